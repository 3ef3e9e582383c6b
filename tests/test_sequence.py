import random

import pytest

from folioflow.operators.sequence import carry_forward, dense_sequence, prefix_sums


def test_prefix_sums_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randrange(5), rng.choice([None, 0, 3, 7])) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, k int, n long").repartition(7)
    got = {r.id: r.before for r in prefix_sums(df, ["k", "id"], "n", "before", group="g").collect()}
    run: dict = {}
    for i, g, _, n in sorted(rows, key=lambda r: (r[2], r[0])):
        assert got[i] == run.get(g, 0)
        run[g] = run.get(g, 0) + (n or 0)
    assert len(got) == 500


def test_dense_sequence_counts_every_row_once(spark):
    df = spark.createDataFrame([(x,) for x in [5, 1, 1, None, 9]], "x int")
    out = dense_sequence(df, ["x"]).orderBy("seq").collect()
    assert [r.seq for r in out] == [0, 1, 2, 3, 4]
    assert [r.x for r in out] == [None, 1, 1, 5, 9]


def test_empty_table(spark):
    assert dense_sequence(spark.createDataFrame([], "x int"), ["x"]).collect() == []
    assert prefix_sums(spark.createDataFrame([], "x int, g string"), ["x"], "x", "s", group="g").collect() == []


@pytest.mark.parametrize("rows_a_batch", ["10000", "3"])
def test_carry_forward_against_a_loop(spark, rows_a_batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    rng = random.Random(6)
    groups = ["hot"] * 400 + ["a", "b", "c"] * 20
    rows = [(g, i, rng.choice([None, None, None, f"v{i}"]) if g != "b" else None) for i, g in enumerate(groups)]
    rng.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, 1, "x")], "g string, k int, v string").repartition(9)
    got = {(r.g, r.k): r.before for r in carry_forward(df, "g", "k", "v", "before").collect()}
    last: dict = {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        assert got[g, k] == last.get(g)
        last[g] = last.get(g) if v is None else v
    assert len(got) == len(rows)
    assert carry_forward(df.limit(0), "g", "k", "v", "before").count() == 0
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

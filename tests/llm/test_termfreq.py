import random
from collections import defaultdict

import pyarrow as pa

from folioflow.llm import termfreq as TF
from tests.llm import helpers as H


def test_lists_are_split_as_a_reader_would(spark):
    cases = {
        "A; B ;a": ["a", "b", "a"], "- One Two\n- Three.": ["one two", "three"], "x and Y AND z": ["x", "y", "z"], " | a  b | ": ["a b"], "sandbox, brand": ["sandbox", "brand"], "": [], " , ; ": [],
        "1. first\n2) second": ["first", "second"], "Set-20k, v2.": ["set-20k", "v2"], "• Été bench": ["été bench"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.t for r in df.select("v", TF.split_terms(df.v).alias("t")).collect()} == cases


def test_counts_against_a_loop(spark):
    rng = random.Random(1)
    words = ["hot"] * 40 + [f"w{i}" for i in range(30)]
    rows = [(rng.choice("fg"), rng.choice(words), f"r{rng.randrange(60)}") for _ in range(4000)]
    n, recs = defaultdict(int), defaultdict(set)
    for f, t, r in rows:
        n[f, t] += 1
        recs[f, t].add(r)
    got = {(r.field, r.term): (r.mentions, r.papers) for r in TF.count_terms(spark.createDataFrame(rows, "field string, term string, record string").repartition(5)).collect()}
    assert got == {k: (n[k], len(recs[k])) for k in n}


def test_runs_over_batch_edges():
    rows = sorted([("f", "a", "1"), ("f", "a", "1"), ("f", "a", "2"), ("f", "b", "2"), ("g", "b", "2")])
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[s : s + 1])], names=["field", "term", "record"]) for s in range(5)]
    total = defaultdict(lambda: [0, 0])
    for b in TF.run_lengths(iter(batches)):
        for f, t, m, p in zip(*(c.to_pylist() for c in b.columns)):
            total[f, t][0] += m
            total[f, t][1] += p
    assert dict(total) == {("f", "a"): [3, 2], ("f", "b"): [1, 1], ("g", "b"): [1, 1]}


def test_marks_and_bad_rows(spark):
    rows = [H.result(f"p{i}", "common; " + ("mid" if i < 4 else f"rare{i}"), None) for i in range(20)]
    rows += rows[:5] + [H.result("x", "failed only", status="failed"), H.result(None, "nobody"), ("y", "success", None), ("z", None, ((None,), (None,))), H.result("e", "", " ")]
    got = {(r.term): (r.papers, r.mark) for r in TF.term_table(H.clash(spark.createDataFrame(rows, H.RESULTS))).collect()}
    assert got["common"] == (20, "common") and got["mid"] == (4, None) and got["rare9"] == (1, "rare") and len(got) == 18
    assert TF.marked_terms(spark.createDataFrame([], H.RESULTS)).count() == 0
    assert TF.term_table(spark.createDataFrame([H.result("p", "x, " * 50_000)], H.RESULTS)).first().mentions == 50_000

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest

from folioflow.operators import incremental as I


def numbers(df):
    return sorted(r.seq for r in I.numbers(df).collect())


def seqs(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "seq long")


@pytest.mark.parametrize("seed", range(3))
def test_intervals_against_sets(spark, seed):
    rng = random.Random(seed)
    top = 3 * I.BLOCK
    a = {rng.randrange(top) for _ in range(400)} | set(range(I.BLOCK - 5, I.BLOCK + 5))
    b = {rng.randrange(top) for _ in range(400)} | set(rng.sample(sorted(a), 100))
    ia, ib = I.to_intervals(seqs(spark, [*a, *a, None])), I.to_intervals(seqs(spark, b))
    assert numbers(ia) == sorted(a)
    assert numbers(I.merge(ia, ib, ia)) == sorted(a | b)
    assert numbers(I.subtract(ia, ib)) == sorted(a - b)
    assert all(r.lo // I.BLOCK == r.hi // I.BLOCK == r.block for r in I.merge(ia, ib).collect())


def test_empty_sides(spark):
    none = spark.createDataFrame([], I.INTERVALS)
    some = I.to_intervals(seqs(spark, [1, 2, 3]))
    assert numbers(I.subtract(some, none)) == [1, 2, 3]
    assert numbers(I.subtract(none, some)) == numbers(I.subtract(some, some)) == []


def test_runs_survive_failures_and_late_commits(spark, tmp_path):
    ledger = I.Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.createDataFrame([(i, f"r{i}") for i in (1, 2, 3, 7, 8)], "seq long, name string")
    with pytest.raises(RuntimeError):
        I.run_new(ledger, rows, lambda todo: (_ for _ in ()).throw(RuntimeError("executor lost")))
    assert ledger.snapshots() == [] and ledger.outputs() is None
    assert I.run_new(ledger, rows, lambda todo: todo).count() == 5
    assert I.run_new(ledger, rows, lambda todo: todo).count() == 0
    late = rows.unionByName(spark.createDataFrame([(5, "late"), (9, "new")], rows.schema))
    assert sorted(r.name for r in I.run_new(ledger, late, lambda todo: todo).collect()) == ["late", "new"]
    assert sorted(r.seq for r in ledger.outputs().collect()) == [1, 2, 3, 5, 7, 8, 9]


def test_half_written_snapshot_is_not_seen(spark, tmp_path):
    ledger = I.Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.createDataFrame([(1,), (2,)], "seq long")
    rows.write.parquet(str(tmp_path / "ledger" / "snapshot-dead" / "output"))
    assert I.pending(rows, ledger.done()).count() == 2


T0 = datetime(2026, 1, 1)
UNITS = "embedding_id string, text_hash string, built_at timestamp, arrived_at timestamp"
MANIFEST = "run_id string, embedding_id string, text_hash string, model string, status string, written_at timestamp"


def test_commits_at_the_same_moment(spark, tmp_path):
    """Both pass the check together; the loser of the file merges, so that neither commit is lost."""
    folder = str(tmp_path / "ledger")
    one, two = I.Ledger(spark, folder), I.Ledger(spark, folder)
    first, tries = two._publish, []

    def raced(kind, number, content):
        if not tries:
            one.commit(seqs(spark, [0, 1, 2]), seqs(spark, [0, 1, 2]))
        tries.append(number)
        return first(kind, number, content)

    two._publish = raced
    two.commit(seqs(spark, [3, 4, 5]), seqs(spark, [3, 4, 5]))
    assert tries == [0, 1] and numbers(one.done()) == [0, 1, 2, 3, 4, 5]
    assert sorted(r.seq for r in one.outputs().collect()) == [0, 1, 2, 3, 4, 5]


def test_threads_that_commit_lose_nothing(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: I.Ledger(spark, folder).commit(seqs(spark, [2 * k, 2 * k + 1]), seqs(spark, [2 * k, 2 * k + 1])), range(6)))
    assert numbers(I.Ledger(spark, folder).done()) == list(range(12))
    assert len(I.Ledger(spark, folder).snapshots()) == 6


def test_the_same_work_is_not_committed_twice(spark, tmp_path):
    ledger = I.Ledger(spark, str(tmp_path / "ledger"))
    rows = seqs(spark, [1, 2, 3])
    calls = []

    def process(todo):
        if not calls:  # another run does two of them while this one works
            ledger.commit(seqs(spark, [1, 2]), seqs(spark, [1, 2]))
        calls.append(sorted(r.seq for r in todo.collect()))
        return todo

    assert [r.seq for r in I.run_new(ledger, rows, process).collect()] == [3] and calls == [[1, 2, 3], [3]]
    assert sorted(r.seq for r in ledger.outputs().collect()) == [1, 2, 3]
    with pytest.raises(I.Taken):
        ledger.commit(seqs(spark, [3]), seqs(spark, [3]))
    assert sorted(r.seq for r in ledger.outputs().collect()) == [1, 2, 3]


def test_crash_between_output_and_commit(spark, tmp_path):
    ledger = I.Ledger(spark, str(tmp_path / "ledger"))
    rows = seqs(spark, [1, 2])
    ledger._publish = lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost"))
    with pytest.raises(RuntimeError):
        I.run_new(ledger, rows, lambda todo: todo)
    again = I.Ledger(spark, ledger.folder)
    assert again.outputs() is None
    assert sorted(r.seq for r in I.run_new(again, rows, lambda todo: todo).collect()) == [1, 2]
    assert sorted(r.seq for r in again.outputs().collect()) == [1, 2]


def test_late_arrival_moves_no_number(spark, tmp_path):
    ledger = I.Ledger(spark, str(tmp_path / "ledger"))
    rows = lambda *xs: spark.createDataFrame(xs, "name string, at int")
    numbered = lambda df: {r.name: r.seq for r in ledger.number(df, ["name"], ["at"]).collect()}
    before = numbered(rows(("a", 5), ("b", 7), ("b", 9), (None, 8)))
    assert before == {"a": 0, "b": 1, None: 2}
    log = lambda: ledger.log(["name"])
    assert I.run_new(ledger, log(), lambda todo: todo).count() == 3
    after = numbered(rows(("z", 1), ("a", 5), ("b", 7), (None, 8)))
    assert after == before | {"z": 3}
    assert [r.name for r in I.run_new(ledger, log(), lambda todo: todo).collect()] == ["z"]
    assert numbered(rows(("a", 5)).limit(0)) == after


def test_backlog_over_several_runs(spark, tmp_path):
    """A run that breaks off, late states, and lines of the manifest written meanwhile: nothing skipped, nothing twice."""
    at = lambda h: T0 + timedelta(hours=h)
    ledger = I.Ledger(spark, str(tmp_path / "ledger"))
    units = [("u1", "a", at(1), at(1)), ("u2", "a", at(1), at(1)), ("u3", "a", at(1), at(1))]
    lines = [("r1", "u1", "a", "m", "success", at(1))]
    ids = lambda: sorted(r.embedding_id for r in I.pending_units(ledger, spark.createDataFrame(units, UNITS), spark.createDataFrame(lines, MANIFEST)).collect())
    assert ids() == ["u2", "u3"] == ids()
    lines.append(("r2", "u2", "a", "m", "success", at(2)))
    units += [("u0", "a", at(0), at(0)), ("u2", "b", at(3), at(3)), ("u3", "old", at(0), at(9))]
    assert ids() == ["u0", "u2", "u3"]
    todo = I.pending_units(ledger, spark.createDataFrame(units, UNITS), spark.createDataFrame(lines, MANIFEST))
    ledger.commit(todo, todo)
    assert ids() == []
    lines.append(("r3", "u9", "x", "other", "success", at(4)))
    assert ids() == ["u0", "u1", "u2", "u3"]


def test_pending_units(spark):
    at = lambda h: T0 + timedelta(hours=h)
    units = spark.createDataFrame([
        ("same", "h1", at(1), at(1)), ("same", "h1", at(1), at(2)), ("changed", "new", at(5), at(5)), ("changed", "old", at(1), at(9)),
        ("failed", "h", at(1), at(1)), ("othermodel", "h", at(1), at(1)), ("never", "h", at(1), at(1)), (None, "h", at(1), at(1)), ("back", "a", at(3), at(3)),
    ], UNITS)
    manifest = spark.createDataFrame([
        ("r1", "same", "h1", "m1", "success", at(1)), ("r2", "same", "h1", "m2", "success", at(2)), ("r3", "same", "h1", "m2", "failed", at(3)),
        ("r2", "changed", "old", "m2", "success", at(2)), ("r3", "failed", "h", "m2", "failed", at(3)), ("r1", "othermodel", "h", "m1", "success", at(99)),
        ("r2", "gone", "h", "m2", "success", at(2)), ("r1", "back", "a", "m2", "success", at(1)), ("r2", "back", "b", "m2", "success", at(2)),
    ], MANIFEST)
    assert sorted(r.embedding_id for r in I.pending_units(I.fresh_ledger(spark), units, manifest).collect()) == ["back", "changed", "failed", "never", "othermodel"]


def test_pending_units_of_empty_tables(spark):
    none = spark.createDataFrame([], UNITS)
    assert I.pending_units(I.fresh_ledger(spark), none, spark.createDataFrame([], MANIFEST)).count() == 0
    one = spark.createDataFrame([("a", None, None, None)], UNITS)
    assert I.pending_units(I.fresh_ledger(spark), one, spark.createDataFrame([], MANIFEST)).count() == 1


def test_pending_jobs(spark):
    jobs = spark.createDataFrame([(1, "a"), (1, "a"), (5, "b"), (5, "c"), (None, "d"), (9, None)], "position int, paper_id string")
    results = spark.createDataFrame([("a", "failed"), ("a", "success"), ("b", "failed"), (None, "success")], "paper_id string, status string")
    assert sorted(r.paper_id for r in I.pending_jobs(I.fresh_ledger(spark), jobs, results).collect()) == ["b", "c", "d"]
    assert I.pending_jobs(I.fresh_ledger(spark), jobs.limit(0), results).count() == 0

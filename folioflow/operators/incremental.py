"""Processing only new or changed records, with processed sequence numbers kept as intervals.

A ledger is a table of disjoint closed intervals ``(block, lo, hi)`` of sequence numbers that are
done. Intervals never cross a block of ``BLOCK`` numbers, so merging and subtracting work inside
one block at a time: a window partition holds at most ``BLOCK`` numbers whatever the table's size,
and a hot key cannot make one larger. What a run has to do is *available minus done*, which also
finds numbers that were committed late, behind the highest number already processed.

A record gets its number when a ledger first sees it (``Ledger.number``). The number is stored and
never given again, so a record that arrives late takes a new number behind the others, whatever
its time stamp says, and moves no other record's number.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.operators.sequence import dense_sequence
from folioflow.session import checkpoint_dir, cut, remove

#: Sequence numbers in a block of the ledger.
BLOCK = 1 << 16

INTERVALS = "block long, lo long, hi long"


def _block(seq: Column) -> Column:
    return F.floor(seq / F.lit(BLOCK)).cast("long")


def to_intervals(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Distinct sequence numbers as disjoint intervals; null numbers are ignored."""
    one = df.select(F.col(seq).cast("long").alias("s")).where("s is not null").distinct().withColumn("block", _block(F.col("s")))
    island = F.col("s") - F.row_number().over(Window.partitionBy("block").orderBy("s"))
    return one.withColumn("island", island).groupBy("block", "island").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).select("block", "lo", "hi")


def merge(*ledgers: DataFrame) -> DataFrame:
    """The union of intervals, overlapping and adjoining ones made one. Repeated commits change nothing."""
    both = ledgers[0].select("block", "lo", "hi")
    for x in ledgers[1:]:
        both = both.unionByName(x.select("block", "lo", "hi"))
    w = Window.partitionBy("block").orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("lo") > reach + 1), 1).otherwise(0)
    run = F.sum("begins").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        both.withColumn("begins", begins).withColumn("run", run)
        .groupBy("block", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("block", "lo", "hi")
    )


def subtract(available: DataFrame, done: DataFrame) -> DataFrame:
    """Intervals of ``available`` that ``done`` does not cover. Both hold disjoint intervals.

    A sweep over the ends of the intervals: between two neighbouring ends the numbers are either
    all in a set or all out of it.
    """
    def ends(df: DataFrame, side: str) -> DataFrame:
        other = "d" if side == "a" else "a"
        pairs = F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias(side)), F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias(side)))
        return df.select("block", F.explode(pairs).alias("e")).select("block", F.col("e.at").alias("at"), F.col(f"e.{side}").alias(side), F.lit(0).alias(other)).select("block", "at", "a", "d")

    steps = ends(available, "a").unionByName(ends(done, "d")).groupBy("block", "at").agg(F.sum("a").alias("a"), F.sum("d").alias("d"))
    w = Window.partitionBy("block").orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = steps.select("block", "at", F.lead("at").over(w).alias("next"), F.sum("a").over(upto).alias("a"), F.sum("d").over(upto).alias("d"))
    return merge(swept.where("a > 0 and d = 0 and next is not null").select("block", F.col("at").alias("lo"), (F.col("next") - 1).alias("hi")))


def numbers(intervals: DataFrame, out: str = "seq") -> DataFrame:
    return intervals.select(F.explode(F.sequence("lo", "hi")).alias(out))


def pending(rows: DataFrame, done: DataFrame, seq: str = "seq") -> DataFrame:
    """The rows whose sequence number is available and not done (all rows of a repeated number)."""
    gaps = numbers(subtract(to_intervals(rows, seq), done), seq)
    return rows.join(gaps, seq, "left_semi")


class Taken(RuntimeError):
    """Another run has committed some of the same numbers; nothing of this commit is visible."""


class Ledger:
    """Intervals and numbers in a folder, as immutable snapshots and numbered commit files.

    A run writes its output and the merged intervals into a snapshot folder of its own. Both become
    visible together when the commit file with the next number appears. Only one run can make a
    given number: the file is complete before it takes its name, by a hard link on local disks and
    by a rename elsewhere, neither of which replaces a file that is there (the file system has to
    promise that, as HDFS does). The loser of a race reads the ledger again and merges its own
    intervals into what the winner committed, so no commit is lost. If both did the same
    numbers the second raises ``Taken`` and its output stays invisible: nothing is done twice. A run
    that dies before its commit file leaves no trace, and the next run sees the same gaps again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.folder, *parts))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _chain(self, kind: str) -> list[dict]:
        """The contents of the commit files of a kind, first to last."""
        fs, out = self._fs(), []
        if not fs.exists(self._path()):
            return out
        for name in sorted(n for n in (x.getPath().getName() for x in fs.listStatus(self._path())) if n.startswith(f"{kind}-")):
            stream = fs.open(self._path(name))
            try:
                out.append(json.loads(bytes(stream.readAllBytes())))
            finally:
                stream.close()
        return out

    def _publish(self, kind: str, number: int, content: dict) -> bool:
        """Whether commit file ``number`` is now this one. False: another run was first."""
        fs, new, target = self._fs(), self._path(f"_{uuid.uuid4().hex}"), self._path(f"{kind}-{number:09d}")
        stream = fs.create(new, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        try:
            if fs.getUri().getScheme() != "file":
                return not fs.exists(target) and bool(fs.rename(new, target))
            try:
                os.link(new.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        finally:
            fs.delete(new, False)

    def snapshots(self) -> list[str]:
        """Committed snapshots, first to last."""
        return [c["snapshot"] for c in self._chain("commit")]

    def _done(self, chain: list[dict]) -> DataFrame:
        if not chain:
            return self.spark.createDataFrame([], INTERVALS)
        return self.spark.read.schema(INTERVALS).parquet(os.path.join(self.folder, chain[-1]["snapshot"], chain[-1]["intervals"]))

    def done(self) -> DataFrame:
        return self._done(self._chain("commit"))

    def outputs(self) -> DataFrame | None:
        """The output of all commits that have one."""
        paths = [os.path.join(self.folder, c["snapshot"], "output") for c in self._chain("commit") if c["output"]]
        return self.spark.read.parquet(*paths) if paths else None

    def commit(self, processed: DataFrame, output: DataFrame | None = None, seq: str = "seq") -> str:
        """Add the numbers of ``processed`` with their output; raises ``Taken`` if some are done already."""
        return self.commit_intervals(cut(to_intervals(processed, seq)), output)

    def commit_intervals(self, mine: DataFrame, output: DataFrame | None = None) -> str:
        name = f"snapshot-{uuid.uuid4().hex}"
        if output is not None:
            output.write.parquet(os.path.join(self.folder, name, "output"))
        while True:
            chain = self._chain("commit")
            before = self._done(chain)
            if chain and not overlap(mine, before).isEmpty():
                remove(self.spark, os.path.join(self.folder, name))
                raise Taken("another run has committed some of these numbers")
            intervals = f"intervals-{len(chain):09d}"
            (merge(before, mine) if chain else mine).write.mode("overwrite").parquet(os.path.join(self.folder, name, intervals))
            if self._publish("commit", len(chain), {"snapshot": name, "intervals": intervals, "output": output is not None}):
                return name

    def log(self, key: list[str]) -> DataFrame | None:
        """(key..., seq) of all records ever numbered; None before the first."""
        chain = self._chain("numbers")
        return self.spark.read.parquet(*[os.path.join(self.folder, c["part"]) for c in chain]).select(*key, "seq") if chain else None

    def number(self, records: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        """(key..., seq) of all records; those not seen before get the next numbers, in ``order``.

        A key with nulls is a key like any other. Repeated records have one number. ``order`` are
        columns of ``records``; the smallest of a repeated record counts.
        """
        extra = [c for c in order if c not in key]
        one = records.groupBy(*key).agg(*[F.min(c).alias(c) for c in extra]) if extra else records.select(*key).distinct()
        while True:
            chain, known = self._chain("numbers"), self.log(key)
            new = one if known is None else one.join(known, _same(one, known, key), "left_anti")
            first = chain[-1]["next"] if chain else 0
            part = f"numbers_{uuid.uuid4().hex}"
            dense_sequence(new, [*order, *(c for c in key if c not in order)]).select(*key, (F.col("seq") + first).alias("seq")).write.parquet(os.path.join(self.folder, part))
            fresh = self.spark.read.parquet(os.path.join(self.folder, part))
            if n := fresh.count():
                if not self._publish("numbers", len(chain), {"part": part, "next": first + n}):
                    remove(self.spark, os.path.join(self.folder, part))
                    continue
            return fresh if known is None else self.log(key)


def _same(a: DataFrame, b: DataFrame, key: list[str]) -> Column:
    on = F.lit(True)
    for c in key:
        on = on & a[c].eqNullSafe(b[c])
    return on


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """The intervals of ``a`` of which a number is in ``b`` too."""
    x, y = a.alias("x"), b.alias("y")
    on = (F.col("x.block") == F.col("y.block")) & (F.col("x.lo") <= F.col("y.hi")) & (F.col("y.lo") <= F.col("x.hi"))
    return x.join(y, on, "left_semi")


def run_new(ledger: Ledger, rows: DataFrame, process: Callable[[DataFrame], DataFrame], seq: str = "seq") -> DataFrame:
    """Process exactly the gaps of the ledger and commit them with their output.

    If another run has meanwhile committed some of them, its work stands, and what is left is done
    anew. Gives the rows that this run has committed.
    """
    while True:
        todo = cut(pending(rows, ledger.done(), seq))
        try:
            ledger.commit(todo, process(todo), seq)
        except Taken:
            continue
        return todo


def unit_states(units: DataFrame) -> DataFrame:
    """Every distinct state of every unit with the time it first arrived.

    Rows without an id are left out. Repeated rows count once. ``current`` marks the state built
    last; of states built at one time the one that arrived last, then the greatest hash.
    """
    states = units.where("embedding_id is not null").groupBy("embedding_id", "text_hash", "built_at").agg(F.min("arrived_at").alias("arrived_at"), F.max("arrived_at").alias("seen"))
    last = states.groupBy("embedding_id").agg(F.max(F.struct("built_at", "seen", "text_hash")).alias("top"))
    return states.join(last, "embedding_id").select(
        "embedding_id", "text_hash", "built_at", "arrived_at",
        (F.struct("built_at", "seen", "text_hash").eqNullSafe(F.col("top"))).alias("current"),
    )


def stored_hashes(manifest: DataFrame) -> DataFrame:
    """Of each unit the hash and model of its last successful manifest line, in the order of runs."""
    ok = manifest.where("status = 'success' and embedding_id is not null")
    return ok.groupBy("embedding_id").agg(F.max(F.struct("run_id", "written_at", "text_hash", "model")).alias("last")).select("embedding_id", F.col("last.text_hash").alias("stored_hash"), F.col("last.model").alias("stored_model"))


def latest_model(manifest: DataFrame) -> str | None:
    """The model of the latest run, None for an empty manifest. Reads one row."""
    top = manifest.where("run_id is not null and model is not null").agg(F.max(F.struct("run_id", "model")).alias("m")).first()
    return top.m.model if top.m else None


STATE = ["embedding_id", "built_at", "text_hash", "model"]


def pending_units(ledger: Ledger, units: DataFrame, manifest: DataFrame) -> DataFrame:
    """The current unit states that the next run has to embed, with their sequence numbers.

    States are numbered in the ledger under the model of the latest run, so a change of model makes
    every state new. What the manifest proves is committed: states that a later one has replaced, and current ones
    whose hash the last successful line stored under that model. The gaps are the rest, and what a
    run embeds is committed by ``run_new`` or ``Ledger.commit``. Calling it again numbers only states
    that have arrived since and commits only what the manifest has newly proved. A number once done stays done,
    also if a later line of the manifest stores an older hash again; a new ledger shows such units.
    """
    states = unit_states(units).withColumn("model", F.lit(latest_model(manifest)).cast("string"))
    log = ledger.number(states, STATE, ["arrived_at", "embedding_id"])
    now = states.join(log, _same(states, log, STATE)).select(states["embedding_id"], states["text_hash"], states["model"], states["current"], log["seq"])
    proof = now.join(stored_hashes(manifest), "embedding_id", "left")
    stored = F.col("stored_model").eqNullSafe(F.col("model")) & F.col("stored_model").isNotNull() & F.col("text_hash").eqNullSafe(F.col("stored_hash"))
    seen = cut(proof.select("embedding_id", "text_hash", "seq", (~F.col("current") | stored).alias("proved")))
    adopt(ledger, seen.where("proved"))
    return pending(seen.drop("proved"), ledger.done())


def pending_jobs(ledger: Ledger, jobs: DataFrame, results: DataFrame) -> DataFrame:
    """The jobs without a successful result, with their sequence numbers.

    A position may be missing or shared by two papers and would hide a job, so papers are numbered in
    the ledger, new ones in the order (position, paper_id). Successes are committed.
    """
    distinct = jobs.where("paper_id is not null").groupBy("paper_id").agg(F.min("position").alias("position"))
    log = ledger.number(distinct, ["paper_id"], ["position"]).join(distinct.select("paper_id"), "paper_id", "left_semi")
    good = results.where("status = 'success' and paper_id is not null").select("paper_id").distinct()
    adopt(ledger, log.join(good, "paper_id", "left_semi"))
    return pending(log, ledger.done())


def adopt(ledger: Ledger, proved: DataFrame, seq: str = "seq") -> None:
    """Commit the numbers of ``proved`` that are not done yet, without output."""
    while True:
        new = to_intervals(proved, seq)
        new = cut(subtract(new, ledger.done()) if ledger.snapshots() else new)
        if new.isEmpty():
            return
        try:
            ledger.commit_intervals(new)
            return
        except Taken:
            continue


def fresh_ledger(spark: SparkSession) -> Ledger:
    """An empty ledger in a folder of its own under the shared folder."""
    return Ledger(spark, os.path.join(checkpoint_dir(spark), f"ledger-{uuid.uuid4().hex}"))

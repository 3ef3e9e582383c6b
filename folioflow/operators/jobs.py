"""Jobs of the extraction stage: discovery, selection, checks, resuming, outcomes, concurrency."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.contract import reply_error
from folioflow.functions.text import natural_key
from folioflow.operators.sequence import dense_sequence
from folioflow.session import cut

# Fixed values.
CONTEXT_FILES = ("llm_context.txt", "llm_context.py")
IMAGE_TYPES = ("png", "jpg", "jpeg", "webp")
TRANSIENT = ("timeout", "timed out", "connection reset", "connection aborted", "connection error", "temporarily unavailable", "service unavailable", "too many requests", "throttl")


def discover_jobs(files: DataFrame) -> DataFrame:
    """(path) of all files below the artifacts folder -> jobs, numbered 1, 2, ... in natural order.

    A folder ``<paper>/`` with a context file is a job; its pictures lie in ``Visuals`` or, without
    that, ``visuals``. Numbering is distributed; no window holds all jobs.
    """
    parts = files.select("path", F.regexp_extract("path", r"([^/]+)/([^/]+)$", 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    prio = F.when(F.col("name") == CONTEXT_FILES[0], 0).when(F.col("name") == CONTEXT_FILES[1], 1)
    jobs = parts.where(F.col("name").isin(*CONTEXT_FILES)).groupBy(F.col("folder").alias("paper_id")).agg(F.min_by("path", prio).alias("context_path"))
    jobs = jobs.withColumn("artifact_dir", F.regexp_replace("context_path", r"/[^/]+$", "")).withColumn("sort_key", F.array_join(natural_key(F.col("paper_id")), "\u0001"))
    numbered = dense_sequence(jobs, ["sort_key", "paper_id"], "position").withColumn("position", (F.col("position") + 1).cast("int")).drop("sort_key")
    pictures = list_images(files)
    return numbered.join(pictures, "paper_id", "left").withColumn("image_paths", F.coalesce("image_paths", F.array().cast("array<string>")))


def list_images(files: DataFrame) -> DataFrame:
    """(paper_id, image_paths) in natural order of the file names."""
    p = F.col("path")
    shown = files.select("path", F.regexp_extract(p, r"([^/]+)/([Vv]isuals)/([^/]+)$", 1).alias("paper_id"), F.regexp_extract(p, r"/([Vv]isuals)/[^/]+$", 1).alias("folder"), F.regexp_extract(p, r"([^/]+)$", 1).alias("name"))
    ok = shown.where(F.col("folder").isin("Visuals", "visuals") & F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).isin(*IMAGE_TYPES))
    upper = F.max(F.col("folder") == "Visuals").over(Window.partitionBy("paper_id"))
    one = ok.withColumn("upper", upper).where((F.col("folder") == "Visuals") == F.col("upper"))
    ordered = F.array_sort(F.collect_list(F.struct(natural_key(F.col("name")).alias("k"), "path")))
    return one.groupBy("paper_id").agg(F.transform(ordered, lambda x: x.path).alias("image_paths"))


def parse_limit(spec: str | None, total: int) -> tuple[int, int]:
    """``N`` or ``A-B`` (both ends in) to positions; the end is cut to what is there."""
    if spec is None:
        return 1, total
    if not (m := re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", spec)):
        raise ValueError(f"not a limit: {spec!r}")
    start, stop = (int(m[1]), int(m[2])) if m[2] else (1, int(m[1]))
    if start < 1 or stop < start or start > total:
        raise ValueError(f"limit {spec!r} does not fit {total} jobs")
    return start, min(stop, total)


def in_range(jobs: DataFrame, spec: str | None) -> DataFrame:
    last = jobs.agg(F.max("position")).first()[0] or 0
    start, stop = parse_limit(spec, last)
    return jobs.where(F.col("position").between(start, stop))


def preflight(jobs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(paper_id, errors) of jobs whose context or a picture is missing or empty; ``sizes`` has (path, length)."""
    wanted = jobs.select("paper_id", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("at"), F.lit("context").alias("what"), F.col("context_path").alias("path"))), F.transform("image_paths", lambda x, i: F.struct((i + 1).alias("at"), F.lit("image").alias("what"), x.alias("path"))))).alias("f")).select("paper_id", "f.*")
    found = wanted.join(sizes.select("path", "length"), "path", "left")
    message = F.when(F.col("length").isNull(), F.concat(F.lit("missing "), "what", F.lit(": "), "path")).when(F.col("length") == 0, F.concat(F.lit("empty "), "what", F.lit(": "), "path"))
    bad = found.withColumn("message", message).where("message is not null")
    return bad.groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "message"))), lambda x: x.message).alias("errors"))


def completed(results: DataFrame) -> DataFrame:
    return results.where("status = 'success' and paper_id is not null").select("paper_id").distinct()


def resume(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Jobs without a success; failures are tried again."""
    return jobs.join(completed(results), "paper_id", "left_anti")


def dry_run(jobs: DataFrame, results: DataFrame) -> DataFrame:
    return jobs.join(completed(results).withColumn("done", F.lit(True)), "paper_id", "left").select("position", "paper_id", F.coalesce("done", F.lit(False)).alias("completed"))


def classify_error(status: Column, error_type: Column, message: Column) -> Column:
    """struct(retryable, throttled) of a failed call."""
    name, text = F.lower(F.coalesce(error_type, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    marked = F.lit(False)
    for m in TRANSIENT:
        marked = marked | name.contains(m) | text.contains(m)
    marked = marked | F.coalesce(error_type, F.lit("")).isin("TimeoutError", "ConnectionError", "ConnectionResetError", "ConnectionAbortedError", "ConnectionRefusedError", "BrokenPipeError")
    slow = text.contains("429") | text.contains("too many requests") | text.contains("throttl")
    coded = F.when(status == 429, F.struct(F.lit(True).alias("retryable"), F.lit(True).alias("throttled"))).when(status.isin(408, 409, 425) | status.between(500, 599), F.struct(F.lit(True).alias("retryable"), F.lit(False).alias("throttled")))
    return coded.when(marked, F.struct(F.lit(True).alias("retryable"), slow.alias("throttled"))).otherwise(F.struct(F.lit(False).alias("retryable"), F.lit(False).alias("throttled")))


def aimd(outcomes: DataFrame, run: str, order: str, initial: int = 8, least: int = 2, most: int = 24, window: int = 8, factor: float = 0.7) -> DataFrame:
    """The concurrency after every outcome of a run: (run, order, current).

    ``outcomes`` has ``throttles`` and ``success``. The controller has few states (concurrency times
    successes in a row), so the outcomes of a run in one partition of the sort are a mapping of all
    states to states. Each partition reports the mapping of the run that it ends with, the mappings
    are chained on the driver (one a partition), and every partition replays its rows from the state
    that reaches it. A run may hold most of the rows. Null throttles count as none, null success as failure.
    """
    floor = least
    states = [(c, k) for c in range(min(least, initial), max(most, initial) + 1) for k in range(window)]
    number = {s: i for i, s in enumerate(states)}

    def step(current, clean, ok: bool, slow: bool):
        if slow:
            return np.maximum(floor, np.floor(np.maximum(floor, current * factor))).astype(np.int64), clean * 0
        if not ok:
            return current, clean * 0
        full = clean + 1 >= window
        return np.where(full, np.minimum(most, current + 1), current), np.where(full, 0, clean + 1)

    rows = outcomes.select(F.col(run).alias("run"), F.col(order).alias("at"), F.coalesce("success", F.lit(False)).alias("ok"), (F.coalesce("throttles", F.lit(0)) > 0).alias("slow")).where("run is not null")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, dtype=np.int32))], names=[*b.schema.names, "part"])

    kinds = f"run {rows.schema['run'].dataType.simpleString()}, at {rows.schema['at'].dataType.simpleString()}"
    ranged = cut(rows.repartitionByRange("run", "at").sortWithinPartitions("run", "at").mapInArrow(numbered, f"{kinds}, ok boolean, slow boolean, part int"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = part = None
        for b in batches:
            for r, ok, slow, p in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if part is None or r != last:
                    first, last, part = r if part is None else first, r, p
                    current, clean = (np.array(x) for x in zip(*states))
                current, clean = step(current, clean, ok, slow)
        if part is not None:
            ends = [[number[int(c), int(k)] for c, k in zip(current, clean)]]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], b.column(0).type), pa.array([last], b.column(0).type), pa.array(ends, pa.list_(pa.int32()))], names=["part", "first", "last", "ends"])

    kind = rows.schema["run"].dataType.simpleString()
    begin, state, running = {}, number[initial, 0], None
    for p in sorted(ranged.mapInArrow(chunks, f"part int, first {kind}, last {kind}, ends array<int>").collect(), key=lambda p: p.part):
        if p.first == running:
            begin[p.part] = state
        state = p.ends[state if p.first == p.last == running else number[initial, 0]]
        running = p.last

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, current, clean, begun = None, initial, 0, False
        for b in batches:
            out = []
            for r, ok, slow, p in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if not begun or r != now:
                    current, clean = states[begin[p]] if not begun and p in begin else (initial, 0)
                    now, begun = r, True
                current, clean = (int(x) for x in step(np.int64(current), np.int64(clean), ok, slow))
                out.append(current)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int32())], names=["run", "at", "current"])

    return ranged.mapInArrow(replay, f"{kinds}, current int").select(F.col("run").alias(run), F.col("at").alias(order), "current")


OUTCOME = "paper_id string, position int, status string, response string, error_type string, error string, retryable_at_failure boolean, client_calls int, contract_retries_used int"

CORRECTION = "\n\nYour last reply broke the required format. Reply with one JSON object that keeps it exactly."


def run_jobs(jobs: DataFrame, make_client: Callable[[], Callable[[str, str], str]], prompt: str, contract_retries: int = 1) -> DataFrame:
    """Call a model for each job (paper_id, position, context) and check its reply.

    ``make_client`` runs once a partition and gives ``complete(context, system_prompt) -> reply``. A
    reply that breaks the contract is asked for again with a correction; any other error ends the
    job with a failure record. Errors are rows, never exceptions, so one paper cannot fail a stage.
    A lost task calls again: write the result once and resume by paper_id.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for df in batches:
            rows = []
            for r in df.itertuples():
                calls, error, kind, reply = 0, None, None, None
                for attempt in range(contract_retries + 1):
                    calls += 1
                    try:
                        reply = client(r.context, prompt + (CORRECTION if attempt else ""))
                        error = reply_error(reply)
                    except Exception as e:  # noqa: BLE001 - becomes the job's failure record
                        kind, error = type(e).__name__, str(e)
                        break
                    kind = "ValueError" if error else None
                    if not error:
                        break
                retry = bool(error) and kind != "ValueError" and any(m in f"{kind} {error}".lower() for m in TRANSIENT)
                rows.append((r.paper_id, r.position, "failed" if error else "success", None if error else reply, kind, error, retry if error else None, calls, calls - 1))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUTCOME.split(", ")])

    return jobs.select("paper_id", "position", "context").mapInPandas(call, OUTCOME)


class Controller:
    """The concurrency of a run: more after successes in a row, less after a throttled call (see ``aimd``)."""

    def __init__(self, initial: int = 8, least: int = 2, most: int = 24, window: int = 8, factor: float = 0.7):
        self.current, self.clean, self.least, self.most, self.window, self.factor = initial, 0, least, most, window, factor

    def observe(self, success: bool, throttles: int) -> None:
        if throttles:
            self.current, self.clean = max(self.least, int(max(self.least, self.current * self.factor))), 0
        elif not success:
            self.clean = 0
        else:
            self.clean += 1
            if self.clean >= self.window:
                self.current, self.clean = min(self.most, self.current + 1), 0


def run_adaptive(jobs: DataFrame, make_client: Callable[[], Callable[[str, str], str]], prompt: str, folder: str, controller: Controller | None = None, calls_each: int = 8, contract_retries: int = 1) -> Controller:
    """Call a model for all jobs that have no success in ``folder`` yet, never more at a time than the controller allows.

    Each round takes the next ``current`` times ``calls_each`` jobs in the order of their positions, runs them in
    ``current`` tasks, appends the outcomes and lets the controller see them in that order; what
    the driver gets of a round is a flag and a number for each of its jobs. A run that broke off goes on where its last
    complete round ended; failed jobs are tried again by the next run.
    """
    spark, steer = jobs.sparkSession, controller or Controller()
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    left = resume(jobs, spark.read.schema(OUTCOME).json(folder)) if there else jobs
    numbered = cut(dense_sequence(left.select("paper_id", "position", "context"), ["position", "paper_id"], "__nth"))
    next_, total = 0, numbered.count()
    while next_ < total:
        n = steer.current * calls_each
        chunk = numbered.where(F.col("__nth").between(next_, next_ + n - 1)).repartition(steer.current)
        done = cut(run_jobs(chunk, make_client, prompt, contract_retries))
        done.write.mode("append").json(folder)
        slow = classify_error(F.lit(None).cast("int"), F.col("error_type"), F.col("error"))["throttled"]
        for r in done.orderBy("position", "paper_id").select((F.col("status") == "success").alias("ok"), F.coalesce(slow, F.lit(False)).alias("slow")).collect():
            steer.observe(r.ok, int(r.slow))
        next_ += n
    return steer


def run_record(outcomes: DataFrame, **provenance) -> DataFrame:
    """One row: the counts of a run and where its inputs came from."""
    good = F.col("status") == "success"
    return outcomes.agg(F.count("*").alias("attempted"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"), F.coalesce(F.sum("client_calls"), F.lit(0)).alias("client_calls")).withColumn("provenance", F.lit(json.dumps(provenance, sort_keys=True)))

"""Streams over the append-only files: resuming by key and by hash, and the concurrency controller.

Each micro-batch runs the plan of the batch operators, so a stream and a batch give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from folioflow import schemas
from folioflow.operators import embed


def results_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Result lines as they arrive; every paper's first success once, late repeats dropped by key."""
    rows = spark.readStream.schema(schemas.RESULT).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return rows.where("status = 'success' and paper_id is not null").dropDuplicates(["paper_id"])


def units_into(results: DataFrame, read_store: Callable[[], DataFrame], write_units: Callable[[DataFrame, int], None], model: str, checkpoint: str) -> StreamingQuery:
    """For each micro-batch build the facet units, drop those the store holds, and hand on the rest.

    ``write_units`` gets the batch number, so that writing a batch again replaces it.
    """

    def each(batch: DataFrame, number: int) -> None:
        planned = embed.plan(embed.facet_units(embed.facet_values(batch)), read_store(), model)
        write_units(planned.where("action = 'pending'").drop("action"), number)

    return results.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def outcome_rates(outcomes: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Successes and throttles in windows of event time (ts, success, throttles); later rows are dropped."""
    return outcomes.withWatermark("ts", late).groupBy(F.window("ts", width)).agg(F.count("*").alias("calls"), F.count_if("success").alias("successes"), F.sum("throttles").alias("throttles"))


def concurrency(outcomes: DataFrame, initial: int = 8, least: int = 2, most: int = 24, window: int = 8, factor: float = 0.7) -> DataFrame:
    """The controller as keyed state: (run, current) after each micro-batch of outcomes (run, seq, success, throttles)."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        current, clean = state.get if state.exists else (initial, 0)
        rows = pd.concat(list(batches)).sort_values("seq")
        for ok, slow in zip(rows.success, rows.throttles):
            if slow > 0:
                current, clean = max(least, int(max(least, current * factor))), 0
            elif not ok:
                clean = 0
            else:
                clean += 1
                if clean >= window:
                    current, clean = min(most, current + 1), 0
        state.update((current, clean))
        yield pd.DataFrame({"run": [key[0]], "current": [current]})

    return outcomes.groupBy("run").applyInPandasWithState(step, "run string, current int", "current int, clean int", "update", "NoTimeout")

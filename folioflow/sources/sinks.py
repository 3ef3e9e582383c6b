"""Sinks: context files, appended lines, run records. The commit protocol replaces single writers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas


def export_contexts(contexts: DataFrame, folder: str) -> None:
    """One text file a paper, in ``paper_id=<id>/``."""
    contexts.select("paper_id", F.col("text").alias("value")).repartition("paper_id").write.mode("overwrite").partitionBy("paper_id").option("lineSep", "\n").text(folder)


def append_lines(rows: DataFrame, folder: str) -> None:
    """JSON lines; files of a failed attempt never become visible."""
    rows.write.mode("append").json(folder)


def append_manifest(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").partitionBy("run_id").json(folder)


def append_run(record: DataFrame, folder: str) -> None:
    record.withColumn("ended_at", F.current_timestamp()).write.mode("append").parquet(folder)


def last_run(spark: SparkSession, folder: str) -> DataFrame:
    runs = spark.read.parquet(folder)
    return runs.agg(F.max_by(F.struct(*runs.columns), "ended_at").alias("r")).select("r.*")


def create_store(spark: SparkSession, folder: str) -> str:
    """Get or create the empty vector store; returns its newest snapshot."""
    path = os.path.join(folder, "snapshot-000000")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        spark.createDataFrame([], schemas.STORE).write.parquet(path)
    return path

"""Session helpers shared by every operator: the session itself and lineage cuts."""

from __future__ import annotations

import hashlib
import io
import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the caller brings the session."""
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.host": "127.0.0.1",
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=base).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-machine session without that
    setting gets a folder of its own; a cluster without it is an error, because a folder on one
    machine would be unreadable for the executors on the others.
    """
    sc = spark.sparkContext
    if there := sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None):
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(there)
        return there
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(own := tempfile.mkdtemp(prefix="folioflow-checkpoint-"))
    return own


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made.

    Used where a plan reads one intermediate result several times or where values depend on the
    order of a shuffle (sequence numbers): a lost executor then re-reads files instead of
    recomputing a result that might come out in another order.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def rewrite(df: DataFrame, old: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` to a table in the shared folder, delete the table ``old``, and read the new one.

    For loops that build each round on the last one: unlike a checkpoint, which keeps the size that
    was estimated for its plan, a table has its real size, so estimates do not multiply from round
    to round.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"folioflow-{uuid.uuid4().hex}")
    df.write.parquet(path)
    if old:
        remove(spark, old)
    return spark.read.parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of every executor, once a session, by the shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_folioflow_shipped", False):
        return
    here, packed = pathlib.Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(p.relative_to(here.parent))), p.read_bytes())
    at = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark), f"folioflow-{hashlib.md5(packed.getvalue()).hexdigest()}.zip")
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    sc.addPyFile(at.toString())
    sc._folioflow_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))

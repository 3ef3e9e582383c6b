"""The core queries over the project's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import incremental
from folioflow.plans import page_queries, stage_queries
from folioflow.session import cut, remove, table

Query = Callable[[SparkSession, str], DataFrame]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The gaps of two ledgers that are made here from the manifest and the results."""
    of_units, of_jobs = incremental.fresh_ledger(spark), incremental.fresh_ledger(spark)
    units = incremental.pending_units(of_units, table(spark, d, "embedding_units"), table(spark, d, "manifest"))
    jobs = incremental.pending_jobs(of_jobs, table(spark, d, "jobs"), table(spark, d, "results"))
    unit = units.select(F.lit("unit").alias("kind"), F.col("embedding_id").alias("key_id"))
    found = cut(unit.unionByName(jobs.select(F.lit("job").alias("kind"), F.col("paper_id").alias("key_id"))).distinct())
    for ledger in (of_units, of_jobs):
        remove(spark, ledger.folder)
    return found


QUERIES: dict[str, Query] = {p5_found.__name__: p5_found} | page_queries.QUERIES | stage_queries.QUERIES

ORACLE = page_queries.ORACLE | stage_queries.ORACLE | {
    "p5_found": """
WITH cur AS (SELECT embedding_id, arg_max(text_hash, struct_pack(b := built_at, a := arrived_at, h := text_hash)) AS h FROM embedding_units GROUP BY 1),
stored AS (
  SELECT embedding_id, max(struct_pack(r := run_id, w := written_at, h := text_hash, m := model)) AS l
  FROM manifest WHERE status = 'success' GROUP BY 1),
latest AS (SELECT max(struct_pack(r := run_id, m := model)).m AS m FROM manifest)
SELECT 'unit' AS kind, embedding_id AS key_id FROM cur LEFT JOIN stored USING (embedding_id), latest
WHERE NOT (l.h IS NOT DISTINCT FROM cur.h AND l.m IS NOT DISTINCT FROM latest.m)
UNION ALL
SELECT DISTINCT 'job', paper_id FROM jobs WHERE paper_id NOT IN (SELECT paper_id FROM results WHERE status = 'success' AND paper_id IS NOT NULL)
""",
}

"""How often every distinct term occurs, and in how many records.

(term, record) pairs are range-partitioned and sorted, so all rows of a term lie next to each
other, over as many partitions as a hot term needs. A run-length scan over each sorted partition
counts occurrences and distinct records; a term that spans partitions leaves one partial count in
each, and equal pairs never lie in two partitions, so partial counts add up exactly.

Null lists and empty items give no terms. A paper with several successful results counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("datasets_benchmarks", "contribution_type")
#: In fewer papers than this a term is rare; in more than this share of papers it is common.
RARE_BELOW, COMMON_ABOVE = 3, 0.2


def split_terms(value: Column) -> Column:
    """The names in a free-hand list: lower case, single spaces, no list marks, no closing stop."""
    items = F.split(F.lower(value), r"(?U)[,;|\n\r]|\band\b")
    item = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), r"^ ?(?:[-*+•·‣◦▪–—] ?|\(?[0-9]{1,2}[.)] )*", ""), r"[ .]+$", "")
    return F.filter(F.transform(items, item), lambda x: x != "")


def mentions(results: DataFrame) -> DataFrame:
    """(field, term, record) for every name in the lists of successful results."""
    good = results.where("status = 'success' and paper_id is not null")
    lists = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"response.{f}.value").alias("value")) for f in FIELDS]))
    return good.select(F.col("paper_id").alias("record"), lists.alias("l")).select(F.col("l.field").alias("field"), F.explode(split_terms(F.col("l.value"))).alias("term"), "record")


def run_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (field, term, record) batches -> (field, term, mentions, records) of every run."""
    last: tuple | None = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        changes = [np.asarray(pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)) for c in b.columns]
        new_term = np.concatenate([[True], changes[0] | changes[1]])
        new_record = np.concatenate([[True], changes[0] | changes[1] | changes[2]])
        new_record[0] = tuple(c[0].as_py() for c in b.columns) != last
        last = tuple(c[n - 1].as_py() for c in b.columns)
        starts = np.flatnonzero(new_term)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(starts)), b.column(1).take(pa.array(starts)), pa.array(np.diff(np.append(starts, n))), pa.array(np.add.reduceat(new_record.astype(np.int64), starts))],
            names=["field", "term", "mentions", "papers"],
        )


def count_terms(pairs: DataFrame) -> DataFrame:
    """(field, term, record) -> (field, term, mentions, papers)."""
    keys = ["field", "term", "record"]
    ranged = pairs.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    runs = ranged.mapInArrow(run_lengths, "field string, term string, mentions long, papers long")
    return runs.groupBy("field", "term").agg(F.sum("mentions").alias("mentions"), F.sum("papers").alias("papers"))


def term_table(results: DataFrame) -> DataFrame:
    """Every term with its counts, its share of the field's papers, and its mark or null."""
    pairs = mentions(results)
    with_value = pairs.select("field", "record").distinct().groupBy("field").agg(F.count("*").alias("field_papers"))
    mark = F.when(F.col("papers") < RARE_BELOW, "rare").when(F.col("papers") > COMMON_ABOVE * F.col("field_papers"), "common")
    return count_terms(pairs).join(F.broadcast(with_value), "field").withColumn("mark", mark)  # a row per field


def marked_terms(results: DataFrame) -> DataFrame:
    return term_table(results).where("mark is not null").select("field", "term", "mark")

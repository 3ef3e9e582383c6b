"""Distributed dense numbering and prefix sums over a range-sorted table.

Both take two passes: a range partitioning sorts the rows, every partition reports its total, and
the running offsets of the partitions (one number per partition, so their size is bounded by the
number of partitions and not by the data) are added to the running value inside the partition. No
window spans more than one partition of the sort, so neither a hot key nor the whole table ends in
a single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.session import cut

_PART, _RUN = "__part", "__run"


def _offsets(rows: list[tuple]) -> list[tuple]:
    """(group..., partition, total) -> (group..., partition, sum of the group's earlier partitions)."""
    run: dict = {}
    out = []
    for *group, part, n in sorted(rows, key=lambda r: r[-2]):
        before = run.get(tuple(group), 0)
        out.append((*group, part, before))
        run[tuple(group)] = before + n
    return out


def prefix_sums(df: DataFrame, order: list[str], size: str, out: str, group: str | None = None) -> DataFrame:
    """Add ``out``: the sum of ``size`` over the rows before this one, within ``group`` if given.

    ``order`` must be a total order of the rows inside a group (ties are broken arbitrarily but
    stably: the sorted rows are checkpointed before offsets are computed). Null sizes count as 0.
    ``group`` is expected to have few values per partition; its totals are collected as one row
    per (group value, partition).
    """
    keys = ([group] if group else []) + order
    schema = T.StructType([*df.schema.fields, T.StructField(_RUN, T.LongType()), T.StructField(_PART, T.IntegerType())])
    at_size, at_group = df.columns.index(size), df.columns.index(group) if group else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, run = object(), 0
        for b in batches:
            if not b.num_rows:
                continue
            sizes = pc.fill_null(b.column(at_size), 0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            g = [None] * len(sizes) if at_group is None else b.column(at_group).to_pylist()
            starts = [0] if at_group is None else [0, *(i for i in range(1, len(g)) if g[i] != g[i - 1])]
            before = np.zeros(len(sizes), dtype=np.int64)
            for s, e in zip(starts, [*starts[1:], len(g)]):
                if g[s] != last:
                    last, run = g[s], 0
                before[s:e] = run + np.cumsum(sizes[s:e]) - sizes[s:e]
                run += int(sizes[s:e].sum())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before), pa.array(np.full(len(sizes), part, dtype=np.int32))], names=schema.names)

    ranged = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(scan, schema))
    totals = ranged.groupBy(*([group] if group else []), _PART).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).cast("long").alias("n"))
    offsets = _offsets([tuple(r) for r in totals.collect()])  # a row per partition of the sort and group in it
    schema = T.StructType([*([df.schema[group]] if group else []), T.StructField(_PART, T.IntegerType()), T.StructField("__off", T.LongType())])
    add = ranged.sparkSession.createDataFrame(offsets, schema)
    on: Column = ranged[_PART] == add[_PART]
    if group:
        on = on & ranged[group].eqNullSafe(add[group])
    joined = ranged.join(F.broadcast(add), on)
    return joined.select(*[ranged[c] for c in df.columns], (ranged[_RUN] + add["__off"]).alias(out))


def dense_sequence(df: DataFrame, order: list[str], out: str = "seq") -> DataFrame:
    """Add ``out``: 0, 1, 2, ... in the order of ``order`` over the whole table."""
    one = "__one"
    return prefix_sums(df.withColumn(one, F.lit(1).cast("long")), order, one, out).drop(one)


def carry_forward(df: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the last ``value`` that is not null in an earlier row of the group.

    A group may span any number of partitions of the sort: each partition carries values along its
    own rows, and what it hands on to the next one is a single row a partition.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, df.schema[value].dataType), T.StructField(_PART, T.IntegerType())])
    at_group, at_value = df.columns.index(group), df.columns.index(value)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, now, last = TaskContext.get().partitionId(), None, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            groups, values = b.column(at_group).dictionary_encode().indices.to_numpy(), b.column(at_value)
            same = np.concatenate([[False], groups[1:] == groups[:-1]])
            first = np.maximum.accumulate(np.where(same, 0, np.arange(n)))  # where each row's group begins
            filled = np.maximum.accumulate(np.where(values.is_valid().to_numpy(zero_copy_only=False), np.arange(n), -1))
            back = np.concatenate([[-1], filled[:-1]])
            before = values.take(pa.array(back, pa.int64(), mask=back < first))
            last = last if b.column(at_group)[0] == now else None
            if last is not None:  # the group goes on from the batch before
                before = pc.if_else(pc.and_(pa.array(first == 0), before.is_null()), last, before)
            if filled[-1] >= first[-1]:
                last = values[int(filled[-1])]
            elif first[-1] > 0:
                last = None
            now = b.column(at_group)[n - 1]
            yield pa.RecordBatch.from_arrays([*b.columns, before, pa.array(np.full(n, part, dtype=np.int32))], names=schema.names)

    ranged = cut(df.where(F.col(group).isNotNull()).repartitionByRange(group, order).sortWithinPartitions(group, order).mapInArrow(scan, schema))
    ends = ranged.groupBy(_PART).agg(F.min(group).alias("first"), F.max(group).alias("final"))
    tails = ranged.join(F.broadcast(ends), _PART).where((F.col(group) == F.col("final")) & F.col(value).isNotNull()).groupBy(_PART).agg(F.max_by(value, order).alias("tail"))
    handed, carried = {}, []
    for r in sorted(ends.join(tails, _PART, "left").collect(), key=lambda r: r[_PART]):  # a row per partition
        carried.append((r[_PART], r.first, handed.get(r.first)))
        handed = {r.final: r.tail if r.tail is not None else handed.get(r.final) if r.first == r.final else None}
    add = ranged.sparkSession.createDataFrame([c for c in carried if c[2] is not None], T.StructType([T.StructField(_PART, T.IntegerType()), T.StructField("__first", df.schema[group].dataType), T.StructField("__carried", df.schema[value].dataType)]))
    joined = ranged.join(F.broadcast(add), (ranged[_PART] == add[_PART]) & (ranged[group] == add["__first"]), "left")
    return joined.select(*[ranged[c] for c in df.columns], F.coalesce(ranged[out], add["__carried"]).alias(out))

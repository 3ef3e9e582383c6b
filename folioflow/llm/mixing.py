"""Mixing the documents of several sources to target shares of all tokens.

Every document gets a random key by a hash of its id. Within each source the documents are sorted
by that key over as many partitions as they need, distributed prefix sums of their tokens say how
many come before each, and the source is cut where its budget ends. A budget beyond one epoch
repeats the whole source and cuts the last epoch.

Unless a total is given it is the largest one for which every source that has documents can meet
its share within its repeats; the shares of sources without documents are divided among the others
in proportion. With a given total a source that does not suffice gives all it may and is short.

A document is used when more than half of it lies before the cut, so a source misses its budget by
at most half a document. Documents without tokens, without a source or of a source without a target
are not used. Targets with no positive share or no repeats take nothing; repeated targets count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators.sequence import prefix_sums
from folioflow.session import cut

SEED = 17


def budgets(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, float]:
    """Tokens that each source has to give: (tokens there), (share, repeats) and perhaps a total."""
    usable = {s: (share, repeats) for s, (share, repeats) in targets.items() if share and share > 0 and repeats and repeats > 0 and available.get(s, 0) > 0}
    whole = sum(share for share, _ in usable.values())
    if not whole:
        return {}
    most = min(available[s] * repeats / (share / whole) for s, (share, repeats) in usable.items())
    total = most if total is None else total
    return {s: min(share / whole * total, available[s] * repeats) for s, (share, repeats) in usable.items()}


def _targets(mix_targets: DataFrame) -> dict[str, tuple[float, int]]:
    """One row a source; as many rows as the mixture has sources are read to the driver."""
    rows = mix_targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats"))
    return {r.source: (r.share or 0.0, r.repeats or 0) for r in rows.collect()}


def mixed(counted: DataFrame, mix_targets: DataFrame, total: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, tokens) -> (doc_id, source, tokens, times) of every document that is used."""
    spark, targets = counted.sparkSession, _targets(mix_targets)
    names = spark.createDataFrame([(s,) for s in targets], "source string")
    rows = cut(counted.where("tokens > 0").join(F.broadcast(names), "source").select("doc_id", "source", "tokens"))  # a row per target
    available = {r.source: r.n for r in rows.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    budget = budgets(available, targets, total)
    plan = [(s, int(b // available[s]), float(b - available[s] * (b // available[s]))) for s, b in budget.items()]
    cuts = spark.createDataFrame(plan, "source string, epochs int, rest double")
    keyed = rows.withColumn("key", F.xxhash64(F.lit(seed), F.col("doc_id")))
    summed = prefix_sums(keyed, ["key", "doc_id"], "tokens", "before", group="source")
    last = (F.col("before") + F.col("tokens") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    used = summed.join(F.broadcast(cuts), "source").withColumn("times", F.col("epochs") + F.when(last, 1).otherwise(0))
    return used.where("times > 0").select("doc_id", "source", "tokens", "times")


def repeated(used: DataFrame, seed: int = SEED) -> DataFrame:
    """A row for every use of a document, with the place in a random order of each epoch."""
    each = used.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.select("doc_id", "source", "tokens", "epoch", F.xxhash64(F.lit(seed), "epoch", "doc_id").alias("place"))


def shares(used: DataFrame, counted: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """Of each target the tokens there and used, the target share and the share reached."""
    t = mix_targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    there = counted.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    got = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("used_tokens"), F.max("times").alias("most_repeats"))
    one = t.join(there, "source", "left").join(got, "source", "left").na.fill(0)
    total = got.agg(F.sum("used_tokens")).first()[0] or 0
    return one.withColumn("actual_share", F.when(F.lit(total) > 0, F.col("used_tokens") / F.lit(total)).otherwise(0.0))

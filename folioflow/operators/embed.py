"""Embedding stage: units from extraction results, what is new, batches, storing, checking, summing up."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.contract import FIELDS
from folioflow.functions.text import blank_to_null, text_hash
from folioflow.operators.sequence import dense_sequence
from folioflow.session import cut

# Fixed values.
LABELS = {
    "title": "Title", "problem_gap": "Problem Gap", "claimed_contribution": "Claimed Contribution", "technical_approach": "Technical Approach", "datasets_benchmarks": "Datasets / Benchmarks",
    "contribution_type": "Contribution Type", "evaluation_summary": "Evaluation Summary", "reproducibility": "Reproducibility", "limitations_failures": "Limitations / Failures",
}
PAPER_FIELDS, MANDATORY = ("title", "problem_gap", "claimed_contribution", "technical_approach"), ("problem_gap", "claimed_contribution", "technical_approach")
VERSION, COLLECTIONS = "v1", {"paper": "paper_embeddings", "facet": "facet_embeddings"}

UNIT = ["embedding_id", "paper_id", "embedding_type", "text", "text_hash", "schema_version", "facet"]


def successes(results: DataFrame) -> DataFrame:
    return results.where("status = 'success'")


def latest_success(results: DataFrame) -> DataFrame:
    """One successful result a paper: the one completed last."""
    good = successes(results).where("paper_id is not null")
    return good.groupBy("paper_id").agg(F.max_by(F.struct("response", "metadata", "position"), F.struct("metadata.completed_at", "position")).alias("r")).select("paper_id", "r.*")


def resolve_title(results: DataFrame, titles: DataFrame) -> DataFrame:
    """Add ``title`` from a map (paper_id, title, ordinal); of several titles the last one that is not blank."""
    last = titles.withColumn("t", blank_to_null(F.col("title"))).where("t is not null").groupBy("paper_id").agg(F.max_by("t", "ordinal").alias("title"))
    return results.join(last, "paper_id", "left")


def facet_values(results: DataFrame) -> DataFrame:
    """(paper_id, facet, value) for each of the eight fields, blank values as null."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), blank_to_null(F.col(f"response.{f}.value")).alias("value")) for f in FIELDS]))
    return results.select("paper_id", each.alias("x")).select("paper_id", "x.facet", "x.value")


def semantic_text(values: dict[str, Column]) -> Column:
    """``Label:`` and value on the next line, blocks apart by a blank line, in the order given."""
    return F.concat_ws("\n\n", *[F.concat(F.lit(LABELS[k] + ":\n"), v) for k, v in values.items()])


def _unit(df: DataFrame, kind: str, name: Column, text: Column, facet: Column) -> DataFrame:
    return df.select(F.concat_ws("::", "paper_id", name, F.lit(VERSION)).alias("embedding_id"), "paper_id", F.lit(kind).alias("embedding_type"), text.alias("text"), text_hash(text).alias("text_hash"), F.lit(VERSION).alias("schema_version"), facet.alias("facet"))


def paper_units(titled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units, failures (paper_id, error)): a paper needs its title and the three mandatory fields."""
    values = {"title": blank_to_null(F.col("title"))} | {f: blank_to_null(F.col(f"response.{f}.value")) for f in PAPER_FIELDS[1:]}
    flat = titled.select("paper_id", *[v.alias(k) for k, v in values.items()])
    missing = F.array_compact(F.array(*[F.when(F.col(k).isNull(), k) for k in PAPER_FIELDS]))
    judged = flat.withColumn("missing", missing)
    units = _unit(judged.where(F.size("missing") == 0), "paper", F.lit("paper"), semantic_text({k: F.col(k) for k in PAPER_FIELDS}), F.lit(None).cast("string"))
    return units, judged.where(F.size("missing") > 0).select("paper_id", F.concat(F.lit("missing required fields: "), F.array_join("missing", ", ")).alias("error"))


def facet_status(values: DataFrame) -> DataFrame:
    """Add ``status``: ``unit``, or for empty values ``failed`` (mandatory) or ``skipped_empty``."""
    return values.withColumn("status", F.when(F.col("value").isNotNull(), "unit").when(F.col("facet").isin(*MANDATORY), "failed").otherwise("skipped_empty"))


def facet_units(values: DataFrame) -> DataFrame:
    label = F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("facet"))
    return _unit(values.where("value is not null"), "facet", F.col("facet"), F.concat(label, F.lit(":\n"), F.col("value")), F.col("facet"))


def duplicate_ids(units: DataFrame, most: int = 10) -> DataFrame:
    """One row: how many ids occur more than once, and the first of them."""
    twice = units.groupBy("embedding_id").agg(F.count("*").alias("n")).where("n > 1")
    first = twice.orderBy("embedding_id").limit(most).agg(F.array_join(F.array_sort(F.collect_list("embedding_id")), "|").alias("first_ids"))
    return twice.agg(F.count("*").alias("duplicates")).join(first)


def plan(units: DataFrame, stored: DataFrame, model: str) -> DataFrame:
    """Add ``action``: ``skipped_existing`` if the store holds the unit's hash under this model, else ``pending``.

    ``stored`` has (id, text_hash, embedding_model); vectors stay out of the join.
    """
    there = stored.select(F.col("id").alias("embedding_id"), F.col("text_hash").alias("__hash"), F.col("embedding_model").alias("__model"))
    same = F.col("__hash").eqNullSafe(F.col("text_hash")) & F.col("__model").eqNullSafe(F.lit(model)) & F.col("__hash").isNotNull()
    return units.join(there, "embedding_id", "left").withColumn("action", F.when(same, "skipped_existing").otherwise("pending")).drop("__hash", "__model")


def batches(units: DataFrame, order: list[str], size: int) -> DataFrame:
    """Add ``ordinal`` (0, 1, ...) and ``batch``: consecutive units in the given order."""
    return dense_sequence(units, order, "ordinal").withColumn("batch", F.floor(F.col("ordinal") / size).cast("long"))


EMBEDDED = "embedding_id string, batch long, status string, error string, embedding array<float>"


def embed(batched: DataFrame, make_client: Callable[[], Callable[[list[str]], list[list[float]]]]) -> DataFrame:
    """Embed each batch with one call; a batch fails as a whole: an error, a wrong count, empty or unequal vectors.

    ``make_client`` runs once a partition. A lost task calls again.
    """

    def one(client: Callable[[list[str]], list[list[float]]], df: pd.DataFrame) -> pd.DataFrame:
        try:
            got = client(df.text.tolist())
            sizes = {len(v) for v in got}
            if len(got) != len(df):
                raise ValueError(f"{len(got)} vectors for {len(df)} texts")
            if 0 in sizes or len(sizes) > 1:
                raise ValueError("empty vectors or vectors of different length")
            out = df.assign(status="success", error=None, embedding=[np.asarray(v, dtype=np.float32) for v in got])
        except Exception as e:  # noqa: BLE001 - becomes the batch's failure
            out = df.assign(status="failed", error=f"{type(e).__name__}: {e}", embedding=None)
        return out[["embedding_id", "batch", "status", "error", "embedding"]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by batch; the last batch of a frame may go on in the next one."""
        client, held = make_client(), None
        for df in frames:
            df = df if held is None else pd.concat([held, df])
            last = df.batch == df.batch.iloc[-1] if len(df) else []
            for _, part in df[~last].groupby("batch", sort=False) if len(df) else ():
                yield one(client, part)
            held = df[last] if len(df) else None
        if held is not None and len(held):
            yield one(client, held)

    rows = batched.select("embedding_id", "batch", "ordinal", "text").repartition("batch").sortWithinPartitions("batch", "ordinal")
    return rows.mapInPandas(run, EMBEDDED)


def store_metadata(model: str, run_id: str) -> Column:
    """The metadata that the store keeps beside a unit's vector; an empty facet is none."""
    return F.struct("paper_id", "embedding_type", "schema_version", F.lit(model).alias("embedding_model"), "text_hash", F.lit(run_id).alias("run_id"), F.nullif("facet", F.lit("")).alias("facet"))


def embed_and_store(units: DataFrame, store: DataFrame, make_client: Callable[[], Callable[[list[str]], list[list[float]]]], run_id: str, model: str, size: int = 96) -> tuple[DataFrame, DataFrame]:
    """(the store's next snapshot, the manifest lines of the run).

    Units that the store holds are skipped; the others are embedded in batches in the order of their
    ids, papers before facets, and go into the store if their batch succeeds. Vectors are computed
    once: both results read them from a table.
    """
    todo = plan(units, store.select("id", "metadata.text_hash", "metadata.embedding_model").distinct(), model)
    pending = todo.where("action = 'pending'").drop("action").withColumn("__facet", F.col("embedding_type") != "paper")
    done = cut(embed(batches(pending, ["__facet", "embedding_id"], size), make_client))
    embedded = pending.drop("__facet").join(done.select("embedding_id", "status", "error", "embedding"), "embedding_id")
    new = embedded.where("status = 'success'").select(F.col("embedding_id").alias("id"), "embedding", F.col("text").alias("document"), store_metadata(model, run_id).alias("metadata"))
    lines = manifest(embedded, F.col("status"), run_id, model, F.col("error")).unionByName(manifest(todo.where("action <> 'pending'"), F.lit("skipped_existing"), run_id, model))
    return upsert(store.select("id", "embedding", "document", "metadata"), new), lines


def hash_client(dims: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """A stand-in for an embedding service: unit vectors from a hash of the text, the same everywhere."""
    import hashlib

    def call(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            raw = np.frombuffer(hashlib.shake_256(t.encode()).digest(2 * dims), dtype=np.int16).astype(np.float64)
            out.append((raw / np.linalg.norm(raw)).tolist())
        return out

    return call


def manifest(units: DataFrame, status: Column, run_id: str, model: str, error: Column | None = None) -> DataFrame:
    collection = F.when(F.col("embedding_type") == "paper", COLLECTIONS["paper"]).otherwise(COLLECTIONS["facet"])
    return units.select(F.lit(run_id).alias("run_id"), "embedding_id", "paper_id", "embedding_type", "schema_version", F.lit(model).alias("model"), "text_hash", status.alias("status"), collection.alias("chroma_collection"), "facet", (error if error is not None else F.lit(None).cast("string")).alias("error"))


def upsert(store: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Insert or replace rows by key; the result is a new snapshot (see ``write_snapshot``)."""
    return store.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def write_snapshot(df: DataFrame, folder: str, name: str) -> str:
    """A snapshot never overwrites what is being read; readers follow ``current`` to the newest name."""
    path = os.path.join(folder, name)
    df.write.parquet(path)
    return path


def verify(units: DataFrame, store: DataFrame, model: str) -> DataFrame:
    """(embedding_id, error) for everything in the store that is not as the units say.

    The expected dimension is that of the first unit whose vector is there, papers before facets, then by
    ``ordinal``. Of differing rows under one id the one of the greatest run_id counts.
    """
    version = F.struct(F.coalesce("metadata.run_id", F.lit("")).alias("run_id"), F.xxhash64("document", "embedding").alias("h"))
    s = store.select(F.col("id").alias("embedding_id"), version.alias("v"), F.struct("document", F.size("embedding").alias("dims"), "metadata").alias("s")).groupBy("embedding_id").agg(F.max_by("s", "v").alias("s"))
    both = units.join(s, "embedding_id", "left")
    first = both.where("s.dims > 0").agg(F.min_by("s.dims", F.struct(F.col("embedding_type") != "paper", "ordinal")).alias("expected")).first()
    expected = first.expected if first else None
    m = F.col("s.metadata")
    rule = lambda broken, text: F.when(broken, text)
    checks = [
        rule(~F.col("s.document").eqNullSafe(F.col("text")), "stored document differs"), rule(~m["text_hash"].eqNullSafe(F.col("text_hash")), "text_hash mismatch"),
        rule(~m["embedding_model"].eqNullSafe(F.lit(model)), "embedding model mismatch"), rule(~m["schema_version"].eqNullSafe(F.col("schema_version")), "schema version mismatch"),
        rule(~m["paper_id"].eqNullSafe(F.col("paper_id")), "paper_id mismatch"), rule(~m["embedding_type"].eqNullSafe(F.col("embedding_type")), "embedding type mismatch"),
        rule(F.col("facet").isNotNull() & ~m["facet"].eqNullSafe(F.col("facet")), "facet mismatch"), rule(F.coalesce("s.dims", F.lit(0)) <= 0, "embedding vector is empty"),
        rule((F.col("s.dims") > 0) & (F.col("s.dims") != F.lit(expected)), F.concat(F.lit("embedding dimension "), F.col("s.dims").cast("string"), F.lit(f" != expected {expected}"))),
    ]
    errors = F.when(F.col("s").isNull(), F.array(F.lit("missing from the store"))).otherwise(F.array_compact(F.array(*checks)))
    return both.select("embedding_id", F.explode(errors).alias("error"))


def summary(lines: DataFrame) -> DataFrame:
    """Counts of manifest lines by run, type and status."""
    statuses = ("success", "skipped_existing", "skipped_empty", "failed")
    counts = [F.count_if(F.col("status") == s).alias(s) for s in statuses]
    return lines.groupBy("run_id", "embedding_type").agg(*counts, F.count("*").alias("total"))


def run_totals(lines: DataFrame, verification: DataFrame | None = None) -> DataFrame:
    """One row a run: counts of papers and facets, units created, all failures, and the exit code.

    ``verification`` has (run_id, verification_errors). A run fails, exit code 1, if a unit failed or a
    check found an error. Empty and failed units are not created ones.
    """
    is_ = lambda kind, status: (F.col("embedding_type") == kind) & (F.col("status") == status)
    names = {("paper", "success"): "paper_success", ("paper", "skipped_existing"): "paper_skipped", ("paper", "failed"): "paper_failed", ("facet", "success"): "facet_success", ("facet", "skipped_existing"): "facet_skipped", ("facet", "skipped_empty"): "facet_empty", ("facet", "failed"): "facet_failed"}
    one = lines.groupBy("run_id").agg(*[F.count_if(is_(*k)).alias(v) for k, v in names.items()], F.max("model").alias("embedding_model"), F.count_distinct("paper_id").alias("papers"))
    one = one.join(verification, "run_id", "left") if verification is not None else one.withColumn("verification_errors", F.lit(0).cast("long"))
    one = one.withColumn("verification_errors", F.coalesce("verification_errors", F.lit(0))).withColumn("total_failures", F.col("paper_failed") + F.col("facet_failed"))
    made = F.col("paper_success") + F.col("paper_skipped") + F.col("facet_success") + F.col("facet_skipped")
    return one.withColumn("units_created", made).withColumn("exit_code", ((F.col("total_failures") > 0) | (F.col("verification_errors") > 0)).cast("int"))

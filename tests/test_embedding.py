import pytest
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.operators import embed as E

UNIT = "embedding_id string, paper_id string, embedding_type string, text string, text_hash string, schema_version string, facet string, ordinal long"


def units(spark, n=4):
    rows = [(f"p{i}::problem_gap::v1", f"p{i}", "facet", f"Problem Gap:\nt{i}", None, "v1", "problem_gap", i) for i in range(n)]
    return spark.createDataFrame(rows, UNIT).withColumn("text_hash", F.sha2("text", 256))


def stored(u, dims=64, model="m"):
    meta = F.struct("paper_id", "embedding_type", "schema_version", F.lit(model).alias("embedding_model"), "text_hash", F.lit("r").alias("run_id"), "facet")
    return u.select(F.col("embedding_id").alias("id"), F.array_repeat(F.lit(0.5).cast("float"), dims).alias("embedding"), F.col("text").alias("document"), meta.alias("metadata"))


def results(spark, **values):
    item = lambda v: (v, [], 0.5)
    from folioflow.functions.contract import FIELDS

    row = ("p", 1, "success", tuple(item(values.get(f, "v")) for f in FIELDS), None, None, None, None)
    return spark.createDataFrame([row], schemas.RESULT)


def test_units_and_statuses(spark):
    r = results(spark, problem_gap=" ", limitations_failures=None, reproducibility=" kept ")
    status = {x.facet: x.status for x in E.facet_status(E.facet_values(r)).collect()}
    assert status["problem_gap"] == "failed" and status["limitations_failures"] == "skipped_empty" and status["claimed_contribution"] == "unit"
    texts = {x.facet: x.text for x in E.facet_units(E.facet_values(r)).collect()}
    assert texts["reproducibility"] == "Reproducibility:\nkept" and len(texts) == 6
    made, failed = E.paper_units(r.withColumn("title", F.lit("T")))
    assert made.count() == 0 and failed.first().error == "missing required fields: problem_gap"
    made, failed = E.paper_units(results(spark).withColumn("title", F.lit(" T ")))
    one = made.first()
    assert one.embedding_id == "p::paper::v1" and one.text == "Title:\nT\n\nProblem Gap:\nv\n\nClaimed Contribution:\nv\n\nTechnical Approach:\nv" and failed.count() == 0


def test_plan_twice_leaves_nothing(spark):
    u = units(spark)
    s = stored(u.limit(2)).select("id", "metadata.text_hash", "metadata.embedding_model")
    first = E.plan(u, s, "m")
    assert first.where("action = 'pending'").count() == 2
    assert E.plan(u, stored(u).select("id", "metadata.text_hash", "metadata.embedding_model"), "m").where("action = 'pending'").count() == 0
    assert E.plan(u, stored(u).select("id", "metadata.text_hash", "metadata.embedding_model"), "other").where("action = 'pending'").count() == 4


def test_batches_are_consecutive(spark):
    b = E.batches(units(spark, 10).drop("ordinal"), ["embedding_id"], 4).orderBy("ordinal").collect()
    assert [x.batch for x in b] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


@pytest.mark.parametrize("bad, message", [(lambda t: [[1.0]] * (len(t) - 1), "vectors for"), (lambda t: [[1.0] * (i + 1) for i in range(len(t))], "different length"), (lambda t: [[] for _ in t], "empty vectors"), (lambda t: 1 / 0, "ZeroDivisionError")])
def test_a_batch_fails_as_a_whole(spark, bad, message):
    def make():
        good = E.hash_client(8)
        return lambda texts: bad(texts) if any("t5" in t for t in texts) else good(texts)

    out = E.embed(E.batches(units(spark, 9).drop("ordinal"), ["embedding_id"], 3), make).collect()
    assert {r.batch for r in out if r.status == "failed"} == {1} and all(message in r.error for r in out if r.status == "failed")
    assert all(len(r.embedding) == 8 for r in out if r.status == "success") and len(out) == 9


CHANGES = {
    "stored document differs": lambda s: s.withColumn("document", F.lit("x")), "text_hash mismatch": lambda s: s.withColumn("metadata", F.col("metadata").withField("text_hash", F.lit("x"))),
    "embedding model mismatch": lambda s: s.withColumn("metadata", F.col("metadata").withField("embedding_model", F.lit("x"))), "schema version mismatch": lambda s: s.withColumn("metadata", F.col("metadata").withField("schema_version", F.lit(None).cast("string"))),
    "paper_id mismatch": lambda s: s.withColumn("metadata", F.col("metadata").withField("paper_id", F.lit("x"))), "embedding type mismatch": lambda s: s.withColumn("metadata", F.col("metadata").withField("embedding_type", F.lit("x"))),
    "facet mismatch": lambda s: s.withColumn("metadata", F.col("metadata").withField("facet", F.lit("x"))), "embedding vector is empty": lambda s: s.withColumn("embedding", F.array().cast("array<float>")),
    "embedding dimension 3 != expected 64": lambda s: s.withColumn("embedding", F.slice("embedding", 1, 3)), "missing from the store": lambda s: s.limit(0),
}


@pytest.mark.parametrize("message", CHANGES)
def test_each_corruption_gives_one_error(spark, message):
    u = units(spark)
    s = stored(u)
    hit = F.col("id") == "p2::problem_gap::v1"
    broken = s.where(~hit).unionByName(CHANGES[message](s.where(hit)))
    assert [(r.embedding_id, r.error) for r in E.verify(u, broken, "m").collect()] == [("p2::problem_gap::v1", message)]


def test_verify_is_silent_on_a_sound_store(spark):
    u = units(spark)
    assert E.verify(u, stored(u), "m").count() == 0
    assert E.verify(u.limit(0), stored(u), "m").count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    got = {r.id: r.v for r in E.upsert(old, spark.createDataFrame([("b", 2), ("c", 2)], old.schema)).collect()}
    assert got == {"a": 1, "b": 2, "c": 2}


def test_duplicates_and_titles(spark):
    d = E.duplicate_ids(spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",)], "embedding_id string")).first()
    assert (d.duplicates, d.first_ids) == (2, "a|b")
    t = spark.createDataFrame([("p", "old", 1), ("p", "new", 2), ("p", " ", 3)], "paper_id string, title string, ordinal int")
    assert E.resolve_title(results(spark), t).first().title == "new"


def test_summary(spark):
    m = spark.createDataFrame([("r", "paper", "success"), ("r", "paper", "failed"), ("r", "facet", "skipped_empty")], "run_id string, embedding_type string, status string")
    assert {(r.embedding_type, r.success, r.failed, r.skipped_empty, r.total) for r in E.summary(m).collect()} == {("paper", 1, 1, 0, 2), ("facet", 0, 0, 1, 1)}

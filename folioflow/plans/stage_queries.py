"""Queries of the landing-page, extraction and embedding operators over the project's tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import contract, html, text
from folioflow.operators import embed, ingest, jobs
from folioflow.operators.pages import one_per_page
from folioflow.plans import page_queries
from folioflow.sources import files
from folioflow.session import checkpoint_dir, cut, remove, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
MODEL = "vekto-embed-2"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# Landing pages, built from the papers: the tables hold none.


def _html(spark: SparkSession, d: str, named: bool = True) -> DataFrame:
    """(paper_id, paper_url, pdf_url, html): the paper's first listing as a landing page, with or without the tag of its title."""
    p = table(spark, d, "papers").where("paper_id is not null").groupBy("paper_id").agg(F.min_by(F.struct("title", "authors", "venue", "paper_url", "pdf_url"), "seen_at").alias("p")).select("paper_id", "p.*")
    safe = lambda c: F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), '"', "&quot;")
    tagged = F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.concat(F.lit('<meta name="citation_author" content="'), safe(a), F.lit('">'))), "")
    page = F.concat(
        F.lit("<html><head><title>Papers</title>"), F.concat(F.lit('<meta name="citation_title" content="'), safe(F.col("title")), F.lit('">')) if named else F.lit(""), tagged,
        F.coalesce(F.concat(F.lit('<meta name="citation_journal_title" content="'), safe(F.col("venue")), F.lit('">')), F.lit("")), F.lit("</head><body><h1>Site</h1><h2> "), safe(F.col("title")),
        F.lit('</h2><a href="/checklist.pdf">c</a><a href="files/'), F.col("paper_id"), F.lit('.pdf">pdf</a></body></html>'),
    )
    return p.select("paper_id", "paper_url", "pdf_url", page.alias("html"))


def _landing(spark: SparkSession, d: str, named: bool = True) -> DataFrame:
    return _html(spark, d, named).select("paper_id", "paper_url", html.landing_metadata("html", "paper_url", "paper_id").alias("m"))


_FIRST = "p AS (SELECT * FROM papers WHERE paper_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY seen_at) = 1)"


@query(rf"WITH {_FIRST} SELECT paper_id, regexp_replace(title, '^[{text.SPACES}]+|[{text.SPACES}]+$', '', 'g') AS title, array_to_string(list_filter(list_transform(authors, lambda a: regexp_replace(a, '^[{text.SPACES}]+|[{text.SPACES}]+$', '', 'g')), lambda a: a <> ''), '|') AS authors, venue FROM p")
def html_meta(spark: SparkSession, d: str) -> DataFrame:
    return _landing(spark, d).select("paper_id", F.col("m.title").alias("title"), F.array_join("m.authors", "|").alias("authors"), F.col("m.venue").alias("venue"))


@query(rf"WITH {_FIRST} SELECT paper_id, regexp_replace(title, '^[{text.SPACES}]+|[{text.SPACES}]+$', '', 'g') AS title FROM p")
def page_title(spark: SparkSession, d: str) -> DataFrame:
    """Titles of pages without a citation tag: the first heading."""
    return _landing(spark, d, named=False).select("paper_id", F.col("m.title").alias("title"))


@query(f"WITH {_FIRST} SELECT paper_id, paper_url || 'files/' || paper_id || '.pdf' AS pdf_url FROM p")
def pdf_link(spark: SparkSession, d: str) -> DataFrame:
    return _landing(spark, d).select("paper_id", F.col("m.pdf_url").alias("pdf_url"))


_EDGES = rf"'^[{text.SPACES}]+|[{text.SPACES}]+$', '', 'g'"


@query(f"WITH {_FIRST} SELECT paper_id, regexp_replace(title, {_EDGES}) AS title, array_to_string(list_filter(list_transform(authors, lambda a: regexp_replace(a, {_EDGES})), lambda a: a <> ''), '|') AS authors, paper_url || 'files/' || paper_id || '.pdf' AS pdf_url, venue, NULL::VARCHAR AS published, NULL::VARCHAR AS error FROM p")
def landing_metadata(spark: SparkSession, d: str) -> DataFrame:
    return _landing(spark, d).select("paper_id", "m.*").withColumn("authors", F.array_join("authors", "|"))


# Whole papers: a plain "PDF" of the raw texts of a paper's pages, for papers with a pdf_url.

_SOURCE = f"""{_FIRST}, src AS (SELECT DISTINCT paper_id, page_number, replace(coalesce(raw_text, ''), chr(12), ' ') AS t FROM page_content WHERE paper_id IS NOT NULL AND page_number IS NOT NULL),
pdf AS (SELECT p.paper_id, '%PDF-' || chr(10) || coalesce(string_agg(t, chr(12) ORDER BY page_number), '') AS content FROM p LEFT JOIN src USING (paper_id) WHERE pdf_url IS NOT NULL GROUP BY 1),
state AS (SELECT p.paper_id, CASE WHEN coalesce(paper_url, '') = '' THEN 'missing page_url' WHEN content IS NULL THEN 'pdf missing' WHEN strlen(content) < 1024 THEN 'pdf too small' WHEN contains(content, '/Encrypt') THEN 'pdf encrypted' END AS error FROM p LEFT JOIN pdf USING (paper_id))"""
_READ = f"""pg AS (SELECT paper_id, page_number, raw_text, {page_queries._CLEAN('raw_text')} AS clean_text FROM (SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY page_number) AS INTEGER) AS page_number,
  array_to_string(list_filter(list_transform(string_split(t, chr(10) || chr(10)), lambda x: regexp_replace(x, {_EDGES})), lambda x: x <> ''), chr(10) || chr(10)) AS raw_text FROM src JOIN state USING (paper_id) WHERE error IS NULL))"""


def _ingested(spark: SparkSession, d: str) -> ingest.Ingested:
    pages = table(spark, d, "page_content").where("paper_id is not null and page_number is not null").select("paper_id", "page_number", F.translate(F.coalesce("raw_text", F.lit("")), "\f", " ").alias("t")).distinct()
    body = pages.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "t"))), lambda x: x.t), "\f").alias("body"))
    landing = _html(spark, d)
    pdfs = landing.where("pdf_url is not null").join(body, "paper_id", "left").select("paper_id", F.encode(F.concat(F.lit("%PDF-\n"), F.coalesce("body", F.lit(""))), "UTF-8").alias("content"))
    return ingest.ingest(landing.select("paper_id", F.col("paper_url").alias("page_url")), landing, pdfs, ingest.PlainReader)


@query(f"WITH {_SOURCE} SELECT CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, error, count(*) AS papers FROM state GROUP BY 1, 2")
def ingest_status(spark: SparkSession, d: str) -> DataFrame:
    return ingest.status_counts(_ingested(spark, d).papers)


@query(page_queries.ORACLE["repeated_noise"].replace(page_queries._PG, f"{_SOURCE}, {_READ}"))
def ingest_pages(spark: SparkSession, d: str) -> DataFrame:
    """The text of all pages after every step of the pipeline."""
    return _ingested(spark, d).pages.select("paper_id", "page_number", "clean_text")


@query(f"""WITH {_SOURCE}, {_READ} SELECT paper_id, title, CAST(n AS INTEGER) AS page_count, 'ok' AS status FROM (SELECT paper_id, regexp_replace(title, {_EDGES}) AS title FROM p) JOIN (SELECT paper_id, count(*) AS n FROM pg GROUP BY 1) USING (paper_id)""")
def ingest_papers(spark: SparkSession, d: str) -> DataFrame:
    """The papers that come out, by their contexts."""
    whole = _ingested(spark, d)
    return whole.papers.join(whole.contexts.select("paper_id"), "paper_id").select("paper_id", "title", "page_count", "status")


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def file_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", files.file_hash(F.encode("text", "UTF-8")).alias("sha256"))


@query("SELECT doc_id, CASE WHEN text IS NULL THEN 'missing' WHEN strlen(CASE WHEN doc_id % 3 = 0 THEN '%PDF-' ELSE '' END || text) < 1024 THEN 'too small' WHEN doc_id % 3 <> 0 THEN 'not a PDF' END AS error FROM documents")
def pdf_validate(spark: SparkSession, d: str) -> DataFrame:
    content = F.encode(F.concat(F.when(F.col("doc_id") % 3 == 0, "%PDF-").otherwise(""), F.col("text")), "UTF-8")
    return table(spark, d, "documents").select("doc_id", files.pdf_check(content).alias("error"))


# Extraction.


def _files(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "jobs").where("paper_id is not null and context_path is not null")
    each = j.select(F.explode(F.concat(F.array("context_path"), F.coalesce("image_paths", F.array().cast("array<string>")))).alias("path"))
    return each.distinct()


_SORTED = "(SELECT array_to_string(list_concat(CASE WHEN regexp_matches(x, '^[0-9]') THEN [''] ELSE [] END, list_transform(regexp_extract_all(x, '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN lpad(p, 20, '0') ELSE lower(p) END)), chr(1)))"


@query(f"WITH j AS (SELECT DISTINCT paper_id, context_path FROM jobs WHERE paper_id IS NOT NULL AND context_path IS NOT NULL) SELECT paper_id, context_path, CAST(row_number() OVER (ORDER BY {_SORTED.replace('(x', '(paper_id')}, paper_id) AS INTEGER) AS position FROM j")
def discover_jobs(spark: SparkSession, d: str) -> DataFrame:
    return jobs.discover_jobs(_files(spark, d)).select("paper_id", "context_path", "position")


@query("WITH i AS (SELECT DISTINCT paper_id, unnest(image_paths) AS path FROM jobs WHERE paper_id IS NOT NULL AND context_path IS NOT NULL) SELECT paper_id, string_agg(path, '|' ORDER BY path) AS images FROM i GROUP BY 1")
def list_images(spark: SparkSession, d: str) -> DataFrame:
    return jobs.list_images(_files(spark, d)).select("paper_id", F.array_join("image_paths", "|").alias("images"))


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jobs").where("paper_id is not null").dropDuplicates(["paper_id"])


_J = "j AS (SELECT * FROM jobs WHERE paper_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY paper_id) = 1)"
_DONE = "done AS (SELECT DISTINCT paper_id FROM results WHERE status = 'success' AND paper_id IS NOT NULL)"


@query(f"WITH {_J} SELECT position, paper_id FROM j WHERE position BETWEEN 5 AND 200")
def limit_range(spark: SparkSession, d: str) -> DataFrame:
    return jobs.in_range(_jobs(spark, d), " 5 - 200").select("position", "paper_id")


@query(f"""WITH {_J}, w AS (SELECT paper_id, 0 AS nth, 'context' AS what, context_path AS path FROM j UNION ALL SELECT paper_id, unnest(range(1, len(image_paths) + 1)), 'image', unnest(image_paths) FROM j),
m AS (SELECT paper_id, nth, CASE WHEN length(path) % 5 = 0 THEN 'missing ' WHEN length(path) % 7 = 0 THEN 'empty ' END || what || ': ' || path AS message FROM w)
SELECT paper_id, string_agg(message, '|' ORDER BY nth) AS errors FROM m WHERE message IS NOT NULL GROUP BY 1""")
def preflight(spark: SparkSession, d: str) -> DataFrame:
    sizes = _files(spark, d).where(F.length("path") % 5 != 0).withColumn("length", F.when(F.length("path") % 7 == 0, 0).otherwise(100))
    return jobs.preflight(_jobs(spark, d), sizes).select("paper_id", F.array_join("errors", "|").alias("errors"))


@query(f"WITH {_J}, {_DONE} SELECT position, paper_id FROM j WHERE paper_id NOT IN (SELECT paper_id FROM done)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    return jobs.resume(_jobs(spark, d), table(spark, d, "results")).select("position", "paper_id")


@query(f"WITH {_DONE} SELECT paper_id FROM done")
def completed_ids(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "results").select(F.to_json(F.struct("paper_id", "position", "status")).alias("value"))
    broken = spark.createDataFrame([("{broken",), ("  ",), ("[1]",)], "value string")
    return jobs.completed(files.result_lines(lines.unionByName(broken)))


@query("SELECT paper_id, status, count(*) AS lines FROM results WHERE paper_id IS NOT NULL GROUP BY 1, 2")
def scan_results_strict(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "results").where("paper_id is not null").select(F.to_json(F.struct("paper_id", "position", "status")).alias("value"))
    return files.result_lines(lines, strict=True).groupBy("paper_id", "status").agg(F.count("*").alias("lines"))


@query(f"WITH {_DONE} SELECT count(*) AS completed FROM done")
def success_count(spark: SparkSession, d: str) -> DataFrame:
    return jobs.completed(table(spark, d, "results")).agg(F.count("*").alias("completed"))


@query(f"WITH {_J}, {_DONE} SELECT position, paper_id, paper_id IN (SELECT paper_id FROM done) AS completed FROM j")
def dry_run(spark: SparkSession, d: str) -> DataFrame:
    return jobs.dry_run(_jobs(spark, d), table(spark, d, "results"))


_MARKS = " OR ".join(f"contains(n, '{m}') OR contains(t, '{m}')" for m in jobs.TRANSIENT)


@query(f"""WITH f AS (SELECT *, TRY_CAST(nullif(regexp_extract(coalesce(error, ''), '(?:^|[^0-9])([45][0-9][0-9])(?:[^0-9]|$)', 1), '') AS INTEGER) AS code, lower(coalesce(error_type, '')) AS n, lower(coalesce(error, '')) AS t FROM results WHERE status = 'failed'),
c AS (SELECT *, {_MARKS} OR error_type IN ('TimeoutError', 'ConnectionError', 'ConnectionResetError', 'ConnectionAbortedError', 'ConnectionRefusedError', 'BrokenPipeError') AS marked, contains(t, '429') OR contains(t, 'too many requests') OR contains(t, 'throttl') AS slow FROM f),
k AS (SELECT error_type, error, CASE WHEN code = 429 OR code IN (408, 409, 425) OR code BETWEEN 500 AND 599 THEN true ELSE coalesce(marked, false) END AS retryable, CASE WHEN code = 429 THEN true WHEN code IN (408, 409, 425) OR code BETWEEN 500 AND 599 THEN false ELSE coalesce(marked AND slow, false) END AS throttled FROM c)
SELECT error_type, error, retryable, throttled, count(*) AS failures FROM k GROUP BY ALL""")
def classify_error(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "results").where("status = 'failed'")
    code = F.nullif(F.regexp_extract(F.coalesce("error", F.lit("")), r"(?:^|[^0-9])([45][0-9][0-9])(?:[^0-9]|$)", 1), F.lit("")).cast("int")
    return failed.select("error_type", "error", jobs.classify_error(code, F.col("error_type"), F.col("error")).alias("k")).groupBy("error_type", "error", F.col("k.retryable").alias("retryable"), F.col("k.throttled").alias("throttled")).agg(F.count("*").alias("failures"))


@query("""WITH RECURSIVE o AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, event_type <> 'error' AS ok, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 1 ELSE 0 END AS thr FROM events),
f AS (SELECT user_id, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS event_id, 8 AS cur, 0 AS clean FROM (SELECT DISTINCT user_id FROM o)
UNION ALL SELECT f.user_id, o.n, o.event_id,
  CASE WHEN thr > 0 THEN greatest(2, CAST(floor(greatest(2.0::DOUBLE, cur * 0.7::DOUBLE)) AS INTEGER)) WHEN ok AND clean + 1 >= 8 THEN least(24, cur + 1) ELSE cur END,
  CASE WHEN thr > 0 OR NOT ok OR clean + 1 >= 8 THEN 0 ELSE clean + 1 END FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1)
SELECT user_id AS run, event_id, cur AS current FROM f WHERE n > 0""")
def aimd_trace(spark: SparkSession, d: str) -> DataFrame:
    bad = F.col("event_type") == "error"
    return jobs.aimd(table(spark, d, "events").select(F.col("user_id").alias("run"), "event_id", (~bad).alias("success"), F.when(bad & (F.col("event_id") % 2 == 0), 1).otherwise(0).alias("throttles")), "run", "event_id")


def _replies(spark: SparkSession, d: str) -> DataFrame:
    """Successful replies as text, some broken by rule."""
    good = embed.latest_success(table(spark, d, "results"))
    raw = F.to_json("response", {"ignoreNullFields": "false"})
    n = F.length("paper_id") + F.col("position")
    broken = F.when(n % 11 == 0, F.concat(raw, F.lit(" x"))).when(n % 11 == 1, F.regexp_replace(raw, '"reproducibility"', '"repro"')).when(n % 11 == 2, F.regexp_replace(raw, r'^\{"problem_gap":\{"value":"(?:[^"\\]|\\.)*"', '{"problem_gap":{"value":" "')).otherwise(raw)
    return good.select("paper_id", (n % 11).alias("kind"), broken.alias("raw"))


@query()
def contract_validate(spark: SparkSession, d: str) -> DataFrame:
    return _replies(spark, d).select("paper_id", "kind", contract.contract_error("raw").alias("error"))


def _breach() -> str:
    """The first breach of the contract in the successful results, field by field, as the contract says it."""
    cases = []
    for f in contract.FIELDS:
        x = f"response.{f}"
        blank = f"regexp_replace({x}.value, '[{text.SPACES}]', '', 'g') = ''"
        cases += [f"WHEN {x} IS NULL THEN '{f} must be an object'", (f"WHEN {'(k = 2 OR ' if f == 'problem_gap' else '('}{blank}) AND {x}.value IS NOT NULL THEN '{f}.value must be null or a non-empty string'")]
        cases += [f"WHEN {x}.source_span IS NULL THEN '{f}.source_span must be a list'", f"WHEN len({x}.source_span) > 3 THEN '{f}.source_span may contain at most # spans'"]
        cases += [f"WHEN {x}.confidence IS NULL THEN '{f}.confidence must be numeric'", f"WHEN {x}.confidence NOT BETWEEN 0 AND 1 THEN '{f}.confidence must be between #.# and #.#'"]
        cases += [f"WHEN {x}.value IS NULL AND len({x}.source_span) > 0 THEN '{f}: null value requires empty source_span'", f"WHEN {x}.value IS NULL AND {x}.confidence <> 0 THEN '{f}: null value requires confidence #.#'"]
        cases += [f"WHEN len(list_filter({x}.source_span, lambda s: coalesce(s.text, '') = '')) > 0 THEN '{f}.source_span[#].text must be a non-empty string'"]
    return "CASE WHEN k = 0 THEN 'response is not valid JSON: Extra data: line # column # (char #)' WHEN k = 1 THEN 'top-level fields mismatch; missing=[''reproducibility''], extra=[''repro'']' " + " ".join(cases) + " ELSE 'accepted' END"


@query(f"WITH r AS (SELECT *, (length(paper_id) + position) % 11 AS k FROM results WHERE status = 'success' AND paper_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY metadata.completed_at DESC, position DESC) = 1) SELECT {_breach()} AS outcome, count(*) AS replies FROM r GROUP BY 1")
def contract_errors(spark: SparkSession, d: str) -> DataFrame:
    checked = _replies(spark, d).withColumn("error", contract.contract_error("raw"))
    return checked.groupBy(F.regexp_replace(F.coalesce("error", F.lit("accepted")), r"[0-9]+", "#").alias("outcome")).agg(F.count("*").alias("replies"))


@query()
def extract_stub(spark: SparkSession, d: str) -> DataFrame:
    def make_client():
        import json

        empty = {"value": None, "source_span": [], "confidence": 0.0}
        item = lambda v: {"value": v, "source_span": [{"page": 1, "text": v}], "confidence": 0.9}

        def client(context: str, system: str) -> str:
            if "7" in context[-3:]:
                raise TimeoutError("timed out")
            good = json.dumps({f: item(context) if f == "problem_gap" else empty for f in contract.FIELDS})
            return good if "again" in system or len(system) > 20 or "3" not in context[-1:] else good[:-1]

        return client

    return jobs.run_jobs(_jobs(spark, d).withColumn("context", F.col("paper_id")), make_client, "Extract.")


@query()
def run_record(spark: SparkSession, d: str) -> DataFrame:
    return jobs.run_record(extract_stub(spark, d), prompt="Extract.", selection="all")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'image/jpeg' WHEN doc_id % 3 = 1 THEN 'image/webp' ELSE 'image/png' END AS mime, base64(encode(text)) AS data FROM documents")
def encode_images(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("page."), F.when(F.col("doc_id") % 3 == 0, "JPG").when(F.col("doc_id") % 3 == 1, "webp").otherwise("bin"))
    coded = files.encoded_image(path, F.encode("text", "UTF-8"))
    return table(spark, d, "documents").select("doc_id", coded.alias("c")).select("doc_id", "c.mime", F.regexp_replace("c.data", r"\s", "").alias("data"))


# Embedding.

_LATEST = "r AS (SELECT * FROM results WHERE status = 'success' AND paper_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY metadata.completed_at DESC, position DESC) = 1)"
_S = lambda x: rf"nullif(regexp_replace({x}, '^[{text.SPACES}]+|[{text.SPACES}]+$', '', 'g'), '')"
_TITLE = f"t AS (SELECT paper_id, arg_max(x, struct_pack(s := seen_at, x := x)) AS title FROM (SELECT paper_id, seen_at, {_S('title')} AS x FROM papers) WHERE x IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1)"
_VALUES = "v AS (" + " UNION ALL ".join(f"SELECT paper_id, '{f}' AS facet, {_S(f'response.{f}.value')} AS value FROM r" for f in contract.FIELDS) + ")"
_LABEL = "CASE facet " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in embed.LABELS.items()) + " END"
_STATUS = "CASE WHEN value IS NOT NULL THEN 'unit' WHEN facet IN ('problem_gap', 'claimed_contribution', 'technical_approach') THEN 'failed' ELSE 'skipped_empty' END"


@query("SELECT paper_id, count(*) AS successes FROM results WHERE status = 'success' GROUP BY 1")
def success_filter(spark: SparkSession, d: str) -> DataFrame:
    return embed.successes(table(spark, d, "results")).groupBy("paper_id").agg(F.count("*").alias("successes"))


def _titled(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "papers").where("paper_id is not null").select("paper_id", "title", F.struct(F.col("seen_at"), text.blank_to_null(F.col("title")).alias("x")).alias("ordinal"))
    return embed.resolve_title(embed.latest_success(table(spark, d, "results")), titles)


@query(f"WITH {_LATEST}, {_TITLE} SELECT paper_id, title FROM r LEFT JOIN t USING (paper_id)")
def resolve_title(spark: SparkSession, d: str) -> DataFrame:
    return _titled(spark, d).select("paper_id", "title")


@query(f"WITH {_TITLE} SELECT paper_id, title FROM t")
def title_map(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "papers").select("paper_id", F.lit(None).cast("string").alias("anthology_id"), "title", F.struct("seen_at", text.blank_to_null(F.col("title")).alias("x")).alias("ordinal"))
    return files.title_map(rows, "ordinal")


@query("SELECT paper_id AS anthology_id, paper_url AS page_url, title, count(*) AS times FROM papers GROUP BY ALL")
def scan_papers(spark: SparkSession, d: str) -> DataFrame:
    """The papers as JSON arrays in files, a file a partition, read as paper lists."""
    p = table(spark, d, "papers").select(F.to_json(F.struct(F.col("paper_id").alias("anthology_id"), F.col("paper_url").alias("page_url"), "title")).alias("value"))

    def array(batches):
        import pyarrow as pa

        begun = False
        for b in batches:
            rows = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([("," if begun or i else "[") + r for i, r in enumerate(rows)], pa.string())], names=["value"])
            begun = begun or bool(rows)
        yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"], pa.string())], names=["value"])

    folder = f"{checkpoint_dir(spark)}/papers-{uuid.uuid4().hex}"
    p.mapInArrow(array, "value string").write.text(folder)
    read = files.paper_list(spark, folder).groupBy("anthology_id", "page_url", "title").agg(F.count("*").alias("times"))
    out = cut(read)
    remove(spark, folder)
    return out


@query(f"WITH {_LATEST}, {_VALUES} SELECT * FROM v")
def facet_value(spark: SparkSession, d: str) -> DataFrame:
    return embed.facet_values(embed.latest_success(table(spark, d, "results")))


@query(f"WITH {_LATEST}, {_VALUES} SELECT paper_id, facet, {_STATUS} AS status FROM v")
def facet_status(spark: SparkSession, d: str) -> DataFrame:
    return embed.facet_status(facet_value(spark, d)).select("paper_id", "facet", "status")


_FACETS = f"fu AS (SELECT paper_id || '::' || facet || '::v1' AS embedding_id, paper_id, 'facet' AS embedding_type, {_LABEL} || ':' || chr(10) || value AS text, 'v1' AS schema_version, facet FROM v WHERE value IS NOT NULL)"
_PAPERS = f"""pf AS (SELECT paper_id, title, {", ".join(f"{_S(f'response.{f}.value')} AS {f}" for f in embed.MANDATORY)} FROM r LEFT JOIN t USING (paper_id)),
pu AS (SELECT paper_id || '::paper::v1' AS embedding_id, paper_id, 'paper' AS embedding_type, {" || chr(10) || chr(10) || ".join(f"'{embed.LABELS[f]}:' || chr(10) || {f}" for f in embed.PAPER_FIELDS)} AS text, 'v1' AS schema_version, NULL::VARCHAR AS facet FROM pf
  WHERE title IS NOT NULL AND problem_gap IS NOT NULL AND claimed_contribution IS NOT NULL AND technical_approach IS NOT NULL)"""


@query(f"WITH {_LATEST}, {_VALUES}, {_FACETS} SELECT *, sha256(text) AS text_hash FROM fu")
def facet_units(spark: SparkSession, d: str) -> DataFrame:
    return embed.facet_units(facet_value(spark, d))


@query(f"WITH {_LATEST}, {_TITLE}, {_PAPERS} SELECT *, sha256(text) AS text_hash FROM pu")
def paper_units(spark: SparkSession, d: str) -> DataFrame:
    return embed.paper_units(_titled(spark, d))[0]


@query(f"WITH {_LATEST}, {_TITLE}, {_PAPERS} SELECT paper_id, 'missing required fields: ' || array_to_string(list_filter([{', '.join(f'''CASE WHEN {f} IS NULL THEN '{f}' END''' for f in embed.PAPER_FIELDS)}], lambda x: x IS NOT NULL), ', ') AS error FROM pf WHERE paper_id || '::paper::v1' NOT IN (SELECT embedding_id FROM pu)")
def paper_unit_failures(spark: SparkSession, d: str) -> DataFrame:
    return embed.paper_units(_titled(spark, d))[1]


@query(f"WITH {_LATEST}, {_TITLE}, {_PAPERS} SELECT paper_id, text FROM pu")
def semantic_text(spark: SparkSession, d: str) -> DataFrame:
    return paper_units(spark, d).select("paper_id", "text")


def _units(spark: SparkSession, d: str) -> DataFrame:
    return paper_units(spark, d).unionByName(facet_units(spark, d))


_UNITS = f"WITH {_LATEST}, {_TITLE}, {_VALUES}, {_FACETS}, {_PAPERS}, u AS (SELECT *, sha256(text) AS text_hash FROM (SELECT * FROM pu UNION ALL SELECT * FROM fu))"


@query("WITH d AS (SELECT embedding_id FROM manifest WHERE embedding_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT (SELECT count(*) FROM d) AS duplicates, (SELECT string_agg(embedding_id, '|' ORDER BY embedding_id) FROM (SELECT * FROM d ORDER BY 1 LIMIT 10)) AS first_ids")
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    return embed.duplicate_ids(table(spark, d, "manifest").where("embedding_id is not null"))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stored_vectors").select("id", "metadata.text_hash", "metadata.embedding_model").distinct()


@query(_UNITS + f", s AS (SELECT DISTINCT id, metadata.text_hash AS h, metadata.embedding_model AS m FROM stored_vectors) SELECT embedding_id, CASE WHEN s.h = u.text_hash AND s.m = '{MODEL}' THEN 'skipped_existing' ELSE 'pending' END AS action FROM u LEFT JOIN s ON s.id = u.embedding_id")
def incremental_plan(spark: SparkSession, d: str) -> DataFrame:
    return embed.plan(_units(spark, d), _stored(spark, d), MODEL).select("embedding_id", "action")


@query(_UNITS + " SELECT embedding_id, row_number() OVER (ORDER BY embedding_id) - 1 AS ordinal, (row_number() OVER (ORDER BY embedding_id) - 1) // 96 AS batch FROM u")
def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    return embed.batches(_units(spark, d), ["embedding_id"], 96).select("embedding_id", "ordinal", "batch")


@query()
def embed_stub(spark: SparkSession, d: str) -> DataFrame:
    return embed.embed(embed.batches(_units(spark, d), ["embedding_id"], 96), embed.hash_client).select("embedding_id", "batch", "status", "error", F.size("embedding").alias("dims"))


_STORED = "s AS (SELECT DISTINCT id, len(embedding) AS dims, document, metadata AS m FROM stored_vectors WHERE id IS NOT NULL)"


def _kept_and_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return embed.embed_and_store(_units(spark, d), table(spark, d, "stored_vectors").where("id is not null"), embed.hash_client, "run-next", MODEL)


@query(_UNITS + f""", {_STORED}, w AS (SELECT u.* FROM u WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = u.embedding_id AND s.m.text_hash = u.text_hash AND s.m.embedding_model = '{MODEL}'))
SELECT id, document, coalesce(dims, -1) AS dims, m.text_hash AS text_hash, m.embedding_model AS model, m.run_id AS run_id, m.facet AS facet FROM s WHERE id NOT IN (SELECT embedding_id FROM w)
UNION ALL SELECT embedding_id, text, 64, text_hash, '{MODEL}', 'run-next', facet FROM w""")
def embed_store(spark: SparkSession, d: str) -> DataFrame:
    """The store after a run that embeds what is pending."""
    return _kept_and_new(spark, d)[0].select("id", "document", F.coalesce(F.size("embedding"), F.lit(-1)).alias("dims"), "metadata.text_hash", F.col("metadata.embedding_model").alias("model"), "metadata.run_id", "metadata.facet").distinct()


@query(_UNITS + f""", {_STORED} SELECT embedding_id, text_hash, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.id = u.embedding_id AND s.m.text_hash = u.text_hash AND s.m.embedding_model = '{MODEL}') THEN 'skipped_existing' ELSE 'success' END AS status, 'run-next' AS run_id, NULL::VARCHAR AS error FROM u""")
def embed_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest lines of the same run."""
    return _kept_and_new(spark, d)[1].select("embedding_id", "text_hash", "status", "run_id", "error").distinct()


@query("""WITH c AS (SELECT run_id, count(*) FILTER (embedding_type = 'paper' AND status = 'success') AS paper_success, count(*) FILTER (embedding_type = 'paper' AND status = 'skipped_existing') AS paper_skipped,
  count(*) FILTER (embedding_type = 'paper' AND status = 'failed') AS paper_failed, count(*) FILTER (embedding_type = 'facet' AND status = 'success') AS facet_success, count(*) FILTER (embedding_type = 'facet' AND status = 'skipped_existing') AS facet_skipped,
  count(*) FILTER (embedding_type = 'facet' AND status = 'skipped_empty') AS facet_empty, count(*) FILTER (embedding_type = 'facet' AND status = 'failed') AS facet_failed, max(model) AS embedding_model, count(DISTINCT paper_id) AS papers FROM (SELECT DISTINCT * FROM manifest) GROUP BY 1)
SELECT *, 0 AS verification_errors, paper_failed + facet_failed AS total_failures, paper_success + paper_skipped + facet_success + facet_skipped AS units_created, CASE WHEN paper_failed + facet_failed > 0 THEN 1 ELSE 0 END AS exit_code FROM c""")
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return embed.run_totals(table(spark, d, "manifest").distinct())


_SPANS = " UNION ALL ".join(f"SELECT paper_id, '{f}' AS facet, unnest(response.{f}.source_span) AS s, unnest(range(1, len(response.{f}.source_span) + 1)) AS span_no FROM r" for f in contract.FIELDS)
_SQUEEZE = lambda x: rf"regexp_replace({x}, '[{text.SPACES}]+', ' ', 'g')"


@query(f"""WITH {_LATEST}, sp AS ({_SPANS}), q AS (SELECT paper_id, facet, CAST(span_no AS INTEGER) AS span_no, CAST(s.page AS INTEGER) AS page, s.text AS span, nullif({_SQUEEZE(f"regexp_replace(s.text, {_EDGES})")}, '') AS t FROM sp),
pg AS (SELECT DISTINCT paper_id, page_number, {_SQUEEZE('clean_text')} AS c FROM page_content WHERE paper_id IS NOT NULL AND page_number IS NOT NULL)
SELECT paper_id, facet, span_no, page, span, CASE WHEN t IS NOT NULL THEN EXISTS (SELECT 1 FROM pg WHERE pg.paper_id = q.paper_id AND (q.page IS NULL OR q.page = pg.page_number) AND contains(pg.c, q.t)) END AS grounded FROM q""")
def span_grounded(spark: SparkSession, d: str) -> DataFrame:
    return ingest.grounded_spans(embed.latest_success(table(spark, d, "results")), one_per_page(table(spark, d, "page_content"), "clean_text"), contract.FIELDS)


@query(_UNITS + f"""SELECT 'run' AS run_id, embedding_id, paper_id, embedding_type, schema_version, '{MODEL}' AS model, text_hash, 'success' AS status, CASE embedding_type WHEN 'paper' THEN 'paper_embeddings' ELSE 'facet_embeddings' END AS chroma_collection, facet, NULL::VARCHAR AS error FROM u""")
def manifest(spark: SparkSession, d: str) -> DataFrame:
    return embed.manifest(_units(spark, d), F.lit("success"), "run", MODEL)


@query(_UNITS + f""", s AS (SELECT DISTINCT id, len(embedding) AS dims, document, metadata FROM stored_vectors),
b AS (SELECT u.*, s.id, coalesce(s.dims, 0) AS dims, s.document, s.metadata AS m FROM u LEFT JOIN s ON s.id = u.embedding_id),
e AS (SELECT arg_min(dims, struct_pack(f := embedding_type <> 'paper', i := embedding_id)) AS ex FROM b WHERE dims > 0),
c AS (SELECT embedding_id, unnest(CASE WHEN id IS NULL THEN ['missing from the store'] ELSE [CASE WHEN document IS DISTINCT FROM text THEN 'stored document differs' END, CASE WHEN m.text_hash IS DISTINCT FROM text_hash THEN 'text_hash mismatch' END,
  CASE WHEN m.embedding_model IS DISTINCT FROM '{MODEL}' THEN 'embedding model mismatch' END, CASE WHEN m.schema_version IS DISTINCT FROM schema_version THEN 'schema version mismatch' END, CASE WHEN m.paper_id IS DISTINCT FROM paper_id THEN 'paper_id mismatch' END,
  CASE WHEN m.embedding_type IS DISTINCT FROM embedding_type THEN 'embedding type mismatch' END, CASE WHEN facet IS NOT NULL AND m.facet IS DISTINCT FROM facet THEN 'facet mismatch' END, CASE WHEN dims <= 0 THEN 'embedding vector is empty' END,
  CASE WHEN dims > 0 AND dims <> ex THEN 'embedding dimension ' || dims || ' != expected ' || ex END] END) AS error FROM b, e)
SELECT embedding_id, error FROM c WHERE error IS NOT NULL""")
def verify_store(spark: SparkSession, d: str) -> DataFrame:
    return embed.verify(_units(spark, d).withColumn("ordinal", F.col("embedding_id")), table(spark, d, "stored_vectors"), MODEL)


@query("SELECT run_id, embedding_type, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'skipped_existing') AS skipped_existing, count(*) FILTER (status = 'skipped_empty') AS skipped_empty, count(*) FILTER (status = 'failed') AS failed, count(*) AS total FROM (SELECT DISTINCT * FROM manifest) GROUP BY 1, 2")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return embed.summary(table(spark, d, "manifest").distinct())


@query(f"WITH s AS (SELECT DISTINCT id, metadata.text_hash AS h FROM stored_vectors), u AS (SELECT DISTINCT ON (embedding_id) embedding_id, text_hash FROM embedding_units WHERE embedding_id IS NOT NULL ORDER BY embedding_id, built_at DESC, arrived_at DESC, text_hash DESC) SELECT coalesce(embedding_id, id) AS id, coalesce(u.text_hash, s.h) AS text_hash FROM s FULL JOIN u ON s.id = u.embedding_id")
def store_upsert(spark: SparkSession, d: str) -> DataFrame:
    store = table(spark, d, "stored_vectors").select("id", F.col("metadata.text_hash").alias("text_hash")).distinct()
    new = table(spark, d, "embedding_units").where("embedding_id is not null").groupBy("embedding_id").agg(F.max(F.struct("built_at", "arrived_at", "text_hash")).alias("m")).select(F.col("embedding_id").alias("id"), F.col("m.text_hash").alias("text_hash"))
    return embed.upsert(store, cut(new))

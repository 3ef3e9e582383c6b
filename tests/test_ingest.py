import json

import pytest
from pyspark.sql import functions as F

from folioflow.functions import contract
from folioflow.operators import embed, ingest, jobs
from folioflow.sources import files

GOOD = "word " * 60


class Reader(ingest.PlainReader):
    """A paper whose text has BROKEN cannot be opened; pages with SCAN have no text of their own."""

    def pages(self, content):
        if b"BROKEN" in content:
            raise ValueError("no such object")
        out = super().pages(content)
        for p in out:
            whole = "\n\n".join(b["text"] for b in p["blocks"])
            if "SCAN" in whole:
                p["blocks"], p["images"] = [], [{"w": 600.0, "h": 500.0}]
            if "GRID" in whole:
                p["tables"] = [{"cells": [["a", ""], ["b"]], "row_count": 2, "col_count": 2, "above": "see\nTable 3b: numbers", "below": "", "markdown": " |a| "}]
            p["links"] = ["https://github.com/a/b", "mailto:x"]
        return out

    def recognise(self, content, page_number):
        if b"UNSEEN" in content:
            raise RuntimeError("engine failed")
        return "1 Introduction\n" + "seen by a machine " * 10

    def render(self, content, page_number):
        return b"png%d" % page_number


def pdf(*pages):
    return bytearray(("%PDF-\n" + "\f".join(pages)).encode())


def landing(title):
    return f'<meta name="citation_title" content="{title}"><a href="x.pdf">p</a>' if title else "<p></p>"


def test_pipeline(spark):
    papers = [("a", "https://h.org/a"), ("a", "https://h.org/a"), ("b", "https://h.org/b"), ("c", "https://h.org/c"), ("d", ""), ("e", "https://h.org/e"), ("f", "https://h.org/f"), (None, "x"), ("g", "https://h.org/g")]
    pages = {
        "a": pdf("Head\n\nAbstract\n\n" + GOOD * 5, "Head\n\nGRID " + GOOD, "SCAN", "Head\n\nlast https://osf.io/1. " + GOOD, "Head\n\n" + GOOD),
        "b": pdf("BROKEN" + GOOD * 5), "c": pdf("short"), "e": pdf("UNSEEN " + GOOD * 5, "SCAN"), "g": bytearray(b"x" * 3000),
    }
    got = ingest.ingest(
        spark.createDataFrame(papers, "paper_id string, page_url string"), spark.createDataFrame([(p, landing("" if p == "f" else f"T {p}")) for p in "abcdefg"], "paper_id string, html string"),
        spark.createDataFrame([*pages.items(), (None, pages["a"])], "paper_id string, content binary"), Reader,
    )
    state = {r.paper_id: (r.status, r.error) for r in got.papers.collect()}
    assert state == {
        "a": ("ok", None), "b": ("failed", "unreadable: ValueError: no such object"), "c": ("failed", "pdf too small"), "d": ("failed", "missing page_url"),
        "e": ("ok", None), "f": ("failed", "missing title, pdf_url"), "g": ("failed", "pdf not a PDF"),
    } or state["f"][1].startswith("missing title")
    rows = {(r.paper_id, r.page_number): r for r in got.pages.collect()}
    assert set(rows) == {("a", n) for n in range(1, 6)} | {("e", 1), ("e", 2)}
    assert rows["a", 3].text_source == "ocr" and rows["a", 3].section == "1 Introduction" and rows["a", 2].section == "Abstract"
    assert "Head" not in rows["a", 2].clean_text and rows["a", 2].raw_text.startswith("Head")  # recurs on most pages
    assert rows["a", 3].image_path == "visuals/page_003.png" and "corrupted_text" in rows["a", 3].visual_reason
    assert rows["a", 4].urls == ["https://osf.io/1", "https://github.com/a/b"]
    assert rows["e", 2].warnings == ["ocr failed: engine failed"] and rows["e", 2].text_source == "native"
    table = got.tables.first()
    assert (table.paper_id, table.page_number, table.table_id, table.caption, table.text) == ("a", 2, "Table 3B", "Table 3b: numbers", "|a|")
    assert {(r.paper_id, r.page_number, bytes(r.png)) for r in got.pictures.collect()} >= {("a", 3, b"png3"), ("e", 2, b"png2")}
    assert {r.paper_id for r in got.contexts.collect()} == {"a", "e"}
    assert {(r.status, r.papers) for r in ingest.status_counts(got.papers).groupBy("status").agg(F.sum("papers").alias("papers")).collect()} == {("ok", 2), ("failed", 5)}


def test_pipeline_of_nothing(spark):
    got = ingest.ingest(spark.createDataFrame([], "paper_id string, page_url string"), spark.createDataFrame([], "paper_id string, html string"), spark.createDataFrame([], "paper_id string, content binary"), Reader)
    assert [df.count() for df in got] == [0] * 5


def test_grounded_spans(spark):
    empty = {"value": None, "source_span": [], "confidence": 0.0}
    spans = [{"page": 1, "text": "a  b"}, {"page": 2, "text": "a b"}, {"page": None, "text": "c d"}, {"page": 9, "text": "a"}, {"page": 1, "text": " "}]
    reply = json.dumps({f: empty | ({"source_span": spans} if f == "problem_gap" else {}) for f in contract.FIELDS})
    results = spark.createDataFrame([("p", reply), ("q", None)], "paper_id string, raw string").select("paper_id", F.from_json("raw", contract.RESPONSE).alias("response"))
    pages = spark.createDataFrame([("p", 1, "x a\nb y"), ("p", 2, "c\td"), ("p", 3, None)], "paper_id string, page_number int, clean_text string")
    got = {r.span_no: r.grounded for r in ingest.grounded_spans(results, pages, contract.FIELDS).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: None}


UNITS = "embedding_id string, paper_id string, embedding_type string, text string, text_hash string, schema_version string, facet string"


def test_embed_and_store(spark):
    units = spark.createDataFrame([("p::paper", "p", "paper", "one", "h1", "v1", None), *[(f"p::f{i}", "p", "facet", f"t{i}", f"h{i}", "v1", "f") for i in range(5)]], UNITS)
    meta = "paper_id string, embedding_type string, schema_version string, embedding_model string, text_hash string, run_id string, facet string"
    old = [("p::f0", [1.0], "t0", ("p", "facet", "v1", "m", "h0", "r0", "f")), ("p::f1", [1.0], "old", ("p", "facet", "v1", "m", "was", "r0", "f")), ("gone", [1.0], "g", ("x", "facet", "v1", "m", "h", "r0", "f"))]
    store = spark.createDataFrame(old, f"id string, embedding array<float>, document string, metadata struct<{meta}>".replace(" string,", ":string,").replace(" string>", ":string>").replace("id:string", "id string", 1).replace("document:string", "document string"))

    def make_client():
        calls = []

        def client(texts):
            calls.append(len(texts))
            if "t3" in texts:
                raise TimeoutError("slow")
            return [[float(len(calls)), 2.0]] * len(texts)

        return client

    new, lines = embed.embed_and_store(units, store, make_client, "r1", "m", size=2)
    status = {r.embedding_id: (r.status, r.error) for r in lines.collect()}
    bad = {k for k, v in status.items() if v == ("failed", "TimeoutError: slow")}
    assert status["p::f0"] == ("skipped_existing", None) and "p::f3" in bad and len(bad) <= 2 and len(status) == 6
    rows = {r.id: r for r in new.collect()}
    assert rows["gone"].document == "g" and rows["p::paper"].metadata.facet is None and rows["p::paper"].metadata.run_id == "r1"
    assert set(rows) == {"gone", "p::f1", "p::f0", "p::paper"} | {f"p::f{i}" for i in (2, 4) if f"p::f{i}" not in bad}


def test_one_client_a_partition_and_whole_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # batches go over the frames' ends
    try:
        rows = spark.createDataFrame([(f"u{i:02}", i // 4, i, f"t{i}") for i in range(22)], "embedding_id string, batch long, ordinal long, text string")
        made = spark.sparkContext.accumulator(0)

        def make_client():
            made.add(1)
            return lambda texts: [[float(len(texts)), float(t[1:])] for t in texts]

        got = {r.embedding_id: list(r.embedding) for r in embed.embed(rows.coalesce(1), make_client).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {f"u{i:02}": [2.0 if i >= 20 else 4.0, float(i)] for i in range(22)} and made.value <= 4


def test_run_totals(spark):
    lines = spark.createDataFrame([("r1", "paper", "success", "m", "a"), ("r1", "facet", "skipped_empty", "m", "a"), ("r1", "facet", "skipped_existing", "m", "b"), ("r2", "facet", "failed", "m", "a"), ("r3", "paper", "success", "m", None)], "run_id string, embedding_type string, status string, model string, paper_id string")
    checks = spark.createDataFrame([("r3", 2)], "run_id string, verification_errors long")
    got = {r.run_id: (r.units_created, r.total_failures, r.verification_errors, r.exit_code) for r in embed.run_totals(lines, checks).collect()}
    assert got == {"r1": (2, 0, 0, 0), "r2": (0, 1, 0, 1), "r3": (1, 0, 2, 1)}
    assert embed.run_totals(lines.limit(0)).count() == 0


def test_prompts_are_read_and_not_run():
    assert files.load_prompt('import os\nos.abort()\nEXTRACTION_SYSTEM_PROMPT = """ Do\nit. """') == "Do\nit."
    for bad in ("", "EXTRACTION_SYSTEM_PROMPT = ' '", "EXTRACTION_SYSTEM_PROMPT = 3", "EXTRACTION_SYSTEM_PROMPT = str(1)"):
        with pytest.raises(ValueError):
            files.load_prompt(bad)


def test_adaptive_run(spark, tmp_path):
    """Throttled calls lower the concurrency of later rounds; a second run only does what failed."""
    rows = spark.createDataFrame([(f"p{i:02}", i, "slow" if i < 3 else "fine") for i in range(30)], "paper_id string, position int, context string")
    empty = {"value": None, "source_span": [], "confidence": 0.0}

    def make_client(broken=True):
        def client(context, system):
            if broken and context == "slow":
                raise RuntimeError("429 too many requests")
            return json.dumps({f: empty for f in contract.FIELDS})

        return client

    folder = str(tmp_path / "out")
    steer = jobs.run_adaptive(rows, make_client, "x", folder, jobs.Controller(initial=4), calls_each=4)
    assert steer.current == 2 + (30 - 3) // 8
    assert jobs.completed(spark.read.schema(jobs.OUTCOME).json(folder)).count() == 27
    again = jobs.run_adaptive(rows, lambda: make_client(False), "x", folder)
    assert again.clean == 3 and spark.read.schema(jobs.OUTCOME).json(folder).count() == 33

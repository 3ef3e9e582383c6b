import json
import pathlib

import pytest
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions import html
from folioflow.operators import embed
from folioflow.sources import files, sinks
from folioflow.streaming import incremental as S


def write(path, text):
    pathlib.Path(path).parent.mkdir(parents=True, exist_ok=True)
    pathlib.Path(path).write_text(text)
    return str(path)


def test_paper_list(spark, tmp_path):
    ok = write(tmp_path / "a.json", json.dumps([{"anthology_id": "x", "page_url": "u", "title": "t", "more": 1}]))
    assert [(r.anthology_id, r.title) for r in files.paper_list(spark, ok).collect()] == [("x", "t")]
    with pytest.raises(ValueError):
        files.paper_list(spark, write(tmp_path / "b.json", '{"anthology_id": "x"}'))


def test_result_lines_lenient_and_strict(spark, tmp_path):
    path = write(tmp_path / "r.jsonl", '{"paper_id": "a", "status": "success"}\n\n{broken\n[1]\n{"paper_id": "b", "status": "failed"}\n')
    assert sorted(r.paper_id for r in files.read_results(spark, path).collect()) == ["a", "b"]
    with pytest.raises(Exception, match="is no JSON object"):
        files.read_results(spark, path, strict=True).collect()
    with pytest.raises(Exception, match="has no paper_id"):
        files.read_results(spark, write(tmp_path / "s.jsonl", '{"paper_id": " "}\n'), strict=True).collect()


def test_title_map(spark):
    rows = [("p", None, "one", 1), (None, "p", "two ", 2), ("p", None, " ", 3), (None, None, "x", 4)]
    df = spark.createDataFrame(rows, "paper_id string, anthology_id string, title string, n int")
    assert [(r.paper_id, r.title) for r in files.title_map(df, "n").collect()] == [("p", "two")]


def test_files_and_pdfs(spark, tmp_path):
    write(tmp_path / "p1" / "llm_context.txt", "text")
    assert {(pathlib.Path(r.path).name, r.length) for r in files.artifact_files(spark, str(tmp_path)).collect()} == {("llm_context.txt", 4)}
    rows = [(None,), (bytearray(b"%PDF-"),), (bytearray(b"x" * 2000),), (bytearray(b"%PDF-" + b"x" * 2000),), (bytearray(b"%PDF-" + b"x" * 2000 + b"/Encrypt"),)]
    assert [r.e for r in spark.createDataFrame(rows, "c binary").select(files.pdf_check(F.col("c")).alias("e")).collect()] == ["missing", "too small", "not a PDF", None, "encrypted"]
    r = spark.createDataFrame([("a.JPG", bytearray(b"abc"))], "p string, c binary").select(files.encoded_image(F.col("p"), F.col("c")).alias("x")).first().x
    assert tuple(r) == ("image/jpeg", "YWJj")


def test_landing_pages(spark):
    page = '<title>no</title><h1>One</h1><h2> Two <b>bold</b></h2><meta name="citation_author" content=" A &amp; B "><meta name="citation_author" content=""><a href="checklist.pdf">c</a><a href="/x/ID.pdf">p</a>'
    rows = [(page, "https://h.org/p/", "ID"), ('<meta name="citation_title" content="T"><meta name="citation_pdf_url" content="u.pdf"><meta name="citation_date" content="2020">', "https://h.org", "ID"), ("", None, None), ('<meta name="citation_title" content=""><meta name="citation_title" content="X"><h2></h2><h1>One</h1>', "https://h.org", "ID")]
    got = [r.m for r in spark.createDataFrame(rows, "h string, u string, i string").select(html.landing_metadata("h", "u", "i").alias("m")).collect()]
    assert (got[0].title, got[0].authors, got[0].pdf_url, got[0].error) == ("Two bold", ["A & B"], "https://h.org/x/ID.pdf", None)
    assert (got[1].title, got[1].pdf_url, got[1].published) == ("T", "u.pdf", "2020")
    assert got[2].error == "missing paper_id, title, pdf_url"
    assert got[3].title == "" and "title" in got[3].error


def test_sinks(spark, tmp_path):
    ctx = spark.createDataFrame([("a", "one\ntwo"), ("b", "x")], "paper_id string, text string")
    sinks.export_contexts(ctx, str(tmp_path / "c"))
    assert [p.read_text().rstrip("\n") for p in (tmp_path / "c" / "paper_id=a").glob("*.txt")] == ["one\ntwo"]
    for n in (1, 2):
        sinks.append_run(spark.createDataFrame([(n,)], "attempted int"), str(tmp_path / "runs"))
    assert sinks.last_run(spark, str(tmp_path / "runs")).first().attempted == 2
    store = sinks.create_store(spark, str(tmp_path / "store"))
    assert spark.read.parquet(store).count() == 0 and sinks.create_store(spark, str(tmp_path / "store")) == store


def test_stream_equals_batch(spark, tmp_path):
    item = lambda v: {"value": v, "source_span": [], "confidence": 0.5}
    from folioflow.functions.contract import FIELDS

    lines = [{"paper_id": f"p{i % 3}", "status": "success" if i else "failed", "response": {f: item(f"v{i % 3}") for f in FIELDS}} for i in range(5)]
    for i, x in enumerate(lines):
        write(tmp_path / "in" / f"{i}.json", json.dumps(x))
    out, empty = str(tmp_path / "out"), spark.createDataFrame([], "id string, text_hash string, embedding_model string")
    put = lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}")
    S.units_into(S.results_stream(spark, str(tmp_path / "in"), 2), lambda: empty, put, "m", str(tmp_path / "ck")).awaitTermination()
    got = {r.embedding_id for r in spark.read.parquet(out).collect()}
    batch = spark.read.schema(schemas.RESULT).json(str(tmp_path / "in"))
    want = {r.embedding_id for r in embed.facet_units(embed.facet_values(embed.successes(batch).dropDuplicates(["paper_id"]))).collect()}
    assert got == want and len(got) == 24


def test_concurrency_and_rates_as_streams(spark, tmp_path):
    rows = [{"run": "r", "seq": i, "ts": f"2026-01-01T00:{i:02d}:00Z", "success": True, "throttles": int(i == 20)} for i in range(30)]
    write(tmp_path / "o" / "a.json", "\n".join(map(json.dumps, rows)))
    stream = spark.readStream.schema("run string, seq int, ts timestamp, success boolean, throttles int").json(str(tmp_path / "o"))
    S.concurrency(stream).writeStream.format("memory").queryName("aimd").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    assert [r.current for r in spark.table("aimd").collect()] == [8]  # 8, +1, +1 = 10, x 0.7 = 7, +1
    S.outcome_rates(stream).writeStream.format("memory").queryName("rates").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    assert sum(r.calls for r in spark.table("rates").collect()) == 30

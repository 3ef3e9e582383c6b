import math
import random

from pyspark.sql import functions as F

from folioflow.operators import pages as P

PAGE = "paper_id string, page_number int, raw_text string, clean_text string, needs_visual boolean, image_path string, urls array<string>, visual_reason array<string>, text_source string, warnings array<string>"


def frame(spark, rows):
    full = [(r["p"], r["n"], r.get("raw", ""), r.get("clean", ""), r.get("vis", False), r.get("img"), r.get("urls", []), r.get("why", []), "native", []) for r in rows]
    return spark.createDataFrame(full, PAGE)


def test_repeated_noise_against_a_loop(spark):
    rng = random.Random(2)
    rows = []
    for p in range(12):
        for n in range(1, rng.choice([2, 3, 5, 12]) + 1):
            body = [rng.choice(["alpha", "beta", "Header", f"Page {n}", "", "gamma delta"]) for _ in range(rng.randrange(0, 9))]
            rows.append({"p": f"p{p}", "n": n, "clean": "\n".join(body).strip()})
    got = {(r.paper_id, r.page_number): r.clean_text for r in P.repeated_noise(frame(spark, rows)).collect()}

    def edges(lines):
        f = [i for i, x in enumerate(lines) if x.strip()]
        return set(f[:3] + f[-3:])

    def key(x):
        import re

        return re.sub(r"\b\d+\b", "<number>", re.sub(r"\s+", " ", x).strip().lower()) or None

    for p in {r["p"] for r in rows}:
        mine = [r for r in rows if r["p"] == p]
        seen: dict = {}
        for r in mine:
            lines = r["clean"].splitlines()
            for i in edges(lines):
                seen.setdefault(key(lines[i]), set()).add(r["n"])
        noisy = {k for k, v in seen.items() if k and len(mine) >= 3 and len(v) >= max(3, math.ceil(0.3 * len(mine)))}
        for r in mine:
            lines = r["clean"].splitlines()
            want = "\n".join(x for i, x in enumerate(lines) if not (i in edges(lines) and key(x) in noisy)).strip() if noisy else r["clean"]
            assert got[p, r["n"]] == want


def test_sections_carry_forward(spark):
    rows = [{"p": "a", "n": 1, "clean": "Abstract\nx"}, {"p": "a", "n": 2, "clean": "text"}, {"p": "a", "n": 3, "clean": "1 One\ny\n2 Two"}, {"p": "a", "n": 4, "clean": "z"}, {"p": "b", "n": 1, "clean": "z"}]
    got = {(r.paper_id, r.page_number): r.section for r in P.sections(frame(spark, rows)).collect()}
    assert got == {("a", 1): "Abstract", ("a", 2): "Abstract", ("a", 3): "1 One", ("a", 4): "2 Two", ("b", 1): None}


def test_ocr_only_where_the_text_is_bad(spark):
    rows = [{"p": "a", "n": 1, "raw": "x" * 90, "clean": "good"}, {"p": "a", "n": 2, "raw": "x", "clean": "bad"}, {"p": "a", "n": 3, "raw": "x", "clean": "bad"}, {"p": "a", "n": 4, "raw": "x", "clean": "bad"}]
    ocr = spark.createDataFrame([("a", 1, "no", None), ("a", 2, "read  it", None), ("a", 3, None, "boom"), ("a", 4, " ", None)], "paper_id string, page_number int, text string, error string")
    got = {r.page_number: (r.clean_text, r.text_source, r.warnings) for r in P.ocr_fallback(frame(spark, rows), ocr).collect()}
    assert got == {1: ("good", "native", []), 2: ("read it", "ocr", []), 3: ("bad", "native", ["ocr failed: boom"]), 4: ("bad", "native", ["ocr gave no text"])}


def test_visual_reasons_in_order_and_once(spark):
    pages = frame(spark, [{"p": "a", "n": 1, "raw": "x = y"}, {"p": "a", "n": 2, "raw": "Figure 3 shows " + "x" * 90}])
    facts = spark.createDataFrame([("a", 1, 0.6, 0), ("a", 2, 0.04, 20)], "paper_id string, page_number int, image_ratio double, drawings int")
    scores = spark.createDataFrame([("a", 1, 2, 0.7, 0.1), ("a", 1, 1, 0.0, 0.5), ("a", 1, 3, 0.9, 0.9)], "paper_id string, page_number int, table_index int, complexity double, confidence double")
    got = {r.page_number: r.visual_reason for r in P.visual_reasons(pages, facts, scores).collect()}
    assert got == {1: ["corrupted_text", "scanned_page", "poor_table_extraction", "complex_table", "equation"], 2: ["figure"]}


def test_context_text(spark):
    papers = spark.createDataFrame([("a", "T", ["X", "Y"], "V", 2020, "u"), ("b", "T2", [], None, None, None)], "paper_id string, title string, authors array<string>, venue string, year int, pdf_url string")
    pages = frame(spark, [{"p": "a", "n": 10, "clean": "ten", "vis": True, "img": "p10.png", "why": ["figure", "equation"]}, {"p": "a", "n": 2, "clean": "two", "urls": ["https://github.com/x", "https://doi.org/1"]}])
    tabs = spark.createDataFrame([("a", 2, 1, "Table 1", "cap", "r", False), ("a", 10, 1, "t", None, "hidden", True), ("a", 2, 2, "t2", None, "s", False)], "paper_id string, page_number int, table_index int, table_id string, caption string, text string, use_visual boolean")
    got = {r.paper_id: (r.text, r.visual_pages) for r in P.contexts(papers, pages, tabs).collect()}
    assert got["a"] == (
        "PAPER METADATA\n\nPaper ID: a\nTitle: T\nAuthors: X, Y\nVenue: V\nYear: 2020\nPDF URL: u\n\nFULL PAPER TEXT\n\n=== PAGE 2 ===\ntwo\n\n=== PAGE 10 ===\nten\n\n"
        "TABLES NOT REPRESENTED BY IMAGES\n\n=== PAGE 2 / Table 1 ===\ncap\nr\n\n=== PAGE 2 / t2 ===\ns\n\nARTIFACT LINKS\n\n=== PAGE 2 ===\nhttps://github.com/x\n\nVISUAL PAGES\nPage 10: figure, equation",
        ["p10.png"],
    )
    assert got["b"][0].endswith("Authors: Unknown\nVenue: Unknown\nYear: Unknown\nPDF URL: None\n\nFULL PAPER TEXT") and got["b"][1] == []


def test_document_rules(spark):
    papers = spark.createDataFrame([("ok", 2, True), ("gap", 2, True), ("off", 1, True), ("none", 0, False)], "paper_id string, page_count int, pdf_exists boolean")
    pages = frame(spark, [{"p": "ok", "n": 1}, {"p": "ok", "n": 2}, {"p": "gap", "n": 1}, {"p": "gap", "n": 3}, {"p": "off", "n": 1}])
    tabs = spark.createDataFrame([("off", 2)], "paper_id string, page_number int")
    got = {r.paper_id: r.violations for r in P.validate_documents(papers, pages, tabs).collect()}
    assert got == {"ok": [], "gap": ["page numbers are not a sequence"], "off": ["table outside the document"], "none": ["missing pdf", "no pages", "page count differs", "page numbers are not a sequence"]}


def test_use_visual(spark):
    pages = frame(spark, [{"p": "a", "n": 1, "vis": True, "img": "x"}, {"p": "a", "n": 2, "vis": True}])
    tabs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "paper_id string, page_number int")
    assert {(r.paper_id, r.page_number): r.use_visual for r in P.table_use_visual(tabs, pages).collect()} == {("a", 1): True, ("a", 2): False, ("b", 1): False}


def test_empty_pages(spark):
    none = frame(spark, [])
    assert P.repeated_noise(none).count() == P.sections(none).count() == 0
    null = none.select("paper_id", "page_number", "clean_text").unionByName(spark.createDataFrame([("a", 1, None)], "paper_id string, page_number int, clean_text string"))
    assert [r.clean_text for r in P.repeated_noise(null).collect()] == [None]
    assert P.sections(null.withColumn("section", F.lit("old"))).first().section is None

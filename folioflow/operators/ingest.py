"""Ingestion of papers as one plan: landing pages, PDFs, pages, tables, pictures, contexts, and what failed.

What needs an engine for PDFs is behind ``Reader``: a factory makes one for each partition, so any library
can be used without being a dependency. Everything else is DataFrame plans. Errors are rows: a paper
that fails leaves its reason and stops no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import html, layout, tables, text
from folioflow.operators import pages as ops
from folioflow.session import cut
from folioflow.sources.files import pdf_check
from folioflow.thresholds import DEFAULT, Thresholds

KEY = ["paper_id", "page_number"]
VISUALS = "visuals/page_%03d.png"

PAGE_FACTS = (
    "page_width double, page_area double, drawings int, links array<string>, images array<struct<w:double,h:double>>, "
    "blocks array<struct<block_no:int,block_type:int,x0:double,y0:double,x1:double,y1:double,text:string>>, "
    "tables array<struct<cells:array<array<string>>,row_count:int,col_count:int,above:string,below:string,markdown:string>>"
)
EXTRACTED = f"paper_id string, page_number int, {PAGE_FACTS}, error string"
_FACTS = ["page_width", "page_area", "drawings", "links", "images", "blocks", "tables"]


class Reader(Protocol):
    """What an engine for PDFs has to do. Page numbers begin at 1; an exception fails the paper, page or picture alone."""

    def pages(self, content: bytes) -> list[dict]:
        """A dict a page with the columns of ``PAGE_FACTS``."""

    def recognise(self, content: bytes, page_number: int) -> str | None:
        """The page's text by character recognition."""

    def render(self, content: bytes, page_number: int) -> bytes:
        """The page as a PNG."""


class PlainReader:
    """Reads "PDFs" that are plain text: pages after the first line, form feeds between them, a block a paragraph.

    An example of a ``Reader`` and a stand-in for tests. It recognises nothing, and its pictures are empty.
    """

    def pages(self, content: bytes) -> list[dict]:
        body = content.decode().partition("\n")[2]
        return [
            {"page_width": 600.0, "page_area": 480000.0, "drawings": 0, "links": [], "images": [], "tables": [],
             "blocks": [{"block_no": i, "block_type": 0, "x0": 0.0, "y0": 10.0 * i, "x1": 600.0, "y1": 10.0 * i + 9, "text": t} for i, t in enumerate(page.split("\n\n"))]}
            for page in body.split("\f")
        ]

    def recognise(self, content: bytes, page_number: int) -> str | None:
        raise RuntimeError("no engine for recognition")

    def render(self, content: bytes, page_number: int) -> bytes:
        return b""


def extract(pdfs: DataFrame, make_reader: Callable[[], Reader]) -> DataFrame:
    """(paper_id, content) -> ``EXTRACTED``: a row a page; for a file that cannot be read one row with its error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = make_reader()
        for df in batches:
            for paper, content in zip(df.paper_id, df.content):
                try:
                    rows = [(paper, i, *(p[c] for c in _FACTS), None) for i, p in enumerate(reader.pages(bytes(content)), 1)]
                except Exception as e:  # noqa: BLE001 - becomes the paper's error
                    rows = [(paper, None, *[None] * len(_FACTS), f"{type(e).__name__}: {e}")]
                if rows:
                    yield pd.DataFrame(rows, columns=["paper_id", "page_number", *_FACTS, "error"])

    return pdfs.select("paper_id", "content").mapInPandas(read, EXTRACTED)


def native_pages(extracted: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Every page with its blocks in reading order as ``raw_text``, cleaned, and its facts; pages without blocks are empty."""
    one = extracted.where("error is null")
    blocks = one.select(*KEY, "page_width", F.explode("blocks").alias("b")).select(*KEY, "page_width", "b.*")
    both = one.select(*KEY, "page_area", "drawings", "links", "images").join(layout.layout_text(blocks, t), KEY, "left").withColumn("raw_text", F.coalesce("raw_text", F.lit("")))
    ratio = text.large_image_ratio(F.col("images"), F.col("page_area"))
    none = F.array().cast("array<string>")
    return both.select(*KEY, "raw_text", text.clean_text(F.col("raw_text")).alias("clean_text"), F.lit("native").alias("text_source"), "drawings", ratio.alias("image_ratio"), "links", none.alias("warnings"))


def scored_tables(extracted: DataFrame) -> DataFrame:
    """Every table with its id, caption, text, complexity and confidence."""
    each = extracted.where("error is null").select(*KEY, F.posexplode("tables").alias("at", "t")).select(*KEY, (F.col("at") + 1).alias("table_index"), "t.*")
    caption = tables.caption(F.coalesce("above", F.lit("")), F.coalesce("below", F.lit("")))
    named = each.withColumn("caption", caption)
    return named.select(
        *KEY, "table_index", tables.table_id(F.col("caption"), F.col("page_number"), F.col("table_index")).alias("table_id"), "caption", text.blank_to_null(F.col("markdown")).alias("text"),
        tables.complexity(F.col("cells"), F.col("row_count"), F.col("col_count")).alias("complexity"), tables.confidence(F.col("cells"), F.col("row_count"), F.col("col_count")).alias("confidence"),
    )


def _each_page(pdfs: DataFrame, wanted: DataFrame, make_reader: Callable[[], Reader], what: str, kind: str) -> DataFrame:
    """Call a reader's method for the wanted pages: (paper_id, page_number, result, error). A paper's file is read once."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        method = getattr(make_reader(), what)
        for df in batches:
            rows = []
            for paper, content, numbers in zip(df.paper_id, df.content, df.numbers):
                for n in numbers:
                    try:
                        rows.append((paper, int(n), method(bytes(content), int(n)), None))
                    except Exception as e:  # noqa: BLE001 - becomes the page's error
                        rows.append((paper, int(n), None, str(e)))
            yield pd.DataFrame(rows, columns=["paper_id", "page_number", "result", "error"])

    numbers = wanted.groupBy("paper_id").agg(F.sort_array(F.collect_set("page_number")).alias("numbers"))
    return pdfs.select("paper_id", "content").join(numbers, "paper_id").mapInPandas(call, f"paper_id string, page_number int, result {kind}, error string")


def recognised(pdfs: DataFrame, pages: DataFrame, make_reader: Callable[[], Reader], t: Thresholds = DEFAULT) -> DataFrame:
    """(paper_id, page_number, text, error) of the pages whose own text cannot be used."""
    bad = pages.where(~text.quality(F.coalesce("raw_text", F.lit("")), t)["good"])
    return _each_page(pdfs, bad, make_reader, "recognise", "string").withColumnRenamed("result", "text")


def rendered(pdfs: DataFrame, pages: DataFrame, make_reader: Callable[[], Reader]) -> DataFrame:
    """(paper_id, page_number, image_path, png, error) of the pages that need a picture."""
    done = _each_page(pdfs, pages.where("needs_visual"), make_reader, "render", "binary")
    return done.select(*KEY, F.when(F.col("error").isNull(), F.format_string(VISUALS, "page_number")).alias("image_path"), F.col("result").alias("png"), "error")


class Ingested(NamedTuple):
    """``papers`` (paper_id, metadata, page_count, status 'ok' | 'failed', error), and of those that are ok the rest."""

    papers: DataFrame
    pages: DataFrame
    tables: DataFrame
    pictures: DataFrame
    contexts: DataFrame


def ingest(listed: DataFrame, landing: DataFrame, pdfs: DataFrame, make_reader: Callable[[], Reader], t: Thresholds = DEFAULT) -> Ingested:
    """Papers (paper_id, page_url), their landing pages (paper_id, html) and files (paper_id, content) -> all that is known.

    The steps follow one another as their meaning demands: pictures are chosen by the native text, recognition
    comes before recurring headers are removed, sections after that, links and the way each table is shown
    last. Papers without an id are left out; of a paper listed twice the smallest page_url counts. Extraction, recognition and
    pictures are materialised, so that a lost executor repeats no call whose result is used.
    """
    one = listed.where("paper_id is not null").groupBy("paper_id").agg(F.min("page_url").alias("page_url"))
    pages_there = landing.where("paper_id is not null").groupBy("paper_id").agg(F.min("html").alias("html"))
    files = pdfs.where("paper_id is not null").select("paper_id", "content").dropDuplicates(["paper_id"])
    met = one.join(pages_there, "paper_id", "left").select("paper_id", "page_url", html.landing_metadata("html", "page_url", "paper_id").alias("m"))
    checked = met.join(files.select("paper_id", pdf_check(F.col("content"), t).alias("__file"), F.lit(True).alias("__there")), "paper_id", "left")
    fault = F.when(F.coalesce("page_url", F.lit("")) == "", "missing page_url").when(F.col("m.error").isNotNull(), F.col("m.error"))
    state = cut(checked.withColumn("error", F.coalesce(fault, F.when(F.col("__there").isNull(), "pdf missing"), F.concat(F.lit("pdf "), F.col("__file")))).drop("__file", "__there"))
    usable = files.join(state.where("error is null").select("paper_id"), "paper_id", "left_semi")

    extracted = cut(extract(usable, make_reader))
    pages, found = native_pages(extracted, t), scored_tables(extracted)
    pages = ops.visual_reasons(pages.drop("image_ratio", "drawings"), pages.select(*KEY, "image_ratio", "drawings"), found.select(*KEY, "table_index", "complexity", "confidence"), t)
    pictures = cut(rendered(usable, pages, make_reader))
    pages = pages.join(pictures.select(*KEY, "image_path"), KEY, "left")
    pages = ops.ocr_fallback(pages, cut(recognised(usable, pages, make_reader, t)), t)
    pages = ops.sections(ops.repeated_noise(pages, t), t)
    pages = pages.withColumn("urls", text.urls(F.col("raw_text"), F.col("links"))).drop("links")
    found = ops.table_use_visual(found, pages)

    counts = extracted.groupBy("paper_id").agg(F.count_if(F.col("error").isNull()).cast("int").alias("page_count"), F.max("error").alias("__read"))
    state = state.join(counts, "paper_id", "left").withColumn("page_count", F.coalesce("page_count", F.lit(0)))
    broken = ops.validate_documents(state.where("error is null and __read is null").select("paper_id", "page_count", F.lit(True).alias("pdf_exists")), extracted.where("error is null"), found)
    judged = state.join(broken, "paper_id", "left").withColumn("error", F.coalesce("error", F.concat(F.lit("unreadable: "), "__read"), F.nullif(F.array_join("violations", ", "), F.lit(""))))
    papers = cut(judged.select("paper_id", F.col("page_url").alias("paper_url"), "m.title", "m.authors", "m.venue", text.year_of(F.col("m.published"), F.col("paper_id")).alias("year"), "m.pdf_url", "page_count", F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "error"))
    good = papers.where("status = 'ok'")
    kept = lambda df: df.join(good.select("paper_id"), "paper_id", "left_semi")
    pages, found = kept(pages), kept(found)
    return Ingested(papers, pages, found, kept(pictures), ops.contexts(good, pages, found))


def status_counts(papers: DataFrame) -> DataFrame:
    """How many papers were ingested, and how many failed for which reason."""
    return papers.groupBy("status", "error").agg(F.count("*").alias("papers"))


def grounded_spans(results: DataFrame, pages: DataFrame, field_names: tuple[str, ...], page_text: str = "clean_text") -> DataFrame:
    """(paper_id, facet, span_no, page, span, grounded): whether each quoted span stands in the page that it names.

    A span without a page is looked for on every page of the paper. Spaces and line breaks in spans and
    pages count as one space. A page that is not there grounds nothing; a null or empty span is null.
    """
    squeeze: Callable[[Column], Column] = lambda c: F.regexp_replace(c, rf"[{text.SPACES}]+", " ")
    each = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f"response.{f}.source_span").alias("spans")) for f in field_names])
    spans = results.select("paper_id", F.explode(each).alias("f")).select("paper_id", "f.facet", F.posexplode("f.spans").alias("at", "s"))
    spans = spans.select("paper_id", "facet", (F.col("at") + 1).alias("span_no"), F.col("s.page").cast("int").alias("page"), F.col("s.text").alias("span"), F.nullif(squeeze(text.strip(F.col("s.text"))), F.lit("")).alias("__span"))
    have = pages.select("paper_id", F.col("page_number").alias("page"), squeeze(F.col(page_text)).alias("__text"))
    # Texts of pages go to the spans that name them; only spans without a page meet a whole paper.
    named = spans.where("page is not null").join(have, ["paper_id", "page"], "left")
    any_ = spans.where("page is null").join(have.drop("page"), "paper_id", "left")
    hit = named.unionByName(any_.select(named.columns)).groupBy("paper_id", "facet", "span_no", "page", "span", "__span").agg(F.max(F.coalesce(F.col("__text").contains(F.col("__span")), F.lit(False))).alias("hit"))
    return hit.select("paper_id", "facet", "span_no", "page", "span", F.when(F.col("__span").isNotNull(), F.col("hit")).alias("grounded"))

"""Operators over the pages of papers: noise, sections, visual evidence, tables, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import tables, text
from folioflow.functions.text import first_filled
from folioflow.operators.sequence import carry_forward
from folioflow.thresholds import DEFAULT, Thresholds

KEY = ["paper_id", "page_number"]

# The headings of a context, its page marks, and the names of metadata.
METADATA, TEXT, TABLES, ARTIFACTS, VISUALS = "PAPER METADATA", "FULL PAPER TEXT", "TABLES NOT REPRESENTED BY IMAGES", "ARTIFACT LINKS", "VISUAL PAGES"
PAGE_OPEN, PAGE_CLOSE, VISUAL_LINE, UNKNOWN = "=== PAGE ", " ===", "Page ", "Unknown"
NAMES = {"paper_id": "Paper ID", "title": "Title", "authors": "Authors", "venue": "Venue", "year": "Year", "pdf_url": "PDF URL"}


def one_per_page(pages: DataFrame, *columns: str) -> DataFrame:
    """Pages with the wanted columns, repeated rows once; rows without a key are left out.

    Of differing versions of a page the greatest counts, compared column by column.
    """
    keyed = pages.where("paper_id is not null and page_number is not null")
    if not columns:
        return keyed.select(*KEY).distinct()
    return keyed.groupBy(*KEY).agg(F.max(F.struct(*columns)).alias("__v")).select(*KEY, "__v.*")


def repeated_noise(pages: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Replace ``clean_text`` by the text without edge lines that recur on enough pages of the paper.

    Keys are counted with partial aggregation by (paper, key, page); only the few keys that recur
    go back to the pages, as one array a paper.
    """
    least = F.greatest(F.lit(t.noise_min_pages), F.floor((F.col("pages") * t.noise_page_percent + 99) / 100).cast("int"))
    lined = pages.withColumn("__lines", text.lines(F.coalesce("clean_text", F.lit("")))).withColumn("__edges", text.edge_indexes(F.col("__lines"), t))
    keys = lined.select(*KEY, F.explode(F.transform("__edges", lambda i: text.noise_key(F.get("__lines", i), t))).alias("key")).where("key is not null")
    seen = keys.distinct().groupBy("paper_id", "key").agg(F.count("*").alias("n")).where(F.col("n") >= t.noise_min_pages)
    sizes = pages.groupBy("paper_id").agg(F.count("*").alias("pages")).where(F.col("pages") >= t.noise_min_pages)
    noisy = seen.join(sizes, "paper_id").where(F.col("n") >= least).groupBy("paper_id").agg(F.collect_list("key").alias("__noise"))
    keep = F.filter("__lines", lambda x, i: ~(F.array_contains("__edges", i) & F.coalesce(F.array_contains("__noise", text.noise_key(x, t)), F.lit(False))))
    cleaned = F.when(F.col("__noise").isNull() | F.col("clean_text").isNull(), F.col("clean_text")).otherwise(text.strip(F.array_join(keep, "\n")))
    return lined.join(noisy, "paper_id", "left").withColumn("clean_text", cleaned).drop("__lines", "__edges", "__noise")


def sections(pages: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Set ``section``: the first heading on the page, else the last one on an earlier page of the paper.

    Only headings are sorted, not texts, and a paper may span partitions of the sort.
    """
    found = F.transform(F.filter(text.lines(F.coalesce("clean_text", F.lit(""))), lambda x: text.is_heading(x, t)), text.strip)
    ends = pages.select(*KEY, found.alias("h")).select(*KEY, F.try_element_at("h", F.lit(1)).alias("__first"), F.try_element_at("h", F.lit(-1)).alias("__last"))
    carried = carry_forward(ends, "paper_id", "page_number", "__last", "__before")
    labelled = carried.select(*KEY, F.coalesce("__first", "__before").alias("section"))
    return pages.drop("section").join(labelled, KEY, "left")


def ocr_fallback(pages: DataFrame, ocr: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Take recognised text (paper_id, page_number, text, error) for pages whose own text is not usable.

    A failed or empty recognition leaves a warning and the page as it is. ``raw_text`` never changes.
    """
    both = pages.join(ocr.select(*KEY, F.col("text").alias("__ocr"), F.col("error").alias("__error")), KEY, "left")
    bad = ~text.quality(F.coalesce("raw_text", F.lit("")), t)["good"]
    clean = text.clean_text(F.col("__ocr"))
    used = bad & F.col("__error").isNull() & (F.coalesce(clean, F.lit("")) != "")
    warning = F.when(bad & F.col("__error").isNotNull(), F.concat(F.lit("ocr failed: "), F.col("__error"))).when(bad & ~used, "ocr gave no text")
    warnings = F.array_compact(F.concat(F.coalesce("warnings", F.array().cast("array<string>")), F.array(warning)))
    return both.withColumns({"clean_text": F.when(used, clean).otherwise(F.col("clean_text")), "text_source": F.when(used, "ocr").otherwise(F.col("text_source")), "warnings": warnings}).drop("__ocr", "__error")


def visual_reasons(pages: DataFrame, facts: DataFrame, table_scores: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Set ``visual_reason`` (in a fixed order, each once) and ``needs_visual``.

    ``facts`` has (paper_id, page_number, image_ratio, drawings), ``table_scores`` (paper_id,
    page_number, table_index, complexity, confidence).
    """
    reason = tables.visual_reason(F.col("complexity"), F.col("confidence"), t)
    per_page = table_scores.withColumn("reason", reason).where("reason is not null").groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("table_index", "reason"))), lambda r: r.reason).alias("__tables"))
    raw = F.coalesce("raw_text", F.lit(""))
    bad = ~text.quality(raw, t)["good"]
    one = lambda cond, name: F.array(F.when(cond, name))
    every = F.concat(
        one(bad, "corrupted_text"), one(bad & (F.col("image_ratio") >= t.scanned_image_ratio), "scanned_page"),
        F.coalesce("__tables", F.array().cast("array<string>")),
        one(text.figure_candidate(raw, F.col("image_ratio"), F.col("drawings"), t), "figure"), one(bad & text.has_equation(raw), "equation"),
    )
    both = pages.join(facts, KEY, "left").join(per_page, KEY, "left").withColumn("image_ratio", F.coalesce("image_ratio", F.lit(0.0)))
    return both.withColumn("visual_reason", F.array_distinct(F.array_compact(every))).withColumn("needs_visual", F.size("visual_reason") > 0).drop("__tables")


def table_use_visual(table_rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Set ``use_visual``: the table's page needs a picture and has one."""
    shown = pages.where("needs_visual and image_path is not null").select(*KEY, F.lit(True).alias("__shown")).dropDuplicates(KEY)
    return table_rows.join(shown, KEY, "left").withColumn("use_visual", F.coalesce("__shown", F.lit(False))).drop("__shown")


def validate_documents(papers: DataFrame, pages: DataFrame, table_rows: DataFrame) -> DataFrame:
    """(paper_id, violations): papers whose pages are not 1..page_count, or with tables off the pages.

    ``papers`` has (paper_id, page_count, pdf_exists).
    """
    n = pages.groupBy("paper_id").agg(F.count("*").alias("n"), F.count_distinct("page_number").alias("different"), F.min("page_number").alias("low"), F.max("page_number").alias("high"))
    off = table_rows.join(papers.select("paper_id", "page_count"), "paper_id").where("page_number < 1 or page_number > page_count").groupBy("paper_id").agg(F.count("*").alias("off"))
    both = papers.join(n, "paper_id", "left").join(off, "paper_id", "left")
    rule = lambda cond, name: F.when(F.coalesce(cond, F.lit(True)), name)
    found = F.array_compact(F.array(
        rule(~F.col("pdf_exists"), "missing pdf"), rule(F.col("page_count") <= 0, "no pages"),
        rule(F.col("n") != F.col("page_count"), "page count differs"),
        rule((F.col("low") != 1) | (F.col("high") != F.col("n")) | (F.col("different") != F.col("n")), "page numbers are not a sequence"),
        F.when(F.col("off") > 0, "table outside the document"),
    ))
    return both.select("paper_id", found.alias("violations"))


def contexts(papers: DataFrame, pages: DataFrame, table_rows: DataFrame) -> DataFrame:
    """(paper_id, text, visual_pages): the whole paper as one text that keeps page numbers.

    Each section is put together by one aggregation a paper; empty ones are left out. A paper's
    text is one value by definition, so its size bounds a task, not the corpus.
    """
    def joined(df: DataFrame, order: list[str], piece, sep: str, out: str) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(*order, piece.alias("piece"))))
        return df.groupBy("paper_id").agg(F.array_join(F.transform(parts, lambda p: p.piece), sep).alias(out))

    mark = lambda: F.concat(F.lit(PAGE_OPEN), F.col("page_number").cast("string"))
    page_text = joined(pages, ["page_number"], F.concat(mark(), F.lit(PAGE_CLOSE + "\n"), F.coalesce("clean_text", F.lit(""))), "\n\n", "__pages")
    plain = table_rows.where("not use_visual and text is not null and text <> ''")
    table_piece = F.concat_ws("\n", F.concat(mark(), F.lit(" / "), F.col("table_id"), F.lit(PAGE_CLOSE)), F.nullif(F.col("caption"), F.lit("")), "text")
    table_text = joined(plain, ["page_number", "table_index"], table_piece, "\n\n", "__tables")
    links = pages.withColumn("__links", F.filter("urls", text.is_artifact_url)).where(F.size("__links") > 0)
    link_text = joined(links, ["page_number"], F.concat(mark(), F.lit(PAGE_CLOSE + "\n"), F.array_join("__links", "\n")), "\n\n", "__artifacts")
    shown = pages.where("needs_visual and image_path is not null")
    shown_piece = F.concat(F.lit(VISUAL_LINE), F.col("page_number").cast("string"), F.lit(": "), F.array_join("visual_reason", ", "))
    visuals = F.array_sort(F.collect_list(F.struct("page_number", shown_piece.alias("piece"), "image_path")))
    shown_text = shown.groupBy("paper_id").agg(visuals.alias("__v")).select("paper_id", F.array_join(F.transform("__v", lambda v: v.piece), "\n").alias("__visual"), F.transform("__v", lambda v: v.image_path).alias("visual_pages"))
    filled = {
        "paper_id": F.col("paper_id"), "title": F.col("title"), "authors": first_filled(F.array_join("authors", ", "), F.lit(UNKNOWN)), "venue": first_filled(F.col("venue"), F.lit(UNKNOWN)),
        "year": F.coalesce(F.nullif("year", F.lit(0)).cast("string"), F.lit(UNKNOWN)), "pdf_url": F.col("pdf_url"),
    }
    lines = [F.concat(F.lit(f"{NAMES[k]}: "), F.coalesce(v, F.lit("None"))) for k, v in filled.items()]
    meta = F.concat(F.lit(METADATA + "\n\n"), F.concat_ws("\n", *lines))
    titled = lambda title, c, sep="\n\n": F.when(F.col(c).isNotNull(), F.concat(F.lit(title + sep), F.col(c)))
    whole = F.concat_ws("\n\n", meta, F.coalesce(titled(TEXT, "__pages"), F.lit(TEXT)), titled(TABLES, "__tables"), titled(ARTIFACTS, "__artifacts"), titled(VISUALS, "__visual", "\n"))
    out = papers.dropDuplicates(["paper_id"])
    for part in (page_text, table_text, link_text, shown_text):
        out = out.join(part, "paper_id", "left")
    return out.select("paper_id", text.strip(whole).alias("text"), F.coalesce("visual_pages", F.array().cast("array<string>")).alias("visual_pages"))

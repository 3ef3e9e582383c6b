"""Scores, captions and identifiers of extracted tables. Cells are arrays of rows of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import SPACES, strip
from folioflow.thresholds import DEFAULT, Thresholds

CAPTION = rf"(?i)(?<![\p{{L}}\p{{N}}_])(table)([{SPACES}]+)([0-9]+)([a-z]?)(?![\p{{L}}\p{{N}}_])"


def _shares(cells: Column, columns: Column) -> tuple[Column, Column, Column]:
    flat = F.flatten(cells)
    total = F.greatest(F.size(flat), F.lit(1))
    text = lambda c: F.coalesce(c, F.lit(""))
    empty = F.size(F.filter(flat, lambda c: strip(text(c)) == "")) / total
    multiline = F.size(F.filter(flat, lambda c: text(c).contains("\n"))) / total
    irregular = F.size(F.filter(cells, lambda r: F.size(r) != columns))
    return empty, multiline, irregular


def complexity(cells: Column, rows: Column, columns: Column) -> Column:
    empty, multiline, irregular = _shares(cells, columns)
    add = lambda cond, x: F.when(cond, F.lit(x)).otherwise(F.lit(0.0))
    # Added in this order: sums of doubles depend on it.
    score = add(columns >= 5, 0.20) + add(rows >= 10, 0.15) + add(empty >= 0.15, 0.20) + add(multiline >= 0.10, 0.15) + add(irregular > 0, 0.30)
    return F.least(score, F.lit(1.0))


def confidence(cells: Column, rows: Column, columns: Column) -> Column:
    empty, _, irregular = _shares(cells, columns)
    score = F.lit(1.0) - F.least(empty * 0.50, F.lit(0.40)) - F.least(irregular * 0.15, F.lit(0.30)) - F.when((rows == 1) | (columns == 1), 0.15).otherwise(0.0)
    sound = F.greatest(F.lit(0.0), F.least(score, F.lit(1.0)))
    return F.when((rows <= 0) | (columns <= 0) | (F.size(cells) <= 0), 0.0).otherwise(sound)


def caption(above: Column, below: Column) -> Column:
    """The first line above, else below, that names a table; white space collapsed."""
    def first(text: Column) -> Column:
        return F.get(F.filter(F.split(text, "\n"), lambda x: x.rlike(CAPTION)), F.lit(0))

    return strip(F.regexp_replace(F.coalesce(first(above), first(below)), rf"[{SPACES}]+", " "))


def table_id(caption_text: Column, page_number: Column, table_index: Column) -> Column:
    """"Table 2A" from a caption, else ``page_N_table_M``."""
    number, suffix = F.regexp_extract(caption_text, CAPTION, 3), F.upper(F.regexp_extract(caption_text, CAPTION, 4))
    named = F.concat(F.lit("Table"), F.regexp_extract(caption_text, CAPTION, 2), number, suffix)
    return F.when(F.coalesce(caption_text, F.lit("")).rlike(CAPTION), named).otherwise(F.format_string("page_%d_table_%d", page_number, table_index))


def visual_reason(complexity_score: Column, confidence_score: Column, t: Thresholds = DEFAULT) -> Column:
    return F.when(complexity_score >= t.complex_table, "complex_table").when(confidence_score < t.poor_table, "poor_table_extraction")

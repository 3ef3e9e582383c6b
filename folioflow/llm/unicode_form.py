"""One form for text that reads the same but is stored with different characters.

``canonical_form`` applies, in this order: canonical decomposition, removal of default-ignorable
characters, look-alike letters of other scripts to the Latin letter of the same shape (before any
compatibility mapping, which would turn some into letters of another shape), hyphens of equal look
to one, compatibility normalisation in composed form; all of it once more for the letters that
this brings to light; and every run of white space to a single space.
``folded_form`` adds full case folding for comparisons that ignore case.

The normaliser runs once per distinct value of an Arrow batch, and printable ASCII text never
leaves the JVM: for it the form is white space handling alone.

Null stays null; empty or blank text becomes the empty string; text of any length is handled whole.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.session import cut

# Letters of other scripts that have the shape of a Latin letter, and that letter.
LOOKALIKES = {
    # Cyrillic, small
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "ѵ": "v",
    # Cyrillic, capital
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ѵ": "V",
    # Greek, small
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    # Greek, capital
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h",
}
# Hyphens that look like the one of the keyboard.
HYPHENS = "‐‑⁃﹣－"
# Default-ignorable code points, as ranges.
IGNORABLE = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
    (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]

_IGNORE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in IGNORABLE) + "]+")
_ALIKE = str.maketrans(LOOKALIKES | {h: "-" for h in HYPHENS})


def canonical(text: str) -> str:
    """The form of one text, case and accents kept."""
    if text.isascii():
        return " ".join(text.split())
    # Decomposed, a look-alike is mapped under its accent too, and the lunate sigma is still one. Twice,
    # because compatibility characters hide look-alikes and ignorable characters.
    for _ in range(2):
        text = unicodedata.normalize("NFKC", _IGNORE.sub("", unicodedata.normalize("NFD", text)).translate(_ALIKE))
        if text.isascii():
            break
    return " ".join(text.split())


def folded(text: str) -> str:
    """The form of one text for comparisons without case."""
    return unicodedata.normalize("NFKC", canonical(text).casefold())


def _each_distinct(values: pd.Series, form) -> pd.Series:
    codes, distinct = pd.factorize(values)
    done = pd.Series([form(x) for x in distinct] + [None], dtype=object)  # code -1, null, takes the last
    return pd.Series(done.to_numpy()[codes])


@F.pandas_udf(T.StringType())
def _canonical_udf(values: pd.Series) -> pd.Series:
    return _each_distinct(values, canonical)


@F.pandas_udf(T.StringType())
def _folded_udf(values: pd.Series) -> pd.Series:
    return _each_distinct(values, folded)


def _plain(text: Column) -> Column:
    return ~text.rlike(r"[^\t\n\x0b\f\r\x1c-\x7e]")


def _spaced(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"[\s\x1c-\x1f]+", " "), "^ | $", "")


def canonical_form(text: Column) -> Column:
    return F.when(_plain(text), _spaced(text)).otherwise(_canonical_udf(F.when(~_plain(text), text)))


def folded_form(text: Column) -> Column:
    return F.when(_plain(text), F.lower(_spaced(text))).otherwise(_folded_udf(F.when(~_plain(text), text)))


def records(papers: DataFrame, pages: DataFrame) -> DataFrame:
    """Titles and pages as one table (field, key, paper_id, text)."""
    titles = papers.select(F.lit("title").alias("field"), F.col("paper_id").alias("key"), "paper_id", F.col("title").alias("text"))
    texts = pages.select(F.lit("clean_text").alias("field"), F.concat_ws("#", "paper_id", F.col("page_number").cast("string")).alias("key"), "paper_id", F.col("clean_text").alias("text"))
    return titles.unionByName(texts)


def forms(papers: DataFrame, pages: DataFrame) -> DataFrame:
    """Every distinct record with its form and its form without case."""
    one = records(papers, pages).withColumn("form", canonical_form(F.col("text")))
    return one.select("field", "key", "paper_id", "form", folded_form(F.col("text")).alias("folded"), (~F.col("form").eqNullSafe(F.col("text"))).alias("changed")).distinct()


def same_reading_pairs(papers: DataFrame, pages: DataFrame) -> DataFrame:
    """Records of two papers whose texts differ but have one form.

    Only 16-byte digests of form and text are shuffled. Classes of one form are found by partial
    aggregation before any row is paired, so a form that a third of the rows share without any
    difference in characters (one notice page copied everywhere) makes no pairs at all.
    """
    text, form = F.col("text"), F.col("form")
    marked = records(papers, pages).where("text is not null and key is not null").withColumn("form", canonical_form(text)).where(form != "")
    slim = cut(marked.select("field", "key", "paper_id", F.unhex(F.md5(form)).alias("form_id"), F.unhex(F.md5(text)).alias("text_id")).distinct())
    classes = slim.groupBy("field", "form_id").agg(F.min("text_id").alias("t0"), F.max("text_id").alias("t1"), F.min("paper_id").alias("p0"), F.max("paper_id").alias("p1"))
    mixed = slim.join(classes.where("t0 <> t1 and p0 <> p1").select("field", "form_id"), ["field", "form_id"], "left_semi")
    a, b = mixed.alias("a"), mixed.alias("b")
    on = (F.col("a.field") == F.col("b.field")) & (F.col("a.form_id") == F.col("b.form_id")) & (F.col("a.text_id") != F.col("b.text_id")) & (F.col("a.paper_id") != F.col("b.paper_id")) & (F.col("a.key") < F.col("b.key"))
    return a.join(b, on).select(F.col("a.field").alias("field"), F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b")).distinct()

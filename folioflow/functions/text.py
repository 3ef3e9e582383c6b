"""Column builders for text of pages: cleaning, quality, line keys, headings, links.

Python, Java and RE2 disagree about what ``\\s``, ``\\d`` and a line break are, so every class is
written out. Everything but compatibility normalisation runs inside code generation; that runs in
an Arrow UDF and only for text that is not plain ASCII.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.thresholds import DEFAULT, Thresholds

#: White space inside a line, all white space, and a line break, as classes for Java and RE2.
BLANKS = r"\x09\x1f\x20\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
SPACES = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BREAK = r"\x0d\x0a|[\x0a-\x0d\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# Fixed values.
KNOWN_TITLES = ("abstract", "introduction", "related work", "background", "method", "methods", "methodology", "approach", "experiments", "experimental setup", "evaluation", "results", "analysis", "discussion", "limitations", "conclusion", "conclusions", "references", "appendix", "acknowledgments", "acknowledgements")
NUMBERED = r"^(?:[0-9]+(?:\.[0-9]+)*|[A-Z](?:\.[0-9]+)*)[.)]?[" + SPACES + r"]+[A-Z][^\x0a]{1,100}$"
APPENDIX = r"(?i)^(?:appendix(?:[" + SPACES + r"]+[a-z])?|[a-z](?:\.[0-9]+)*)[" + SPACES + r"]+[^\x0a]{1,100}$"
URL = r"""https?://[^\s<>()\[\]{}"']+"""
URL_TAIL = r"[.,;:!?)\]}]+$"
ARTIFACT_HOSTS = ("github.com", "gitlab.com", "huggingface.co", "zenodo.org", "figshare.com", "osf.io", "kaggle.com")
DENIED_HOSTS = ("doi.org", "dx.doi.org", "aclanthology.org")
EQUATION = "[=∑∏∫≤≥λαβ]"
FIGURE = r"(?im)^[" + SPACES + r"]*(?:figure|fig\.)[" + SPACES + r"]*[0-9]+[a-z]?(?![a-zA-Z0-9_])"
HYPHENATED = r"(?<![\p{L}\p{N}_])([A-Za-z]{3,})-\n([a-z]{2,5})(?![\p{L}\p{N}_])"


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(text: Column) -> Column:
    exotic = text.rlike(r"[^\x00-\x7f]")
    return F.when(exotic, _nfkc(F.when(exotic, text))).otherwise(text)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, rf"^[{SPACES}]+|[{SPACES}]+\z", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def dehyphenate(text: Column) -> Column:
    """Join a word cut by a hyphen at a line end when its tail is short and in lower case."""
    return F.regexp_replace(text, HYPHENATED, "$1$2")


def lines(text: Column) -> Column:
    """Lines of a text; like a text file, a break at the end begins no new line."""
    broken = F.split(F.regexp_replace(text, BREAK, "\n"), "\n", -1)
    return F.when(text == "", F.array().cast("array<string>")).when(F.element_at(broken, -1) == "", F.slice(broken, 1, F.size(broken) - 1)).otherwise(broken)


def clean_text(raw: Column) -> Column:
    """Normalised text: hyphens repaired, blanks collapsed, lines trimmed, at most one blank line in a row."""
    t = F.regexp_replace(dehyphenate(nfkc(raw)), BREAK, "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), rf"[{BLANKS}]*\n[{BLANKS}]*", "\n")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def visible_chars(raw: Column) -> Column:
    return F.length(F.regexp_replace(raw, rf"[{SPACES}]", ""))


def quality(raw: Column, t: Thresholds = DEFAULT) -> Column:
    """struct(visible, unprintable, replaced, good): whether a page's text can be used."""
    visible, hidden = visible_chars(raw), F.regexp_count(raw, F.lit(r"[\p{C}&&[^\x09-\x0d\x1c-\x1f\x85]]"))
    replaced = F.regexp_count(raw, F.lit("�"))
    good = (visible >= t.min_visible_chars) & ((visible - hidden) / visible >= t.min_printable_ratio) & (replaced / visible < t.max_replacement_ratio)
    return F.struct(visible.alias("visible"), hidden.alias("unprintable"), replaced.alias("replaced"), F.when(visible < t.min_visible_chars, False).otherwise(good).alias("good"))


def edge_indexes(line_array: Column, t: Thresholds = DEFAULT) -> Column:
    """0-based places of the first and last lines that are not blank, ascending."""
    filled = F.filter(F.sequence(F.lit(0), F.size(line_array) - 1), lambda i: strip(F.get(line_array, i)) != "")
    n, k = F.size(filled), t.noise_edge_lines
    both = F.concat(F.slice(filled, 1, k), F.slice(filled, F.greatest(n - k + 1, F.lit(1)), k))
    return F.when((F.size(line_array) == 0) | (n == 0), F.array().cast("array<int>")).otherwise(F.array_distinct(both))


def noise_key(line: Column, t: Thresholds = DEFAULT) -> Column:
    """What a header or footer is recognised by: lower case, single spaces, numbers masked. Null: no candidate."""
    norm = F.lower(strip(F.regexp_replace(line, rf"[{SPACES}]+", " ")))
    masked = F.regexp_replace(norm, r"(?<![\p{L}\p{N}_])\p{Nd}+(?![\p{L}\p{N}_])", "<number>")
    return F.when((norm == "") | (F.length(norm) > t.noise_max_chars) | norm.contains("http://") | norm.contains("https://"), None).otherwise(masked)


def is_heading(line: Column, t: Thresholds = DEFAULT) -> Column:
    text = strip(line)
    low = F.lower(text)
    known = F.regexp_replace(low, ":+$", "").isin(*KNOWN_TITLES)
    caption = low.startswith("table ") | low.startswith("figure ") | low.startswith("fig. ")
    wordy = F.size(F.split(text, rf"[{SPACES}]+")) > t.heading_max_words
    shaped = text.rlike(NUMBERED) | text.rlike(APPENDIX)
    return F.when((text == "") | (F.length(text) > t.heading_max_chars), False).otherwise(known | (~caption & ~wordy & shaped))


def urls(raw: Column, links: Column | None = None) -> Column:
    """Links in the text without closing punctuation, then those of annotations, each once."""
    found = F.transform(F.regexp_extract_all(raw, F.lit(URL), F.lit(0)), lambda u: F.regexp_replace(u, URL_TAIL, ""))
    if links is not None:
        kept = F.filter(links, lambda u: u.startswith("http://") | u.startswith("https://"))
        found = F.concat(found, F.coalesce(kept, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(found, lambda u: u != ""))


def is_artifact_url(url: Column) -> Column:
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), r"^www\.", "")
    return ~host.isin(*DENIED_HOSTS) & (host.isin(*ARTIFACT_HOSTS) | host.endswith(".github.io"))


def has_equation(text: Column) -> Column:
    return text.rlike(EQUATION)


def large_image_ratio(images: Column, page_area: Column) -> Column:
    """The largest image's share of the page; images are structs of w and h."""
    shares = F.transform(images, lambda i: i.w * i.h / F.greatest(page_area, F.lit(1.0)))
    return F.coalesce(F.array_max(shares), F.lit(0.0))


def figure_candidate(raw: Column, image_ratio: Column, drawings: Column, t: Thresholds = DEFAULT) -> Column:
    return raw.rlike(FIGURE) & ((image_ratio >= t.figure_image_ratio) | (F.coalesce(drawings, F.lit(0)) >= t.figure_drawings))


# Scalars of metadata.


def paper_id_from_url(url: Column) -> Column:
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*:", ""), r"^//[^/]*", "")
    last = F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"([^/]*)$", 1)
    return F.regexp_replace(F.regexp_replace(last, ";.*$", ""), r"\.pdf$", "")


def year_of(*texts: Column) -> Column:
    """The first whole 19xx or 20xx of the first text that is not empty."""
    text = F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])
    return F.nullif(F.regexp_extract(text, r"(?:^|[^\p{L}\p{N}_])((?:19|20)[0-9]{2})(?![\p{L}\p{N}_])", 1), F.lit("")).cast("int")


def first_filled(*texts: Column) -> Column:
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def natural_key(name: Column) -> Column:
    """Sorts digit runs by value and the rest without case: an array of comparable strings."""
    parts = F.regexp_extract_all(name, F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    first = F.when(name.rlike("^[0-9]"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.concat(first, parts), lambda p: F.when(p.rlike("^[0-9]"), F.lpad(p, 20, "0")).otherwise(F.lower(p)))

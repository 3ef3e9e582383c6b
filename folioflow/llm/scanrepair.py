"""Noise in text from scanned pages: broken words, misread characters, headers, page numbers.

Every page is judged by its text, never by its ``text_source``.

* The vocabulary (canonical lower-case words with their counts over all pages) is counted inside
  each partition first. Halves of words cut at a line end stay out of it.
* Words with the same *confusable-glyph skeleton* (characters that scanners mistake for each other
  made one) form a group. A word is misread if its group has a form at least ``RATIO`` times as
  frequent in the corpus, or one clearly more frequent in the same paper (names of systems and
  people are frequent nowhere else).
* A word cut by a mark at a line end is broken if joined it is a known word and more frequent than
  with a hyphen; unknown both ways it is broken.
* The edge of a page are its ``EDGE`` first and last lines that are not blank, however long they are.
* Running headers are edge lines whose text without numbers has the skeleton of the beginning of
  the paper's title, or names an author with "et al.", or, digits masked, recurs at the page tops
  of its paper next to a number that moves with the page.
* Page numbers are edge lines holding one number alone whose distance from the page's position is
  the paper's usual one.

Words that are frequent beyond doubt are broadcast: at most 1 / ``FREQUENT_SHARE`` words can each
make up that share of all words, whatever the size of the corpus. All other words are joined.

Null or empty pages have no noise. Repeated pages count once. Text is handled whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.text import is_heading
from folioflow.llm.unicode_form import canonical, canonical_form
from folioflow.session import cut

RATIO, FREQUENT_SHARE, FREQUENT_LEAST = 20, 1e-5, 1000
PAPER_RATIO, EDGE = 2, 3

_MARKS = "-‐‑–—¬­"
_TRIM = ".,;:()[]{}\"'“”‘’?*…"
#: A line end that cuts a word, and the word that goes on.
_CUT = rf"(\S*\pL)[{_MARKS}][ \t]*\n[ \t]*(\S+)"

# Characters and pairs that recognition takes for each other, each with the one that stands for all.
GLYPHS = {"0": "o", "1": "l", "!": "l", "|": "l", "i": "l", "5": "s", "$": "s", "q": "g", "9": "g", "6": "b", "f": "t", "e": "c", "h": "b", "8": "b"}
PAIRS = [("vv", "w"), ("rn", "m"), ("nn", "m"), ("cl", "d"), ("rl", "n"), ("ll", "b"), ("tl", "u")]
#: Orders in which the pairs are tried: overlapping pairs can hide one another.
_ORDERS = [PAIRS, [("ll", "b"), *[p for p in PAIRS if p[0] != "ll"]], [("tl", "u"), *[p for p in PAIRS if p[0] != "tl"]], [("rl", "n"), *[p for p in PAIRS if p[0] != "rl"]]]
_GLYPH_MAP = str.maketrans(GLYPHS)


def skeletons(word: str) -> list[str]:
    """The word as a scanner may confuse it; numbered, because only equal orders compare."""
    base = word.lower().translate(_GLYPH_MAP)
    out = []
    for k, order in enumerate(_ORDERS):
        s = base
        for a, b in order:
            s = s.replace(a, b)
        out.append(f"{k}{s}")
    return out


def word_form(token: str) -> str:
    """A token as the vocabulary has it; empty if it is no word."""
    w = (token if token.isascii() else canonical(token)).strip(_TRIM).lower()
    return w if len(w) > 1 and any(map(str.isalpha, w)) else ""


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for b in batches:
        text = pc.replace_substring_regex(b.column(0), _CUT, " ")
        found = pc.value_counts(pc.utf8_split_whitespace(text).flatten())
        for token, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
            if token and (w := word_form(token)):
                counts[w] += n
    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])


_SCHEMA = "paper_id string, page_number int, kind string, line_no int, a string, b string, c string"

_NUMBER = re.compile(r"(?:page|pagc|p\.|[-–—\[(]|seite)?\s*([0-9loi!|s]{1,5}|[ivxlcdm]{1,9})\s*(?:/\s*[0-9]{1,5})?\s*[-–—\])]?", re.I)
_DECORATED = re.compile(r"^\s*(?:page|pagc|p\.|[-–—\[(])|/", re.I)
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def _roman(s: str) -> int | None:
    vals = [_ROMAN.get(c, 0) for c in s]
    n = sum(-v if v < max(vals[i + 1 :], default=0) else v for i, v in enumerate(vals))
    names = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]
    back, rest = "", n
    for v, c in names:
        while rest >= v:
            back, rest = back + c, rest - v
    return n if back == s else None


def page_number_of(line: str) -> tuple[int, bool, bool] | None:
    """(number, whether marked as a page number, whether Roman) if the line holds one number alone."""
    s = " ".join(line.split())
    if not s or not (m := _NUMBER.fullmatch(s)):
        return None
    body, marked = m[1].lower(), bool(_DECORATED.search(s))
    if (n := _roman(body)) and not any(map(str.isdigit, body)):
        return n, marked, True
    digits = body.translate(str.maketrans({"l": "1", "i": "1", "!": "1", "|": "1", "o": "0", "s": "5"}))
    return (int(digits), marked, False) if digits.isdigit() and (marked or any(map(str.isdigit, body))) else None


_PART = r"(?:(?:page|pagc|p\.)\s*[0-9lo!]{1,5}|[-–—]\s*[0-9lo!]{1,5}\s*[-–—]|[0-9]{1,5}\s*/\s*[0-9]{1,5}|[0-9]{1,5}|[ivxlcdm]{1,9})"
_REACH = 64
_LEAD, _TAIL = re.compile(rf"^{_PART}\s{{2,}}", re.I), re.compile(rf"\s{{2,}}{_PART}$", re.I)


def header_core(line: str) -> tuple[str, str]:
    """A line without a page number at either end, and that number's text."""
    s = line.strip()
    # A number with its marks and the gap beside it lie within so many characters of an end.
    if m := _LEAD.search(s[:_REACH]):
        return s[m.end() :].strip(), m[0].strip()
    if m := _TAIL.search(s[-_REACH:]):
        return s[: len(s) - (len(m[0]))].strip(), m[0].strip()
    return s, ""


def _page_rows(frequent: set[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(paper_id, page_number, clean_text, raw_text) -> rows of kind w(ord), h(yphen), e(dge), r(aw edge)."""
        rare: dict[str, str] = {}

        def form(token: str) -> str:
            if (w := rare.get(token)) is None:
                w = word_form(token)
                w = rare[token] = "" if w in frequent else w
                if len(rare) > 500_000:
                    rare.clear()
            return w

        for b in batches:
            paper, page = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[tuple] = []
            lines = pc.split_pattern(pc.fill_null(b.column(2), ""), "\n")
            flat, parent, offsets = lines.flatten(), pc.list_parent_indices(lines).to_numpy(), lines.offsets.to_numpy()
            first = offsets[0]
            tokens = pc.utf8_split_whitespace(flat)
            words, at = tokens.flatten().dictionary_encode(), pc.list_parent_indices(tokens).to_numpy()
            forms = [form(t) for t in words.dictionary.to_pylist()]
            codes = words.indices.to_numpy()
            cut_line = pc.match_substring_regex(flat, rf"\pL[{_MARKS}]\s*$").to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(np.fromiter(map(bool, forms), bool, len(forms))[codes]) if len(codes) else []:
                i = at[k]
                last = cut_line[i] and (k + 1 == len(at) or at[k + 1] != i)
                goes_on = i > 0 and parent[i - 1] == parent[i] and cut_line[i - 1] and (k == 0 or at[k - 1] != i)
                if not last and not goes_on:
                    p = parent[i]
                    out.append((paper[p], page[p], "w", int(i - (offsets[p] - first)) + 1, forms[codes[k]], None, None))
            for i in np.flatnonzero(cut_line):
                p = parent[i]
                if i + 1 < len(flat) and parent[i + 1] == p:
                    a, nxt = (flat[int(j)].as_py().split() for j in (i, i + 1))
                    if a and nxt:
                        left, right = canonical(a[-1].rstrip(_MARKS)).lstrip(_TRIM).lower(), canonical(nxt[0]).rstrip(_TRIM).lower()
                        if left and right and right[0].isalpha():
                            out.append((paper[p], page[p], "h", int(i - (offsets[p] - first)) + 1, left, right, "" if a[-1].rstrip()[-1] == "-" else "mark"))
            for col, kind in ((2, "e"), (3, "r")):
                for p, text in enumerate(b.column(col).to_pylist()):
                    if not text:
                        continue
                    each = text.split("\n")
                    filled = [i for i, x in enumerate(each) if x.strip()]
                    for rank, i in enumerate(filled):
                        if rank < EDGE or rank >= len(filled) - EDGE:
                            line = each[i]
                            number = page_number_of(canonical(line))
                            if number:
                                out.append((paper[p], page[p], f"{kind}n", i + 1, str(number[0]), "marked" if number[1] else "roman" if number[2] else "", "edge" if rank == 0 or rank == len(filled) - 1 else ""))
                            elif kind == "e" and rank < 2 and line:
                                core, num = header_core(line)
                                out.append((paper[p], page[p], "t", i + 1, canonical(core), num, str(rank)))
            cols = list(zip(*out)) or [[]] * 7
            types = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["paper_id", "page_number", "kind", "line_no", "a", "b", "c"])

    return rows


@F.pandas_udf(T.ArrayType(T.StringType()))
def skeletons_of(words: pd.Series) -> pd.Series:
    return words.map(lambda w: None if w is None else skeletons(w))


@F.pandas_udf(T.StringType())
def _title_skeleton(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else re.sub(r"[\W_]+", "", canonical(t).lower().translate(_GLYPH_MAP)))


def _one_skeleton(word: Column) -> Column:
    return F.explode(skeletons_of(word))


class Noise:
    """The evidence gathered over all pages, and what follows from it."""

    def __init__(self, pages: DataFrame, papers: DataFrame):
        self.pages = pages.where("paper_id is not null and page_number is not null").select("paper_id", F.col("page_number").cast("int").alias("page_number"), "clean_text", "raw_text")
        text = self.pages.where("clean_text is not null").select("clean_text")
        counted = text.mapInArrow(_vocabulary, "word string, n long")
        self.vocabulary = cut(counted.groupBy("word").agg(F.sum("n").alias("n")))
        grouped = self.vocabulary.select("word", "n", _one_skeleton(F.col("word")).alias("skeleton"))
        top = grouped.groupBy("skeleton").agg(F.max(F.struct("n", "word")).alias("top"))
        both = grouped.join(top, "skeleton").where((F.col("top.word") != F.col("word")) & (F.col("top.n") >= RATIO * F.col("n")) & self._misreadable("word", "top.word"))
        self.misread = cut(both.groupBy("word").agg(F.max(F.col("top")).alias("top")).select("word", F.col("top.word").alias("right")))
        total = self.vocabulary.agg(F.sum("n")).first()[0] or 0
        sure = self.vocabulary.where(F.col("n") >= max(FREQUENT_LEAST, FREQUENT_SHARE * total)).join(self.misread, "word", "left_anti")
        frequent = {r.word for r in sure.select("word").collect()}  # at most 1 / FREQUENT_SHARE words
        self.rows = cut(self.pages.mapInArrow(_page_rows(frequent), _SCHEMA).distinct())
        self.papers = papers

    @staticmethod
    def _misreadable(word: str, right: str) -> Column:
        """Two letters can be one word's slip only with enough of the word around them."""
        w = F.col(word)
        return (F.length(w) >= 3) | w.rlike("[0-9!|$]")

    def page_numbers(self) -> DataFrame:
        n = self.rows.where("kind in ('en', 'rn')").withColumn("offset", F.col("a").cast("long") - F.col("page_number"))
        support = n.groupBy("paper_id", "offset").agg(F.count_distinct("page_number").alias("pages"))
        usual = support.groupBy("paper_id").agg(F.max(F.struct("pages", (-F.abs("offset")).alias("near"), "offset")).alias("u"))
        length = self.pages.groupBy("paper_id").agg(F.count_distinct("page_number").alias("of"))
        known = n.where("kind = 'en'").join(usual, "paper_id").join(length, "paper_id")
        # A bare number inside the page may be a table's: then half of the pages must agree.
        agreed = (F.col("u.pages") >= 2) & ((F.col("c") == "edge") | (F.col("b") != "") | (2 * F.col("u.pages") >= F.col("of")))
        fits = (F.col("offset") == F.col("u.offset")) & (agreed | (F.col("b") == "marked") | (F.col("c") == "edge") & ((F.col("b") == "roman") | (F.col("offset") == 0)))
        return known.where(fits | ((F.col("b") == "marked") & (F.col("u.pages") < 2))).select("paper_id", "page_number", "line_no").distinct()

    def headers(self) -> DataFrame:
        tops = self.rows.where("kind = 't' and a <> ''").withColumn("core", _title_skeleton(F.col("a")))
        titles = self.papers.where("paper_id is not null and title is not null").select("paper_id", _title_skeleton(F.col("title")).alias("title")).groupBy("paper_id").agg(F.collect_set("title").alias("titles"))
        known = tops.join(titles, "paper_id", "left")
        short = (F.length("core") >= 4) & F.exists(F.coalesce("titles", F.array().cast("array<string>")), lambda t: F.startswith(t, F.col("core")))
        author = F.col("core").rlike(r"^\p{L}{2,40}ctal$") & F.col("a").rlike(r"(?i)^(\S+ ){1,4}\S+$") & F.col("a").rlike(r"(?i) [ec]t a[l1!i]\.?$")
        masked = F.regexp_replace("core", "[0-9]+", "#")
        # A line that recurs at the page tops of its paper, each time beside another number.
        recurs = tops.where("b <> '' and c = '0'").groupBy("paper_id", masked.alias("masked")).agg(F.count_distinct("page_number").alias("pages"), F.count_distinct("b").alias("numbers")).where("pages >= 2 and numbers >= 2")
        beside = known.withColumn("masked", masked).join(recurs.select("paper_id", "masked", F.lit(True).alias("moving")), ["paper_id", "masked"], "left")
        moving = F.coalesce("moving", F.lit(False)) & (F.col("b") != "") & (F.col("c") == "0")
        return beside.where(short | author | moving).select("paper_id", "page_number", "line_no").distinct()

    def misread_words(self) -> DataFrame:
        """(paper_id, page_number, line_no, word, right) in running text."""
        w = self.rows.where("kind = 'w'").select("paper_id", "page_number", "line_no", F.col("a").alias("word"))
        corpus = w.join(self.misread, "word").select("paper_id", "page_number", "line_no", "word", "right")
        per_paper = w.groupBy("paper_id", "word").agg(F.count("*").alias("n")).select("paper_id", "word", "n", _one_skeleton(F.col("word")).alias("skeleton"))
        top = per_paper.groupBy("paper_id", "skeleton").agg(F.max(F.struct("n", "word")).alias("top"))
        local = per_paper.join(top, ["paper_id", "skeleton"]).where((F.col("top.word") != F.col("word")) & (F.col("top.n") >= PAPER_RATIO * F.col("n")) & self._misreadable("word", "top.word"))
        local = local.join(self.vocabulary.select("word", F.col("n").alias("all_n")), "word", "left").where(F.coalesce("all_n", F.lit(0)) <= F.col("n") + F.col("top.n"))
        named = w.join(local.groupBy("paper_id", "word").agg(F.max("top").alias("top")).select("paper_id", "word", F.col("top.word").alias("right")), ["paper_id", "word"])
        return corpus.unionByName(named.select(corpus.columns)).dropDuplicates(["paper_id", "page_number", "line_no", "word"])

    def broken_words(self) -> DataFrame:
        """(paper_id, page_number, line_no, left, right, wrong_half): a half is wrong if the joined word is misread."""
        h = self.rows.where("kind = 'h'").select("paper_id", "page_number", "line_no", F.col("a").alias("left"), F.col("b").alias("right"), F.col("c").alias("mark"), F.concat("a", "b").alias("joined"), F.concat_ws("-", "a", "b").alias("hyphened"))
        v = self.vocabulary
        counted = h.join(v.select(F.col("word").alias("joined"), F.col("n").alias("n_joined")), "joined", "left").join(v.select(F.col("word").alias("hyphened"), F.col("n").alias("n_hyphened")), "hyphened", "left")
        # A join may be a misread word, however often its misread form occurs: its skeleton's most frequent form decides.
        odd = counted.select("joined", _one_skeleton(F.col("joined")).alias("skeleton")).distinct()
        best = v.select("word", "n", _one_skeleton(F.col("word")).alias("skeleton")).join(odd, "skeleton").where("word <> joined").groupBy("joined").agg(F.max(F.struct("n", "word")).alias("top"))
        all_ = counted.join(best, "joined", "left")
        n_joined, n_hyphened = F.coalesce("n_joined", F.lit(0)), F.coalesce("n_hyphened", F.lit(0))
        broken = (n_joined > n_hyphened) | ((n_hyphened == 0) & ((F.col("mark") == "mark") | F.col("top").isNotNull() | (n_joined == 0)))
        wrong = F.when((F.col("top.n") >= RATIO * F.greatest(n_joined, F.lit(1))) & self._misreadable("joined", "top.word"), F.when(F.startswith(F.col("top.word"), F.col("left")), "right").otherwise("left"))
        return all_.where(broken).select("paper_id", "page_number", "line_no", "left", "right", wrong.alias("wrong_half"), F.col("top.word").alias("joined_right"))

    def lines(self) -> DataFrame:
        """(paper_id, page_number, line_no, kind) of every noisy line."""
        numbers = self.page_numbers().withColumn("kind", F.lit("page_number"))
        headers = self.headers().withColumn("kind", F.lit("running_header")).join(numbers.select("paper_id", "page_number", "line_no"), ["paper_id", "page_number", "line_no"], "left_anti")
        whole = cut(numbers.unionByName(headers.select(numbers.columns)))
        broken = cut(self.broken_words())
        misread = self.misread_words().select("paper_id", "page_number", "line_no").unionByName(
            broken.where("wrong_half is not null").select("paper_id", "page_number", F.when(F.col("wrong_half") == "right", F.col("line_no") + 1).otherwise(F.col("line_no")).alias("line_no"))
        ).distinct().withColumn("kind", F.lit("misread"))
        running = broken.select("paper_id", "page_number", "line_no").distinct().withColumn("kind", F.lit("broken_word")).unionByName(misread)
        running = running.join(whole.select("paper_id", "page_number", "line_no"), ["paper_id", "page_number", "line_no"], "left_anti")
        return whole.unionByName(running.select(whole.columns)).select("paper_id", "page_number", "line_no", "kind")


def noisy_lines(pages: DataFrame, papers: DataFrame) -> DataFrame:
    return Noise(pages, papers).lines()


def repaired_pages(pages: DataFrame, papers: DataFrame) -> DataFrame:
    """Every page as paragraphs of continuous text: (paper_id, page_number, text, lines_dropped).

    Headers and page numbers are dropped, misread words replaced, broken words joined, and the
    lines of a paragraph joined by spaces. Blank lines, section headings and a line that ends a
    sentence well short of the page's width end a paragraph. Windows run over one page.
    """
    noise = Noise(pages, papers)
    page = ["paper_id", "page_number"]
    dropped = noise.lines().where("kind in ('running_header', 'page_number')").groupBy(*page).agg(F.collect_set("line_no").alias("dropped"))
    broken = noise.broken_words().groupBy(*page).agg(F.collect_set("line_no").alias("broken"))
    fixes = noise.misread_words().groupBy(*page).agg(F.collect_set(F.struct("line_no", "word", "right")).alias("fixes"))
    # One shuffle of the texts, by page; all windows and the aggregation below use its partitions.
    one = noise.pages.groupBy(*page).agg(F.max("clean_text").alias("clean_text")).join(dropped, page, "left").join(broken, page, "left").join(fixes, page, "left")
    none = F.array().cast("array<int>")
    text = _fixed(F.coalesce("clean_text", F.lit("")), F.col("fixes"))
    lines = one.select(*page, F.col("clean_text").isNull().alias("null"), F.coalesce("dropped", none).alias("dropped"), F.coalesce("broken", none).alias("broken"), F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))
    marked = lines.withColumn("line", F.trim("line")).withColumn("cut", F.array_contains("broken", F.col("at") + 1)).withColumn("drop", F.array_contains("dropped", F.col("at") + 1))
    w = Window.partitionBy(*page).orderBy("at")
    kept = marked.withColumn("line", F.when(F.col("drop"), None).when(F.col("cut"), F.regexp_replace("line", rf"[{_MARKS}]\s*$", "")).otherwise(F.col("line")))
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    before, was_cut = F.last("line", ignorenulls=True).over(past), F.last(F.when(~F.col("drop"), F.col("cut")), ignorenulls=True).over(past)
    heading = F.coalesce(is_heading(F.col("line")), F.lit(False))
    seen = kept.withColumn("heading", heading).withColumn("before", before).withColumn("was_cut", was_cut).withColumn("width", F.max(F.length("line")).over(Window.partitionBy(*page)))
    after_heading = F.last(F.when(~F.col("drop"), F.col("heading")), ignorenulls=True).over(past)
    starts = F.col("before").isNull() | (F.col("before") == "") | F.col("heading") | after_heading | (F.col("before").rlike(r"[.!?]$") & (F.length("before") < 0.6 * F.col("width")))
    joint = F.when(starts, "\n\n").when(F.col("was_cut"), "").otherwise(" ")
    pieces = seen.withColumn("piece", F.when(F.coalesce(F.col("line"), F.lit("")) != "", F.concat(joint, F.col("line"))).otherwise(""))
    whole = pieces.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("parts"), F.first("null").alias("null"), F.sum(F.col("drop").cast("long")).alias("lines_dropped"))
    joined = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p.piece), ""), r"^\n+", "")
    return whole.select(*page, F.when(~F.col("null"), joined).alias("text"), "lines_dropped")


def _fixed(text: Column, fixes: Column) -> Column:
    """A page with its misread words replaced, on the lines where they stand."""

    @F.pandas_udf(T.StringType())
    def apply(texts: pd.Series, fixes: pd.Series) -> pd.Series:
        def one(page, pairs):
            if page is None or pairs is None:
                return page
            lines = page.split("\n")
            by_line: dict[int, dict[str, str]] = {}
            for p in pairs:
                by_line.setdefault(p["line_no"] - 1, {})[p["word"]] = p["right"]

            def word(m: re.Match, right: dict[str, str]) -> str:
                form = word_form(m[0])
                if form not in right:
                    return m[0]
                core, new = m[0].strip(_TRIM), right[form]
                new = new.upper() if core.isupper() and len(core) > 1 else new[:1].upper() + new[1:] if core[:1].isupper() else new
                return m[0].replace(core, new, 1)

            for i, right in by_line.items():
                if i < len(lines):
                    lines[i] = re.sub(r"\S+", lambda m: word(m, right), lines[i])
            return "\n".join(lines)

        return pd.Series([one(a, b) for a, b in zip(texts, fixes)])

    return F.when(fixes.isNull(), text).otherwise(apply(F.when(fixes.isNotNull(), text), fixes))

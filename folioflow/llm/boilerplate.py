"""Lines that recur across the documents of one source, found as repeated blocks and removed.

Per source the lines of all pages are identifiers in one long sequence, cut at page ends and at
lines too short to count. The *suffix array* over it, a range sort of all suffixes, puts equal
beginnings next to each other, and the common prefix of neighbours says how long a repeated block
is. A block of n lines is a range of the array whose neighbours have at least n lines in common; it
goes if enough papers lie in its range. Nothing but these ranges decides which lines are repeated.

* The sort is by the suffix alone: a line's identifier holds its source. A source or a notice that
  a third of all pages share spreads over as many partitions as its rows need.
* Inside a partition the common prefixes are computed with numpy over all rows at once, as deep as
  rows agree, without a limit. Ranges that end inside the partition are counted there.
* Ranges that cross into a neighbouring partition are *open*. What the driver gets of each partition is
  its first and last suffix and the lengths at which its prefixes shrink seen from both ends (as many as
  a page has lines); from that it tells every partition which open ranges it lies in. Their papers
  are counted over all partitions, and the blocks that span enough of them (at most a few for each
  boundary between partitions) go back.
* Every line of a block begins a suffix that shares the rest of the block, so marking the first line
  of every block marks all of its lines.

Pages without text, without a paper or of a paper without a venue have no cases; they come out of
``strip_pages`` as they are. Repeated pages count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.unicode_form import LOOKALIKES
from folioflow.session import cut

MIN_CHARS, MIN_PAPERS, MIN_SHARE = 25, 5, 0.2

_WIDE = "".join(chr(0xFF21 + i) for i in range(26)) + "".join(chr(0xFF41 + i) for i in range(26))
_LATIN = "".join(chr(65 + i) for i in range(26)) + "".join(chr(97 + i) for i in range(26))


def line_key(line: Column) -> Column:
    """Equal for lines that agree apart from digits, case, spaces, punctuation and invisible marks."""
    same = F.translate(line, _WIDE + "".join(LOOKALIKES), _LATIN + "".join(LOOKALIKES.values()))
    return F.regexp_replace(F.lower(same), r"[^\p{L}\p{M}]+", "")


def page_lines(pages: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per page version: the keys of its lines in order, null for lines too short to count."""
    def key_of(line: Column) -> Column:
        key = line_key(line)
        return F.when((F.length(F.regexp_replace(line, r"^(?U)\s+|(?U)\s+$", "")) >= min_chars) & (key != ""), F.xxhash64(key, F.length(key)))

    kept = pages.where("clean_text is not null and paper_id is not null and page_number is not null")
    return kept.select("paper_id", "page_number", F.xxhash64("clean_text").alias("version"), F.transform(F.split("clean_text", "\n", -1), key_of).alias("ids")).dropDuplicates(["paper_id", "page_number", "version"])


_SUFFIX = "page long, paper long, needed int, line_no int, suffix array<long>"


def _ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``values`` that begin at ``starts``, one after another."""
    ends = np.cumsum(lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page, paper, needed, ids) -> a row for every suffix: a line and those after it up to the next gap."""
    for b in batches:
        lists = b.column(3)
        flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        there = flat.is_valid().to_numpy(zero_copy_only=False)
        values = flat.fill_null(0).to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(b.num_rows), np.diff(offsets))
        # The end of a run of lines: the next gap or the end of the page.
        ends = np.where(there, offsets[1:][of], np.arange(len(values)))
        gap = np.where(there, np.iinfo(np.int64).max, np.arange(len(values)))
        ends = np.minimum(ends, np.minimum.accumulate(gap[::-1])[::-1])
        at = np.flatnonzero(there)
        step = 20_000
        for s in range(0, len(at), step):
            i = at[s : s + step]
            n = ends[i] - i
            suffix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(_ragged(values, i, n)))
            row = pa.array(of[i])
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), b.column(2).take(row), pa.array(i - offsets[of[i]] + 1, pa.int32()), suffix], names=["page", "paper", "needed", "line_no", "suffix"])


def _common(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many first numbers each slice has in common with the one before it; 0 for the first."""
    out = np.zeros(len(starts), dtype=np.int32)
    live, depth = np.arange(1, len(starts)), 0
    while len(live):
        live = live[(lengths[live] > depth) & (lengths[live - 1] > depth)]
        live = live[values[starts[live] + depth] == values[starts[live - 1] + depth]]
        depth += 1
        out[live] = depth
    return out


def _ranges(common: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, n) of every maximal range of rows whose neighbours share n > 0 numbers; inner ranges first.

    ``common`` of the first row is not looked at.
    """
    out, stack = [], []
    for i in range(1, len(common) + 1):
        c, begin = (int(common[i]) if i < len(common) else 0), i - 1
        while stack and stack[-1][1] > c:
            begin, n = stack.pop()
            out.append((begin, i, n))
        if c and (not stack or stack[-1][1] < c):
            stack.append((begin, c))
    return out


def _profile(common: np.ndarray) -> list[int]:
    """The values at which the running minimum shrinks."""
    low = np.minimum.accumulate(common)
    return low[np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))].tolist() if len(low) else []


_SORTED = "part int, page long, paper long, needed int, line_no int, common int, block int, first array<long>, last array<long>, left array<int>, right array<int>"


def _papers_in(paper: np.ndarray, begin: int, end: int, before: np.ndarray) -> int:
    """Distinct papers in a range; ``before`` has the row of the same paper's last line before each row."""
    return int((before[begin:end] < begin).sum())


def _last_seen(paper: np.ndarray) -> np.ndarray:
    order = np.argsort(paper, kind="stable")
    out = np.full(len(paper), -1)
    again = paper[order[1:]] == paper[order[:-1]]
    out[order[1:][again]] = order[:-1][again]
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes of a partition -> its repeated lines and what its neighbours need.

    A row with ``block`` is a line whose longest block that spans enough papers has so many lines.
    Other rows share their first line with the partition's first or last row: their ranges may go on in the
    next partition. The row without a page has the first and last suffix and the profiles.
    """
    part = TaskContext.get().partitionId()
    columns, commons, first, last = [], [], None, None
    for b in batches:
        if not b.num_rows:
            continue
        lists = b.column(4)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values, lengths, starts = lists.flatten().to_numpy(), np.diff(offsets), offsets[:-1] - offsets[0]
        if first is None:
            first, held = values[: lengths[0]].copy(), np.zeros(0, np.int64)
        # The row before this batch goes first.
        commons.append(_common(np.concatenate([held, values]), np.concatenate([[0], starts + len(held)]), np.concatenate([[len(held)], lengths]))[1:])
        held = last = values[starts[-1] :].copy()
        columns.append([b.column(i).to_numpy() for i in range(4)])
    if first is None:
        return
    page, paper, needed, line = (np.concatenate([c[i] for c in columns]) for i in range(4))
    common = np.concatenate(commons)
    n = len(common)
    groups = np.append(np.flatnonzero(common == 0), n)  # where another first line begins
    inner = [(s, e) for s, e in zip(groups[1:-2], groups[2:-1]) if e - s >= needed[s]]
    block = np.zeros(n, np.int32)
    for s, e in inner:
        before = _last_seen(paper[s:e])
        for begin, end, k in _ranges(common[s:e]):
            if end - begin >= needed[s] and _papers_in(paper[s:e], begin, end, before) >= needed[s]:
                block[s + begin : s + end] = np.maximum(block[s + begin : s + end], k)
    edge = np.zeros(n, bool)
    edge[: groups[1]] = edge[groups[-2] :] = True
    rows = np.flatnonzero((block > 0) | edge)
    told = np.where(edge, 0, block)
    none = pa.nulls(len(rows), pa.list_(pa.int64())), pa.nulls(len(rows), pa.list_(pa.int32()))
    names = [c.split()[0] for c in _SORTED.split(", ")]
    kinds = pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()
    cols = np.full(n, part), page, paper, needed, line, common, told
    yield pa.RecordBatch.from_arrays([*(pa.array(c[rows], t) for c, t in zip(cols, kinds)), none[0], none[0], none[1], none[1]], names=names)
    ends = (first.tolist(), last.tolist()), (_profile(common[1:]), _profile(common[1:][::-1]))
    one = [part, None, None, None, None, None, None, *ends[0], *ends[1]]
    lists = pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())
    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(one, (*kinds, *lists))], names=names)


def _open_lengths(parts: list) -> dict[int, tuple[list[int], list[int]]]:
    """Of each partition the lengths of the blocks that may go on over its left and its right end.

    ``parts`` are the partitions in order with ``first``, ``last``, ``left`` and ``right``. Going away from
    an end, the common prefix with it can only shrink; every length it takes is one of a range.
    """
    def shared(a: list[int], b: list[int]) -> int:
        same = [x == y for x, y in zip(a, b)]
        return same.index(False) if False in same else len(same)

    border = [shared(a.last, b.first) for a, b in zip(parts, parts[1:])]

    def beyond(k: int, step: int) -> list[int]:
        out, low, at = set(), None, k
        while 0 <= at + step < len(parts):
            over = border[at] if step > 0 else border[at - 1]
            low = over if low is None else min(low, over)
            at += step
            for n in (low, *(parts[at].left if step > 0 else parts[at].right)):
                low = min(low, n)
                out.add(low)
            if not low:
                break
        return sorted(out - {0})

    return {p.part: (beyond(k, -1), beyond(k, 1)) for k, p in enumerate(parts)}


def _resolve(parts: dict[int, tuple]):
    """Rows at the ends of partitions -> (page, line_no, block), and for open ranges (range, n, paper, needed) besides.

    ``parts`` has (first suffix, last suffix, open lengths at the left, at the right).
    """
    import hashlib

    def name(suffix: list[int], n: int) -> bytes:
        return hashlib.md5(np.array(suffix[:n], dtype=np.int64).tobytes()).digest()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(7)] for b in batches if b.num_rows]
        if not got:
            return
        part, page, paper, needed, line, common, told = (np.concatenate([g[i] for g in got]) for i in range(7))
        first, last, left, right = parts[int(part[0])]
        out: list[list[np.ndarray]] = [[] for _ in range(6)]

        def put(rows: np.ndarray, block: np.ndarray | int, range_: bytes | None) -> None:
            k = len(rows)
            for col, x in zip(out, (page[rows], line[rows], np.broadcast_to(block, k), np.full(k, range_, dtype=object), paper[rows], needed[rows])):
                col.append(x)

        done = np.flatnonzero(told > 0)
        put(done, told[done], None)
        edge = np.flatnonzero(told == 0)
        starts = np.append(np.flatnonzero((common[edge] == 0) | (np.arange(len(edge)) == 0)), len(edge))
        for g, (s, e) in enumerate(zip(starts, starts[1:])):
            rows = edge[s:e]
            own, least = common[rows], int(needed[rows[0]])
            at_left, at_right = g == 0 and bool(left), g == len(starts) - 2 and bool(right)
            open_ = {}
            for suffix, lengths, on, low in ((first, left, at_left, np.minimum.accumulate(np.concatenate([[len(first)], own[1:]]))), (last, right, at_right, np.minimum.accumulate(np.concatenate([own[1:], [len(last)]])[::-1])[::-1])):
                if on:
                    for n in sorted({*lengths, *(int(x) for x in np.unique(low) if 0 < x <= max(lengths))}):
                        open_.setdefault(name(suffix, n), (n, []))[1].append(np.flatnonzero(low >= n))
            for range_, (n, at) in open_.items():
                put(rows[np.unique(np.concatenate(at))], n, range_)
            before, block = _last_seen(paper[rows]), np.zeros(len(rows), np.int32)
            for begin, end, n in _ranges(own):
                goes_on = begin == 0 and at_left and n <= max(left) or end == len(rows) and at_right and n <= max(right)
                if not goes_on and end - begin >= least and _papers_in(paper[rows], begin, end, before) >= least:
                    block[begin:end] = np.maximum(block[begin:end], n)
            put(rows[block > 0], block[block > 0], None)
        kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32()
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(out, kinds)], names=["page", "line_no", "block", "range", "paper", "needed"])

    return resolve


def suffix_array(pages: DataFrame, papers: DataFrame, min_papers: int = MIN_PAPERS, min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(pages with a number, their suffixes (page, paper, needed, line_no, suffix), sorted over all partitions)."""
    venues = papers.where("venue is not null and paper_id is not null").select("paper_id", "venue").distinct()
    enough = F.ceil(F.greatest(F.lit(min_papers).cast("double"), F.col("papers_of_venue") * min_share)).cast("int")
    needed = venues.groupBy("venue").agg(F.count_distinct("paper_id").alias("papers_of_venue")).select("venue", enough.alias("needed"))
    listed = page_lines(pages).join(venues.join(needed, "venue"), "paper_id")
    numbered = cut(listed.withColumn("page", F.monotonically_increasing_id()))
    ids = F.transform("ids", lambda x: F.when(x.isNotNull(), F.xxhash64("venue", x)))
    rows = numbered.select("page", F.xxhash64("paper_id").alias("paper"), "needed", ids.alias("ids")).mapInArrow(_suffixes, _SUFFIX)
    return numbered.select("page", "paper_id", "page_number", "version"), rows.repartitionByRange("suffix", "page", "line_no").sortWithinPartitions("suffix", "page", "line_no")


def repeated_blocks(suffixes: DataFrame) -> DataFrame:
    """Sorted suffixes -> (page, line_no, block): the first lines of all blocks that span enough papers, and their lengths."""
    scanned = cut(suffixes.mapInArrow(_scan, _SORTED))
    ends = sorted(scanned.where("page is null").select("part", "first", "last", "left", "right").collect(), key=lambda p: p.part)  # a row per partition
    lengths = _open_lengths(ends)
    parts = {p.part: (p.first, p.last, *lengths[p.part]) for p in ends}
    found = scanned.where("page is not null").drop("first", "last", "left", "right").mapInArrow(_resolve(parts), "page long, line_no int, block int, range binary, paper long, needed int")
    if not any(a or b for a, b in lengths.values()):
        return found.select("page", "line_no", "block").groupBy("page", "line_no").agg(F.max("block").alias("block"))
    found = cut(found)
    spans = found.where("range is not null").select("range", "paper", "needed").distinct().groupBy("range", "needed").agg(F.count("*").alias("papers")).where("papers >= needed").select("range")
    sure = F.broadcast(spans)  # at most the open lengths of each boundary between partitions
    across = found.where("range is not null").join(sure, "range", "left_semi")
    return found.where("range is null").unionByName(across).groupBy("page", "line_no").agg(F.max("block").alias("block"))


def repeated_lines(pages: DataFrame, papers: DataFrame, **limits) -> DataFrame:
    """(paper_id, page_number, version, line_no, block) of every line in a block that spans enough papers."""
    numbered, suffixes = suffix_array(pages, papers, **limits)
    return repeated_blocks(suffixes).join(numbered, "page").select("paper_id", "page_number", "version", "line_no", "block")


def strip_pages(pages: DataFrame, papers: DataFrame, **limits) -> DataFrame:
    """Every page with its text without the repeated lines, and how many were removed."""
    cols = pages.select("paper_id", "page_number", "clean_text").distinct().withColumn("version", F.xxhash64("clean_text"))
    gone = repeated_lines(pages, papers, **limits).groupBy("paper_id", "page_number", "version").agg(F.collect_set("line_no").alias("gone"))
    kept = F.array_join(F.filter(F.split("clean_text", "\n", -1), lambda x, i: ~F.array_contains(F.col("gone"), i + 1)), "\n")
    both = cols.join(gone, ["paper_id", "page_number", "version"], "left")
    return both.select("paper_id", "page_number", F.when(F.col("gone").isNull(), F.col("clean_text")).otherwise(kept).alias("clean_text"), F.coalesce(F.size("gone"), F.lit(0)).alias("lines_removed"))

"""Filling containers of a fixed capacity with texts of varying length.

Texts of one length are interchangeable, so the packing is solved on the histogram of lengths: at
most ``capacity`` numbers, however many texts there are. Bin completion fills one container after
another around the longest remaining length: undominated fillings of the rest are enumerated, the
chosen one is repeated as often as the counts allow, branches whose waste leaves no chance to beat
the best packing so far are cut, and best-fit decreasing is the first incumbent. The search ends
when it meets the lower bound (no packing uses fewer containers), its budget of nodes or the last
branch; the best packing is returned either way, so no text is ever left out. The enumeration is not
complete: a container has at most ``FILLINGS`` ways, from the first 64 fillings found in 400 steps
over 24 lengths a level. Above the lower bound the packing may hence use more containers than needed.

Texts then find their container by their rank among texts of their length. Ranks are counted in
salted parts, so a length that a third of all texts share is no single task.

A text longer than the capacity is cut into full containers and a remainder, which is packed like
any other. Texts without tokens (null, empty) take no room: they come out with size 0 and no container. Duplicated
``doc_id`` are separate texts only if the rows differ in number; equal keys are ordered arbitrarily.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import cut

CAPACITY, NODES, FILLINGS = 2048, 20_000, 4
#: Texts of one length in a part whose ranks are counted in one task.
PART = 1 << 20

Pattern = tuple[tuple[int, int], ...]


def dominates(a: list[int], b: list[int]) -> bool:
    """Whether the lengths ``b`` fit into holes of the lengths ``a``: then ``a`` is never the worse filling."""
    b = sorted(b, reverse=True)

    def place(i: int, holes: list[int]) -> bool:
        if i == len(b):
            return True
        tried = set()
        for k, h in enumerate(holes):
            if h >= b[i] and h not in tried:
                tried.add(h)
                if place(i + 1, [*holes[:k], h - b[i], *holes[k + 1 :]]):
                    return True
        return False

    return len(b) <= 8 and place(0, list(a))


def fillings(gap: int, counts: list[int], sizes: list[int], most: int = FILLINGS, nodes: int = 400) -> list[list[int]]:
    """Up to ``most`` undominated ways to fill ``gap`` from the lengths left, least waste first.

    ``sizes`` are the lengths left, ascending. One length that fits exactly dominates everything.
    """
    found: list[tuple[int, list[int]]] = []
    seen = 0

    def search(left: int, last: int, chosen: list[int]) -> bool:
        """True as soon as nothing is wasted."""
        nonlocal seen
        seen += 1
        if left <= last and left and counts[left] - chosen.count(left) > 0:
            found.append((0, [*chosen, left]))
            return True
        top = bisect_right(sizes, min(left, last))
        any_fits = False
        tries = 0
        for k in range(top - 1, -1, -1):
            s = sizes[k]
            if counts[s] - chosen.count(s) <= 0:
                continue
            any_fits = True
            if seen >= nodes or tries >= 24:
                break
            tries += 1
            if search(left - s, s, [*chosen, s]):
                return True
        if not any_fits:
            found.append((left, chosen))
        return False

    if gap:
        search(gap, gap, [])
    else:
        found.append((0, []))
    found.sort(key=lambda f: (f[0], len(f[1])))
    kept: list[list[int]] = []
    for _, f in found[:64]:
        if len(kept) < most and not any(dominates(k, f) for k in kept):
            kept.append(f)
    return kept or [[]]


def _pattern(longest: int, filling: list[int]) -> Pattern:
    items = [longest, *filling]
    return tuple((s, items.count(s)) for s in sorted(set(items), reverse=True))


def best_fit(hist: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, equal containers taken together."""
    open_: dict[int, dict[Pattern, int]] = {}  # room left -> contents -> how many
    rooms: list[int] = []
    for size in sorted(hist, reverse=True):
        left = hist[size]
        while left:
            k = bisect_right(rooms, size - 1)
            if k < len(rooms):
                room = rooms[k]
                content, n = next(iter(open_[room].items()))
            else:
                room, content, n = capacity, (), left // (capacity // size) or 1
            each = min(room // size, left)
            n = min(n, left // each)
            if content or room != capacity:
                open_[room][content] -= n
                if not open_[room][content]:
                    del open_[room][content]
                    if not open_[room]:
                        del open_[room]
                        rooms.remove(room)
            new, rest = (*content, (size, each)), room - each * size
            if rest not in open_:
                rooms.insert(bisect_right(rooms, rest), rest)
            open_.setdefault(rest, {})[new] = open_.get(rest, {}).get(new, 0) + n
            left -= n * each
    return [(content, n) for group in open_.values() for content, n in group.items()]


def plan(hist: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Containers as (pattern of (length, how many), how often), covering the histogram exactly."""
    hist = {s: n for s, n in hist.items() if n > 0}
    if not hist:
        return []
    total = sum(s * n for s, n in hist.items())
    least = -(-total // capacity)
    best = best_fit(hist, capacity)
    bins = sum(n for _, n in best)
    counts = [0] * (capacity + 1)
    for s, n in hist.items():
        counts[s] = n
    sizes = sorted(hist)
    # A frame: the ways to fill the next container, the next way to try, what the last try took.
    frames: list[list] = []
    waste = made = used = 0

    def take(pattern: Pattern, n: int) -> None:
        for s, k in pattern:
            counts[s] -= k * n
            if not counts[s]:
                sizes.remove(s)

    def give(pattern: Pattern, n: int) -> None:
        for s, k in pattern:
            if not counts[s]:
                sizes.insert(bisect_right(sizes, s), s)
            counts[s] += k * n

    def frame() -> list:
        longest = sizes[-1]
        counts[longest] -= 1
        ways = fillings(capacity - longest, counts, sizes)
        counts[longest] += 1
        return [[_pattern(longest, w) for w in ways], 0, None]

    frames.append(frame())
    while frames and bins > least and used < nodes:
        f = frames[-1]
        if f[2]:
            pattern, n = f[2]
            give(pattern, n)
            made -= n
            waste -= n * (capacity - sum(s * k for s, k in pattern))
            f[2] = None
        if f[1] == len(f[0]):
            frames.pop()
            continue
        pattern = f[0][f[1]]
        f[1] += 1
        used += 1
        n = min(counts[s] // k for s, k in pattern)
        spare = capacity - sum(s * k for s, k in pattern)
        if waste + n * spare > (bins - 1) * capacity - total:
            n = min(n, max(0, ((bins - 1) * capacity - total - waste) // spare)) if spare else n
            if not n:
                continue
        take(pattern, n)
        made, waste, f[2] = made + n, waste + n * spare, (pattern, n)
        if sizes:
            frames.append(frame())
        elif made < bins:
            bins, best = made, [g[2] for g in frames]
    return best


def items(counted: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, tokens) -> (doc_id, piece, first_token, size): a piece a text, more only beyond the capacity."""
    pieces = counted.where("tokens > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / capacity).cast("int"))))
    first = F.col("piece").cast("long") * capacity
    return pieces.select("doc_id", "piece", first.alias("first_token"), F.least(F.col("tokens") - first, F.lit(capacity)).cast("int").alias("size"))


def _assign(patterns: list[tuple[Pattern, int]], capacity: int):
    rows, base, used = [], 0, {}
    for pattern, n in patterns:
        for s, k in pattern:
            start = used.get(s, 0)
            rows.append((s, start, base, k))
            used[s] = start + k * n
        base += n
    rows.sort()
    wide = 1 << 48
    key = np.array([s * wide + a for s, a, _, _ in rows], dtype=np.int64)
    start, first, per = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, piece, first_token, size, rank) -> the same with the container instead of the rank."""
        for b in batches:
            size, rank = b.column(3).to_numpy().astype(np.int64), b.column(4).to_numpy()
            at = np.searchsorted(key, size * wide + rank, side="right") - 1
            container = first[at] + (rank - start[at]) // per[at]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(container)], names=["doc_id", "piece", "first_token", "size", "container"])

    return assign


def pack(counted: DataFrame, capacity: int = CAPACITY, nodes: int = NODES, part: int = PART) -> DataFrame:
    """(doc_id, tokens) -> (doc_id, piece, first_token, size, container)."""
    counted = cut(counted.select("doc_id", "tokens"))
    all_ = items(counted, capacity)
    hist = {r.size: r.n for r in all_.groupBy("size").agg(F.count("*").alias("n")).withColumnRenamed("size", "size").toLocalIterator()}  # at most `capacity` rows
    patterns = plan(hist, capacity, nodes)
    salts = max(1, -(-max(hist.values(), default=1) // part))
    salted = all_.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sums = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("size", "salt", before.alias("before"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "piece"))).join(offsets, ["size", "salt"])
    ranked = ranked.select("doc_id", "piece", "first_token", "size", (F.col("before") + F.col("r") - 1).cast("long").alias("rank"))
    schema = f"doc_id {all_.schema['doc_id'].dataType.simpleString()}, piece int, first_token long, size int, container long"
    placed = ranked.mapInArrow(_assign(patterns, capacity), schema)
    empty = counted.where("tokens is null or tokens <= 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("first_token"), F.lit(0).alias("size"), F.lit(None).cast("long").alias("container"))
    return placed.unionByName(empty)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every container with its number of texts, its tokens and its unused room."""
    return packed.where("container is not null").groupBy("container").agg(F.count("*").alias("texts"), F.sum("size").alias("tokens"), (F.lit(capacity) - F.sum("size")).alias("unused"))

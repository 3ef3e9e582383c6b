import itertools
import random
from collections import Counter

import pytest

from folioflow.llm import mixing as M
from folioflow.llm import packing as P
from folioflow.llm import tokens as K
from tests.llm import helpers as H


def least_bins(sizes, capacity):
    """The optimum by trying everything."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] >= sizes[i]:
                go(i + 1, [*bins[:k], bins[k] - sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, capacity - sizes[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_plans_are_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 37])
    hist = Counter(rng.randrange(1, capacity + 1) for _ in range(rng.randrange(0, 10)))
    plan = P.plan(hist, capacity)
    used = Counter()
    for pattern, n in plan:
        assert sum(s * k for s, k in pattern) <= capacity and n > 0
        for s, k in pattern:
            used[s] += k * n
    assert used == hist and sum(n for _, n in plan) == least_bins(hist.elements(), capacity)


def test_plans_cover_large_counts_quickly():
    rng = random.Random(1)
    hist = {rng.randrange(1, 2000): rng.randrange(1, 10**9) for _ in range(1500)}
    for plan in (P.plan(hist, 2048), P.best_fit(hist, 2048)):
        used = Counter()
        for pattern, n in plan:
            assert sum(s * k for s, k in pattern) <= 2048
            for s, k in pattern:
                used[s] += k * n
        assert used == hist
    total = sum(s * n for s, n in hist.items())
    assert sum(n for _, n in P.plan(hist, 2048)) <= 1.02 * total / 2048


def test_dominance():
    assert P.dominates([5], [3, 2]) and P.dominates([5, 4], [4, 3, 1]) and not P.dominates([4, 4], [5]) and P.dominates([3], [3])


def test_every_text_is_placed_once_and_whole(spark):
    rng = random.Random(2)
    sizes = {i: rng.choice([0, 7, 7, 7, rng.randrange(1, 60), 250]) for i in range(600)} | {1000: 100, 1001: 99, 1002: 1}
    df = H.clash(spark.createDataFrame([*sizes.items(), (2000, None)], "doc_id long, tokens long"))
    for part in (1 << 20, 16):  # ranks counted in one part or in many
        rows = P.pack(df, capacity=100, part=part).collect()
        pieces: dict = {}
        load: Counter = Counter()
        for r in rows:
            if r.container is not None:
                pieces.setdefault(r.doc_id, []).append((r.first_token, r.size))
                load[r.container] += r.size
        assert sorted(r.doc_id for r in rows if r.container is None) == sorted([2000, *(d for d, n in sizes.items() if not n)])
        assert max(load.values()) <= 100 and sorted(load) == list(range(len(load)))
        for d, n in sizes.items():
            got = sorted(pieces.get(d, []))
            assert sum(s for _, s in got) == n and len(got) == (0 if not n else 1 if n <= 100 else -(-n // 100))
            assert [f for f, _ in got] == list(itertools.accumulate([0, *(s for _, s in got)]))[: len(got)]
        assert len(load) == -(-sum(sizes.values()) // 100)
    f = P.fill(P.pack(df, capacity=100), 100).collect()
    assert sum(r.tokens for r in f) == sum(sizes.values()) and all(r.unused == 100 - r.tokens for r in f)
    assert P.pack(df.limit(0), 100).count() == 0


def test_token_counts(spark):
    enc = K.encoding()
    texts = ["plain words", "<|endoftext|> is text", "", None, "naïve café 東京", "word " * 50_000]
    df = H.clash(spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], H.DOCUMENTS).drop("tokens"))
    got = {r.doc_id: r.tokens for r in K.token_counts(df, ["doc_id"]).collect()}
    assert got == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert all(enc.decode(enc.encode_ordinary(t)) == t for t in texts if t)


def counted(spark, spec):
    rng = random.Random(3)
    rows = [(f"{s}{i}", s, rng.randrange(1, 40)) for s, n in spec.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, source string, tokens long")


TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.15, 4), ("none", 0.05, 3)]


def test_shares_are_met_within_repeats(spark):
    c, t = counted(spark, {"a": 900, "b": 500, "c": 80, "other": 50}), H.clash(spark.createDataFrame([*TARGETS, TARGETS[0], (None, 0.1, 1)], H.TARGETS))
    used = M.mixed(c, t)
    rows = {r.source: r for r in M.shares(used, c, t).collect()}
    for s, share, most in TARGETS[:3]:
        assert abs(rows[s].actual_share - share / 0.95) < 0.005 and rows[s].most_repeats <= most
    assert rows["none"].used_tokens == 0 and set(rows) == {"a", "b", "c", "none"}
    assert any(rows[s].used_tokens >= 0.99 * rows[s].available_tokens * rows[s].max_repeats for s in "abc")  # the total is as large as it can be
    times = {r.doc_id: r.times for r in used.collect()}
    assert all(1 <= n <= {"a": 1, "b": 2, "c": 4}[d[0]] for d, n in times.items())
    each = M.repeated(used).collect()
    assert Counter(r.doc_id for r in each) == times and len({(r.doc_id, r.epoch) for r in each}) == len(each)


def test_a_given_total_and_a_source_that_is_short(spark):
    c, t = counted(spark, {"a": 900, "b": 500, "c": 5}), spark.createDataFrame(TARGETS, H.TARGETS)
    rows = {r.source: r for r in M.shares(M.mixed(c, t, total=10_000), c, t).collect()}
    assert rows["c"].used_tokens == 4 * rows["c"].available_tokens < 0.15 * 10_000
    assert abs(rows["a"].used_tokens - 10_000 * 0.5 / 0.95) < 25


def test_mixing_bad_rows(spark):
    c = H.clash(spark.createDataFrame([("x", "a", 0), ("y", None, 5), ("z", "a", None), ("w", "q", 5)], "doc_id string, source string, tokens long"))
    t = spark.createDataFrame([("a", 0.5, 1), ("q", None, 1), ("r", 0.2, None), ("s", 0.0, 1), ("t", -1.0, 1)], H.TARGETS)
    assert M.mixed(c, t).count() == 0 and M.shares(M.mixed(c, t), c, t).count() == 5
    assert M.mixed(c.limit(0), t.limit(0)).count() == 0


def test_hash_order_is_the_same_every_time(spark):
    c, t = counted(spark, {"a": 300, "b": 300}), spark.createDataFrame(TARGETS, H.TARGETS)
    one, two = ({tuple(r) for r in M.mixed(c.repartition(n), t).collect()} for n in (2, 5))
    assert one == two

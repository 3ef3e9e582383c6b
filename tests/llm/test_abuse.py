import random

import numpy as np
import pytest

from folioflow.llm import abuse as A
from tests.llm import helpers as H

WORDS = "corpus parser retriever annotation letters minutes blogs training signals method reads yields compares several results table figure quietly often".split()
BAD = ["you are a pathetic gronk and nobody wants you here", "shut up you filthy gronk or i will smash you", "all zorbians are vermin and must go", "what a load of trash from a filthy gronk like you"]
STUDY = ["the lexicon lists words such as 'gronk' and 'filthy' for raters", "posts against zorbians were marked by three raters"]


def corpus(n=500, seed=0):
    rng = random.Random(seed)
    rows, truth = [], []
    for i in range(n):
        s = [" ".join(rng.choices(WORDS, k=rng.randrange(8, 16))) for _ in range(rng.randrange(1, 6))]
        bad = rng.random() < 0.3
        if bad:
            s.insert(rng.randrange(len(s) + 1), rng.choice(BAD))
        elif rng.random() < 0.3:
            s.insert(rng.randrange(len(s) + 1), rng.choice(STUDY))
        rows.append(". ".join(s) + ".")
        truth.append(bad)
    return rows, truth


@pytest.mark.parametrize("text, want", [("d.u.m.b", "dumb"), ("f i l t h y", "filthy"), ("u-g-l-y", "ugly"), ("Gr0nk", "gronk"), ("grooooonk", "gronk"), ("Gr@nk", "grank"), ("gr#nk", "gr*nk"), ("naïve", "naive"), ("1234", "0")])
def test_disguises(text, want):
    assert [A.squeezed(t) for t in A.tokens(text)] == [want]


def test_windows_cover_every_token():
    for n in (0, 1, A.WINDOW, A.WINDOW + 1, 1000):
        w = A.windows(n)
        assert {i for s in w for i in range(s, min(n, s + A.WINDOW))} == set(range(n))
        assert all(b - a <= A.STRIDE for a, b in zip(w, w[1:]))


def test_gradients_against_differences():
    rng, vocabulary, net = np.random.default_rng(1), A.Vocabulary(), A.Network()
    ids = np.array([w for t in corpus(4)[0] for w in A.cut_windows(vocabulary.add(A.tokens(t)))][:6])
    word, grams = vocabulary.arrays()
    y = np.array([1, 0, 1, 0, 1, 0.0][: len(ids)])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def loss():
        p = net.forward(np.concatenate([net.w["word"][word], grams.mean(net.w["gram"])], axis=1), ids)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grad = net.gradients(word, grams, ids, y)
    for name in ("Wf", "Ub", "cf", "Wa", "va", "wo", "bo"):
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in net.w[name].shape)
            kept = net.w[name][at]
            net.w[name][at] = kept + 1e-4
            up = loss()
            net.w[name][at] = kept - 1e-4
            down = loss()
            net.w[name][at] = kept
            assert abs((up - down) / 2e-4 - grad[name][at]) < 1e-3 * max(1e-2, abs(grad[name][at])) + 1e-6


def test_long_words_keep_all_their_sequences():
    word = "rechtsschutzversicherungsgesellschaftenverband"
    _, grams = A.features(word)
    assert len(grams) == len(set(word_grams(word))) > 60
    table = np.random.default_rng(0).normal(size=(A.GRAMS, 5)).astype(np.float32)
    lists = [[], grams, [3], [], [7, 9, 9]]
    got = A.Grams.of(lists)
    want = np.array([table[g].mean(0) if g else np.zeros(5) for g in lists])
    assert np.allclose(got.mean(table), want, atol=1e-6)
    assert np.allclose(got.take(np.array([4, 0, 1, 1])).mean(table), want[[4, 0, 1, 1]], atol=1e-6)


def word_grams(word):
    edge = f"<{word}>"
    return [edge[i : i + n] for n in (3, 4) for i in range(len(edge) - n + 1)] + [edge]


def test_screened_windows_score_like_all_networks_where_it_matters():
    rng, nets = np.random.default_rng(2), [A.Network(seed=k) for k in range(3)]
    x, ids = [rng.normal(size=(50, A.WORD_DIM + A.CHAR_DIM)).astype(np.float32) for _ in nets], rng.integers(1, 50, size=(40, A.WINDOW))
    each = np.array([A._score_windows(n, v, ids) for n, v in zip(nets, x)])
    got = A.judged(nets, x, ids, screen=float(np.median(each[0])))
    doubt = each[0] >= np.median(each[0])
    assert np.allclose(got[doubt], each.mean(0)[doubt]) and np.allclose(got[~doubt], each[0][~doubt])


def test_the_threshold_follows_what_the_texts_can_tell():
    rng = np.random.default_rng(3)
    y = np.arange(4000) % 4 == 0
    top = np.clip(np.where(y, 0.85, 0.6) + rng.normal(0, 0.05, 4000), 0, 1)
    assert A.threshold_of(y, top) >= 0.7
    assert abs(A.threshold_of(y[:0], top[:0]) - 0.6) < 1e-9  # nothing is known: the middle of all


@pytest.fixture(scope="module")
def tables(spark):
    texts, truth = corpus()
    rng = random.Random(7)
    docs = [(i, t, "en", "abc"[i % 3]) for i, t in enumerate(texts)]
    labels = [(i, r, int(truth[i] != (rng.random() < 0.05))) for i in range(350) for r in ("x", "y")[: 1 + i % 2]]
    more = [(9000, None, None, None), (9001, "", "en", "a"), (9002, texts[0], "en", "b"), (9003, "plain words " * 20_000 + BAD[0], "en", "c")]
    return H.clash(spark.createDataFrame(docs + more, H.DOCUMENTS)), H.clash(spark.createDataFrame([*labels, labels[0], (None, "x", 1), (9000, "x", 1), (5, "z", None)], H.LABELS)), truth


def test_held_out_accuracy(spark, tables):
    docs, labels, truth = tables
    got = {r.doc_id: (r.score, r.abusive) for r in A.scores(docs, labels).collect()}
    held = range(350, 500)
    hit = sum(got[i][1] and truth[i] for i in held)
    assert hit / sum(truth[i] for i in held) >= 0.9 and hit / max(1, sum(got[i][1] for i in held)) >= 0.9
    assert got[9000] == got[9001] == (0.0, False)
    assert got[9002] == got[0]
    assert got[9003][1]  # the last words of a very long text count
    rates = {r.source: (r.documents, r.rate) for r in A.rates(A.scores(docs, labels)).collect()}
    assert rates["a"][0] == 168 and 0.2 < rates["a"][1] < 0.45 and rates[None] == (1, 0.0)


def test_labels_that_teach_nothing_accuse_nobody(spark, tables):
    """Three wrong labels on plain texts are not enough to suspect anything."""
    plain, _ = corpus(60, seed=3)
    docs = spark.createDataFrame([(i, t.split(". ")[0], "en", "a") for i, t in enumerate(plain) if not any(b in t for b in BAD)], H.DOCUMENTS)
    labels = spark.createDataFrame([(r.doc_id, "x", int(n < 3)) for n, r in enumerate(docs.select("doc_id").collect())], H.LABELS)
    rows = A.scores(docs, labels).collect()
    assert sum(r.abusive for r in rows) <= 0.1 * len(rows)


def test_without_two_classes_there_is_no_score(spark, tables):
    docs, labels, _ = tables
    for l in (labels.limit(0), labels.where("abusive = 0")):
        rows = A.scores(docs, l).collect()
        assert len(rows) == 504 and all(r.score is None and r.abusive is None for r in rows)
    assert A.scores(docs.limit(0), labels).count() == 0


def test_all_labelled_texts_and_windows_are_learnt_from(spark, monkeypatch):
    """More texts than the bound of 6,000 that there once was, and a long one."""
    rng, seen = random.Random(1), []
    texts = [" ".join(rng.choices(WORDS, k=6)) + (" " + rng.choice(BAD) if i % 100 == 0 else "") for i in range(6400)]
    texts[1] = " ".join(rng.choices(WORDS, k=A.WINDOW + 20 * A.STRIDE))
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], H.DOCUMENTS)
    labels = spark.createDataFrame([(i, "x", int(i % 100 == 0)) for i in range(6400)], H.LABELS)
    monkeypatch.setattr(A, "drawn", lambda picked, steps, drawn=A.drawn: seen.append((picked, drawn(picked, steps))) or seen[-1][1])
    assert A.fit(docs, labels, steps=1)
    picked, stream = seen[0]
    off = picked.where("not y").select("h", "at").collect()
    assert len(off) == len(set(off)) == 6336 - 1 + 21 and len({r.h for r in off}) == 6336
    fold = {(r.fold, r.y): r["count"] for r in picked.groupBy("fold", "y").count().collect()}
    read = {(r.net, r.y): (r.n, r.texts) for r in stream.groupBy("net", "y").agg(A.F.count("*").alias("n"), A.F.sum("weight").alias("texts")).collect()}
    for net in range(A.FOLDS):
        for y in (False, True):
            assert read[net, y][0] >= sum(n for (f, c), n in fold.items() if f != net and c == y)


def test_word_counts_are_of_all_texts_and_windows_weigh_by_text():
    pa = A.pa
    rows = [(1, 0, True, "gronk reads gronk"), (2, 1, False, "reads letters"), (3, 2, False, " ".join(WORDS[i % len(WORDS)] + str(i) for i in range(A.WINDOW + 8 * A.STRIDE))), (4, 0, False, " ")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), pa.string()))], names=["h", "fold", "y", "text"])
    counts = {w: (on, off) for b in A._count_task(iter([batch])) for w, on, off in zip(*(c.to_pylist() for c in b.columns))}
    word = lambda w: A.features(w)[0]
    assert counts[0] == (1, 2) and counts[word("gronk")] == (1, 0) and counts[word("letters")][0] == 0 and counts[word("reads")][0] == 1
    got = [r for b in A._window_task(A._beyond(*np.ones((2, A.WORDS))), True)(iter([batch])) for r in b.to_pylist()]
    assert [r["h"] for r in got] == [1, 2, *[3] * 9] and [r["at"] for r in got if r["h"] == 3] == list(range(9))
    assert sorted(r["weight"] for r in got if r["h"] == 3) == pytest.approx([2 / 7] * 7 + [1, 1])
    assert got[0]["words"] == "gronk reads gronk" and len(got[-1]["words"].split(" ")) == A.WINDOW


def test_a_weight_counts_a_window_so_many_times():
    vocabulary, net = A.Vocabulary(), A.Network()
    ids = np.array([w for t in corpus(4)[0] for w in A.cut_windows(vocabulary.add(A.tokens(t)))][:3])
    y, (word, grams) = np.array([1, 0, 1.0]), vocabulary.arrays()
    weighed = net.gradients(word, grams, ids, y, weight=np.array([3, 1, 0.0]))
    again = net.gradients(word, grams, ids[[0, 0, 0, 1]], y[[0, 0, 0, 1]])
    assert all(np.allclose(weighed[k] * 3, again[k] * 4, atol=1e-6) for k in ("wo", "Wf", "Ub", "va"))


def test_texts_beyond_the_former_bound_change_the_model(spark):
    """A word that the 6,000 negative texts of the smallest hashes lack is harmless where later ones have it."""
    rng = random.Random(2)
    order = [r.i for r in spark.range(6900).select(A.F.col("id").alias("i"), A.F.xxhash64(A.F.lit(A.SEED), "id").alias("h")).orderBy("h").collect()]
    bad, late = set(order[:300]), set(order[6300:])
    plain = lambda: " ".join(rng.choices(WORDS, k=5))
    texts = [f"{plain()} you filthy gronk {plain()}" if i in bad else f"{plain()} the gronk corpus {plain()}" if i in late else plain() for i in range(6900)]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], H.DOCUMENTS)
    labels = spark.createDataFrame([(i, "x", int(i in bad)) for i in range(6900)], H.LABELS)
    model = A.fit(docs, labels, steps=80)
    rows = docs.select("doc_id", "text").mapInArrow(A._score_task(model, 1, ["doc_id", "score", "abusive"]), "doc_id long, score double, abusive boolean").collect()
    assert sum(r.abusive for r in rows if r.doc_id in bad) >= 0.9 * len(bad)
    assert sum(r.abusive for r in rows if r.doc_id in late) <= 0.1 * len(late)

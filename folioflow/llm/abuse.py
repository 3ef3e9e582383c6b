"""Abusive, hateful or sexual content: a recurrent network with attention over windows of words.

A text is cut into words and marks, disguised spellings (d.u.m.b, s p a c e d, r3pl@ced, streeeetched)
are brought nearer to the plain one, and every window of ``WINDOW`` words, overlapping the next by
half (``STRIDE``), is scored. A word enters as a trained vector of its own and as the mean of trained
vectors of its character sequences, so a word with a masked letter stays close to itself. A
bidirectional gated recurrent network reads the window, attention pools it, and a text's score is
that of its worst window. Context decides: quoted or studied words are in other company.

The first of three networks reads every window of every text. Windows that it holds harmless beyond
doubt (a score under ``SCREEN``) keep that score; the two others read the rest, and the mean counts.

Training happens in numpy, a task for each network, and reads every labelled text: its windows come
as a sorted stream, so memory does not grow with them, but the time of these tasks does. Labels are
of whole texts and raters err, so networks that have not seen a text say which of its windows is meant
and whether its label is to be believed (see ``fit``). Counts, thresholds and scores are of all texts, whole.

Null and empty texts score 0. Texts in several rows are scored in each. Without labels of both
classes there is no model and every score is null.
"""

from __future__ import annotations

import io
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut

WINDOW, STRIDE, SEED, FOLDS, STEPS, BATCH, SCREEN = 32, 16, 5, 3, 300, 128, 0.02
WORDS, GRAMS, WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 1 << 13, 1 << 14, 16, 32, 16, 16
#: Share of the distinct words of a batch that the network does not hear while it is trained.
DEAF = 0.15

# Signs used in place of letters.
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_]([ .\-_*·]))(?:[^\W\d_]\1)+[^\W\d_](?![^\W\d_])")
_TOKEN = re.compile(r"\w(?:[\w#*@!$'’.\-]*\w)?|[^\w\s]")


def tokens(text: str) -> list[str]:
    """Words and marks of a text, spaced-out words closed up."""
    closed = _SPACED.sub(lambda m: re.sub(re.escape(m[1]), "", m[0]), text if text.isascii() else unicodedata.normalize("NFKC", text))
    return _TOKEN.findall(closed.lower())


def squeezed(token: str) -> str:
    """A token without accents, stretched letters and disguises; numbers become 0."""
    if not any(map(str.isalpha, token)):
        return "0" if any(map(str.isdigit, token)) else token
    plain = "".join(c for c in unicodedata.normalize("NFD", token) if not unicodedata.combining(c)).translate(_SIGNS)
    return re.sub(r"[#*_]", "*", re.sub(r"(.)\1{2,}", r"\1", re.sub(r"(?<=\w)[.](?=\w)", "", plain)))


def features(token: str) -> tuple[int, list[int]]:
    """(number of the word's vector, numbers of its character sequences' vectors); 0 is none."""
    w = squeezed(token)
    edge = f"<{w}>"
    grams = {edge[i : i + n] for n in (3, 4) for i in range(len(edge) - n + 1)} | {edge}
    return 1 + zlib.crc32(w.encode()) % (WORDS - 1), sorted(1 + zlib.crc32(g.encode()) % (GRAMS - 1) for g in grams)


def windows(n: int) -> list[int]:
    """Where the windows over n tokens begin; the last one ends with the text."""
    if n <= WINDOW:
        return [0] if n else []
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Grams:
    """For each of some words the numbers of its character sequences, however many they are."""

    def __init__(self, flat: np.ndarray, counts: np.ndarray):
        self.flat, self.counts = flat, counts

    @classmethod
    def of(cls, lists: list[list[int]]) -> Grams:
        return cls(np.array([g for one in lists for g in one], dtype=np.int64), np.array([len(one) for one in lists], dtype=np.int64))

    def take(self, rows: np.ndarray) -> Grams:
        counts, ends = self.counts[rows], np.cumsum(self.counts[rows])
        starts = (np.cumsum(self.counts) - self.counts)[rows]
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
        return Grams(self.flat[at], counts)

    def mean(self, table: np.ndarray) -> np.ndarray:
        """The mean of the table's rows for each word, zeros for a word without sequences."""
        out, some = np.zeros((len(self.counts), table.shape[1]), np.float32), np.flatnonzero(self.counts)
        if len(some):
            out[some] = np.add.reduceat(table[self.flat], (np.cumsum(self.counts) - self.counts)[some], axis=0) / self.counts[some, None]
        return out


class Vocabulary:
    """Distinct tokens of some texts, numbered from 1, with their features; 0 pads."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.word, self.grams = [0], [[]]

    def add(self, tokens_: list[str]) -> list[int]:
        out = list(map(self.number.get, tokens_))
        if None in out:
            for t in tokens_:
                if t not in self.number:
                    self.number[t] = len(self.word)
                    w, g = features(t)
                    self.word.append(w)
                    self.grams.append(g)
            out = list(map(self.number.get, tokens_))
        return out

    def arrays(self, since: int = 0) -> tuple[np.ndarray, Grams]:
        return np.array(self.word[since:]), Grams.of(self.grams[since:])


def cut_windows(ids: list[int]) -> np.ndarray:
    """(windows, WINDOW) token numbers; a text shorter than a window is filled up with 0."""
    at = np.array(windows(len(ids)), dtype=np.int64)
    padded = np.array(ids + [0] * max(0, WINDOW - len(ids)), dtype=np.int32)
    return padded[at[:, None] + np.arange(WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """The weights, the forward pass and its gradients."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = SEED):
        if weights:
            self.w = weights
            return
        rng = np.random.default_rng(seed)
        x, h, a = WORD_DIM + CHAR_DIM, HIDDEN, ATTENTION
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.w = {"word": normal(WORDS, WORD_DIM, scale=0.1), "gram": normal(GRAMS, CHAR_DIM, scale=0.3), "Wa": normal(2 * h, a, scale=0.2), "va": normal(a, scale=0.2), "wo": normal(2 * h, scale=0.2), "bo": np.zeros(1, np.float32)}
        for d in "fb":
            self.w |= {f"W{d}": normal(x, 3 * h, scale=x**-0.5), f"U{d}": normal(h, 3 * h, scale=h**-0.5), f"c{d}": np.zeros(3 * h, np.float32)}
        self.w["word"][0] = self.w["gram"][0] = 0

    def embed(self, word: np.ndarray, grams: Grams) -> np.ndarray:
        return np.concatenate([self.w["word"][word], grams.mean(self.w["gram"])], axis=1).astype(np.float32)

    def _run(self, g: np.ndarray, u: np.ndarray, mask: np.ndarray, order: range, keep: list | None) -> np.ndarray:
        """One direction over (steps, batch, 3h) inputs; the states, (steps, batch, h)."""
        steps, batch, h3 = g.shape
        n = h3 // 3
        state, out = np.zeros((batch, n), np.float32), np.empty((steps, batch, n), np.float32)
        for t in order:
            rec = state @ u
            zr = _sigmoid(g[t, :, : 2 * n] + rec[:, : 2 * n])
            z, r = zr[:, :n], zr[:, n:]
            new = np.tanh(g[t, :, 2 * n :] + r * rec[:, 2 * n :])
            nxt = new + z * (state - new)
            if keep is not None:
                keep.append((state, z, r, new, rec[:, 2 * n :]))
            state = np.where(mask[t][:, None], nxt, state)
            out[t] = state
        return out

    def forward(self, x: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Token vectors (tokens, dims) and windows of token numbers (batch, steps) -> scores in (0, 1)."""
        w, mask = self.w, (ids > 0).T
        states = []
        for d, order in (("f", range(ids.shape[1])), ("b", range(ids.shape[1] - 1, -1, -1))):
            g = (x @ w[f"W{d}"] + w[f"c{d}"])[ids.T]
            tape = [] if keep is not None else None
            states.append(self._run(g, w[f"U{d}"], mask, order, tape))
            if keep is not None:
                keep[d] = tape
        h = np.concatenate(states, axis=2)
        u = np.tanh(h @ w["Wa"])
        e = np.where(mask, u @ w["va"], -1e9)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tb,tbh->bh", a, h)
        p = _sigmoid(pooled @ w["wo"] + w["bo"][0])
        if keep is not None:
            keep |= {"h": h, "u": u, "a": a, "pooled": pooled, "p": p}
        return p

    def gradients(self, word: np.ndarray, grams: Grams, ids: np.ndarray, y: np.ndarray, heard: np.ndarray | None = None, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Of the mean log loss, each window's times its ``weight``. ``heard`` has a number in [0, 1) for every token; those under ``DEAF`` are not heard."""
        w, used = self.w, np.unique(ids)
        local = np.searchsorted(used, ids)
        mask = ids.T > 0
        # Positions in the short list of used tokens; number 0 pads, so it stays first.
        if used[0] != 0:
            used, local = np.concatenate([[0], used]), local + 1
        wu, gu = word[used], grams.take(used)
        x = self.embed(wu, gu)
        keep: dict = {}
        if heard is not None:
            deaf = heard[used] < DEAF
            x = np.where(deaf[:, None], 0, x)
        p = self.forward(x, local, keep)
        h, u, a = keep["h"], keep["u"], keep["a"]
        dlogit = ((p - y) * (1 if weight is None else weight) / len(y)).astype(np.float32)
        grad = {"wo": keep["pooled"].T @ dlogit, "bo": np.array([dlogit.sum()])}
        dpool = dlogit[:, None] * w["wo"]
        dh = a[:, :, None] * dpool
        da = np.einsum("bh,tbh->tb", dpool, h)
        de = a * (da - (a * da).sum(0))
        grad["va"] = np.einsum("tb,tba->a", de, u)
        du = de[:, :, None] * w["va"] * (1 - u * u)
        grad["Wa"] = np.einsum("tbh,tba->ha", h, du, optimize=True)
        dh = dh + du @ w["Wa"].T
        dx, n = np.zeros_like(x), HIDDEN
        for d, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            order = range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1)
            dstate, dU = np.zeros((len(ids), n), np.float32), np.zeros_like(w[f"U{d}"])
            dg = np.zeros((ids.shape[1], len(ids), 3 * n), np.float32)
            for t, (before, z, r, new, rec) in zip(reversed(order), reversed(keep[d])):
                total = dstate + dh[t, :, part]
                m = mask[t][:, None]
                live = np.where(m, total, 0)
                dan = live * (1 - z) * (1 - new * new)
                daz, dar = live * (before - new) * z * (1 - z), dan * rec * r * (1 - r)
                drec = np.concatenate([daz, dar, dan * r], axis=1)
                dg[t, :, : 2 * n], dg[t, :, 2 * n :] = drec[:, : 2 * n], dan
                dU += before.T @ drec
                dstate = np.where(m, live * z + drec @ w[f"U{d}"].T, total)
            flat, at = dg.reshape(-1, 3 * n), local.T.ravel()
            summed = _add_rows(at, flat, len(x))
            grad |= {f"U{d}": dU, f"c{d}": flat.sum(0), f"W{d}": x.T @ summed}
            dx += summed @ w[f"W{d}"].T
        dx[0] = 0
        if heard is not None:
            dx[deaf] = 0
        grad["word"] = (wu, dx[:, :WORD_DIM])
        share = dx[:, WORD_DIM:] / np.maximum(gu.counts, 1)[:, None]
        grad["gram"] = (gu.flat, np.repeat(share, gu.counts, axis=0))
        return grad


def dump(nets: list[Network], threshold: float) -> bytes:
    out = io.BytesIO()
    np.savez(out, threshold=np.float32(threshold), **{f"{i}/{k}": v.astype(np.float32) for i, net in enumerate(nets) for k, v in net.w.items()})
    return out.getvalue()


def load(data: bytes) -> tuple[list[Network], float]:
    z = np.load(io.BytesIO(data))
    names = [k.split("/") for k in z.files if "/" in k]
    return [Network({k: z[f"{i}/{k}"] for j, k in names if int(j) == i}) for i in sorted({int(i) for i, _ in names})], float(z["threshold"])


def _add_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by number."""
    order = np.argsort(at, kind="stable")
    out = np.zeros((n, rows.shape[1]), np.float32)
    sorted_ = at[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(at) else np.array([], int)
    if len(starts):
        out[sorted_[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class _Adam:
    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.w.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.w.items()}

    def step(self, grad: dict) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, g in grad.items():
            if isinstance(g, tuple):  # only some rows of a table
                ids, where = np.unique(g[0], return_inverse=True)
                g = _add_rows(where, g[1], len(ids))
            else:
                ids = slice(None)
            self.m[k][ids] = 0.9 * self.m[k][ids] + 0.1 * g
            self.v[k][ids] = 0.999 * self.v[k][ids] + 0.001 * g * g
            self.net.w[k][ids] -= rate * self.m[k][ids] / (np.sqrt(self.v[k][ids]) + 1e-7)
        self.net.w["word"][0] = self.net.w["gram"][0] = 0


def _score_windows(net: Network, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.concatenate([net.forward(x, ids[s : s + 512]) for s in range(0, len(ids), 512)]) if len(ids) else np.zeros(0)


def _beyond(on: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Of every word's texts, positive and not, how far the positive ones are beyond chance; number 0 counts all texts.

    A word of one text only, a name say, is hardly beyond chance.
    """
    expected = (on + off) * (on[0] / (on[0] + off[0]))
    beyond = (on - expected) / np.sqrt(expected + 1)
    beyond[0] = 0
    return beyond


def _spans(doc: np.ndarray) -> list[tuple[int, int]]:
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    return list(zip(starts, [*starts[1:], len(doc)]))


def _worst(doc: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The rank of each window among those of its text, 0 for the highest score."""
    order = np.lexsort((-score, doc))
    rank = np.empty(len(doc), dtype=np.int64)
    rank[order] = np.arange(len(doc)) - np.repeat([s for s, _ in _spans(doc)], [e - s for s, e in _spans(doc)])
    return rank


_CUTS = np.arange(0.3, 0.91, 0.05)


def threshold_of(y: np.ndarray, top: np.ndarray) -> float:
    """The threshold for texts of known class and their scores, see ``_middle``."""
    return _middle(y.sum(), np.array([(y & (top >= c)).sum() for c in _CUTS]), np.array([(top >= c).sum() for c in _CUTS]))


def _middle(positive: int, right: np.ndarray, found: np.ndarray) -> float:
    """The middle of the thresholds whose F1, on texts judged by a network that had not seen them, may be the best.

    That is, all within one standard error of the best: few texts tell thresholds apart less than many.
    """
    f1 = 2 * right / np.maximum(1, positive + found)
    error = (f1.max() * (1 - f1.max()) / max(1, positive)) ** 0.5
    return float(np.median(_CUTS[f1 >= f1.max() - error - 1e-9]))


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, fold, y, text) -> (word, on, off): texts of either class with a word; word 0 is in each."""
    on, off, number = np.zeros(WORDS, np.int64), np.zeros(WORDS, np.int64), {}
    for b in batches:
        for y, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            if words := set(tokens(t)):
                if len(number) > 300_000:
                    number.clear()
                for w in words - number.keys():
                    number[w] = features(w)[0]
                (on if y else off)[[0, *{number[w] for w in words}]] += 1
    some = np.flatnonzero(on + off)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(on[some]), pa.array(off[some])], names=["word", "on", "off"])


def _judge(how: np.ndarray | list[bytes]):
    """How windows of token numbers, with the fold of their text, are scored.

    By words beyond chance: the mean of a window's three highest. By networks: that which has not seen the fold.
    """
    nets = None if isinstance(how, np.ndarray) else [load(m)[0][0] for m in how]

    def judge(vocabulary: Vocabulary, ids: np.ndarray, fold: np.ndarray) -> np.ndarray:
        if nets is None:
            return np.sort(how[np.array(vocabulary.word)[ids]], axis=1)[:, -3:].mean(1)
        out = np.zeros(len(ids))
        for f, net in enumerate(nets):
            mine = np.flatnonzero(fold == f)
            used = np.union1d([0], ids[mine]).astype(np.int64)
            x = net.embed(np.array([vocabulary.word[i] for i in used]), Grams.of([vocabulary.grams[i] for i in used]))
            out[mine] = _score_windows(net, x, np.searchsorted(used, ids[mine]))
        return out

    return judge


_WINDOWS = "h long, fold int, y boolean, at int, rank int, score double, top double, weight double, words string"


def _window_task(how: np.ndarray | list[bytes], whole: bool):
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h, fold, y, text) -> every window, or the highest of each text where not ``whole``, with its score and rank in the text.

        Of a negative text the two highest weigh 1 each and all others together 2 at most; positive windows weigh 1.
        """
        judge, vocabulary = _judge(how), Vocabulary()
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                if len(vocabulary.word) > 300_000:
                    vocabulary = Vocabulary()
                words = [tokens(t) for t in part.column(3).to_pylist()]
                per_doc = [cut_windows(vocabulary.add(w)) for w in words]
                counts = np.array([len(w) for w in per_doc])
                if not counts.sum():
                    continue
                doc = np.repeat(np.arange(len(counts)), counts)
                at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                score = judge(vocabulary, np.concatenate(per_doc), part.column(1).to_numpy()[doc]).astype(np.float64)
                rank, top = _worst(doc, score), np.zeros(len(counts))
                np.maximum.at(top, doc, score)
                rows = part.select([0, 1, 2])
                others = np.minimum(1, 2 / np.maximum(1, counts - 2))[doc]
                weight = np.where((rank < 2) | rows.column(2).to_numpy(zero_copy_only=False).astype(bool)[doc], 1, others)
                keep = np.arange(len(doc)) if whole else np.flatnonzero(rank == 0)
                texts = [" ".join(words[d][i : i + WINDOW]) if whole else "" for d, i in zip(doc[keep], (windows(len(words[d]))[k] for d, k in zip(doc[keep], at[keep])))]
                yield pa.RecordBatch.from_arrays([*rows.take(pa.array(doc[keep])).columns, pa.array(at[keep], pa.int32()), pa.array(rank[keep], pa.int32()), pa.array(score[keep]), pa.array(top[doc[keep]]), pa.array(weight[keep]), pa.array(texts, pa.string())], names=["h", "fold", "y", "at", "rank", "score", "top", "weight", "words"])

    return cut_up


def _learn_task(first: bool, rate: float = 4e-3):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (net, t, y, weight, words) -> (net, model): a step for every ``BATCH`` windows, a quarter of them positive; t runs from 0 to 1."""
        adam, now, rng, known = None, None, None, {}
        waiting, share = {False: [], True: []}, {False: BATCH - BATCH // 4, True: BATCH // 4}

        def step() -> None:
            held = [row for y, n in share.items() for row in waiting[y][:n]]
            for y, n in share.items():
                del waiting[y][:n]
            number = {w: i for i, w in enumerate(dict.fromkeys(w for _, _, _, ws in held for w in ws), 1)}
            if len(known) > 300_000:
                known.clear()
            for w in number.keys() - known.keys():
                known[w] = features(w)
            each = [known[w] for w in number]
            ids = np.array([[number[w] for w in ws] + [0] * (WINDOW - len(ws)) for _, _, _, ws in held])
            adam.rate = rate if max(t for t, *_ in held) < 0.7 else rate / 4
            word, grams = np.array([0, *(w for w, _ in each)]), Grams.of([[], *(g for _, g in each)])
            adam.step(adam.net.gradients(word, grams, ids, np.array([y for _, y, _, _ in held], np.float32), rng.random(len(word)), np.array([x for _, _, x, _ in held])))

        def done() -> pa.RecordBatch:
            while any(waiting.values()):
                step()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([dump([adam.net], 0)], pa.binary())], names=["net", "model"])

        for b in batches:
            for net, t, y, weight, words in zip(*(c.to_pylist() for c in b.columns)):
                if net != now:
                    if adam:
                        yield done()
                    adam, now, rng = _Adam(Network(seed=SEED + net), rate), net, np.random.default_rng([SEED, net, first])
                waiting[y].append((t, y, weight, words.split(" ")))
                if all(len(waiting[c]) >= n for c, n in share.items()):
                    step()
        if adam:
            yield done()

    return learn


def drawn(picked: DataFrame, steps: int) -> DataFrame:
    """Windows (h, fold, y, at, weight, words) -> (net, t, y, weight, words), the stream that each network learns from, by t in [0, 1).

    A network gets the windows of all folds but its own, a quarter of them positive. Each comes at least once and,
    where they are fewer than ``steps`` batches ask for, in turns. Weights have a mean of 1 over each class of a network. Networks without both classes get none.
    """
    sums = {(r.fold, r.y): (r.n, r.weight) for r in picked.groupBy("fold", "y").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()}
    need, mean = [], []
    for f in range(FOLDS):
        (off, off_weight), (on, on_weight) = (np.sum([x for (fold, y), x in sums.items() if fold != f and y == c] + [(0, 0)], axis=0).tolist() for c in (False, True))
        share = (BATCH - BATCH // 4, BATCH // 4)
        batches = max(steps, off / share[0], on / share[1])
        need += [batches * share[0] / off, batches * share[1] / on] if off and on else [0.0, 0.0]
        mean += [off_weight / off, on_weight / on] if off and on else [1.0, 1.0]
    nets = picked.select("*", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))).alias("net")).where("net <> fold")
    of_net = lambda numbers: F.element_at(F.array(*map(F.lit, numbers)), F.col("net") * 2 + F.col("y").cast("int") + 1)
    turns = nets.withColumn("need", of_net(need)).withColumn("weight", F.col("weight") / of_net(mean)).where("need > 0")
    turns = turns.withColumn("turn", F.explode(F.sequence(F.lit(0), F.ceil("need").cast("int") - 1)))
    chance = F.pmod(F.xxhash64(F.lit(SEED), "net", "turn", "h", "at"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    stream = turns.withColumn("t", (F.col("turn") + chance) / F.col("need")).where("turn = 0 or t < 1")
    return stream.repartitionById(FOLDS, F.col("net")).sortWithinPartitions("net", "t", "h", "at").select("net", "t", "y", "weight", "words")


def _networks(picked: DataFrame, steps: int, first: bool) -> list[bytes]:
    got = {r.net: bytes(r.model) for r in drawn(picked, steps).mapInArrow(_learn_task(first), "net int, model binary").collect()}
    for f in set(range(FOLDS)) - got.keys():
        blind = Network(seed=SEED + f)
        blind.w["bo"] -= 10  # nothing to learn from: no text is suspected
        got[f] = dump([blind], 0)
    return [got[f] for f in range(FOLDS)]


def labelled(documents: DataFrame, doc_labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) with the mean judgement of the raters; repeated judgements of one count once."""
    votes = doc_labels.where("doc_id is not null and abusive is not null").groupBy("doc_id", "rater").agg(F.max("abusive").alias("abusive")).groupBy("doc_id").agg(F.avg("abusive").alias("label"))
    return documents.where("text is not null and text <> ''").select("doc_id", "text").join(votes, "doc_id").dropDuplicates(["doc_id"])


def fit(documents: DataFrame, doc_labels: DataFrame, steps: int = STEPS) -> bytes | None:
    """The model (eight megabytes whatever the corpus), trained on all labelled texts; None without both classes.

    Two rounds of cross-fitting: each fold is scored by a network that has not seen it. Those scores
    say which window of a positive text is meant, and which labels to distrust: a network that has
    seen a wrong label could have learnt it by heart. In the first round words that positive texts have
    beyond chance must do. The networks of the second round are the model together; of a text that two
    of them have learnt by heart, the third still judges freely. Of negative texts all windows count.
    """
    h = F.xxhash64(F.lit(SEED), "doc_id")
    rows = cut(labelled(documents, doc_labels).select(h.alias("h"), F.pmod(h, F.lit(FOLDS)).cast("int").alias("fold"), (F.col("label") >= 0.5).alias("y"), "text"))
    words = rows.mapInArrow(_count_task, "word int, on long, off long").groupBy("word").agg(F.sum("on").alias("on"), F.sum("off").alias("off")).collect()
    on, off = np.zeros(WORDS), np.zeros(WORDS)
    for r in words:
        on[r.word], off[r.word] = r.on, r.off
    if not on[0] or not off[0]:
        return None
    guess = cut(rows.mapInArrow(_window_task(_beyond(on, off), True), _WINDOWS).where("not y or rank = 0").withColumn("top", F.round("top", 3)))
    usual = guess.where("not y and rank = 0").agg(F.percentile("top", 0.97)).first()[0]
    nets = _networks(guess.where(~F.col("y") | (F.col("top") > usual)), steps, True)
    apart = rows.mapInArrow(_window_task(nets, True), _WINDOWS)
    nets = _networks(cut(apart.where("if(y, top >= 0.5 and (rank = 0 or score >= 0.8), top < 0.8)")), 2 * steps, False)
    tops = rows.mapInArrow(_window_task(nets, False), _WINDOWS)
    hit = [F.col("top") >= float(c) for c in _CUTS]
    sums = tops.agg(F.count_if("y"), *(F.count_if(F.col("y") & c) for c in hit), *map(F.count_if, hit)).first()
    return dump([load(m)[0][0] for m in nets], _middle(sums[0], np.array(sums[1 : 1 + len(_CUTS)]), np.array(sums[1 + len(_CUTS) :])))


def judged(nets: list[Network], vectors: list[np.ndarray], ids: np.ndarray, screen: float = SCREEN) -> np.ndarray:
    """Windows of token numbers -> scores: the first network's, the mean of all where that is ``screen`` or more."""
    out = _score_windows(nets[0], vectors[0], ids)
    doubt = np.flatnonzero(out >= screen)
    if len(doubt):
        out[doubt] = np.mean([out[doubt], *(_score_windows(net, x, ids[doubt]) for net, x in zip(nets[1:], vectors[1:]))], axis=0)
    return out


def _score_task(model: bytes, at: int, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nets, threshold = load(model)
        vocabulary, x = Vocabulary(), [np.zeros((1, WORD_DIM + CHAR_DIM), np.float32) for _ in nets]
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                if len(vocabulary.word) > 300_000:
                    vocabulary, x = Vocabulary(), [e[:1] for e in x]
                per_doc = [cut_windows(vocabulary.add(tokens(t)) if t else []) for t in part.column(at).to_pylist()]
                if len(vocabulary.word) > len(x[0]):
                    new = vocabulary.arrays(len(x[0]))
                    x = [np.concatenate([e, net.embed(*new)]) for e, net in zip(x, nets)]
                counts = np.array([len(w) for w in per_doc])
                top = np.zeros(len(per_doc))
                if counts.sum():
                    ids = np.concatenate(per_doc)
                    used, local = np.unique(ids, return_inverse=True)
                    local = local.reshape(ids.shape) + (used[0] != 0)
                    rows = used if used[0] == 0 else np.concatenate([[0], used])
                    np.maximum.at(top, np.repeat(np.arange(len(per_doc)), counts), judged(nets, [e[rows] for e in x], local))
                rest = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(top), pa.array(top >= threshold)], names=names)

    return score


def scores(documents: DataFrame, doc_labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, abusive) of every document."""
    model = fit(documents, doc_labels)
    rows = documents.select("doc_id", "source", "text")
    if model is None:
        return rows.select("doc_id", "source", F.lit(None).cast("double").alias("score"), F.lit(None).cast("boolean").alias("abusive"))
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, source string, score double, abusive boolean"
    return rows.mapInArrow(_score_task(model, 2, ["doc_id", "source", "score", "abusive"]), schema)


def rates(scored: DataFrame) -> DataFrame:
    """Of every source (null is one) its documents, the abusive ones, their rate and the mean score."""
    n = F.count_if(F.col("abusive"))
    return scored.groupBy("source").agg(F.count("*").alias("documents"), n.alias("abusive"), (n / F.count("*")).alias("rate"), F.avg("score").alias("mean_score"))

"""Clusters of mutually similar vectors by Markov clustering.

1. *Micro-clusters.* Vectors are range-partitioned by (facet, nearest of ``MICRO`` fixed directions,
   id) and every partition joins each vector to a leader with a cosine of at least ``LEADER``. Because
   the id is part of the range, a group that holds a third of all rows lies over many partitions, each
   with leaders of its own. The number of directions is the same for every table and leaders are not
   joined to leaders, so no unit is farther from its leader in a large table than in a small one.
2. *Similarity graph.* Each leader goes to its nearest of K directions, ``PROBES`` of them or more;
   leaders that meet in a cell are compared in matrix blocks, and cosines of at least ``LINK`` are
   edges. K follows the number of leaders, and the probes follow K (``_probes_for``), because pairs
   at ``LINK`` meet the less the finer the cells are. A cell above ``CELL`` rows is cut into slices
   and every pair of slices is compared in a task of its own: nothing is capped or left out. The
   cells are an index, not exact: tests measure the recall of its links, also just above ``LINK``.
3. *Markov clustering.* The column-stochastic matrix of the graph, rows weighted with the size of
   the micro-cluster, is squared, inflated and pruned until columns no longer change, as joins and
   aggregations over (row, col, value). A column's strongest row is its attractor and names the
   cluster; the flow to it says how typical a member is.

Unit vectors travel as 16-bit integers (128 bytes for 64 numbers; a cosine is off by under 1e-4).

Rows without an id, without a full vector, with non-finite numbers or of length zero have no
cluster. Repeated rows count once; of different vectors under one id the one of the greatest
``run_id`` counts. A null facet is a facet. An empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import cut, remove, rewrite

DIMENSIONS, LINK, LEADER, MICRO, PROBES, PER_CELL, CELL = 64, 0.8, 0.9, 256, 5, 128, 4096
INFLATION, PRUNE, STILL, ROUNDS = 2.0, 1e-3, 0.02, 30
_SEED, _SCALE = 20240229, 32767.0


def directions(k: int, dims: int = DIMENSIONS) -> np.ndarray:
    """K fixed random unit vectors; every executor makes the same ones."""
    d = np.random.default_rng(_SEED).standard_normal((k, dims)).astype(np.float32)
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def _cells_for(rows: int) -> int:
    return 1 << max(4, int(max(1, rows) / PER_CELL).bit_length() - 1)


def _probes_for(k: int) -> int:
    """Cells that a leader goes to: enough for 99% of the pairs just above ``LINK`` to meet in one of K."""
    return max(PROBES, 2 * (k.bit_length() - 1) - 8)


def _decode(col: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.int16).reshape(-1, dims).astype(np.float32) / _SCALE


def _top(x: np.ndarray, d: np.ndarray, probes: int) -> np.ndarray:
    out = np.empty((len(x), min(probes, len(d))), dtype=np.int32)
    for s in range(0, len(x), 2048):
        sims = x[s : s + 2048] @ d.T
        part = np.argpartition(-sims, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] < len(d) else np.tile(np.arange(len(d)), (len(sims), 1))
        order = np.argsort(-np.take_along_axis(sims, part, 1), axis=1, kind="stable")
        out[s : s + 2048] = np.take_along_axis(part, order, 1)
    return out


def _place(k: int, dims: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(facet, id, embedding) -> (facet, cell, id, q) for usable vectors."""
        d = directions(k, dims)
        for b in batches:
            lists = b.column(2)
            if not len(lists):
                continue
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
            norm = np.linalg.norm(x, axis=1)
            good = np.isfinite(norm) & (norm > 0)
            x = (x[good] / norm[good, None]).astype(np.float32)
            q = np.rint(x * _SCALE).astype(np.int16)
            keep = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), pa.array(_top(x, d, 1)[:, 0] if len(x) else [], pa.int32()), b.column(1).take(keep), pa.array([r.tobytes() for r in q], pa.binary())], names=["facet", "cell", "id", "q"])

    return place


class _Leaders:
    """Greedy leaders of one cell: each vector joins its most similar leader or becomes one."""

    def __init__(self, dims: int):
        self.x, self.n, self.label = np.empty((64, dims), dtype=np.float32), 0, []

    def add(self, x: np.ndarray, labels: list, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(position of the leader, cosine to it) of each row; new leaders take the row's label."""
        who, sim = np.full(len(x), -1), np.ones(len(x), dtype=np.float32)
        for s in range(0, len(x), 1024):
            part = x[s : s + 1024]
            left = np.arange(len(part))
            if self.n:
                sims = part @ self.x[: self.n].T
                best = sims.argmax(1)
                top = sims[np.arange(len(part)), best]
                hit = top >= threshold
                who[s : s + 1024][hit], sim[s : s + 1024][hit] = best[hit], top[hit]
                left = left[~hit]
            while len(left):
                first = left[0]
                sims = part[left] @ part[first]
                near = sims >= threshold
                near[0] = True
                at = s + left[near]
                who[at], sim[at] = self.n, sims[near]
                if self.n == len(self.x):
                    self.x = np.concatenate([self.x, np.empty_like(self.x)])
                self.x[self.n] = part[first]
                self.label.append(labels[s + first])
                self.n += 1
                left = left[~near]
        return who, np.minimum(sim, 1)


def _lead(threshold: float, dims: int):
    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (facet, cell, id, q) -> (facet, id, leader, sim, q); q only of leaders, whose id is the label."""
        key, leaders, told = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            facet, cell, ids = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            q, x = b.column(3).to_pylist(), _decode(b.column(3), dims)
            starts = [0, *(i for i in range(1, len(ids)) if cell[i] != cell[i - 1] or facet[i] != facet[i - 1])]
            to, sims, vec = [], np.empty(len(ids), dtype=np.float32), [None] * len(ids)
            for s, e in zip(starts, [*starts[1:], len(ids)]):
                if (facet[s], cell[s]) != key:
                    key, leaders = (facet[s], cell[s]), _Leaders(dims)
                told = leaders.n
                who, sims[s:e] = leaders.add(x[s:e], ids[s:e], threshold)
                to += [leaders.label[w] for w in who]
                seen = np.flatnonzero(who >= told)
                for w, i in {int(who[i]): int(i) for i in seen[::-1]}.items():
                    vec[s + i] = q[s + i]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(to, b.column(2).type), pa.array(sims), pa.array(vec, pa.binary())], names=["facet", "id", "leader", "sim", "q"])

    return lead


def _probe(k: int, probes: int, dims: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(facet, node, q) -> a row for each of the leader's cells."""
        d = directions(k, dims)
        for b in batches:
            if not b.num_rows:
                continue
            top = _top(_decode(b.column(2), dims), d, probes)
            at = pa.array(np.repeat(np.arange(len(top)), top.shape[1]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(top.ravel()), b.column(1).take(at), b.column(2).take(at)], names=["facet", "cell", "node", "q"])

    return probe


def _pairs(link: float, dims: int):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (facet, cell, a, b, slice, node, q) -> (src, dst, w) with src < dst."""
        key, held = None, []
        names = ["src", "dst", "w"]

        def compare() -> pa.RecordBatch:
            sl, node, x = (np.concatenate([h[i] for h in held]) for i in range(3))
            src, dst, w = [], [], []
            one, two = np.flatnonzero(sl == key[2]), np.flatnonzero(sl == key[3])
            same = key[2] == key[3]
            for s in range(0, len(one), 2048):
                rows = one[s : s + 2048]
                sims = x[rows] @ x[two].T
                i, j = np.nonzero(sims >= link)
                a, c = node[rows[i]], node[two[j]]
                keep = a < c if same else a != c
                src.append(np.minimum(a, c)[keep]), dst.append(np.maximum(a, c)[keep]), w.append(sims[i, j][keep])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst)), pa.array(np.concatenate(w).astype(np.float64))], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_pylist() for i in range(4)]
            sl, node, x = b.column(4).to_numpy(), b.column(5).to_numpy(), _decode(b.column(6), dims)
            keys = list(zip(*cols))
            starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1])]
            for s, e in zip(starts, [*starts[1:], len(keys)]):
                if keys[s] != key:
                    if held and sum(len(h[0]) for h in held) > 1:
                        yield compare()
                    key, held = keys[s], []
                held.append((sl[s:e], node[s:e], x[s:e]))
        if held and sum(len(h[0]) for h in held) > 1:
            yield compare()

    return pairs


def vectors(store: DataFrame, dims: int = DIMENSIONS) -> DataFrame:
    """(facet, id, embedding) with one vector an id; the facet's null is kept apart from every name."""
    facet = F.when(F.col("metadata.facet").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("metadata.facet")))
    full = (F.size("embedding") == dims) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    rows = store.where(F.col("id").isNotNull() & F.col("embedding").isNotNull()).where(full).select(facet.alias("facet"), "id", "embedding", F.coalesce("metadata.run_id", F.lit("")).alias("run_id"))
    state = F.xxhash64("embedding", "facet")
    states = rows.select("id", "run_id", state.alias("state")).groupBy("id").agg(F.min("state").alias("low"), F.max("state").alias("high"), F.max(F.struct("run_id", "state")).alias("top"))
    several = cut(states.where("low <> high").select("id", F.col("top.state").alias("state")))
    if several.isEmpty():
        return rows.select("facet", "id", "embedding")
    kept = rows.withColumn("state_now", state).join(several, "id", "left").where("state is null or state = state_now")
    return kept.select("facet", "id", "embedding")


def micro_clusters(rows: DataFrame, dims: int = DIMENSIONS, leader: float = LEADER) -> tuple[DataFrame, DataFrame]:
    """(members (facet, id, leader, sim), leaders (facet, leader, q)).

    The same for few and for many rows: every unit has a cosine of at least ``leader`` to its leader.
    """
    placed = rows.mapInArrow(_place(MICRO, dims), "facet string, cell int, id string, q binary")
    schema = "facet string, id string, leader string, sim float, q binary"
    order = ["facet", "cell", "id"]
    led = cut(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_lead(leader, dims), schema))
    return led.select("facet", "id", "leader", "sim"), led.where("q is not null").select("facet", "leader", "q")


def links(nodes: DataFrame, most: int, dims: int = DIMENSIONS, link: float = LINK, probes: int | None = None, cell_rows: int = CELL) -> DataFrame:
    """(facet, node long, q) -> (src, dst, w): every found pair of nodes with a cosine of at least ``link``.

    ``most`` is the number of nodes in the largest facet.
    """
    k = _cells_for(most)
    probed = nodes.mapInArrow(_probe(k, probes or _probes_for(k), dims), "facet string, cell int, node long, q binary")
    big = cut(probed.groupBy("facet", "cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows).select("facet", "cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("slices")))
    one = F.lit(0)
    if big.isEmpty():
        blocks = probed.select("facet", "cell", one.alias("a"), one.alias("b"), one.alias("slice"), "node", "q")
    else:
        own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
        cutup = probed.join(big, ["facet", "cell"], "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("slice", own)
        blocks = cutup.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select("facet", "cell", F.least("slice", "other").alias("a"), F.greatest("slice", "other").alias("b"), "slice", "node", "q")
    keys = ["facet", "cell", "a", "b"]
    found = blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_pairs(link, dims), "src long, dst long, w double")
    return found.groupBy("src", "dst").agg(F.max("w").alias("w"))


def markov(edges: DataFrame, mass: DataFrame, inflation: float = INFLATION, prune: float = PRUNE, rounds: int = ROUNDS) -> DataFrame:
    """Undirected (src, dst, w) and (node, mass) -> (node, attractor, flow) for every node with an edge.

    Of attractors with nearly equal flow the smallest node counts. Every round writes the matrix to a table in the shared folder,
    because squaring reads it twice.
    """
    both = edges.select(F.col("src").alias("row"), F.col("dst").alias("col"), "w").unionByName(edges.select(F.col("dst").alias("row"), F.col("src").alias("col"), "w"))
    loops = both.select(F.col("col").alias("row"), "col").distinct().withColumn("w", F.lit(1.0))
    weighted = both.unionByName(loops).join(mass, F.col("row") == F.col("node")).select("row", "col", (F.col("w") * F.col("mass")).alias("v"))

    def stochastic(m: DataFrame) -> DataFrame:
        w = Window.partitionBy("col")
        share = m.withColumn("v", F.col("v") / F.sum("v").over(w)).withColumn("most", F.max("v").over(w))
        kept = share.where((F.col("v") >= prune) | (F.col("v") >= F.col("most")))
        return kept.withColumn("v", F.col("v") / F.sum("v").over(w)).select("row", "col", "v")

    m, at = rewrite(stochastic(weighted))
    for _ in range(rounds):
        a, b = m.select("row", F.col("col").alias("mid"), F.col("v").alias("x")), m.select(F.col("row").alias("mid"), "col", F.col("v").alias("y"))
        squared = a.join(b, "mid").groupBy("row", "col").agg(F.sum(F.col("x") * F.col("y")).alias("v"))
        m, at = rewrite(stochastic(squared.withColumn("v", F.pow("v", inflation))), at)
        restless = m.groupBy("col").agg((F.max("v") - F.sum(F.col("v") * F.col("v"))).alias("chaos")).agg(F.max("chaos")).first()[0]
        if restless is None or restless < STILL:
            break
    else:
        warnings.warn(f"Markov clustering still moves after {rounds} rounds (by {restless:.3f}); the strongest rows are read as they are", stacklevel=2)
    # Attractors that share a column nearly alike are one system; the smallest names it.
    strong = m.withColumn("most", F.max("v").over(Window.partitionBy("col"))).where(F.col("v") >= 0.5 * F.col("most"))
    best = strong.groupBy("col").agg(F.min("row").alias("attractor"), F.max("v").alias("flow")).select(F.col("col").alias("node"), "attractor", "flow")
    best = cut(best)
    remove(best.sparkSession, at)
    root = best.select(F.col("node").alias("attractor"), F.col("attractor").alias("root"))
    return best.join(root, "attractor").select("node", F.col("root").alias("attractor"), "flow")


def clusters(store: DataFrame, dims: int = DIMENSIONS, link: float = LINK, leader: float = LEADER) -> DataFrame:
    """(embedding_id, facet, cluster, typical): a row for each unit with a full vector.

    ``typical`` is the flow of the unit's micro-cluster to the attractor times its cosine to the leader.
    """
    members, leaders = micro_clusters(vectors(store, dims), dims, leader)
    nodes = cut(leaders.withColumn("node", F.monotonically_increasing_id()))
    most = nodes.groupBy("facet").count().agg(F.max("count")).first()[0] or 0
    edges = cut(links(nodes.select("facet", "node", "q"), most, dims, link))
    named = cut(members.join(nodes.select("leader", "facet", "node"), ["leader", "facet"]).groupBy("id", "facet").agg(F.max(F.struct("sim", "node")).alias("m")).select("id", "facet", F.col("m.node").alias("node"), F.col("m.sim").alias("sim")))
    mass = named.groupBy("node").agg(F.count("*").cast("double").alias("mass"))
    if edges.isEmpty():
        flow = mass.select("node", F.col("node").alias("attractor"), F.lit(1.0).alias("flow"))
    else:
        flow = cut(markov(edges, mass))
    out = named.join(flow, "node", "left")
    facet = F.when(F.col("facet") == "-", None).otherwise(F.substring("facet", 2, 1 << 30))
    return out.select(F.col("id").alias("embedding_id"), facet.alias("facet"), F.coalesce("attractor", "node").alias("cluster"), (F.coalesce("flow", F.lit(1.0)) * F.col("sim").cast("double")).alias("typical"))


def groups(store: DataFrame, **how) -> DataFrame:
    """(embedding_id, facet, first_embedding_id, size, typical) of every unit, single ones too."""
    c = cut(clusters(store, **how))
    each = c.groupBy("cluster").agg(F.min("embedding_id").alias("first_embedding_id"), F.count("*").alias("size"))
    return c.join(each, "cluster").select("embedding_id", "facet", "first_embedding_id", "size", "typical")


def described(store: DataFrame, most_typical: int = 3, **how) -> DataFrame:
    """Every cluster of at least two: (first_embedding_id, facet, size, typical_ids).

    The most typical members are taken from salted parts of a cluster first, so a cluster with a
    third of all rows is not sorted in one task.
    """
    g = groups(store, **how).where("size > 1").withColumn("salt", F.pmod(F.xxhash64("embedding_id"), F.lit(64)))
    order = [F.desc("typical"), F.asc("embedding_id")]
    part = g.withColumn("r", F.row_number().over(Window.partitionBy("first_embedding_id", "salt").orderBy(*order))).where(F.col("r") <= most_typical)
    top = part.withColumn("r", F.row_number().over(Window.partitionBy("first_embedding_id").orderBy(*order))).where(F.col("r") <= most_typical)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "embedding_id"))), lambda x: x.embedding_id), "|")
    return top.groupBy("first_embedding_id", "facet", "size").agg(ids.alias("typical_ids"))

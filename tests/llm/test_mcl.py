import numpy as np

from folioflow.llm import mcl
from tests.llm import helpers as H


def blobs(seed=0, sizes=(40, 12, 5, 2, 1, 1, 1), noise=0.3, dims=64):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in enumerate(sizes):
        centre = rng.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        for k in range(n):
            v = centre + noise * rng.standard_normal(dims) / np.sqrt(dims)
            rows.append((f"g{g}-{k:03d}", (v * rng.uniform(0.5, 3)).astype(float).tolist()))
    return rows


def brute(rows):
    """first id of each unit's group: connected by cosines of at least 0.8 within the facet."""
    out = {}
    for facet in {r[3][6] for r in rows}:
        mine = {r[0]: r[1] for r in rows if r[3][6] == facet}
        ids = sorted(mine)
        x = np.array([mine[i] for i in ids])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        first = list(range(len(ids)))
        changed = True
        while changed:
            new = [min(first[j] for j in np.flatnonzero(row >= 0.8)) for row in x @ x.T]
            changed, first = new != first, new
        out |= {i: ids[f] for i, f in zip(ids, first) if first.count(f) > 1}
    return out


def found(df):
    return {r.embedding_id: r.first_embedding_id for r in df.where("size > 1").collect()}


def test_groups_against_brute_force(spark):
    rows = [H.unit(i, v, f) for f in ("a", None) for i, v in [(f"{f}/{i}", v) for i, v in blobs(seed=len(str(f)))]]
    rows += rows[:30]  # repeated rows
    bad = [H.unit("null", None), H.unit("short", [0.1] * 32), H.unit("zero", [0.0] * 64), H.unit("nan", [float("nan")] * 64), H.unit(None, [0.1] * 64), H.unit("hole", [None] + [0.1] * 63)]
    store = H.clash(spark.createDataFrame([*rows, *bad], H.STORE)).repartition(5)
    assert found(mcl.groups(store)) == brute(rows)


def test_exact_copies_are_one_group_and_null_facet_stays_null(spark):
    v = [0.1] * 63 + [3.0]
    g = mcl.groups(spark.createDataFrame([H.unit(f"c{i:04d}", v, None) for i in range(2000)] + [H.unit("z", v, "null")], H.STORE)).collect()
    big = [r for r in g if r.embedding_id != "z"]
    assert {(r.first_embedding_id, r.size, r.facet) for r in big} == {("c0000", 2000, None)} and len(g) == 2001


def test_the_later_run_counts_for_one_id(spark):
    a, b = [1.0] + [0.0] * 63, [0.0, 1.0] + [0.0] * 62
    rows = [H.unit("x", a, run="r1"), H.unit("x", b, run="r2"), H.unit("y", b), H.unit("z", a)]
    assert found(mcl.groups(spark.createDataFrame(rows, H.STORE))) == {"x": "x", "y": "x"}


def test_empty_and_lonely(spark):
    none = spark.createDataFrame([], H.STORE)
    assert mcl.groups(none).count() == mcl.described(none).count() == 0
    lone = mcl.groups(spark.createDataFrame([H.unit("x", [1.0] * 64)], H.STORE)).collect()
    assert [(r.embedding_id, r.size) for r in lone] == [("x", 1)]


def test_description_names_typical_members(spark):
    d = mcl.described(spark.createDataFrame([H.unit(i, v) for i, v in blobs()], H.STORE)).collect()
    assert sorted(r.size for r in d) == [2, 5, 12, 40] and all(len(r.typical_ids.split("|")) == min(3, r.size) for r in d)


def test_recall_of_links_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.array([v for _, v in blobs(seed=9, sizes=[30] * 20 + [1] * 300, noise=0.55)])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    x = x[rng.permutation(len(x))]
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.8, 1)))}
    q = [bytearray(np.rint(v * 32767).astype(np.int16).tobytes()) for v in x]
    nodes = spark.createDataFrame([("f", i, v) for i, v in enumerate(q)], "facet string, node long, q binary")
    got = {(r.src, r.dst) for r in mcl.links(nodes, len(x)).collect()}
    close = {(i, j) for i, j in want if x[i] @ x[j] >= 0.8002}
    assert len(got & close) >= 0.9 * len(close) and all(x[i] @ x[j] >= 0.7998 for i, j in got)
    sliced = {(r.src, r.dst) for r in mcl.links(nodes, len(x), cell_rows=20).collect()}
    assert sliced == got  # crowded cells are cut up without losing a pair


def pairs_at(cosine, n, seed=5, dims=64):
    rng = np.random.default_rng(seed)
    x, z = rng.standard_normal((2, n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x.astype(np.float32), (cosine * x + np.sqrt(1 - cosine**2) * z).astype(np.float32)


def test_pairs_just_above_the_threshold_meet_whatever_the_number_of_cells():
    x, y = pairs_at(0.801, 1500)
    for k in (16, 256, 2048, 8192):
        d = mcl.directions(k)
        a, b = mcl._top(x, d, mcl._probes_for(k)), mcl._top(y, d, mcl._probes_for(k))
        assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() >= 0.98


def test_recall_of_thin_groups_at_the_cells_of_a_large_table(spark):
    x, y = pairs_at(0.801, 800)
    q = [bytearray(np.rint(v * 32767).astype(np.int16).tobytes()) for v in np.concatenate([x, y])]
    nodes = spark.createDataFrame([("f", i, v) for i, v in enumerate(q)], "facet string, node long, q binary")
    got = {(r.src, r.dst) for r in mcl.links(nodes, 2048 * mcl.PER_CELL).collect()}
    assert len(got & {(i, i + 800) for i in range(800)}) >= 0.98 * 800


def test_no_unit_is_far_from_its_leader_however_crowded_the_cells(spark, monkeypatch):
    monkeypatch.setattr(mcl, "CELL", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = blobs(seed=4, sizes=(1500,), noise=0.3)
        members, leaders = mcl.micro_clusters(spark.createDataFrame([("+f", i, v) for i, v in rows], "facet string, id string, embedding array<float>").repartition(4, "id"))
        led, named = members.collect(), {r.leader for r in leaders.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    assert len(led) == len(rows) and {r.leader for r in led} == named
    assert min(unit[r.id] @ unit[r.leader] for r in led) >= mcl.LEADER - 1e-3


def test_micro_clusters_of_a_facet_do_not_change_with_the_size_of_another(spark):
    few, many = ([(f, f"{f}{i}", v) for i, v in blobs(seed=s, sizes=(n,), noise=0.45)] for f, s, n in (("+a", 1, 300), ("+b", 2, 9000)))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        alone, beside = ({(r.id, r.leader) for r in mcl.micro_clusters(spark.createDataFrame(rows, "facet string, id string, embedding array<float>"))[0].where("facet = '+a'").collect()} for rows in (few, few + many))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(alone) == len(few) and alone == beside


def test_markov_separates_two_cliques_on_a_bridge(spark):
    clique = [(a, b, 0.95) for c in ((0, 1, 2, 3), (10, 11, 12, 13)) for i, a in enumerate(c) for b in c[i + 1 :]]
    edges = spark.createDataFrame([*clique, (3, 10, 0.81)], "src long, dst long, w double")
    mass = spark.createDataFrame([(n, 1.0) for n in (0, 1, 2, 3, 10, 11, 12, 13)], "node long, mass double")
    got = {r.node: r.attractor for r in mcl.markov(edges, mass).collect()}
    assert len({got[n] for n in (0, 1, 2, 3)}) == len({got[n] for n in (10, 11, 12, 13)}) == 1 and got[0] != got[10]

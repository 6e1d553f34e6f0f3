"""Operators on vectors against brute force: near-duplicates, nearest samples, clusters, varied subsets."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from frameloom.llm import candidates as C
from frameloom.llm import chosen_path, hashing, linkage, polytope, variety

SCHEMA = "sample_token string, dinov2 array<float>, clip_image array<float>, token string, class long, vector int, key string, a int, cid int"


def batch_of(spark, rows):
    """Rows of (token, dinov2, clip_image) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(t, d, c, "other", 1, 2, "k", 3, 4) for t, d, c in rows], SCHEMA)


def floats(x):
    return [float(v) for v in np.asarray(x, np.float32)]


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def groups():
    """Vectors in groups of slightly altered copies of differing length, with exact copies and loners."""
    rng = np.random.default_rng(2)
    base = unit(rng.normal(size=(120, 64)))
    x = np.concatenate([base] + [base[: 120 // k] + rng.normal(size=(120 // k, 64)) * s for k, s in ((1, 0.02), (2, 0.025), (3, 0.04), (3, 0.001))])
    x = x * rng.uniform(0.2, 5, (len(x), 1))
    x[5] = x[3]
    x[6] = x[3]
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def dirty(spark, groups):
    rows = [(f"t{i:04d}", floats(v), floats(v)) for i, v in enumerate(groups)]
    rows += rows[:7]  # repeated rows
    rows += [("null", None, None), ("empty", [], []), ("zero", [0.0] * 64, [0.0] * 64), ("short", [1.0] * 63, [1.0] * 63), ("nan", [float("nan")] + [1.0] * 63, None), ("hole", [None] + [1.0] * 63, None), (None, floats(groups[0]), floats(groups[0]))]
    return batch_of(spark, rows)


def pairs_of(x, least):
    u = unit(x.astype(np.float64))
    s = u @ u.T
    return {(f"t{i:04d}", f"t{j:04d}") for i, j in np.argwhere(s >= least) if i < j}


def test_rotations_are_rotations_and_fast():
    r = hashing.rotation(64, 3, 1)
    assert np.allclose(r @ r.T, np.eye(64), atol=1e-5)
    h = hashing.fast_hadamard(np.eye(8))
    assert np.allclose(h @ h.T, np.eye(8)) and set(np.round(np.abs(h) * np.sqrt(8), 6).ravel()) == {1.0}
    assert hashing.rotation(48, 3, 1).shape == (48, 64)


def test_codes_never_lose_a_pair(groups):
    codes, u = hashing.encode(groups), unit(groups.astype(np.float64))
    s, c, off = u @ u.T, hashing.decode(codes) @ hashing.decode(codes).T, hashing.turns(codes)
    turn = off[:, None] + off[None, :]
    for least in (0.9, 0.97):
        assert (c[s >= least] >= hashing.loosest(least, off.max())).all()
    assert (np.abs(np.arccos(np.clip(s, -1, 1)) - np.arccos(np.clip(c, -1, 1))) <= turn + 1e-3).all() and off.max() < 1.2e-3
    for dim in (1, 7, 63, 768):
        x = np.random.default_rng(dim).normal(size=(20, dim))
        assert hashing.width(hashing.encode(x)) == dim and np.allclose(hashing.decode(hashing.encode(x)), unit(x), atol=1e-3)


def test_near_duplicate_pairs_are_complete(spark, dirty, groups):
    got = [tuple(r) for r in chosen_path.near_duplicate_pairs(dirty).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs_of(groups, 0.97)
    assert {("t0003", "t0005"), ("t0003", "t0006"), ("t0005", "t0006")} <= set(got)


def test_near_duplicate_groups_are_components(spark, dirty, groups):
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    links = {}
    for a, b in pairs_of(groups, 0.97):
        parent[find(a)] = find(b)
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    want = {}
    for t in links:
        want.setdefault(find(t), []).append(t)
    got = chosen_path.near_duplicate_groups(dirty).collect()
    assert {(r.sample_token, r.group_token, r.n_links) for r in got} == {(t, min(g), links[t]) for g in want.values() for t in g}


def test_empty_tables(spark, dirty):
    none = dirty.limit(0)
    assert chosen_path.near_duplicate_pairs(none).count() == 0 and chosen_path.near_duplicate_groups(none).count() == 0
    assert polytope.close_neighbour_pairs(none).count() == 0
    labels, clusters, _ = linkage.similarity_clusters(none)
    assert labels.count() == 0 and clusters.count() == 0
    kept, clusters = variety.varied_subset(none, 10)
    assert kept.count() == 0 and clusters.count() == 0


def small_limits(monkeypatch, dense, bucket, small=32):
    monkeypatch.setattr(C, "DENSE", dense)
    monkeypatch.setattr(C, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(C, "SMALL", small)
    monkeypatch.setattr(C, "sampled", lambda rows, number: rows.select("class", "vector").dropDuplicates(["class"]))
    whole = C.layout
    monkeypatch.setattr(C, "layout", lambda sample, seed, roots, probes, dim: whole(sample, seed, roots, probes, dim, 1))


def test_large_buckets_are_split_and_dense_ones_cut(spark, monkeypatch):
    rng = np.random.default_rng(0)
    loose, tight = unit(rng.normal(size=(8000, 16))), unit(rng.normal(size=(1, 16)) + rng.normal(size=(900, 16)) * 0.02)
    x = np.concatenate((loose, tight)).astype(np.float32)
    rows = spark.createDataFrame([(i, floats(v)) for i, v in enumerate(x)], "class long, vector array<float>")
    small_limits(monkeypatch, 300, 300 * 25)
    plan = C.layout(rows, 5, (0, 1), 2, 16)
    assert plan.split and plan.blocks and plan.depth >= 2
    at, cell = plan.cells(unit(x.astype(np.float64)).astype(np.float32), np.arange(len(x)))
    assert set(at) == set(range(len(x))) and np.unique(cell, return_counts=True)[1].max() <= 900
    got = {(r.a, r.b) for r in chosen_path.near_duplicate_classes(rows, len(x), 0.97, dim=16).collect()}
    u = unit(x.astype(np.float64))
    want = {(i, j) for i, j in np.argwhere(np.triu(u @ u.T, 1) >= 0.97)}
    assert got <= want and len(got) >= 0.9995 * len(want)


@pytest.mark.parametrize("depth", [2, 3])
def test_splits_before_the_shuffle_keep_the_recall(spark, dirty, groups, monkeypatch, depth):
    small_limits(monkeypatch, 10**9, 0)
    whole = C.Layout.keys

    def forced(self, x):  # every bucket is split until the depth is reached
        out, again = whole(self, x), None
        for _ in range(depth - 1):
            again = Layout_all(self, out[1])
            out = whole(again, x)
        return out

    def Layout_all(plan, keys):
        return C.Layout(plan.seed, plan.roots, plan.probes, {**plan.split, **{int(k): 1 for k in np.unique(keys)}}, {}, depth)

    monkeypatch.setattr(C.Layout, "keys", forced)
    monkeypatch.setattr(C, "layout", lambda sample, seed, roots, probes, dim: C.Layout(seed, roots, probes, {}, {}, depth))
    got = set(map(tuple, chosen_path.near_duplicate_pairs(dirty).collect()))
    assert got == pairs_of(groups, 0.97)
    want = {(f"t{i:04d}", r + 1, f"t{j:04d}") for i, js in brute_nearest(groups, 5, 0.9).items() for r, j in enumerate(js)}
    near = {(r.sample_token, r["rank"], r.neighbour) for r in polytope.nearest_samples(dirty, "dinov2", 5, 0.9).collect()}
    assert len(near & want) >= 0.995 * len(want)


def test_dense_parts_are_found_in_deep_splits(monkeypatch):
    """A bucket of nearly equal records that splits many times inside a task loses next to no pair."""
    monkeypatch.setattr(C, "SMALL", 16)
    rng = np.random.default_rng(3)
    x = unit(np.repeat(unit(rng.normal(size=(40, 64))), 50, 0) + rng.normal(size=(2000, 64)) * 0.015)
    codes, hit = hashing.encode(x), set()
    for at in C.leaves(codes, 7, 17):
        i, j = C.close_pairs(hashing.decode(codes[at]), 0.97)
        hit |= set(zip(np.minimum(at[i], at[j]).tolist(), np.maximum(at[i], at[j]).tolist()))
    want = np.argwhere(np.triu(x @ x.T, 1) >= 0.97)
    assert sum((i, j) in hit for i, j in want.tolist()) >= 0.999 * len(want)


def test_a_dense_group_sends_few_pairs(spark):
    rng = np.random.default_rng(9)
    x = unit(rng.normal(size=(1, 64)) + rng.normal(size=(2000, 64)) * 0.05).astype(np.float32)
    rows = spark.createDataFrame([(i, floats(v)) for i, v in enumerate(x)], "class long, vector array<float>")
    plan = C.layout(None, 29, tuple(range(polytope.tables_needed(0.9, 64))), 2, 64)
    near = polytope.class_neighbours(rows, 5, 0.9, plan).persist()
    none = spark.createDataFrame([], "class long, n long")
    assert near.count() < 12 * len(x)  # of two million pairs
    assert polytope._settled(near, none, 5, 0.9, False, 64).count() < 8 * len(x)
    df = batch_of(spark, [(f"t{i:04d}", floats(v), None) for i, v in enumerate(x)])
    want = {(f"t{i:04d}", r + 1, f"t{j:04d}") for i, js in brute_nearest(x, 5, 0.9).items() for r, j in enumerate(js)}
    assert {(r.sample_token, r["rank"], r.neighbour) for r in polytope.nearest_samples(df, "dinov2", 5, 0.9).collect()} == want
    loose = {(r.sample_token, r.neighbour) for r in polytope.nearest_samples(df, "dinov2", 5, 0.9, ranked=False).collect()}
    assert loose == {(a, b) for a, _, b in want}


def test_runs_are_repeated_until_the_recall_is_reached(spark, dirty, groups, monkeypatch):
    monkeypatch.setattr(chosen_path, "runs_needed", lambda *a: 1)
    got, want = set(map(tuple, chosen_path.near_duplicate_pairs(dirty).collect())), pairs_of(groups, 0.97)
    assert got <= want and len(got) >= 0.99 * len(want)
    assert chosen_path.missed_share(0, 50, 1000, 3) == 0 and chosen_path.missed_share(100, 50, 1000, 3) > 0.05


def test_a_cosine_too_low_is_refused(spark, dirty):
    with pytest.raises(ValueError):
        chosen_path.near_duplicate_pairs(dirty, threshold=0.3)


def test_exact_pairs_without_broadcast(spark, dirty, groups, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(C, "BROADCAST_BYTES", 0)
    assert set(map(tuple, chosen_path.near_duplicate_pairs(dirty).collect())) == pairs_of(groups, 0.97)


def brute_nearest(x, k, least=-2.0):
    s = np.round(unit(x.astype(np.float64)) @ unit(x.astype(np.float64)).T, 6)
    np.fill_diagonal(s, -9)
    return {i: [j for j in np.lexsort((np.arange(len(s)), -s[i]))[:k] if s[i, j] >= least] for i in range(len(s))}


def test_nearest_samples_above_a_cosine(spark, dirty, groups):
    want = {(f"t{i:04d}", r + 1, f"t{j:04d}") for i, js in brute_nearest(groups, 5, 0.9).items() for r, j in enumerate(js)}
    got = {(r.sample_token, r["rank"], r.neighbour) for r in polytope.nearest_samples(dirty, "dinov2", 5, 0.9).collect()}
    assert got == want


def test_recall_of_the_nearest_at_all(spark):
    x = np.random.default_rng(5).normal(size=(1200, 64)).astype(np.float32)
    df = batch_of(spark, [(f"t{i:04d}", floats(v), None) for i, v in enumerate(x)])
    got = {(r.sample_token, r.neighbour) for r in polytope.nearest_samples(df, "dinov2", 10).collect()}
    want = {(f"t{i:04d}", f"t{j:04d}") for i, js in brute_nearest(x, 10).items() for j in js}
    assert len(got & want) / len(want) >= 0.9


@pytest.mark.parametrize("dense", [10**9, 40])
def test_nearest_of_some_among_all(spark, monkeypatch, dense):
    """Recall of the nearest of unrelated vectors, and of those in a dense group that is cut into blocks."""
    if dense < 10**9:
        small_limits(monkeypatch, dense, 0)
    rng = np.random.default_rng(7)
    x = np.concatenate((rng.normal(size=(1500, 64)), rng.normal(size=(1, 64)) + rng.normal(size=(300, 64)) * 0.1)).astype(np.float32)
    x[11] = x[10]
    df = batch_of(spark, [(f"t{i:04d}", floats(v), None) for i, v in enumerate(x)] + [("t0010", floats(x[10]), None), ("null", None, None), ("zero", [0.0] * 64, None)])
    got = polytope.nearest_of(df, F.col("token").rlike("0$"), "dinov2", 10).collect()
    best = brute_nearest(x, 10)
    want = {(f"t{i:04d}", f"t{j:04d}") for i in range(0, len(x), 10) for j in best[i]}
    found = {(r.sample_token, r.neighbour) for r in got}
    assert len(found & want) >= 0.9 * len(want) and {r.sample_token for r in got} == {a for a, _ in want}
    assert {(r.neighbour, r.sim) for r in got if r.sample_token == "t0010" and r["rank"] == 1} == {("t0011", 1.0)}
    assert len(got) == len(found) == len(want) and polytope.nearest_of(df.limit(0), F.lit(True), "dinov2").count() == 0


def test_copies_offer_their_smallest_tokens(spark):
    df = batch_of(spark, [(f"t{i:02d}", floats(np.eye(64)[0]), None) for i in range(9)] + [("lone", floats(np.eye(64)[1]), None)])
    got = polytope.nearest_samples(df, "dinov2", 3, 0.9).collect()
    by = {t: [r.neighbour for r in sorted(got, key=lambda r: r["rank"]) if r.sample_token == t] for t in ("t00", "t01", "t08", "lone")}
    assert by == {"t00": ["t01", "t02", "t03"], "t01": ["t00", "t02", "t03"], "t08": ["t00", "t01", "t02"], "lone": []}


def test_linkage_in_a_block_is_average_linkage():
    x = unit(np.random.default_rng(1).normal(size=(40, 6)))
    root = linkage.merge_block(x, np.ones(40), 0.5)
    groups = {r: [i for i in range(40) if root[i] == r] for r in set(root)}
    means = np.array([x[g].mean(0) for g in groups.values()])
    s = means @ means.T
    np.fill_diagonal(s, -1)
    assert s.max() < 0.5  # nothing is left to merge
    assert all((x[g] @ x[g].T).sum() >= (0.49 * len(g) * (len(g) - 1) + len(g)) * 0.9 for g in groups.values())


def test_planted_clusters_are_found(spark):
    rng = np.random.default_rng(4)
    centres = unit(rng.normal(size=(6, 64)))
    sizes = (700, 300, 120, 60, 30, 12)
    x = np.concatenate([c + rng.normal(size=(n, 64)) * 0.13 for c, n in zip(centres, sizes)] + [rng.normal(size=(20, 64))])
    own = np.repeat(np.arange(7), (*sizes, 20))
    rows = [(f"t{i:04d}", None, floats(v)) for i, v in enumerate(x)] + [("t0000", None, floats(x[0])), ("bad", None, [0.0] * 64), (None, None, floats(x[1]))]
    prompts = spark.createDataFrame([(10 + i, f"p{i}", floats(c)) for i, c in enumerate(centres)] + [(1, "none", None)], "prompt_id int, prompt string, clip_text array<float>")
    got = {r.sample_token: r.prompt_id for r in linkage.member_prompts(batch_of(spark, rows), prompts).collect()}
    inside = [i for i in range(len(x)) if own[i] < 6]
    assert sum(got.get(f"t{i:04d}") == 10 + own[i] for i in inside) >= 0.99 * len(inside)
    assert sum(f"t{i:04d}" in got for i in range(len(x)) if own[i] == 6) <= 2 and "bad" not in got
    records = linkage.cluster_records(batch_of(spark, rows), prompts).orderBy("cluster_id").collect()
    assert [r.label for r in records][:6] == [f"p{i}" for i in range(6)] and abs(records[0].size - 700) <= 3 and len(records[0].members) == 5
    empty = linkage.label_clusters(spark.createDataFrame([(1, 2, [1.0] * 64)], "cid long, n long, mean array<float>"), prompts.limit(0)).first()
    assert empty.prompt_id is None


@pytest.mark.parametrize("heavy", [10**9, 64])
def test_clusters_of_other_vectors_and_threshold(spark, monkeypatch, heavy):
    """Tight clusters on a common direction, far above the default threshold, with and without cutting heavy buckets."""
    monkeypatch.setattr(linkage, "HEAVY", heavy)
    monkeypatch.setattr(linkage, "block_size", lambda count: 256)
    rng = np.random.default_rng(14)
    common = rng.normal(size=(1, 32)) * 1.5
    centres = unit(common + rng.normal(size=(9, 32)))
    sizes = (500, 200, 90, 60, 60, 40, 30, 20, 10)
    x = np.concatenate([unit(c + rng.normal(size=(n, 32)) * 0.05) for c, n in zip(centres, sizes)])
    own = np.repeat(np.arange(9), sizes)
    across = centres @ centres.T
    np.fill_diagonal(across, -1)
    assert across.max() < 0.9  # within a cluster it is about 0.92
    rows = [(f"t{i:04d}", None, floats(v)) for i, v in enumerate(x)]
    labels, clusters, _ = linkage.similarity_clusters(batch_of(spark, rows), threshold=0.89, dim=32)
    got = {r.token: r.cid for r in labels.collect()}
    groups = {}
    for i, c in enumerate(own):
        groups.setdefault(got[f"t{i:04d}"], []).append(c)
    most = sum(max(map(g.count, set(g))) for g in groups.values())
    assert most >= 0.995 * len(x) and sum(len(g) >= 5 for g in groups.values()) == 9
    assert {r.cid: r.n for r in clusters.collect()} == {c: len(g) for c, g in groups.items()}


def test_nothing_is_left_to_merge(spark):
    x = unit(np.random.default_rng(1).normal(size=(700, 8))).astype(np.float32)
    labels, clusters, _ = linkage.similarity_clusters(batch_of(spark, [(f"t{i:03d}", None, floats(v)) for i, v in enumerate(x)]), threshold=0.5, dim=8)
    m = np.array([r["mean"] for r in clusters.collect()])
    s = m @ m.T
    np.fill_diagonal(s, -1)
    assert s.max() < 0.5 and sum(r.n for r in clusters.collect()) == 700


def test_quotas():
    q = variety.quotas({0: 10_000, 1: 100, 2: 1, 3: 0}, 112)
    assert sum(q.values()) == 112 and q[2] == 1 and q[3] == 0 and 5 < q[0] / q[1] < 15
    assert variety.quotas({0: 3, 1: 50}, 40, equal=True) == {0: 3, 1: 37}
    assert variety.quotas({0: 3, 1: 2}, 99) == {0: 3, 1: 2} and sum(variety.quotas({i: 5 for i in range(9)}, 4).values()) == 4
    assert variety.quotas({}, 5) == {}


def test_varied_subset_shows_rare_kinds_and_not_standstills(spark):
    rng = np.random.default_rng(6)
    centres = unit(rng.normal(size=(12, 64)))
    sizes = [600, 200, 100, *[12] * 9]
    x = np.concatenate([c + rng.normal(size=(n, 64)) * 0.05 for c, n in zip(centres, sizes)])
    still = x[0] + rng.normal(size=(300, 64)) * 0.0005
    x = np.concatenate([x, still])
    own = np.concatenate([np.repeat(np.arange(12), sizes), np.full(300, 99)])
    rows = [(f"t{i:04d}", floats(v), floats(v)) for i, v in enumerate(x)] + [("t0001", floats(x[1]), floats(x[1])), ("copy", floats(x[9]), floats(x[9])), ("none", None, [0.0] * 64), ("half", None, floats(x[3]))]
    kept, clusters = variety.varied_subset(batch_of(spark, rows), 100, k=24)
    tokens = [r.sample_token for r in kept.collect()]
    kinds = [own[int(t[1:])] for t in tokens if t[0] == "t"]
    assert len(tokens) == len(set(tokens)) == 100 and set(range(12)) <= set(kinds) and kinds.count(99) <= 10 and "none" not in tokens
    assert {r.cluster_id: r.kept for r in clusters.collect() if r.kept} == {r.cluster_id: r["count"] for r in kept.groupBy("cluster_id").count().collect()}
    everything, _ = variety.varied_subset(batch_of(spark, rows), 10**6, k=4)
    assert everything.count() == len(x) + 1


def test_a_standstill_and_the_order_of_rows_change_nothing(spark):
    """5,000 exact copies beside 2,000 different records: as many kinds are kept, and the same rows however they are partitioned."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2000, 64)).astype(np.float32)
    rows = [(f"t{i:04d}", floats(v), floats(v)) for i, v in enumerate(x)] + [(f"s{i:04d}", floats(x[7]), floats(x[7])) for i in range(5000)]
    table = batch_of(spark, rows).persist()
    kept = [set(map(tuple, variety.varied_subset(t, 100)[0].collect())) for t in (table.repartition(3), table.repartition(11, "vector", "sample_token"))]
    assert kept[0] == kept[1] and len(kept[0]) == 100
    assert sum(t[0][0] == "s" for t in kept[0]) <= 1 and variety.usable_records(table) == 7000


def test_centres_are_fitted_on_all_records(spark):
    rng = np.random.default_rng(8)
    kinds = unit(rng.normal(size=(9, 64)))
    x = (kinds[np.r_[np.zeros(42_000, int), 1:9]] + rng.normal(size=(42_008, 64)) * 0.002).astype(np.float32)

    def draw(batches):
        for b in batches:
            vectors = pa.array(list(x[b.column(0).to_numpy()]), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array([f"t{i:05d}" for i in b.column(0).to_pylist()]), vectors, vectors], ["sample_token", "dinov2", "clip_image"])

    table = spark.range(len(x)).mapInArrow(draw, "sample_token string, dinov2 array<float>, clip_image array<float>")
    kept, _ = variety.varied_subset(table, 40, k=16)
    got = {r.sample_token: r.cluster_id for r in kept.collect()}
    own = [got.get(f"t{42_000 + i}") for i in range(8)]
    assert None not in own and len(set(own)) == 8  # a cluster and a slot of its own for each rare kind


def test_cells_are_decoded_once(monkeypatch):
    x = unit(np.random.default_rng(4).normal(size=(300, 16)))
    codes, decoded, decode = hashing.encode(x), [], hashing.decode
    monkeypatch.setattr(hashing, "decode", lambda c: decoded.append(len(c)) or decode(c))
    part = C.unit_parts(codes)
    assert all(np.array_equal(part(at), decode(codes[at])) for at in (np.arange(300), np.array([5, 2, 5])))
    assert decoded == [300]
    monkeypatch.setattr(C, "WHOLE_BYTES", 0)
    assert np.array_equal(C.unit_parts(codes)(np.array([7])), decode(codes[[7]]))
    p, q, s = C.nearest(x.astype(np.float32), 3, -2.0, 0.0)
    exact = x @ x.T
    np.fill_diagonal(exact, -9)
    best = np.argsort(-exact, axis=1)[:, :3]
    assert all(set(best[n]) <= set(q[p == n]) for n in range(300)) and np.allclose(s, exact[p, q], atol=1e-5)


@pytest.mark.parametrize("count", [100, 32_768, 32_769, 10**9])
def test_blocks_of_a_round_are_as_large_at_any_size(count):
    assert linkage.block_size(count) == linkage.block_size(10**6)


def test_few_nodes_are_one_block(spark):
    x = unit(np.random.default_rng(5).normal(size=(400, 8)) + 1.0)
    nodes = spark.createDataFrame([(i, 1, floats(v)) for i, v in enumerate(x)], "cid long, n long, mean array<float>")
    left = linkage._round(nodes, 0.5, 0, 400).where("mean is not null")
    keys = linkage._hashed(nodes, 0, 0, 71, {}).select("key").distinct().count()
    assert keys == 1 and left.count() < 400
    assert left.select(F.spark_partition_id().alias("p")).distinct().count() == 1


def test_linkage_looks_again_only_where_the_best_is_gone():
    """The groups are those of a search of all rows after each step; the rows searched are fewer."""
    searched = []

    class Counted(np.ndarray):
        def argmax(self, *args, **kwargs):
            searched.append(len(self))
            return np.asarray(self).argmax(*args, **kwargs)

    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 16))[rng.integers(0, 30, 600)] + 0.6 * rng.normal(size=(600, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    n = rng.integers(1, 4, 600)
    got = linkage.merge_block(x, n, 0.4, linkage.block_similarities(x).view(Counted))
    # the mean of a group stands for it, so the mutual best of all means merge
    root, groups, all_rows = np.arange(600), {i: (x[i].astype(np.float64), int(n[i])) for i in range(600)}, 0
    while True:
        at = sorted(groups)
        m = np.array([groups[i][0] for i in at])
        s = m @ m.T
        np.fill_diagonal(s, -9)
        best = s.argmax(1)
        all_rows += len(at)
        pairs = [(k, int(best[k])) for k in range(len(at)) if best[best[k]] == k < best[k] and s[k, best[k]] >= 0.4]
        if not pairs:
            break
        for a, b in pairs:
            (u, p), (v, q) = groups[at[a]], groups.pop(at[b])
            groups[at[a]] = ((p * u + q * v) / (p + q), p + q)
            root[root == at[b]] = at[a]
    assert np.array_equal(got, root) and 1 < len(groups) < 300
    assert sum(searched) < all_rows

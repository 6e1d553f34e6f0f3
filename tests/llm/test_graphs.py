"""Components, groups, scene names and splits."""

import random

import pytest
from pyspark.sql import functions as F

from frameloom.llm import components as K
from frameloom.llm import splits as S


def roots(pairs):
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        parent[find(a)] = find(b)
    groups = {}
    for i in list(parent):
        groups.setdefault(find(i), []).append(i)
    return {(i, min(g)) for g in groups.values() if len(g) > 1 for i in g}


@pytest.mark.parametrize("find", [K.min_label_components, K.star_components])
def test_components(spark, find):
    rng = random.Random(1)
    pairs = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(150)] + [("hub", f"h{i}") for i in range(200)]
    pairs += [(f"r{rng.randrange(300)}", f"r{rng.randrange(300)}") for _ in range(200)]
    dirty = [*pairs, *pairs[:50], *((b, a) for a, b in pairs[:50]), ("x", None), (None, None), ("y", "y")]
    rng.shuffle(dirty)
    df = spark.createDataFrame([(a, b, 1, "n") for a, b in dirty], "src string, dst string, u int, label string")
    assert set(map(tuple, find(df).select("node", "label").collect())) == roots([p for p in pairs if p[0] != p[1]])
    assert find(df.limit(0)).count() == 0


def test_a_giant_component_and_hot_nodes(spark, monkeypatch):
    """A hub, a long chain and a component that holds nearly all, with keys of more than 20 rows sent instead of shuffled."""
    monkeypatch.setattr(K, "HOT", 20)
    rng = random.Random(2)
    pairs = [("hub", f"h{i:04d}") for i in range(400)] + [(f"h{i:04d}", f"c{i:04d}") for i in range(0, 400, 3)] + [(f"k{i:04d}", f"k{i + 1:04d}") for i in range(300)]
    pairs += [(f"k{rng.randrange(300):04d}", f"h{rng.randrange(400):04d}") for _ in range(40)] + [("x", "y")]
    got = K.min_label_components(spark.createDataFrame(pairs, "src string, dst string")).collect()
    want = roots(pairs)
    assert {(r.node, r.label) for r in got} == want and len(got) == len(want)
    assert {r["size"] for r in got} == {2, len(want) - 2}


def test_numbers_and_equal_hashes(spark, monkeypatch):
    whole = F.xxhash64
    monkeypatch.setattr(K.F, "xxhash64", lambda *c: whole(*c) % 7 if len(c) == 2 and not isinstance(c[0], str) and "0" in str(c[0]) else whole(*c))
    pairs = [(i, i + 1) for i in range(0, 60, 3)]
    df = spark.createDataFrame(pairs, "src long, dst long")
    assert {(r.node, r.label, r["size"]) for r in K.min_label_components(df).collect()} == {(n, a, 2) for a, b in pairs for n in (a, b)}


def test_consolidated_groups(spark):
    matches = spark.createDataFrame(
        [("A ", "b", True), ("b", "C", True), ("c", "d", False), ("d", "e", None), ("f", None, True), ("g", "g", True), (" ", "z", True), ("a", "B", True)], "src_token string, dst_token string, is_match boolean"
    )
    groups = spark.createDataFrame([("r", "M", ["n", None, "M", "n "]), ("r", None, ["q", "p"]), ("r", "solo", ["solo"]), ("r", "w", None), ("r", "n", ["c"]), ("r", None, [])], "run_id string, representative string, members array<string>")
    got = set(map(tuple, K.consolidated_groups(matches, groups).collect()))
    assert got == {(t, "a") for t in "abcmn"} | {("p", "p"), ("q", "p")}
    rows = K.group_records(matches, groups).collect()
    assert {(r.representative, r.n_members, tuple(r.members)) for r in rows} == {("a", 5, tuple("abcmn")), ("p", 2, ("p", "q"))}
    assert K.consolidated_groups(matches.limit(0), groups.limit(0)).count() == 0
    short = K.group_records(matches, groups, most=2).collect()
    assert sorted(m for r in short for m in r.members) == sorted("abcmn") + ["p", "q"] and max(len(r.members) for r in short) <= 2
    assert len({(r.representative, r.part) for r in short}) == len(short)


NAMES = [
    ("scene-0007-toll_plaza", "7t"), ("Scene0007TollPlaza", "7t"), ("toll_plaza-scene-0007", "7t"), ("scene–07–toll-plaza\xa0", "7t"), ("import 2 scene-0007-tol_plaza", "7t"), ("raw_scene-0007-toll__plaza_v3", "7t"),
    ("scene-0007-bridge_deck", "7b"), ("bridge-deck scnee 7", "7b"), ("scene-70-toll_plaza", "70t"), ("log4:scene-70-toll_lpaza", "70t"), ("scene-8-toll_plaza", "8t"), ("scene-9-bridge_deck", "9b"), ("scene-10-bridge_deck", "10b"),
    ("scene-11-bus_corridor", "11c"), ("scene-12-bus_corridor", "12c"), ("scene-12-wet_corridor", "12w"), ("scene-13-wet_corridor", "13w"), ("scene-7-alpha_beta", "7a"), ("scene-13-toll_plaza", "13t"),
]


def samples_of(spark, names):
    rows = [(f"s{i:03d}", n, "x", "y", 1) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "sample_token string, scene_name string, token string, label string, key int")


def test_scene_names(spark):
    df = samples_of(spark, [n for n, _ in NAMES] * 2 + [None, "", "   ", "no number", "12345", "scene-", "é" * 5000])
    got = {tuple(r) for r in S.same_scene_pairs(df).collect()}
    want = {(a, b) for a, x in NAMES for b, y in NAMES if x == y and a < b}
    assert got == want
    assert S.same_scene_pairs(df.limit(0)).count() == 0


def test_splits_keep_scenes_together_in_proportion(spark):
    names = ["scene-0007-toll_plaza"] * 200 + ["Scene0007TollPlaza"] * 30 + [f"scene-{i}-bridge_deck" for i in range(20, 420) for _ in range(2)] + [None] * 100 + [""] * 20
    df = samples_of(spark, names)
    df = df.unionByName(df.limit(50)).unionByName(df.where("sample_token is null"))
    both = spark.createDataFrame([("s000", "scene-400-bridge_deck", "x", "y", 1), (None, "scene-5-x", "", "", 1)], df.schema)  # one token, two scenes
    shares = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1), ("none", 0.0), (None, 0.5), ("nil", None)], "split_name string, share double")
    got = S.assign_splits(df.unionByName(both), shares).collect()
    split = {r.sample_token: r.split_name for r in got}
    assert len(got) == len(split) == len(names)
    scene = {}
    for i, n in enumerate(names):
        if n:
            scene.setdefault(n.lower().replace("-", "").replace("_", "").replace("0007", "7"), set()).add(split[f"s{i:03d}"])
    assert all(len(v) == 1 for v in scene.values())
    assert scene["scene400bridgedeck"] == scene["scene7tollplaza"]
    share = {s: sum(v == s for v in split.values()) / len(split) for s in set(split.values())}
    assert set(share) == {"train", "validation", "test"} and abs(share["train"] - 0.8) < 0.11 and all(share[s] > 0.02 for s in share)
    again = {r.sample_token: r.split_name for r in S.assign_splits(df.unionByName(both).repartition(7), shares).collect()}
    assert again == split
    fixed, less = ({r.sample_token: r.split_name for r in S.assign_splits(d, shares, fixed=True).collect()} for d in (df, df.where("scene_name not like '%-3%'")))
    assert len(fixed) == len(names) and all(fixed[t] == s for t, s in less.items()) and set(fixed.values()) == {"train", "validation", "test"}
    assert S.assign_splits(df.limit(0), shares).count() == 0
    assert {r.split_name for r in S.assign_splits(df, shares.limit(0)).collect()} == {None}

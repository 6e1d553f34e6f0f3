"""The registered queries of the problems on the smallest test data: against their SQL, or against what defines their result."""

import glob
import os
import re
from collections import Counter, defaultdict

import pytest

from frameloom.llm import queries as Q

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.fixture(scope="module")
def rows(spark):
    done = {}

    def run(name):
        if name not in done:
            done[name] = Q.queries()[name](spark, FOLDER).collect()
        return done[name]

    return run


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(rows, duck, name):
    found = duck.execute(Q.oracle_sql()[name])
    names = [x[0] for x in found.description]
    got = rows(name)
    assert got and sorted(got[0].asDict()) == sorted(names)
    want = sorted(tuple(map(str, (dict(zip(names, r))[c] for c in sorted(names)))) for r in found.fetchall())
    assert sorted(tuple(str(r[c]) for c in sorted(names)) for r in got) == want


def usable(duck, column):
    return {t for (t,) in duck.execute(f"SELECT DISTINCT sample_token FROM encoded_batch WHERE sample_token IS NOT NULL AND len({column}) = 64 AND list_max(list_transform({column}, lambda x: abs(x))) > 0").fetchall()}


def test_kept_list_has_its_size_and_counts(rows, duck):
    kept, clusters = rows("p1_kept"), {r.cluster_id: r for r in rows("p1_clusters")}
    either = usable(duck, "dinov2") | usable(duck, "clip_image")
    target = max(duck.execute("SELECT max(target_size) FROM curation_set").fetchone()[0] or 0, len(either) // 100, 1)
    assert len({r.sample_token for r in kept}) == len(kept) <= target and {r.sample_token for r in kept} <= either
    assert len(kept) == min(target, sum(r["size"] for r in clusters.values()))
    assert all(clusters[c].kept == n for c, n in Counter(r.cluster_id for r in kept).items())
    assert all(r.per_cluster_kept == clusters[r.cluster_id].kept for r in kept)


def test_nearest_are_found(rows, duck):
    spaces = " UNION ALL ".join(f"SELECT '{c}' AS space, sample_token AS token, any_value({c})::DOUBLE[] AS v FROM encoded_batch WHERE sample_token IS NOT NULL AND len({c}) = 64 AND list_max(list_transform({c}, lambda x: abs(x))) > 0 GROUP BY 2" for c in ("dinov2", "clip_image"))
    want = duck.execute(f"""WITH u AS ({spaces}), c AS (SELECT a.space, a.token AS t, b.token AS o, round(list_cosine_similarity(a.v, b.v), 6) AS sim FROM u a JOIN u b ON a.space = b.space AND a.token <> b.token
        WHERE ('0x' || substr(md5(a.token), 1, 8))::BIGINT % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY space, t ORDER BY sim DESC, o) AS k FROM c) SELECT space, t, o FROM r WHERE k <= 10""").fetchall()
    got = {(r.space, r.sample_token, r.neighbour) for r in rows("p4_nearest")}
    assert want and len(got & set(want)) >= 0.9 * len(want) and {g[:2] for g in got} == {w[:2] for w in want}


def test_scene_pairs_agree_with_plain_spelling(rows, duck):
    """Names that differ in case and separators only are one scene; names with other numbers never are."""
    names = [n for (n,) in duck.execute("SELECT DISTINCT scene_name FROM samples WHERE scene_name <> ''").fetchall()]
    plain = defaultdict(set)
    for n in names:
        if m := re.fullmatch(r"scene[-_ ]?0*(\d+)[-_ ]([a-z]+[-_ ]?[a-z]+)", n.lower()):
            plain[m[1], re.sub("[-_ ]", "", m[2])].add(n)
    got = {(r.scene_name_a, r.scene_name_b) for r in rows("p3_found")}
    assert all((a, b) in got for group in plain.values() for a in group for b in group if a < b)
    number = lambda n: {x.lstrip("0") or "0" for x in re.findall(r"\d+", n)}
    assert got and all(a < b and number(a) & number(b) for a, b in got)


def test_splits_never_cut_a_scene(rows, duck):
    split = {r.sample_token: r.split_name for r in rows("p3_splits")}
    assert set(split) == {t for (t,) in duck.execute("SELECT DISTINCT sample_token FROM samples WHERE sample_token IS NOT NULL").fetchall()}
    scene = defaultdict(set)
    for t, n in duck.execute("SELECT sample_token, scene_name FROM samples WHERE sample_token IS NOT NULL AND scene_name <> ''").fetchall():
        scene[n].add(split[t])
    assert all(len(s) == 1 for s in scene.values())
    assert all(scene[r.scene_name_a] == scene[r.scene_name_b] for r in rows("p3_found"))


def test_groups_list_their_members(rows):
    members = {(r.representative, m) for r in rows("p5_groups") for m in r.members}
    assert members == {(r.group_token, r.sample_token) for r in rows("p5_found")}
    sizes = Counter(r.group_token for r in rows("p5_found"))
    assert all(r.n_members == sizes[r.representative] and len(r.members) <= 1000 for r in rows("p5_groups"))


def test_cluster_sizes_add_up(rows, duck):
    found, clusters = rows("p6_found"), rows("p6_clusters")
    assert sum(r["size"] for r in clusters) == len({r.sample_token for r in found}) == len(found)
    assert {r.sample_token for r in found} <= usable(duck, "clip_image") and len(found) > 0.8 * len(usable(duck, "clip_image"))
    assert sorted(r.cluster_id for r in clusters) == list(range(len(clusters))) and all(1 <= len(r.members) <= 5 for r in clusters)
    by_size = [r["size"] for r in sorted(clusters, key=lambda r: r.cluster_id)]
    assert by_size == sorted(by_size, reverse=True)
    own = {r.sample_token: r.prompt_id for r in found}
    assert all(own[m] == r.prompt_id for r in clusters for m in r.members)


def test_offsets_cover_the_texts(rows, duck):
    ids, texts = {r.doc_id: r.ids for r in rows("p7_ids")}, dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    for r in rows("p7_offsets"):
        assert r.ids == ids[r.doc_id] and len(r.starts) == len(r.ends) == len(r.ids)
        assert not r.ids or (r.starts[0], r.ends[-1]) == (0, len(texts[r.doc_id]))
        assert all(s <= e and t >= e - 1 for s, e, t in zip(r.starts, r.ends, r.starts[1:]))


def test_containers_hold_all_tokens(rows, duck):
    ids = {r.doc_id: len(r.ids) for r in rows("p7_ids")}
    room = dict(duck.execute("SELECT target_id, capacity_tokens FROM pack_targets").fetchall())
    load, got = defaultdict(int), defaultdict(int)
    for r in rows("p8_containers"):
        load[r.target_id, r.container_id] += r.n_tokens
        got[r.target_id, r.doc_id] += r.n_tokens
        assert r.piece == 0 or ids[r.doc_id] > room[r.target_id]
    assert all(n <= room[t] for (t, _), n in load.items())
    assert all(got[t, d] == n for t in room for d, n in ids.items()) and len(got) == len(room) * len(ids)
    for t, c in room.items():
        own = [n for (x, _), n in load.items() if x == t]
        assert len(own) <= max(-(-sum(own) // c) + 1, 1.03 * sum(own) / c)


def test_bands_are_of_documents_with_prose(rows, duck):
    got = rows("p9_found")
    assert got and len({r.doc_id for r in got}) == len(got) and {r.band for r in got} <= set(range(1, 6))
    told = dict(duck.execute("SELECT doc_id, avg(band) FROM reading_labels WHERE band BETWEEN 1 AND 5 GROUP BY doc_id").fetchall())
    both = [(r.band, told[r.doc_id]) for r in got if r.doc_id in told]
    assert len(both) >= 10 and sum(abs(a - b) <= 1 for a, b in both) >= 0.9 * len(both)

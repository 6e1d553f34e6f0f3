"""What the exact comparisons send doesn't grow with the number of blocks."""

import numpy as np
import pytest

from frameloom.operators import blocks, curate, graph, project
from frameloom.operators.order import ranked
from frameloom.plans import queries as core
from frameloom.session import stage
from tests.test_core import frame, gaussian

QUERIES = ["near_dup_pairs", "near_dup_groups", "near_dup_components", "duplicates_json", "dropped_duplicates", "surviving_samples", "curation_set_unclustered", "knn_distance", "outliers", "api_outliers", "outlier_gallery", "curation_set", "stratified_take", "boosted_outliers", "per_cluster_kept"]
SMOKE = "/root/testdata/sf0.001"


def shuffled(spark, run):
    """Bytes that ``run`` writes to shuffles."""
    from pyspark import SparkContext

    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        SparkContext._active_spark_context._jsc.sc().listenerBus().waitUntilEmpty()
        executors = store.executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    before = written()
    run()
    return written() - before


@pytest.mark.parametrize("name", QUERIES)
def test_query_sends_no_copies_for_blocks(spark, monkeypatch, name):
    def run():
        core.queries()[name](spark, SMOKE).write.format("noop").mode("overwrite").save()

    wide = shuffled(spark, run)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(blocks, "FILE_ROWS", 64, raising=False)
    assert shuffled(spark, run) < 1.2 * wide + 50_000


def test_neighbour_graph_sends_no_copies(spark, monkeypatch):
    df = frame(spark, gaussian(300, 64))

    def run():
        project.neighbour_graph(df, 5).write.format("noop").mode("overwrite").save()

    wide = shuffled(spark, run)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(blocks, "FILE_ROWS", 64, raising=False)
    assert shuffled(spark, run) < 1.2 * wide + 50_000


def test_pairs_over_several_files(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FILE_ROWS", 32, raising=False)
    x = gaussian(300, 64, noise=0.1)
    x[200] = x[3]
    found = blocks.pairs_above(frame(spark, x), 0.97)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    s = x @ x.T
    rows = found.collect()
    assert len(rows) == len({(r.a, r.b) for r in rows})
    assert {(r.a, r.b) for r in rows} == {(f"s{i:05d}", f"s{j:05d}") for i in range(300) for j in range(i + 1, 300) if s[i, j] >= 0.97}
    assert all(abs(r.sim - s[int(r.a[1:]), int(r.b[1:])]) < 1e-12 for r in rows)


def test_top_k_over_several_files_with_ties(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FILE_ROWS", 32, raising=False)
    x = gaussian(300, 64, noise=0.4)
    x[10:300:7] = x[3]  # equal vectors in every file: ties go to the smaller token
    df = frame(spark, x)
    found = blocks.top_k(df, df, 5, exclude_self=True)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    s = np.round(x @ x.T, 10)
    np.fill_diagonal(s, -9)
    got = {(r.query, r["rank"]): r.token for r in found.collect()}
    assert got == {(f"s{i:05d}", n + 1): f"s{j:05d}" for i in range(300) for n, j in enumerate(np.lexsort((np.arange(300), -s[i]))[:5])}


GROUPED = ["near_dup_groups", "duplicates_json", "dropped_duplicates", "surviving_samples", "curation_set_unclustered", "stratified_take", "curation_set", "boosted_outliers", "per_cluster_kept"]


@pytest.fixture
def no_broadcast(spark):
    """Joins are shuffled, as those of larger tables are."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", GROUPED)
def test_groups_are_summed_where_their_vectors_are(spark, no_broadcast, name):
    """Beside the two spaces' vectors as they are read, and tables of tokens, less than one copy of the vectors is sent."""
    read = core._vectors(spark, SMOKE, "dinov2")
    vectors = read.count() * 64 * 8
    once = shuffled(spark, lambda: [core._vectors(spark, SMOKE, c).write.format("noop").mode("overwrite").save() for c in ("dinov2", "clip_image")])
    sent = shuffled(spark, lambda: core.queries()[name](spark, SMOKE).write.format("noop").mode("overwrite").save())
    assert sent < once + vectors


def test_components_drop_edges_inside_a_part(spark, no_broadcast):
    """Edges are sent for the first round, not for each."""
    rng = np.random.default_rng(3)
    parts = [[f"n{i:06d}" for i in rng.permutation(1_000_000)[:24]] for _ in range(40)]
    pairs = [(a, b) for part in parts for k, a in enumerate(part) for b in part[k + 1 :]]
    pairs += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(100)]
    edges = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    once = shuffled(spark, lambda: edges.unionByName(edges.selectExpr("b as a", "a as b")).repartition("a").write.format("noop").mode("overwrite").save())
    sent = shuffled(spark, lambda: graph.components(edges).write.format("noop").mode("overwrite").save())
    assert sent < 3 * once


def test_outliers_are_compared_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(curate, "ranked", lambda far, order, name="rank": seen.append(far) or ranked(far, order, name))
    found = curate.find_outliers(frame(spark, gaussian(60, 16)), 5, 0.1)
    assert found.count() == 6
    assert "MapInArrow" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_links_have_the_components_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FILE_ROWS", 64, raising=False)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(blocks, "TILE", 8)
    x = gaussian(400, 64, noise=0.1)
    x[20:400:3] = x[7]  # a standstill in every file
    df = blocks.shelf(frame(spark, x))
    pairs = blocks.pairs_above(df, 0.97).collect()
    links = [(r.a, r.b) for r in blocks.links_above(df, 0.97).collect()]
    assert len(pairs) > 127 * 126 // 2 and set(links) <= {(r.a, r.b) for r in pairs}
    files = len(df._shelved)
    assert files > 3 and len(links) == len(set(links)) < files * 400 + 400 and len(links) < len(pairs) // 4

    def labels(edges):
        return {(r.token, r.root) for r in graph.components(spark.createDataFrame(edges, "a string, b string")).collect()}

    assert labels(links) == labels([(r.a, r.b) for r in pairs])


def test_shelf_keeps_single_floats(spark):
    rows = core._vectors(spark, SMOKE, "dinov2")
    held = blocks.shelf(rows)
    assert spark.read.parquet(*held._shelved).schema["v"].dataType.simpleString() == "array<float>"
    want = {r.token: list(r.v) for r in rows.collect()}
    assert {r.token: list(r.v) for r in held.collect()} == want
    for tokens, x in blocks._stretches(held._shelved, 100):
        assert all(want[t] == v for t, v in zip(tokens.tolist(), x.tolist()))


def test_rounds_of_the_projection_send_no_pairs(spark, no_broadcast):
    df = blocks.shelf(frame(spark, gaussian(600, 64)))

    def run(rounds):
        return shuffled(spark, lambda: project.neighbour_projection(df, 5, rounds).write.format("noop").mode("overwrite").save())

    once = shuffled(spark, lambda: project.neighbour_graph(df, 5).write.format("noop").mode("overwrite").save())
    assert run(8) - run(2) < once  # six rounds


def test_projection_over_several_cells(spark, monkeypatch):
    df = blocks.shelf(frame(spark, gaussian(300, 64, noise=0.4)))
    want = {r.sample_token: (r.x, r.y) for r in project.neighbour_projection(df, 5, 6).collect()}
    monkeypatch.setattr(project, "_cell_count", lambda rows: 7, raising=False)
    got = {r.sample_token: (r.x, r.y) for r in project.neighbour_projection(df, 5, 6).collect()}
    assert len(want) == 300 and got.keys() == want.keys()
    assert all(abs(a - b) < 1e-6 for t in want for a, b in zip(want[t], got[t]))


LINKED = ["curation_set_unclustered", "dropped_duplicates", "duplicates_json", "near_dup_components", "stratified_take", "surviving_samples", "curation_set", "boosted_outliers", "per_cluster_kept"]


@pytest.mark.parametrize("name", LINKED)
def test_groups_write_no_pair_for_each_two_members(spark, monkeypatch, name):
    written = []

    class Counted(graph.Stage):
        def __init__(self, frame, kind):
            super().__init__(frame, kind)
            if kind == "edges":
                written.append(self.frame.count())

    monkeypatch.setattr(graph, "Stage", Counted)
    core.queries()[name](spark, SMOKE)
    sets = core.queries()["near_dup_components"](spark, SMOKE).groupBy("root").count().collect()
    assert written[0] == sum(r["count"] - 1 for r in sets)
    assert written[0] < core.queries()["near_dup_pairs"](spark, SMOKE).count()


FLOATS = ["api_outliers", "knn_distance", "outlier_gallery"]


@pytest.mark.parametrize("name", FLOATS)
def test_shelves_are_written_in_single_floats(spark, monkeypatch, name):
    seen = []
    monkeypatch.setattr(blocks, "stage", lambda rows, *more: seen.append(dict(rows.dtypes)["v"]) or stage(rows, *more))
    core.queries()[name](spark, SMOKE)
    assert seen == ["array<float>"]


def repeated():
    x = gaussian(120, 64, noise=0.3)
    return np.concatenate([x[:30]] * 9 + [x[30:]])[np.random.default_rng(1).permutation(360)]


def test_equal_vectors_are_linked_once(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FILE_ROWS", 32, raising=False)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    x = repeated()
    x[5] *= 1e-9 / np.linalg.norm(x[5])  # too short to be near anything, its copy as well
    x[350] = x[5]
    df = blocks.shelf(frame(spark, x))
    pairs = {(r.a, r.b) for r in blocks.pairs_above(df, 0.999).collect()}
    links = [(r.a, r.b) for r in blocks.links_above(df, 0.999).collect()]
    assert len(df._shelved) > 8 and len(pairs) > 900
    assert set(links) <= pairs and len(links) < 300  # before, one for each file that holds a copy

    def labels(edges):
        return {(r.token, r.root) for r in graph.components(spark.createDataFrame(list(edges), "a string, b string")).collect()}

    assert labels(links) == labels(pairs)


class Near(blocks.Stage):
    """Keeps the rows of the stages of answers."""

    rows: list[int] = []

    def __init__(self, frame, name="stage", *more, **named):
        super().__init__(frame, name, *more, **named)
        if name == "near":
            Near.rows.append(self.frame.count())


@pytest.mark.parametrize("k", [3, 8, 9, 359, 360])
def test_neighbours_of_equal_vectors(spark, monkeypatch, k):
    monkeypatch.setattr(blocks, "FILE_ROWS", 32, raising=False)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(blocks, "Stage", Near)
    monkeypatch.setattr(Near, "rows", [])
    x = repeated()
    got = {r.sample_token: r.knn_distance for r in curate.knn_distance(frame(spark, x), k).collect()}
    s = np.round(x @ x.T, 10)
    np.fill_diagonal(s, -9)
    want = {f"s{i:05d}": 1 - np.sort(s[i])[::-1][k - 1] for i in range(360)} if k < 360 else {}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)
    assert Near.rows == [120 if k < 360 else 0]


COMPARED = ["knn_distance", "curation_set", "boosted_outliers", "per_cluster_kept", "api_outliers", "outlier_gallery"]


@pytest.mark.parametrize("name", COMPARED)
def test_query_compares_equal_vectors_once(spark, monkeypatch, tmp_path, name):
    batch = spark.read.parquet(f"{SMOKE}/encoded_batch.parquet")
    batch.unionByName(batch.selectExpr("sample_token || '-2' as sample_token", "dinov2", "clip_image", "backend")).write.parquet(f"{tmp_path}/encoded_batch.parquet")
    for table in ("samples", "failure_prompts"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMOKE}/{table}.parquet")
    monkeypatch.setattr(blocks, "Stage", Near)
    monkeypatch.setattr(Near, "rows", [])
    core.queries()[name](spark, str(tmp_path))
    different = core._vectors(spark, SMOKE, "clip_image")._raw.select("v").distinct().count()
    assert Near.rows == [different]


UNSUMMED = ["dropped_duplicates", "duplicates_json", "stratified_take", "surviving_samples", "curation_set", "boosted_outliers", "per_cluster_kept"]


@pytest.mark.parametrize("name", UNSUMMED)
def test_query_of_members_sums_no_vectors(spark, monkeypatch, name):
    def refuse(*_):
        raise AssertionError("vectors are summed")

    monkeypatch.setattr(curate, "group_sums", refuse)
    core.queries()[name](spark, SMOKE).write.format("noop").mode("overwrite").save()

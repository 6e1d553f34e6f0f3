"""Core operators against brute force, invariants and hand-made cases."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.functions import images
from frameloom.functions import text as T
from frameloom.functions.vectors import cosine, l2_normalize, search_cosine
from frameloom.operators import benchmark, blocks, curate, density, encode, graph, index, order, project, report
from frameloom.plans.pipeline import CurationConfig, CurationPipeline, CurationService
from frameloom.schema import CLUSTER, DUPLICATE_GROUP, OUTLIER
from frameloom.sources import artifacts
from frameloom.sources import samples as S
from frameloom.streaming import ingest

VECTOR = "token string, v array<double>"


def gaussian(n, dim, centres=10, seed=0, noise=0.3):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim)) * 2
    x = c[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(f"s{i:05d}", [float(v) for v in r]) for i, r in enumerate(x)], VECTOR)


def test_vector_functions(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    out = row.select(l2_normalize(F.col("a")), cosine(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("z")), search_cosine(F.col("a"), F.col("b"))).first()
    assert np.allclose(out[0], [0.6, 0.8]) and abs(out[1] - 0.96) < 1e-6 and out[2] == 0 and abs(out[3] - 0.96) < 1e-6


def test_text_functions(spark):
    rows = spark.createDataFrame([("Heavy RAIN at Night", ["b", "a"]), ("fog, dawn", []), ("nothing", ["x"])], "d string, t array<string>")
    got = rows.select(T.infer_weather(F.col("d")), T.infer_time_of_day(F.col("d")), T.manifest_hash(F.col("t"))).collect()
    assert [tuple(r)[:2] for r in got] == [("rain", "night"), ("fog", "dusk"), ("clear", "day")]
    assert got[1][2] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    import hashlib

    assert got[0][2] == hashlib.sha256(b"a\nb\n").hexdigest()


def test_unit_vectors_leave_out_unusable(spark):
    rows = [("a", [1.0, 0.0], 1), ("a", [1.0, 0.0], 2), ("z", [0.0, 0.0], 1), ("s", [1.0], 1), ("n", None, 1), (None, [1.0, 1.0], 1), ("i", [float("inf"), 1.0], 1), ("q", [float("nan"), 1.0], 1), ("m", [None, 1.0], 1)]
    batch = spark.createDataFrame(rows, "sample_token string, x array<float>, v int")
    assert [r.token for r in blocks.unit_vectors(batch, "x", 2).collect()] == ["a"]


@pytest.mark.parametrize("block", [64, 4096])
def test_pairs_and_top_k_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK", block)
    x = gaussian(300, 16)
    x[7] = x[3]
    df, s = frame(spark, x), x @ x.T
    got = {(r.a, r.b) for r in blocks.pairs_above(df, 0.97).collect()}
    assert got == {(f"s{i:05d}", f"s{j:05d}") for i in range(300) for j in range(i + 1, 300) if s[i, j] >= 0.97}
    hits = blocks.top_k(df.limit(20), df, 5).collect()
    order = np.lexsort((np.tile(np.arange(300), (300, 1)), -np.round(s, 10)))
    by = {}
    for r in hits:
        by.setdefault(r.query, {})[r["rank"]] = r.token
    for q, ranks in by.items():
        assert [ranks[i] for i in range(1, 6)] == [f"s{j:05d}" for j in order[int(q[1:])][:5]]
    without = blocks.top_k(df, df, 3, exclude_self=True).where("query = token").count()
    assert without == 0


def test_top_k_with_fewer_rows_and_none(spark):
    df = frame(spark, gaussian(3, 4))
    assert blocks.top_k(df, df, 10).count() == 9
    assert blocks.top_k(df, df.limit(0), 10).count() == 0
    assert blocks.pairs_above(df.limit(0), 0.5).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(12)] + [("x", "y"), ("x", None), ("y", "x")], "a string, b string")
    got = dict(graph.components(edges).collect())
    assert {got[f"n{i:03d}"] for i in range(13)} == {"n000"} and got["y"] == "x" and len(got) == 15
    assert graph.components(edges.limit(0)).count() == 0


def test_near_duplicate_groups_follow_the_formula(spark):
    x = np.eye(60)
    x[1] = x[0] + 0.05 * x[2]
    x[1] /= np.linalg.norm(x[1])
    row = curate.find_near_duplicates(frame(spark, x), 0.99).where("representative = 's00000'").first()
    assert row.members == ["s00000", "s00001"] and row.n_members == 2
    assert abs(row.mean_similarity - (x[0] @ x[1]) / 2) < 1e-9 and abs(row.mean_pairwise_similarity - x[0] @ x[1]) < 1e-9


def test_outliers(spark):
    x = gaussian(100, 8, centres=2)
    x[40] = -x.mean(0) / np.linalg.norm(x.mean(0))
    got = curate.find_outliers(frame(spark, x), 10, 0.05).orderBy("rank").collect()
    assert len(got) == 5 and [r["rank"] for r in got] == [0, 1, 2, 3, 4]
    d = np.sort(1 - x @ x.T, axis=1)[:, 10]
    assert got[0].sample_token == f"s{d.argmax():05d}" and abs(got[0].knn_distance - d.max()) < 1e-5
    assert curate.find_outliers(frame(spark, x[:5]), 10).count() == 0


def test_assembly_order_truncation_and_quotas(spark):
    members = spark.createDataFrame([(f"a{i}", 0) for i in range(6)] + [(f"b{i}", 1) for i in range(2)] + [("noise", -1)], "sample_token string, cluster_id int")
    groups = spark.createDataFrame([("a0", ["a0", "a1", None])], "representative string, members array<string>")
    outliers = spark.createDataFrame([("a1", 0.9, 0), ("noise", 0.8, 1), ("b0", 0.7, 2)], "sample_token string, knn_distance double, rank int")
    parts = curate.assemble(members.select("sample_token"), groups, outliers, members, 4)
    assert [r.sample_token for r in parts["kept"].orderBy("position").collect()] == ["a0", "a2", "a3", "b0"]
    assert {r.cluster_id: r.kept for r in parts["per_cluster_kept"].collect()} == {0: 3, 1: 1}
    assert [r.sample_token for r in parts["boosted_outliers"].collect()] == ["noise"]
    assert [r.sample_token for r in parts["dropped_duplicates"].collect()] == ["a1"]
    none = curate.assemble(members.select("sample_token"), groups, outliers, None, 3)
    assert [r.sample_token for r in none["kept"].orderBy("position").collect()] == ["a0", "a2", "a3"]
    half = spark.range(1).select(curate.quota(5, F.lit(1), F.lit(2)), curate.quota(7, F.lit(1), F.lit(2))).first()
    assert tuple(half) == (2, 4)  # 2.5 and 3.5 round to even


def test_index_parameters():
    assert [index.suggest_ivf_params(n, 512)[0] for n in (404, 1000, 5000, 10000)] == [10, 31, 70, 100]
    assert index.suggest_ivf_params(10_000, 384) == (100, 16, 8) and index.suggest_ivf_params(100, 7)[1] == 1
    assert index.choose_strategy(500) == "exact" and index.choose_strategy(None) == "index" and index.choose_strategy(10, "index") == "index"
    assert index.pick_flavor(10, 10) == "ivfflat" and index.pick_flavor(10**7, 512) == "ivfpq"
    for f in (lambda: index.choose_strategy(1, "x"), lambda: index.pick_flavor(1, 1, "x")):
        with pytest.raises(ValueError):
            f()


def test_ivf_recall_and_pq(spark):
    x = gaussian(3000, 32, centres=20, seed=1)
    df = frame(spark, x)
    asked = df.limit(50)
    truth = blocks.top_k(asked, df, 10)
    flat = index.build_index(df, "ivfflat")
    assert flat.info["index_type"] == "ivfflat" and index.recall_at_k(truth, flat.search(asked, 10)).first()[0] >= 0.9
    pq = index.build_index(df, "ivfpq", m=8)
    hits = pq.search(asked, 10).collect()
    assert pq.info["m"] == 8 and len(hits) == 500 and index.recall_at_k(truth, pq.search(asked, 10)).first()[0] >= 0.8
    assert index.build_index(df.limit(50)).info["index_type"] == "exact"
    assert index.recall_at_k(truth.limit(0), truth).first()[0] == 1.0


def test_few_queries_find_what_many_do(spark, monkeypatch):
    x = gaussian(2000, 32, centres=20, seed=1)
    x[100:140] = x[100]  # ties
    df = frame(spark, x)
    built, asked = index.build_index(df, "ivfflat"), df.where("token < 's00120'")
    few = {(r.query, r.token, r["rank"], r.sim) for r in built.search(asked, 10).collect()}
    assert built.search(asked.limit(0), 10).count() == 0
    monkeypatch.setattr(index, "FEW_QUERIES", 0)
    assert {(r.query, r.token, r["rank"], r.sim) for r in built.search(asked, 10).collect()} == few and len(few) == 1200


def test_pq_cells_are_cut_without_loss(spark, monkeypatch):
    df = frame(spark, gaussian(2000, 32, centres=20, seed=1))
    built, asked = index.build_index(df, "ivfpq", m=8), df.limit(20)
    whole = {(r.query, r.token, r["rank"]) for r in built.search(asked, 10).collect()}
    monkeypatch.setattr(index, "BLOCK", 4)
    assert {(r.query, r.token, r["rank"]) for r in built.search(asked, 10).collect()} == whole


def test_pairs_and_outliers_through_the_index(spark):
    x = gaussian(2000, 32, centres=20, seed=4, noise=0.2)
    df = frame(spark, x)
    built = index.build_index(df, "ivfflat")
    for least in (0.9, 0.99):
        exact = {(r.a, r.b) for r in blocks.pairs_above(df, least).collect()}
        found = {(r.a, r.b) for r in built.pairs_above(least).collect()}
        assert found <= exact and len(found) >= 0.99 * len(exact)
    lone, via = (curate.find_outliers(df, 10, 0.05, i).collect() for i in (None, built))
    assert len(lone) == len(via) == 100 and len({r.sample_token for r in lone} & {r.sample_token for r in via}) >= 95
    assert sorted(r["rank"] for r in via) == list(range(100))
    assert index.wide_nlist(10**4) == 256 and index.wide_nlist(10**7) == 3162 and index.wide_nlist(10**12) == 4096


def test_stores_are_saved_and_probed(spark, tmp_path):
    x = gaussian(3000, 32, centres=20, seed=2)
    df = frame(spark, x)
    assert index.make_store(df.limit(100)).info["index_type"] == "exact" and index.make_store(df, "exact").info["n"] == 3000
    for name, store in (("flat", index.make_store(df)), ("exact", index.make_store(df, "exact"))):
        store.save(f"file://{tmp_path}/{name}")
        found = index.search_saved(spark, f"file://{tmp_path}/{name}", [float(v) for v in x[5]], 10).collect()
        best = np.argsort(-(x @ x[5]))[:10]
        assert found[0].token == "s00005" and len({r.token for r in found} & {f"s{i:05d}" for i in best}) >= 9
    plan = index.search_saved(spark, f"file://{tmp_path}/flat", [float(v) for v in x[5]], 10, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1][:40]


def test_pq_ranks_again_by_the_exact_cosine(spark):
    df = frame(spark, gaussian(3000, 32, centres=20, seed=1))
    asked = df.limit(50)
    truth, found = blocks.top_k(asked, df, 10), index.build_index(df, "ivfpq", m=8).search(asked, 10)
    assert index.recall_at_k(truth, found).first()[0] >= 0.9
    sims = {(r.query, r.token): r.sim for r in truth.collect()}
    assert all(abs(sims.get((r.query, r.token), r.sim) - r.sim) < 1e-9 for r in found.collect())


def test_projection_and_kmeans(spark):
    x = gaussian(200, 8, centres=2, noise=0.05, seed=3)
    df = frame(spark, x)
    xy = np.array([(r.x, r.y) for r in project.project_2d(df).orderBy("sample_token").collect()])
    c = x - x.mean(0)
    assert np.allclose(xy[:, 0] ** 2, (c @ np.linalg.svd(c)[2][0]) ** 2, atol=1e-8)
    ids = [r.cluster_id for r in project.kmeans_clusters(df, k=2, n_init=1).orderBy("sample_token").collect()]
    assert len({(i, x[n] @ x[0] > 0.5) for n, i in enumerate(ids)}) == 2
    assert project.default_k(404) == 8 and project.default_k(12) == 2
    assert project.project_2d(df.limit(0)).count() == 0


def test_neighbour_projection_keeps_clusters_together(spark):
    x = gaussian(300, 16, centres=5, noise=0.6, seed=6)
    df = frame(spark, x)
    graph_rows = project.neighbour_graph(df, 8).collect()
    weight = {(r.i, r.j): r.w for r in graph_rows}
    assert all(weight[j, i] == pytest.approx(w) and 0 < w <= 1 and i != j for (i, j), w in weight.items())
    best = np.argsort(-(x @ x.T - 2 * np.eye(300)), axis=1)[:, 0]
    assert all(weight[f"s{i:05d}", f"s{b:05d}"] == pytest.approx(1) for i, b in enumerate(best))
    got = {r.sample_token: (r.x, r.y) for r in project.neighbour_projection(df, 8, rounds=20).collect()}
    xy = np.array([got[f"s{i:05d}"] for i in range(300)])
    own = (x @ x.T).argsort(1)[:, -9:-1]
    assert len(got) == 300 and np.isfinite(xy).all()
    # neighbours stay close: far less apart than rows at large
    apart = np.linalg.norm(xy[:, None] - xy[own], axis=2).mean()
    assert apart < 0.3 * np.linalg.norm(xy[:, None] - xy[None], axis=2).mean()
    assert project.neighbour_projection(df.limit(2)).count() == 2 and project.neighbour_projection(df.limit(0)).count() == 0


def test_encoders(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 2.0]), (2, None)], "id int, f array<float>")
    got = {r.id: r.dinov2 for r in encode.encode_features(df, "id", "f", "dinov2", 3).collect()}
    assert len(got[1]) == 384 and abs(np.linalg.norm(got[1]) - 1) < 1e-5 and got[2] is None
    assert np.array_equal(encode.prompt_vector("A"), encode.prompt_vector("a"))
    assert encode.get_encoder("auto").backend == "projection"
    with pytest.raises(ValueError):
        encode.get_encoder("x")
    with pytest.raises(ImportError):
        encode.get_encoder("torch")


def test_model_encoders_run_in_batches(spark):
    def load():
        return lambda images: (np.array([[len(i), 1.0] for i in images]), np.array([[1.0, len(i), 2.0] for i in images])), lambda texts: np.array([[len(t), 3.0] for t in texts])

    model = encode.get_encoder("torch", load)
    images = spark.createDataFrame([(f"s{i}", bytearray(i + 1)) for i in range(40)] + [("none", None)], "token string, image binary")
    got = {r.token: r for r in model.encode_images(images, "token", "image").collect()}
    assert len(got) == 41 and got["none"].dinov2 is None and got["s3"].backend == "torch"
    assert np.allclose(got["s3"].dinov2, np.array([4, 1]) / np.sqrt(17)) and np.allclose(got["s3"].clip_image, np.array([1, 4, 2]) / np.sqrt(21))
    prompts = spark.createDataFrame([(1, "abcd"), (2, None)], "prompt_id int, prompt string")
    rows = {r.prompt_id: r.clip_text for r in model.encode_prompts(prompts).collect()}
    assert np.allclose(rows[1], np.array([4, 3]) / 5) and rows[2] is None and np.allclose(model.encode_text("abcd"), rows[1])

    def broken():
        raise OSError("no weights")

    assert encode.get_encoder("auto", broken).backend == "projection"
    with pytest.raises(OSError):
        encode.get_encoder("torch", broken)
    both = encode.ProjectionEncoder().encode_images(spark.createDataFrame([("a", [1.0, 2.0])], "token string, f array<float>"), "token", "f", 2).first()
    assert len(both.dinov2) == 384 and len(both.clip_image) == 512 and both.backend == "projection"


def test_synthetic_samples(spark):
    rows = S.synthetic_samples(spark, 400).orderBy("timestamp").collect()
    copies = [r for r in rows if "_dup_" in r.sample_token]
    assert len(rows) == 400 and 20 < len(copies) < 80 and rows[0].scene_name == "scene-0000-urban_intersection"
    names = {r.sample_token[:12]: r.scene_name for r in rows}
    assert all(names["sample_" + r.sample_token[-5:]] == r.scene_name for r in copies)


def test_first_rows_and_keyframes(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "z", 3)], "sample_token string, weather string, ingested_at int")
    for c in S.SAMPLES.fieldNames():
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(S.SAMPLES[c].dataType))
    assert [r.weather for r in S.first_rows(rows).collect()] == ["y"]
    sample = spark.createDataFrame([("s1", "c1", 5), ("s2", "c1", 6)], "token string, scene_token string, timestamp long")
    files = spark.createDataFrame([("s1", True, "samples/CAM_FRONT/1.jpg"), ("s1", True, "samples/LIDAR_TOP/1.bin"), ("s2", True, "samples/CAM_FRONT/2.jpg")], "sample_token string, is_key_frame boolean, filename string")
    scene = spark.createDataFrame([("c1", "scene-0001", "Rain, night", "l1")], "token string, name string, description string, log_token string")
    log = spark.createDataFrame([("l1", "quay")], "token string, location string")
    got = S.keyframe_join(sample, files, scene, log).collect()
    assert [(r.sample_token, r.weather, r.time_of_day, r.location) for r in got] == [("s1", "rain", "night", "quay")]


def test_pipeline_and_service(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = gaussian(120, 64, centres=4, noise=1.5)
    x[1] = x[0]
    batch = spark.createDataFrame([(f"s{i:05d}", [float(v) for v in r], [float(v) for v in r], "b") for i, r in enumerate(x)], "sample_token string, dinov2 array<float>, clip_image array<float>, backend string")
    samples = S.synthetic_samples(spark, 120).withColumn("sample_token", F.concat(F.lit("s"), F.lpad((((F.col("timestamp") - S.BASE_TIMESTAMP) / 500_000).cast("int")).cast("string"), 5, "0")))
    prompts = spark.createDataFrame([(i, f"prompt {i}", [float(v) for v in rng.normal(size=64)]) for i in range(3)], "prompt_id int, prompt string, clip_text array<float>")
    out = f"file://{tmp_path}/run"
    service = CurationService(spark, out)
    assert service.health()["loaded"] is False
    with pytest.raises(FileNotFoundError):
        service.outliers()
    line = CurationPipeline(CurationConfig(target_size=30, n_init=1)).run(samples, batch, prompts, out, datetime(2025, 1, 1), "abc").first()
    assert line.n_input_samples == 120 and line.n_curated == 30 and line.n_duplicate_groups >= 1
    assert service.health()["loaded"] and service.near_duplicates(2, 5).count() >= 1 and service.outliers(3).count() == 3
    found = service.search([float(v) for v in x[0]], 2).collect()
    assert {r.sample_token for r in found} == {"s00000", "s00001"} and abs(found[0].score - 1) < 1e-5
    assert line.vector_index.index_type == "exact" and line.vector_index.n == 120
    assert {r.sample_token for r in service.search_text("prompt 1", 3).collect()} <= {f"s{i:05d}" for i in range(120)}
    record = service.lineage().first()
    assert record.run_id.startswith("run-20250101T000000Z-") and record.git_sha == "abc" and record.n_curated_samples == 30
    with pytest.raises(ValueError):
        service.search([0.0] * 64, 0)
    kept = S.read_artifact(spark, f"{out}/json/kept.json", "position int, sample_token string").orderBy("position").collect()
    assert [r.sample_token for r in kept] == [r.sample_token for r in spark.read.parquet(f"{out}/kept").orderBy("position").collect()]
    assert S.read_artifact(spark, f"{out}/json/summary.json", "n_curated int").first().n_curated == 30
    assert S.read_artifact(spark, f"{out}/json/duplicates", DUPLICATE_GROUP).count() == line.n_duplicate_groups
    assert S.read_artifact(spark, f"{out}/json/outliers", OUTLIER).count() == line.n_outliers
    assert S.read_artifact(spark, f"{out}/json/clusters", CLUSTER).where("size(members) = size").count() == line.n_clusters
    # the same run with an index for the search, and for pairs and neighbours
    small = CurationConfig(target_size=30, n_init=1, exact_rows=10, vector_backend="index")
    again = CurationPipeline(small).run(samples, batch, prompts, out + "2", datetime(2025, 1, 1), "abc").first()
    assert again.n_duplicate_groups == line.n_duplicate_groups and again.n_outliers == line.n_outliers
    assert CurationService(spark, out + "2").search([float(v) for v in x[0]], 2).count() == 2


def test_stages_are_removed(spark):
    import os

    from frameloom.session import scratch, shared_folder, stage

    folder = shared_folder(spark).removeprefix("file://") + "/frameloom-stages"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    with scratch():
        rows = stage(spark.range(5), "gone")
        assert rows.count() == 5 and len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before


def test_command_line(spark, tmp_path, capsys):
    from frameloom.__main__ import main, parser

    a = parser().parse_args(["--out", "x", "--source", "nuscenes", "--dataroot", "y", "--max-samples", "7", "--benchmark"])
    assert (a.source, a.dataroot, a.max_samples, a.benchmark, a.target_size, a.dup_threshold) == ("nuscenes", "y", 7, True, 120, 0.97)
    main(["--out", f"file://{tmp_path}/cli", "--n", "60", "--target-size", "12", "--projection", "neighbours"])
    assert "Curated 60 raw frames → 1" in capsys.readouterr().out


def test_ranks_without_one_task(spark):
    rows = spark.range(500).select(((F.col("id") * 37) % 500).alias("id"), F.lit("x").alias("rank_of"))
    got = {r.id: r.place for r in order.ranked(rows.repartition(7), [F.desc("id")], "place").collect()}
    assert got == {i: 499 - i for i in range(500)} and order.ranked(rows.limit(0), [F.desc("id")]).count() == 0


def test_git_sha_outside_a_repository(tmp_path):
    assert report.git_sha(str(tmp_path / "none")) is None


def test_artifacts(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_artifact(spark, f"file://{tmp_path}/x.json", "a int")
    assert S.read_artifact(spark, f"file://{tmp_path}/x.json", "a int", required=False).count() == 0
    (tmp_path / "x.json").write_text('{"a": 1}\n')
    assert S.read_artifact(spark, f"file://{tmp_path}/x.json", "a int").first().a == 1
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert S.read_artifact(spark, f"file://{tmp_path}/x.json", "a int").count() == 2
    (tmp_path / "x.json").write_text('[\n  {\n    "a": 1\n  },\n  {"a": 3}\n]')
    assert {r.a for r in S.read_artifact(spark, f"file://{tmp_path}/x.json", "a int").collect()} == {1, 3}
    (tmp_path / "x.json").write_text('{\n  "a": 4,\n  "b": null\n}')
    assert S.read_artifact(spark, f"file://{tmp_path}/x.json", "a int").first().a == 4


def test_density_clusters(spark):
    rng = np.random.default_rng(0)
    xy = np.concatenate([rng.normal((0, 0), 0.1, (60, 2)), rng.normal((5, 5), 0.2, (40, 2)), rng.normal((-6, 4), 0.1, (12, 2)), [(20, 20), (-20, 9), (3, -15)]])
    labels = density.density_labels(xy)
    assert [len(set(labels[a:b].tolist())) for a, b in ((0, 60), (60, 100), (100, 112))] == [1, 1, 1] and len(set(labels[:112].tolist())) == 3 and set(labels[112:].tolist()) == {-1}
    df = spark.createDataFrame([(f"s{i:03d}", float(x), float(y)) for i, (x, y) in enumerate(xy)] + [("null", None, 1.0)], "sample_token string, x double, y double")
    got = {r.sample_token: r.cluster_id for r in density.density_clusters(df).collect()}
    assert got["null"] == -1 and [got[f"s{i:03d}"] for i in range(115)] == labels.tolist()
    some = {r.sample_token: r.cluster_id for r in density.density_clusters(df, sample_points=60).collect()}
    assert len({some[f"s{i:03d}"] for i in range(60)} - {-1}) == 1 and some["s112"] == -1
    assert density.density_clusters(df.limit(0)).count() == 0 and set(density.density_labels(xy[:3]).tolist()) == {-1}
    tree = density.spanning_tree(xy[:30])
    assert len(tree) == 29 and (np.diff(tree[:, 2]) >= 0).all()


def test_density_clusters_are_of_all_points(spark):
    rng = np.random.default_rng(3)
    xy = np.concatenate([rng.uniform(0, 4, (5_500, 2)), rng.normal((9, 9), 0.1, (500, 2)), rng.normal((-7, 3), 0.02, (6, 2)), [(30, 30), (-30, 9)]])
    df = spark.createDataFrame([(f"s{i:05d}", float(x), float(y)) for i, (x, y) in enumerate(xy)], "sample_token string, x double, y double")
    got = {r.sample_token: r.cluster_id for r in density.density_clusters(df).collect()}
    labels = [got[f"s{i:05d}"] for i in range(len(xy))]
    assert labels == [0] * 5_500 + [1] * 500 + [2] * 6 + [-1, -1]
    some = np.concatenate([xy[:700], xy[5_480:], xy[:9]])
    for min_samples in (1, 4):
        rows, boxes = density.spanning_tree(some, min_samples), density.spanning_tree(some, min_samples, 0)
        assert len(rows) == len(boxes) == len(some) - 1 and np.allclose(rows[:, 2], boxes[:, 2])


def test_points_of_a_grid_cell_are_one_leaf(spark, monkeypatch):
    rng = np.random.default_rng(3)
    xy = np.concatenate([rng.normal(size=(n, 2)) * 0.1 + c for n, c in ((900, (0, 0)), (500, (3, 0)), (60, (0, 3)))] + [rng.uniform(-9, 9, size=(6, 2))])
    df = spark.createDataFrame([(f"s{i:05d}", float(a), float(b)) for i, (a, b) in enumerate(xy)] + [("bad", None, 1.0)], "sample_token string, x double, y double")
    whole = {r.sample_token: r.cluster_id for r in density.density_clusters(df).collect()}
    monkeypatch.setattr(density, "MOST_POINTS", 100)
    cells = {r.sample_token: r.cluster_id for r in density.density_clusters(df).collect()}
    assert len(whole) == len(cells) == len(xy) + 1 and cells["bad"] == -1
    assert sum(whole[t] == cells[t] for t in whole) >= 0.99 * len(whole) and {0, 1, 2} <= set(cells.values())


def test_devkit_folder(spark, tmp_path):
    import json

    files = [("s1", True, "samples/CAM_FRONT/a.jpg"), ("s1", True, "samples/LIDAR_TOP/a.bin"), ("s2", True, "samples/CAM_FRONT/gone.jpg"), ("s2", True, "samples/LIDAR_TOP/b.bin"), ("s3", False, "samples/CAM_FRONT/c.jpg")]
    tables = {
        "sample": [{"token": t, "scene_token": "c1", "timestamp": n} for n, t in enumerate(("s1", "s2", "s3"))],
        "sample_data": [{"sample_token": t, "is_key_frame": k, "filename": f} for t, k, f in files],
        "scene": [{"token": "c1", "name": "scene-0061", "description": "Foggy dusk", "log_token": "l1"}],
        "log": [{"token": "l1", "location": "harbour"}],
    }
    for name, rows in tables.items():
        (tmp_path / "v1.0-mini").mkdir(exist_ok=True)
        (tmp_path / "v1.0-mini" / f"{name}.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "samples" / "CAM_FRONT").mkdir(parents=True)
    (tmp_path / "samples" / "CAM_FRONT" / "a.jpg").write_bytes(b"x")
    got = S.nuscenes_samples(spark, str(tmp_path), max_samples=5).collect()
    assert [(r.sample_token, r.scene_name, r.weather, r.time_of_day, r.location, r.cam_path) for r in got] == [("s1", "scene-0061", "fog", "dusk", "harbour", "samples/CAM_FRONT/a.jpg")]
    assert S.read_images(spark, f"{tmp_path}/samples").count() == 1


def chunked(kind, width, height, rows, palette=b""):
    """A PNG of given filtered rows."""
    import struct
    import zlib

    head = images._chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0))
    return images.SIGNATURE + head + (images._chunk(b"PLTE", palette) if palette else b"") + images._chunk(b"IDAT", zlib.compress(rows)) + images._chunk(b"IEND", b"")


def test_pictures_in_and_out():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (13, 17, 3)).astype(np.uint8)
    assert np.array_equal(images.read_picture(images.png_bytes(x)), x)
    assert np.array_equal(images.read_picture(b"P6\n17 13\n255\n" + x.tobytes()), x)
    filtered = bytes([1, 10, 5, 5]) + bytes([3, 10, 2, 1]) + bytes([4, 1, 1, 1]) + bytes([0, 9, 8, 7])  # left, mean, Paeth, none
    grey = images.read_picture(chunked(0, 3, 4, filtered))
    assert grey[:, :, 0].tolist() == [[10, 15, 20], [15, 17, 19], [16, 18, 20], [9, 8, 7]]
    assert images.read_picture(chunked(3, 2, 1, bytes([0, 1, 0]), bytes([1, 2, 3, 4, 5, 6]))).tolist() == [[[4, 5, 6], [1, 2, 3]]]
    assert images.read_picture(chunked(6, 1, 1, bytes([0, 100, 200, 50, 51]))).tolist() == [[[20, 40, 10]]]
    for broken in (None, b"", b"jpeg", images.png_bytes(x)[:60], chunked(3, 2, 1, bytes([0, 1, 0])), chunked(0, 3, 4, filtered[:-1]), b"P6 x"):
        assert images.read_picture(broken) is None
    assert np.array_equal(images.resize(x, 13, 17), x) and images.resize(np.full((30, 20, 3), 7, np.uint8), 8, 8).tolist() == np.full((8, 8, 3), 7).tolist()
    assert images.resize(np.array([[[0] * 3, [100] * 3]], np.uint8), 1, 1).tolist() == [[[50] * 3]] and images.thumbnail(np.zeros((400, 100, 3), np.uint8), 40).shape == (40, 10, 3)
    assert images.thumbnail(x, 40) is x and images.features(x).shape == (192,)


def test_pictures_are_decoded_in_batches(spark):
    made = S.synthetic_pictures(S.synthetic_samples(spark, 30), 32)
    files = made.unionByName(spark.createDataFrame([("none", None), ("bad", bytearray(b"x"))], "sample_token string, content binary"))
    got = {r.sample_token: r for r in S.decode_images(files, "sample_token", size=16, thumb=8).collect()}
    assert len(got) == 32 and got["none"].height is None and got["bad"].thumb is None
    one = next(r for t, r in got.items() if t.startswith("sample"))
    assert (one.height, one.width, len(one.pixels), len(one.features)) == (32, 32, 16 * 16 * 3, 192)
    assert images.read_picture(bytes(one.thumb)).shape == (8, 8, 3) and one.thumb_base64.startswith("iVBOR")


def test_weak_density_falls_back_to_kmeans(spark):
    x = gaussian(40, 4, centres=2, seed=2)
    points = spark.createDataFrame([(f"s{i:05d}", float(i % 2) * 1e-9, 0.0) for i in range(40)], "sample_token string, x double, y double")
    assert density.failure_modes(points, frame(spark, x), n_init=1).where("cluster_id >= 0").count() == 40


def test_too_many_prompts_are_refused(spark):
    v = F.array(F.lit(1.0), F.lit(0.0))
    prompts = spark.range(10_001).select(F.col("id").cast("int").alias("prompt_id"), F.lit("p").alias("prompt"), v.alias("v"))
    centres = spark.range(1).select(F.col("id").alias("cluster_id"), v.alias("v"))
    assert curate.label_clusters(centres, prompts.where("prompt_id < 10000")).first().prompt_id == 0
    with pytest.raises(ValueError):
        curate.label_clusters(centres, prompts)


def test_queries_run_all_starts(spark, monkeypatch):
    from frameloom.plans import queries

    asked = []
    monkeypatch.setattr(queries.project, "kmeans_clusters", lambda vectors, n_init=10: asked.append(n_init))
    monkeypatch.setattr(queries.density, "failure_modes", lambda xy, vectors, n_init=10: asked.append(n_init) or spark.createDataFrame([], "sample_token string, cluster_id int"))
    queries.kmeans_clusters(spark, "/root/testdata/sf0.001")
    queries.clusters(spark, "/root/testdata/sf0.001")
    assert asked == [10, 10]


def test_benchmark_points(spark):
    point = benchmark.run_benchmark(spark, (1000,), 32, 50, repeats=1)[0]
    assert point["n"] == 1000 and point["recall_at_k"] >= 0.9 and point["index"] == "ivfflat" and point["params"]["nlist"] == 31


def test_synthetic_copies_are_near_duplicates(spark):
    rows = S.synthetic_samples(spark, 200)
    vectors = encode.encode_features(S.synthetic_features(rows), "sample_token", "features", "dinov2", 192)
    v = {r.sample_token: np.array(r.dinov2) for r in vectors.collect()}
    assert len(v) == 200
    for t in v:
        own, _, copied = t.partition("_dup_")
        if copied and f"sample_{copied[-5:]}" in v:
            assert v[t] @ v[f"sample_{copied[-5:]}"] > 0.97


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", [1.0], [2.0]), ("a", None, [3.0])], "sample_token string, dinov2 array<float>, clip_image array<float>")
    artifacts.write_vectors(df, f"file://{tmp_path}/v")
    assert spark.read.parquet(f"file://{tmp_path}/v").where("space = 'dinov2'").count() == 2
    assert artifacts.json_document(df.select("sample_token"), ["sample_token"]) == '[{"sample_token":"a"},{"sample_token":"b"}]'
    artifacts.write_json(df, f"file://{tmp_path}/j")
    assert spark.read.json(f"file://{tmp_path}/j").count() == 2
    with pytest.raises(ValueError):
        artifacts.json_document(df, ["sample_token"], 1)


def test_streamed_ingest(spark, tmp_path):
    rows = spark.createDataFrame([("a", "s", datetime(2025, 1, 1)), ("a", "s", datetime(2025, 1, 1)), ("b", "s", datetime(2025, 1, 1, 0, 5)), (None, "s", datetime(2025, 1, 1))], "sample_token string, scene_name string, ingested_at timestamp")
    rows.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = ingest.read_samples(spark, f"file://{tmp_path}/in", rows.schema)
    ingest.append_to(ingest.first_arrivals(stream), f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    assert sorted(r.sample_token for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b"]
    q = ingest.scene_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.n for r in spark.sql("select n from counts").collect()] == [4]

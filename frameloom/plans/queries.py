"""Queries of the core operators over the test tables. Clusters are told by each frame's nearest prompt, so SQL can follow them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.functions import text as T
from frameloom.functions.vectors import dot, l2_normalize, search_cosine, usable
from frameloom.operators import benchmark, blocks, curate, density, encode, graph, index, project, report
from frameloom.plans.oracles import oracle_sql  # noqa: F401
from frameloom.session import shared_folder, stage
from frameloom.sources import samples as S

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
TARGET, TAU = 120, 0.97


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return S.first_rows(_read(spark, d, "samples"))


def _vectors(spark: SparkSession, d: str, space: str) -> DataFrame:
    return blocks.unit_vectors(_read(spark, d, "encoded_batch"), space)


def _prompts(spark: SparkSession, d: str) -> DataFrame:
    vector = F.col("clip_text").cast("array<double>")
    return _read(spark, d, "failure_prompts").where(usable(vector, 64)).select("prompt_id", "prompt", l2_normalize(vector).alias("v"))


def _members(spark: SparkSession, d: str, clip: DataFrame | None = None) -> DataFrame:
    cells = _prompts(spark, d).select(F.lpad(F.col("prompt_id").cast("string"), 9, "0").alias("token"), "v")
    clip = _vectors(spark, d, "clip_image") if clip is None else clip
    return blocks.top_k(clip, cells, 1).select(F.col("query").alias("sample_token"), F.col("token").cast("int").alias("cluster_id"))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return stage(curate.find_near_duplicates(blocks.shelf(_vectors(spark, d, "dinov2"), "dino"), TAU), "groups")


def _duplicates(spark: SparkSession, d: str) -> DataFrame:
    return curate.duplicate_members(blocks.shelf(_vectors(spark, d, "dinov2"), "dino"), TAU)


def _joined(column: str) -> F.Column:
    return F.array_join(column, ",")


def _text(column: str) -> F.Column:
    """Integers with nulls as text, which any client compares exactly."""
    return F.col(column).cast("string").alias(column)


def _queries_of(vectors: DataFrame) -> DataFrame:
    """The stated query set: tokens whose seed is divisible by 100."""
    return vectors.where(T.token_seed(F.col("token")) % 100 == 0)


# scans, projections, scalars
@query
def samples_scan(spark, d):
    return _samples(spark, d).select("sample_token", "scene_name", _text("timestamp"), "location", "weather", _text("num_lidar_pts"))


@query
def synthetic_samples(spark, d):
    return S.synthetic_samples(spark, 2000).select("sample_token", "scene_token", "scene_name", "timestamp", "cam_path", "location", "weather", "time_of_day", F.round(F.col("ego_speed_mps").cast("double"), 3).alias("ego_speed"), "num_lidar_pts")


@query
def token_seed(spark, d):
    return _read(spark, d, "samples").where("sample_token is not null").select("sample_token", T.token_seed(F.col("sample_token")).alias("seed")).distinct()


@query
def keyframe_join(spark, d):
    rows = _samples(spark, d).where("scene_token is not null and location is not null")
    files = rows.select(F.col("sample_token"), F.lit(True).alias("is_key_frame"), F.explode(F.array(F.when(F.col("cam_path").isNotNull(), F.concat(F.lit("samples/CAM_FRONT/"), "sample_token", F.lit(".jpg"))), F.when(F.col("lidar_path").isNotNull(), F.concat(F.lit("samples/LIDAR_TOP/"), "sample_token", F.lit(".bin"))))).alias("filename")).where("filename is not null")
    scene = rows.groupBy(F.col("scene_token").alias("token")).agg(F.min("scene_name").alias("name"), F.min(F.concat_ws(" ", "weather", "time_of_day")).alias("description"), F.min("location").alias("log_token"))
    log = scene.select(F.col("log_token").alias("token"), F.upper("log_token").alias("location")).distinct()
    out = S.keyframe_join(rows.select(F.col("sample_token").alias("token"), "scene_token", "timestamp"), files, scene, log)
    return out.select("sample_token", "scene_token", "scene_name", _text("timestamp"), "cam_path", "lidar_path", "location", "weather", "time_of_day")


@query
def samples_roundtrip(spark, d):
    return stage(_samples(spark, d), "samples").select("sample_token", "scene_name", _text("timestamp"), "weather", _text("num_lidar_pts"))


@query
def payload_projection(spark, d):
    payload = F.struct("sample_token", "scene_name", "weather", "time_of_day").alias("payload")
    return _samples(spark, d).select(payload).select("payload.*")


@query
def sample_records(spark, d):
    xy = _vectors(spark, d, "clip_image").select(F.col("token").alias("sample_token"), F.round(F.col("v")[0], 6).alias("x"), F.round(F.col("v")[1], 6).alias("y"))
    rows = _samples(spark, d).select("sample_token", "scene_name", "weather", "time_of_day", "location", F.round(F.col("ego_speed_mps").cast("double"), 2).alias("ego_speed_mps"))
    return rows.join(xy, "sample_token")


@query
def infer_conditions(spark, d):
    return _read(spark, d, "documents").select("doc_id", T.infer_weather(F.coalesce("text", F.lit(""))).alias("weather"), T.infer_time_of_day(F.coalesce("text", F.lit(""))).alias("time_of_day"))


@query
def scene_fields(spark, d):
    name = F.col("scene_name")
    names = _read(spark, d, "samples").where("scene_name is not null").groupBy("scene_name").agg(F.count("*").alias("n"))
    return names.select("scene_name", "n", F.substring(F.md5("scene_name"), 1, 16).alias("scene_token"), T.scene_template(name).alias("template"), T.scene_number(name).alias("number"))


@query
def prior_siblings(spark, d):
    """For each timed sample, the number of earlier ones of its scene. Counts run over minutes first, so no task holds a scene."""
    rows = _samples(spark, d).where("scene_name is not null and timestamp is not null").select("sample_token", "scene_name", "timestamp", F.floor(F.col("timestamp") / 60_000_000).alias("minute"))
    minutes = rows.groupBy("scene_name", "minute").count()
    before = minutes.withColumn("before", F.sum("count").over(Window.partitionBy("scene_name").orderBy("minute")) - F.col("count"))
    inside = rows.withColumn("inside", F.rank().over(Window.partitionBy("scene_name", "minute").orderBy("timestamp")) - 1)
    return inside.join(before.drop("count"), ["scene_name", "minute"]).select("sample_token", (F.col("before") + F.col("inside")).alias("n_prior"))


@query
def vec_normalize(spark, d):
    return _vectors(spark, d, "dinov2").select("token", F.posexplode("v").alias("pos", "x")).select("token", "pos", F.round("x", 6).alias("x"))


@query
def vec_cosine(spark, d):
    """Of each frame, the product of its two unit vectors."""
    other = _vectors(spark, d, "clip_image").withColumnRenamed("v", "w")
    return _vectors(spark, d, "dinov2").join(other, "token").select("token", F.round(dot(F.col("v"), F.col("w")), 6).alias("sim"))


@query
def manifest_hash(spark, d):
    return _read(spark, d, "curation_set").select("run_id", T.manifest_hash(F.coalesce("kept", F.array().cast("array<string>"))).alias("manifest_sha256"))


# near-duplicates
@query
def near_dup_pairs(spark, d):
    return blocks.pairs_above(blocks.shelf(_vectors(spark, d, "dinov2"), "dino"), TAU).select("a", "b", F.round("sim", 6).alias("sim"))


@query
def near_dup_components(spark, d):
    return graph.components(blocks.links_above(blocks.shelf(_vectors(spark, d, "dinov2"), "dino"), TAU))


@query
def near_dup_groups(spark, d):
    return _groups(spark, d).select("representative", _joined("members").alias("members"), "n_members", F.round("mean_similarity", 6).alias("mean_similarity"), F.round("mean_pairwise_similarity", 6).alias("mean_pairwise_similarity"))


@query
def dropped_duplicates(spark, d):
    return curate.droppable(_duplicates(spark, d))


@query
def surviving_samples(spark, d):
    return _samples(spark, d).select("sample_token").join(curate.droppable(_duplicates(spark, d)), "sample_token", "left_anti")


@query
def duplicates_json(spark, d):
    return _duplicates(spark, d).select(F.to_json(F.struct("representative", "members")).alias("json"))


@query
def api_near_duplicates(spark, d):
    return _read(spark, d, "duplicate_groups").where(F.size("members") >= 3).orderBy(F.desc(F.size("members")), "run_id", "representative", _joined("members")).limit(50).select("run_id", "representative", F.size("members").alias("n_members"))


@query
def dup_gallery(spark, d):
    """The twelve largest earlier groups with the scene of their representative, or its token, and ten members."""
    top = _read(spark, d, "duplicate_groups").where("representative is not null").orderBy(F.desc(F.size("members")), "run_id", "representative", _joined("members")).limit(12)
    scenes = _samples(spark, d).select(F.col("sample_token").alias("representative"), "scene_name")
    return top.join(scenes, "representative", "left").select("run_id", "representative", F.coalesce("scene_name", "representative").alias("title"), _joined(F.slice("members", 1, 10)).alias("shown"))


# outliers and search
@query
def knn_distance(spark, d):
    return curate.knn_distance(blocks.shelf(_vectors(spark, d, "clip_image"), "clip"), 10).select("sample_token", F.round("knn_distance", 6).alias("knn_distance"))


def _outliers(spark, d, clip: DataFrame | None = None) -> DataFrame:
    return curate.find_outliers(blocks.shelf(_vectors(spark, d, "clip_image"), "clip") if clip is None else clip)


@query
def outliers(spark, d):
    return _outliers(spark, d)


@query
def api_outliers(spark, d):
    return _outliers(spark, d).orderBy("rank").limit(50)


@query
def outlier_gallery(spark, d):
    top = _outliers(spark, d).orderBy("rank").limit(12)
    return top.join(_samples(spark, d).select("sample_token", "scene_name", "weather"), "sample_token", "left")


@query
def exact_topk(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return blocks.top_k(clip.orderBy("token").limit(1), clip, 10).select("query", "token", "rank", F.round("sim", 6).alias("sim"))


@query
def exact_topk_batch(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return blocks.top_k(_queries_of(clip), clip, 10).select("query", "token", "rank", F.round("sim", 6).alias("sim"))


@query
def text_search(spark, d):
    """The twelve frames most similar to the first prompt, by the text search's formula."""
    vector = _read(spark, d, "failure_prompts").where("prompt_id = 1").select(F.col("clip_text").cast("array<double>").alias("q"))
    raw = _read(spark, d, "encoded_batch").select("sample_token", F.col("clip_image").cast("array<double>").alias("v")).where(F.col("sample_token").isNotNull() & usable(F.col("v"), 64))
    rows = raw.groupBy("sample_token").agg(F.min("v").alias("v")).join(F.broadcast(vector.limit(1)))
    best = rows.select("sample_token", F.round(search_cosine(F.col("v"), F.col("q")), 6).alias("score")).orderBy(F.desc("score"), "sample_token").limit(12)
    return _samples(spark, d).select("sample_token", "scene_name", "weather").join(F.broadcast(best), "sample_token")


def _prompt_index(spark, d, clip):
    import numpy as np

    cells = _prompts(spark, d).orderBy("prompt_id").limit(1000).select("v").collect()
    return index.build_index(clip, "ivfflat", nprobe=4, centres=np.array([r.v for r in cells]))


@query
def ivf_topk(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return _prompt_index(spark, d, clip).search(_queries_of(clip), 10).select("query", "token", "rank", F.round("sim", 6).alias("sim"))


@query
def recall_at_k(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    asked = stage(_queries_of(clip), "queries")
    return index.recall_at_k(blocks.top_k(asked, clip, 10), _prompt_index(spark, d, clip).search(asked, 10))


@query
def ivf_kmeans_topk(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return index.build_index(clip, "ivfflat").search(_queries_of(clip), 10)


@query
def ivfpq_topk(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return index.build_index(clip, "ivfpq").search(_queries_of(clip), 10)


@query
def ann_benchmark(spark, d):
    """Recall of the k-means index against exact search over the stated query set."""
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    asked = stage(_queries_of(clip), "queries")
    built = index.build_index(clip, "ivfflat")
    info = [F.lit(v).alias(k) for k, v in built.info.items()]
    return index.recall_at_k(blocks.top_k(asked, clip, 10), built.search(asked, 10)).select("recall", *info)


# clusters
@query
def cluster_sizes(spark, d):
    return _members(spark, d).groupBy("cluster_id").agg(F.count("*").alias("size"), F.sum(F.count("*")).over(Window.partitionBy()).alias("total"))


@query
def cluster_centroids(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return curate.centroids(_members(spark, d, clip), clip).select("cluster_id", F.posexplode("v").alias("pos", "x")).select("cluster_id", "pos", F.round("x", 6).alias("x"))


def _xy(clip: DataFrame) -> DataFrame:
    return clip.select(F.col("token").alias("sample_token"), F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))


@query
def cluster_centroid_2d(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return _members(spark, d, clip).join(_xy(clip), "sample_token").groupBy("cluster_id").agg(F.round(F.avg("x"), 6).alias("x"), F.round(F.avg("y"), 6).alias("y"))


@query
def label_clusters(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    return curate.label_clusters(curate.centroids(_members(spark, d, clip), clip), _prompts(spark, d)).select("cluster_id", "prompt_id", "label", F.round("score", 6).alias("score"))


@query
def clusters_ranked(spark, d):
    sizes = _members(spark, d).groupBy("cluster_id").agg(F.count("*").alias("size"))
    return sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("size"), "cluster_id")) - 1)


@query
def cluster_sample_2d(spark, d):
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    rows = _members(spark, d, clip).join(_xy(clip), "sample_token")
    idx = F.row_number().over(Window.partitionBy("cluster_id").orderBy("sample_token"))
    return rows.withColumn("idx", idx).where(F.col("idx") <= 25).select("cluster_id", "sample_token", "idx", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query
def noise_filter(spark, d):
    """Frames whose nearest prompt is too far count as noise and are left out."""
    near = blocks.top_k(_vectors(spark, d, "clip_image"), _prompts(spark, d).select(F.lpad(F.col("prompt_id").cast("string"), 9, "0").alias("token"), "v"), 1)
    ids = near.select(F.col("query").alias("sample_token"), F.when(F.round("sim", 6) >= 0.2, F.col("token").cast("int")).otherwise(-1).alias("cluster_id"))
    return ids.where("cluster_id >= 0")


@query
def token_to_cluster(spark, d):
    return _read(spark, d, "clusters").select("run_id", "cluster_id", F.explode("members").alias("sample_token")).distinct()


@query
def cluster_series(spark, d):
    """The series of the latest run's clusters: their points, with the number of points and the mean of the series."""
    last = _read(spark, d, "clusters").agg(F.max("run_id").alias("run_id"))
    points = _read(spark, d, "clusters").join(F.broadcast(last), "run_id").select("cluster_id", F.explode("sample_2d").alias("p")).select("cluster_id", "p.*")
    means = points.groupBy("cluster_id").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean_x"), F.round(F.avg("y"), 6).alias("mean_y"))
    return points.join(means, "cluster_id").select("cluster_id", "sample_token", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "n", "mean_x", "mean_y")


@query
def clusters(spark, d):
    """Cluster records of density clusters on the principal axes, or of k-means where they are weak."""
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    xy = stage(project.project_2d(clip), "points")
    members = stage(density.failure_modes(xy, clip), "members")
    labels = curate.label_clusters(curate.centroids(members.where("cluster_id >= 0"), clip), _prompts(spark, d))
    return curate.cluster_records(members, xy, labels)


@query
def density_clusters(spark, d):
    return density.density_clusters(stage(project.project_2d(blocks.shelf(_vectors(spark, d, "clip_image"), "clip")), "points"))


@query
def kmeans_clusters(spark, d):
    return project.kmeans_clusters(blocks.shelf(_vectors(spark, d, "clip_image"), "clip"))


@query
def project_2d(spark, d):
    return project.project_2d(blocks.shelf(_vectors(spark, d, "clip_image"), "clip"))


@query
def neighbour_projection(spark, d):
    return project.neighbour_projection(blocks.shelf(_vectors(spark, d, "clip_image"), "clip"))


# assembly
def _assembly(spark, d) -> dict[str, DataFrame]:
    clip = blocks.shelf(_vectors(spark, d, "clip_image"), "clip")
    members = stage(_members(spark, d, clip), "members")
    return curate.assemble(_samples(spark, d).select("sample_token"), _duplicates(spark, d), stage(_outliers(spark, d, clip), "outliers"), members, TARGET)


@query
def stratified_take(spark, d):
    return curate.stratified_take(stage(_members(spark, d), "members"), curate.droppable(_duplicates(spark, d)), TARGET)


@query
def boosted_outliers(spark, d):
    return _assembly(spark, d)["boosted_outliers"]


@query
def per_cluster_kept(spark, d):
    return _assembly(spark, d)["per_cluster_kept"]


@query
def curation_set(spark, d):
    return _assembly(spark, d)["kept"]


@query
def curation_set_unclustered(spark, d):
    none = spark.createDataFrame([], "sample_token string, knn_distance double, rank int")
    return curate.assemble(_samples(spark, d).select("sample_token"), _duplicates(spark, d), none, None, TARGET)["kept"]


# reports
@query
def summary(spark, d):
    """Counts of the stored tables of earlier runs, and the headline of a run over them."""
    groups, sets = _read(spark, d, "duplicate_groups"), _read(spark, d, "curation_set")
    kept = sets.select(F.explode("kept").alias("sample_token")).distinct()
    lone = sets.select(F.explode("boosted_outliers").alias("sample_token")).distinct()
    return report.summary(_samples(spark, d), groups.where("members is not null"), lone, _read(spark, d, "clusters"), kept, duplicate_threshold=TAU, target_size=TARGET)


def _lineage(spark, d) -> DataFrame:
    sets = _read(spark, d, "curation_set")
    count = lambda c: F.size(F.coalesce(F.col(c), F.array().cast("array<string>")))
    return sets.select("run_id", "target_size", count("kept").alias("n_kept"), count("dropped_duplicates").alias("n_dropped"), T.manifest_hash(F.coalesce("kept", F.array().cast("array<string>"))).alias("sha"))


@query
def lineage_timeline(spark, d):
    return _lineage(spark, d).select("run_id", F.substring("sha", 1, 8).alias("sha8"), F.substring("sha", 1, 32).alias("sha32"), "n_kept", "n_dropped")


@query
def lineage_history(spark, d):
    """Records of earlier runs, appended one run after another and read again."""
    import uuid

    path = f"{shared_folder(spark)}/frameloom-lineage-{uuid.uuid4().hex}"
    rows = _lineage(spark, d).drop("sha")
    last = rows.agg(F.max("run_id").alias("run_id"))
    report.append_lineage(rows.join(F.broadcast(last), "run_id", "left_anti"), path)
    report.append_lineage(rows.join(F.broadcast(last), "run_id", "left_semi"), path)
    return spark.read.parquet(path)


@query
def lineage_record(spark, d):
    kept = _read(spark, d, "curation_set").select(F.explode("kept").alias("sample_token")).distinct()
    record = report.lineage_record(summary(spark, d), report.manifest(kept), datetime(2025, 1, 1), None, {"vector_backend": "exact"})
    return record.select("run_id", "timestamp_utc", "n_input_samples", "n_curated_samples", "n_duplicate_groups", "n_outliers", "n_clusters", "duplicate_threshold", "target_size", "manifest_sha256")


@query
def index_benchmark(spark, d):
    """Recall and latency on generated vectors of the published sizes, apart from the tables."""
    rows = benchmark.run_benchmark(spark)
    return spark.createDataFrame([(r["n"], r.get("recall_at_k"), r.get("exact_ms_per_query"), r.get("index_ms_per_query"), r.get("build_s"), r.get("index"), r.get("error")) for r in rows], "n int, recall double, exact_ms double, index_ms double, build_s double, index string, error string")


@query
def synthetic_vectors(spark, d):
    """Generated frames, drawn small and projected to one space."""
    rows = S.synthetic_features(S.synthetic_samples(spark, 400))
    return encode.encode_features(rows, "sample_token", "features", "dinov2", 192)


@query
def synthetic_images(spark, d):
    """Generated frames as PNG files, decoded again, resized, and as thumbnails."""
    out = S.decode_images(S.synthetic_pictures(S.synthetic_samples(spark, 200)), "sample_token", size=64, thumb=32)
    return out.select("sample_token", "height", "width", F.length("pixels").alias("n_bytes"), F.size("features").alias("n_features"), "thumb_base64")


# encoders
@query
def random_projection(spark, d):
    return encode.encode_features(_read(spark, d, "embeddings"), "vec_id", "embedding", "dinov2", 64)


@query
def text_embed(spark, d):
    return encode.encode_prompts(_read(spark, d, "failure_prompts"))

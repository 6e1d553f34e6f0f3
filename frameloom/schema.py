"""Schemas of the tables that the pipeline reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

SAMPLES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("sample_token", "scene_token", "scene_name")]
    + [T.StructField("timestamp", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("camera", "cam_path", "lidar_path", "location", "weather", "time_of_day")]
    + [T.StructField("ego_speed_mps", T.FloatType()), T.StructField("num_lidar_pts", T.IntegerType())]
)
DUPLICATE_GROUP = "representative string, members array<string>, mean_similarity double"
OUTLIER = "sample_token string, knn_distance double, rank int"
CLUSTER = "cluster_id int, label string, size int, members array<string>, centroid_2d struct<x: double, y: double>, sample_2d array<struct<sample_token: string, x: double, y: double>>"
CURATION_SET = "kept array<string>, dropped_duplicates array<string>, boosted_outliers array<string>, per_cluster_kept map<string, long>"
LINEAGE = (
    "run_id string, timestamp_utc string, git_sha string, python_version string, encoder_backend string, source string, n_input_samples int, n_curated_samples int, "
    "n_duplicate_groups int, n_outliers int, n_clusters int, duplicate_threshold double, target_size int, manifest_sha256 string, extras map<string, string>"
)

"""Queries of the nine problems over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _varied(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """As many as the largest earlier target, or a hundredth of the usable records if that is more."""
    from frameloom.llm.variety import usable_records, varied_subset

    batch = _read(spark, folder, "encoded_batch")
    target = _read(spark, folder, "curation_set").select(F.max("target_size")).first()[0] or 0
    return varied_subset(batch, max(target, usable_records(batch) // 100, 1))


def p1_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The kept list, with each cluster's number of kept records."""
    kept, clusters = _varied(spark, folder)
    return kept.join(clusters.select("cluster_id", F.col("kept").alias("per_cluster_kept")), "cluster_id")


def p1_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _varied(spark, folder)[1]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.chosen_path import near_duplicate_pairs

    return near_duplicate_pairs(_read(spark, folder, "encoded_batch"))


def p2_groups(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.chosen_path import near_duplicate_groups

    return near_duplicate_groups(_read(spark, folder, "encoded_batch"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.splits import same_scene_pairs

    return same_scene_pairs(_read(spark, folder, "samples"))


def p3_splits(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.splits import assign_splits

    return assign_splits(_read(spark, folder, "samples"), _read(spark, folder, "split_shares"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.polytope import close_neighbour_pairs

    return close_neighbour_pairs(_read(spark, folder, "encoded_batch"))


def p4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 most similar samples, in either space, of each whose token's number is divisible by 100."""
    from frameloom.functions.text import token_seed
    from frameloom.llm.polytope import nearest_of

    batch, asked = _read(spark, folder, "encoded_batch"), token_seed(F.col("token")) % 100 == 0
    dino, clip = (nearest_of(batch, asked, c).select(F.lit(c).alias("space"), "sample_token", "rank", "neighbour", "sim") for c in ("dinov2", "clip_image"))
    return dino.unionByName(clip)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.components import consolidated_groups

    return consolidated_groups(_read(spark, folder, "match_pairs"), _read(spark, folder, "duplicate_groups"))


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.components import group_records

    return group_records(_read(spark, folder, "match_pairs"), _read(spark, folder, "duplicate_groups"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.linkage import member_prompts

    return member_prompts(_read(spark, folder, "encoded_batch"), _read(spark, folder, "failure_prompts"))


def p6_clusters(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.linkage import cluster_records

    return cluster_records(_read(spark, folder, "encoded_batch"), _read(spark, folder, "failure_prompts"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.encoding import encode_documents

    return encode_documents(_read(spark, folder, "documents"))


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """The texts made from the ids again."""
    from frameloom.llm.encoding import decode_documents

    return decode_documents(p7_ids(spark, folder))


def p7_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """The ids with the characters of the text that each covers."""
    from frameloom.llm.encoding import encode_with_offsets

    return encode_with_offsets(_read(spark, folder, "documents"))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.packing import pack

    return pack(_read(spark, folder, "documents"), _read(spark, folder, "pack_targets"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    from frameloom.llm.reading import reading_bands

    return reading_bands(_read(spark, folder, "documents"), _read(spark, folder, "reading_labels"))


def queries() -> dict[str, Query]:
    names = (p1_kept, p1_clusters, p2_found, p2_groups, p3_found, p3_splits, p4_found, p4_nearest, p5_found, p5_groups, p6_found, p6_clusters, p7_ids, p7_decoded, p7_offsets, p8_containers, p9_found)
    return {f.__name__: f for f in names}


_BLANK = "'^[\\s ]+|[\\s ]+$'"
_CLEAN = "nullif(lower(regexp_replace({0}, " + _BLANK + ", '', 'g')), '')"


def oracle_sql() -> dict[str, str]:
    """Where a plain SQL statement over whole tables gives the exact result."""
    unit = "SELECT sample_token AS token, any_value(dinov2)::DOUBLE[] AS v FROM encoded_batch WHERE sample_token IS NOT NULL AND len(dinov2) = 64 AND list_aggregate(list_transform(dinov2, lambda x: abs(x)), 'max') > 0 GROUP BY sample_token"
    spaces = " UNION ALL ".join(f"SELECT '{c}' AS space, sample_token AS token, any_value({c})::DOUBLE[] AS v FROM encoded_batch WHERE sample_token IS NOT NULL AND len({c}) = 64 AND list_aggregate(list_transform({c}, lambda x: abs(x)), 'max') > 0 GROUP BY sample_token" for c in ("dinov2", "clip_image"))
    return {
        "p2_groups": f"""WITH RECURSIVE u AS ({unit}),
            b AS MATERIALIZED (SELECT a.token AS s, b.token AS d FROM u a JOIN u b ON a.token <> b.token WHERE list_cosine_similarity(a.v, b.v) >= 0.97),
            cc AS (SELECT s AS node, s AS root FROM b UNION SELECT b.d, cc.root FROM cc JOIN b ON b.s = cc.node),
            n AS (SELECT s, count(*) AS n_links FROM b GROUP BY s)
            SELECT node AS sample_token, min(root) AS group_token, any_value(n_links) AS n_links FROM cc JOIN n ON n.s = cc.node GROUP BY node""",
        "p4_found": f"""WITH u AS ({spaces}),
            c AS (SELECT a.space, a.token AS t, b.token AS o, round(list_cosine_similarity(a.v, b.v), 6) AS sim FROM u a JOIN u b ON a.space = b.space AND a.token <> b.token WHERE list_cosine_similarity(a.v, b.v) >= 0.8999),
            r AS (SELECT *, row_number() OVER (PARTITION BY space, t ORDER BY sim DESC, o) AS k FROM c)
            SELECT DISTINCT space, least(t, o) AS token_a, greatest(t, o) AS token_b FROM r WHERE k <= 5 AND sim >= 0.9""",
        "p2_found": f"WITH u AS ({unit}) SELECT a.token AS token_a, b.token AS token_b FROM u a JOIN u b ON a.token < b.token WHERE list_cosine_similarity(a.v, b.v) >= 0.97",
        "p5_found": f"""WITH RECURSIVE e AS (
              SELECT {_CLEAN.format("src_token")} AS s, {_CLEAN.format("dst_token")} AS d FROM match_pairs WHERE is_match
              UNION SELECT coalesce({_CLEAN.format("representative")}, list_min(list_transform(members, lambda m: {_CLEAN.format("m")}))), {_CLEAN.format("m")} FROM (SELECT representative, members, unnest(members) AS m FROM duplicate_groups)),
            b AS (SELECT s, d FROM e WHERE s IS NOT NULL AND d IS NOT NULL AND s <> d UNION SELECT d, s FROM e WHERE s IS NOT NULL AND d IS NOT NULL AND s <> d),
            cc AS (SELECT s AS node, s AS root FROM b UNION SELECT b.d, cc.root FROM cc JOIN b ON b.s = cc.node)
            SELECT node AS sample_token, min(root) AS group_token FROM cc GROUP BY node""",
        "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    }

"""Summary, manifest and lineage of a run."""

from __future__ import annotations

import json
import platform
import subprocess
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions.text import manifest_hash
from frameloom.schema import LINEAGE


#: The sentence that sums up a run. Fixed value.
HEADLINE = "Curated %d raw frames → %d high-value training samples; flagged %s%% near-duplicates; surfaced %d failure-mode clusters."


def _struct(values: dict) -> F.Column:
    return F.struct(*(F.lit(v).alias(k) for k, v in values.items()))


def summary(samples: DataFrame, groups: DataFrame, outliers: DataFrame, clusters: DataFrame, kept: DataFrame, vector_index: dict | None = None, benchmark: list[dict] | None = None, **fixed: object) -> DataFrame:
    """The counts of a run in one row, with its headline. ``fixed`` adds constants: source, backends, threshold, target;
    ``vector_index`` what the index is, as a struct, and ``benchmark`` its points, as an array of structs."""
    n = samples.agg(F.count("*").alias("n"), F.countDistinct("scene_name").alias("s"))
    g = groups.agg(F.count("*").alias("g"), F.coalesce(F.sum(F.size("members")), F.lit(0)).alias("m"))
    rows = n.join(g).join(outliers.agg(F.count("*").alias("o"))).join(clusters.agg(F.count("*").alias("c"))).join(kept.agg(F.count("*").alias("k")))
    rate = F.lit(100.0) * F.col("m") / F.greatest(F.lit(1), F.col("n"))
    extra = [_struct(vector_index).alias("vector_index")] if vector_index else []
    if benchmark is not None:
        shape = "array<struct<n: int, dim: int, k: int, n_queries: int, exact_ms_per_query: double, index_ms_per_query: double, speedup: double, recall_at_k: double, index: string, params: map<string, int>, build_s: double, error: string>>"
        extra.append(F.from_json(F.lit(json.dumps(benchmark)), shape).alias("ann_benchmark"))
    return rows.select(
        *(F.lit(v).alias(k) for k, v in fixed.items()), *extra, F.col("n").alias("n_input_samples"), F.col("s").alias("n_scenes"), F.col("g").alias("n_duplicate_groups"),
        F.col("m").alias("n_samples_in_duplicate_groups"), F.round(rate, 2).alias("duplicate_rate_pct"), F.col("o").alias("n_outliers"), F.col("c").alias("n_clusters"),
        F.col("k").alias("n_curated"), F.format_string(HEADLINE, F.col("n"), F.col("k"), F.round(rate, 1).cast("string"), F.col("c")).alias("headline_metric"),
    )


def manifest(kept: DataFrame) -> DataFrame:
    """manifest_sha256 of the kept tokens (a list as long as the target); of none, the hash of no bytes."""
    return kept.agg(manifest_hash(F.collect_list("sample_token")).alias("manifest_sha256"))


def git_sha(folder: str) -> str | None:
    try:
        done = subprocess.run(["git", "rev-parse", "HEAD"], cwd=folder, capture_output=True, text=True, timeout=5)
    except (OSError, subprocess.SubprocessError):
        return None
    return done.stdout.strip() if done.returncode == 0 else None


def lineage_record(summary_row: DataFrame, manifest_row: DataFrame, when: datetime | None = None, sha: str | None = None, extras: dict[str, str] | None = None) -> DataFrame:
    """One row of the lineage table. The time is given, so that a repeated task writes the same."""
    stamp = (when or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    both = summary_row.join(manifest_row)
    pairs = [F.lit(x) for kv in (extras or {}).items() for x in kv]
    values = {
        "run_id": F.concat(F.lit(f"run-{stamp}-"), F.substring("manifest_sha256", 1, 8)), "timestamp_utc": F.lit(stamp), "git_sha": F.lit(sha), "python_version": F.lit(platform.python_version()),
        "n_curated_samples": F.col("n_curated"), "extras": F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), "map<string,string>"),
    }
    names = [f.strip().split(" ", 1) for f in LINEAGE.replace("map<string, string>", "map<string;string>").split(",")]
    have = set(both.columns)
    return both.select(*(values.get(n, F.col(n) if n in have else F.lit(None)).cast(t.replace(";", ",")).alias(n) for n, t in names))


def append_lineage(record: DataFrame, path: str) -> None:
    """Adds the record; earlier ones are never rewritten."""
    record.write.mode("append").parquet(path)


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINEAGE).parquet(path)

"""The curation run end to end, and the read service over its tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions.vectors import l2_normalize, search_cosine, usable
from frameloom.operators import benchmark, curate, density, encode, project, report
from frameloom.operators.blocks import unit_vectors
from frameloom.operators.index import build_index, make_store, search_saved, wide_nlist
from frameloom.session import scratch
from frameloom.sources.artifacts import json_document, write_document, write_json
from frameloom.sources.samples import first_rows

#: Rows up to which all pairs are compared; more are searched through an index.
EXACT_ROWS = 200_000


@dataclass
class CurationConfig:
    source: str = "table"
    encoder: str = "auto"
    vector_backend: str = "auto"
    dup_threshold: float = 0.97
    target_size: int = 120
    knn: int = 10
    outlier_share: float = 0.05
    min_cluster_size: int = 5
    n_init: int = 10
    dim: int = 64
    projection: str = "axes"
    benchmark_sizes: tuple[int, ...] = ()
    exact_rows: int = EXACT_ROWS


class CurationPipeline:
    """``run`` reads samples and vectors, writes every artifact as a table under ``out`` and as JSON under ``out/json``, and adds a
    lineage record. Its stages are removed at its end."""

    def __init__(self, config: CurationConfig | None = None):
        self.config = config or CurationConfig()

    def run(self, samples: DataFrame, batch: DataFrame, prompts: DataFrame, out: str, when: datetime | None = None, sha: str | None = None) -> DataFrame:
        with scratch():
            return self._run(samples, batch, prompts, out, when, sha)

    def _run(self, samples: DataFrame, batch: DataFrame, prompts: DataFrame, out: str, when: datetime | None, sha: str | None) -> DataFrame:
        c, spark = self.config, samples.sparkSession

        def keep(frame: DataFrame, name: str) -> DataFrame:
            frame.write.mode("overwrite").parquet(f"{out}/{name}")
            return spark.read.parquet(f"{out}/{name}")

        rows = keep(first_rows(samples), "samples")
        dino, clip = (keep(unit_vectors(batch, s, c.dim), f"vectors_{s}") for s in ("dinov2", "clip_image"))
        store = make_store(clip, c.vector_backend)
        store.save(f"{out}/index")
        # beyond what can be compared pair by pair, candidates come from indexes with small cells
        large = max(dino.count(), clip.count())
        wide = [build_index(x, "ivfflat", nlist=wide_nlist(large)) if large > c.exact_rows else None for x in (dino, clip)]
        groups = keep(curate.find_near_duplicates(dino, c.dup_threshold, wide[0]), "duplicates")
        outliers = keep(curate.find_outliers(clip, c.knn, c.outlier_share, wide[1]), "outliers")
        xy = keep(project.neighbour_projection(clip, index=wide[1]) if c.projection == "neighbours" else project.project_2d(clip), "points")
        members = keep(density.failure_modes(xy, clip, c.min_cluster_size, c.n_init), "members")
        texts = prompts.where(usable(F.col("clip_text").cast("array<double>"), c.dim)).select("prompt_id", "prompt", l2_normalize(F.col("clip_text").cast("array<double>")).alias("v"))
        labels = curate.label_clusters(curate.centroids(members.where("cluster_id >= 0"), clip), texts)
        clusters = keep(curate.cluster_records(members, xy, labels), "clusters")
        parts = curate.assemble(rows.select("sample_token"), groups, outliers, members, c.target_size)
        kept = keep(parts["kept"], "kept")
        rest = {name: keep(parts[name], name) for name in ("dropped_duplicates", "boosted_outliers", "per_cluster_kept")}
        points = benchmark.run_benchmark(spark, c.benchmark_sizes) if c.benchmark_sizes else None
        line = report.summary(rows, groups, outliers, clusters, kept, store.info, points, source=c.source, encoder_backend=c.encoder, vector_backend=store.info["index_type"], duplicate_threshold=c.dup_threshold, target_size=c.target_size)
        line = keep(line, "summary")
        # documents for a page: large tables as lines, a folder each; what is bounded by the run's parameters as one document
        for name, frame in (("samples", rows), ("duplicates", groups), ("outliers", outliers), ("clusters", clusters), ("dropped_duplicates", rest["dropped_duplicates"]), ("boosted_outliers", rest["boosted_outliers"])):
            write_json(frame, f"{out}/json/{name}")
        write_document(spark, json_document(line, ["source"])[1:-1], f"{out}/json/summary.json")
        write_document(spark, json_document(kept, ["position"]), f"{out}/json/kept.json")
        report.append_lineage(report.lineage_record(line, report.manifest(kept), when, sha, {"vector_backend": store.info["index_type"]}), f"{out}/lineage")
        return line


class CurationService:
    """Reads of a run's tables. A table that isn't there raises FileNotFoundError, each by itself; ``health`` never does."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out

    def _table(self, name: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            raise FileNotFoundError(f"{self.out}/{name}")
        return self.spark.read.parquet(f"{self.out}/{name}")

    def health(self) -> dict:
        try:
            row = self.summary().first()
        except FileNotFoundError:
            return {"status": "ok", "loaded": False, "summary": None}
        return {"status": "ok", "loaded": True, "summary": row.asDict() if row else None}

    def summary(self) -> DataFrame:
        return self._table("summary")

    def near_duplicates(self, min_size: int = 2, limit: int = 50) -> DataFrame:
        return self._table("duplicates").where(F.size("members") >= min_size).orderBy(F.desc("n_members"), "representative").limit(limit)

    def outliers(self, limit: int = 50) -> DataFrame:
        return self._table("outliers").orderBy("rank").limit(limit)

    def clusters(self) -> DataFrame:
        return self._table("clusters").orderBy(F.desc("size"), "cluster_id")

    def lineage(self) -> DataFrame:
        return self._table("lineage").orderBy(F.desc("timestamp_utc"))

    def search(self, vector: list[float], k: int = 12, exact: bool = False) -> DataFrame:
        """The k samples most similar to a query vector, with their columns and score; k is 1 to 100.

        The run's index is probed, if it is one with cells; with ``exact`` all rows are scored.
        """
        if not 1 <= k <= 100:
            raise ValueError("k must be 1 to 100")
        norm = sum(float(x) ** 2 for x in vector) ** 0.5
        try:
            info = {r.key: r.value for r in self._table("index/info").collect()}
        except FileNotFoundError:
            info = {"index_type": "exact"}
        if exact or norm == 0 or info["index_type"] == "exact":
            score = search_cosine(F.col("v"), F.array(*(F.lit(float(x)) for x in vector)))
            best = self._table("vectors_clip_image").select(F.col("token").alias("sample_token"), F.round(score, 10).alias("score")).orderBy(F.desc("score"), "sample_token").limit(k)
        else:
            best = search_saved(self.spark, f"{self.out}/index", [float(x) / norm for x in vector], k).select(F.col("token").alias("sample_token"), F.col("sim").alias("score"))
        return self._table("samples").join(F.broadcast(best), "sample_token").orderBy(F.desc("score"), "sample_token")

    def search_text(self, text: str, k: int = 12, encoder: encode.ProjectionEncoder | encode.ModelEncoder | None = None) -> DataFrame:
        """``search`` for the vector that the encoder gives a text; its length is that of the stored vectors."""
        first = self._table("vectors_clip_image").first()
        return self.search([float(x) for x in (encoder or encode.get_encoder()).encode_text(text, len(first.v) if first else 1)], k)

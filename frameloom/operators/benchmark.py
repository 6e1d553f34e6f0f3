"""Recall and latency of the index against exact search on generated clustered vectors."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.operators.blocks import top_k
from frameloom.operators.index import build_index, recall_at_k
from frameloom.session import stage

log = logging.getLogger(__name__)


def corpus(spark: SparkSession, n: int, dim: int, seed: int = 0, noise: float = 0.3, mark: str = "s") -> DataFrame:
    """token, v: n unit vectors around max(8, n / 200) Gaussian centres; each row is drawn from its own number, in any partitioning."""
    centres = np.random.default_rng(seed).standard_normal((max(8, n // 200), dim)) * 2.0

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            x = np.empty((len(ids), dim))
            for row, i in zip(x, ids):
                rng = np.random.default_rng([seed, 1, i])
                row[:] = centres[rng.integers(len(centres))] + noise * rng.standard_normal(dim)
            x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-8
            yield pa.RecordBatch.from_arrays([pa.array([f"{mark}{i:07d}" for i in ids]), pa.array(list(x), pa.list_(pa.float64()))], ["token", "v"])

    return spark.range(n).mapInArrow(draw, "token string, v array<double>")


def perturbed(vectors: DataFrame, n: int, number: int, seed: int = 0, noise: float = 0.05) -> DataFrame:
    """About ``number`` rows of the corpus, chosen by hash, each moved a little, as queries that have an answer nearby but aren't rows."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).to_pylist(), float)
            for row, t in zip(x, b.column(0).to_pylist()):
                row += noise * np.random.default_rng([seed, 2, int(t[1:])]).standard_normal(len(row))
            if len(x):
                x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-8
            yield pa.RecordBatch.from_arrays([pa.array(["q" + t[1:] for t in b.column(0).to_pylist()]), pa.array(list(x), pa.list_(pa.float64()))], ["token", "v"])

    chosen = vectors.where(F.pmod(F.xxhash64(F.lit(seed), "token"), F.lit(max(1, n // number))) == 0)
    return chosen.mapInArrow(move, "token string, v array<double>")


def best_of(run: Callable[[], DataFrame], repeats: int = 3) -> float:
    """Seconds of the fastest of ``repeats`` runs after a first one."""
    took = []
    for i in range(repeats + 1):
        began = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        took += [time.perf_counter() - began] * (i > 0)
    return min(took)


def run_benchmark(spark: SparkSession, sizes: tuple[int, ...] = (1_000, 5_000, 10_000), dim: int = 384, n_queries: int = 200, k: int = 10, seed: int = 0, repeats: int = 3) -> list[dict]:
    """A point a size: milliseconds a query of both searches, their ratio, recall, index type and parameters. The build is
    timed apart. A size that fails is logged and comes out as a point with its ``error``."""
    points = []
    for n in sizes:
        try:
            rows = stage(corpus(spark, n, dim, seed), "corpus")
            asked = stage(perturbed(rows, n, n_queries, seed), "queries")
            number = asked.count()
            began = time.perf_counter()
            built = build_index(rows, "auto", seed=seed)
            build = time.perf_counter() - began
            slow, fast = (1000 * best_of(f, repeats) / max(1, number) for f in (lambda: top_k(asked, rows, k), lambda: built.search(asked, k)))
            recall = recall_at_k(top_k(asked, rows, k), built.search(asked, k)).first()[0]
            params = {p: v for p, v in built.info.items() if p in ("nlist", "m", "nbits", "nprobe")}
            points.append({"n": n, "dim": dim, "k": k, "n_queries": number, "exact_ms_per_query": round(slow, 3), "index_ms_per_query": round(fast, 3), "speedup": round(slow / max(1e-6, fast), 2), "recall_at_k": recall, "index": built.info["index_type"], "params": params, "build_s": round(build, 3)})
        except Exception as e:  # noqa: BLE001
            log.warning("no point at n=%d", n, exc_info=True)
            points.append({"n": n, "dim": dim, "k": k, "error": str(e)[:500]})
    return points

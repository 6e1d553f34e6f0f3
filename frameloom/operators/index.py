"""Vector indexes: exact, inverted file (IVF), and IVF with product quantisation (IVF-PQ).

An index is a table partitioned by cell plus its centres. The coarse centres and the codebooks are fitted on a bounded sample
of the corpus; every row is indexed. A search scores the centres, follows each query's best cells, and joins queries and
rows by cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import dot
from frameloom.operators.blocks import BLOCK, _best, _matrix, best_of_cells, cells, pairs_above, top_k
from frameloom.session import stage

SAMPLE_ROWS = 20_000
SHORTLIST = 16
#: Queries, and bytes of them, that are sent to the rows instead of shuffled to their cells.
FEW_QUERIES, FEW_BYTES = 4096, 16 << 20
PQ_THRESHOLD_MB = 200
FLAVORS = ("auto", "ivfflat", "ivfpq")


def suggest_ivf_params(n: int, dim: int) -> tuple[int, int, int]:
    """Cells, sub-quantisers and bits: about √n cells between 8 and 256, halved while they would hold under 30 rows each."""
    nlist = min(256, max(8, math.isqrt(max(n, 16))))
    while nlist > 8 and n // nlist < 30:
        nlist //= 2
    return nlist, next((m for m in (16, 12, 8, 6, 4, 2) if dim % m == 0), 1), 8


def pick_flavor(n: int, dim: int, flavor: str = "auto", pq_threshold_mb: int = PQ_THRESHOLD_MB) -> str:
    if flavor not in FLAVORS:
        raise ValueError(f"unknown flavor: {flavor}")
    if flavor != "auto":
        return flavor
    return "ivfpq" if n * dim * 4 / 2**20 >= pq_threshold_mb else "ivfflat"


def choose_strategy(n: int | None, backend: str = "auto") -> str:
    """exact or index: ``auto`` searches exactly below 2,000 rows; an unknown size is taken for large."""
    if backend not in ("auto", "exact", "index"):
        raise ValueError(f"unknown backend: {backend}")
    return ("exact" if n is not None and n < 2000 else "index") if backend == "auto" else backend


def kmeans(x: np.ndarray, k: int, rounds: int = 20, seed: int = 0) -> np.ndarray:
    """Lloyd's centres from a random start; an empty centre takes the row farthest from its own."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        score = x @ c.T - (c * c).sum(1) / 2
        own = score.argmax(1)
        count = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        full = count > 0
        c[full] = sums[full] / count[full, None]
        for e in np.flatnonzero(~full):
            far = score[np.arange(len(x)), own].argmin()
            c[e], score[far] = x[far], np.inf
    return c


@dataclass
class Index:
    """A built index. ``info`` has index_type, n, and for IVF nlist, nprobe, for IVF-PQ also m and nbits."""

    vectors: DataFrame
    info: dict
    centres: np.ndarray | None = None
    codebooks: np.ndarray | None = None
    table: DataFrame | None = None

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """query, token, sim, rank of each query row (token, v). IVF can return fewer than k; IVF-PQ ranks its shortlist again by the exact cosine."""
        if self.table is None:
            return top_k(queries, self.vectors, k)
        if self.codebooks is None:
            few = queries.select("token", "v").limit(FEW_QUERIES + 1).toArrow()
            if few.num_rows <= FEW_QUERIES and few.nbytes <= FEW_BYTES:
                return few_search(few, self.table, self.centres, self.info["nprobe"], k)
        probed = probe(queries, self.centres, self.info["nprobe"])
        if self.codebooks is None:
            return cell_search(probed, self.table, k)
        return rerank(pq_search(self, probed, SHORTLIST * k), queries, self.vectors, k)

    def pairs_above(self, threshold: float, nprobe: int = 8) -> DataFrame:
        """a, b, sim: pairs a < b of indexed rows with a cosine of at least ``threshold`` that share one of ``nprobe`` best cells."""
        if self.centres is None:
            return pairs_above(self.vectors, threshold)
        asked = probe(self.vectors, self.centres, nprobe)
        return cell_pairs(asked, assign(self.vectors, self.centres), threshold)

    def save(self, path: str) -> None:
        """Writes the rows kept by cell, the centres and what the index is, so that a service reads only the cells that it probes."""
        spark = self.vectors.sparkSession
        rows = assign(self.vectors, self.centres) if self.centres is not None else self.vectors.withColumn("cell", F.lit(0).cast("long"))
        by_cell(rows).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
        centres = self.centres if self.centres is not None else np.zeros((1, 1))
        spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cell long, v array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
        spark.createDataFrame([(k, str(v)) for k, v in self.info.items()], "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/info")


def by_cell(rows: DataFrame, pieces: int = 16) -> DataFrame:
    """Rows of a cell in few partitions, but in several, so that a cell that holds a third of all rows isn't one task."""
    return rows.repartition(F.col("cell"), F.pmod(F.xxhash64("token"), F.lit(pieces)))


def assign(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """token, v, cell: the cell whose centre has the largest inner product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(pa.chunked_array([b.column(1)])) if b.num_rows else np.zeros((0, centres.shape[1]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((x @ centres.T).argmax(1) if len(x) else [], pa.int64())], ["token", "v", "cell"])

    return vectors.select("token", "v").mapInArrow(run, "token string, v array<double>, cell long")


def probe(queries: DataFrame, centres: np.ndarray, nprobe: int) -> DataFrame:
    """token, v, cell: each query once for each of its ``nprobe`` best cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = _matrix(pa.chunked_array([b.column(1)])) @ centres.T
            n = min(nprobe, s.shape[1])
            best = np.argsort(-s, axis=1, kind="stable")[:, :n]
            rows = pa.array(np.repeat(np.arange(len(s)), n))
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(best.reshape(-1).astype(np.int64))], ["token", "v", "cell"])

    return queries.select("token", "v").mapInArrow(run, "token string, v array<double>, cell long")


def cell_search(probed: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """Exact scoring inside cells. A large cell is cut into blocks by hash, and its queries go to each, so no task holds it whole."""
    counts = table.groupBy("cell").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("long").alias("blocks"))
    counts = stage(counts, "cells")
    corpus = table.join(counts, "cell").withColumn("block", F.pmod(F.xxhash64("token"), F.col("blocks")))
    asked = probed.join(counts, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = F.xxhash64("cell", "block").alias("cell")
    both = asked.select(key, F.lit(0).alias("own"), "token", "v").unionByName(corpus.select(key, F.lit(1).alias("own"), "token", "v"))
    return best_of_cells(both, k)


def few_search(few: pa.Table, table: DataFrame, centres: np.ndarray, nprobe: int, k: int) -> DataFrame:
    """``cell_search`` for few queries (token, v): they go to all tasks, which read the index as it is stored; only each task's k best
    of a query are shuffled."""
    asked = np.array(few["token"].to_pylist(), str)
    if not len(asked):
        return table.sparkSession.createDataFrame([], "query string, token string, sim double, rank int")
    q = _matrix(few["v"])
    best = np.argsort(-(q @ centres.T), axis=1, kind="stable")[:, :nprobe]
    order = np.argsort(best.reshape(-1), kind="stable")
    found, starts = np.unique(best.reshape(-1)[order], return_index=True)
    by_cell = dict(zip(found.tolist(), np.split(order // best.shape[1], starts[1:])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, sims = [], [], []
        for b in batches:
            if not b.num_rows:
                continue
            token, cell, x = np.array(b.column(0).to_pylist(), str), b.column(2).to_numpy(), _matrix(pa.chunked_array([b.column(1)]))
            by = np.argsort(cell, kind="stable")
            for rows in np.split(by, np.flatnonzero(np.diff(cell[by])) + 1):
                own = by_cell.get(int(cell[rows[0]]))
                if own is None:
                    continue
                rows = rows[np.argsort(token[rows], kind="stable")]
                s = np.round(q[own] @ x[rows].T, 10)
                some = _best(s, min(k, s.shape[1]))
                at.append(np.repeat(own, some.shape[1]))
                names.append(token[rows][some.reshape(-1)])
                sims.append(np.take_along_axis(s, some, 1).reshape(-1))
        if at:
            a, n, s = np.concatenate(at), np.concatenate(names), np.concatenate(sims)
            by = np.lexsort((n, -s, a))
            first = np.flatnonzero(np.r_[True, a[by][1:] != a[by][:-1]])
            place = np.arange(len(by)) - np.repeat(first, np.diff(np.r_[first, len(by)]))
            by = by[place < k]
            yield pa.RecordBatch.from_arrays([pa.array(asked[a[by]], pa.string()), pa.array(n[by], pa.string()), pa.array(s[by])], ["query", "token", "sim"])

    hits = table.select("token", "v", "cell").mapInArrow(run, "query string, token string, sim double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "token"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def cell_pairs(probed: DataFrame, table: DataFrame, threshold: float) -> DataFrame:
    """a, b, sim of rows that meet in a cell with a cosine of at least ``threshold``, in blocks as in ``cell_search``."""
    counts = stage(table.groupBy("cell").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("long").alias("blocks")), "cells")
    rows = table.join(counts, "cell").withColumn("block", F.pmod(F.xxhash64("token"), F.col("blocks")))
    asked = probed.join(counts, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = F.xxhash64("cell", "block").alias("cell")
    both = asked.select(key, F.lit(0).alias("own"), "token", "v").unionByName(rows.select(key, F.lit(1).alias("own"), "token", "v"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches):
            tokens, x = np.array(t["token"].to_pylist(), object), _matrix(t["v"])
            cut = int(np.searchsorted(t["own"].to_numpy(), 1))
            for lo in range(0, cut if cut < len(tokens) else 0, 1024):
                s = x[lo : min(lo + 1024, cut)] @ x[cut:].T
                i, j = np.nonzero(s >= threshold)
                a, b, sim = tokens[lo + i], tokens[cut + j], s[i, j]
                apart = a != b
                low = (a < b)[apart]
                a, b = a[apart], b[apart]
                yield pa.RecordBatch.from_arrays([pa.array(np.where(low, a, b), pa.string()), pa.array(np.where(low, b, a), pa.string()), pa.array(sim[apart])], ["a", "b", "sim"])

    found = both.repartition("cell").sortWithinPartitions("cell", "own").mapInArrow(multiply, "a string, b string, sim double")
    return found.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def pq_encode(table: DataFrame, centres: np.ndarray, codebooks: np.ndarray) -> DataFrame:
    """token, cell, code: one byte a sub-quantiser, of the residual to the cell's centre."""
    m, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column(2).to_numpy(zero_copy_only=False)
            r = (_matrix(pa.chunked_array([b.column(1)])) - centres[cell]).reshape(-1, m, width)
            codes = np.stack([(r[:, i] @ codebooks[i].T - (codebooks[i] ** 2).sum(1) / 2).argmax(1) for i in range(m)], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([x.tobytes() for x in codes], pa.binary())], ["token", "cell", "code"])

    return table.select("token", "v", "cell").mapInArrow(run, "token string, cell long, code binary")


def pq_search(index: Index, probed: DataFrame, k: int) -> DataFrame:
    """Scores from tables of each query's inner products with all code words, summed over a row's code.

    A large cell is cut into blocks by hash, and its queries go to each; the queries of a block are scored together.
    """
    centres, codebooks = index.centres, index.codebooks
    m, words, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches):
            cut = int(np.searchsorted(t["own"].to_numpy(), 1))
            if cut in (0, t.num_rows):
                continue
            asked, rows = t.slice(0, cut), t.slice(cut)
            names, queries, x = np.array(rows["token"].to_pylist()), np.array(asked["token"].to_pylist()), _matrix(asked["v"])
            codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(-1, m)
            centre = centres[int(t["home"][0].as_py())]
            for lo in range(0, cut, 256):
                part = x[lo : lo + 256]
                s = np.repeat((part @ centre)[:, None], len(names), 1)
                for i in range(m):
                    s += (part[:, i * width : (i + 1) * width] @ codebooks[i].T)[:, codes[:, i]]
                n = min(k, s.shape[1])
                best = np.argpartition(-s, n - 1, axis=1)[:, :n]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(queries[lo : lo + 256], n), pa.string()), pa.array(names[best.reshape(-1)], pa.string()), pa.array(np.take_along_axis(s, best, 1).reshape(-1))], ["query", "token", "sim"])

    counts = stage(index.table.groupBy("cell").agg(F.ceil(F.count("*") / (16 * BLOCK)).cast("long").alias("blocks")), "cells")
    asked = probed.join(counts, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = index.table.join(counts, "cell").withColumn("block", F.pmod(F.xxhash64("token"), F.col("blocks")))
    key, none = F.xxhash64("cell", "block").alias("cell"), F.lit(None)
    asked = asked.select(key, F.col("cell").alias("home"), F.lit(0).alias("own"), "token", "v", none.cast("binary").alias("code"))
    both = asked.unionByName(rows.select(key, F.col("cell").alias("home"), F.lit(1).alias("own"), "token", none.cast("array<double>").alias("v"), "code"))
    found = both.repartition("cell").sortWithinPartitions("cell", "own").mapInArrow(run, "query string, token string, sim double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "token"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def rerank(found: DataFrame, queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """query, token, sim, rank: the k best of each query's candidates (query, token) by the exact cosine of the stored vectors."""
    asked, rows = queries.select(F.col("token").alias("query"), F.col("v").alias("q")), vectors.select("token", "v")
    sims = found.select("query", "token").join(asked, "query").join(rows, "token").select("query", "token", F.round(dot(F.col("q"), F.col("v")), 10).alias("sim"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "token"))
    return sims.withColumn("rank", rank).where(F.col("rank") <= k)


def wide_nlist(n: int) -> int:
    """Cells for searches of all rows against all: about the root of the rows, between 256 and 4,096, so that a cell stays small."""
    return max(256, min(4096, math.isqrt(n)))


def make_store(vectors: DataFrame, backend: str = "auto", **options) -> Index:
    """The store that ``choose_strategy`` names for so many rows: searched exactly, or indexed."""
    if choose_strategy(vectors.count(), backend) == "index":
        return build_index(vectors, **options)
    held = stage(vectors.select("token", "v"), "vectors")
    return Index(held, {"index_type": "exact", "n": held.count()})


def search_saved(spark, path: str, vector: list[float], k: int, nprobe: int | None = None) -> DataFrame:
    """token, sim: the k rows of a saved index most similar to one unit vector; only the files of the probed cells are read."""
    info = {r.key: r.value for r in spark.read.parquet(f"{path}/info").collect()}  # a handful of rows
    rows, q = spark.read.parquet(f"{path}/cells"), np.asarray(vector, np.float64)
    if info["index_type"] != "exact":
        centres = spark.read.parquet(f"{path}/centres").orderBy("cell").toArrow()
        score = _matrix(centres["v"]) @ q
        best = np.argsort(-score, kind="stable")[: nprobe or int(info["nprobe"])]
        rows = rows.where(F.col("cell").isin([int(centres["cell"][int(i)].as_py()) for i in best]))
    sim = F.round(dot(F.col("v"), F.array(*(F.lit(float(x)) for x in q))), 10)
    return rows.select("token", sim.alias("sim")).orderBy(F.desc("sim"), "token").limit(k)


def build_index(vectors: DataFrame, flavor: str = "auto", nlist: int | None = None, m: int | None = None, nprobe: int = 16, pq_threshold_mb: int = PQ_THRESHOLD_MB, centres: np.ndarray | None = None, seed: int = 0) -> Index:
    """An index over rows (token, v) of unit vectors; too few rows for the cells are searched exactly."""
    if flavor not in FLAVORS:
        raise ValueError(f"unknown flavor: {flavor}")
    vectors = stage(vectors.select("token", "v"), "vectors")
    n = vectors.count()
    dim = len(vectors.first().v) if n else 0
    own_nlist, own_m, nbits = suggest_ivf_params(n, max(1, dim))
    nlist, m = nlist or own_nlist, m or own_m
    if n < max(256, 4 * nlist) and centres is None:
        return Index(vectors, {"index_type": "exact", "n": n})
    most = max(SAMPLE_ROWS, 32 * nlist)
    one_in = max(1, n // most)
    sample = vectors.where(F.pmod(F.xxhash64(F.lit(seed), "token"), F.lit(one_in)) == 0).orderBy("token").limit(2 * most).select("v").toArrow()
    x = _matrix(sample["v"])
    centres = kmeans(x, nlist, seed=seed) if centres is None else centres
    table = assign(vectors, centres)
    info = {"index_type": "ivfflat", "n": n, "nlist": len(centres), "nprobe": nprobe}
    if pick_flavor(n, dim, flavor, pq_threshold_mb) == "ivfflat":
        return Index(vectors, info, centres, None, stage(by_cell(table).sortWithinPartitions("cell"), "index"))
    rest = (x - centres[(x @ centres.T).argmax(1)]).reshape(len(x), m, dim // m)
    codebooks = np.stack([kmeans(rest[:, i], 2**nbits, 10, seed + i) for i in range(m)])
    return Index(vectors, info | {"index_type": "ivfpq", "m": m, "nbits": nbits}, centres, codebooks, stage(pq_encode(table, centres, codebooks), "index"))


def recall_at_k(truth: DataFrame, found: DataFrame) -> DataFrame:
    """recall: shared (query, token) pairs over all true ones; 1 if there are none."""
    hits = truth.select("query", "token").join(found.select("query", "token").distinct(), ["query", "token"], "left_semi").agg(F.count("*").alias("hits"))
    whole = truth.agg(F.count("*").alias("whole"))
    share = F.when(F.col("whole") == 0, F.lit(1.0)).otherwise(F.col("hits") / F.col("whole"))
    return hits.join(whole).select(F.round(share, 4).alias("recall"))  # two one-row tables

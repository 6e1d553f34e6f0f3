"""Two-dimensional projection and k-means clusters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.operators.blocks import _matrix, _own_task, top_k
from frameloom.operators.index import Index
from frameloom.session import Stage, stage


def pca(vectors: DataFrame, components: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes. Each partition sends one row of sums, merged by position; the sign of an axis makes its largest loading positive."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = _matrix(pa.chunked_array([b.column(0)]))
                part = np.concatenate(([len(x)], x.sum(0), (x.T @ x).reshape(-1)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["s"])

    parts = vectors.select("v").mapInArrow(sums, "s array<double>").select(F.posexplode("s").alias("pos", "x"))
    rows = parts.groupBy("pos").agg(F.sum("x").alias("x")).orderBy("pos").toArrow()["x"].to_numpy()
    d = int((np.sqrt(4 * len(rows) - 3) - 1) / 2)
    n, mean = rows[0], rows[1 : d + 1] / rows[0]
    values, axes = np.linalg.eigh(rows[d + 1 :].reshape(d, d) / n - np.outer(mean, mean))
    top = axes[:, np.argsort(-values)[:components]]
    return mean, top * np.sign(top[np.abs(top).argmax(0), np.arange(top.shape[1])])


def project_2d(vectors: DataFrame) -> DataFrame:
    """sample_token, x, y on the first two principal axes of the centred vectors; no rows give no rows."""
    if vectors.isEmpty():
        return vectors.sparkSession.createDataFrame([], "sample_token string, x double, y double")
    mean, axes = pca(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                xy = (_matrix(pa.chunked_array([b.column(1)])) - mean) @ axes
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["sample_token", "x", "y"])

    return vectors.select("token", "v").mapInArrow(run, "sample_token string, x double, y double")


def _near(vectors: DataFrame, k: int, index: Index | None) -> DataFrame:
    """i, j, d: each row's ``k`` nearest others; those of a row come one after another."""
    if index:
        near = index.search(vectors, k + 1).where("query <> token")
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "token"))).where(F.col("rank") <= k)
    else:
        near = top_k(vectors, vectors, k, exclude_self=True)
    return near.select(F.col("query").alias("i"), F.col("token").alias("j"), F.greatest(F.lit(0.0), 1 - F.col("sim")).alias("d"))


def _weighed(near: DataFrame) -> DataFrame:
    """i, j, w: weights of the pairs of ``_near``, in both directions."""

    def weigh(t: pa.Table) -> pa.RecordBatch:
        i, j, d = t["i"].combine_chunks(), t["j"].combine_chunks(), t["d"].to_numpy()
        at = _starts(i)
        count = np.diff(np.append(at, len(d)))
        beyond = d - np.repeat(np.minimum.reduceat(d, at), count)
        scale = np.add.reduceat(beyond, at) / count
        w = pa.array(np.exp(-beyond / np.repeat(np.maximum(scale, 1e-9), count)))
        return pa.RecordBatch.from_arrays([pa.concat_arrays([i, j]), pa.concat_arrays([j, i]), pa.concat_arrays([w, w])], ["i", "j", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            cut = int(_starts(t["i"].combine_chunks())[-1]) if len(t) else 0  # the last row's pairs may go on
            if cut:
                yield weigh(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and len(held):
            yield weigh(held)

    kind = near.schema["i"].dataType.simpleString()
    return near.mapInArrow(run, f"i {kind}, j {kind}, w double")


def _starts(keys: pa.Array) -> np.ndarray:
    """Where runs of equal keys begin."""
    x = keys.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.append(len(x) > 0, x[1:] != x[:-1]))


def neighbour_graph(vectors: DataFrame, k: int = 15, index: Index | None = None) -> DataFrame:
    """i, j, w: the fuzzy graph of each row's ``k`` nearest others, both ways (McInnes et al., 2018).

    A row's nearest neighbour has the weight 1; the others fall off with their distance beyond it, at the row's own scale, the mean of those
    distances. Weights a and b of both directions make a + b - a b. Neighbours are exact, or those that an ``index`` finds.
    """
    return _weighed(_near(vectors, k, index)).groupBy("i", "j").agg((1 - F.product(1 - F.col("w"))).alias("w"))


#: Rows of a cell of the layout at most, on average; of fewer rows there are up to 32 cells.
CELL_ROWS = 1 << 18


def _cell_count(rows: int) -> int:
    return max(1, -(-rows // CELL_ROWS), min(32, rows // 4096))


def _parts(held: Stage) -> dict[int, str]:
    """The file of each cell of a stage whose tasks are its cells."""
    return {int(f.rpartition("/part-")[2].split("-")[0]): f for f in held.frame.inputFiles()}


def _columns(parts: dict[int, str], cell: int, names: list[str]) -> list[np.ndarray]:
    kinds = {"i": pa.int64(), "token": pa.string()}
    read = list(_batches(parts, cell, names))
    return [pa.chunked_array([b[n] for b in read], kinds.get(n, pa.float64())).to_numpy() for n in names]


def _batches(parts: dict[int, str], cell: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    if cell in parts:
        system, path = fs.FileSystem.from_uri(parts[cell].replace("s3a://", "s3://", 1))
        with system.open_input_file(path) as source:
            yield from pq.ParquetFile(source).iter_batches(65536, columns=names)


def _in_cells(near: DataFrame, number: int) -> Stage:
    """i, j, w of ``neighbour_graph`` over numbers: a file for each cell of i, in the order of j's cells. Pairs are sent once."""

    def merge(t: pa.Table) -> pa.RecordBatch:
        i, j, w = (t[c].to_numpy() for c in "ijw")
        at = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        return pa.RecordBatch.from_arrays([pa.array(i[at]), pa.array(j[at]), pa.array(1 - np.multiply.reduceat(1 - w, at))], ["i", "j", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            i, j = t["i"].to_numpy(), t["j"].to_numpy()
            cut = len(t) - int(np.argmin(np.append((i == i[-1])[::-1] & (j == j[-1])[::-1], False)))  # the last pair may go on
            if cut:
                yield merge(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None:
            yield merge(held)

    cell = lambda c: F.pmod(F.col(c), F.lit(number)).cast("int")
    rows = _weighed(near).repartitionById(number, cell("i")).sortWithinPartitions(cell("j"), "i", "j")
    return Stage(rows.mapInArrow(run, "i long, j long, w double"), "graph")


def neighbour_projection(vectors: DataFrame, k: int = 15, rounds: int = 30, index: Index | None = None) -> DataFrame:
    """sample_token, x, y: the layout of the neighbour graph by its two smoothest functions, started from the principal axes.

    Each round moves every row towards the weighted mean of its neighbours (half way, so that nothing oscillates), and the two
    coordinates are made of mean 0, variance 1 and uncorrelated again, all weighted by degree: subspace iteration for the graph's
    spectral layout. Rows without coordinates have no neighbours: there are none with k rows or more. Fewer than three rows fall
    back to the principal axes.

    Rows are told by a 64-bit hash, of which two equal ones are noticed, and stand in cells by it. Pairs are sent once, to the cell of
    their first row; in a round the task of a cell reads the coordinates of the other cells one after another, so rounds shuffle
    nothing, and only five sums a round come to the driver.
    """
    start = stage(project_2d(vectors), "axes")
    total = start.count()
    if total < 3:
        return start
    for seed in range(20):
        code = lambda c, seed=seed: F.xxhash64(F.lit(seed), c)
        if start.select(code("sample_token").alias("i")).distinct().count() == total:
            break
    else:
        raise RuntimeError("rows of equal hashes under every seed")
    number = _cell_count(total)
    rows = start.select(code("sample_token").alias("i"), F.col("sample_token").alias("token"), "x", "y")
    first = Stage(rows.repartitionById(number, F.pmod("i", F.lit(number)).cast("int")).sortWithinPartitions("i"), "places")
    graph = _in_cells(_near(vectors, k, index).select(code("i").alias("i"), code("j").alias("j"), "d"), number)
    places, edges = _parts(first), _parts(graph)

    def degrees(cell: int) -> list[np.ndarray]:
        i, x, y = _columns(places, cell, ["i", "x", "y"])
        deg = np.zeros(len(i))
        for b in _batches(edges, cell, ["i", "w"]):
            deg += np.bincount(np.searchsorted(i, b["i"].to_numpy()), b["w"].to_numpy(), len(i))
        keep = deg > 0
        return [i[keep], deg[keep], x[keep], y[keep]]

    spark = vectors.sparkSession
    held = Stage(_cellwise(spark, number, degrees), "layout")
    for turn in range(rounds + 1):
        m = held.frame.agg(F.sum("deg").alias("n"), *(F.sum(F.col("deg") * e).alias(a) for a, e in (("x", F.col("x")), ("y", F.col("y")), ("xx", F.col("x") ** 2), ("xy", F.col("x") * F.col("y")), ("yy", F.col("y") ** 2)))).first()
        if m.n is None:
            return start.limit(0)
        mx, my = m.x / m.n, m.y / m.n
        sx = max(m.xx / m.n - mx * mx, 1e-18) ** 0.5
        slope = (m.xy / m.n - mx * my) / sx**2
        sy = max(m.yy / m.n - my * my - slope**2 * sx**2, 1e-18) ** 0.5
        now = _parts(held)

        def flat(cell: int, now=now, mx=mx, my=my, sx=sx, sy=sy, slope=slope) -> list[np.ndarray]:
            i, deg, x, y = _columns(now, cell, ["i", "deg", "x", "y"])
            return [i, deg, (x - mx) / sx, (y - my - slope * (x - mx)) / sy]

        def moved(cell: int, flat=flat) -> list[np.ndarray]:
            i, deg, x, y = flat(cell)
            ax, ay, loaded = np.zeros(len(i)), np.zeros(len(i)), -1
            for b in _batches(edges, cell, ["i", "j", "w"]):
                p, j, w = np.searchsorted(i, b["i"].to_numpy()), b["j"].to_numpy(), b["w"].to_numpy()
                of = j % number
                cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
                for lo, hi in zip(cuts, cuts[1:]):
                    if of[lo] != loaded:
                        loaded = int(of[lo])
                        others, _, u, v = flat(loaded)
                    q = np.searchsorted(others, j[lo:hi])
                    ax += np.bincount(p[lo:hi], w[lo:hi] * u[q], len(i))
                    ay += np.bincount(p[lo:hi], w[lo:hi] * v[q], len(i))
            return [i, deg, (x + ax / deg) / 2, (y + ay / deg) / 2]

        if turn == rounds:
            break
        after = Stage(_cellwise(spark, number, moved), "layout")
        held.drop()
        held = after

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in (n for b in batches for n in b.column(0).to_pylist()):
            ids, tokens = _columns(places, cell, ["i", "token"])
            i, _, x, y = flat(cell)
            for lo in range(0, len(i), 65536):
                at = slice(lo, lo + 65536)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[np.searchsorted(ids, i[at])], pa.string()), pa.array(x[at]), pa.array(y[at])], ["sample_token", "x", "y"])

    return _own_task(spark, number).mapInArrow(named, "sample_token string, x double, y double")


def _cellwise(spark: SparkSession, number: int, rows_of: Callable[[int], list[np.ndarray]]) -> DataFrame:
    """i, deg, x, y that ``rows_of`` gives for each cell, a task a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in (n for b in batches for n in b.column(0).to_pylist()):
            columns = rows_of(cell)
            for lo in range(0, len(columns[0]), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 65536]) for c in columns], ["i", "deg", "x", "y"])

    return _own_task(spark, number).mapInArrow(run, "i long, deg double, x double, y double")


def default_k(n: int, min_cluster_size: int = 5) -> int:
    return min(8, max(2, n // max(1, min_cluster_size)))


def kmeans_clusters(vectors: DataFrame, k: int | None = None, n_init: int = 10, seed: int = 42, min_cluster_size: int = 5) -> DataFrame:
    """sample_token, cluster_id: the run of the least cost of ``n_init`` distributed k-means runs."""
    n = vectors.count()
    if n < 2:
        return vectors.select(F.col("token").alias("sample_token"), F.lit(0).alias("cluster_id"))
    rows = vectors.select("token", array_to_vector(F.col("v")).alias("features")).persist()
    try:
        models = [KMeans(k=k or default_k(n, min_cluster_size), seed=seed + i).fit(rows) for i in range(n_init)]
    finally:
        rows.unpersist()
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(rows).select(F.col("token").alias("sample_token"), F.col("prediction").cast("int").alias("cluster_id"))

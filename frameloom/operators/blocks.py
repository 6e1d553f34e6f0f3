"""Dense similarity in blocks: exact pairs and exact top-k as matrix products in Arrow batches.

Rows are written once, in files of bounded size; a task holds one file and reads the others one after another, so nothing is sent
as often as it is compared. Only pairs over the threshold, or each row's best, leave a task. The work is quadratic, as the exact
results are by definition; an IVF index (``operators.index``) is the way for larger collections.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from frameloom.functions.vectors import EPSILON, l2_normalize, norm, usable
from frameloom.session import Stage, stage

#: Rows of a stretch that a task reads, rows that are multiplied with it at once, and rows of a file.
BLOCK = 4096
TILE = 512
FILE_ROWS = 16_384


def unit_vectors(batch: DataFrame, column: str, dim: int = 64, token: str = "sample_token") -> DataFrame:
    """token, v: one normalised double vector a token; of several vectors of a token the smallest counts. Unusable ones are left out."""
    rows = batch.select(F.col(token).alias("token"), F.col(column).alias("v")).where(F.col("token").isNotNull() & usable(F.col("v").cast("array<double>"), dim))
    raw = rows.groupBy("token").agg(F.min("v").alias("v"))
    out = _normalised(raw)
    if raw.schema["v"].dataType == ArrayType(FloatType()):
        out._raw = raw
    return out


def _normalised(raw: DataFrame) -> DataFrame:
    return raw.select("token", l2_normalize(F.col("v").cast("array<double>")).alias("v"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell of a stream sorted by cell."""
    held: list[pa.RecordBatch] = []
    last: int | None = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column("cell").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if last is not None and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = int(keys[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def shelf(vectors: DataFrame, name: str = "vectors") -> DataFrame:
    """token, v (unit) as a stage of files of at most ``FILE_ROWS`` rows, which tasks of ``pairs_above`` and ``top_k`` read by themselves.

    So rows are written once, not sent to each task that compares them. Single floats of ``unit_vectors`` are written as they are, half
    as large, and normalised when they are read. A frame that is on a shelf stays as it is. The shared folder has to be one that
    pyarrow can read: local, hdfs, s3 or gs.
    """
    if getattr(vectors, "_shelved", None) is not None:
        return vectors
    raw = getattr(vectors, "_raw", None)
    held = stage((vectors if raw is None else raw).select("token", "v"), name, FILE_ROWS)
    out = held if raw is None else _normalised(held)
    out._shelved, out._held = sorted(held.inputFiles()), held
    return out


def _batches(uri: str, rows: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    with system.open_input_file(path) as source:
        yield from pq.ParquetFile(source).iter_batches(rows, columns=columns)


def _stretches(files: list[str], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and vectors of files, about ``rows`` at a time."""
    for tokens, x, _ in _weighted(files, rows, {}):
        yield tokens, x


def _weighted(files: list[str], rows: int, weights: dict[str, bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens, vectors and weights of files, about ``rows`` at a time. Rows of no weight are skipped; others than those of ``weights`` have 1."""
    held: list[pa.RecordBatch] = []
    n: list[np.ndarray] = []
    for uri in files:
        of, at = np.frombuffer(zlib.decompress(weights[uri]), np.int32) if uri in weights else np.zeros(0, np.int32), 0
        for b in _batches(uri, rows, ["token", "v"]):
            w = of[at : at + b.num_rows]
            w = np.pad(w, (0, b.num_rows - len(w)), constant_values=1)
            at += b.num_rows
            held.append(b if w.all() else b.filter(pa.array(w > 0)))
            n.append(w[w > 0])
            if sum(map(len, n)) >= rows:
                yield *_stretch(held), np.concatenate(n)
                held, n = [], []
    if sum(map(len, n)):
        yield *_stretch(held), np.concatenate(n)


def _stretch(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    t = pa.Table.from_batches(held)
    x = _matrix(t["v"])
    return np.array(t["token"].to_pylist(), object), _unit(x) if x.dtype == np.float32 else x


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows as ``l2_normalize`` makes them, to the last bit: squares are added one after another."""
    x = x.astype(np.float64)
    total = np.zeros(len(x))
    for c in range(x.shape[1]):
        total += x[:, c] * x[:, c]
    return x / (np.sqrt(total) + EPSILON)[:, None]


def _slack(dim: int) -> float:
    """What the cosine of unit rows in single floats is off at most, twice: rounding of the rows, their products and the sum."""
    return (dim + 8) * 2.0**-23


def _own_task(spark: SparkSession, number: int) -> DataFrame:
    return spark.range(0, number, 1, max(1, number))


def pairs_above(vectors: DataFrame, threshold: float) -> DataFrame:
    """a, b, sim: all pairs a < b of unit vectors with a cosine of at least ``threshold``.

    A task holds a file of the shelf and reads the files from there on. Products of single floats, first of some rotated dimensions,
    tell which pairs can reach the threshold; those are multiplied in double.
    """
    vectors = shelf(vectors)
    files = vectors._shelved

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at in (n for b in batches for n in b.column(0).to_pylist()):
            for tokens, x in _stretches(files[at : at + 1], FILE_ROWS):
                seen = _screen(x)
                yield from _pairs(tokens, x, tokens, x, threshold, True, seen)
                for others, y in _stretches(files[at + 1 :], BLOCK):
                    yield from _pairs(tokens, x, others, y, threshold, False, seen)

    return _own_task(vectors.sparkSession, len(files)).mapInArrow(multiply, "a string, b string, sim double")


def links_above(vectors: DataFrame, threshold: float) -> DataFrame:
    """a, b: pairs of ``pairs_above`` that have the same components. All are compared, but a task sends what joins parts only.

    That is one pair for each row outside its file that is close to one inside, and fewer than the file has rows besides, so
    frames at a standstill don't make a pair for each two of them. Of equal vectors the first alone is compared; each of the others is
    one pair, with the first, however many files hold them.
    """
    vectors = shelf(vectors)
    files = vectors._shelved
    equal, marks = _copies(vectors, threshold + 1e-9)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _weights(files, marks)
        for at in (n for b in batches for n in b.column(0).to_pylist()):
            for tokens, x, _ in _weighted(files[at : at + 1], FILE_ROWS, weights):
                seen, parts = _screen(x), np.arange(len(x))
                for i, j, _ in _close(tokens, x, tokens, x, threshold, True, seen):
                    parts, new = _joined(parts, i, j)
                    yield _ordered(tokens[i[new]], tokens[j[new]])
                for others, y, _ in _weighted(files[at + 1 :], BLOCK, weights):
                    by = np.full(len(y), -1)  # the first row that is close to each of these
                    for i, j, _ in _close(tokens, x, others, y, threshold, False, seen):
                        rows, first = np.unique(j, return_index=True)
                        first = first[by[rows] < 0]
                        by[j[first]] = i[first]
                        parts, new = _joined(parts, i, by[j])
                        new = np.concatenate((first, new))
                        yield _ordered(tokens[i[new]], others[j[new]])

    links = _own_task(vectors.sparkSession, len(files)).mapInArrow(link, "a string, b string")
    return links.unionByName(equal)


def _numbered(files: list[str], spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f.rpartition("/")[2], n) for n, f in enumerate(files)], "file string, cell long")


def _copies(vectors: DataFrame, least: float = 0.0) -> tuple[DataFrame, list[str]]:
    """a, b: each token b of a shelf whose vector equals that of a smaller token, and a, the smallest of these; and files for ``_weights``.

    Equal vectors are told by 128 bits of their hashes, so vectors aren't sent. Those whose product with themselves is below ``least``,
    as that of very short ones is, are left apart.
    """
    held, spark = vectors._held, vectors.sparkSession
    length = norm(F.col("v").cast("array<double>"))
    if held is not vectors:  # normalised when read
        length = length / (length + EPSILON)
    file = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")
    each = held.where(length * length >= least).select("token", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"), file, F.col("_metadata.row_index").alias("row"))
    first = each.groupBy("h", "g").agg(F.min("token").alias("a"), F.count("*").cast("int").alias("n")).where("n > 1")
    found = each.join(first, ["h", "g"]).join(F.broadcast(_numbered(vectors._shelved, spark)), "file")
    equal = Stage(found.select("a", F.col("token").alias("b"), "cell", "row", F.when(F.col("token") == F.col("a"), F.col("n")).otherwise(0).alias("n")), "copies").frame

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches):
            rows = t["row"].to_numpy()
            weights = np.ones(rows.max() + 1, np.int32)
            weights[rows] = t["n"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([t["cell"][0].as_py()]), pa.array([zlib.compress(weights.tobytes(), 1)], pa.binary())], ["cell", "n"])

    marks = Stage(equal.select("cell", "row", "n").repartition("cell").sortWithinPartitions("cell").mapInArrow(pack, "cell long, n binary"), "marks").frame
    return equal.where("n = 0").select("a", "b"), sorted(marks.inputFiles())


def _weights(files: list[str], marks: list[str]) -> dict[str, bytes]:
    """Of files that hold any of several equal vectors, how many each row stands for, packed: the first of equal vectors for all, the others for none."""
    return {files[cell]: n for f in marks for b in _batches(f, 256, ["cell", "n"]) for cell, n in zip(*(c.to_pylist() for c in b.columns))}


def _joined(parts: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts (the smallest row of each row's part) after joining those of rows i and j, and the places of joins that sufficed."""
    used, left = [], np.arange(len(i))
    while True:
        p, q = parts[i[left]], parts[j[left]]
        apart = p != q
        left, p, q = left[apart], p[apart], q[apart]
        if not len(left):
            return parts, np.concatenate(used) if used else left
        high, first = np.unique(np.maximum(p, q), return_index=True)  # each goes to a smaller one, so there is no circle
        used.append(left[first])
        to = np.arange(len(parts))
        to[high] = np.minimum(p, q)[first]
        while (further := to[to]).tobytes() != to.tobytes():
            to = further
        parts = to[parts]


def _ordered(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low = a < b
    return pa.RecordBatch.from_arrays([pa.array(np.where(low, a, b), pa.string()), pa.array(np.where(low, b, a), pa.string())], ["a", "b"])


@lru_cache(maxsize=4)
def _turn(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(17).standard_normal((dim, dim)))[0]


def _screen(x: np.ndarray) -> np.ndarray:
    """Fewer dimensions, whose products are never below those of x: a quarter of the rotated ones and the length of the rest."""
    dim = x.shape[1]
    if dim < 32:
        return x.astype(np.float32)
    y = x @ _turn(dim)
    return np.concatenate((y[:, : dim // 4], np.linalg.norm(y[:, dim // 4 :], axis=1, keepdims=True)), 1).astype(np.float32)


def _pairs(tokens: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray, threshold: float, same: bool, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i, j, sim in _close(tokens, x, others, y, threshold, same, seen):
        for p in range(0, len(i), 65536):
            q = slice(p, p + 65536)
            yield _ordered(tokens[i[q]], others[j[q]]).append_column("sim", pa.array(sim[q]))


def _close(tokens: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray, threshold: float, same: bool, seen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows i of x and j of y, and their cosines; ``seen`` is the screen of x."""
    y_seen, least = seen if same else _screen(y), threshold - _slack(x.shape[1])
    for lo in range(0, len(x), TILE):
        for c in range(0, len(y), BLOCK):
            rows, columns = slice(lo, lo + TILE), slice(c, c + BLOCK)
            near = seen[rows] @ y_seen[columns].T >= least
            close = np.flatnonzero(near)
            if len(close) > near.size // 64:  # the screen tells little here
                close = np.flatnonzero(x[rows].astype(np.float32) @ y[columns].astype(np.float32).T >= least)
            if not len(close):
                continue
            i, j = np.divmod(close, len(y[columns]))
            i, j = i + lo, j + c
            if same:
                keep = tokens[i] < others[j]
                i, j = i[keep], j[keep]
            sim = _products(x, y, i, j)
            keep = sim >= threshold
            if keep.any():
                yield i[keep], j[keep], sim[keep]


def _products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows i of x and j of y, a bounded number at a time."""
    out = np.empty(len(i))
    for lo in range(0, len(i), 65536):
        at = slice(lo, lo + 65536)
        out[at] = np.einsum("ij,ij->i", x[i[at]], y[j[at]])
    return out


def group_sums(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """root, tokens, own, v: of each group of members (token, root) and file of the shelf the tokens, and the sums of squares and of vectors.

    Members go to the files, so vectors aren't shuffled.
    """
    vectors = shelf(vectors)
    files, spark = vectors._shelved, vectors.sparkSession
    at = vectors.select("token", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).join(F.broadcast(_numbered(files, spark)), "file").select("token", "cell")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches):
            n = t["cell"][0].as_py()
            for tokens, x in _stretches(files[n : n + 1], FILE_ROWS):
                row = {token: i for i, token in enumerate(tokens.tolist())}
                names = np.array(t["token"].to_pylist(), object)
                found = np.array([row.get(token, -1) for token in names.tolist()])
                roots, part = np.unique(np.array(t["root"].to_pylist(), object)[found >= 0], return_inverse=True)
                order = np.argsort(part, kind="stable")
                names, y = names[found >= 0][order], x[found[found >= 0][order]]
                cuts = np.searchsorted(part[order], np.arange(len(roots) + 1))
                for lo in range(0, len(roots), 1024):
                    hi = min(lo + 1024, len(roots))
                    own, sums = (np.add.reduceat(z[: cuts[hi]], cuts[lo:hi], axis=0) for z in ((y * y).sum(1), y))
                    lists = pa.ListArray.from_arrays(pa.array((cuts[lo : hi + 1] - cuts[lo]).astype(np.int32)), pa.array(names[cuts[lo] : cuts[hi]], pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array(roots[lo:hi], pa.string()), lists, pa.array(own), pa.array(list(sums), pa.list_(pa.float64()))], ["root", "tokens", "own", "v"])

    placed = members.select("token", "root").join(at, "token").repartition(max(1, len(files)), "cell").sortWithinPartitions("cell")
    return placed.mapInArrow(add, "root string, tokens array<string>, own double, v array<double>")


def top_k(queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
    """query, token, sim, rank (from 1): the k most similar corpus rows of each query, ties by token.

    queries and corpus: token, v (unit). A task holds a stretch of queries, reads the files of the corpus one after another, and keeps
    each query's k best, so only answers leave it. The order is that of similarities rounded to 10 decimals, so equal vectors tie.
    """
    queries, corpus = (shelf(corpus),) * 2 if queries is corpus else (queries, shelf(corpus))
    files, mine = corpus._shelved, getattr(queries, "_shelved", None)

    def answers(tokens: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        best = _Best(tokens, x, k, exclude_self)
        for others, y in _stretches(files, BLOCK):
            best.meet(others, y)
        yield from best.batches()

    def of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at in (n for b in batches for n in b.column(0).to_pylist()):
            for tokens, x in _stretches(mine[at : at + 1], FILE_ROWS):
                yield from answers(tokens, x)

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) >= FILE_ROWS:
                yield from answers(*_stretch(held))
                held = []
        if sum(h.num_rows for h in held):
            yield from answers(*_stretch(held))

    schema = "query string, token string, sim double, rank int"
    if mine is not None:
        return _own_task(corpus.sparkSession, len(mine)).mapInArrow(of_files, schema)
    return queries.select("token", "v").mapInArrow(of_rows, schema)


def kth_nearest(vectors: DataFrame, k: int) -> DataFrame:
    """token, sim: of each row the similarity of its k-th nearest other, as ``top_k`` has it; no row where there are k rows or fewer.

    Of equal vectors the first is compared for all: it counts as often as it occurs.
    """
    vectors = shelf(vectors)
    files = vectors._shelved
    equal, marks = _copies(vectors)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _weights(files, marks)
        for at in (n for b in batches for n in b.column(0).to_pylist()):
            for tokens, x, own in _weighted(files[at : at + 1], FILE_ROWS, weights):
                best = _Best(tokens, x, k, True)
                for others, y, n in _weighted(files, BLOCK, weights):
                    best.meet(others, y, n)
                sims = np.concatenate((best.sims, np.round(np.einsum("ij,ij->i", x, x), 10)[:, None]), 1)
                order = np.argsort(-sims, axis=1, kind="stable")
                so_far = np.take_along_axis(np.concatenate((best.counts, own[:, None] - 1), 1), order, 1).cumsum(1)
                at_k = order[np.arange(len(x)), (so_far >= k).argmax(1)]
                there = so_far[:, -1] >= k
                yield pa.RecordBatch.from_arrays([pa.array(tokens[there], pa.string()), pa.array(sims[np.arange(len(x)), at_k][there])], ["token", "sim"])

    near = Stage(_own_task(vectors.sparkSession, len(files)).mapInArrow(answers, "token string, sim double"), "near").frame
    return near.unionByName(near.join(equal, near["token"] == equal["a"]).select(F.col("b").alias("token"), "sim"))


class _Best:
    """The k best of queries (tokens, unit rows x) among stretches of a corpus that come one after another, and how many rows each stands for."""

    def __init__(self, tokens: np.ndarray, x: np.ndarray, k: int, exclude_self: bool):
        self.tokens, self.x, self.x4, self.k, self.exclude = tokens, x, x.astype(np.float32), k, exclude_self
        self.names, self.sims, self.counts = np.full((len(x), k), "", object), np.full((len(x), k), -9.0), np.zeros((len(x), k), np.int64)

    def meet(self, others: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> None:
        order = np.argsort(others, kind="stable")
        others, y, n = others[order], y[order], np.ones(len(y), np.int64) if n is None else n[order]
        y4 = y.astype(np.float32)
        # what ties with the last after rounding counts too
        least = (self.sims[:, -1] - _slack(y.shape[1]) - 1e-9).astype(np.float32)
        at = {t: n for n, t in enumerate(others.tolist())} if self.exclude else {}
        own = np.array([at.get(t, -1) for t in self.tokens.tolist()]) if self.exclude else np.full(len(self.x), -1)
        for lo in range(0, len(self.x), TILE):
            hi = min(lo + TILE, len(self.x))
            s = self.x4[lo:hi] @ y4.T
            close = np.flatnonzero(s >= least[lo:hi, None])
            if not len(close):
                continue
            if len(close) > s.size // 16:  # the first stretch, or a dense one: as well all in double
                whole = np.round(self.x[lo:hi] @ y.T, 10)
                there = np.flatnonzero(own[lo:hi] >= 0)
                whole[there, own[lo:hi][there]] = -9
                j = _best(whole, min(self.k, len(y)))
                i = np.repeat(np.arange(hi - lo), j.shape[1])
                j = j.reshape(-1)
                sim = whole[i, j]
                keep = sim > -9
            else:
                i, j = np.divmod(close, len(y))
                sim = np.round(_products(self.x[lo:hi], y, i, j), 10)
                keep = (own[lo:hi][i] != j) & (sim >= self.sims[lo:hi, -1][i])
            self._add(i[keep] + lo, others[j[keep]], sim[keep], n[j[keep]])

    def _add(self, i: np.ndarray, names: np.ndarray, sims: np.ndarray, counts: np.ndarray) -> None:
        rows, i = np.unique(i, return_inverse=True)
        i = np.concatenate((np.repeat(np.arange(len(rows)), self.k), i))
        names, sims, counts = (np.concatenate((held[rows].reshape(-1), new)) for held, new in ((self.names, names), (self.sims, sims), (self.counts, counts)))
        order = np.lexsort((-sims, i))
        tied = (i[order][1:] == i[order][:-1]) & (sims[order][1:] == sims[order][:-1]) & (sims[order][1:] > -9)
        if tied.any():
            by_name = np.argsort(names, kind="stable")
            order = by_name[np.lexsort((-sims[by_name], i[by_name]))]
        first = np.searchsorted(i[order], np.arange(len(rows)))
        kept = order[(first[:, None] + np.arange(self.k)).reshape(-1)].reshape(len(rows), self.k)
        self.names[rows], self.sims[rows], self.counts[rows] = names[kept], sims[kept], counts[kept]

    def batches(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.x), 1024):
            names, sims = self.names[lo : lo + 1024], self.sims[lo : lo + 1024]
            i, j = np.nonzero(sims > -9)
            yield pa.RecordBatch.from_arrays([pa.array(self.tokens[lo : lo + 1024][i], pa.string()), pa.array(names[i, j], pa.string()), pa.array(sims[i, j]), pa.array(j.astype(np.int32) + 1)], ["query", "token", "sim", "rank"])


def best_of_cells(rows: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
    """query, token, sim, rank of rows (cell, own, token, v), where own is 0 for queries and 1 for the corpus of a cell.

    A query may be in several cells; a corpus row that it meets in more than one counts once.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches):
            tokens, x = np.array(t["token"].to_pylist()), _matrix(t["v"])
            cut = int(np.searchsorted(t["own"].to_numpy(), 1))
            if cut in (0, len(tokens)):
                continue
            order = np.argsort(tokens[cut:], kind="stable")
            names, y = tokens[cut:][order], x[cut:][order]
            at = np.minimum(np.searchsorted(names, tokens[:cut]), len(names) - 1)
            mine = names[at] == tokens[:cut]
            for lo in range(0, cut, 1024):
                hi = min(lo + 1024, cut)
                s = np.round(x[lo:hi] @ y.T, 10)
                if exclude_self:
                    own = np.flatnonzero(mine[lo:hi])
                    s[own, at[lo:hi][own]] = -9
                best = _best(s, min(k, s.shape[1]))
                sim = np.take_along_axis(s, best, 1).reshape(-1)
                keep = sim > -9
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(tokens[lo:hi], best.shape[1])[keep], pa.string()), pa.array(names[best.reshape(-1)][keep], pa.string()), pa.array(sim[keep])], ["query", "token", "sim"])

    found = rows.repartition("cell").sortWithinPartitions("cell", "own").mapInArrow(multiply, "query string, token string, sim double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "token"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _best(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k largest values in order, ties to the smaller column: values are multiples of 1e-10, so a smaller step orders equal ones."""
    t = s - np.arange(s.shape[1]) * (5e-11 / max(1, s.shape[1]))
    some = np.argpartition(-t, k - 1, axis=1)[:, :k]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(t, some, 1), axis=1), 1)

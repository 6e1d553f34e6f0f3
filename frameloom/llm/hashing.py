"""Unit-vector codes and cross-polytope tokens, shared by the operators on vectors.

A vector is hashed by a pseudo-rotation H·D1·H·D2·H·D3 (H the Hadamard transform, D random signs): its token is the
signed axis nearest to the rotated vector. The rotation is built once by fast Hadamard transforms of the identity and
applied as one matrix product, which for the dimensions of embeddings is faster than the butterflies.

Vectors travel as twelve bits a dimension and the angle by which that code is off. The angle bounds each cosine, so a test on
codes loses no pair; only pairs that the bounds leave open are checked on the stored floats.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, dim: int) -> Column:
    """Has ``dim`` values, none of them null, NaN or infinite, and not all zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dim) & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def class_rows(frame: DataFrame, column: str, dim: int, token: str = "sample_token") -> DataFrame:
    """token, class, vector of each usable row. Equal vectors share a class: the 64-bit hash of their floats."""
    vector = F.col(column).cast("array<float>")
    rows = frame.select(F.col(token).cast("string").alias("token"), vector.alias("vector"))
    rows = rows.where(F.col("token").isNotNull() & usable(F.col("vector"), dim))
    return rows.select("token", F.xxhash64("vector").alias("class"), "vector")


def members(rows: DataFrame) -> DataFrame:
    """token, class: one row a token. A token with several different vectors counts with that of the smallest class."""
    return rows.groupBy("token").agg(F.min("class").alias("class"))


def fast_hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the length is a power of two."""
    x, n, h = x.copy(), x.shape[-1], 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack((y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]), -2).reshape(x.shape)
        h *= 2
    return x / np.sqrt(n)


def padded(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


@lru_cache(maxsize=256)
def rotation(dim: int, seed: int, number: int) -> np.ndarray:
    """Pseudo-rotation ``number`` as a (dim, padded dim) matrix."""
    n, rng = padded(dim), np.random.default_rng([seed, number])
    m = np.eye(n)
    for _ in range(3):
        m = fast_hadamard(m * rng.choice((-1.0, 1.0), n))
    return np.ascontiguousarray(m[:dim], dtype=np.float32)


def tokens(x: np.ndarray, turn: np.ndarray, probes: int = 2) -> np.ndarray:
    """(rows, probes) signed axes nearest to each rotated row, the nearest first."""
    y = x @ turn
    a, out, rows = np.abs(y), [], np.arange(len(x))
    for _ in range(probes):
        i = a.argmax(1)
        out.append(2 * i + (y[rows, i] < 0))
        a[rows, i] = -1
    return np.stack(out, 1)


def encode(vectors: np.ndarray) -> np.ndarray:
    """Codes of vectors as rows of bytes: twelve bits a dimension, scaled to the row's largest value, and last the angle by
    which the code is off, in steps of ``step``, rounded up."""
    v = vectors.astype(np.float64)
    q = np.rint(v * (2047 / np.abs(v).max(1, keepdims=True))).astype(np.int16)
    low = (q & 15).astype(np.uint8)
    if low.shape[1] % 2:
        low = np.concatenate((low, np.zeros((len(low), 1), np.uint8)), 1)
    w = q.astype(np.float64)
    cross = v / np.linalg.norm(v, axis=1, keepdims=True) - w / np.linalg.norm(w, axis=1, keepdims=True)
    off = 2 * np.arcsin(np.minimum(1, np.linalg.norm(cross, axis=1) / 2))
    off = np.minimum(255, np.ceil(off / step(v.shape[1]) + 1e-3)).astype(np.uint8)
    return np.concatenate(((q >> 4).astype(np.int8).view(np.uint8), low[:, 0::2] | (low[:, 1::2] << 4), off[:, None]), 1)


def width(codes: np.ndarray) -> int:
    """Dimensions of codes."""
    return (codes.shape[1] - 1) * 2 // 3


def decode(codes: np.ndarray) -> np.ndarray:
    """Unit rows."""
    d = width(codes)
    x = codes[:, :d].view(np.int8).astype(np.float32) * 16
    x[:, 0::2] += codes[:, d:-1][:, : (d + 1) // 2] & 15
    x[:, 1::2] += codes[:, d:-1][:, : d // 2] >> 4
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def step(dim: int) -> float:
    """The unit of a code's angle: 255 of them are the most that any code of ``dim`` values can be off, as its largest value is 2047."""
    return float(np.arcsin(min(1.0, 0.5 * np.sqrt(dim) / 2047))) / 250


def turns(codes: np.ndarray) -> np.ndarray:
    """The angle by which each code is off at most; a little more for the arithmetic of single floats."""
    return codes[:, -1].astype(np.float32) * np.float32(step(width(codes))) + np.float32(1e-5)


def loosest(similarity: float, turn: float) -> float:
    """The least cosine that codes of a pair of ``similarity`` can have, if each is off by ``turn`` at most."""
    return float(np.cos(min(np.pi, np.arccos(np.clip(similarity, -1, 1)) + 2 * turn))) - 1e-6


def level_recall(similarity: float, dim: int, probes: int = 2, pairs: int = 4096, rotations: int = 8, seed: int = 101) -> float:
    """The share of pairs at a cosine that share one of their ``probes`` nearest axes of a rotation: measured on drawn pairs."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((pairs, dim))
    y -= (x * y).sum(1, keepdims=True) * x
    y = similarity * x + np.sqrt(max(0.0, 1 - similarity**2)) * y / np.maximum(1e-12, np.linalg.norm(y, axis=1, keepdims=True))
    hit = [(tokens(x, t, probes)[:, :, None] == tokens(y, t, probes)[:, None, :]).any((1, 2)).mean() for t in (rotation(dim, seed, r) for r in range(rotations))]
    return float(np.mean(hit))


def code_tokens(codes: np.ndarray, rotations: list[np.ndarray], probes: int = 2, part: int = 32768) -> list[np.ndarray]:
    """``tokens`` of codes by each rotation, a part of the codes at a time."""
    out: list[list[np.ndarray]] = [[] for _ in rotations]
    for lo in range(0, len(codes), part):
        x = decode(codes[lo : lo + part])
        for own, turn in zip(out, rotations):
            own.append(tokens(x, turn, probes).astype(np.int16))
    return [np.concatenate(own) for own in out]


def mix(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of integers, element by element."""
    with np.errstate(over="ignore"):
        h = np.uint64(0x9E3779B97F4A7C15)
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
    return h


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column without nulls as a dense matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1), np.float32)


def bytes_column(codes: np.ndarray) -> pa.Array:
    n, d = codes.shape
    offsets = pa.py_buffer(np.arange(0, (n + 1) * d, d, dtype=np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(codes).tobytes())])


def bytes_matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32, n + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(n, -1) if n else np.zeros((0, 3), np.uint8)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Key and rows of each group of a stream sorted by a long ``key``; holds one group at a time."""
    held: list[pa.RecordBatch] = []
    last: int | None = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if last is not None and keys[lo] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = int(keys[lo])
            held.append(b.slice(lo, hi - lo))
    if last is not None:
        yield last, pa.Table.from_batches(held)

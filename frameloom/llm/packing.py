"""Filling fixed-capacity containers along a space-filling curve (problem 8).

A document's tokens are hashed into a vector, which a fixed random projection takes to a few dimensions; its place on the
Hilbert curve through them is its key. Items are sorted by range of the key, so a partition is a stretch of the curve, and
each stretch is packed by itself: neighbours along the curve are taken a window at a time and put, the largest first, into the
fullest container with room. Containers that a window leaves open go on into the next.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm.encoding import FOLDER
from frameloom.session import stage

WIDTH, AXES, BITS = 64, 4, 12
#: The split of bytes into pieces that the vocabulary was made with. Fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def ranks(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=2)
def projection(width: int, axes: int, seed: int = 41) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(width, axes)))[0]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of rows of integers below 2^bits, by Gray-code untangling of the axes."""
    x, n = points.astype(np.int64).T.copy(), points.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: list[list[int]]) -> np.ndarray:
    """Hilbert key of each list of token ids; an empty list has the key of the middle."""
    vectors = np.zeros((len(ids), WIDTH))
    for v, x in zip(vectors, ids):
        h = (np.asarray(x, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        v += np.bincount((h % WIDTH).astype(np.int64), 1.0 - 2.0 * ((h >> np.uint64(12)) & np.uint64(1)).astype(float), WIDTH) if len(x) else 0
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    flat = (vectors / np.where(norm > 0, norm, 1)) @ projection(WIDTH, AXES) * np.sqrt(WIDTH)
    place = np.clip((1 / (1 + np.exp(-1.7 * flat))) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert(place, BITS)


def measured(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """doc_id, n_tokens, curve: each row of documents with its size and its place on the curve."""
    path = f"{folder}/{name}.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = ranks(path)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [encoding.encode_ordinary(t) if t else [] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(curve_keys(ids), pa.int64())], ["doc_id", "n_tokens", "curve"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, curve long")


class Packer:
    """Open containers of one capacity. ``add`` packs a window of sizes and returns the container of each."""

    def __init__(self, capacity: int, most_open: int = 256):
        self.capacity, self.most_open, self.made = capacity, most_open, 0
        self.open: list[tuple[int, int]] = []  # (room, container), the least room first

    def add(self, sizes: list[int]) -> list[int]:
        out = [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            at = bisect_left(self.open, (sizes[i], -1))
            if at < len(self.open):
                room, container = self.open.pop(at)
            else:
                room, container, self.made = self.capacity, self.made, self.made + 1
            out[i] = container
            insort(self.open, (room - sizes[i], container))
        if len(self.open) > self.most_open:
            self.open = self.open[-self.most_open :]  # the fullest are closed
        return out


def pack(documents: DataFrame, targets: DataFrame, window: int = 4096, tokens_per_stretch: int = 6_000_000) -> DataFrame:
    """target_id, container_id, doc_id, piece, first_token, n_tokens: every document in a container of each capacity.

    A document larger than the capacity is cut into full containers and a rest, which is packed as an item; no other is cut.
    Null and empty texts are items of 0 tokens. A null or non-positive capacity is left out. A repeated doc_id is packed as
    often as it comes. container_id has meaning only inside its target. No documents give no rows.
    """
    listed = targets.where("capacity_tokens > 0 and target_id is not null").select(F.col("target_id").cast("int").alias("t"), F.col("capacity_tokens").cast("long").alias("c")).distinct().orderBy("t", "c").take(101)
    if len(listed) > 100:
        raise ValueError("more than 100 targets")
    schema = "target_id int, container_id long, doc_id long, piece int, first_token long, n_tokens long"
    items = stage(measured(documents), "measured")
    if not listed:
        return items.sparkSession.createDataFrame([], schema)
    total = items.agg(F.sum("n_tokens"), F.count("*")).first()
    stretches = max(1, len(listed) * int((total[0] or 0) // tokens_per_stretch + total[1] // 1_000_000 + 1))
    each = F.explode(F.array(*(F.struct(F.lit(r.t).alias("target_id"), F.lit(r.c).alias("capacity")) for r in listed)))
    items = items.withColumn("x", each).select("x.target_id", "x.capacity", "doc_id", "n_tokens", "curve")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a stretch names its containers by the number of its partition
        base, packers = TaskContext.get().partitionId() << 32, {}
        for b in batches:
            for lo in range(0, b.num_rows, window):
                part = b.slice(lo, window).to_pydict()
                rows: dict[tuple[int, int], list[tuple]] = {}
                for t, c, d, n in zip(part["target_id"], part["capacity"], part["doc_id"], part["n_tokens"]):
                    rows.setdefault((t, c), []).append((d, n))
                for (t, c), docs in rows.items():
                    p = packers.setdefault((t, c), Packer(c))
                    out, rest = [], []
                    for d, n in docs:
                        full = 0 if n <= c else n // c
                        for k in range(full):
                            out.append((t, base + p.made, d, k, k * c, c))
                            p.made += 1
                        if n - full * c or not full:
                            rest.append((d, full, n - full * c))
                    for (d, k, n), container in zip(rest, p.add([n for *_, n in rest])):
                        out.append((t, base + container, d, k, k * c, n))
                    types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), types)], ["target_id", "container_id", "doc_id", "piece", "first_token", "n_tokens"])

    order = ("target_id", "curve", "doc_id")
    along = items.repartitionByRange(stretches, *order).sortWithinPartitions(*order)
    return along.mapInArrow(run, schema)

"""Pairs of vectors from hashed buckets, and their exact check. Used by the operators that pair vectors.

Records are split by tokens of rotations, as paths of a tree. The upper part of a path is the shuffle: a bucket that is too large
for a task is split again by another rotation before it is sent, so only records of such buckets are sent more often. The
lower part is split inside the task that holds the bucket, by several rotations at once, so depth costs next to no recall. A
bucket that rotations can't split (a dense group) is cut into blocks, and each pair of blocks is a cell of its own. Which buckets
are so is estimated from one record in 64; that chooses the layout, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import hashing as H
from frameloom.session import stage

#: Bytes of codes above which a bucket is split before it is sent.
BUCKET_BYTES = 96 << 20
#: Rows above which a bucket that rotations can't split is cut into blocks.
DENSE = 65_536
#: Rows of a part that are compared with each other.
SMALL = 1024
#: Rotations of a split inside a task.
TURNS = 3
#: Class numbers that are sent to all tasks at most (8 bytes each), and bytes of vectors. More are shuffled.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20
#: Bytes of unit rows up to which a cell is decoded as a whole, not again for each part.
WHOLE_BYTES = 64 << 20


@dataclass
class Layout:
    """How roots are split before the shuffle: keys that are split again, and dense keys with their number of blocks."""

    seed: int
    roots: tuple[int, ...]
    probes: int = 2
    split: dict[int, int] = field(default_factory=dict)
    blocks: dict[int, int] = field(default_factory=dict)
    depth: int = 1

    def __post_init__(self) -> None:
        if len(self.roots) > 62:
            raise ValueError("more than 62 runs or tables would be needed: the cosine is too low for this recall")

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row number, key and parent's key of each entry of unit rows. The low six bits of a key are its root."""
        out = []
        again = np.array(sorted(self.split), np.uint64)
        for root in self.roots:
            at, key, level = np.arange(len(x)), np.full(len(x), H.mix(self.seed, root)), 0
            while len(at):
                axes = H.tokens(x[at], H.rotation(x.shape[1], self.seed, 64 * root + level), self.probes)
                parent = np.repeat(key, self.probes)
                key = (H.mix(key[:, None], axes).reshape(-1) & ~np.uint64(63)) | np.uint64(root)
                at = np.repeat(at, self.probes)
                more = np.isin(key, again)
                out.append((at[~more], key[~more], parent[~more]))
                at, key, level = at[more], key[more], level + 1
        return tuple(np.concatenate(p) for p in zip(*out))

    def cells(self, x: np.ndarray, classes: np.ndarray, side: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Row number and cell of each entry; an entry of a dense key is in each cell of its block.

        With a ``side``, rows are searched (1), each in the cell of its block, or ask (0) in the cells of all blocks.
        """
        at, key, _ = self.keys(x)
        if not self.blocks:
            return at, key
        dense = np.isin(key, np.array(sorted(self.blocks), np.uint64))
        rows, cell = [at[~dense]], [key[~dense]]
        for k in np.unique(key[dense]):
            own = at[key == k]
            g = self.blocks[int(k)]
            block = (H.mix(11, classes[own]) % np.uint64(g)).astype(np.int64)
            for other in range(g if side != 1 else 1):
                p, q = (np.minimum(block, other), np.maximum(block, other)) if side is None else (block if side else np.full(len(own), other),) * 2
                rows.append(own)
                cell.append((H.mix(k, p, q) & ~np.uint64(63)) | (k & np.uint64(63)))
        return np.concatenate(rows), np.concatenate(cell)


def layout(sample: DataFrame | None, seed: int, roots: tuple[int, ...], probes: int, dim: int, one_in: int = 64) -> Layout:
    """Looks for large buckets in ``sample`` (class, vector: one record in ``one_in``; None for few records), a level at a time.

    Only keys of large buckets come to the driver: there are at most as many as entries over the bound.
    """
    out = Layout(seed, roots, probes)
    most = max(DENSE, BUCKET_BYTES // (dim * 3 // 2 + 1))
    tried: dict[int, int] = {}
    while sample is not None and out.depth < 8:
        probe = Layout(seed, roots, probes, {**out.split, **tried})

        def count(batches: Iterator[pa.RecordBatch], probe: Layout = probe) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    _, key, parent = probe.keys(H.decode(H.encode(H.matrix(b.column(1)))))
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(parent.astype(np.int64))], ["key", "parent"])

        large = sample.select("class", "vector").mapInArrow(count, "key long, parent long").groupBy("key", "parent").count().where(F.col("count") * one_in > DENSE / 2)
        found = [(r.key & (2**64 - 1), r.parent & (2**64 - 1), r["count"] * one_in) for r in large.collect()]
        widest: dict[int, int] = {}
        for _, parent, n in found:
            widest[parent] = max(widest.get(parent, 0), n)
        for key, n in tried.items():
            if widest.get(key, 0) >= n // 2:
                out.blocks[key] = -(-n // (DENSE // 2))
            elif n > most:
                out.split[key] = n
        deeper = any(k in out.split for k in tried)
        out.depth += deeper
        known = {**out.split, **out.blocks, **tried}
        fresh = {key: n for key, parent, n in found if n > DENSE and key not in known and (not tried or parent in out.split)}
        if not fresh:
            break
        tried = fresh
    return out


def sampled(rows: DataFrame, number: int, one_in: int = 64) -> DataFrame | None:
    """One record in ``one_in`` of class, vector, written once; None if no bucket of so few records can be large."""
    if number <= DENSE:
        return None
    return stage(rows.select("class", "vector").where(F.pmod(F.xxhash64(F.lit(3), "class"), F.lit(one_in)) == 0).dropDuplicates(["class"]), "sample")


def in_cells(rows: DataFrame, plan: Layout) -> DataFrame:
    """cell, class, code of each entry of rows (class, vector), sorted by cell. A class that a partition repeats leaves it once, so
    copies are merged before the shuffle."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            classes = b.column(0).to_numpy(zero_copy_only=False)
            fresh = np.fromiter((not (c in seen or seen.add(c)) for c in classes.tolist()), bool, len(classes))
            if not fresh.any():
                continue
            codes, classes = H.encode(H.matrix(b.column(1).filter(pa.array(fresh)))), classes[fresh]
            at, cell = plan.cells(H.decode(codes), classes)
            for lo in range(0, len(at), 8192):
                t = at[lo : lo + 8192]
                yield pa.RecordBatch.from_arrays([pa.array(cell[lo : lo + 8192].astype(np.int64)), pa.array(classes[t]), H.bytes_column(codes[t])], ["cell", "class", "code"])

    placed = rows.select("class", "vector").mapInArrow(entries, "cell long, class long, code binary")
    return placed.repartition("cell").sortWithinPartitions("cell")


def asked_cells(asking: DataFrame, rows: DataFrame, plan: Layout, probes: int) -> DataFrame:
    """cell, side, class, code, sorted by cell and side: classes that ask (side 0) in ``probes`` buckets a root, and all (side 1) in those of the plan."""

    def placed(frame: DataFrame, own: Layout, side: int) -> DataFrame:
        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for b in batches:
                classes = b.column(0).to_numpy(zero_copy_only=False)
                fresh = np.fromiter((not (c in seen or seen.add(c)) for c in classes.tolist()), bool, len(classes))
                b, classes = b.filter(pa.array(fresh)), classes[fresh]
                for lo in range(0, len(classes), 1024):
                    codes = H.encode(H.matrix(b.column(1).slice(lo, 1024)))
                    at, cell = own.cells(H.decode(codes), classes[lo : lo + 1024], side)
                    for p in range(0, len(at), 8192):
                        t = at[p : p + 8192]
                        yield pa.RecordBatch.from_arrays([pa.array(cell[p : p + 8192].astype(np.int64)), pa.array(np.full(len(t), side, np.int32)), pa.array(classes[lo : lo + 1024][t]), H.bytes_column(codes[t])], ["cell", "side", "class", "code"])

        return frame.select("class", "vector").mapInArrow(entries, "cell long, side int, class long, code binary")

    wide = Layout(plan.seed, plan.roots, probes, plan.split, plan.blocks, plan.depth)
    return placed(asking, wide, 0).unionByName(placed(rows, plan, 1)).repartition("cell").sortWithinPartitions("cell", "side")


def cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cell, its different classes in order, and their codes."""
    for cell, table in H.grouped(batches, "cell"):
        classes, first = np.unique(table["class"].to_numpy(), return_index=True)
        if len(classes) > 1:
            yield cell, classes, np.concatenate([H.bytes_matrix(c) for c in table["code"].chunks])[first]


def leaves(codes: np.ndarray, path: int, seed: int, probes: int = 2, small: int | None = None) -> Iterator[np.ndarray]:
    """Row numbers of the parts of a cell in which all rows are to be compared.

    A part of more than ``small`` rows is split by the tokens of TURNS rotations, sampled by the hash of its path, as long as that
    saves work; a pair at a cosine that one rotation keeps with p is in one of the parts with 1 - (1 - p)^TURNS.
    """
    small, dim = small or SMALL, H.width(codes)
    parts = [(np.arange(len(codes)), path, 0)]
    while parts:
        at, path, depth = parts.pop()
        if len(at) > small and depth < 12:
            children, work = [], 0.0
            numbers = [4096 + int(H.mix(path, turn)) % 96 for turn in range(TURNS)]
            for turn, t in enumerate(H.code_tokens(codes[at], [H.rotation(dim, seed, n) for n in numbers], probes)):
                order = np.argsort(t.reshape(-1), kind="stable")
                value, starts = np.unique(t.reshape(-1)[order], return_index=True)
                paths = H.mix(path, turn, value).tolist()
                for child, c in zip(paths, np.split(order // probes, starts[1:])):
                    if len(c) > 1:
                        children.append((at[c], child, depth + 1))
                        work += float(len(c)) ** 2
            # a split costs about as much as comparing each row with ``small`` others
            if work + small * (len(at) + 4.0 * len(children)) < float(len(at)) ** 2:
                parts += children
                continue
        yield at


def unit_parts(codes: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Gives the unit rows of parts of a cell, whose parts hold a row many times."""
    if len(codes) * H.width(codes) * 4 > WHOLE_BYTES:
        return lambda at: H.decode(codes[at])
    x = H.decode(codes)
    return lambda at: x[at]


def exact(pairs: DataFrame, rows: DataFrame, dim: int) -> DataFrame:
    """a, b, sim: the cosine of each pair in double from the stored floats."""
    ends = stage(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "ends")
    few = ends.count() <= BROADCAST_ROWS
    vectors = rows.select("class", "vector").join(F.broadcast(ends) if few else ends, "class", "left_semi")
    vectors = stage(vectors.dropDuplicates(["class"]), "vectors")

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (H.matrix(b.column(i)).astype(np.float64) for i in (2, 3))
            sim = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sim)], ["a", "b", "sim"])

    left = vectors.select(F.col("class").alias("a"), F.col("vector").alias("x"))
    right = vectors.select(F.col("class").alias("b"), F.col("vector").alias("y"))
    if few and vectors.count() * (4 * dim + 24) <= BROADCAST_BYTES:
        left, right = F.broadcast(left), F.broadcast(right)
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(cosines, "a long, b long, sim double")


def _step(rows: int) -> int:
    """Rows that are compared at once with so many: their cosines take 32 MB at most."""
    return max(64, min(2048, (8 << 20) // max(1, rows)))


def close_pairs(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers i < j of unit rows with a cosine of at least ``least``."""
    i, j, step = [], [], _step(len(x))
    for lo in range(0, len(x), step):
        at = np.flatnonzero(x[lo : lo + step] @ x[lo:].T >= least)
        p, q = np.divmod(at, len(x) - lo)
        up = q > p
        i.append(p[up] + lo)
        j.append(q[up] + lo)
    return np.concatenate(i), np.concatenate(j)


def likely(dim: int) -> float:
    """The share of a pair's largest turn that its cosine shows at most, but for one pair in a million: rounding errors point anywhere."""
    return min(1.0, 3.5 / dim**0.5)


def nearest(x: np.ndarray, k: int, floor: float, turn: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of each row and of the rows that can be among its k most similar, and their cosines of at least ``floor``.

    x: unit rows that are off by ``turn`` at most. Besides the k best those come out that the codes don't tell from the k-th.
    """
    turn *= likely(x.shape[1])
    i, j, sims = [], [], []
    k, step = min(k, len(x) - 1), _step(len(x))
    for lo in range(0, len(x), step):
        s = x[lo : lo + step] @ x.T
        np.fill_diagonal(s[:, lo:], -9)
        at = np.flatnonzero(s >= floor)
        p, q = np.divmod(at, len(x))
        own = s.reshape(-1)[at]
        full = np.flatnonzero(np.bincount(p, minlength=len(s)) > k)
        if len(full):
            last = np.partition(s[full], -k, axis=1)[:, -k]
            cut = np.full(len(s), -9, s.dtype)
            cut[full] = np.cos(np.minimum(np.pi, np.arccos(np.clip(last, -1, 1)) + 4 * turn)) - 3e-6
            keep = own >= cut[p]
            p, q, own = p[keep], q[keep], own[keep]
        i.append(p + lo)
        j.append(q)
        sims.append(own)
    return np.concatenate(i), np.concatenate(j), np.concatenate(sims)


def best_columns(s: np.ndarray, k: int, turn: float, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of cosines that can be among their row's k largest, as in ``nearest``."""
    if s.shape[1] <= k:
        return np.nonzero(s > -9)
    last = np.partition(s, -k, axis=1)[:, -k].astype(np.float64)
    cut = np.cos(np.minimum(np.pi, np.arccos(np.clip(last, -1, 1)) + 4 * turn * likely(dim))) - 3e-6
    return np.nonzero(s >= np.maximum(cut, -1.5)[:, None])


def still_best(i: np.ndarray, sims: np.ndarray, k: int, turn: float, dim: int) -> np.ndarray:
    """Which entries of row numbers ``i`` (in order) and cosines can be among the k most similar of their row, as in ``nearest``."""
    turn *= likely(dim)
    order = np.lexsort((-sims, i))
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
    sizes = np.diff(np.r_[first, len(i)])
    full = sizes >= k
    cut = np.full(len(first), -9.0)
    last = sims[order][first[full] + k - 1].astype(np.float64)
    cut[full] = np.cos(np.minimum(np.pi, np.arccos(np.clip(last, -1, 1)) + 4 * turn)) - 3e-6
    return sims >= np.repeat(cut, sizes)

"""Choosing a varied subset (problem 1).

Records are vectors of both spaces, each of unit length. Equal records are one class. Classes are grouped into cells by two
cross-polytope tokens: nearly equal records mostly share a cell. Mini-batch k-means is fitted on all classes: the start is greedy
k-means++ over one class of every cell, weighted by the cell's classes, so no kind of record is left out of it; each mini-batch is
a slice by hash, and all slices are visited. Sums are whole numbers, so the centres don't depend on how the table is partitioned. The
number of clusters grows with the root of the target. A cluster's quota is proportional to the square root of its number of cells
(or equal), so a standstill counts as little more than one frame; it is never more than the cluster holds, and unused slots go to
the others. Within a cluster one record of each cell comes before the second of any, in the order of a hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm import hashing as H
from frameloom.session import Stage, stage

SLICES = 8
#: Cells that the start may have: a row of each comes to the driver. At 64 dimensions a space there are no more.
MOST_CELLS = 1 << 16
#: Sums are kept in steps of this.
UNIT = float(1 << 30)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of each row's nearest centre."""
    return (x @ centres.T - (centres * centres).sum(1) / 2).argmax(1)


def _start(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator, trials: int = 8) -> np.ndarray:
    """Greedy k-means++ over weighted rows: of ``trials`` drawn rows the one that leaves the least cost."""
    norm = (x * x).sum(1)
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    far = np.maximum(norm - 2 * (x @ x[chosen[0]]) + norm[chosen[0]], 0)
    for _ in range(min(k, len(x)) - 1):
        p = weight * np.where(far < 1e-9, 0, far)
        if p.sum() <= 0:
            break
        drawn = rng.choice(len(x), trials, p=p / p.sum())
        left = np.minimum(far[:, None], np.maximum(norm[:, None] - 2 * (x @ x[drawn].T) + norm[drawn], 0))
        best = int(np.argmin(weight @ left))
        chosen.append(int(drawn[best]))
        far = left[:, best]
    return x[chosen]


def mini_batch_kmeans(classes: Stage, features: Callable[[pa.RecordBatch], np.ndarray], k: int, seed: int = 13) -> np.ndarray:
    """Centres of mini-batch k-means (per-centre learning rates) over all rows (class, x, y, cell) of a stage kept by ``slice``.

    Tasks send sums, which are added up per centre; at most a row a centre and one a cell of the start come to the driver.
    """
    rng = np.random.default_rng(seed)

    def sums(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(len(centres), np.int64), np.zeros(centres.shape, np.int64)
            for b in batches:
                if b.num_rows:
                    x = features(b)
                    own = _nearest(x, centres)
                    order = np.argsort(own, kind="stable")
                    hit, first = np.unique(own[order], return_index=True)
                    count += np.bincount(own, minlength=len(centres))
                    total[hit] += np.add.reduceat(np.rint(x[order].astype(np.float64) * UNIT).astype(np.int64), first)
            hit = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int64)), pa.array(count[hit]), pa.array(list(total[hit]), pa.list_(pa.int64()))], ["own", "n", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own, t in H.grouped(batches, "own"):
                yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([int(t["n"].to_numpy().sum())]), pa.array([H.matrix(t["sums"]).sum(0)], pa.list_(pa.int64()))], ["own", "n", "sums"])

        kind = "own long, n long, sums array<long>"
        found = rows.mapInArrow(run, kind).repartition("own").sortWithinPartitions("own").mapInArrow(add, kind).toArrow()
        count, total = np.zeros(len(centres), np.int64), np.zeros(centres.shape)
        if found.num_rows:
            count[found["own"].to_numpy()], total[found["own"].to_numpy()] = found["n"].to_numpy(), H.matrix(found["sums"]) / UNIT
        return count, total

    # the smallest class of every cell; of more cells than MOST_CELLS those of the smallest hashes
    cells = classes.frame.groupBy("cell").agg(F.count("*").alias("n"), F.min("class").alias("class"))
    some = F.broadcast(stage(cells.orderBy(F.xxhash64(F.lit(seed), "cell"), "cell").limit(MOST_CELLS).select("class", "n"), "cells"))
    first = classes.frame.join(some, "class").select("class", "x", "y", "n").toArrow().sort_by("class")
    if not first.num_rows:
        return np.zeros((0, 0), np.float32)
    x = features(first.combine_chunks().to_batches()[0])
    c = _start(x, first["n"].to_numpy().astype(np.float64), k, rng).astype(np.float64)
    seen = np.zeros(len(c))
    for part in range(SLICES):
        count, total = sums(classes.frame.where(F.col("slice") == part), c.astype(np.float32))
        seen += count
        hit = count > 0
        c[hit] += (total[hit] - count[hit, None] * c[hit]) / seen[hit, None]
    return c.astype(np.float32)


def quotas(sizes: dict[int, int], target: int, equal: bool = False, kinds: dict[int, int] | None = None) -> dict[int, int]:
    """Slots of each cluster: by the square root of its size (or of ``kinds``), or equal; at least one if there are enough; never over its size.

    Slots that a small cluster can't use are shared out again among the rest, in the same proportions.
    """
    left, out = {c: n for c, n in sizes.items() if n > 0}, {c: 0 for c in sizes}
    slots = min(target, sum(left.values()))
    if slots >= len(left):
        for c in left:
            out[c], slots = 1, slots - 1
    while slots > 0:
        room = {c: n - out[c] for c, n in left.items() if n > out[c]}
        weight = {c: 1.0 if equal else (kinds or left)[c] ** 0.5 for c in room}
        whole = sum(weight.values())
        share = {c: min(room[c], int(slots * weight[c] / whole)) for c in room}
        if not any(share.values()):
            for c in sorted(room, key=lambda c: (-weight[c], c))[:slots]:
                share[c] = 1
        for c, s in share.items():
            out[c] += s
        slots -= sum(share.values())
    return out


def usable_records(batch: DataFrame, spaces: tuple[str, str] = ("clip_image", "dinov2"), dim: int = 64) -> int:
    """The number of different tokens with a usable vector."""
    sound = [H.usable(F.col(c).cast("array<float>"), dim) for c in spaces]
    return batch.where((sound[0] | sound[1]) & F.col("sample_token").isNotNull()).select("sample_token").distinct().count()


def varied_subset(batch: DataFrame, target: int, spaces: tuple[str, str] = ("clip_image", "dinov2"), k: int | None = None, equal: bool = False, dim: int = 64, seed: int = 13) -> tuple[DataFrame, DataFrame]:
    """kept (sample_token, cluster_id, place) and clusters (cluster_id, size, kept).

    A record is usable if either vector is; a missing one counts as zeros. Equal records keep the smallest token only, a
    repeated token counts once. ``k`` is four times the root of the target unless given, a quarter of the target at most. Centres,
    sizes, quotas and the choice cover all records. A target beyond the number of different records keeps them all; none
    gives no rows.
    """
    sound = [H.usable(F.col(c).cast("array<float>"), dim) for c in spaces]
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    vectors = [F.when(s, F.col(c).cast("array<float>")).otherwise(zeros).alias(a) for s, c, a in zip(sound, spaces, "xy")]
    rows = batch.where((sound[0] | sound[1]) & F.col("sample_token").isNotNull()).select(F.col("sample_token").cast("string").alias("token"), *vectors)
    rows = rows.withColumn("class", F.xxhash64("x", "y"))
    k = k or max(2, min(math.ceil(4 * math.sqrt(target)), target // 4))

    def features(b: pa.RecordBatch) -> np.ndarray:
        parts = [H.matrix(b.column(c)).astype(np.float32) for c in ("x", "y")]
        return np.concatenate([p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12) for p in parts], 1)

    kind = "class long, x array<float>, y array<float>, cell long"

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies that a partition holds are merged before the shuffle
        for b in batches:
            fresh = [not (c in seen or seen.add(c)) for c in b.column("class").to_pylist()]
            b = b.filter(pa.array(fresh, pa.bool_()))
            x = features(b) if b.num_rows else np.zeros((0, 2 * dim), np.float32)
            cell = H.mix(7, *(H.tokens(x, H.rotation(2 * dim, seed, t), 1)[:, 0] for t in range(2)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("class", "x", "y")), pa.array(cell.astype(np.int64))], ["class", "x", "y", "cell"])

    def first_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if b.num_rows:
                c = b.column("class").to_numpy()
                fresh = np.r_[c[0] != last, c[1:] != c[:-1]]
                last = c[-1]
                yield b.filter(pa.array(fresh))

    once = rows.select("class", "x", "y").mapInArrow(celled, kind).repartition("class").sortWithinPartitions("class").mapInArrow(first_of, kind)
    classes = Stage(once.withColumn("slice", F.pmod(F.xxhash64(F.lit(seed + 1), "class"), F.lit(SLICES)).cast("int")), "classes", by="slice")
    centres = mini_batch_kmeans(classes, features, k, seed)
    if not len(centres):
        empty = rows.sparkSession.createDataFrame
        return empty([], "sample_token string, cluster_id int, place int"), empty([], "cluster_id int, size long, kept long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = _nearest(features(b), centres) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("cell"), pa.array(own.astype(np.int32))], ["class", "cell", "cluster_id"])

    owners = rows.select("token", "class").groupBy("token").agg(F.min("class").alias("class")).groupBy("class").agg(F.min("token").alias("token"))
    placed = stage(classes.frame.select("class", "x", "y", "cell").mapInArrow(place, "class long, cell long, cluster_id int").join(owners, "class"), "placed")
    classes.drop()
    counts = placed.groupBy("cluster_id", "cell").count().groupBy("cluster_id").agg(F.sum("count").alias("size"), F.count("*").alias("cells")).collect()  # at most k rows
    sizes = {r.cluster_id: r["size"] for r in counts}
    quota = quotas(sizes, target, equal, {r.cluster_id: r.cells for r in counts})
    clusters = rows.sparkSession.createDataFrame([(c, sizes[c], q) for c, q in sorted(quota.items())], "cluster_id int, size long, kept long")
    order = F.xxhash64(F.lit(seed), "token")
    in_cell = placed.withColumn("order", order).withColumn("turn", F.row_number().over(Window.partitionBy("cluster_id", "cell").orderBy("order", "token")))
    # only as many records of a cell as the largest quota can be wanted; the group limit runs before the shuffle
    top = max(quota.values())
    taken = in_cell.where(F.col("turn") <= top).withColumn("place", F.row_number().over(Window.partitionBy("cluster_id").orderBy("turn", "order", "token"))).where(F.col("place") <= top)
    slots = F.broadcast(clusters.select("cluster_id", F.col("kept").alias("slots")))  # k rows
    return taken.join(slots, "cluster_id").where("place <= slots").select(F.col("token").alias("sample_token"), "cluster_id", "place"), clusters

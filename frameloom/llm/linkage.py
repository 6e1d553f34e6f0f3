"""Similarity clusters by reciprocal-nearest-neighbour average linkage (problem 6).

A node is a cluster: its weight and the mean of its unit vectors. The average similarity of two clusters is the product of
their means, so linkage is exact without keeping pairs. Each round hashes the means by fresh pseudo-rotations, which makes
the sparse graph: nodes of a block are neighbours. Within a block all mutual best pairs merge in parallel, again and again, as
long as their average similarity reaches the level of the block: the first quartile of its nodes' best similarities of those that
reach the threshold. So tight merges precede loose ones, whatever the scale of the similarities is, and the levels come down as the tight pairs are
merged. Rounds go on, each on other blocks and over all nodes that are left, until several in a row have merged nothing although
all their blocks were down at the threshold. A round's work is written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm import hashing as H
from frameloom.llm.components import _look_up
from frameloom.operators.order import ranked
from frameloom.session import Stage, stage

NODE = "cid long, target long, n long, mean array<float>, high boolean"
NAMES = ["cid", "target", "n", "mean", "high"]
#: Nodes of a bucket above which it is cut, along its order, before the shuffle.
HEAVY = 65_536
#: Rounds in a row without a merge, at the threshold, that end the linkage.
DRY = 3


def merge_block(mean: np.ndarray, n: np.ndarray, level: float, s: np.ndarray | None = None) -> np.ndarray:
    """The group of each node, by the row number of the group's first node, after merging mutual best pairs down to ``level``.

    ``s``: the similarities as ``block_similarities`` has them, which are overwritten. Only rows whose best is gone look for another:
    a mean of two values is never above both, so the other rows keep theirs.
    """
    root, at, w = np.arange(len(n)), np.arange(len(n)), n.astype(np.float32)
    s = block_similarities(mean) if s is None else s
    alive, best = np.ones(len(at), bool), s.argmax(1) if len(at) else np.zeros(0, np.int64)
    top = s[np.arange(len(at)), best]
    while len(at) > 1:
        k = np.arange(len(at))
        i = np.flatnonzero((best[best] == k) & (k < best) & (top >= level))
        if not len(i):
            break
        j = best[i]
        root[at[j]] = at[i]
        p, q = (w[i] / (w[i] + w[j]))[:, None], (w[j] / (w[i] + w[j]))[:, None]
        rows = p * s[i] + q * s[j]
        rows[:, i] = rows[:, i] * p.T + rows[:, j] * q.T
        rows[:, j] = -9
        rows[np.arange(len(i)), i] = -9
        s[:, i], s[:, j] = rows.T, -9
        s[i], s[j] = rows, -9
        w[i] += w[j]
        alive[j] = False
        gone = np.zeros(len(at), bool)
        gone[i] = gone[j] = True
        if alive.mean() < 0.7:
            near = np.cumsum(alive) - 1
            gone = gone[best][alive] | gone[alive]
            s, at, w, best, top = s[np.ix_(alive, alive)], at[alive], w[alive], near[best[alive]], top[alive]
            alive = np.ones(len(at), bool)
        else:
            gone = gone[best] | gone
        new = np.flatnonzero(gone)
        best[new] = s[new].argmax(1)
        top[new] = s[new, best[new]]
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def block_similarities(mean: np.ndarray) -> np.ndarray:
    """Products of all means, with nothing on the diagonal."""
    x = mean.astype(np.float32)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    return s


def block_level(mean: np.ndarray, threshold: float, s: np.ndarray | None = None) -> float:
    """The first quartile of the nodes' best similarities within the block, and ``threshold`` at least."""
    if len(mean) < 2:
        return threshold
    best = (block_similarities(mean) if s is None else s).max(1)
    best = best[best >= threshold]
    return max(threshold, float(np.quantile(best, 0.25))) if len(best) > 16 else threshold


def _rows(cid: np.ndarray, target: np.ndarray, n: np.ndarray, mean: list | None, high: bool) -> pa.RecordBatch:
    means = pa.array(mean, pa.list_(pa.float32())) if mean is not None else pa.nulls(len(cid), pa.list_(pa.float32()))
    return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(target), pa.array(n), means, pa.array(np.full(len(cid), high))], NAMES)


def _merged(table: pa.Table, threshold: float) -> Iterator[pa.RecordBatch]:
    cid, n, mean = table["cid"].to_numpy(), table["n"].to_numpy(), H.matrix(table["mean"])
    s = block_similarities(mean)
    level = block_level(mean, threshold, s)
    root = merge_block(mean, n, level, s)
    heads, group = np.unique(root, return_inverse=True)
    total = np.bincount(group, n).astype(np.int64)
    sums = np.zeros((len(heads), mean.shape[1]))
    np.add.at(sums, group, mean * n[:, None].astype(np.float64))
    yield _rows(cid[heads], cid[heads], total, list((sums / total[:, None]).astype(np.float32)), level > threshold)
    gone = np.flatnonzero(root != np.arange(len(cid)))
    if len(gone):
        yield _rows(cid[gone], cid[root[gone]], np.zeros(len(gone), np.int64), None, False)


def _hashed(nodes: DataFrame, number: int, turns: int, seed: int, pieces: dict[int, int]) -> DataFrame:
    """key, ord and the node: the bucket by ``turns`` rotations and the place in it by another. Buckets in ``pieces`` are cut along that order."""
    heavy = np.array(sorted(pieces), np.int64)
    cuts = np.array([pieces[k] for k in sorted(pieces)], np.int64)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = H.matrix(b.column("mean"))
                key = H.mix(seed, np.zeros(len(x), np.int64))
                for t in range(turns):
                    key = H.mix(key, H.tokens(x, H.rotation(x.shape[1], seed + number, t), 1)[:, 0])
                key = key.astype(np.int64)
                order = H.tokens(x, H.rotation(x.shape[1], seed + number, turns), 1)[:, 0]
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, key), len(heavy) - 1)
                    cut = np.where(heavy[at] == key, cuts[at], 1)
                    wide = H.padded(x.shape[1]) * 2
                    place = order * 64 + (H.mix(5, b.column("cid").to_numpy()) % np.uint64(64)).astype(np.int64)
                    key = np.where(cut > 1, H.mix(key, place * cut // (64 * wide)).astype(np.int64), key)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(order.astype(np.int32)), *(b.column(c) for c in ("cid", "n", "mean"))], ["key", "ord", "cid", "n", "mean"])

    return nodes.select("cid", "n", "mean").mapInArrow(keyed, "key long, ord int, cid long, n long, mean array<float>")


def block_size(count: int) -> int:
    """Nodes of a block, the same however many there are."""
    return 4096


def _round(nodes: DataFrame, threshold: float, number: int, count: int, seed: int = 71) -> DataFrame:
    """One hashed round. Buckets are cut into blocks in the order of another rotation, so block mates are as similar as can be."""
    block = block_size(count)
    # as many as fit in a block are one bucket, so they are one block
    turns = 0 if count <= block else max(1, math.ceil(math.log(max(2, count) / (64 * 1024)) / math.log(128)))
    pieces: dict[int, int] = {}
    if count > HEAVY:  # else no bucket is heavy; only heavy ones come to the driver, at most count / HEAVY
        some = nodes.where(F.pmod(F.xxhash64(F.lit(9), "cid"), F.lit(64)) == 0)
        found = _hashed(some, number, turns, seed, {}).groupBy("key").count().where(F.col("count") * 64 > HEAVY).collect()
        pieces = {r.key: -(-r["count"] * 64 * 2 // HEAVY) for r in found}

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:  # blocks may hold the end of one bucket and the start of the next
            while b.num_rows:
                room = block - sum(x.num_rows for x in held)
                held.append(b.slice(0, room))
                b = b.slice(room)
                if sum(x.num_rows for x in held) == block:
                    yield from _merged(pa.Table.from_batches(held), threshold)
                    held = []
        if held:
            yield from _merged(pa.Table.from_batches(held), threshold)

    return _hashed(nodes, number, turns, seed, pieces).repartition("key").sortWithinPartitions("key", "ord", "cid").mapInArrow(merge, NODE)


def similarity_clusters(batch: DataFrame, column: str = "clip_image", threshold: float = 0.37, dim: int = 64, max_rounds: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (token, class, cid), clusters (cid, n, mean of the unit vectors), and the rows they were made of.

    Clusters of one member are isolated records. Unusable vectors (null, another length, all zero, null or infinite values)
    belong to none. Equal vectors are one node weighted by its tokens; a repeated token counts once.
    """
    rows = H.class_rows(batch, column, dim)
    own = stage(H.members(rows), "members")
    weight = own.groupBy("class").agg(F.count("*").alias("n"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = H.matrix(b.column(2)).astype(np.float64) if b.num_rows else np.zeros((0, dim))
            x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float32()))], ["cid", "n", "mean"])

    first = rows.select("class", "vector").dropDuplicates(["class"]).join(weight, "class").select(F.col("class").alias("cid"), "n", "vector")
    held = Stage(first.mapInArrow(unit, "cid long, n long, mean array<float>"), "nodes")
    nodes, count, dry, number = held.frame, held.frame.count(), 0, 0
    maps: list[tuple[DataFrame, int]] = []
    while count > 1 and dry < (DRY if count > block_size(count) else 1):  # so few nodes are one block
        if number == max_rounds:
            raise RuntimeError(f"clusters still merge after {max_rounds} rounds")
        out = Stage(_round(nodes, threshold, number, count), "round")
        left = out.frame.where("mean is not null").agg(F.count("*").alias("n"), F.coalesce(F.bool_or("high"), F.lit(False)).alias("high")).first()
        if left.n < count:
            maps.append((out.frame.where("cid <> target").select("cid", "target"), count - left.n))
            nodes = out.frame.where("mean is not null").select("cid", "n", "mean")
        dry = dry + 1 if left.n == count and not left.high else 0
        if left.n == count:
            out.drop()  # the same nodes again
        count, number = left.n, number + 1
    # where each node went in the end, from the last round to the first
    gone: Stage | None = None
    for moved, size in reversed(maps):
        after = moved
        if gone is not None:
            far = _look_up(moved, "target", gone.frame.withColumnRenamed("cid", "id"), "target", size, "next")
            after = far.select("cid", F.coalesce("next", "target").alias("target")).unionByName(gone.frame)
        after = Stage(after, "gone")
        if gone is not None:
            gone.drop()
        gone = after
    labels = own.select("token", "class", F.col("class").alias("cid"))
    if gone is not None:
        labels = labels.join(gone.frame, "cid", "left").select("token", "class", F.coalesce("target", "cid").alias("cid"))
    return stage(labels, "labels"), nodes, rows


def label_clusters(clusters: DataFrame, prompts: DataFrame, dim: int = 64) -> DataFrame:
    """cid, n, prompt_id, prompt, fit: each cluster with the prompt whose clip_text has the highest cosine with its mean.

    Ties go to the smaller prompt_id. Prompts are a short list; more than 10,000 are refused. Prompts without a usable vector
    take no part, and with none left the label is null.
    """
    texts = prompts.where(H.usable(F.col("clip_text").cast("array<float>"), dim) & F.col("prompt_id").isNotNull()).select("prompt_id", "prompt", "clip_text").orderBy("prompt_id").take(10_001)
    if len(texts) > 10_000:
        raise ValueError("more than 10,000 prompts")
    if not texts:
        return clusters.select("cid", "n", F.lit(None).cast("int").alias("prompt_id"), F.lit(None).cast("string").alias("prompt"), F.lit(None).cast("double").alias("fit"))
    p = np.array([r.clip_text for r in texts], np.float64)
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    ids, words = pa.array([r.prompt_id for r in texts], pa.int32()), pa.array([r.prompt for r in texts], pa.string())

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = H.matrix(b.column(2)).astype(np.float64) if b.num_rows else np.zeros((0, dim))
            s = x @ p.T / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)
            best = s.argmax(1) if len(s) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids.take(pa.array(best)), words.take(pa.array(best)), pa.array(s[np.arange(len(s)), best])], ["cid", "n", "prompt_id", "prompt", "fit"])

    return clusters.select("cid", "n", "mean").mapInArrow(label, "cid long, n long, prompt_id int, prompt string, fit double")


def member_prompts(batch: DataFrame, prompts: DataFrame, least_size: int = 5, threshold: float = 0.37) -> DataFrame:
    """sample_token, prompt_id of each member of a cluster of at least ``least_size`` (smaller ones are isolated records)."""
    labels, clusters, _ = similarity_clusters(batch, threshold=threshold)
    named = label_clusters(clusters.where(F.col("n") >= least_size), prompts)
    return labels.join(named.select("cid", "prompt_id"), "cid").select(F.col("token").alias("sample_token"), "prompt_id")


def cluster_records(batch: DataFrame, prompts: DataFrame, least_size: int = 5, threshold: float = 0.37, typical: int = 5) -> DataFrame:
    """cluster_id (from 0, the largest first), label, prompt_id, size, members: the ``typical`` members nearest to the mean."""
    labels, clusters, rows = similarity_clusters(batch, threshold=threshold)
    clusters = stage(clusters.where(F.col("n") >= least_size), "clusters")
    named = ranked(label_clusters(clusters, prompts), [F.desc("n"), F.asc("cid")], "cluster_id")
    vectors = rows.select("class", "vector").dropDuplicates(["class"])
    dot = F.aggregate(F.zip_with("vector", "mean", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v))
    near = labels.join(clusters.select("cid", "mean"), "cid").join(vectors, "class").select("cid", "token", (dot / norm).alias("near"))
    near = near.withColumn("at", F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("near"), "token"))).where(F.col("at") <= typical)
    near = near.groupBy("cid").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x.token).alias("members"))
    return named.join(near, "cid").select("cluster_id", F.col("prompt").alias("label"), "prompt_id", F.col("n").alias("size"), "members")

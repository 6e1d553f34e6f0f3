"""Near-duplicate records with small edits, by a chosen-path join (problem 2).

Each vector is read as a set: of every pseudo-rotation, the two signed axes nearest to it. Small edits leave most of the
set unchanged. A run splits all records by the tokens of one sampled rotation (a record follows both its tokens), splits each
part again by others, sampled by the hash of the path so far, and compares all pairs once a part is small. The first split is the
shuffle; only buckets too large for a task are split again before it, and all deeper splits happen inside the task that holds
the part (``candidates``). How often a rotation keeps a pair at the threshold is measured on drawn pairs, which gives
the number of runs; how many pairs the runs still miss is then estimated from the pairs that few runs found, and runs are
repeated until that share is below the target. What the bounds leave open is checked on the stored floats.

Defined results: a vector that is null, of another length, all zero, or with null or infinite values takes no part. Equal
vectors are one class, joined once. A repeated token counts once. Extra columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm import candidates as C
from frameloom.llm import hashing as H
from frameloom.llm.components import min_label_components
from frameloom.session import Stage, stage

#: Splits inside a task that a run's recall is reckoned with.
INSIDE = 4


def runs_needed(threshold: float, recall: float, dim: int, shipped: int = 1) -> int:
    """Runs that leave less than 1 - ``recall`` of the pairs at the threshold, the least similar ones, unfound."""
    p = min(0.999999, H.level_recall(threshold, dim))
    run = p**shipped * (1 - (1 - p) ** C.TURNS) ** INSIDE
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - run)))


def missed_share(once: int, twice: int, found: int, runs: int) -> float:
    """The estimated share of pairs that no run found, from those that exactly one and exactly two runs found (Chao's estimator)."""
    unseen = (runs - 1) / runs * once * max(0, once - 1) / (2 * (twice + 1))
    return unseen / max(1.0, found + unseen)


def close_in_runs(rows: DataFrame, plan: C.Layout, least: float) -> DataFrame:
    """a, b, sim, turn, runs: pairs of classes that some run finds and that can be as similar as ``least``; the cosine of their
    codes, the angle by which it is off at most, and a bit for each run."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, classes, codes in C.cell_rows(batches):
            off, found = H.turns(codes), []
            for at in C.leaves(codes, cell, plan.seed, plan.probes):
                p, q = C.close_pairs(H.decode(codes[at]), H.loosest(least, float(off[at].max())))
                found.append(np.minimum(at[p], at[q]) * len(classes) + np.maximum(at[p], at[q]))
            both = np.unique(np.concatenate(found))
            for lo in range(0, len(both), 65536):
                i, j = both[lo : lo + 65536] // len(classes), both[lo : lo + 65536] % len(classes)
                sim = np.einsum("ij,ij->i", H.decode(codes[i]), H.decode(codes[j]))
                yield pa.RecordBatch.from_arrays([pa.array(classes[i]), pa.array(classes[j]), pa.array(sim), pa.array(off[i] + off[j]), pa.array(np.full(len(i), 1 << (cell & 63), np.int64))], ["a", "b", "sim", "turn", "runs"])

    pairs = C.in_cells(rows, plan).mapInArrow(search, "a long, b long, sim float, turn float, runs long")
    return pairs.groupBy("a", "b").agg(F.min("sim").alias("sim"), F.max("turn").alias("turn"), F.bit_or("runs").alias("runs"))


def near_duplicate_classes(rows: DataFrame, number: int, threshold: float = 0.97, recall: float = 0.9999, dim: int = 64, seed: int = 17) -> DataFrame:
    """a, b of the classes of ``class_rows``, about ``number`` of them, with a cosine of at least ``threshold``.

    A pair whose codes are so similar that rounding can't have made the difference needs no check; the others are checked.
    """
    sample = C.sampled(rows, number)
    runs = runs_needed(threshold, recall, dim)
    plan = C.layout(sample, seed, tuple(range(runs)), 2, dim)
    while plan.depth > 1 and runs_needed(threshold, recall, dim, plan.depth) > len(plan.roots):
        plan = C.layout(sample, seed, tuple(range(runs_needed(threshold, recall, dim, plan.depth))), 2, dim)
    held = Stage(close_in_runs(rows, plan, threshold), "pairs")
    while len(plan.roots) < 62:
        own = F.bit_count("runs")
        n = held.frame.agg(F.count("*").alias("found"), F.count(F.when(own == 1, 1)).alias("once"), F.count(F.when(own == 2, 1)).alias("twice")).first()
        if len(plan.roots) > 1 and missed_share(n.once, n.twice, n.found, len(plan.roots)) <= 1 - recall:
            break
        more = C.layout(sample, seed, tuple(range(len(plan.roots), min(62, len(plan.roots) + 2))), 2, dim)
        plan.roots += more.roots
        joined = held.frame.unionByName(close_in_runs(rows, more, threshold)).groupBy("a", "b").agg(F.min("sim").alias("sim"), F.max("turn").alias("turn"), F.bit_or("runs").alias("runs"))
        after = Stage(joined, "pairs")
        held.drop()
        held = after
    at = F.acos(F.least(F.lit(1.0), F.col("sim").cast("double")))
    sure = at + F.col("turn") + 1e-4 <= float(np.arccos(threshold))
    checked = C.exact(held.frame.where(~sure), rows, dim).where(F.col("sim") >= threshold)
    return held.frame.where(sure).select("a", "b").unionByName(checked.select("a", "b"))


def near_duplicate_pairs(batch: DataFrame, column: str = "dinov2", threshold: float = 0.97, dim: int = 64) -> DataFrame:
    """token_a, token_b: every pair of different tokens whose cosine is at least ``threshold``, the smaller token first.

    This expands groups of equal vectors into all pairs, as the result is defined; ``near_duplicate_groups`` doesn't.
    """
    rows = H.class_rows(batch, column, dim)
    own = stage(H.members(rows), "members")
    links = near_duplicate_classes(rows, own.count(), threshold, dim=dim)
    a, b = (own.select(F.col("class").alias(c), F.col("token").alias(t)) for c, t in (("a", "s"), ("b", "t")))
    across = links.join(a, "a").join(b, "b").select(F.least("s", "t").alias("token_a"), F.greatest("s", "t").alias("token_b"))
    same = own.alias("x").join(own.alias("y"), (F.col("x.class") == F.col("y.class")) & (F.col("x.token") < F.col("y.token")))
    return across.unionByName(same.select(F.col("x.token").alias("token_a"), F.col("y.token").alias("token_b")))


def near_duplicate_groups(batch: DataFrame, column: str = "dinov2", threshold: float = 0.97, dim: int = 64) -> DataFrame:
    """sample_token, group_token, n_links: each token that has a near-duplicate, with the smallest token of its group and the
    number of tokens linked to it directly. Pairs are made between classes of equal vectors only."""
    rows = H.class_rows(batch, column, dim)
    own = stage(H.members(rows), "members")
    links = stage(near_duplicate_classes(rows, own.count(), threshold, dim=dim), "links")
    sizes = own.groupBy("class").agg(F.count("*").alias("size"), F.min("token").alias("least"))
    both = links.select(F.col("a").alias("class"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("class"), F.col("a").alias("other")))
    near = both.join(sizes.select(F.col("class").alias("other"), "size"), "other").groupBy("class").agg(F.sum("size").alias("near"))
    root = min_label_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    groups = sizes.join(root.select(F.col("node").alias("class"), "label"), "class", "left").join(near, "class", "left")
    groups = groups.where(F.col("label").isNotNull() | (F.col("size") > 1)).withColumn("label", F.coalesce("label", "class"))
    least = groups.groupBy("label").agg(F.min("least").alias("group_token"))
    each = groups.join(least, "label").select("class", "group_token", (F.coalesce("near", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    return own.join(each, "class").select(F.col("token").alias("sample_token"), "group_token", "n_links")

"""Most similar vectors for every vector, by cross-polytope hashing (problem 4).

A table hashes a unit vector by a pseudo-rotation to its nearest signed axes. Multiprobe: a record goes into the buckets of its
nearest axes (two, unless told otherwise), so a close pair that a cut separates still meets. The other rotations of a table are
applied inside the task that holds the bucket, to parts that are still large, several at once (``candidates``); so more records
mean more splits in tasks, neither more entries nor less recall. The number of tables follows from the share of pairs that a
rotation keeps, which is measured on drawn pairs. A part sends on only what can be among a record's k best, as far as the
codes tell. Of these, answers that the codes can't settle are ranked again by the exact cosine of the stored floats.

Defined results: unusable vectors (null, another length, all zero, null or infinite values) are neither queries nor
answers. A repeated token counts once. Equal vectors are one class: each class offers its k + 1 smallest tokens, which are
all that can be among k answers with ties by smaller token. With fewer than k other samples, fewer come out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm import candidates as C
from frameloom.llm import hashing as H
from frameloom.session import stage

#: Splits inside a task that a table's recall is reckoned with.
INSIDE = 2
#: Similarities count as equal when they are when rounded to six decimals.
TIE = 2e-6


def tables_needed(least: float, dim: int, probes: int = 2, recall: float = 0.998, shipped: int = 1) -> int:
    """Tables that find a pair at the cosine ``least`` with a probability of ``recall``."""
    p = min(0.999999, H.level_recall(least, dim, probes))
    table = p**shipped * (1 - (1 - p) ** C.TURNS) ** INSIDE
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - table)))


def class_neighbours(rows: DataFrame, k: int, least: float | None, plan: C.Layout) -> DataFrame:
    """class, other, sim, turn: for each class those that can be among its ``k`` most similar (of at least ``least``), with the
    cosine of their codes and the angle by which it is off at most."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, classes, codes in C.cell_rows(batches):
            off, unit, found, sims = H.turns(codes), C.unit_parts(codes), [], []
            for at in C.leaves(codes, cell, plan.seed, plan.probes):
                turn = float(off[at].max())
                p, q, s = C.nearest(unit(at), k, H.loosest(least, turn) if least is not None else -2.0, turn)
                found.append(at[p] * len(classes) + at[q])
                sims.append(s)
            both, first = np.unique(np.concatenate(found), return_index=True)
            sims = np.concatenate(sims)[first]
            keep = C.still_best(both // len(classes), sims, k, float(off.max()), H.width(codes))
            both, sims = both[keep], sims[keep]
            for lo in range(0, len(both), 65536):
                i, j = both[lo : lo + 65536] // len(classes), both[lo : lo + 65536] % len(classes)
                yield pa.RecordBatch.from_arrays([pa.array(classes[i]), pa.array(classes[j]), pa.array(sims[lo : lo + 65536]), pa.array(off[i] + off[j])], ["class", "other", "sim", "turn"])

    pairs = C.in_cells(rows, plan).mapInArrow(search, "class long, other long, sim float, turn float").repartition("class")
    return pairs.groupBy("class", "other").agg(F.max("sim").alias("sim"), F.max("turn").alias("turn"))


def _settled(links: DataFrame, sizes: DataFrame, k: int, least: float | None, ranked: bool, dim: int) -> DataFrame:
    """Links that can matter, with their bounds ``low`` and ``high`` and whether they are ``open``: a link is settled if so few tokens can
    be better that its class is among the k best whatever the exact cosines are, or, with ``ranked``, never."""
    other, mine = sizes.select(F.col("class").alias("other"), F.col("n").alias("w")), sizes.select("class", F.col("n").alias("w0"))
    links = links.join(other, "other", "left").join(mine, "class", "left").withColumn("w", F.coalesce("w", F.lit(1))).withColumn("w0", F.coalesce("w0", F.lit(1)) - 1)
    at = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("sim").cast("double"))))
    links = links.withColumn("sure", F.lit(not ranked))
    if least is not None:
        links = links.where(F.cos(F.greatest(F.lit(0.0), at - F.col("turn"))) + TIE >= least).withColumn("sure", F.col("sure") & (F.cos(F.least(F.lit(math.pi), at + F.col("turn"))) - TIE >= least))
    off = F.col("turn") * C.likely(dim)
    links = links.withColumn("low", F.cos(F.least(F.lit(math.pi), at + off)) - TIE).withColumn("high", F.cos(F.greatest(F.lit(0.0), at - off)) + TIE)
    by = Window.partitionBy("class")
    links = links.withColumn("above", F.sum("w").over(by.orderBy(F.desc("low")))).withColumn("reach", F.sum("w").over(by.orderBy(F.desc("high"))) + F.col("w0"))
    # k tokens are surely at least as good as ``floor``; no more than k tokens can be better than ``roof``
    links = links.withColumn("floor", F.max(F.when(F.col("above") >= k, F.col("low"))).over(by)).withColumn("roof", F.max(F.when(F.col("reach") > k, F.col("high"))).over(by))
    links = links.where(F.coalesce(F.col("high") >= F.col("floor"), F.lit(True)))
    settled = F.coalesce(F.col("low") > F.col("roof"), F.lit(True)) & F.col("sure")
    return links.select("class", "other", F.col("sim").cast("double").alias("sim"), (~settled).alias("open"))


def nearest_samples(batch: DataFrame, column: str, k: int = 5, least: float | None = None, dim: int = 64, tables: int | None = None, probes: int | None = None, ranked: bool = True, seed: int = 29) -> DataFrame:
    """sample_token, rank (from 1), neighbour, sim: the k most similar other samples of each, sim rounded to 6 decimals.

    Ties go to the smaller token. ``least`` drops what is less similar, and lets the tables search only for that: as many
    tables of 2 probes as find 0.998 of the pairs at ``least``, and nearly all above. Without it, 10 tables of 5
    probes find over 0.9 of the nearest even of unrelated vectors. Without ``ranked`` the answers are the same, but the order and
    sim of those that need no exact check are those of the codes.
    """
    rows = H.class_rows(batch, column, dim)
    own = stage(H.members(rows), "members")
    number = own.count()
    probes = probes or (2 if least is not None else 5)
    tables = tables or (tables_needed(least, dim, probes) if least is not None else 10)
    sample = C.sampled(rows, number)
    plan = C.layout(sample, seed, tuple(range(tables)), probes, dim)
    if least is not None and plan.depth > 1:
        plan = C.layout(sample, seed, tuple(range(max(tables, tables_needed(least, dim, probes, shipped=plan.depth)))), probes, dim)
    shared = stage(own.groupBy("class").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    near = _near(class_neighbours(rows, k, least, plan), rows, shared, k, least, ranked, dim)
    return _answers(near, own, own, k)


def _near(found: DataFrame, rows: DataFrame, shared: DataFrame, k: int, least: float | None, ranked: bool, dim: int) -> DataFrame:
    """class, other, sim (rounded) of links that can matter, checked where codes can't settle them, and of each shared class with itself."""
    small = F.broadcast(shared) if shared.count() <= C.BROADCAST_ROWS else shared
    links = stage(_settled(found, small, k, least, ranked, dim), "links")
    ends = F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")
    sims = C.exact(links.where("open").select(*ends).distinct(), rows, dim)
    sims = sims if least is None else sims.where(F.round("sim", 6) >= least)
    checked = links.where("open").select("class", "other", *ends).join(sims, ["a", "b"]).select("class", "other", "sim")
    near = links.where("not open").select("class", "other", "sim").unionByName(checked)
    same = shared.select("class", F.col("class").alias("other"), F.lit(1.0).alias("sim"))
    return stage(near.withColumn("sim", F.round("sim", 6)).unionByName(same), "near")


def _answers(near: DataFrame, asking: DataFrame, own: DataFrame, k: int) -> DataFrame:
    """sample_token, rank, neighbour, sim of the tokens that ask (token, class) among all (token, class), from links of their classes."""
    # only tokens whose class has a neighbour or another token answer
    own = stage(own.join(near.select(F.col("other").alias("class")).distinct(), "class", "left_semi"), "answering")
    some = own.withColumn("at", F.row_number().over(Window.partitionBy("class").orderBy("token"))).where(F.col("at") <= k + 1)
    offers = near.join(some.select(F.col("class").alias("other"), F.col("token").alias("neighbour")), "other")
    # per class the k + 1 best tokens: a member of the class leaves itself out
    best = Window.partitionBy("class").orderBy(F.desc("sim"), "neighbour")
    offers = offers.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).select("class", "neighbour", "sim")
    mine = offers.join(asking, "class").where(F.col("token") != F.col("neighbour"))
    rank = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("sim"), "neighbour"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("token").alias("sample_token"), "rank", "neighbour", "sim")


def nearest_of(batch: DataFrame, asked: Column, column: str, k: int = 10, dim: int = 64, tables: int = 5, probes: int = 16, seed: int = 29) -> DataFrame:
    """sample_token, rank (from 1), neighbour, sim: the k most similar other samples, whatever their cosine, of each sample for whose
    ``token`` the condition ``asked`` holds, among all samples.

    All records are in one bucket a table; those that ask probe many. With 5 tables of 16 probes of 128 a neighbour at a
    cosine of 0.5 is found with a probability of 0.98. Ties go to the smaller token; unusable vectors neither ask nor answer.
    """
    rows = H.class_rows(batch, column, dim)
    own = stage(H.members(rows), "members")
    asking = stage(own.where(asked), "asking")
    kinds = asking.select("class").distinct()
    mine = stage(rows.select("class", "vector").join(F.broadcast(kinds) if asking.count() <= C.BROADCAST_ROWS else kinds, "class", "left_semi").dropDuplicates(["class"]), "asking")
    plan = C.layout(C.sampled(rows, own.count()), seed, tuple(range(tables)), 1, dim)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in H.grouped(batches, "cell"):
            cut = int(np.searchsorted(t["side"].to_numpy(), 1))
            if cut in (0, t.num_rows):
                continue
            first, all_codes = t["class"].to_numpy(), np.concatenate([H.bytes_matrix(c) for c in t["code"].chunks])
            asks, ask_at = np.unique(first[:cut], return_index=True)
            rest, rest_at = np.unique(first[cut:], return_index=True)
            off, q, codes = H.turns(all_codes), H.decode(all_codes[:cut][ask_at]), all_codes[cut:][rest_at]
            q_off, c_off = off[:cut][ask_at], off[cut:][rest_at]
            turn = float(off.max())
            for lo in range(0, len(asks), 512):
                i, j, sims = [], [], []
                for c in range(0, len(rest), 16384):  # the best of each stretch, then of all
                    s = q[lo : lo + 512] @ H.decode(codes[c : c + 16384]).T
                    s[asks[lo : lo + 512, None] == rest[None, c : c + 16384]] = -9
                    p, r = C.best_columns(s, k, turn, dim)
                    i.append(p)
                    j.append(r + c)
                    sims.append(s[p, r])
                i, j, sims = np.concatenate(i), np.concatenate(j), np.concatenate(sims)
                order = np.lexsort((j, i))
                i, j, sims = i[order], j[order], sims[order]
                keep = C.still_best(i, sims, k, turn, dim) & (sims > -2)
                i, j, sims = i[keep], j[keep], sims[keep]
                yield pa.RecordBatch.from_arrays([pa.array(asks[lo + i]), pa.array(rest[j]), pa.array(sims), pa.array(q_off[lo + i] + c_off[j])], ["class", "other", "sim", "turn"])

    found = C.asked_cells(mine, rows, plan, probes).mapInArrow(search, "class long, other long, sim float, turn float").repartition("class")
    found = found.groupBy("class", "other").agg(F.max("sim").alias("sim"), F.max("turn").alias("turn"))
    shared = stage(own.groupBy("class").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    near = _near(found, rows, shared, k, None, True, dim)
    return _answers(near.join(kinds, "class", "left_semi"), asking, own, k)


def close_neighbour_pairs(batch: DataFrame, spaces: tuple[str, ...] = ("dinov2", "clip_image"), k: int = 5, least: float = 0.9, dim: int = 64) -> DataFrame:
    """space, token_a, token_b: each pair of which one is among the other's k nearest with a cosine of at least ``least``."""
    out = None
    for space in spaces:
        near = nearest_samples(batch, space, k, least, dim, ranked=False)
        pairs = near.select(F.lit(space).alias("space"), F.least("sample_token", "neighbour").alias("token_a"), F.greatest("sample_token", "neighbour").alias("token_b")).distinct()
        out = pairs if out is None else out.unionByName(pairs)
    return out

"""Components of a similarity graph by contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.session import Stage


def _roots(edges: DataFrame) -> Stage:
    """token, root: each end of an edge with the end of its path of smallest neighbours. Jumps halve the paths."""
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    held = Stage(ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("token"), F.least("a", "m").alias("root")), "roots")
    while True:
        far = held.frame.select(F.col("token").alias("root"), F.col("root").alias("next"))
        after = Stage(held.frame.join(far, "root").select("token", F.col("root").alias("old"), F.col("next").alias("root")), "roots")
        held.drop()
        held = after
        if not held.frame.where("old <> root").limit(1).count():
            return held


def components(edges: DataFrame, max_rounds: int = 500) -> DataFrame:
    """token, root: each end of an edge (a, b) with the smallest token of its component.

    A round sends each token along its smallest neighbours to a token that is smaller than all of its own, and goes on with the edges
    between those, which are half as many at most; edges inside a part take no further part. It is written to the shared folder.
    Edges are shuffled to fetch their ends' roots, minima to be compared, neighbour lists never. Null ends are no edge; no
    edges give no rows.
    """
    held = Stage(edges.where("a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "edges")
    rounds: list[Stage] = []
    for _ in range(max_rounds):
        roots = _roots(held.frame)
        rounds.append(roots)
        ends = [roots.frame.select(F.col("token").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab"]
        apart = held.frame.join(ends[0], "a").select("b", "a_root").join(ends[1], "b").where("a_root <> b_root")
        after = Stage(apart.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "edges")
        held.drop()
        held = after
        if not held.frame.limit(1).count():
            break
    else:
        raise RuntimeError(f"components still merge after {max_rounds} rounds")
    held.drop()
    labels = rounds.pop()
    while rounds:  # where each token went in the end, from the last round to the first
        first, last = rounds.pop(), labels
        to = last.frame.select(F.col("token").alias("root"), F.col("root").alias("next"))
        labels = Stage(first.frame.join(to, "root", "left").select("token", F.coalesce("next", "root").alias("root")), "labels")
        first.drop()
        last.drop()
    return labels.frame.select("token", "root")

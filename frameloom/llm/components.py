"""Connected components over many pairs: minimum labels with pointer jumping (problem 5), and alternating stars (problem 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.session import Stage, stage


def _edges(pairs: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct undirected edges, smaller node first; no nulls, no loops."""
    low, high = F.least(src, dst), F.greatest(src, dst)
    sound = F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))
    return pairs.where(sound).select(low.alias("src"), high.alias("dst")).distinct()


#: Rows that one key may have in a shuffled join. Values of more frequent keys are sent to all tasks: there are few such keys.
HOT = 1 << 18


def _hot(frame: DataFrame, column: str, rows: int) -> DataFrame | None:
    """Values of a column that more than HOT of its ``rows`` have: at most rows / HOT."""
    if rows <= HOT:
        return None
    found = stage(frame.groupBy(column).count().where(F.col("count") > HOT).select(column), "hot")
    return found if found.count() else None


def _look_up(big: DataFrame, column: str, small: DataFrame, value: str, rows: int, out: str) -> DataFrame:
    """``big`` with the ``value`` that ``small`` (id, value) has for a column, as ``out``; null where it has none. A hot key is not shuffled."""
    own = small.select(F.col("id").alias("_id"), F.col(value).alias(out))
    hot = _hot(big, column, rows)
    if hot is None:
        return big.join(own, big[column] == own["_id"], "left").drop("_id")
    few = small.join(F.broadcast(hot.select(F.col(column).alias("id"))), "id", "left_semi").select(F.col("id").alias("_hid"), F.col(value).alias("_hot"))
    big = big.join(F.broadcast(few), F.col(column) == F.col("_hid"), "left")
    # rows that have their value go anywhere
    big = big.withColumn("_key", F.when(F.col("_hid").isNull(), F.col(column)).otherwise(F.xxhash64(*big.columns)))
    big = big.join(own, F.col("_key") == F.col("_id"), "left")
    return big.withColumn(out, F.when(F.col("_hid").isNull(), F.col(out)).otherwise(F.col("_hot"))).drop("_hid", "_hot", "_key", "_id")


def min_label_components(pairs: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """node, label, size: every node of an edge between two different nodes, with the smallest node and the size of its component.

    Nodes are told by a 64-bit hash, so that rounds move numbers, in an order that has nothing to do with the graph; two nodes of
    one hash are noticed, and another hash is taken. A round gives each node the smallest number among itself and its
    neighbours and jumps: a node's parent becomes its parent's. Then edges are contracted to the parents of their ends: those
    inside one parent go, equal ones become one, and components without an edge left are finished and take no further part.
    Each round is written to the shared folder; the loop ends when no edge is left. Parents are then followed back to the
    nodes, and the smallest node of each component is its label. Minima, never neighbour lists, are shuffled; a key with very
    many rows isn't. Null ends and loops make no edge; repeated and turned edges count once; no edges give no rows.
    """
    sound = pairs.where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))).select(F.col(src).alias("s"), F.col(dst).alias("d"))
    for seed in range(20):
        code = lambda c, seed=seed: F.xxhash64(F.lit(seed), c)
        ends = sound.select(F.explode(F.array("s", "d")).alias("node")).select("node", code("node").alias("id"))
        held = Stage(ends.distinct(), "nodes")
        nodes = held.frame
        if not nodes.groupBy("id").count().where("count > 1").limit(1).count():
            break
        held.drop()
    else:
        raise RuntimeError("nodes of equal hashes under every seed")
    edges = Stage(sound.select(F.least(code("s"), code("d")).alias("a"), F.greatest(code("s"), code("d")).alias("b")).distinct(), "edges")
    rounds: list[tuple[Stage, int]] = []
    left = edges.frame.count()
    while left:
        if len(rounds) == max_rounds:
            raise RuntimeError(f"{left} edges are left after {max_rounds} rounds")
        e = edges.frame
        least = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("id"), F.least("a", "m").alias("m"))
        up = _look_up(least, "m", least, "m", 2 * left, "parent").select("id", "parent")
        parents = Stage(up, "parents")
        number = parents.frame.count()
        moved = _look_up(_look_up(e, "a", parents.frame, "parent", left, "p"), "b", parents.frame, "parent", left, "q")
        after = Stage(moved.where("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
        edges.drop()
        edges, left = after, after.frame.count()
        rounds.append((parents, number))
    if not rounds:
        return nodes.select("node", F.col("node").alias("label"), F.lit(1).cast("long").alias("size"))
    up, count = rounds[-1][0].frame, rounds[-1][1]
    for parents, number in reversed(rounds[:-1]):
        up = _look_up(parents.frame, "parent", up, "parent", number, "next").select("id", F.coalesce("next", "parent").alias("parent"))
        count = number
    placed = Stage(nodes.select("id", "node").join(up, "id").select("node", F.col("parent").alias("root")), "placed")
    for parents, _ in rounds:
        parents.drop()
    heads = placed.frame.groupBy("root").agg(F.min("node").alias("label"), F.count("*").alias("size")).select(F.col("root").alias("id"), F.struct("label", "size").alias("head"))
    return _look_up(placed.frame, "root", heads, "head", count, "head").select("node", "head.label", "head.size")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v).

    Large: each node links its larger neighbours to the smallest of itself and its neighbours. Small: each node links its
    smaller neighbours and itself to the smallest of them. The minimum is an aggregate that is joined back, so a node with
    very many neighbours is never one row.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = around.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def star_components(pairs: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """node, label, as ``min_label_components``, by alternating large-star and small-star until the edges stay the same."""

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())

    edges = Stage(_edges(pairs, src, dst).select(F.col("dst").alias("u"), F.col("src").alias("v")), "stars")
    before: tuple | None = None
    for _ in range(max_rounds):
        after = Stage(_star(_star(edges.frame, True), False), "stars")
        edges.drop()
        edges, now = after, mark(after.frame)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"stars still change after {max_rounds} rounds")
    leaves = edges.frame.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return leaves.unionByName(leaves.select(F.col("label").alias("node"), "label").distinct())


#: What surrounds a token without belonging to it.
BLANKS = " \t\n\x0b\f\r\u00a0"


def clean_token(token: Column) -> Column:
    """Lower case without surrounding blanks; blank is null."""
    return F.nullif(F.lower(F.btrim(token.cast("string"), F.lit(BLANKS))), F.lit(""))


def _linked(matches: DataFrame, groups: DataFrame) -> DataFrame:
    pairs = matches.where(F.col("is_match")).select(clean_token(F.col("src_token")).alias("src"), clean_token(F.col("dst_token")).alias("dst"))
    listed = groups.select(clean_token(F.col("representative")).alias("head"), F.transform("members", clean_token).alias("members"))
    listed = listed.select(F.coalesce("head", F.array_min("members")).alias("src"), F.explode("members").alias("dst"))
    return min_label_components(pairs.unionByName(listed))


def consolidated_groups(matches: DataFrame, groups: DataFrame) -> DataFrame:
    """sample_token, group_token: every token of a group of two or more with the smallest token of its group (problem 5).

    A match row with is_match true links its two tokens; a group row links its representative with each of its members.
    Tokens are equal regardless of case and surrounding blanks and come out lower case. Null, blank and equal ends, null or
    false is_match and one-member groups link nothing; a group without representative links its members to the smallest
    of them. Repeated rows count once.
    """
    return _linked(matches, groups).select(F.col("node").alias("sample_token"), F.col("label").alias("group_token"))


def group_records(matches: DataFrame, groups: DataFrame, most: int = 1000) -> DataFrame:
    """representative, part, n_members, members of each group, the members in order; at most ``most`` members are listed per row.

    A larger group comes out as several rows numbered by ``part``, so no row grows with the group.
    """
    parts = F.ceil(F.col("size") / (most / 2)).cast("int")
    each = _linked(matches, groups).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    place = F.row_number().over(Window.partitionBy("label", "part").orderBy("node")) - 1
    # a part of which the hash made more than ``most`` is cut once more
    each = each.withColumn("part", (F.col("part") + F.floor(place / most) * F.col("parts")).cast("int"))
    rows = each.groupBy("label", "part").agg(F.first("size").alias("n_members"), F.array_sort(F.collect_list("node")).alias("members"))
    return rows.select(F.col("label").alias("representative"), "part", "n_members", "members")

"""Near-duplicate groups, outliers, cluster records, and the assembly of a curation set.

Input order is the order of tokens: tables have no order of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import dot, l2_normalize
from frameloom.operators.blocks import group_sums, kth_nearest, links_above, shelf
from frameloom.operators.graph import components
from frameloom.operators.index import Index
from frameloom.operators.order import ranked
from frameloom.session import stage


def find_near_duplicates(vectors: DataFrame, threshold: float = 0.97, index: Index | None = None) -> DataFrame:
    """representative, members, n_members, mean_similarity, mean_pairwise_similarity of each group of two or more.

    All pairs are compared, or with an ``index`` those that share one of its best cells, for collections too large for that.

    Groups are components of the graph of pairs with a cosine of at least ``threshold``; the representative is the first
    member. mean_similarity is the sum of all pairs' similarities in both directions over n², with nothing on the diagonal;
    mean_pairwise_similarity is the mean of the pairs. Both come from the sum of the group's vectors, so pairs below the
    threshold count without being listed.
    """
    vectors = shelf(vectors)
    roots = components(index.pairs_above(threshold) if index else links_above(vectors, threshold))
    parts = group_sums(roots, vectors).groupBy("root").agg(F.flatten(F.collect_list("tokens")).alias("members"), F.sum("own").alias("own"), F.collect_list("v").alias("each"))
    total = F.aggregate(F.slice("each", 2, F.size("each")), F.element_at("each", 1), lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    sums = parts.select("root", F.array_sort("members").alias("members"), "own", total.alias("v"))
    out = sums.select("root", "members", "own", F.size("members").alias("n"), dot(F.col("v"), F.col("v")).alias("whole"))
    off = F.col("whole") - F.col("own")
    return out.select(
        F.col("root").alias("representative"), "members", F.col("n").alias("n_members"),
        (off / (F.col("n") * F.col("n"))).alias("mean_similarity"), (off / (F.col("n") * (F.col("n") - 1))).alias("mean_pairwise_similarity"),
    )


def duplicate_members(vectors: DataFrame, threshold: float = 0.97) -> DataFrame:
    """representative, members of ``find_near_duplicates`` without their similarities, so no vectors are summed or sent."""
    roots = components(links_above(vectors, threshold))
    return roots.groupBy(F.col("root").alias("representative")).agg(F.array_sort(F.collect_list("token")).alias("members"))


def droppable(groups: DataFrame) -> DataFrame:
    """sample_token of each group member that is not the representative."""
    each = groups.select("representative", F.explode("members").alias("sample_token"))
    return each.where("sample_token is not null and sample_token <> representative").select("sample_token").distinct()


def knn_distance(vectors: DataFrame, k: int = 10, index: Index | None = None) -> DataFrame:
    """sample_token, knn_distance: the cosine distance of each row's k-th nearest other row; no rows if there are k or fewer.

    With an ``index`` the neighbours are those that it finds; a row for which it finds fewer than k counts with its farthest.
    """
    if index:
        found = index.search(vectors, k + 1).where("query <> token").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "token"))).where(F.col("rank") <= k)
        return found.groupBy(F.col("query").alias("sample_token")).agg((1 - F.min("sim")).alias("knn_distance"))
    return kth_nearest(vectors, k).select(F.col("token").alias("sample_token"), (1 - F.col("sim")).alias("knn_distance"))


def find_outliers(vectors: DataFrame, k: int = 10, top_pct: float = 0.05, index: Index | None = None) -> DataFrame:
    """sample_token, knn_distance, rank (from 0) of the share of rows with the largest distance, at least one; ties by token."""
    n_top = max(1, int(vectors.count() * top_pct))
    far = stage(knn_distance(vectors, k, index).withColumn("knn_distance", F.round("knn_distance", 6)), "far")  # the sort by ranges reads it twice
    return ranked(far, [F.desc("knn_distance"), F.asc("sample_token")]).where(F.col("rank") < n_top)


def centroids(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """cluster_id, v: the normalised mean vector of each cluster's members (sample_token, cluster_id)."""
    each = members.join(vectors, members["sample_token"] == vectors["token"]).select("cluster_id", F.posexplode("v").alias("pos", "x"))
    mean = each.groupBy("cluster_id", "pos").agg(F.avg("x").alias("x")).groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("p"))
    return mean.select("cluster_id", l2_normalize(F.transform("p", lambda e: e.x)).alias("v"))


def label_clusters(centres: DataFrame, prompts: DataFrame) -> DataFrame:
    """cluster_id, prompt_id, label, score: the prompt (prompt_id, prompt, v) nearest to each centre, the first of equals. More than 10,000 prompts are refused."""
    listed = prompts.select("prompt_id", "prompt", "v")
    if listed.limit(10_001).count() > 10_000:
        raise ValueError("more than 10,000 prompts")
    all_prompts = listed.agg(F.collect_list(F.struct("prompt_id", "prompt", "v")).alias("all"))  # a bounded list in one row
    scored = centres.join(F.broadcast(all_prompts)).select("cluster_id", F.explode(F.transform("all", lambda p: F.struct(F.round(dot(F.col("v"), p.v), 10).alias("score"), (-p.prompt_id).alias("order"), p.prompt.alias("prompt")))).alias("s"))
    best = scored.groupBy("cluster_id").agg(F.max("s").alias("s"))
    return best.select("cluster_id", (-F.col("s.order")).alias("prompt_id"), F.col("s.prompt").alias("label"), F.col("s.score").alias("score"))


def cluster_records(members: DataFrame, xy: DataFrame, labels: DataFrame, sample: int = 25) -> DataFrame:
    """Cluster records: size, ordered members, 2-D centre, and the first ``sample`` members' points. Noise (negative ids) is left out.

    A record holds its members, as the format wants it; work on members goes by the table of members, a row each.
    """
    rows = members.where("cluster_id >= 0").join(xy, "sample_token")
    own = F.row_number().over(Window.partitionBy("cluster_id").orderBy("sample_token"))
    shown = rows.withColumn("at", own).where(F.col("at") <= sample).groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("sample_token", "x", "y"))).alias("sample_2d"))
    out = rows.groupBy("cluster_id").agg(
        F.count("*").cast("int").alias("size"), F.array_sort(F.collect_list("sample_token")).alias("members"), F.struct(F.avg("x").alias("x"), F.avg("y").alias("y")).alias("centroid_2d"),
    ).join(shown, "cluster_id")
    named = out.join(labels.select("cluster_id", "label"), "cluster_id", "left")
    return named.withColumn("label", F.coalesce("label", F.concat(F.lit("cluster "), "cluster_id"))).select("cluster_id", "label", "size", "members", "centroid_2d", "sample_2d")


def quota(target: int, size: Column, total: Column) -> Column:
    """At least one; rounded half to even."""
    return F.greatest(F.lit(1), F.bround(F.lit(float(target)) * size / total).cast("int"))


def stratified_take(members: DataFrame, dropped: DataFrame, target: int) -> DataFrame:
    """cluster_id, cluster_rank, sample_token, member_idx: each cluster's first surviving members, up to its quota.

    Quotas follow sizes before duplicates are dropped, over clustered rows only. Clusters rank by size, then id.
    """
    sizes = members.where("cluster_id >= 0").groupBy("cluster_id").agg(F.count("*").alias("size"))
    whole = sizes.agg(F.sum("size").alias("total"))
    ranked = sizes.join(F.broadcast(whole)).withColumn("cluster_rank", F.row_number().over(Window.orderBy(F.desc("size"), "cluster_id")) - 1)
    alive = members.where("cluster_id >= 0").join(dropped, "sample_token", "left_anti")
    idx = F.row_number().over(Window.partitionBy("cluster_id").orderBy("sample_token"))
    taken = alive.withColumn("member_idx", idx).where(F.col("member_idx") <= target).join(ranked, "cluster_id")
    return taken.where(F.col("member_idx") <= quota(target, F.col("size"), F.col("total"))).select("cluster_id", "cluster_rank", "sample_token", "member_idx")


def boosted_outliers(outliers: DataFrame, dropped: DataFrame, taken: DataFrame) -> DataFrame:
    """Outliers that are neither dropped nor taken by quota, in their order."""
    left = outliers.join(dropped, "sample_token", "left_anti").join(taken.select("sample_token"), "sample_token", "left_anti")
    return left.select("sample_token", "rank")


def kept_rows(taken: DataFrame, boosted: DataFrame, target: int) -> DataFrame:
    """position (from 0), sample_token of the kept list: quota rows, then a tenth of the target of boosted outliers, cut to the target."""
    first = taken.select(F.lit(0).alias("part"), F.col("cluster_rank").alias("p"), F.col("member_idx").alias("q"), "sample_token")
    most = max(1, target // 10)
    extra = boosted.orderBy("rank").limit(most).select(F.lit(1).alias("part"), F.col("rank").alias("p"), F.lit(0).alias("q"), "sample_token")
    at = F.min(F.struct("part", "p", "q")).alias("at")
    once = first.unionByName(extra).groupBy("sample_token").agg(at).orderBy("at", "sample_token").limit(target)
    return once.select((F.row_number().over(Window.orderBy("at", "sample_token")) - 1).alias("position"), "sample_token")


def assemble(tokens: DataFrame, groups: DataFrame, outliers: DataFrame, members: DataFrame | None, target: int) -> dict[str, DataFrame]:
    """The tables of a curation set: kept, dropped_duplicates, boosted_outliers, per_cluster_kept.

    Without clusters the first surviving tokens are kept. Quotas may fill the target, so most
    boosted outliers can be cut off although all are reported; per_cluster_kept counts before the cut.
    """
    dropped = stage(droppable(groups), "dropped")
    if members is None:
        alive = tokens.join(dropped, "sample_token", "left_anti").orderBy("sample_token").limit(target)
        kept = alive.select((F.row_number().over(Window.orderBy("sample_token")) - 1).alias("position"), "sample_token")
        spark = tokens.sparkSession
        return {"kept": kept, "dropped_duplicates": dropped, "boosted_outliers": spark.createDataFrame([], "sample_token string, rank int"), "per_cluster_kept": spark.createDataFrame([], "cluster_id int, kept long")}
    taken = stage(stratified_take(members, dropped, target), "taken")
    boosted = stage(boosted_outliers(outliers, dropped, taken), "boosted")
    sizes = members.where("cluster_id >= 0").select("cluster_id").distinct()
    counts = sizes.join(taken.groupBy("cluster_id").agg(F.count("*").alias("kept")), "cluster_id", "left").select("cluster_id", F.coalesce("kept", F.lit(0)).cast("long").alias("kept"))
    return {"kept": kept_rows(taken, boosted, target), "dropped_duplicates": dropped, "boosted_outliers": boosted, "per_cluster_kept": counts}

"""Density clusters of 2-D points: hierarchical density-based clustering after Campello et al. (2013).

The tree of densities is built over all points. One task holds it: two coordinates and a few numbers a
point. Up to ``MOST_POINTS`` each point is a leaf; of more, those of one cell of a fine grid are one leaf, at their mean and with their number
as its weight, so that the task is bounded by the cells. A cell is a thousandth of the plane wide, far less than the distance below which
clusters aren't split. Up to ``DENSE_POINTS`` the spanning tree comes from whole rows of distances, above it from Borůvka rounds over a k-d
tree. Both give a minimum spanning tree, so the clusters don't depend on the way taken, but for the order of edges of equal length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DENSE_POINTS = 5_000
#: Points up to which each is a leaf of the tree, and cells of the grid along an axis beyond.
MOST_POINTS, GRID = 500_000, 1024
LEAF = 16


class _Tree:
    """A balanced k-d tree: ``order`` has the points leaf by leaf, ``low`` and ``high`` the boxes of each depth's 2^depth nodes."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
        self.order, self.starts = np.arange(n), np.array([0, n])
        for _ in range(self.depth):
            cuts = [0]
            for lo, hi in zip(self.starts[:-1], self.starts[1:]):
                part = self.order[lo:hi]
                x = points[part]
                mid = len(part) // 2
                self.order[lo:hi] = part[np.argpartition(x[:, np.ptp(x, axis=0).argmax()], mid)]
                cuts += [lo + mid, hi]
            self.starts = np.array(cuts)
        self.points = points[self.order]
        self.width = int(np.diff(self.starts).max())
        self.low, self.high = [np.minimum.reduceat(self.points, self.starts[:-1])], [np.maximum.reduceat(self.points, self.starts[:-1])]
        for _ in range(self.depth):
            self.low.insert(0, np.minimum(self.low[0][::2], self.low[0][1::2]))
            self.high.insert(0, np.maximum(self.high[0][::2], self.high[0][1::2]))

    def within(self, asked: np.ndarray, reach: np.ndarray, own: np.ndarray | None = None, pure: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """i, j, distance: the points j no farther than ``reach`` from each asked i; with ``own``, only those of another component.

        Points are told by their place in ``order``; ``pure`` has the component of each node, -1 where it has several.
        """
        q, node = np.arange(len(asked)), np.zeros(len(asked), np.int64)
        for d in range(self.depth):
            q, node = np.repeat(q, 2), np.stack((2 * node, 2 * node + 1), 1).reshape(-1)
            x = self.points[asked[q]]
            off = np.maximum(np.maximum(self.low[d + 1][node] - x, x - self.high[d + 1][node]), 0)
            keep = np.sqrt((off**2).sum(1)) <= reach[q]
            if own is not None:
                keep &= pure[d + 1][node] != own[asked[q]]
            q, node = q[keep], node[keep]
        at = self.starts[node][:, None] + np.arange(self.width)
        inside = at < self.starts[node + 1][:, None]
        i, j = np.repeat(q, self.width)[inside.reshape(-1)], at[inside]
        if own is not None:
            keep = own[asked[i]] != own[j]
            i, j = i[keep], j[keep]
        distance = np.sqrt(((self.points[asked[i]] - self.points[j]) ** 2).sum(1))
        keep = distance <= reach[i]
        return asked[i[keep]], j[keep], distance[keep]

    def nodes_of(self, own: np.ndarray) -> list[np.ndarray]:
        """The component of each depth's nodes, -1 where a node has several."""
        low, high = np.minimum.reduceat(own, self.starts[:-1]), np.maximum.reduceat(own, self.starts[:-1])
        out = [np.where(low == high, low, -1)]
        for _ in range(self.depth):
            left, right = out[0][::2], out[0][1::2]
            out.insert(0, np.where(left == right, left, -1))
        return out

    def core(self, min_samples: int, step: int = 8192) -> np.ndarray:
        """Distance of each point to its ``min_samples``-th other one. The points next in order bound it."""
        n = len(self.points)
        k = min(min_samples, n - 1)
        out = np.zeros(n)
        for lo in range(0, n, step):
            asked = np.arange(lo, min(lo + step, n))
            first = np.clip(asked - k // 2 - 1, 0, n - 1 - k)[:, None] + np.arange(k + 1)
            reach = np.sqrt(((self.points[first] - self.points[asked][:, None]) ** 2).sum(2)).max(1)
            i, _, d = self.within(asked, reach)
            by = np.lexsort((d, i))
            out[asked] = d[by][np.searchsorted(i[by], asked) + k]
        return out


def _boruvka(points: np.ndarray, min_samples: int, step: int = 8192) -> np.ndarray:
    """The edges of ``spanning_tree``: each round every component but the largest finds its shortest edge to another."""
    tree, n = _Tree(points), len(points)
    # with one neighbour asked for, no distance is below the core distances of its ends
    core = tree.core(min_samples) if min_samples > 1 else np.zeros(n)
    own, edges = np.arange(n), []
    leaf = np.minimum(tree.starts[:-1, None] + np.arange(tree.width), tree.starts[1:, None] - 1)
    while (own != own[0]).any():
        largest = np.bincount(own).argmax()
        best, ends = np.full(n, np.inf), np.zeros((n, 2), np.int64)

        def offer(i: np.ndarray, j: np.ndarray, d: np.ndarray) -> None:
            d = np.maximum(d, np.maximum(core[i], core[j]))
            by = np.lexsort((d, own[i]))
            by = by[np.r_[True, own[i][by][1:] != own[i][by][:-1]]] if len(by) else by
            by = by[d[by] < best[own[i[by]]]]
            best[own[i[by]]], ends[own[i[by]]] = d[by], np.stack((i[by], j[by]), 1)

        # first bounds: points of the same leaf, and the last of one leaf with the first of the next
        a = np.concatenate([leaf.reshape(-1)] * (tree.width - 1) + [np.arange(n - 1), np.arange(1, n)])
        b = np.concatenate([np.roll(leaf, -s, 1).reshape(-1) for s in range(1, tree.width)] + [np.arange(1, n), np.arange(n - 1)])
        apart = own[a] != own[b]
        a, b = a[apart], b[apart]
        offer(a, b, np.sqrt(((tree.points[a] - tree.points[b]) ** 2).sum(1)))
        pure, rest = tree.nodes_of(own), np.flatnonzero(own != largest)
        for lo in range(0, len(rest), step):
            asked = rest[lo : lo + step]
            asked = asked[core[asked] <= best[own[asked]]]
            offer(*tree.within(asked, best[own[asked]], own, pure))
        parent = np.arange(n)

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for c in np.argsort(best, kind="stable")[: np.isfinite(best).sum()]:
            if c == largest:  # its bound isn't its shortest edge
                continue
            i, j = ends[c]
            x, y = find(own[i]), find(own[j])
            if x != y:
                parent[x] = y
                edges.append((tree.order[i], tree.order[j], best[c]))
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        own = parent[own]
    return np.array(edges)


def spanning_tree(points: np.ndarray, min_samples: int = 1, dense_points: int = DENSE_POINTS) -> np.ndarray:
    """Edges (i, j, mutual reachability distance) of a minimum spanning tree, shortest first; rows of the distance matrix are made one at a time."""
    n = len(points)
    if n > max(dense_points, min_samples + 1):
        edges = _boruvka(points, min_samples)
        return edges[np.argsort(edges[:, 2], kind="stable")]
    core = np.zeros(n)
    for lo in range(0, n, 512):
        d = np.sqrt(((points[lo : lo + 512, None] - points[None]) ** 2).sum(2))
        core[lo : lo + 512] = np.partition(d, min(min_samples, n - 1), axis=1)[:, min(min_samples, n - 1)]
    inside, best, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    at, edges = 0, []
    for _ in range(n - 1):
        inside[at] = True
        d = np.maximum(np.sqrt(((points - points[at]) ** 2).sum(1)), np.maximum(core, core[at]))
        closer = ~inside & (d < best)
        best[closer], link[closer] = d[closer], at
        at = int(np.where(inside, np.inf, best).argmin())
        edges.append((link[at], at, best[at]))
    return np.array(sorted(edges, key=lambda e: e[2])) if edges else np.zeros((0, 3))


def density_labels(points: np.ndarray, min_cluster_size: int = 5, min_samples: int = 1, epsilon: float = 0.3, dense_points: int = DENSE_POINTS, weights: np.ndarray | None = None) -> np.ndarray:
    """Cluster of each point, -1 for noise: the clusters of the condensed tree with the greatest stability, none split below ``epsilon``.

    A point of a weight counts as so many.
    """
    n = len(points)
    if n < 2 or (n if weights is None else weights.sum()) < min_cluster_size:
        return np.full(n, -1)
    # single-linkage tree: node n + e joins two nodes at the length of edge e
    parent, size, left, right, length = list(range(2 * n - 1)), ([1] * n if weights is None else weights.tolist()) + [0] * (n - 1), {}, {}, {}

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for e, (i, j, d) in enumerate(spanning_tree(points, min_samples, dense_points).tolist()):
        a, b, new = find(int(i)), find(int(j)), n + e
        left[new], right[new], length[new], size[new] = a, b, d, size[a] + size[b]
        parent[a] = parent[b] = new
    root = 2 * n - 2

    def points_under(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            x = todo.pop()
            todo += (left[x], right[x]) if x >= n else ()
            if x < n:
                out.append(x)
        return out

    # condensed tree: a cluster lives on while only small branches fall off, and ends in two large ones or none
    born, stability, children, content, order = {root: 0.0}, {root: 0.0}, {}, {root: root}, [root]
    for cluster in order:
        node, start = content[cluster], born[cluster]
        while node >= n:
            density = 1 / max(length[node], 1e-12)
            a, b = left[node], right[node]
            big = [x for x in (a, b) if size[x] >= min_cluster_size]
            if len(big) == 2:
                stability[cluster] += (density - start) * size[node]
                children[cluster] = big
                for x in big:
                    born[x], stability[x], content[x] = density, 0.0, x
                    order.append(x)
                break
            stability[cluster] += (density - start) * sum(size[x] for x in (a, b) if x not in big)
            if not big:
                break
            node = big[0]
    chosen: dict[int, bool] = {}
    value = dict(stability)
    for cluster in reversed(order):
        kids = children.get(cluster, [])
        below = sum(value[k] for k in kids)
        chosen[cluster] = not kids or (value[cluster] >= below and cluster != root)
        if kids and not chosen[cluster]:
            value[cluster] = below
    picked, todo = [], [root]
    while todo:
        c = todo.pop()
        if chosen[c] and c != root:
            picked.append(c)
        else:
            todo += children.get(c, [])
    # a cluster born at a distance under epsilon is replaced by its first ancestor born above it
    above = {k: c for c, kids in children.items() for k in kids}
    first = {root: root}
    for c in order[1:]:
        first[c] = first[above[c]] if 1 / born[c] < epsilon and above[c] != root else c
    final = {first[c] for c in picked}
    labels = np.full(n, -1)
    for number, c in enumerate(sorted(final, key=lambda c: min(points_under(c)))):
        labels[points_under(c)] = number
    return labels


def density_clusters(points: DataFrame, min_cluster_size: int = 5, min_samples: int = 1, epsilon: float = 0.3, sample_points: int = DENSE_POINTS) -> DataFrame:
    """sample_token, cluster_id (-1 for noise) of points (sample_token, x, y); null, NaN and infinite coordinates are noise.

    ``sample_points`` is the number of leaves up to which the spanning tree is made from whole rows of distances; no point
    is left out above it.
    """
    sound = F.coalesce((F.abs("x") < F.lit(float("inf"))) & (F.abs("y") < F.lit(float("inf"))), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            xy = np.column_stack([t[c].to_numpy().astype(float) for c in ("x", "y")])
            labels = density_labels(xy, min_cluster_size, min_samples, epsilon, sample_points)
            yield from pa.table([t["sample_token"], pa.array(labels.astype(np.int32))], ["sample_token", "cluster_id"]).combine_chunks().to_batches(max_chunksize=10_000)

    rows = points.select("sample_token", "x", "y")
    noise = rows.where(~sound).select("sample_token", F.lit(-1).alias("cluster_id"))
    rows = rows.where(sound)
    box = rows.agg(F.count("*").alias("n"), *(f(c).alias(f"{name}_{c}") for c in ("x", "y") for name, f in (("low", F.min), ("high", F.max)))).first()
    if box.n > MOST_POINTS:
        place = lambda c: F.least(F.lit(GRID - 1), F.floor((F.col(c) - box[f"low_{c}"]) / max(box[f"high_{c}"] - box[f"low_{c}"], 1e-12) * GRID)).cast("int")
        rows = rows.withColumn("cell", place("x") * GRID + place("y"))
        leaves = rows.groupBy("cell").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n"), F.min("sample_token").alias("sample_token"))

        def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                t = pa.Table.from_batches(held)
                xy = np.column_stack([t[c].to_numpy() for c in ("x", "y")])
                labels = density_labels(xy, min_cluster_size, min_samples, epsilon, sample_points, t["n"].to_numpy())
                yield from pa.table([t["cell"], pa.array(labels.astype(np.int32))], ["cell", "cluster_id"]).combine_chunks().to_batches(max_chunksize=10_000)

        found = leaves.repartition(1).sortWithinPartitions("sample_token").mapInArrow(weighed, "cell int, cluster_id int")  # at most GRID² leaves
        return rows.join(found, "cell").select("sample_token", "cluster_id").unionByName(noise)
    return rows.repartition(1).sortWithinPartitions("sample_token").mapInArrow(run, "sample_token string, cluster_id int").unionByName(noise)


def failure_modes(points: DataFrame, vectors: DataFrame, min_cluster_size: int = 5, n_init: int = 10, seed: int = 42) -> DataFrame:
    """Density clusters of the points; where they are weak (too few points or fewer than two clusters), k-means of the vectors."""
    from frameloom.operators.project import kmeans_clusters
    from frameloom.session import stage

    dense = stage(density_clusters(points, min_cluster_size), "density")
    seen = dense.where("cluster_id >= 0").agg(F.count("*").alias("n"), F.countDistinct("cluster_id").alias("c")).first()
    if seen.n < min_cluster_size or seen.c < 2:
        return kmeans_clusters(vectors, n_init=n_init, seed=seed, min_cluster_size=min_cluster_size)
    return dense

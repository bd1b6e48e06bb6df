"""Operator 11: centroid clustering with a vantage-point tree over the centroids.

Vectors become integers, ``floor(SCALE * x)``, so that distances, sums and ties are exact.  Each
round builds a vantage-point tree over the current centroids and broadcasts it.  Every vector searches it best-first:
of its open nodes the one with the least lower bound comes next, the vantage point or the leaf's centroids are
compared by exact squared distance, and a vector is done when its least bound *exceeds* the distance of its best
centroid.  The pruning radius is inclusive, so a centroid at the same distance is still met, and the smaller
number wins.  A batch of vectors advances together, each along its own order of nodes.

Rounds.  A task adds up its vectors by cluster and component; Spark adds the tasks' sums (``k`` x dimensions rows come
back, whatever the number of vectors) and the driver divides, rounding down.  Empty clusters keep their centroid.

Scale.  One map over the vectors and a combined aggregation each round; a cluster that holds a third of the vectors is
a row for each task and component.  The tree is refused beyond ``TREE_BYTES``.  The integer vectors and the
last assignment are written to the shared folder, so a lost executor repeats tasks, not rounds.

Defined cases.  Null vectors, vectors of another length and vectors with null or non-finite components are left out,
and so are those whose integers would pass 62 bits.  Repeated rows and ids count once each row; a null id is an id
like any other (its hash is that of ``1:``).  Vectors of equal hash start in order of their
components.  With fewer vectors than ``k`` there are as many clusters as vectors.  Distances and sums beyond 63 bits
are given as the largest long.  Empty tables give empty results.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, written

SCALE, DIMENSIONS, CLUSTERS, ROUNDS = 64, 64, 16, 3
LEAF = 4
TREE_BYTES = 128 << 20
_LONG = (1 << 63) - 1
#: Components up to this fit squared distances of up to 128 dimensions into 63 bits.
_PLAIN = 1 << 26


# ------------------------------------------------------------ the tree


def _squares(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows of ``v`` by rows of ``c``."""
    return ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)


def _root(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64))


class VantageTree:
    """Nodes in flat lists.  ``points[n]`` are the centroids compared at node ``n``: the
    vantage point, or all of a leaf.  ``children[n]`` are ``(node, least, most)``: a child
    and the range of distances from the vantage point to the centroids below it."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.points: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        if len(centroids):
            self._grow(np.arange(len(centroids)))

    def _grow(self, members: np.ndarray) -> int:
        me = len(self.points)
        self.points.append(members)
        self.children.append([])
        if len(members) <= LEAF:
            return me
        # the member farthest from the first one: a corner separates well
        c = self.centroids[members]
        at = int(np.argmax(_squares(c, c[:1])[:, 0]))
        rest = np.delete(members, at)
        far = _root(_squares(self.centroids[rest], c[at : at + 1])[:, 0])
        order = np.argsort(far, kind="stable")
        self.points[me] = members[at : at + 1]
        for half in (order[: len(order) // 2], order[len(order) // 2 :]):
            self.children[me].append((self._grow(rest[half]), float(far[half].min()), float(far[half].max())))
        return me

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(cluster, squared distance)`` of each row of ``v``."""
        n = len(v)
        best = np.full(n, -1, dtype=v.dtype)  # -1: none yet
        who = np.full(n, -1, dtype=np.int64)
        bound = np.full((n, len(self.points)), np.inf)
        bound[:, 0] = 0.0
        alive = np.arange(n)
        while alive.size:
            node = bound[alive].argmin(axis=1)
            low = bound[alive, node]
            reach = np.where(who[alive] < 0, np.inf, _root(np.maximum(best[alive], 0)))
            go = (low <= reach) & (low < np.inf)  # inclusive: equal distances must meet
            alive, node, low = alive[go], node[go], low[go]
            bound[alive, node] = np.inf
            order = np.argsort(node, kind="stable")
            kinds, first = np.unique(node[order], return_index=True)
            for k, rows in zip(kinds, np.split(order, first[1:])):
                self._visit(int(k), v, alive[rows], low[rows], best, who, bound)
        return who, best

    def _visit(self, k, v, rows, low, best, who, bound):
        d2 = _squares(v[rows], self.centroids[self.points[k]])
        for j, p in enumerate(self.points[k]):
            x, b, w = d2[:, j], best[rows], who[rows]
            better = (w < 0) | (x < b) | ((x == b) & (p < w))
            best[rows[better]] = x[better]
            who[rows[better]] = p
        if self.children[k]:
            d = _root(d2[:, 0])
            for child, least, most in self.children[k]:
                slack = 1e-9 * (d + most + 1.0)  # roots are rounded; bounds must not exceed the truth
                bound[rows, child] = np.maximum(low, np.maximum(least - d, d - most) - slack)


def _rows(batch: pa.RecordBatch, dim: int, plain: bool) -> np.ndarray:
    v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return v.astype(np.int64) if plain and (v.size == 0 or np.abs(v).max() <= _PLAIN) else v.astype(object)


def _search(tree, plain, dim, batches):
    """``(batch, vectors, clusters, squared distances)`` for slices of bounded memory."""
    nodes = max(1, len(tree.value.points))
    step = max(1, min(8192, (1 << 22) // max(nodes, dim * LEAF)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            v = _rows(part, dim, plain)
            yield part, v, *tree.value.nearest(v)


# ------------------------------------------------------------ Spark


def integer_vectors(vectors: DataFrame, dim: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, v``: the kept vectors as integers."""
    x = F.col(f"`{vec_col}`")
    fits = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float((1 << 62) // scale)))
    d = vectors.where(x.isNotNull() & (F.size(x) == dim) & fits)
    return d.select(F.col(f"`{id_col}`").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the least hash of ``seed:id`` (bounded: ``k`` rows)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=object)


def _tree(spark: SparkSession, centroids: np.ndarray):
    """The broadcast tree over the centroids, and whether plain integers suffice."""
    if centroids.size * 8 > TREE_BYTES:
        raise ValueError(f"{len(centroids)} centroids of {centroids.shape[1]} components exceed {TREE_BYTES} bytes")
    plain = bool(np.abs(centroids).max() <= _PLAIN)
    return spark.sparkContext.broadcast(VantageTree(centroids.astype(np.int64) if plain else centroids)), plain


def next_centroids(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign, add up, divide rounding down."""
    spark, dim = kept.sparkSession, centroids.shape[1]
    tree, plain = _tree(spark, centroids)

    def sums(batches):
        total, count = {}, {}
        for _, v, who, _ in _search(tree, plain, dim, batches):
            order = np.argsort(who, kind="stable")
            names, first = np.unique(who[order], return_index=True)
            for c, rows in zip(names.tolist(), np.split(order, first[1:])):
                s = v[rows].sum(axis=0).astype(object)  # Python's integers across slices
                total[c] = total[c] + s if c in total else s
                count[c] = count.get(c, 0) + len(rows)
        for c, s in total.items():
            values = pa.array([Decimal(int(x)) for x in s], pa.decimal128(38, 0))
            cols = [pa.array([c] * dim, pa.int32()), pa.array(range(dim), pa.int32()), values, pa.array([count[c]] * dim, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["c", "i", "s", "n"])

    part = kept.select("v").mapInArrow(sums, "c int, i int, s decimal(38,0), n long")
    out = centroids.copy()
    for r in part.groupBy("c", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():  # k x dim rows
        out[r.c, r.i] = int(r.s) // r.n
    tree.destroy()
    return out


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of every vector, written to the shared folder."""
    spark, dim = kept.sparkSession, centroids.shape[1]
    tree, plain = _tree(spark, centroids)
    id_type = kept.schema["id"].dataType

    def each(batches):
        for part, _, who, best in _search(tree, plain, dim, batches):
            d = pa.array([min(int(x), _LONG) for x in best], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(who.astype(np.int32)), d], ["id", "cluster", "distance"])

    out = written(kept.mapInArrow(each, f"id {id_type.simpleString()}, cluster int, distance long"), "vp-assigned")
    tree.destroy()
    return out


def cluster_vectors(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dim: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = 1,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``(assignment, centroids)``: ``id, cluster, distance`` rows and the last centroids as integers."""
    ship_package(vectors.sparkSession)
    kept = written(integer_vectors(vectors, dim, scale, id_col, vec_col), "vp-vectors")
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = next_centroids(kept, centroids)
    return assign(kept, centroids), centroids


def op11_centroid_clusters(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The contract's row for each kept vector."""
    rows, centroids = cluster_vectors(vectors)
    by = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # at most k rows
    of = {r.cluster: int(r.s) for r in by}
    stats = [(c, min(s, _LONG), min(sum(of.values()), _LONG), hashlib.sha256(",".join(str(int(x)) for x in centroids[c]).encode()).hexdigest()) for c, s in of.items()]
    stats = spark.createDataFrame(stats, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(stats), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

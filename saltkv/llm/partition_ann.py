"""Operator 12: approximate nearest neighbours by learned partitions.

1. *Graph.*  A bounded sample of the vectors (``sample_size``) is linked to its ``DEGREE`` nearest sample members by
   inner product.  The graph is cut into ``parts`` parts of equal size with few edges between them: recursive bisection by
   the second eigenvector of each part (power iteration), mended by swaps that gain.
2. *Classifier.*  A network with one hidden layer learns, from a vector's direction, the distribution of its
   neighbours over the parts.
3. *Index.*  Every vector of the table goes to its most probable part.
4. *Search.*  A query is routed to its ``probes`` most probable parts and compared with all their
   vectors; candidates are ranked by the inner product in double precision on the original vectors.

Recall is measured in each run: ``CHECK_QUERIES`` queries are answered by brute force over all vectors, and ``probes`` is the least
number of parts that holds ``RECALL`` of their true neighbours.  The documented bounds are on what is fitted
(sample, parts, check queries); every vector is indexed and every query is answered.

Scale.  Parts grow in number with the root of the table's rows, up to ``MOST_PARTS``.  A part larger than a block is split over
tasks (a row's block is the hash of its id), and so are the queries of a part, so a task holds one block of
vectors and one of queries at most; each sends on its best ``n`` of each query, and Spark's group limit keeps ``n``
before the last shuffle.  Of copies of one vector only the ``n + 1`` smallest ids can be among the first ``n`` of any query, so a
group of copies that holds a third of all rows leaves ``n + 1`` candidates.  That is exact, as ties go
to the smaller id.  Sample, graph, network and check queries are bounded and are the only things broadcast or collected.

Defined cases.  Vectors that are null, empty, zero or hold null or non-finite components take no part, and neither do rows with
a null id.  Equal rows count once; rows that share an id are all the query's own.  Vectors meet
only vectors of their own length (an index for each).  Ties of the measure go to the smaller id.  With fewer than
``n`` candidates all are returned.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship_package, written

NEAREST = 20
MOST_PARTS, PER_PART = 1024, 200
MOST_SAMPLE, SAMPLE_BYTES = 65_536, 64 << 20
DEGREE, HIDDEN, EPOCHS = 10, 128, 30
CHECK_QUERIES, RECALL = 400, 0.95
BLOCK_BYTES = 16 << 20
RESULT = "query_id long, vec_id long, score double"


def n_parts(n: int) -> int:
    """Parts for ``n`` vectors: the power of two nearest to a quarter of the root of ``n``."""
    if n < 64:
        return 1
    return int(min(MOST_PARTS, max(4, 2 ** round(np.log2(np.sqrt(n) / 4)))))


def sample_size(n: int, dim: int) -> int:
    return int(min(n, max(2000, PER_PART * n_parts(n)), MOST_SAMPLE, max(1, SAMPLE_BYTES // (8 * dim))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow column of lists of ``dim`` doubles as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def directions(v: np.ndarray) -> np.ndarray:
    """Unit vectors, safe for components of any size, scaled to components of about one."""
    u = v / np.abs(v).max(axis=1)[:, None]
    return u / np.sqrt((u * u).sum(axis=1))[:, None] * np.sqrt(v.shape[1])


# ------------------------------------------------------------ exact ranking


def best_of(q_ids, q, ids, v, n: int, step: int = 8192):
    """``(query row, id, score, row of v)``: for each query its ``n`` best of the rows of
    ``v`` with another id, ties to the smaller id.  A matrix product proposes, with room for its
    rounding; scores are sums in a fixed order, so that equal vectors score equally."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
    kept = none
    with np.errstate(all="ignore"):
        for at in range(0, len(ids), step):
            part, names = v[at : at + step], ids[at : at + step]
            s = np.nan_to_num(q @ part.T, nan=-np.inf)
            own = np.isin(names, q_ids)
            if own.any():
                s[:, own] = np.where(q_ids[:, None] == names[own][None, :], np.nan, s[:, own])
            least = np.full(len(q), -np.inf)
            if s.shape[1] > n:
                least = np.partition(np.nan_to_num(s, nan=-np.inf), -n, axis=1)[:, -n]
                least = least - 1e-12 * (np.abs(least) + np.sqrt((q * q).sum(axis=1)) * np.sqrt((part * part).sum(axis=1)).max())
                least = np.nan_to_num(least, nan=-np.inf)
            i, j = np.nonzero(s >= least[:, None])
            score = np.nan_to_num((q[i] * part[j]).sum(axis=1), nan=-np.inf)
            kept = tuple(np.concatenate(x) for x in zip(kept, (i, names[j], score, j + at)))
            order = np.lexsort((kept[1], -kept[2], kept[0]))
            kept = tuple(x[order] for x in kept)
            starts = np.searchsorted(kept[0], np.arange(len(q)))
            first = np.arange(len(order)) - starts[kept[0]] < n
            kept = tuple(x[first] for x in kept)
    return kept


# ------------------------------------------------------------ balanced parts of a graph


def balanced_parts(links: np.ndarray, parts: int, rng) -> np.ndarray:
    """A part for each vertex; sizes differ by at most the number of bisections.  ``links[i]`` are neighbours of
    ``i`` (-1: none).  All parts of a level are bisected together."""
    n = len(links)
    a, b = np.repeat(np.arange(n), links.shape[1]), links.ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate((a, b)), np.concatenate((b, a))  # both directions
    label = np.zeros(n, np.int64)
    while label.max(initial=0) + 1 < parts:
        inner = label[a] == label[b]
        a, b = a[inner], b[inner]
        side = _bisect(a, b, label, rng)
        side = _swap(a, b, label, side, rng)
        label = 2 * label + side
    return label


def _rank(label: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Position of each element inside its label, by descending value."""
    order = np.lexsort((-value, label))
    first = np.searchsorted(label[order], label[order])
    out = np.empty(len(label), np.int64)
    out[order] = np.arange(len(label)) - first
    return out


def _bisect(a, b, label, rng) -> np.ndarray:
    n, k = len(label), label.max() + 1
    size = np.bincount(label, minlength=k)
    degree = np.bincount(a, minlength=n) + 1e-9
    x = rng.normal(size=n)
    for _ in range(40):  # power iteration on the lazy walk, without each part's constant vector
        x = 0.5 * x + 0.5 * np.bincount(a, x[b], minlength=n) / degree
        x -= (np.bincount(label, x, minlength=k) / size)[label]
        x /= np.sqrt(np.bincount(label, x * x, minlength=k) / size + 1e-300)[label]
    return (_rank(label, x) >= ((size + 1) // 2)[label]).astype(np.int64)


def _swap(a, b, label, side, rng, passes: int = 12) -> np.ndarray:
    """Swap pairs across each part's halves while fewer edges are cut."""
    n = len(label)

    def cut(s):
        return int((s[a] != s[b]).sum())

    best = cut(side)
    for _ in range(passes):
        across = np.bincount(a, side[a] != side[b], minlength=n)
        gain = 2 * across - np.bincount(a, minlength=n)
        gain = np.where(rng.random(n) < 0.5, gain, -(10**9))  # neighbours seldom move at once
        half = 2 * label + side
        rank = _rank(half, gain.astype(float))
        order = np.lexsort((rank, half))
        key = half[order] * (n + 1) + rank[order]
        partner = np.searchsorted(key, (half ^ 1) * (n + 1) + rank)
        ok = partner < n
        ok[ok] &= key[partner[ok]] == ((half ^ 1) * (n + 1) + rank)[ok]
        mate = np.zeros(n, np.int64)
        mate[ok] = order[partner[ok]]
        move = ok & (gain + np.where(ok, gain[mate], 0) > 0)
        trial = np.where(move, 1 - side, side)
        now = cut(trial)
        if now < best:
            side, best = trial, now
    return side


# ------------------------------------------------------------ the classifier


class Router:
    """One hidden layer: direction of a vector -> scores of the parts."""

    def __init__(self, dim: int, parts: int, rng):
        self.w1, self.b1 = rng.normal(size=(dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN)
        self.w2, self.b2 = rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)

    def scores(self, u: np.ndarray) -> np.ndarray:
        return np.maximum(u @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, v: np.ndarray, first: int | None = None) -> np.ndarray:
        """Parts of each vector, most probable first."""
        order = np.argsort(-self.scores(directions(v)), axis=1, kind="stable")
        return order[:, :first] if first else order

    def fit(self, u: np.ndarray, label: np.ndarray, links: np.ndarray, rng, epochs: int = EPOCHS) -> None:
        """Cross-entropy to the parts of each vector and its neighbours (Adam)."""
        around = np.concatenate((np.arange(len(u))[:, None], links), axis=1)
        around = np.where(around < 0, around[:, :1], around)
        params = [self.w1, self.b1, self.w2, self.b2]
        moment, spread, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for epoch in range(epochs):
            rate = 0.003 * (1 - epoch / epochs) + 1e-5
            for rows in np.array_split(rng.permutation(len(u)), max(1, len(u) // 256)):
                x = u[rows]
                h = np.maximum(x @ self.w1 + self.b1, 0)
                z = h @ self.w2 + self.b2
                z = np.exp(z - z.max(axis=1)[:, None])
                z /= z.sum(axis=1)[:, None]
                np.add.at(z, (np.arange(len(rows))[:, None], label[around[rows]]), -1 / around.shape[1])
                z /= len(rows)
                back = (z @ self.w2.T) * (h > 0)
                grads = [x.T @ back, back.sum(axis=0), h.T @ z, z.sum(axis=0)]
                t += 1
                for p, g, m, s in zip(params, grads, moment, spread):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)


# ------------------------------------------------------------ Spark


def clean_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, v, dim`` of the vectors that take part, equal rows once."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    d = vectors.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda c: c != 0))
    return d.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("v")).dropDuplicates(["id", "v"]).withColumn("dim", F.size("v"))


def _candidates(rows: DataFrame, n: int) -> DataFrame:
    """Rows that can be among the first ``n`` of any query: of equal vectors the ``n + 1`` smallest ids."""
    same = Window.partitionBy("dim", F.xxhash64("v"), "v").orderBy("id")
    return rows.withColumn("__r", F.row_number().over(same)).where(F.col("__r") <= n + 1).drop("__r")


def _drawn(rows: DataFrame, n: int, total: int, salt: int) -> pa.Table:
    """``id, v`` of ``n`` rows (all, if fewer) by hash of the whole row; a few more than ``n`` leave their tasks."""
    h = F.xxhash64("id", "v", F.lit(salt))
    if total > n:
        share = n / total + 4 * np.sqrt(n) / total  # the hash gives more or less by a root
        rows = rows.where(F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40)))
    return rows.select("id", "v", h.alias("h")).toArrow().sort_by([("h", "ascending"), ("id", "ascending")]).slice(0, n)


def neighbour_graph(spark: SparkSession, sample: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """The nearest sample members of each (rows of numbers, -1: none), in tasks over slices of the sample."""
    n = len(sample)
    shared = spark.sparkContext.broadcast(sample)

    def links(batches):
        for batch in batches:
            i = batch.column("id").to_numpy()
            for at in range(0, len(i), 512):
                own = i[at : at + 512]
                q, j, _, _ = best_of(own, shared.value[own], np.arange(n), shared.value, degree)
                yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(j)], ["i", "j"])

    got = spark.range(n).repartition(min(max(1, n // 512), 200), "id").mapInArrow(links, "i long, j long").toArrow()
    shared.destroy()
    out = np.full((n, degree), -1, np.int64)
    i, j = got.column("i").to_numpy(), got.column("j").to_numpy()
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    out[i, np.arange(len(i)) - np.searchsorted(i, i)] = j
    return out


class PartitionIndex:
    """Vectors of one length, each in its most probable part (``rows``: id, v, part)."""

    def __init__(self, rows: DataFrame, dim: int, n: int, nearest: int):
        self.dim, self.nearest = dim, nearest
        spark = rows.sparkSession
        self.spark, rng = spark, np.random.default_rng(12)
        self.parts = n_parts(n)
        sample = matrix(_drawn(rows, sample_size(n, dim), n, 0).column("v"), dim)  # at most SAMPLE_BYTES
        links = neighbour_graph(spark, sample)
        label = balanced_parts(links, self.parts, rng)
        router = Router(dim, self.parts, rng)
        if self.parts > 1:
            router.fit(directions(sample), label, links, rng)
        self.router = router = spark.sparkContext.broadcast(router)

        def place(batches):
            for batch in batches:
                v = matrix(batch.column("v"), dim)
                part = router.value.ranked(v, 1)[:, 0] if len(v) else np.empty(0)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(part.astype(np.int32))], ["id", "v", "part"])

        self.rows = written(rows.select("id", "v").mapInArrow(place, "id long, v array<double>, part int"), "ann-index")

    def calibrate(self, queries: DataFrame, recall: float = RECALL, n_queries: int = CHECK_QUERIES) -> int:
        """Parts to probe, so that ``recall`` of the true neighbours of the check queries stand in them.  The
        check queries are compared with every vector."""
        got = _drawn(queries, n_queries, queries.count(), 1)
        self.recall = 1.0
        if not got.num_rows:
            return 1
        check = self.spark.sparkContext.broadcast((got.column("id").to_numpy(), matrix(got.column("v"), self.dim)))
        dim, nearest = self.dim, self.nearest

        def truth(batches):
            ids, q = check.value
            for batch in batches:
                v = matrix(batch.column("v"), dim)
                i, name, score, at = best_of(ids, q, batch.column("id").to_numpy(), v, nearest)
                cols = [pa.array(i.astype(np.int32)), pa.array(name), pa.array(score), batch.column("part").take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(cols, ["q", "id", "score", "part"])

        best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        true = self.rows.mapInArrow(truth, "q int, id long, score double, part int").withColumn("r", F.row_number().over(best))
        true = true.where(F.col("r") <= nearest).select("q", "part").collect()  # n_queries * nearest rows
        place = np.argsort(self.router.value.ranked(check.value[1]), axis=1)  # rank of each part for each query
        ranks = np.array([place[r.q, r.part] for r in true], dtype=int)
        check.destroy()
        if not len(ranks):
            return 1
        within = np.cumsum(np.bincount(ranks, minlength=self.parts)) / len(ranks)
        probes = int(np.searchsorted(within, recall)) + 1
        self.recall = float(within[probes - 1])
        return probes

    def search(self, queries: DataFrame, probes: int) -> DataFrame:
        """``query_id, vec_id, score``: for each query the best of each block it met."""
        dim, nearest, router = self.dim, self.nearest, self.router
        block = max(1, BLOCK_BYTES // (8 * dim))

        def route(batches):
            for batch in batches:
                v = matrix(batch.column("v"), dim)
                to = router.value.ranked(v, probes).astype(np.int32)
                at = pa.array(np.repeat(np.arange(len(v)), to.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), pa.array(to.ravel()), batch.column("v").take(at)], ["id", "part", "v"])

        routed = queries.select("id", "v").mapInArrow(route, "id long, part int, v array<double>")

        def blocks(df, name):
            return df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(name))

        # a row for each part: at most MOST_PARTS
        split = written(blocks(self.rows, "nv").join(blocks(routed, "nq"), "part"), "ann-blocks")

        def dealt(df, own, other, a, b):
            d = df.join(F.broadcast(split), "part").withColumn(a, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
            return d.select("part", a, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(b), "id", "v")

        key = ["part", "bv", "bq"]
        left = dealt(self.rows, "nv", "nq", "bv", "bq").groupBy(*key)
        right = dealt(routed, "nq", "nv", "bq", "bv").groupBy(*key)

        def compare(v, q):
            out = []
            ids, vs, qs = v.column("id").to_numpy(), matrix(v.column("v"), dim), matrix(q.column("v"), dim)
            q_ids = q.column("id").to_numpy()
            for at in range(0, len(q_ids) if len(ids) else 0, 512):
                i, name, score, _ = best_of(q_ids[at : at + 512], qs[at : at + 512], ids, vs, nearest)
                out.append(pa.table([pa.array(q_ids[at + i]), pa.array(name), pa.array(score)], ["query_id", "vec_id", "score"]))
            return pa.concat_tables(out) if out else pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["query_id", "vec_id", "score"])

        return left.cogroup(right).applyInArrow(compare, RESULT)


def nearest_neighbours(vectors: DataFrame, is_query, n: int = NEAREST, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id column ``id`` satisfies ``is_query``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = written(clean_vectors(vectors, id_col, vec_col), "ann-vectors")
    candidates = written(_candidates(rows, n), "ann-candidates")
    found = []
    for dim, count in sorted((r.dim, r["count"]) for r in candidates.groupBy("dim").count().collect()):
        index = PartitionIndex(candidates.where(F.col("dim") == dim), dim, count, n)
        queries = rows.where((F.col("dim") == dim) & is_query(F.col("id")))
        found.append(index.search(queries, index.calibrate(queries, recall)))
    out = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= n).select("query_id", "rank", "vec_id", "score")


def op12_learned_partitions(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The contract's rows: the 20 nearest found of each query."""
    return nearest_neighbours(vectors, lambda i: i % 20 == 0)

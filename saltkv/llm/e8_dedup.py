"""Operator 2: near-duplicate embeddings by E8 lattice hashing.

Each table projects the unit vector at random into one or more blocks of eight
dimensions, scales by ``SCALE`` and decodes each block to its nearest point of the E8 lattice: the
vector's *cell*.  A vector is stored in its own cell of every table and looks also
into the ``PROBES`` neighbouring cells nearest to its projection.  Stored and looking
vectors that meet are verified by cosine in double precision; those of 0.9 or more link.

With one block a pair at cosine 0.9 meets in one table with probability over 0.6, so four
tables find over 0.97 of such pairs and nearly all closer ones (``tests`` measure it against
brute force).  Cells hold ``N / 170`` vectors a block; ``layout`` adds a block for
every factor of 100 beyond 400,000 vectors, up to four, and as many tables as the measured chance to meet
in one (``MEET``) asks for, so that the recall holds at any size.  Beyond four blocks' worth of vectors cells grow and are
verified in more blocks.

Copies and clusters.  Bitwise equal vectors are one class with a multiplicity.  A
cell with many vectors is verified in blocks of ``BLOCK`` by ``BLOCK`` (matrix products in
separate tasks).  Pairs are never emitted: a block emits a link count for each vector,
where a pair counts at the first meeting only, and the edges of a spanning forest.

Defined cases.  Vectors that are null, empty, zero or hold null or non-finite components
link with nothing, not even their copies.  Vectors of different length never link.  Repeated vec_ids are vectors of their
own; a null vec_id is carried, counts as a link, and is least in no component.  An empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written
from .components import components

COSINE = 0.9
SCALE, PROBES, TABLES, BLOCK, SALTS = 0.5, 4, 4, 2048, 16
#: For 1 to 4 blocks, the chance that a pair at cosine 0.9 meets in one table (measured, rounded down).
MEET = (0.6, 0.36, 0.18, 0.065)


def layout(n: int) -> tuple[int, int]:
    """``(blocks, tables)`` for ``n`` vectors."""
    blocks = 1 if n <= 400_000 else 1 + math.ceil(math.log(n / 400_000, 100))
    blocks = min(blocks, len(MEET))
    return blocks, TABLES if blocks == 1 else math.ceil(math.log(0.03) / math.log(1 - MEET[blocks - 1]))


# ------------------------------------------------------------ the lattice


def _d8(y: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (integers with an even sum)."""
    f = np.rint(y)
    d = y - f
    odd = np.flatnonzero(f.sum(axis=1).astype(np.int64) & 1)
    k = np.abs(d[odd]).argmax(axis=1)
    f[odd, k] += np.where(d[odd, k] >= 0, 1.0, -1.0)
    return f


def decode(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: D8, or D8 moved by one half."""
    a, b = _d8(y), _d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or halves with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = s
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


_AROUND = neighbours()


def _cell(points: np.ndarray, table: int) -> np.ndarray:
    """64-bit name of lattice points (their doubles are integers)."""
    h = np.full(points.shape[:-1], table + 1, np.uint64)
    for i in range(points.shape[-1]):
        h = (h ^ (2 * points[..., i]).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cells(u: np.ndarray, table: int, blocks: int, probes: int = PROBES) -> np.ndarray:
    """Column 0: the own cell of each unit vector in a table; then the cells it looks into."""
    rng = np.random.default_rng([8, u.shape[1], table])
    y = u @ rng.normal(size=(u.shape[1], 8 * blocks)) * SCALE
    best = None
    for b in range(blocks):  # the nearest combinations of cells over the blocks so far
        part = y[:, 8 * b : 8 * b + 8]
        own = decode(part)
        d = ((part[:, None, :] - own[:, None, :] - _AROUND[None]) ** 2).sum(axis=2)
        near = np.argsort(d, axis=1, kind="stable")[:, :probes]
        points = np.concatenate((own[:, None, :], own[:, None, :] + _AROUND[near]), axis=1)
        dist = np.concatenate((((part - own) ** 2).sum(axis=1)[:, None], np.take_along_axis(d, near, axis=1)), axis=1)
        if best is None:
            best, total = points, dist
            continue
        m = points.shape[1]
        both = (total[:, :, None] + dist[:, None, :]).reshape(len(y), -1)
        first = np.argsort(both[:, 1:], axis=1, kind="stable")[:, : 4 * probes] + 1
        pick = np.concatenate((np.zeros((len(y), 1), np.int64), first), axis=1)  # own cells come first
        best = np.concatenate((np.take_along_axis(best, (pick // m)[:, :, None], axis=1), np.take_along_axis(points, (pick % m)[:, :, None], axis=1)), axis=2)
        total = np.take_along_axis(both, pick, axis=1)
    return _cell(best, table)


# ------------------------------------------------------------ verification


def _first_meeting(x: list[np.ndarray], y: list[np.ndarray], i: np.ndarray, j: np.ndarray, cell: int) -> np.ndarray:
    """Whether pairs ``i, j`` that meet in ``cell`` of the last table meet there
    first; ``x`` and ``y`` hold the cells of all vectors for the tables so far."""
    first = np.ones(len(i), bool)
    for t, (a, b) in enumerate(zip(x, y)):
        at_x = (b[j] == a[i, :1]).any(axis=1)  # the right one is stored in, or looks into, the cell of the left
        at_y = (a[i] == b[j, :1]).any(axis=1)
        if t < len(x) - 1:
            first &= ~(at_x | at_y)
        else:
            first &= ~(at_x & (a[i, 0] < cell)) & ~(at_y & (b[j, 0] < cell))
    return first


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(i, least of its component)`` equivalent to ``a - b`` over ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            i = np.flatnonzero(label != np.arange(n))
            return i, label[i]
        label = new


def verify_block(rows: dict[str, np.ndarray], table: int, cell: int, blocks: int):
    """``rows``: ``side`` (0 stored here, 1 stored on the right, 2 looking), ``cid``, ``m`` and unit vectors ``u``.  Returns
    link counts and edges of the classes."""
    left, right = rows["side"] == 0, rows["side"] != 0
    lid, rid, u, v = rows["cid"][left], rows["cid"][right], rows["u"][left], rows["u"][right]
    i, j = np.nonzero(u @ v.T >= COSINE)
    stored = rows["side"][right][j] == 1
    ok = np.where(stored, lid[i] < rid[j], lid[i] != rid[j])
    i, j = i[ok], j[ok]
    if len(i):
        x, y = ([cells(w, t, blocks) for t in range(table + 1)] for w in (u, v))
        some = [slice(k, k + (1 << 17)) for k in range(0, len(i), 1 << 17)]
        first = np.concatenate([_first_meeting(x, y, i[s], j[s], cell) for s in some])
        i, j = i[first], j[first]
    ids = np.concatenate((lid[i], rid[j]))
    other = np.concatenate((rows["m"][right][j], rows["m"][left][i]))
    who, at = np.unique(ids, return_inverse=True)
    count = np.bincount(at, weights=other, minlength=len(who)).astype(np.int64) if len(who) else np.zeros(0, np.int64)
    a, b = _forest(at[: len(i)], at[len(i) :], len(who)) if len(who) else (np.zeros(0, int), np.zeros(0, int))
    return who, count, who[a], who[b]


# ------------------------------------------------------------ Spark


def _unit(raw: list[bytes]) -> np.ndarray:
    v = np.stack([np.frombuffer(r, np.float64) for r in raw])
    v = v / np.abs(v).max(axis=1, keepdims=True)  # neither overflow nor underflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0)
    v = v.withColumn("ok", F.coalesce(ok, F.lit(False))).withColumn("h", F.when(F.col("ok"), F.xxhash64("v")))

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            raw = [np.asarray(x, np.float64).tobytes() for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raw, pa.binary())], ["cid", "least", "m", "vec"])

    # a class is named by the 64-bit hash of its vector: two differ in a shared name once in 2**64 pairs
    groups = v.where("ok").groupBy("h", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("m"))
    groups = groups.select(F.col("h").alias("cid"), "least", "m", "v")
    classes = written(groups.mapInArrow(pack, "cid long, least long, m long, vec binary"), "vector-classes")
    blocks, tables = layout(classes.count())

    def enter(batches):
        import pyarrow as pa

        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                cid, raw = part.column(0).to_numpy(), part.column(1).to_pylist()
                size = np.array([len(r) for r in raw])
                for d in np.unique(size):
                    at = np.flatnonzero(size == d)
                    u = _unit([raw[i] for i in at])
                    for t in range(tables):
                        c = cells(u, t, blocks)
                        k = c.shape[1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(c.size, t, np.int32)), pa.array(np.full(c.size, d, np.int32)), pa.array(c.ravel()),
                             pa.array(np.repeat(cid[at], k)), pa.array(np.tile(np.arange(k) > 0, len(at)))],
                            ["t", "d", "cell", "cid", "looks"],
                        )

    entries = written(classes.select("cid", "vec").mapInArrow(enter, "t int, d int, cell long, cid long, looks boolean"), "lattice-cells")
    where = ["t", "d", "cell"]
    size = entries.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("looks")).alias("own"))
    size = size.where("n > 1 and own > 0").select(*where, F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))
    e = entries.join(size, where).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("k")).cast("int"))
    every = F.sequence(F.lit(0), F.col("k") - 1)
    left = e.where("not looks").select(*where, "cid", F.lit(0).alias("side"), F.col("chunk").alias("i"), F.explode(every).alias("j"))
    right = e.select(*where, "cid", F.when(F.col("looks"), 2).otherwise(1).alias("side"), F.explode(every).alias("i"), F.col("chunk").alias("j"))
    block = left.unionByName(right).join(classes.select("cid", "m", "vec"), "cid")
    key = [*where, "i", "j"]
    block = block.select(*key, "side", "cid", "m", "vec").repartition(*key).sortWithinPartitions(*key)

    def verify(batches):
        import pyarrow as pa

        def out(name, rows):
            r = {"side": np.array([x[0] for x in rows]), "cid": np.array([x[1] for x in rows], np.int64), "m": np.array([x[2] for x in rows])}
            if not (r["side"] == 0).any() or not (r["side"] != 0).any():
                return
            who, count, a, b = verify_block(r | {"u": _unit([x[3] for x in rows])}, name[0], name[2], blocks)
            if len(who):
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.nulls(len(who), pa.int64()), pa.array(count)], ["a", "b", "links"])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "links"])

        name, rows = None, []
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                for r in zip(*(c.to_pylist() for c in batch.slice(s, 2000).columns)):
                    if r[:5] != name:
                        if len(rows) > 1:
                            yield from out(name, rows)
                        name, rows = r[:5], []
                    rows.append(r[5:])
        if len(rows) > 1:
            yield from out(name, rows)

    found = written(block.mapInArrow(verify, "a long, b long, links long"), "vector-links")
    links = found.where("links is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    label = components(found.where("b is not null").select("a", "b"))
    named = classes.select("cid", "least", "m").join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    named = written(named, "vector-labels")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    of = named.join(least, "label").join(links, "cid", "left").select(
        F.col("cid").alias("h"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id", salts
    )
    rows = v.select("id", "h").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    rows = rows.join(of, ["h", "salt"], "left")  # copied: one vector may be a third of all rows
    comp = F.coalesce("component_id", "id")
    return rows.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), comp.alias("component_id"),
                       F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))


def op2_embedding_dedup(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    return embedding_links(vectors)

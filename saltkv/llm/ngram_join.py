"""Operator 1: n-gram Jaccard join by grouped prefixes.

Two documents link if their sets of distinct 5-word shingles have a Jaccard
similarity of at least 0.8.  All shingles stand in one global order: common ones last,
otherwise by hash.  Sets that are similar enough share one of their first
``n - ceil(0.8 n) + 1`` shingles, their *prefix*.

1. Documents whose sets have equal size and equal prefixes form a *group*; equal
   sets form a *class* in it.  One prefix a group enters the inverted lists.
2. Lists propose pairs of groups of compatible sizes.
3. Pairs are expanded to members.  A parity bitmap bounds how similar two sets can
   be; pairs that pass it are verified on their whole sets.

What is asked for is components, so a pair whose ends are known to be connected
needs no check.  Long lists (over ``LONG``) and groups first propose stars around a pivot;
after verification and a first connection, every pair that is still apart is
expanded in full (``_unresolved``).  Thus a cluster of thousands of near copies costs a multiple of
its size, and no link between different texts is lost.

The order.  A shingle is *common* if over ``LONG`` documents hold it.  The prefixes by hash of all
documents are counted, then, for documents that have a common shingle there, what stands next in the new order.  Any set of common shingles gives the same result; it only shortens lists.  It is sent to all tasks, and
``COMMON_MOST`` bounds it (32 MB): beyond that the count that makes a shingle common
rises.

Scale.  Each pass reads the texts again instead of storing shingles (numpy hashes
25 MB/s and core).  Inverted lists are shuffled as one array for each bucket of
shingles and batch, not as rows.  No text is shuffled: sets are computed
where the text is read, for documents in pairs that passed the bitmap.

Hashes are 64 bits: two sets are taken as equal, and two shingles in a
compared pair as one, wrongly with a probability of about 2**-64 for each pair.

Defined cases.  A null text or one without words has ``n_shingles`` 0 and its own id as
component.  With fewer than five words the whole sequence is one shingle.
Repeated rows (same id and text) give repeated rows; rows that share an id but not the
text are documents of their own whose least reachable id may be that id.  Null
ids are carried and have a null component unless a link leads to an id.  Empty tables give
empty results.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, lean, written
from .components import components
from .langid import text_bytes
from .shingles import WORDS, mix, shingle_sets

#: Lists and groups longer than this start with stars instead of all pairs.
LONG = 12
COMMON_MOST = 1 << 22
SALTS = 16
BITS = 1024
PART = 4096
BLOOM_BITS = 1 << 26
_CHUNK = 1 << 23  # bytes of text whose shingles are counted or listed together


def needed(n):
    """Least overlap of a set of ``n`` with any set that it links to: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def links(inter: int, n: int, m: int) -> bool:
    return 100 * inter >= 80 * (n + m - inter) and inter > 0


def _ordered_prefix(x: np.ndarray, common: np.ndarray, extra: int = 0) -> np.ndarray:
    """The prefix of a sorted set (and ``extra`` more) with common shingles last."""
    k = len(x) - needed(len(x)) + 1 + extra
    if len(common):
        at = np.searchsorted(common, x)
        at[at == len(common)] = 0
        is_common = common[at] == x
        if is_common[:k].any():
            return np.concatenate((x[~is_common], x[is_common]))[:k]
    return x[:k]


def _key(x: np.ndarray) -> int:
    """One 64-bit key of a whole set."""
    n = np.uint64(len(x))
    with np.errstate(over="ignore"):
        return int(mix(np.array([np.add.reduce(mix(x + np.uint64(0x9E3779B97F4A7C15))) ^ (n * np.uint64(0xD1342543DE82EF95))]))[0].view(np.int64))


def _prefix_key(x: np.ndarray, n: int) -> int:
    return _key(np.append(x, np.uint64(n)))


def _bitmap(x: np.ndarray) -> bytes:
    """Parity of the set's hashes in each of ``BITS`` cells.  Two sets differ in at
    least as many shingles as their bitmaps differ in bits."""
    return np.packbits(np.bincount((x >> np.uint64(40)) & np.uint64(BITS - 1), minlength=BITS).astype(np.uint8) & 1).tobytes()


def _buckets(tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``tokens`` by bucket, and where each of the ``n`` buckets starts."""
    b = (tokens >> np.uint64(20)) % np.uint64(n)
    order = np.argsort(b, kind="stable")
    return order, np.searchsorted(b[order], np.arange(n + 1, dtype=np.uint64))


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket_runs(batches):
    """``(bucket, rows)`` from batches that are sorted by their first column."""
    bucket, rows = None, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if r[0] != bucket and rows:
                yield bucket, rows
                rows = []
            bucket = r[0]
            rows.append(r[1:])
    if rows:
        yield bucket, rows


# ------------------------------------------------------------ the order


def _count_common(docs: DataFrame, common: np.ndarray, n_words: int, buckets: int) -> DataFrame:
    """``token, df``: shingles that over ``LONG`` documents hold.  First (``common``
    is empty) in their prefixes, then in twice that, for documents with a common one in the
    prefix.  A batch counts a shingle 255 times at most, which is over any limit that matters."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(common)

    def count(batches):
        import pyarrow as pa

        def flush(parts):
            tokens, n = np.unique(np.concatenate(parts), return_counts=True)
            order, cut = _buckets(tokens, buckets)
            tokens, n = tokens[order], np.minimum(n[order], 255).astype(np.uint8)
            some = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([tokens[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary()),
                 pa.array([n[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary())], ["bucket", "tokens", "counts"])

        parts, size = [], 0
        for batch in batches:
            for _, x in shingle_sets(*text_bytes(batch.column(0)), n_words):
                p = _ordered_prefix(x, sent.value)
                if not len(sent.value) or not np.array_equal(p, x[: len(p)]):
                    parts.append(_ordered_prefix(x, sent.value, len(p)) if len(sent.value) else p)
                    size += len(x) * 8
                if size > _CHUNK:
                    yield flush(parts)
                    parts, size = [], 0
        if parts:
            yield flush(parts)

    def total(batches):
        import pyarrow as pa

        for _, rows in _bucket_runs(batches):
            t = np.concatenate([np.frombuffer(a, np.uint64) for a, _ in rows])
            c = np.concatenate([np.frombuffer(b, np.uint8) for _, b in rows])
            order = np.argsort(t, kind="stable")
            t, c = t[order], c[order]
            start = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            df = np.add.reduceat(c.astype(np.int64), start)
            yield pa.RecordBatch.from_arrays([pa.array(t[start][df > LONG].view(np.int64)), pa.array(df[df > LONG])], ["token", "df"])

    rows = docs.select("__text").mapInArrow(lean(count), "bucket int, tokens binary, counts binary")
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(lean(total), "token long, df long")


def common_shingles(docs: DataFrame, n_words: int) -> np.ndarray:
    """Sorted hashes of the common shingles, at most ``COMMON_MOST``."""
    buckets = _partitions(docs.sparkSession)
    common = np.zeros(0, np.uint64)
    for _ in range(2):
        new = written(_count_common(docs, common, n_words, buckets), "common-shingles")
        least, room = LONG, COMMON_MOST - len(common)
        while (found := new.where(F.col("df") > least).count()) > room:
            least *= 2
        if not found:
            break
        got = new.where(F.col("df") > least).select("token").toArrow().column(0).to_numpy().view(np.uint64)
        common = np.union1d(common, got)
    return common


# ------------------------------------------------------------ lists and pairs


def _pairs_of_lists(docs: DataFrame, reps: np.ndarray, sent, n_words: int, buckets: int) -> DataFrame:
    """Inverted lists over the groups' representatives (``reps``: a bloom map of their ids'
    hashes; what else it lets pass is sorted out by group).  Rows ``(0, a, b, 0)`` are proposed pairs of groups,
    ``(1, token, gid, n)`` the entries of long lists."""
    sent_reps = docs.sparkSession.sparkContext.broadcast(reps)

    def spread(batches):
        import pyarrow as pa

        def flush(prefix, gid, size):
            k = [len(p) for p in prefix]
            t, g, n = np.concatenate(prefix), np.repeat(np.array(gid, np.int64), k), np.repeat(np.minimum(size, 65535).astype(np.uint16), k)
            order, cut = _buckets(t, buckets)
            some = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), *(pa.array([v[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary()) for v in (t[order], g[order], n[order]))],
                ["bucket", "tokens", "gids", "sizes"],
            )

        prefix, gid, size, total = [], [], [], 0
        for batch in batches:
            batch = batch.filter(pa.array(_in_bloom(sent_reps.value, batch.column(1).to_numpy())))
            for _, x in shingle_sets(*text_bytes(batch.column(0)), n_words):
                p = _ordered_prefix(x, sent.value)
                prefix.append(p)
                gid.append(_prefix_key(p, len(x)))
                size.append(len(x))
                total += len(x) * 8
                if total > _CHUNK:
                    yield flush(prefix, gid, size)
                    prefix, gid, size, total = [], [], [], 0
        if prefix:
            yield flush(prefix, gid, size)

    def propose(batches):
        import pyarrow as pa

        def rows(kind, a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(n)], ["kind", "a", "b", "n"])

        for _, parts in _bucket_runs(batches):
            t, g, n = (np.concatenate([np.frombuffer(p[i], kind) for p in parts]) for i, kind in enumerate((np.uint64, np.int64, np.uint16)))
            # entries of lists with two groups or more, by list, size and group; a group enters once
            order = np.argsort(t, kind="stable")
            same = t[order][1:] == t[order][:-1]
            order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
            order = order[np.lexsort((g[order], n[order], t[order]))]
            again = (t[order][1:] == t[order][:-1]) & (g[order][1:] == g[order][:-1])
            order = order[np.concatenate(([True], ~again))] if len(order) else order
            t, g, n = t[order], g[order], n[order].astype(np.int64)
            start = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.zeros(0, np.int64)
            size = np.diff(np.append(start, len(t)))
            length, rank = np.repeat(size, size), np.arange(len(t)) - np.repeat(start, size)
            long = length > LONG
            left, right = [], []
            for lag in range(1, LONG):  # all pairs of short lists
                i = np.flatnonzero(~long & (rank + lag < length))
                if not len(i):
                    break
                i = i[n[i] >= needed(n[i + lag])]  # 65,535 stands for any greater size
                left.append(i)
                right.append(i + lag)
            # long lists: stars around every LONG-th entry, and a chain of the pivots
            i = np.flatnonzero(long & (rank > 0))
            pivot = np.where(rank[i] % LONG, i - rank[i] % LONG, i - LONG)
            ok = n[pivot] >= needed(n[i])
            left.append(pivot[ok])
            right.append(i[ok])
            a, b = g[np.concatenate(left)], g[np.concatenate(right)]
            ab = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
            yield rows(0, ab[:, 0], ab[:, 1], np.zeros(len(ab), np.int64))
            yield rows(1, t[long].view(np.int64), g[long], n[long])

    rows = docs.select("__text", F.xxhash64("__id").alias("h"))
    spreaded = rows.mapInArrow(lean(spread), "bucket int, tokens binary, gids binary, sizes binary")
    spreaded = spreaded.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return spreaded.mapInArrow(lean(propose), "kind int, a long, b long, n long")


def _bloom(hashes: DataFrame) -> np.ndarray:
    """One bit for each of ``hashes`` (column ``h``) in a map of ``BLOOM_BITS``, as words
    of 64: 8 MB at most.  It spares work, and false hits change nothing."""
    word = F.pmod(F.shiftright("h", 6), F.lit(BLOOM_BITS // 64))
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    rows = hashes.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def _in_bloom(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (bits[(h >> 6) % len(bits)] >> (h & 63)) & 1 == 1


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n_words: int) -> DataFrame:
    """The linking ones of ``pairs`` (class keys ``a, b``), on whole sets."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def close(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BITS // 8) for i in (3, 5))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            total = batch.column(2).to_numpy() + batch.column(4).to_numpy()
            # linking sets of n and m differ in (n + m) / 9 shingles at most
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(9 * differ <= total))

    pairs = pairs.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(lean(close), "a long, b long")
    pairs = written(pairs, "close-pairs")
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    bits = _bloom(keys.join(classes.select("key", "doc"), "key").select(F.xxhash64("doc").alias("h")))
    sent_bits = docs.sparkSession.sparkContext.broadcast(bits)

    def sets(batches):
        import pyarrow as pa

        sent: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(_in_bloom(sent_bits.value, batch.column(1).to_numpy())))
            own, raw, size = [], [], 0
            for _, x in shingle_sets(*text_bytes(batch.column(0)), n_words):
                key = _key(x)
                if key not in sent:
                    sent.add(key)
                    own.append(key)
                    raw.append(x.tobytes())
                    size += len(raw[-1])
                if size > _CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(raw, pa.binary())], ["key", "shingles"])
                    own, raw, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(raw, pa.binary())], ["key", "shingles"])

    def check(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):  # no copies of a batch's sets
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                ok.append(links(int((y[at] == x).sum()), len(x), len(y)))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], ["a", "b"])

    s = docs.select("__text", F.xxhash64("__id").alias("h")).mapInArrow(lean(sets), "key long, shingles binary")
    s = written(s, "shingle-sets")  # the bloom map let through few others; the joins drop them
    both = pairs.join(s.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(s.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(lean(check), "a long, b long").distinct()  # a repeated row may have given its set twice


def _apart_in_lists(batches):
    """Pairs of one block of a long list that aren't connected and that sizes and bitmaps let link."""
    import pyarrow as pa

    def pairs(rows):
        side, key, n, label, bits = (list(c) for c in zip(*rows))
        side, key, n, label = np.array(side), np.array(key, np.int64), np.array(n, np.int64), np.array(label, np.int64)
        bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(rows), -1)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for s in range(0, len(x), 256):
            i, j = np.nonzero((label[x[s : s + 256], None] != label[y][None]) & (5 * np.minimum(n[x[s : s + 256], None], n[y][None]) >= 4 * np.maximum(n[x[s : s + 256], None], n[y][None])))
            i, j = x[s + i], y[j]
            for t in range(0, len(i), 1 << 16):
                u, v = i[t : t + (1 << 16)], j[t : t + (1 << 16)]
                ok = 9 * np.bitwise_count(bits[u] ^ bits[v]).sum(axis=1, dtype=np.int64) <= n[u] + n[v]
                a, b = key[u[ok]], key[v[ok]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    name, rows = None, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if r[:3] != name:
                if rows:
                    yield from pairs(rows)
                name, rows = r[:3], []
            rows.append(r[3:])
    if rows:
        yield from pairs(rows)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _unresolved(groups: DataFrame, members: DataFrame, proposed: DataFrame, long: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs of classes that the first round left untried and apart.  ``members``:
    ``gid, key, n, label``."""
    m1 = members.select(F.col("gid").alias("g1"), F.col("key").alias("a"), F.col("n").alias("n1"), F.col("label").alias("l1"))
    m2 = members.select(F.col("gid").alias("g2"), F.col("key").alias("b"), F.col("n").alias("n2"), F.col("label").alias("l2"))
    apart = F.col("l1") != F.col("l2")
    # members of one group that aren't all connected
    split = members.groupBy("gid").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select(F.col("gid").alias("g1"))
    inside = m1.join(split, "g1", "left_semi").join(m2, F.col("g1") == F.col("g2")).where(apart & (F.col("a") < F.col("b"))).select("a", "b")
    # proposed pairs of groups with more members than the two that were tried
    size = groups.select("gid", "m")
    wide = proposed.join(size.select(F.col("gid").alias("a"), F.col("m").alias("ma")), "a").join(size.select(F.col("gid").alias("b"), F.col("m").alias("mb")), "b")
    wide = wide.where("ma > 1 or mb > 1").select(F.col("a").alias("g1"), F.col("b").alias("g2"))
    across = wide.join(m1, "g1").join(m2, "g2").where(apart).select("a", "b")
    # long lists whose entries aren't all connected, in blocks of PART x PART entries
    entry = long.select("token", "gid").join(members.select("gid", "key", "n", "label", "bits"), "gid").drop("gid")
    mixed = entry.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size"))
    mixed = mixed.where("x != y").select("token", F.ceil(F.col("size") / PART).cast("int").alias("k"))
    entry = entry.join(mixed, "token").withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("k")).cast("int"))
    value = ["key", "n", "label", "bits"]
    left = entry.select("token", F.col("chunk").alias("i"), F.explode(F.sequence(F.col("chunk"), F.col("k") - 1)).alias("j"), F.lit(0).alias("side"), *value)
    right = entry.select("token", F.explode(F.sequence(F.lit(0), F.col("chunk"))).alias("i"), F.col("chunk").alias("j"), F.lit(1).alias("side"), *value)
    block = left.unionByName(right).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    rest = block.mapInArrow(lean(_apart_in_lists), "a long, b long")
    return _ordered(inside.unionByName(across).unionByName(rest)).join(tried, ["a", "b"], "left_anti")


# ------------------------------------------------------------ the operator


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``."""
    spark = docs.sparkSession
    d = id_text(docs, id_col, text_col)
    buckets = _partitions(spark)
    sent = spark.sparkContext.broadcast(common_shingles(d, n_words))

    def describe(batches):
        import pyarrow as pa

        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            key, gid, bits = ([None] * len(size) for _ in range(3))
            for i, x in shingle_sets(*text_bytes(batch.column(1)), n_words):
                p = _ordered_prefix(x, sent.value)
                size[i], key[i], gid[i], bits[i] = len(x), _key(x), _prefix_key(p, len(x)), _bitmap(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(key, pa.int64()), pa.array(gid, pa.int64()), pa.array(bits, pa.binary())],
                ["doc", "n", "key", "gid", "bits"],
            )

    kind = d.schema["__id"].dataType.simpleString()
    rows = written(d.mapInArrow(lean(describe), f"doc {kind}, n long, key long, gid long, bits binary"), "sets")
    classes = written(rows.where("n > 0").groupBy("key").agg(F.min("doc").alias("doc"), F.min("n").alias("n"), F.min("gid").alias("gid"), F.min("bits").alias("bits")), "classes")
    groups = written(classes.groupBy("gid").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("m")), "groups")
    reps = _bloom(groups.join(classes.select(F.col("key").alias("rep"), "doc"), "rep").select(F.xxhash64("doc").alias("h")))
    proposals = written(_pairs_of_lists(d, reps, sent, n_words, buckets), "list-pairs")
    proposed = written(proposals.where("kind = 0").select("a", "b").distinct(), "group-pairs")
    long = proposals.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("gid"))

    rep = groups.select("gid", "rep")
    first = proposed.join(rep.select(F.col("gid").alias("a"), F.col("rep").alias("ra")), "a").join(rep.select(F.col("gid").alias("b"), F.col("rep").alias("rb")), "b")
    stars = classes.join(groups.where("m > 1").select("gid", "rep"), "gid").select(F.col("rep").alias("a"), F.col("key").alias("b"))
    tried = written(_ordered(first.select(F.col("ra").alias("a"), F.col("rb").alias("b")).unionByName(stars)), "class-pairs")
    edges = written(_verified(tried, d, classes, n_words), "class-links")

    label = components(edges)
    named = classes.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    members = written(named.select("gid", "key", "n", "label", "doc", "bits"), "members")
    more = written(_unresolved(groups, members, proposed, long, tried), "class-pairs")
    if more.head(1):
        edges = edges.unionByName(written(_verified(more, d, classes, n_words), "class-links"))
        label = components(edges)
        named = classes.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
        members = written(named.select("gid", "key", "n", "label", "doc", "bits"), "members")

    least = members.groupBy("label").agg(F.min("doc").alias("component_id"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    of = members.join(least, "label").select("key", "component_id", salts)  # copied: one text may be a third of all rows
    out = rows.select("doc", "n", "key").withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    out = out.join(of, ["key", "salt"], "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))


def keep_first_of_component(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the
    least doc_id.  Documents without words are nobody's copies and stay.  Rows
    that share the kept doc_id all stay."""
    c = ngram_components(docs)
    gone = c.where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op1_ngram_jaccard(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return ngram_components(docs)

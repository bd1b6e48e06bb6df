"""Operator 13: phrase collocations by multikey three-way quicksort of suffix pointers.

1. *Words.*  Texts are lower-cased (A-Z), cut into pieces and words, and words are counted by language.  Words below
   ``LEAST`` can't be part of a candidate.  A bit table of fixed size holds the others (a false hit only keeps more).
2. *Routing.*  Each word is the start of a suffix of up to ``DEPTH`` words that ends at the piece's end or before a word that isn't in
   the table.  Tasks combine equal suffixes and send them to a route by the hash of their two leading
   words, as blocks: the block's words once, and numbers.
3. *Sorting.*  A route's pointers are sorted by multikey three-way quicksort: partition by the word at the current depth into
   less, equal and greater; the equal part's weight is the count of the phrase up to that depth, and goes one word deeper.  A
   part whose weight is below ``LEAST`` is abandoned.
4. *Scores.*  Every part of a candidate is a candidate or a frequent word itself, so ``l`` and ``r`` are joins of the candidate table
   with itself.  Candidates covered by a longer one go, and the first ``FIRST`` of each language remain.

Scale.  ``ROUTE`` bounds the suffixes of a route: the first pass also counts leading pairs and triples by hash into
fine buckets, which grow in number with the text.  A pair bucket beyond the bound is routed by three words, and a triple bucket beyond
it by all four, so no common pair or passage lands in one task.  Prefixes shorter than what a route was dealt by are
counted in part there; such counts aren't abandoned but added up by Spark.  Equal suffixes of four words are combined before they leave a task.
Collected: the bit table, and the hot buckets (at most text / ``ROUTE``).

Defined cases.  Null and empty texts have no words.  A null language is ``und``.  Repeated rows and ids count as often as they
occur.  Texts of any length are read in slices without a cut between them.  Ties of the score go to the larger count, then to the lesser
phrase in byte order; ties between cuts to the first.  Empty tables give empty results.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship_package, written

DEPTH, LEAST, COVER, SCALE, FIRST = 4, 30, 80, 2_000_000, 2000
ROUTE, FLUSH, SLICE = 2_000_000, 2_000_000, 1 << 20
FINE = 4096
BITS = 26

_END = b"\xff"  # in no UTF-8 text
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(0xFF if c in _CUTS else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


# ------------------------------------------------------------ words


class Numbers(dict):
    """Numbers of the words of one language, from 1; 0 is the end of a piece or an infrequent word."""

    def __init__(self, lang: bytes, known: np.ndarray | None):
        super().__init__({_END: 0})
        self.seed, self.seed32, self.known = xxhash.xxh64_intdigest(lang), zlib.crc32(lang + b"\0"), known
        self.words, self.hashes = [_END], [0]

    def __missing__(self, word: bytes) -> int:
        n = 0
        if self.known is not None:
            bit = zlib.crc32(word, self.seed32) & ((1 << BITS) - 1)
        if self.known is None or self.known[bit >> 3] >> (bit & 7) & 1:
            n = len(self.words)
            self.words.append(word)
            self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        self[word] = n
        return n


def read_words(batches, known: np.ndarray | None = None) -> Iterator[tuple[bytes, Numbers, np.ndarray, int]]:
    """``(lang, numbers, ids, n)``: the word numbers of many texts of a language, of which the first ``n`` are
    suffix starts and the others only what the last suffixes need."""
    state: dict[bytes, list] = {}  # lang -> [numbers, texts, their bytes, arrays of ids, their size]

    def number(s):
        blob = _END.join(s[1]) + _END
        s[1], s[2] = [], 0
        blob = blob.translate(_TABLE).replace(_END, b" \xff ")
        at = 0
        while at < len(blob):
            end = blob.find(b" ", at + SLICE)
            end = len(blob) if end < 0 else end
            words = blob[at:end].split()
            s[3].append(np.fromiter(map(s[0].__getitem__, words), np.int32, len(words)))
            s[4] += len(words)
            at = end
            if s[4] >= FLUSH and at < len(blob):
                ids = np.concatenate(s[3])
                s[3], s[4] = [ids[1 - DEPTH :]], DEPTH - 1
                yield ids, len(ids) - (DEPTH - 1)

    def finish(s):
        ids = np.concatenate([*s[3], np.zeros(DEPTH - 1, np.int32)])
        s[3], s[4] = [], 0
        return ids, len(ids) - (DEPTH - 1)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            text = text.as_py()
            if not text:
                continue
            s = state.get(lang)
            if s is None:
                s = state[lang] = [Numbers(lang, known), [], 0, [], 0]
            s[1].append(text)
            s[2] += len(text)
            if s[2] >= SLICE:
                for unit in number(s):
                    yield lang, s[0], *unit
                if s[4] >= FLUSH or len(s[0]) > 1 << 20:
                    yield lang, s[0], *finish(s)
                    if len(s[0]) > 1 << 20:
                        s[0] = Numbers(lang, known)
    for lang, s in state.items():
        if s[1]:
            for unit in number(s):
                yield lang, s[0], *unit
        if s[4]:
            yield lang, s[0], *finish(s)


def suffixes(ids: np.ndarray, n: int) -> np.ndarray:
    """The suffix of each of the first ``n`` places, a column for each depth; 0 from its end on."""
    w = np.zeros((DEPTH, n), np.int32)
    w[0] = ids[:n]
    for d in range(1, DEPTH):
        w[d] = np.where(w[d - 1] > 0, ids[d : d + n], 0)
    return w


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def prefix_hashes(w: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first two, three, ... words of each suffix."""
    out = [hashes[w[0]]]
    for d in range(1, DEPTH):
        out.append(_mix(out[-1], hashes[w[d]]))
    return out[1:]


# ------------------------------------------------------------ pass 1: words and loads


def _counted(fine: int):
    """Word counts by language, and how many suffixes start with a pair or triple of each fine bucket."""

    def count(batches):
        loads = [np.zeros(fine, np.int64), np.zeros(fine, np.int64)]
        for lang, numbers, ids, n in read_words(batches):
            per = np.bincount(ids[:n], minlength=1)
            per[0] = 0
            there = np.flatnonzero(per)
            for part in np.array_split(there, len(there) // 100_000 + 1):
                words = pa.array([numbers.words[i] for i in part], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(part), np.int32)), pa.array([lang] * len(part), pa.binary()), words, pa.nulls(len(part), pa.int64()), pa.array(per[part])],
                    ["kind", "lang", "word", "bucket", "n"],
                )
            w = suffixes(ids, n)
            w = w[:, w[1] > 0]
            for load, h in zip(loads, prefix_hashes(w, np.array(numbers.hashes, np.uint64))):
                load += np.bincount((h & np.uint64(fine - 1)).astype(np.int64), minlength=fine)
        for k, load in enumerate(loads):
            at = np.flatnonzero(load)
            empty = pa.nulls(len(at), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k + 1, np.int32)), empty, empty, pa.array(at), pa.array(load[at])], ["kind", "lang", "word", "bucket", "n"])

    return count


def frequent_bits(words: DataFrame, least: int) -> np.ndarray:
    """The table of ``2 ** BITS`` bits (8 MB) of the frequent words."""
    at = F.crc32(F.concat("lang", F.unhex(F.lit("00")), "word")).bitwiseAND(F.lit((1 << BITS) - 1))
    pages = words.where(F.col("n") >= least).select(at.alias("b")).groupBy(F.shiftright("b", 15).alias("p")).agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit(32767))).alias("m"))
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for r in pages.collect():
        bits[r.p << 12 : (r.p << 12) + 4096] = np.frombuffer(r.m, np.uint8)
    return bits


# ------------------------------------------------------------ pass 2: routing


class Routes:
    """Where a suffix goes: ``count`` routes by two leading words, as many by three for hot pairs, and by
    all words for hot triples."""

    def __init__(self, count: int, hot2: np.ndarray, hot3: np.ndarray):
        self.count, self.hot = count, (hot2, hot3)

    def of(self, hashes: list[np.ndarray]) -> np.ndarray:
        fine, n = np.uint64(len(self.hot[0]) - 1), np.uint64(self.count)
        two, three, four = hashes
        hot2 = self.hot[0][(two & fine).astype(np.int64)]
        hot3 = hot2 & self.hot[1][(three & fine).astype(np.int64)]
        route = np.where(hot3, four % n + n + n, np.where(hot2, three % n + n, (two & fine) % n))
        return route.astype(np.int64)

    def partial(self, route: int) -> int:
        """Up to how many words a prefix may have its occurrences in several routes (0: all that count are here)."""
        return (0, 2, 3)[route // self.count]


def combined(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, and how often each occurs."""
    head = w[0].astype(np.int64) << 32 | w[1]
    tail = w[2].astype(np.int64) << 32 | w[3]
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    first = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))))
    return w[:, order[first]], np.diff(np.concatenate((first, [len(head)])))


def _routed(shared, routes: Routes):
    def send(batches):
        for lang, numbers, ids, n in read_words(batches, shared.value):
            w = suffixes(ids, n)
            w = w[:, w[1] > 0]
            if not w.shape[1]:
                continue
            w, count = combined(w)
            route = routes.of(prefix_hashes(w, np.array(numbers.hashes, np.uint64)))
            order = np.argsort(route, kind="stable")
            names, first = np.unique(route[order], return_index=True)
            rows = []
            for r, own in zip(names.tolist(), np.split(order, first[1:])):
                rows.append((lang, r, *packed(w[:, own], count[own], numbers.words)))
                if len(rows) == 256:
                    yield _blocks(rows)
                    rows = []
            if rows:
                yield _blocks(rows)

    return send


def packed(w: np.ndarray, count: np.ndarray, names: list[bytes]) -> tuple[int, int, int, bytes]:
    """Suffixes as ``(size, bytes of the words, suffixes, block)``: the words once, and byte by byte the suffixes' numbers
    of them (0: end) and the counts, compressed."""
    there, local = np.unique(w, return_inverse=True)
    local = local.reshape(w.shape) + (1 if there[0] else 0)
    words = b" ".join(names[i] for i in there if i)
    columns = [np.frombuffer(x.astype("<u4").tobytes(), np.uint8).reshape(-1, 4).T for x in (*local, count)]
    block = words + b"".join(c.tobytes() for c in columns)
    return len(block), len(words), w.shape[1], pa.compress(block, codec="zstd", asbytes=True)


def unpacked(size: int, n_words: int, n: int, block: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``(words, numbers, counts)`` of a block."""
    block = pa.decompress(block, decompressed_size=size, codec="zstd", asbytes=True)
    columns = np.frombuffer(block, np.uint8, offset=n_words).reshape(DEPTH + 1, 4, n)
    columns = np.ascontiguousarray(columns.transpose(0, 2, 1)).view("<u4").reshape(DEPTH + 1, n)
    return block[:n_words].split(b" "), columns[:DEPTH], columns[DEPTH]


_BLOCK = [("lang", pa.binary()), ("route", pa.int64()), ("size", pa.int64()), ("n_words", pa.int64()), ("n", pa.int64()), ("block", pa.binary())]


def _blocks(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*rows), _BLOCK)], [k for k, _ in _BLOCK])


# ------------------------------------------------------------ sorting


def frequent_prefixes(w: np.ndarray, weight: np.ndarray, least: int, partial: int = 0) -> Iterator[tuple[int, int, int]]:
    """``(suffix, words, count)`` of each prefix of two words or more whose suffixes weigh ``least``, by multikey three-way
    quicksort of pointers to the columns of ``w``.  Prefixes of up to ``partial`` words are given whatever they weigh."""
    pointers = np.arange(w.shape[1])
    todo = [(0, len(pointers), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        own = pointers[lo:hi]
        key, heavy = w[depth].take(own), weight.take(own)
        some = np.sort(key[:: max(1, len(key) // 9)])
        pivot = some[len(some) // 2]
        less, same = key < pivot, key == pivot
        more = ~(less | same)
        a, b = lo + int(np.count_nonzero(less)), hi - int(np.count_nonzero(more))
        pointers[lo:hi] = np.concatenate((own[less], own[same], own[more]))
        for start, end, rows in ((lo, a, less), (b, hi, more)):
            # no prefix in here weighs more than all of it
            if start < end and (depth < partial or heavy[rows].sum() >= least):
                todo.append((start, end, depth))
        if pivot == 0:
            continue  # these suffixes have ended
        count, words = int(heavy[same].sum()), depth + 1
        if count >= least or words <= partial:
            if words >= 2:
                yield int(pointers[a]), words, count
            if words < DEPTH:
                todo.append((a, b, words))


def _sorted(routes: Routes, least: int):
    def phrases(key, blocks):
        lang, route = key[0].as_py(), key[1].as_py()
        names: dict[bytes, int] = {}
        parts, weights = [], []
        for row in zip(*(blocks.column(k) for k, _ in _BLOCK[2:])):
            words, w, n = unpacked(*(x.as_py() for x in row))
            to = np.fromiter([0, *(names.setdefault(x, len(names) + 1) for x in words)], np.int32, len(words) + 1)
            parts.append(to[w])
            weights.append(n)
        w, weight = np.concatenate(parts, axis=1), np.concatenate(weights).astype(np.int64)
        del parts, weights
        text = [b"", *names]
        rows = [(lang, b" ".join(text[i] for i in w[:words, at]), words, n) for at, words, n in frequent_prefixes(w, weight, least, routes.partial(route))]
        kinds = [("lang", pa.binary()), ("phrase", pa.binary()), ("words", pa.int32()), ("a", pa.int64())]
        return pa.table([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [k for k, _ in kinds])

    return phrases


# ------------------------------------------------------------ Spark


def candidate_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(words, phrases)``: ``lang, word, n`` of all words, and ``lang, phrase, words, a`` of the candidates."""
    spark = docs.sparkSession
    ship_package(spark)
    d = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).cast("binary").alias("lang"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fine = max(FINE, 1 << int(np.ceil(np.log2(1 + size / ROUTE))))  # a bucket has ROUTE bytes or fewer on average
    counted = d.mapInArrow(_counted(fine), "kind int, lang binary, word binary, bucket long, n long")
    counted = written(counted.groupBy("kind", "lang", "word", "bucket").agg(F.sum("n").alias("n")), "phrase-words", "kind")
    words, loads = counted.where("kind = 0").select("lang", "word", "n"), counted.where("kind > 0")
    hot = np.zeros((2, fine), bool)
    for r in loads.where(F.col("n") > ROUTE).select("kind", "bucket").collect():
        hot[r.kind - 1, r.bucket] = True
    total = loads.where("kind = 1").agg(F.sum("n")).first()[0] or 0
    routes = Routes(max(1, -(-total // ROUTE)), *hot)
    shared = spark.sparkContext.broadcast(frequent_bits(words, least))
    blocks = d.mapInArrow(_routed(shared, routes), "lang binary, route long, size long, n_words long, n long, block binary")
    found = blocks.groupBy("lang", "route").applyInArrow(_sorted(routes, least), "lang binary, phrase binary, words int, a long")
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return words, written(found, "phrase-candidates")


def scored(words: DataFrame, phrases: DataFrame, least: int = LEAST, cover: int = COVER, scale: int = SCALE) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer one covers."""
    p = phrases.withColumn("phrase", F.col("phrase").cast("string"))
    counts = p.select("lang", F.col("phrase").alias("part"), F.col("a").alias("n")).unionByName(
        words.where(F.col("n") >= least).select("lang", F.col("word").cast("string").alias("part"), "n")
    )
    ks = range(1, DEPTH)
    sides = [F.struct(F.lit(k).alias("k"), F.lit(s).alias("s"), F.expr(f"substring_index(phrase, ' ', {k if s == 'l' else f'{k} - words'})").alias("part")) for k in ks for s in "lr"]
    cuts = p.select("lang", "phrase", "words", "a", F.explode(F.filter(F.array(*sides), lambda c: c["k"] < F.col("words"))).alias("c"))
    cuts = cuts.select("lang", "phrase", "a", "c.k", "c.s", "c.part").join(counts, ["lang", "part"])
    ends = [F.max(F.when((F.col("k") == k) & (F.col("s") == s), F.col("n"))).alias(f"{s}{k}") for k in ks for s in "lr"]
    wide = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), *ends)
    cut = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(f"CAST({scale} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(19, 0)) DIV (CAST(l{k} AS DECIMAL(19, 0)) + CAST(r{k} AS DECIMAL(19, 0)))").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in ks]
    best = wide.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*cut))).alias("c"))
    # what a longer candidate covers: the greatest count of those that hold it
    inner = [
        F.struct((F.lit(i + m)).alias("end"), F.expr(f"substring_index(substring_index(phrase, ' ', {i + m}), ' ', -{m})").alias("part"), F.lit(m).alias("m"))
        for m in range(2, DEPTH) for i in range(DEPTH - m + 1)
    ]
    held = p.where(F.col("words") > 2).select("lang", "words", "a", F.explode(F.filter(F.array(*inner), lambda c: (c["end"] <= F.col("words")) & (c["m"] < F.col("words")))).alias("c"))
    held = held.groupBy("lang", F.col("c.part").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = best.join(held, ["lang", "phrase"], "left")
    covered = F.expr(f"CAST(longer AS DECIMAL(19, 0)) * 100 >= CAST(a AS DECIMAL(19, 0)) * {cover}")
    kept = kept.where(F.col("longer").isNull() | ~covered)
    return kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``first`` phrases."""
    words, phrases = candidate_phrases(docs, least, text_col, lang_col)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = scored(words, phrases, least)
    # first by slices of a language, then among what is left of them
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= first)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    rows = rows.join(n, "lang")
    return rows.select(F.col("lang").cast("string").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return collocations(docs)

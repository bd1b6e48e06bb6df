"""Operator 7: benchmark decontamination by SimHash windows (DataFrame functions only).

1. Words are hashed.  At every word of every text stand windows of ``SHINGLE`` and of ``SIZES`` words; a window's fingerprint holds the
   bits set in most of its words' hashes.  All runs of five words of a text are its shingles.  A shingle of an
   item weighs the logarithm of the inverse share of items that hold it.
2. Windows of the item's own size (the largest of ``SIZES`` that it holds), half a window apart and one at its end, propose it, and so do its
   heaviest windows of ``SHINGLE`` words that together weigh more than ``1 - SIMILARITY`` of it: a text that holds none of
   these can't reach ``SIMILARITY``, so no changed or broken passage is lost, however few bits a longer window keeps.
3. Fingerprints are cut into ``RADIUS + 1`` blocks.  Two within ``RADIUS`` bits agree in a block, so an equality join on (size, block, its
   bits) finds all of them; a pair counts at its first common block.  Of matches that follow each other as in the item, the first
   stands for all, so an unbroken passage is verified once.  Windows of ``SHINGLE`` words, where three equal words outvote the others, also have to
   agree in their words.
4. A proposed item is contained in a document if its shingles that stand in the document (anywhere in
   it, so that inserted words cost only the shingles they break) reach ``SIMILARITY`` of the weight of all its shingles.

Scale.  Documents are read once; a word's fingerprints are some 200 bit operations in generated code, and only words that match a window leave
their task; nothing is shuffled but verified pairs.  The windows of items are broadcast in parts of about
``BROADCAST_ROWS`` rows, so a benchmark of any size is a
number of passes, not a larger broadcast.  Weights of an item are summed in a window over its own shingles, and
compared as a few sets: verifying is linear in item and document.

Defined cases.  Null and empty texts have no shingles.  Very long texts are searched whole.  Words are runs of letters and digits in lower
case; in scripts written without spaces each character is a word.  Items of fewer than ``SHINGLE`` words have no shingle, so their similarity isn't
defined and they aren't found.  Items under ``SHORT`` words weigh their shingles among themselves.
Repeated rows and ids give one row for each (doc_id, item_id); a null id is a value like any other.  Empty tables give
no rows.  Extra columns are ignored by ``contaminated`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_text, written

BLOCK, SHINGLE, RADIUS, SIMILARITY = 8, 5, 3, 0.8
SIZES = (8, 16, 32)
BROADCAST_ROWS = 200_000
#: Items of fewer words are a class of their own for weights.
SHORT = 15
#: Scripts written without spaces.
_UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
_ONES = 0x0101010101010101


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("long")


def word_hashes(text: Column) -> Column:
    text = F.when(text.rlike(_UNSPACED), F.regexp_replace(text, f"({_UNSPACED})", " $1 ")).otherwise(text)
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _lanes(block: Column) -> Column:
    """Bit counts of eight word hashes: lane ``j`` counts bits j, j+8, ... in its bytes."""
    def lane(j):
        return reduce(lambda a, b: a + b, [F.shiftrightunsigned(block[t], j).bitwiseAND(_long(_ONES)) for t in range(BLOCK)])

    return F.struct(*[lane(j).alias(f"l{j}") for j in range(8)])


def _add(a: Column, b: Column) -> Column:
    return F.struct(*[(a[f"l{j}"] + b[f"l{j}"]).alias(f"l{j}") for j in range(8)])


def _majority(lanes: Column, size: int) -> Column:
    """The SimHash: bits set in more than half of the words.  A count over that half
    carries into its lane's seventh bit (counts are at most 32, so never further)."""
    over = _long((63 - size // 2) * _ONES)
    bit = [F.shiftleft(F.shiftrightunsigned((lanes[f"l{j}"] + over).bitwiseAND(_long(0x40 * _ONES)), 6), j) for j in range(8)]
    return reduce(lambda a, b: a.bitwiseOR(b), bit)


def _block_lanes(h: Column) -> Column:
    n = F.floor(F.size(h) / BLOCK).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: F.slice(h, b * BLOCK + 1, F.lit(BLOCK)))
    return F.transform(blocks, _lanes)


def _with_prints(df: DataFrame) -> DataFrame:
    """``df`` with, for each size, an array ``f<size>`` of the fingerprints of the windows of
    ``h`` by block.  Sums stand in columns of their own, so that each is computed once."""
    df = df.withColumn("l8", _block_lanes(F.col("h")))
    for k, (half, size) in enumerate(zip(SIZES, SIZES[1:])):
        # a block and the half window behind it; beyond the end the sum is null
        behind = F.slice(f"l{half}", (1 << k) + 1, F.greatest(F.size(f"l{half}"), F.lit(1)))
        df = df.select("*", F.zip_with(f"l{half}", behind, _add).alias(f"l{size}"))

    def majority(size):
        return lambda w: _majority(w, size)

    kept = [c for c in df.columns if c not in {f"l{s}" for s in SIZES}]
    return df.select(*kept, *[F.transform(f"l{s}", majority(s)).alias(f"f{s}") for s in SIZES])


def shingle_hashes(h: Column) -> Column:
    """Hashes of all runs of five words, as an array."""
    n = F.size(h) - (SHINGLE - 1)
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))


def item_shingles(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``row, item, s, w, before, whole, prev``: each distinct shingle of each item with its weight, the weight of the item's heavier ones and of
    all, and the next heavier one."""
    b = id_text(benchmark, id_col, text_col).select(F.col("__id").alias("item"), word_hashes(F.col("__text")).alias("h"))
    b = b.where(F.size("h") >= SHINGLE).withColumn("row", F.xxhash64("item", "h")).dropDuplicates(["row"])
    b = b.withColumn("short", F.size("h") < SHORT)
    s = b.select("row", "item", "short", F.explode(F.array_distinct(shingle_hashes(F.col("h")))).alias("s"))
    df = s.groupBy("short", "s").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(b.groupBy("short").agg(F.count(F.lit(1)).alias("all"))), "short")
    df = df.select("short", "s", F.log(1 + F.col("all") / F.col("df")).alias("w"))
    heavy = Window.partitionBy("row").orderBy(F.desc("w"), "s")  # one item's shingles
    s = s.join(df, ["short", "s"]).withColumn("prev", F.lag("s").over(heavy))
    s = s.withColumn("before", F.coalesce(F.sum("w").over(heavy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    return s.withColumn("whole", F.sum("w").over(heavy.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).drop("short")


def item_table(shingles: DataFrame) -> DataFrame:
    """``row, item, whole, classes``: an item's shingles by weight, so that their sum is a few set operations."""
    c = shingles.groupBy("row", "item", "whole", "w").agg(F.collect_list("s").alias("of"))
    return c.groupBy("row", "item", "whole").agg(F.sort_array(F.collect_list(F.struct("w", "of"))).alias("classes"))


def _add3(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Three bits of each of 64 places added at once: their sums and carries."""
    return x.bitwiseXOR(y).bitwiseXOR(z), x.bitwiseAND(y).bitwiseOR(x.bitwiseXOR(y).bitwiseAND(z))


def _add2(x: Column, y: Column) -> tuple[Column, Column]:
    return x.bitwiseXOR(y), x.bitwiseAND(y)


def _over_half(planes: list[Column]) -> Column:
    """Places whose count, in binary digits from the lowest, exceeds half of the ``2 ** (len(planes) - 1)`` counted."""
    *low, half, full = planes
    return full.bitwiseOR(half.bitwiseAND(reduce(Column.bitwiseOR, low)))


def with_prints_at(df: DataFrame, at: str = "i") -> DataFrame:
    """``df`` with the fingerprints ``f5``, ``f8``, ``f16``, ``f32`` of the windows of ``h`` that begin at word ``at`` (words
    beyond the end are 0).  Bits are counted in planes of binary digits, all 64 places at once; each step's
    planes are columns of their own, so that they are computed once."""
    c, kept = F.col, df.columns

    def step(df, drop, **made):
        return df.select(*[x for x in df.columns if x not in drop], *[v.alias(k) for k, v in made.items()])

    def pairs(**sums):  # name=(digit, carry) columns, named by their first and second target
        out = {}
        for names, (digit, carry) in sums.items():
            low, high = names.split("__")
            out[low], out[high] = digit, carry
        return out

    df = step(df, (), **{f"_w{k}": F.coalesce(F.get("h", c(at) + k), F.lit(0).cast("long")) for k in range(SIZES[-1])})
    a0, a1 = _add3(c("_w0"), c("_w1"), c("_w2"))
    df = step(df, (), _s0=a0, _s1=a1)
    df = step(df, ("_s0",), **pairs(_t0___t1=_add3(c("_s0"), c("_w3"), c("_w4"))))
    df = step(df, ("_s1", "_t0", "_t1"), f5=_majority_of_five(c("_t0"), c("_s1"), c("_t1")))
    eights = range(SIZES[-1] // 8)
    one, two, three, four = {}, {}, {}, {}
    for g in eights:
        w = [c(f"_w{8 * g + k}") for k in range(8)]
        one |= pairs(**{f"_a{g}___x{g}": _add3(*w[:3]), f"_b{g}___y{g}": _add3(*w[3:6]), f"_c{g}___z{g}": _add2(*w[6:])})
        two |= pairs(**{f"_p0{g}___d{g}": _add3(c(f"_a{g}"), c(f"_b{g}"), c(f"_c{g}")), f"_e{g}___u{g}": _add3(c(f"_x{g}"), c(f"_y{g}"), c(f"_z{g}"))})
        three |= pairs(**{f"_p1{g}___v{g}": _add2(c(f"_e{g}"), c(f"_d{g}"))})
        four |= pairs(**{f"_p2{g}___p3{g}": _add2(c(f"_u{g}"), c(f"_v{g}"))})
    df = step(df, [f"_w{k}" for k in range(SIZES[-1])], **one)
    df = step(df, [f"_{x}{g}" for x in "abcxyz" for g in eights], **two)
    df = step(df, [f"_{x}{g}" for x in "ed" for g in eights], **three)
    df = step(df, [f"_{x}{g}" for x in "uv" for g in eights], **four)
    parts = [[f"_p{k}{g}" for k in range(4)] for g in eights]
    df = step(df, (), f8=_over_half([c(x) for x in parts[0]]))
    for size in SIZES[1:]:  # counts of neighbours added digit by digit
        sums = [[f"_n{size}_{g}_{k}" for k in range(len(parts[0]) + 1)] for g in range(len(parts) // 2)]
        carry = None
        for k in range(len(parts[0])):
            made = {}
            for g, names in enumerate(sums):
                x, y = c(parts[2 * g][k]), c(parts[2 * g + 1][k])
                last = names[-1] if k == len(parts[0]) - 1 else f"_r{size}_{g}_{k}"
                made[names[k]], made[last] = _add2(x, y) if k == 0 else _add3(x, y, c(carry[g]))
            gone = [p[k] for p in parts] + (carry or [])
            df = step(df, gone, **made)
            carry = [f"_r{size}_{g}_{k}" for g in range(len(sums))]
        parts = sums
        df = step(df, (), **{f"f{size}": _over_half([c(x) for x in parts[0]])})
    return df.select(*kept, *[f"f{m}" for m in (SHINGLE, *SIZES)])


def _majority_of_five(ones: Column, twos: Column, more: Column) -> Column:
    return twos.bitwiseAND(more).bitwiseOR(twos.bitwiseXOR(more).bitwiseAND(ones))


def _block(f: Column, k: int) -> Column:
    return F.shiftrightunsigned(f, 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long"))


def block_keys(f: Column, size: int) -> list[Column]:
    """The four blocks of a fingerprint, with its size and their numbers."""
    first = (SHINGLE, *SIZES).index(size) * (RADIUS + 1)
    return [_block(f, k) + F.lit((first + k) << 16).cast("long") for k in range(RADIUS + 1)]


def _own_print() -> Column:
    """The fingerprint of size ``m``."""
    return reduce(lambda out, m: F.when(F.col("m") == m, F.col(f"f{m}")).otherwise(out), SIZES, F.col(f"f{SHINGLE}"))


def item_windows(benchmark: DataFrame, shingles: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``row, m, at, g, back, size_back, s_back, prev, s``: the windows that propose each item (``shingles``: its ``item_shingles``), with their
    size, place and fingerprint; the distance, size and hash of another that stands for it, if the text has that there too (the one of its size
    before, or the one of the item's size around a shingle); and of a shingle the next heavier one and the hash."""
    b = id_text(benchmark, id_col, text_col).select(F.col("__id").alias("item"), word_hashes(F.col("__text")).alias("h"))
    b = b.where(F.size("h") >= SHINGLE).withColumn("row", F.xxhash64("item", "h")).dropDuplicates(["row"]).withColumn("n", F.size("h"))
    b = b.withColumn("own", reduce(lambda out, m: F.when(F.col("n") >= m, m).otherwise(out), SIZES, F.lit(None).cast("int")))
    at = b.select("row", "h", "n", "own", F.explode(F.sequence(F.lit(0), F.col("n") - SHINGLE)).alias("i"))
    at = at.withColumn("s", F.xxhash64(*[F.get("h", F.col("i") + k) for k in range(SHINGLE)]))
    # one in a thousand more than needed, for rounding errors of sums
    heavy = shingles.where(F.col("before") <= (1 - SIMILARITY + 0.001) * F.col("whole")).select("row", "s", "prev", F.lit(True).alias("heavy"))
    at = at.join(heavy, ["row", "s"], "left").withColumn("nth", F.row_number().over(Window.partitionBy("row", "s").orderBy("i")))  # one item's words
    step, last = F.floor(F.col("own") / 2).cast("int"), F.col("n") - F.col("own")
    probe = F.col("heavy") & (F.col("nth") == 1)
    sized = (F.col("i") <= last) & ((F.col("i") % step == 0) | (F.col("i") == last))
    # the last window of the item's size that begins at or before the shingle; behind the last one's start, that one
    around = F.least(F.col("i") - F.col("i") % step, last)
    at = at.select("row", "h", "i", "own", "prev", F.explode(F.filter(F.array(
        F.when(probe, F.struct(F.lit(SHINGLE).alias("m"), around.alias("other"))),
        F.when(sized, F.struct(F.col("own").alias("m"), F.when(F.col("i") == last, F.floor((last - 1) / step).cast("int") * step).otherwise(F.col("i") - step).alias("other"))),
    ), lambda x: x.isNotNull())).alias("x"))
    at = with_prints_at(at.select("row", "h", "i", "own", "prev", F.col("x.m").alias("m"), F.col("x.other").alias("other")))
    other = F.when(F.col("other") >= 0, F.xxhash64(F.slice("h", F.col("other") + 1, F.col("own"))))
    prev = F.when(F.col("m") == SHINGLE, F.col("prev"))
    return at.select("row", "m", F.col("i").alias("at"), _own_print().alias("g"), (F.col("i") - F.col("other")).alias("back"), F.col("own").alias("size_back"), other.alias("s_back"), prev.alias("prev"), F.when(F.col("m") == SHINGLE, F.xxhash64(F.slice("h", F.col("i") + 1, F.lit(SHINGLE)))).alias("s"))


def proposed(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``docs`` (word hashes ``h``, shingles ``there`` and other columns) with the ``row`` of each item that one of its windows proposes."""
    # an outer generator: of others Spark infers a filter on the array, which it would compute anew below
    last = F.size("h") - SHINGLE
    d = docs.select("*", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("i"))
    keys = [k for m in (SHINGLE, *SIZES) for k in block_keys(F.col(f"f{m}"), m)]
    d = with_prints_at(d).select("*", F.explode_outer(F.array(*keys)).alias("key"))
    own = reduce(lambda out, m: F.when(F.col("m") == m, F.array(*block_keys(F.col("g"), m))).otherwise(out), SIZES, F.array(*block_keys(F.col("g"), SHINGLE)))
    some = windows.select("*", F.posexplode(own).alias("on", "own_key"))
    differ = _own_print().bitwiseXOR(F.col("g"))
    first = reduce(lambda a, k: a & ((F.col("on") <= k) | (_block(differ, k) != 0)), range(RADIUS), F.lit(True))
    # of windows that stand for each other the text's first is enough
    follows = F.when(F.col("i") >= F.col("back"), F.xxhash64(F.slice("h", F.col("i") - F.col("back") + 1, F.col("size_back"))) == F.col("s_back"))
    lighter = F.array_contains(F.coalesce("there", F.array().cast("array<bigint>")), F.col("prev"))  # or Spark infers such a filter from the condition
    # few bits tell the shortest windows apart (three equal words outvote the others): there the words have to agree
    same = F.col("s").isNull() | (F.xxhash64(F.slice("h", F.col("i") + 1, F.lit(SHINGLE))) == F.col("s"))
    near = (F.bit_count(differ) <= RADIUS) & first & same & ~F.coalesce(lighter, F.lit(False)) & ~F.coalesce(follows, F.lit(False))
    return d.join(F.broadcast(some), (F.col("key") == F.col("own_key")) & near).select(*docs.columns, "row")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity`` of each item found."""
    shingles = written(item_shingles(benchmark), "decontam-shingles")
    windows = written(item_windows(benchmark, shingles), "decontam-windows")
    items = item_table(shingles)
    parts = max(1, -(-windows.count() * (RADIUS + 1) // BROADCAST_ROWS))
    d = id_text(docs, id_col, text_col).select(F.col("__id").alias("doc"), word_hashes(F.col("__text")).alias("h"))
    d = d.select("doc", "h", F.array_distinct(shingle_hashes(F.col("h"))).alias("there"))
    there = F.coalesce("there", F.array().cast("array<bigint>"))
    out = []
    for part in range(parts):
        own = F.pmod("row", F.lit(parts)) == part
        met = proposed(d, windows.where(own)).drop("h").join(F.broadcast(items.where(own)), "row")
        both = F.array_intersect(F.flatten(F.transform("classes", lambda x: x["of"])), there)
        met = met.select("doc", "item", "whole", "classes", both.alias("both"))
        found = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x["w"] * F.size(F.array_intersect(x["of"], F.col("both"))))
        # the second use of the array keeps Spark from computing it for each class
        met = met.select("doc", "item", (F.when(F.size("both") > 0, found) / F.col("whole")).alias("similarity"))
        out.append(met.where(F.round("similarity", 9) >= SIMILARITY))  # sums of logarithms end in rounding errors
    pairs = reduce(DataFrame.unionByName, out).groupBy("doc", "item").agg(F.max("similarity").alias("similarity"))
    return pairs.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.round("similarity", 6).alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without documents that hold a passage of ``benchmark``."""
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]), "left_anti").select(*docs.columns)


def op7_decontamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)

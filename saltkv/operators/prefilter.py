"""A Bloom filter of requested prefixes, applied to a table before it is shuffled.

Where the distinct requested keys exceed the broadcast bound, a join moves the whole table although most rows match
nothing.  ``key_filter`` turns the requested prefixes into a bit table by aggregation: every prefix sets ``HASHES`` bits of one word, tasks combine
their bits with ``bit_or``, and the words become one array value of at most ``2 ** MOST_BITS`` bits (16 MB), whatever the number of
requests.  ``prefilter`` reads it as an uncorrelated scalar subquery and tests each row's prefix with integer arithmetic inside the scan's
stage, so only matching rows (and a small share of others) reach the exchange.

A filter never loses a row; the join behind it decides.  The test refers to ``prefix`` alone, so Catalyst moves it
below a newest-wins merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES, BITS_A_KEY = 4, 32
LEAST_BITS, MOST_BITS = 15, 27
#: Words of 64 bits in a page; an array of pages is made in two small steps.
_PAGE = 512


def filter_bits(n_keys: int) -> int:
    """Size exponent of the bit table for so many keys."""
    want = max(1, n_keys * BITS_A_KEY - 1).bit_length()
    return min(MOST_BITS, max(LEAST_BITS, want))


def _place(prefix: Column, bits: int) -> Column:
    """``word, first, mask``: the word of a prefix, one and all of its ``HASHES`` bits there.  The hash is named once: a filter moves below the
    projection that makes the prefix, which is then computed at each mention of it."""
    def place(h):
        at = [F.shiftrightunsigned(h, 32 + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(HASHES)]
        masks = [F.call_function("shiftleft", F.lit(1).cast("long"), x) for x in at]
        return F.struct(h.bitwiseAND(F.lit((1 << (bits - 6)) - 1)).cast("int").alias("word"), at[0].alias("first"), reduce(Column.bitwiseOR, masks).alias("mask"))

    return F.get(F.transform(F.array(F.xxhash64(prefix)), place), F.lit(0))


def key_filter(prefixes: DataFrame, bits: int) -> DataFrame:
    """One row, one column: the bit table as an array of 64-bit words."""
    n_words = (1 << bits) // 64
    marks = prefixes.select(_place(F.col("prefix"), bits).alias("p")).select(F.col("p.word").cast("long").alias("w"), F.col("p.mask").alias("x"))
    # a zero for every word: pages come out whole, and nothing is looked up
    zeros = prefixes.sparkSession.range(n_words).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("x"))
    words = marks.unionByName(zeros).groupBy("w").agg(F.bit_or("x").alias("x"))
    pages = words.groupBy(F.shiftright("w", _PAGE.bit_length() - 1).alias("g")).agg(F.sort_array(F.collect_list(F.struct("w", "x"))).alias("e"))  # _PAGE words
    # at most 2 ** MOST_BITS bits in all: a bounded single value
    pages = pages.select("g", F.col("e")["x"].alias("words")).agg(F.sort_array(F.collect_list(F.struct("g", "words"))).alias("e"))
    return pages.select(F.flatten(F.col("e")["words"]).alias("filter"))


def prefilter(table: DataFrame, prefixes: DataFrame, n_keys: int) -> DataFrame:
    """``table`` without rows whose prefix can't be among the requested ones."""
    bits = filter_bits(n_keys)
    words, place = key_filter(prefixes, bits).scalar(), _place(F.col("prefix"), bits)
    word = F.get(words, place["word"])
    # one bit turns most rows away
    return table.where((F.call_function("getbit", word, place["first"]) == 1) & (place["mask"].bitwiseAND(F.bitwise_not(word)) == 0))

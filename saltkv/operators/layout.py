"""Physical layout of a load: salt partitions, in-partition key order, dedup.

Two ways to place rows:

* ``partition_by_salt`` is the exact salt partitioner: partition *i* holds salt
  *i* (one task per salt, rows sorted by row key).  It is the parity operator,
  and it is right when every salt is small.
* ``cluster_for_write`` is the default for loads.  It range-partitions on
  ``(salt, row_key)``: into ``n * files_per_bucket`` ranges when the input
  size is known, else into ranges that AQE coalesces by size.  Spark samples
  the keys to set the bounds, so work spreads over many tasks even when one
  query key holds a third of all rows: its row keys differ by the unique
  column, and the bounds fall inside the hot key's range.  Every file is
  still sorted by row key and lies inside one salt directory.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_COLS = ("salt", "prefix", "row_key")


def partition_by_salt(df: DataFrame, n: int, salt_col: str = "salt", per_salt: int = 1, key: str = "row_key") -> DataFrame:
    """Salt *i* goes to partition *i*; a NULL salt goes to partition 0.

    ``repartitionById`` places a row by the value of an int expression without
    hashing it.  A salt >= n would wrap modulo n; salts are built < n.

    ``per_salt=k`` splits every salt over ``k`` partitions: salt *i* owns
    partitions ``i*k .. i*k+k-1`` and a row picks one by the hash of its row
    key.  ``k=1`` is the exact one-task-per-salt partitioner; ``k>1`` keeps a
    hot salt (or a hot query key inside it, whose row keys differ) off a
    single task.
    """
    s = F.coalesce(F.col(salt_col), F.lit(0))
    if per_salt <= 1:
        return df.repartitionById(n, s)
    sub = F.pmod(F.xxhash64(F.col(key)), F.lit(per_salt))
    return df.repartitionById(n * per_salt, (s * F.lit(per_salt) + sub).cast("int"))


def salt_from_row_key(row_key: str = "row_key", width: int = 1):
    """Salt of a bare row key: its leading ``width`` characters as int."""
    return F.substring(F.col(row_key), 1, width).cast("int")


def sort_within(df: DataFrame, cells: bool = False) -> DataFrame:
    """Sort every partition by ``(salt, row_key[, qualifier])``.

    ``salt`` leads so that a later ``write.partitionBy("salt")`` finds its
    required order already satisfied and keeps the row-key order in the files.
    Strings compare as UTF-8 bytes, the store's own order.
    """
    keys = ["salt", "row_key"] + (["qualifier"] if cells else [])
    return df.sortWithinPartitions(*keys)


def java_order(c: str):
    """A binary column that sorts like Java compares strings: by UTF-16 code units.

    Byte order (the default everywhere) is code point order.  They differ where a supplementary
    character (a surrogate pair, units D800-DFFF) meets one of U+E000-U+FFFF.
    """
    return F.encode(F.col(c), "UTF-16BE")


def sort_within_java(df: DataFrame, cells: bool = False) -> DataFrame:
    """``sort_within`` in Java's string order."""
    keys = ["row_key"] + (["qualifier"] if cells else [])
    return df.sortWithinPartitions("salt", *[java_order(k) for k in keys])


# Inputs with at least this many partitions are never spread: their map stage
# is already parallel, and an extra full shuffle would cost more than it saves.
SPREAD_BELOW_PARTITIONS = 64


def spread_small_input(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an input that arrives in very few partitions (one
    unsplittable file, one Parquet row group, a tiny batch), so the per-row
    key work is not done by one or two tasks.

    Only inputs with fewer than ``min(cores, 64)`` partitions are spread: on a
    large cluster a 100 GB batch in 400 splits is already parallel and passes
    through unchanged.  Round-robin with Spark's sort-before-repartition is
    deterministic, so a retried task sends every row to the same place.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    target = min_partitions or cores
    if df.rdd.getNumPartitions() >= min(target, SPREAD_BELOW_PARTITIONS):
        return df
    return df.repartition(target)


# Input bytes per written file when the input size is known.  A task sorts what it
# writes, and keyed rows take about eight times their text in memory.
TARGET_INPUT_BYTES_PER_FILE = 64 * 1024 * 1024
# Rows of a written file, where a load's sketches count them.
MOST_ROWS_PER_FILE = 1_500_000


def files_per_bucket_for(spark, n: int, input_bytes: int | None = None) -> int:
    """Default tasks per salt.

    With a known input size: enough tasks that each handles about
    ``TARGET_INPUT_BYTES_PER_FILE``, so file count follows data volume.
    Otherwise: ``spark.sql.shuffle.partitions`` tasks in total.
    """
    if input_bytes is not None:
        return max(1, math.ceil(input_bytes / TARGET_INPUT_BYTES_PER_FILE / n))
    total = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, math.ceil(total / n))


def cluster_for_write(df: DataFrame, n: int, files_per_bucket: int | None = None, cells: bool = False) -> DataFrame:
    """Range-partition on ``(salt, row_key)`` and sort each partition.

    ``files_per_bucket=k`` fixes ``n * k`` ranges (the load job derives ``k``
    from the batch's size on disk).  Without it the range exchange uses
    ``spark.sql.shuffle.partitions`` ranges and AQE merges adjacent small
    ones up to the advisory partition size, so file count follows data
    volume; merged ranges stay contiguous, so every file is still one sorted
    key range.
    """
    keys = ["salt", "row_key"] + (["qualifier"] if cells else [])
    if files_per_bucket:
        out = df.repartitionByRange(n * files_per_bucket, *keys)
    else:
        out = df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def dedup_in_load(df: DataFrame, value_cols, keys=KEY_COLS) -> DataFrame:
    """One row per row key: the copy whose ``value_cols`` struct is largest.

    Which copy wins is undefined in a key/value store when a load repeats a
    key; this picks a deterministic one.  ``max`` is combinable, so Spark
    aggregates partially before the shuffle and a key repeated a million times
    moves as one row per map task.
    """
    value_cols = [c for c in value_cols if c not in keys]
    w = F.max(F.struct(*[F.col(c) for c in value_cols])).alias("__w")
    out = [F.col("__w")[c].alias(c) for c in value_cols]
    if tuple(keys) != KEY_COLS:
        return df.groupBy(*keys).agg(w).select(*keys, *out)
    # a row key begins with its prefix: only what follows moves, and (salt, prefix, rest) stands for the three
    led = F.coalesce(F.col("row_key").startswith(F.col("prefix")), F.lit(False))
    rest = F.when(led, F.expr("substring(row_key, length(prefix) + 1)")).otherwise(F.col("row_key"))
    moved = df.select("salt", "prefix", led.alias("__led"), rest.alias("__rest"), *value_cols).groupBy("salt", "prefix", "__led", "__rest").agg(w)
    row_key = F.when(F.col("__led"), F.concat("prefix", "__rest")).otherwise(F.col("__rest"))
    return moved.select("salt", "prefix", row_key.alias("row_key"), *out)


def rank_within_salt(df: DataFrame, n: int, files_per_bucket: int | None = None, name: str = "rank_in_salt") -> DataFrame:
    """1-based position of every row inside its salt, in row-key byte order:
    the order a scan of one salt returns.

    No salt passes through one task.  The rows are range-partitioned on
    ``(salt, row_key)`` and sorted inside each partition; the layout is pinned
    with a reliable checkpoint in the shared folder (range bounds sampled
    from a shuffled input need not repeat between passes).  Then the rows per
    (partition, salt) are counted into a table bounded by the partition count,
    each partition's offset inside its salt is summed from it, and the rank
    is that offset plus the position inside the partition.
    """
    from pyspark.sql import Window

    from ..session import checkpoint_root

    checkpoint_root(df.sparkSession)
    laid = cluster_for_write(df, n, files_per_bucket)
    pinned = laid.select("*", F.spark_partition_id().alias("__p"), partition_ordinal().alias("__o")).checkpoint(eager=True)
    counts = pinned.groupBy("__p", "salt").agg(F.count(F.lit(1)).alias("__c"), F.min("__o").alias("__first"))
    before = Window.partitionBy("salt").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", "salt", "__first", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"))
    # At most (#partitions + #salts) rows: a proven bound, so it is broadcast.
    ranked = pinned.join(F.broadcast(offsets), ["__p", "salt"])
    rank = (F.col("__off") + F.col("__o") - F.col("__first") + 1).cast("long").alias(name)
    return ranked.select(*[c for c in df.columns], rank)


def partition_ordinal() -> "F.Column":
    """1-based position of a row inside its partition, in the partition's order.

    ``monotonically_increasing_id`` packs the partition id into the upper bits
    and the row index into the lower 33 bits.
    """
    return (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")

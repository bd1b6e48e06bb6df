"""The newest state of a table as one merged copy, kept by upserts.

::

    <table>/_merged/salt=<i>/slice=<hex>/part-*.parquet

``upsert_loads`` folds published loads into the copy: the partitions that their rows touch are read, merged and written back with
Spark's dynamic partition overwrite; all others stay as they are.  Every value column has the version it was written under beside it
(``<column>__v``), so a merge is the newest (version, value) pair of each column, whatever the order of the loads: a late
load under an older version fills only what no newer load wrote, and merging a load twice changes nothing.

Slices.  A salt is divided by the first ``slice_digits`` hex digits of the key's hash (16 ** digits slices; none by default), so that a small load
into a large table rewrites small partitions.  The number of partitions is bounded by salts x slices, and so is the list of touched ones that comes to the driver.

Recovery.  The loads remain the truth.  The overwrite replaces one partition directory after another when all tasks have
finished; if the driver is lost in between, the same ``upsert_loads`` is run again (``rebuild=True`` starts from every load).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.keys import salt_width
from ..operators.layout import KEY_COLS, files_per_bucket_for
from .sketches import expected_keys, table_sketches
from .spec import TableSpec
from .store import VERSION, _fs, _load_dirs, _unique_keys, input_bytes, list_loads, read_loads, table_columns, write_options

SLICE = "slice"
#: Stored bytes for which a file of its own is worth a task.
LEAST_BYTES = 8 << 20
_V = "__v"


def merged_dir(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/_merged"


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """``salt=<i>/slice=<hex>`` directories below ``path`` (a listing; at most salts x slices)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        if s.isDirectory() and s.getPath().getName().startswith("salt="):
            out += [f"{s.getPath().getName()}/{x.getPath().getName()}" for x in fs.listStatus(s.getPath()) if x.isDirectory() and x.getPath().getName().startswith(f"{SLICE}=")]
    return sorted(out)


def _schema(cols) -> StructType:
    s = [StructField(c, StringType()) for c in cols] + [StructField(f"{c}{_V}", LongType()) for c in cols]
    return StructType([*s, StructField("prefix", StringType()), StructField("row_key", StringType()), StructField(VERSION, LongType())])


def _read(spark: SparkSession, path: str, parts: list[str], cols) -> DataFrame:
    schema = StructType([*_schema(cols).fields, *StructType.fromDDL(f"salt int, {SLICE} string").fields])
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{p}" for p in parts])


def _folded(rows: DataFrame, cols) -> DataFrame:
    """Per key and column the newest (version, value) pair: combinable, in any order, any number of times."""
    best = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}{_V}").alias("v"), F.col(c).alias("x")))).alias(c) for c in cols]
    g = rows.groupBy("salt", SLICE, "row_key", "prefix").agg(*best, F.max(VERSION).alias(VERSION))
    return g.select(*[F.col(c)["x"].alias(c) for c in cols], *[F.col(c)["v"].alias(f"{c}{_V}") for c in cols], "prefix", "row_key", VERSION, "salt", SLICE)


def folded_in_ranges(rows: DataFrame, cols, n: int) -> DataFrame:
    """``_folded`` rows in ``n`` ranges of keys, each in key order: rows move once and are folded where they are written."""
    return _folded(rows.repartitionByRange(n, "salt", "row_key"), cols).sortWithinPartitions("salt", SLICE, "row_key")


def upsert_loads(
    spark: SparkSession,
    spec: TableSpec,
    table_dir: str,
    loads: list[int] | None = None,
    slice_digits: int = 0,
    rebuild: bool = False,
    bloom_filter: bool = False,
) -> list[str]:
    """Fold published loads (default: all) into the merged copy; returns the partitions it wrote.
    ``bloom_filter`` writes filters on ``prefix``, sized by the merged sketches of all the table's loads.
    ``slice_digits`` must stay the same for a table; ``rebuild`` ignores what the copy holds."""
    loads = list_loads(spark, table_dir) if loads is None or rebuild else sorted(loads)
    path, cols = merged_dir(table_dir), table_columns(spark, table_dir, spec.cols)
    if not loads:
        return []
    w = salt_width(spec.pre_regions)
    new = read_loads(spark, table_dir, cols, loads)
    new = new.withColumn(SLICE, F.concat(F.lit("h"), F.substring("prefix", w + 1, slice_digits)))
    new = new.select(*cols, *[F.when(F.col(c).isNotNull(), F.col(VERSION)).alias(f"{c}{_V}") for c in cols], "prefix", "row_key", VERSION, "salt", SLICE)
    touched = [f"salt={r.salt}/{SLICE}={r[SLICE]}" for r in new.select("salt", SLICE).distinct().collect()]
    there = set() if rebuild else set(_partitions(spark, path))
    old = _read(spark, path, sorted(there & set(touched)), cols)
    size = sum(input_bytes(spark, f"{table_dir.rstrip('/')}/{VERSION}={t}") for t in loads) + sum(input_bytes(spark, f"{path}/{p}") for p in there & set(touched))
    # while there are fewer files than cores, smaller ones
    per_salt = files_per_bucket_for(spark, spec.pre_regions, size)
    per_salt = max(per_salt, math.ceil(min(spark.sparkContext.defaultParallelism, size / LEAST_BYTES) / spec.pre_regions))
    both = old.unionByName(new)
    if not _unique_keys(spark, _load_dirs(table_dir, loads)):
        both = _folded(both, cols)  # a key may have any number of rows: fewer move
    laid = folded_in_ranges(both, cols, spec.pre_regions * per_salt)
    # rows of repeated loads are folded together, so the number of files bounds nothing here: the largest slice does
    ndv = expected_keys(table_sketches(spark, table_dir), slices=16**slice_digits) if bloom_filter else None
    w = laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**write_options(bloom_filter, ndv))
    w.partitionBy("salt", SLICE).parquet(path)
    return sorted(touched)


def merged(spark: SparkSession, table_dir: str, value_cols=None) -> DataFrame:
    """The merged copy in ``current``'s columns: no shuffle, salt and prefix filters reach the scan."""
    cols = list(value_cols) if value_cols is not None else table_columns(spark, table_dir)
    path = merged_dir(table_dir)
    fs, p = _fs(spark, path)
    schema = StructType([*_schema(cols).fields, *StructType.fromDDL(f"salt int, {SLICE} string").fields])
    df = spark.read.schema(schema).parquet(path) if fs.exists(p) else spark.createDataFrame([], schema)
    return df.select(*KEY_COLS, *cols, VERSION)

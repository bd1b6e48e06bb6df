"""Sketches of a load's prefixes: how many keys a Bloom filter has to hold, without counting them.

::

    <table>/load_ts=<millis>/_sketch/part-*.parquet         salt, sketch, n_rows

A load written with Bloom filters carries one HyperLogLog sketch of its distinct prefixes for each salt.  Sketches of several loads merge
by union, so a key that many loads write counts once, and the table's number of keys is known without reading its rows.  A load that has no
sketch is counted from its ``prefix`` column when it is asked for.

Scale.  Every task folds its rows into a sketch for each salt (4 KB each, whatever the number of rows) before the shuffle; a table of them has at
most as many rows as salts.  A load pays one more pass over its key columns, a merged copy none.

Defined cases.  An empty load has no sketch rows and expects no keys.  A null salt is salt 0, as in the layout.  Rows without a prefix aren't counted.
Estimates are within about 2 % (one standard error at ``LG_K``), and exact for a few keys.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import MOST_ROWS_PER_FILE
from .store import VERSION, _fs, list_loads, read_loads, rename

SKETCH = "_sketch"
LG_K = 12
#: Rows of a range-partitioned file against the mean: range bounds are sampled.
SLACK = 1.5
_SCHEMA = "salt int, sketch binary, n_rows long"


def prefix_sketches(keyed: DataFrame) -> DataFrame:
    """``salt, sketch, n_rows`` of keyed rows."""
    g = keyed.groupBy(F.coalesce("salt", F.lit(0)).alias("salt"))
    return g.agg(F.hll_sketch_agg("prefix", F.lit(LG_K)).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def stage_sketches(spark: SparkSession, keyed: DataFrame, stage_dir: str) -> DataFrame:
    """The sketches of a load that is about to be staged, written beside its staging directory."""
    path = f"{stage_dir.rstrip('/')}{SKETCH}"
    prefix_sketches(keyed).coalesce(1).write.mode("errorifexists").parquet(path)  # at most a row for each salt
    return spark.read.schema(_SCHEMA).parquet(path)


def attach_sketches(spark: SparkSession, stage_dir: str) -> None:
    """Move staged sketches into the staged load, so that one rename publishes both."""
    rename(spark, f"{stage_dir.rstrip('/')}{SKETCH}", f"{stage_dir.rstrip('/')}/{SKETCH}")


def table_sketches(spark: SparkSession, table_dir: str, loads: list[int] | None = None) -> DataFrame:
    """``salt, sketch, n_rows, n_prefixes`` of the table (or of the given loads): the loads' sketches merged, ``n_rows`` the
    sum over the loads, ``n_prefixes`` the estimated number of distinct prefixes."""
    loads = list_loads(spark, table_dir) if loads is None else loads
    own, without = [], []
    for ts in loads:
        path = f"{table_dir.rstrip('/')}/{VERSION}={ts}/{SKETCH}"
        fs, p = _fs(spark, path)
        if fs.exists(p):
            own.append(path)
        else:
            without.append(ts)
    s = spark.read.schema(_SCHEMA).parquet(*own) if own else spark.createDataFrame([], _SCHEMA)
    if without:
        s = s.unionByName(prefix_sketches(read_loads(spark, table_dir, [], without)))
    merged = s.groupBy("salt").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"))
    return merged.withColumn("n_prefixes", F.hll_sketch_estimate("sketch"))


def files_for_rows(sketches: DataFrame, n: int) -> int:
    """Files of each salt that keep a file of the load at ``MOST_ROWS_PER_FILE`` rows."""
    return max(1, math.ceil((sketches.agg(F.sum("n_rows")).first()[0] or 0) / n / MOST_ROWS_PER_FILE))


def expected_keys(sketches: DataFrame, n_files: int | None = None, slices: int = 1) -> int:
    """Distinct prefixes to expect in one file: no more than the largest salt (or slice of it) has, and, where the rows are dealt over
    ``n_files`` ranges, no more than the rows of one.  A wrong guess costs space or false positives, never a row."""
    s = sketches.agg(
        F.max(F.hll_sketch_estimate("sketch")).alias("most"),
        F.sum("n_rows").alias("rows"),
    ).first()
    most = math.ceil((s["most"] or 0) / slices)
    if n_files and n_files > 0:
        most = min(most, math.ceil(SLACK * (s["rows"] or 0) / n_files))
    return max(1, most)

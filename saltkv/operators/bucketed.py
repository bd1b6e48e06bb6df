"""A bucketed copy of a table, for batch lookups that meet it without moving it.

``bucket_table`` writes the newest-wins rows once, hash-distributed into a fixed number of buckets by the
key prefix and sorted inside each (Spark's own bucketing, ``bucketBy`` / ``sortBy``).  ``batch_lookup_bucketed``
deals only the *requests* the same way and joins bucket by bucket: the plan has an exchange on the requests' side and
none on the table's, however many keys are asked for.

Skew.  Rows of one key would share a bucket.  When the copy is written, keys with ``hot_rows`` rows or more (the largest
``MOST_HOT`` of them, so the set may be broadcast) are dealt over ``fan`` buckets: the bucket column ``bkey`` is the prefix, or the
prefix with a number for a hot key.  The hot prefixes are kept beside the table (``<name>_hot``), and a request for one asks for each of its numbers.
Requests that repeat a key many times are combined first: the join sees each asked ``bkey`` once, and the
matched rows fan out to the requests by ``salted_join``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.spec import TableSpec
from .lookup import project_fields, request_keys
from .skew import FAN, HOT_ROWS, MOST_HOT, salted_join

BUCKET = "bkey"


def _numbered(prefix, number):
    return F.concat(prefix, F.lit("~"), number.cast("string"))


def bucket_table(
    spark: SparkSession,
    table: DataFrame,
    name: str,
    location: str,
    buckets: int,
    hot_rows: int = HOT_ROWS,
    fan: int = FAN,
) -> str:
    """Write ``table`` (salt, prefix, row_key and value columns) as the catalog table ``name`` in ``buckets``
    buckets below ``location``; one sorted file a bucket."""
    hot = table.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= hot_rows)
    hot = hot.orderBy(F.desc("n_rows"), "prefix").limit(MOST_HOT)
    hot.write.mode("overwrite").option("path", f"{location.rstrip('/')}/hot").saveAsTable(f"{name}_hot")
    hot = spark.table(f"{name}_hot").select("prefix", F.lit(True).alias("__hot"))
    number = F.pmod(F.xxhash64("row_key"), F.lit(fan))
    keyed = table.join(F.broadcast(hot), "prefix", "left")
    keyed = keyed.withColumn(BUCKET, F.when(F.col("__hot"), _numbered(F.col("prefix"), number)).otherwise(F.col("prefix"))).drop("__hot")
    (
        keyed.repartition(buckets, BUCKET)  # the hash that bucketing uses: a task is a bucket
        .write.mode("overwrite")
        .bucketBy(buckets, BUCKET)
        .sortBy(BUCKET, "row_key")
        .option("path", f"{location.rstrip('/')}/rows")
        .saveAsTable(name)
    )
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('saltkv.fan' = '{fan}')")
    return name


def _fan(spark: SparkSession, name: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('saltkv.fan')").first()["value"])


def asked_buckets(spark: SparkSession, name: str, prefixes: DataFrame) -> DataFrame:
    """``bkey, prefix`` for distinct prefixes: one row, or one for each number of a hot key."""
    hot = spark.table(f"{name}_hot").select("prefix", F.lit(True).alias("__hot"))
    every = F.transform(F.sequence(F.lit(0), F.lit(_fan(spark, name) - 1)), lambda i: _numbered(F.col("prefix"), i))
    asked = prefixes.select("prefix").distinct().join(F.broadcast(hot), "prefix", "left")
    return asked.select(F.explode(F.when(F.col("__hot"), every).otherwise(F.array("prefix"))).alias(BUCKET))


def matched_rows(spark: SparkSession, name: str, prefixes: DataFrame) -> DataFrame:
    """The table's rows for a table of prefixes; the table's side is read bucket by bucket, without an exchange."""
    return spark.table(name).join(asked_buckets(spark, name, prefixes), BUCKET, "left_semi")


def batch_lookup_bucketed(
    spark: SparkSession,
    name: str,
    spec: TableSpec,
    requests: DataFrame,
    req_id: str = "req_id",
    key_cols: Sequence[str] | None = None,
    fields: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``batch_lookup`` on a bucketed copy: one row per (request, matching row).  Requests
    with a NULL single key match nothing."""
    key_cols = list(key_cols or spec.query_key)
    fields = list(fields or spec.result_fields() or spec.cols)
    req = request_keys(requests.select(req_id, *key_cols), spec, key_cols).where(~F.col("__bad")).select(F.col(req_id).alias("__req"), "prefix")
    rows = matched_rows(spark, name, req).drop(BUCKET)
    met = salted_join(rows, req, ["prefix"], "row_key", "__req", hot_rows=hot_rows)
    return project_fields(met.withColumnRenamed("__req", req_id), fields, keep=[req_id, "row_key"], check=False)


def lookup_bucketed(spark: SparkSession, name: str, spec: TableSpec, key, fields: Sequence[str] | None = None) -> DataFrame:
    """Point lookup: the literal bucket keys prune the scan to their buckets."""
    from .lookup import key_literals

    _, prefix, _ = key_literals(spec, key)
    fields = list(fields or spec.result_fields() or spec.cols)
    keys = [prefix]
    if spark.table(f"{name}_hot").where(F.col("prefix") == prefix).limit(1).count():
        keys = [f"{prefix}~{i}" for i in range(_fan(spark, name))]
    rows = spark.table(name).where(F.col(BUCKET).isin(keys))
    return project_fields(rows, fields, keep=["row_key"], check=False).orderBy("row_key")

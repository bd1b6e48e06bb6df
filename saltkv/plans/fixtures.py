"""Table layouts built from the driver's parquet tables (see FIXTURES.md).

Each function reads whole tables from ``sf_dir`` and returns an all-string
DataFrame in the layout's column order, ready to be keyed, exported as a
delimited batch, or loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.spec import TableSpec


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str):
    return F.col(c).cast("string")


CHECK = TableSpec(
    table_name="check", namespace="keyspace", uniq_col="id", pre_regions=3,
    query_key=("check_id",), cols=("id", "check_id", "rule_no", "rule_type", "rule_desc"),
)
OPINION = TableSpec(
    table_name="opinion", namespace="keyspace", uniq_col="id", pre_regions=3,
    query_key=("buss_no", "business_type"), cols=("id", "buss_no", "business_type", "approval_opinion"),
)
COLLISION = TableSpec(
    table_name="collision", namespace="keyspace", uniq_col="id", pre_regions=3,
    query_key=("k1", "k2"), cols=("id", "k1", "k2", "name"),
)
DUPLICATES = TableSpec(
    table_name="duplicates", namespace="keyspace", uniq_col="id", pre_regions=3,
    query_key=("key",), cols=("id", "key", "partkey", "suppkey", "returnflag", "linestatus", "shipdate"),
)
MULTILINE = TableSpec(
    table_name="multiline", namespace="keyspace", uniq_col="id", pre_regions=3,
    query_key=("key",), cols=("id", "key", "lang", "value"),
)


def check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> check: one row per order, keyed by customer."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        _s("o_orderkey").alias("id"),
        _s("o_custkey").alias("check_id"),
        F.col("o_orderpriority").alias("rule_no"),
        F.col("o_orderstatus").alias("rule_type"),
        F.col("o_orderdate").cast("date").cast("string").alias("rule_desc"),
    )


def opinion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> opinion: one row per turn, keyed by (conversation, role)."""
    c = read(spark, sf_dir, "conversations")
    return c.select(
        F.concat(_s("conv_id"), F.lit("-"), _s("turn")).alias("id"),
        _s("conv_id").alias("buss_no"),
        F.col("role").alias("business_type"),
        F.col("text").alias("approval_opinion"),
    )


def opinion_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> opinion: one row per event, keyed by (user, event type)."""
    e = read(spark, sf_dir, "events")
    return e.select(
        _s("event_id").alias("id"),
        _s("user_id").alias("buss_no"),
        F.col("event_type").alias("business_type"),
        F.col("props").alias("approval_opinion"),
    )


def collision_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> composite key (custkey, nationkey), whose concatenation collides."""
    c = read(spark, sf_dir, "customer")
    return c.select(_s("c_custkey").alias("id"), _s("c_custkey").alias("k1"), _s("c_nationkey").alias("k2"), F.col("c_name").alias("name"))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> rows whose id (order-line) repeats inside one load."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("id"),
        _s("l_orderkey").alias("key"),
        _s("l_partkey").alias("partkey"),
        _s("l_suppkey").alias("suppkey"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("l_shipdate").cast("date").cast("string").alias("shipdate"),
    )


def multiline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> whole multi-line texts as values."""
    d = read(spark, sf_dir, "documents")
    return d.select(_s("doc_id").alias("id"), F.col("source").alias("key"), F.col("lang"), F.col("text").alias("value"))


def check_loads(spark: SparkSession, sf_dir: str, n_loads: int = 3) -> list[DataFrame]:
    """Three loads of ``check``: all rows; every 3rd order with a new rule_type
    (rule_desc unwritten, or written empty for even orders); every 5th order
    with an added ``remarks`` column."""
    base = check_rows(spark, sf_dir)
    k = F.col("id").cast("long")
    load1 = base.withColumn("remarks", F.lit(None).cast("string"))
    load2 = base.where(k % 3 == 0).select(
        "id", "check_id",
        F.lit(None).cast("string").alias("rule_no"),
        F.concat(F.lower("rule_type"), F.lit("2")).alias("rule_type"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit(None).cast("string")).alias("rule_desc"),
        F.lit(None).cast("string").alias("remarks"),
    )
    load3 = base.where(k % 5 == 0).select(
        "id", "check_id",
        *[F.lit(None).cast("string").alias(c) for c in ("rule_no", "rule_type", "rule_desc")],
        F.concat(F.lit("r"), F.col("id")).alias("remarks"),
    )
    return [load1, load2, load3][:n_loads]

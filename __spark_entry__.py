"""

Every registered query reads whole tables from ``sf_dir`` (or data Spark
derives from them) and returns a flat DataFrame.  ``oracle_sql()`` holds the
recomputed there with a DuckDB form of Java's string hash.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package lives next to this file; make it importable from any cwd.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltkv.functions.keys import add_row_keys
from saltkv.operators import bucketed as BK
from saltkv.operators import cells as C
from saltkv.operators import layout as L
from saltkv.operators import lookup as LK
from saltkv.operators.merge import latest_wins
from saltkv.operators.ranges import scan_ranges
from saltkv.plans import fixtures as FX
from saltkv.plans import job as J
from saltkv.plans import sql_functions as SQLF
from saltkv.plans.job import load_batch, load_rows
from saltkv.session import scratch_path
from saltkv.sources import delimited as D
from saltkv.sources import merged as MG
from saltkv.sources import sketches as SK
from saltkv.sources import store as ST
from saltkv.sources.spec import CHECK_FIELDS, OPINION_FIELDS

SF_SMOKE = "/root/testdata/sf0.001"


# ============================================================ Spark queries


def _keyed(df: DataFrame, spec, n: int | None = None) -> DataFrame:
    return add_row_keys(df, spec.query_key, spec.uniq_col, n or spec.pre_regions)


def check_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(FX.check_rows(spark, sf_dir), FX.CHECK)


def q_row_keys(spark, sf_dir, n=3):
    t = _keyed(FX.check_rows(spark, sf_dir), FX.CHECK, n)
    return t.select("id", "check_id", "salt", "prefix", "row_key")


def q_row_keys_mod10(spark, sf_dir):
    return q_row_keys(spark, sf_dir, 10)


def q_row_keys_mod12(spark, sf_dir):
    return q_row_keys(spark, sf_dir, 12)


def q_composite_row_keys(spark, sf_dir):
    t = _keyed(FX.opinion_rows(spark, sf_dir), FX.OPINION)
    return t.select("id", "buss_no", "business_type", "salt", "prefix", "row_key")


def q_document_row_keys(spark, sf_dir):
    """The whole document text is the query key (long, multi-line, non-ASCII)."""
    spec = FX.MULTILINE.with_(query_key=("value",))
    t = _keyed(FX.multiline_rows(spark, sf_dir), spec, 10)
    return t.select("id", "salt", "prefix", "row_key")


def q_opinion_wide_row_keys(spark, sf_dir):
    t = _keyed(FX.opinion_wide_rows(spark, sf_dir), FX.OPINION)
    return t.select("id", "buss_no", "business_type", "salt", "prefix", "row_key")


# ------------------------------------------------------------ delimited text

SEP = D.COL_SEP


def _export(spark, df, name, cols=None, check=True) -> str:
    path = scratch_path(spark, name)
    D.write_delimited(df, path, cols, check=check)
    return path


def q_delimited_roundtrip(spark, sf_dir):
    """documents -> delimited text (0x10 records, 0x01 fields) -> parsed rows."""
    path = _export(spark, FX.multiline_rows(spark, sf_dir), "in-multiline")
    return D.read_batch(spark, FX.MULTILINE, path=path).rows


def q_delimited_failfast(spark, sf_dir):
    path = _export(spark, FX.check_rows(spark, sf_dir), "in-check-ff")
    return D.read_batch(spark, FX.CHECK, path=path, mode="failfast").rows


def _short_every_7th(spark, sf_dir) -> str:
    base = FX.check_rows(spark, sf_dir)
    k = F.col("id").cast("long")
    full = F.concat_ws(SEP, *[F.col(c) for c in FX.CHECK.cols])
    short = F.concat_ws(SEP, "id", "check_id", "rule_no")
    lines = base.select(F.when(k % 7 == 0, short).otherwise(full).alias("line"))
    return _export(spark, lines, "in-check-short", ["line"], check=False)


def q_parsed_rows(spark, sf_dir):
    """Permissive parse of a batch where every 7th record is cut short: the rest."""
    return D.read_batch(spark, FX.CHECK, path=_short_every_7th(spark, sf_dir)).rows


def q_rejected_rows(spark, sf_dir):
    """... and the short records, with their field counts."""
    rej = D.read_batch(spark, FX.CHECK, path=_short_every_7th(spark, sf_dir)).rejected
    return rej.select(F.split(F.col("value"), SEP).getItem(0).alias("id"), "n_fields")


# ------------------------------------------------------------ layout


def q_salt_partition_counts(spark, sf_dir):
    """The exact salt partitioner on the table's rows: where each salt's rows landed."""
    placed = L.partition_by_salt(check_table(spark, sf_dir).select("salt", "row_key"), FX.CHECK.pre_regions)
    return placed.select(F.spark_partition_id().alias("partition_id"), "salt").groupBy("partition_id", "salt").agg(F.count(F.lit(1)).alias("n_rows"))


def q_key_fallbacks(spark, sf_dir):
    """Rows without a salt go to partition 0, bare row keys by the salt they begin with."""
    k = F.col("id").cast("long")
    t = check_table(spark, sf_dir).select("id", "row_key", "salt")
    bare = L.salt_from_row_key("row_key", 1)
    t = t.withColumn("salt", F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, bare).otherwise(F.col("salt")).cast("int"))
    return L.partition_by_salt(t, FX.CHECK.pre_regions).select("id", "salt", F.spark_partition_id().alias("partition_id"))


def q_salt_subpartition_counts(spark, sf_dir):
    """Each salt split over k partitions (k from the session's shuffle
    partitions): every row lands in a partition its salt owns."""
    n = FX.CHECK.pre_regions
    k = L.files_per_bucket_for(spark, n)
    t = L.partition_by_salt(check_table(spark, sf_dir), n, per_salt=k)
    placed = (F.floor(F.spark_partition_id() / F.lit(k)) == F.col("salt")).cast("int")
    return t.select("salt", placed.alias("__ok")).groupBy("salt").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.sum("__ok")).alias("n_misplaced")
    )


def q_partition_sorted_rank(spark, sf_dir):
    """Position of each row inside its salt in row-key order, computed without
    routing a salt through one task."""
    t = check_table(spark, sf_dir).select("salt", "row_key", "id")
    return L.rank_within_salt(t, FX.CHECK.pre_regions)


def q_dedup_in_load(spark, sf_dir):
    t = _keyed(FX.duplicate_rows(spark, sf_dir), FX.DUPLICATES)
    return L.dedup_in_load(t, FX.DUPLICATES.cols)


# ------------------------------------------------------------ cells


def q_to_cells(spark, sf_dir):
    return C.to_cells(check_table(spark, sf_dir), FX.CHECK.cols, FX.CHECK.cf)


def q_from_cells(spark, sf_dir):
    cells = C.to_cells(check_table(spark, sf_dir), FX.CHECK.cols, FX.CHECK.cf)
    return C.from_cells(cells, CHECK_FIELDS, family=FX.CHECK.cf)


def q_binary_cells_roundtrip(spark, sf_dir):
    cells = C.to_cells(FX.opinion_rows(spark, sf_dir).transform(lambda d: _keyed(d, FX.OPINION)), FX.OPINION.cols)
    back = C.from_binary_cells(C.to_binary_cells(cells))
    return C.from_cells(back, OPINION_FIELDS)


def q_cells_open(spark, sf_dir):
    """Cells with qualifiers that no schema declares: a customer's orders by month, and the
    declared ``status``; the newest order of a cell wins."""
    o = FX.read(spark, sf_dir, "orders")
    who = F.col("o_custkey").cast("string").alias("row_key")
    month = o.select(who, F.concat(F.lit("m"), F.month("o_orderdate")).alias("qualifier"), F.col("o_orderpriority").alias("value"), F.col("o_orderkey").alias("v"))
    status = o.select(who, F.lit("status").alias("qualifier"), F.col("o_orderstatus").alias("value"), F.col("o_orderkey").alias("v"))
    rows = C.from_cells_open(month.unionByName(status), ["status", "never"], version="v")
    pairs = F.transform(F.map_entries("others"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("row_key", "status", "never", F.array_join(F.array_sort(pairs), ",").alias("others"))


def q_java_order_rank(spark, sf_dir):
    """Positions of the documents' first lines in Java's string order, with characters on both sides of the surrogates."""
    d = FX.read(spark, sf_dir, "documents")
    i = F.col("doc_id") % 4
    lead = F.when(i == 0, F.lit("\U0001F600")).when(i == 1, F.lit("\uE000")).when(i == 2, F.lit("\uFFFD")).otherwise(F.lit("z"))
    t = d.select("doc_id", F.concat(lead, F.substring_index("text", "\n", 1)).alias("row_key"), F.lit(0).alias("salt"))
    # the rank's own key is text, so the units stand in it as hex; ties go to the smaller id
    key = F.concat(F.hex(L.java_order("row_key")), F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 20, "0"))
    return L.rank_within_salt(t.select("salt", key.alias("row_key"), "doc_id"), 1, name="pos").select("doc_id", "pos")


# ------------------------------------------------------------ versions


def _versions(spark, sf_dir, n_loads):
    loads = FX.check_loads(spark, sf_dir, n_loads)
    keyed = [_keyed(d, FX.CHECK).withColumn("load_ts", F.lit(i + 1).cast("long")) for i, d in enumerate(loads)]
    allv = keyed[0]
    for d in keyed[1:]:
        allv = allv.unionByName(d)
    return latest_wins(allv, [*FX.CHECK.cols, "remarks"])


def q_latest_wins(spark, sf_dir):
    return _versions(spark, sf_dir, 2)


def q_latest_wins_added_column(spark, sf_dir):
    return _versions(spark, sf_dir, 3)


# ------------------------------------------------------------ the published store

_PUBLISHED: dict = {}


def _published(spark, sf_dir, name, spec, rows_fn, via_text=True) -> str:
    """Publish a layout once per session and input and return its table
    directory.  ``via_text``: export each batch as dated delimited text and run
    the load job on it; otherwise load the DataFrames (NULL = not written)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PUBLISHED:
        root = scratch_path(spark, f"store-{name}")
        inputs = scratch_path(spark, f"in-{name}")
        batches = rows_fn(spark, sf_dir)
        batches = batches if isinstance(batches, list) else [batches]
        for i, rows in enumerate(batches):
            s = spec.with_(cols=tuple(rows.columns), input_path_prefix=inputs)
            if via_text:
                date = f"2024-01-{i + 1:02d}"
                D.write_delimited(rows, f"{inputs}/{date}", list(rows.columns))
                res = load_batch(spark, s, date, root, load_ts=i + 1)
            else:
                res = load_rows(spark, s, rows, root, load_ts=i + 1)
        _PUBLISHED[key] = res.table_dir
    return _PUBLISHED[key]


def check_dir(spark, sf_dir) -> str:
    return _published(spark, sf_dir, "check", FX.CHECK, FX.check_rows)


def opinion_dir(spark, sf_dir) -> str:
    return _published(spark, sf_dir, "opinion", FX.OPINION, FX.opinion_rows)


def published_check(spark, sf_dir) -> DataFrame:
    return ST.current(spark, check_dir(spark, sf_dir), FX.CHECK.cols)


def published_opinion(spark, sf_dir) -> DataFrame:
    return ST.current(spark, opinion_dir(spark, sf_dir), FX.OPINION.cols)


def published_opinion_wide(spark, sf_dir) -> DataFrame:
    d = _published(spark, sf_dir, "opinion_wide", FX.OPINION, FX.opinion_wide_rows)
    return ST.current(spark, d, FX.OPINION.cols)


def q_load_job(spark, sf_dir):
    t = published_check(spark, sf_dir)
    return t.select("salt", "prefix", "row_key", *FX.CHECK.cols)


def q_published_three_loads(spark, sf_dir):
    d = _published(spark, sf_dir, "check3", FX.CHECK, lambda s, p: FX.check_loads(s, p, 3), via_text=False)
    t = ST.current(spark, d, [*FX.CHECK.cols, "remarks"])
    return t.select("salt", "prefix", "row_key", *FX.CHECK.cols, "remarks", "load_ts")


# ------------------------------------------------------------ lookups


def _top_key(df, cols):
    order = [F.desc("n")] + [F.asc(c) for c in cols]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(*order).first()


def q_lookup_check(spark, sf_dir):
    """The busiest customer's rows, by point lookup on the published table."""
    top = _top_key(FX.check_rows(spark, sf_dir), ["check_id"])
    return LK.lookup(published_check(spark, sf_dir), FX.CHECK, top["check_id"], CHECK_FIELDS, keep_row_key=True)


def q_lookup_opinion(spark, sf_dir):
    top = _top_key(FX.opinion_rows(spark, sf_dir), ["buss_no", "business_type"])
    key = {"buss_no": top["buss_no"], "business_type": top["business_type"]}
    return LK.lookup(published_opinion(spark, sf_dir), FX.OPINION, key, OPINION_FIELDS, keep_row_key=True)


def _collision_table(spark, sf_dir):
    return _keyed(FX.collision_rows(spark, sf_dir), FX.COLLISION)


def _collision_requests(spark, sf_dir):
    return FX.collision_rows(spark, sf_dir).select(F.col("id").alias("req_id"), "k1", "k2")


def q_lookup_collision(spark, sf_dir):
    """Every customer looked up by (custkey, nationkey): concatenation matches."""
    return LK.batch_lookup(_collision_table(spark, sf_dir), FX.COLLISION, _collision_requests(spark, sf_dir))


def q_lookup_collision_exact(spark, sf_dir):
    return LK.batch_lookup(_collision_table(spark, sf_dir), FX.COLLISION, _collision_requests(spark, sf_dir), exact=True)


def q_scan_range(spark, sf_dir):
    return LK.scan_range(published_check(spark, sf_dir), FX.CHECK, "08", "1c", columns=["f:id"])


def q_scan_prefix(spark, sf_dir):
    top = _top_key(FX.check_rows(spark, sf_dir), ["check_id"])
    _, prefix, _ = LK.key_literals(FX.CHECK, top["check_id"])
    return LK.scan_prefix(published_check(spark, sf_dir), FX.CHECK, prefix, columns=["f:id", "f:rule_no"])


def q_scan_limit(spark, sf_dir):
    return LK.scan_limit(published_check(spark, sf_dir), FX.CHECK, 6, columns=list(FX.CHECK.cols))


def _customer_requests(spark, sf_dir, with_null=False):
    c = FX.read(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    if with_null:
        key = F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string")).otherwise(key)
    known = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("req_id"), key.alias("check_id"))
    missing = c.select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("req_id"),
        (F.col("c_custkey") + 100000000).cast("string").alias("check_id"),
    )
    return known.unionByName(missing)


def q_batch_lookup(spark, sf_dir):
    return LK.batch_lookup(published_check(spark, sf_dir), FX.CHECK, _customer_requests(spark, sf_dir), fields=CHECK_FIELDS)


def q_batch_envelope(spark, sf_dir):
    reqs = _customer_requests(spark, sf_dir, with_null=True)
    return LK.batch_envelope(published_check(spark, sf_dir), FX.CHECK, reqs, fields=CHECK_FIELDS)


def q_batch_reply_rows(spark, sf_dir):
    """The rows of every reply, in order."""
    return LK.batch_reply_rows(published_check(spark, sf_dir), FX.CHECK, _customer_requests(spark, sf_dir), fields=CHECK_FIELDS)


def _hot_orders(spark, sf_dir):
    """A third of the orders belong to one customer."""
    rows = FX.check_rows(spark, sf_dir)
    return rows.withColumn("check_id", F.when(F.col("id").cast("long") % 3 == 0, F.lit("HOT")).otherwise(F.col("check_id")))


def q_batch_lookup_hot(spark, sf_dir):
    """Batch lookup by shuffle joins where one key holds a third of all rows."""
    t = _keyed(_hot_orders(spark, sf_dir), FX.CHECK)
    reqs = _customer_requests(spark, sf_dir).unionByName(spark.sql("SELECT 'hot' AS req_id, 'HOT' AS check_id"))
    return LK.batch_lookup(t, FX.CHECK, reqs, fields=CHECK_FIELDS, broadcast_requests=False, hot_rows=100)


def _bucketed(spark, sf_dir, rows, name, **kw) -> str:
    """The keyed rows as a bucketed table, once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PUBLISHED:
        table = f"{name}_{len(_PUBLISHED)}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"DROP TABLE IF EXISTS {table}_hot")
        _PUBLISHED[key] = BK.bucket_table(spark, _keyed(rows, FX.CHECK), table, scratch_path(spark, name), 16, **kw)
    return _PUBLISHED[key]


def q_batch_lookup_bucketed(spark, sf_dir):
    """Batch lookup on a bucketed copy: only the requests move."""
    name = _bucketed(spark, sf_dir, FX.check_rows(spark, sf_dir), "saltkv_check_buckets")
    return BK.batch_lookup_bucketed(spark, name, FX.CHECK, _customer_requests(spark, sf_dir), fields=CHECK_FIELDS)


def q_batch_lookup_bucketed_hot(spark, sf_dir):
    """... where a third of the rows have one key: it is dealt over several buckets."""
    name = _bucketed(spark, sf_dir, _hot_orders(spark, sf_dir), "saltkv_hot_buckets", hot_rows=100, fan=8)
    reqs = _customer_requests(spark, sf_dir).unionByName(spark.sql("SELECT 'hot' AS req_id, 'HOT' AS check_id"))
    return BK.batch_lookup_bucketed(spark, name, FX.CHECK, reqs, fields=CHECK_FIELDS, hot_rows=100)


def q_batch_lookup_prefiltered(spark, sf_dir):
    """Few of the table's keys are asked for, by more keys than may be broadcast: a Bloom filter of the requested prefixes
    drops the other rows before the shuffle."""
    reqs = _customer_requests(spark, sf_dir).where(F.col("check_id").endswith("7"))
    return LK.batch_lookup(published_check(spark, sf_dir), FX.CHECK, reqs, fields=CHECK_FIELDS, broadcast_requests=False)


def q_scan_ranges(spark, sf_dir):
    """Many row-key ranges at once: a narrow one for every customer, and open ones for every nation."""
    c, n = FX.read(spark, sf_dir, "customer"), FX.read(spark, sf_dir, "nation")
    lead = F.concat((F.col("c_custkey") % 3).cast("string"), F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 3))
    narrow = c.select(F.concat(F.lit("c"), "c_custkey").alias("req_id"), lead.alias("start"), F.concat(F.substring(lead, 1, 3), F.lit("g")).alias("stop"))
    k = F.col("n_nationkey")
    at = F.concat((k % 3).cast("string"), F.lower(F.hex(k % 16)))
    wide = n.select(
        F.concat(F.lit("n"), "n_nationkey").alias("req_id"), F.when(k % 5 != 0, at).alias("start"),
        F.when(k % 4 != 0, F.concat((k % 3).cast("string"), F.lit("8f"))).alias("stop"),
    )
    return scan_ranges(published_check(spark, sf_dir), FX.CHECK, narrow.unionByName(wide), columns=["f:id", "f:rule_type"])


def _sql_spec(spark, sf_dir):
    """The published check table with its newest-wins view and the SQL functions over it."""
    spec = FX.CHECK.with_(namespace="keyspace_fn", table_name="check_fn")
    ST.create_table(spark, spec, check_dir(spark, sf_dir), namespace_location=scratch_path(spark, "ns-fn"))
    SQLF.create_functions(spark, spec, ST.create_current_view(spark, spec))
    return spec


def q_sql_row_keys(spark, sf_dir):
    """Salt, prefix and row key by SQL functions."""
    _sql_spec(spark, sf_dir)
    FX.check_rows(spark, sf_dir).createOrReplaceTempView("saltkv_check_rows")
    return spark.sql(
        "SELECT id, check_id, keyspace_fn.check_fn_salt(check_id) AS salt, keyspace_fn.check_fn_prefix(check_id) AS prefix, "
        "keyspace_fn.check_fn_row_key(check_id, id) AS row_key FROM saltkv_check_rows"
    )


def q_sql_lookup(spark, sf_dir):
    """The busiest customer's rows by the table function, with a literal key."""
    _sql_spec(spark, sf_dir)
    top = _top_key(FX.check_rows(spark, sf_dir), ["check_id"])["check_id"]
    return spark.sql("SELECT * FROM check_fn_lookup(:key)", {"key": top})


def q_sql_lookup_lateral(spark, sf_dir):
    """The table function for every request of a table: Catalyst turns it into a hash join."""
    _sql_spec(spark, sf_dir)
    _customer_requests(spark, sf_dir, with_null=True).createOrReplaceTempView("saltkv_requests")
    return spark.sql("SELECT r.req_id, l.row_key, l.id, l.rule_type FROM saltkv_requests r, LATERAL check_fn_lookup(r.check_id) l")


def q_sql_range(spark, sf_dir):
    _sql_spec(spark, sf_dir)
    return spark.sql("SELECT row_key, id FROM check_fn_range('08', '1c')")


def q_described_job(spark, sf_dir):
    """The load job as its command line describes it: table by name, its .properties and .conf files, the arguments;
    the published table in the description's schema, with its resources."""
    inputs = _export(spark, FX.opinion_rows(spark, sf_dir), "in-described")
    args = J.arguments().parse_args(["2024-01-01", "load", "opinion", "--input", inputs, "--store-root", scratch_path(spark, "store-described"), "--load-ts", "5"])
    spec, conf = J.described(args)
    res = J.run_described(spark, args, spec)
    t = ST.current(spark, res.table_dir, spec.cols)
    rows = t.select(*spec.cols).to(spec.schema)
    settings = [F.lit(conf[f"spark.executor.{k}"]).alias(f"executor_{k}") for k in ("instances", "cores", "memory")]
    return rows.select("*", F.lit(spec.qualified_name).alias("table_name"), F.lit(res.load_ts).cast("long").alias("load_ts"), *settings)


def q_load_counts(spark, sf_dir):
    """Numbers of loaded and rejected rows, as the load's own writes observed them."""
    res = load_batch(spark, FX.CHECK, path=_short_every_7th(spark, sf_dir), store_root=scratch_path(spark, "store-counts"), mode="permissive")
    m = ST.read_manifest(spark, res.load_dir)
    t = ST.current(spark, res.table_dir, FX.CHECK.cols)
    return t.agg(F.count(F.lit(1)).alias("n_read")).select("n_read", F.lit(m["loaded"]).cast("long").alias("n_loaded"), F.lit(m["rejected"]).cast("long").alias("n_rejected"))


def bloom_loads(spark, sf_dir):
    """The check table in three loads with Bloom filters, the last without a sketch: every 3rd order, the others, every 5th again."""
    k = F.col("id").cast("long") % 15
    rows, root = FX.check_rows(spark, sf_dir), scratch_path(spark, "store-bloom")
    load_rows(spark, FX.CHECK, rows.where(k % 3 == 0), root, load_ts=1, bloom_filter=True, files_per_bucket=1)
    load_rows(spark, FX.CHECK, rows.where(k % 3 != 0), root, load_ts=2, bloom_filter=True)
    return load_rows(spark, FX.CHECK, rows.where(k % 5 == 0).withColumn("rule_desc", F.lit("again")), root, load_ts=3).table_dir


def q_sketched_prefixes(spark, sf_dir):
    """For each salt the rows and distinct prefixes of a table of three loads, and whether the loads' merged sketches
    estimate the prefixes to a tenth."""
    d = bloom_loads(spark, sf_dir)
    exact = ST.read_loads(spark, d, []).groupBy("salt").agg(F.count_distinct("prefix").alias("n_prefixes"))
    est = SK.table_sketches(spark, d).select("salt", "n_rows", F.col("n_prefixes").alias("est"))
    near = F.abs(F.col("est") - F.col("n_prefixes")) * 10 <= F.col("n_prefixes")
    return exact.join(est, "salt").select("salt", "n_rows", "n_prefixes", near.alias("near"))


def q_merged_bloom_rows(spark, sf_dir):
    """The merged copy of the same loads, written with Bloom filters sized by their sketches."""
    d = bloom_loads(spark, sf_dir)
    MG.upsert_loads(spark, FX.CHECK, d, bloom_filter=True)
    return MG.merged(spark, d, FX.CHECK.cols)


def q_lookup_response(spark, sf_dir):
    """The answers to three single requests: the busiest customer, one that has no rows, and no key."""
    top = _top_key(FX.check_rows(spark, sf_dir), ["check_id"])["check_id"]
    t = published_check(spark, sf_dir)
    answers = [LK.lookup_response(t, FX.CHECK, k, CHECK_FIELDS).withColumn("req_id", F.lit(r)) for r, k in (("top", top), ("none", "-"), ("null", None))]
    return answers[0].unionByName(answers[1]).unionByName(answers[2])


def q_list_tables_by_priority(spark, sf_dir):
    """A table for each order priority in the data, registered and listed."""
    loc = scratch_path(spark, "ns-priority")
    names = FX.read(spark, sf_dir, "orders").select(F.regexp_replace(F.lower("o_orderpriority"), "[^a-z0-9]+", "_").alias("n")).distinct().collect()
    for r in names:
        spec = FX.CHECK.with_(namespace="keyspace_priority", table_name=f"orders_{r.n}")
        ST.create_table(spark, spec, ST.table_location(spec, loc), namespace_location=loc)
    return ST.list_tables(spark, "keyspace_priority")


def q_envelope_unknown_cells(spark, sf_dir):
    """A stored column outside the result schema, written for every 4th order:
    a request fails only when one of its matched rows holds that cell."""
    t = check_table(spark, sf_dir)
    t = t.withColumn("legacy_flag", F.when(F.col("id").cast("long") % 4 == 0, F.lit("x")))
    return LK.batch_envelope(t, FX.CHECK, _customer_requests(spark, sf_dir), fields=CHECK_FIELDS)


def _pair_requests(spark, sf_dir):
    e = FX.read(spark, sf_dir, "events")
    pairs = e.select(F.col("user_id").cast("string").alias("buss_no"), F.col("event_type").alias("business_type")).distinct()
    known = pairs.select(F.concat_ws("/", "buss_no", "business_type").alias("req_id"), "buss_no", "business_type")
    missing = pairs.select(
        F.concat_ws("/", F.lit("x"), "buss_no", "business_type").alias("req_id"),
        "buss_no", F.concat(F.col("business_type"), F.lit("_none")).alias("business_type"),
    )
    return known.unionByName(missing)


def q_batch_lookup_opinion(spark, sf_dir):
    return LK.batch_lookup(published_opinion_wide(spark, sf_dir), FX.OPINION, _pair_requests(spark, sf_dir), fields=OPINION_FIELDS)


def q_batch_envelope_opinion(spark, sf_dir):
    return LK.batch_envelope(published_opinion_wide(spark, sf_dir), FX.OPINION, _pair_requests(spark, sf_dir), fields=OPINION_FIELDS)


def _two_text_loads(spark, sf_dir):
    base = FX.check_rows(spark, sf_dir)
    k = F.col("id").cast("long")
    changed = base.where(k % 2 == 0).withColumn("rule_type", F.concat(F.lower("rule_type"), F.lit("2")))
    return [base, changed]


def q_published_text_loads(spark, sf_dir):
    """Two text loads: NULL-free with unique keys, so the reader merges whole
    rows (one aggregate) instead of one aggregate per column."""
    d = _published(spark, sf_dir, "check2t", FX.CHECK, _two_text_loads)
    t = ST.current(spark, d, FX.CHECK.cols)
    return t.select("salt", "prefix", "row_key", *FX.CHECK.cols, "load_ts")


def q_compacted_three_loads(spark, sf_dir):
    """Loads 1-2 folded into the merged copy, then load 3: it equals the merge of all loads."""
    key = (spark.sparkContext.applicationId, sf_dir, "check3c")
    if key not in _PUBLISHED:
        root = scratch_path(spark, "store-check3c")
        loads = FX.check_loads(spark, sf_dir, 3)
        for i, d in enumerate(loads[:2]):
            res = load_rows(spark, FX.CHECK, d, root, load_ts=i + 1)
        MG.upsert_loads(spark, FX.CHECK, res.table_dir)
        load_rows(spark, FX.CHECK, loads[2], root, load_ts=3, upsert=True)
        _PUBLISHED[key] = res.table_dir
    t = MG.merged(spark, _PUBLISHED[key], [*FX.CHECK.cols, "remarks"])
    return t.select("salt", "prefix", "row_key", *FX.CHECK.cols, "remarks", "load_ts")


def q_late_load_after_compaction(spark, sf_dir):
    """Loads 1 and 3 folded, then load 2 late (and load 3 a second time): nothing of it is lost."""
    root = scratch_path(spark, "store-late")
    loads = FX.check_loads(spark, sf_dir, 3)
    for i in (0, 2, 1):
        res = load_rows(spark, FX.CHECK, loads[i], root, load_ts=i + 1, upsert=True)
    MG.upsert_loads(spark, FX.CHECK, res.table_dir, [3])
    t = MG.merged(spark, res.table_dir, [*FX.CHECK.cols, "remarks"])
    return t.select("salt", "prefix", "row_key", *FX.CHECK.cols, "remarks", "load_ts")


def q_load_rejects_recorded(spark, sf_dir):
    """A permissive load of a batch with short records: what was loaded and what was set aside."""
    root = scratch_path(spark, "store-rejects")
    res = load_batch(spark, FX.CHECK, path=_short_every_7th(spark, sf_dir), store_root=root, mode="permissive")
    loaded = ST.current(spark, res.table_dir, FX.CHECK.cols).select("id", F.lit("loaded").alias("outcome"))
    aside = ST.read_rejected(spark, res.table_dir, res.load_ts)
    return loaded.unionByName(aside.select(F.split("value", SEP).getItem(0).alias("id"), F.lit("rejected").alias("outcome")))


def _dup_loads(spark, sf_dir, n):
    root = scratch_path(spark, "store-dups")
    for i in range(n):
        res = load_rows(spark, FX.DUPLICATES, FX.duplicate_rows(spark, sf_dir), root, load_ts=i + 1, dedup=False)
    return res.table_dir


def q_published_dup_load(spark, sf_dir):
    """One load that may repeat row keys (``dedup=False``) still reads as one row a key."""
    t = ST.current(spark, _dup_loads(spark, sf_dir, 1), FX.DUPLICATES.cols)
    return t.select("salt", "prefix", "row_key", *FX.DUPLICATES.cols)


def q_first_rows_dup_loads(spark, sf_dir):
    """The first six rows over two loads that repeat row keys."""
    return ST.first_rows(spark, _dup_loads(spark, sf_dir, 2), 6, FX.DUPLICATES.cols).select("row_key", *FX.DUPLICATES.cols, "load_ts")


def q_lookup_check_versions(spark, sf_dir):
    """Point lookup through the newest-wins merge of three loads (pruned below it)."""
    d = _published(spark, sf_dir, "check3", FX.CHECK, lambda s, p: FX.check_loads(s, p, 3), via_text=False)
    t = ST.current(spark, d, [*FX.CHECK.cols, "remarks"])
    top = _top_key(FX.check_rows(spark, sf_dir), ["check_id"])
    return LK.lookup(t, FX.CHECK, top["check_id"], CHECK_FIELDS, keep_row_key=True)


def q_scan_limit_versions(spark, sf_dir):
    """The first six rows of the three-load table: only candidate keys are merged."""
    d = _published(spark, sf_dir, "check3", FX.CHECK, lambda s, p: FX.check_loads(s, p, 3), via_text=False)
    cols = [*FX.CHECK.cols, "remarks"]
    return ST.first_rows(spark, d, 6, cols).select("row_key", *cols, "load_ts")


def q_batch_lookup_versions(spark, sf_dir):
    """Batch lookup on a table of three loads: only requested keys are merged."""
    d = _published(spark, sf_dir, "check3", FX.CHECK, lambda s, p: FX.check_loads(s, p, 3), via_text=False)
    t = ST.current(spark, d, [*FX.CHECK.cols, "remarks"])
    return LK.batch_lookup(t, FX.CHECK, _customer_requests(spark, sf_dir), fields=CHECK_FIELDS)


def q_sql_current_view(spark, sf_dir):
    """The three-load table registered in the catalog and read through its
    newest-wins SQL view with plain ``spark.sql``."""
    d = _published(spark, sf_dir, "check3", FX.CHECK, lambda s, p: FX.check_loads(s, p, 3), via_text=False)
    cols = [*FX.CHECK.cols, "remarks"]
    spec = FX.CHECK.with_(namespace="keyspace_sql", table_name="check3")
    ST.create_table(spark, spec, d, cols, namespace_location=scratch_path(spark, "ns-sql"))
    ST.refresh_table(spark, spec)
    view = ST.create_current_view(spark, spec, cols)
    return spark.sql(f"SELECT salt, prefix, row_key, {', '.join(cols)}, load_ts FROM {view}")


def q_list_tables(spark, sf_dir):
    """Register the published check and opinion tables in their namespace
    (the table descriptions' ``keyspace``) and list it as ``namespace:table``."""
    loc = scratch_path(spark, "ns")
    ST.create_table(spark, FX.CHECK, check_dir(spark, sf_dir), namespace_location=loc)
    ST.create_table(spark, FX.OPINION, opinion_dir(spark, sf_dir), namespace_location=loc)
    return ST.list_tables(spark, FX.CHECK.namespace)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "row_keys": q_row_keys,
    "row_keys_mod10": q_row_keys_mod10,
    "row_keys_mod12": q_row_keys_mod12,
    "composite_row_keys": q_composite_row_keys,
    "opinion_wide_row_keys": q_opinion_wide_row_keys,
    "document_row_keys": q_document_row_keys,
    "delimited_roundtrip": q_delimited_roundtrip,
    "delimited_failfast": q_delimited_failfast,
    "parsed_rows": q_parsed_rows,
    "rejected_rows": q_rejected_rows,
    "salt_partition_counts": q_salt_partition_counts,
    "salt_subpartition_counts": q_salt_subpartition_counts,
    "partition_sorted_rank": q_partition_sorted_rank,
    "dedup_in_load": q_dedup_in_load,
    "to_cells": q_to_cells,
    "from_cells": q_from_cells,
    "binary_cells_roundtrip": q_binary_cells_roundtrip,
    "latest_wins": q_latest_wins,
    "latest_wins_added_column": q_latest_wins_added_column,
    "load_job": q_load_job,
    "published_three_loads": q_published_three_loads,
    "lookup_check": q_lookup_check,
    "lookup_opinion": q_lookup_opinion,
    "lookup_collision": q_lookup_collision,
    "lookup_collision_exact": q_lookup_collision_exact,
    "scan_range": q_scan_range,
    "scan_prefix": q_scan_prefix,
    "scan_limit": q_scan_limit,
    "batch_lookup": q_batch_lookup,
    "batch_envelope": q_batch_envelope,
    "batch_reply_rows": q_batch_reply_rows,
    "batch_lookup_hot": q_batch_lookup_hot,
    "envelope_unknown_cells": q_envelope_unknown_cells,
    "batch_lookup_opinion": q_batch_lookup_opinion,
    "batch_envelope_opinion": q_batch_envelope_opinion,
    "published_text_loads": q_published_text_loads,
    "compacted_three_loads": q_compacted_three_loads,
    "lookup_check_versions": q_lookup_check_versions,
    "scan_limit_versions": q_scan_limit_versions,
    "batch_lookup_versions": q_batch_lookup_versions,
    "sql_current_view": q_sql_current_view,
    "late_load_after_compaction": q_late_load_after_compaction,
    "load_rejects_recorded": q_load_rejects_recorded,
    "published_dup_load": q_published_dup_load,
    "first_rows_dup_loads": q_first_rows_dup_loads,
    "list_tables": q_list_tables,
    "key_fallbacks": q_key_fallbacks,
    "cells_open": q_cells_open,
    "java_order_rank": q_java_order_rank,
    "batch_lookup_bucketed": q_batch_lookup_bucketed,
    "batch_lookup_bucketed_hot": q_batch_lookup_bucketed_hot,
    "batch_lookup_prefiltered": q_batch_lookup_prefiltered,
    "scan_ranges": q_scan_ranges,
    "sql_row_keys": q_sql_row_keys,
    "sql_lookup": q_sql_lookup,
    "sql_lookup_lateral": q_sql_lookup_lateral,
    "sql_range": q_sql_range,
    "described_job": q_described_job,
    "load_counts": q_load_counts,
    "sketched_prefixes": q_sketched_prefixes,
    "merged_bloom_rows": q_merged_bloom_rows,
    "lookup_response": q_lookup_response,
    "list_tables_by_priority": q_list_tables_by_priority,
}


# ============================================================ DuckDB oracles


def _jhash(e: str) -> str:
    """Java String.hashCode in DuckDB (signed BIGINT), for any Unicode text."""
    u = (
        f"(CASE WHEN length({e}) = 0 THEN 0::BIGINT ELSE list_reduce("
        f"list_transform(string_split({e}, ''), lambda x: unicode(x)::BIGINT), "
        "lambda h, c: CASE WHEN c <= 65535 THEN (h * 31 + c) & 4294967295 "
        "ELSE (((h * 31 + 55296 + ((c - 65536) >> 10)) & 4294967295) * 31 "
        "+ 56320 + ((c - 65536) & 1023)) & 4294967295 END, 0::BIGINT) END)"
    )
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


def _keys_sql(qk: str, uniq: str, n: int) -> str:
    """``salt, prefix, row_key`` select items for query key ``qk``."""
    w = len(str(n - 1))
    salt = f"CAST(abs({_jhash(qk)} % {n}) AS INTEGER)"
    prefix = f"(lpad(CAST({salt} AS VARCHAR), {w}, '0') || md5({qk}))"
    return f"{salt} AS salt, {prefix} AS prefix, {prefix} || {uniq} AS row_key"


CHECK_SRC = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS check_id, "
    "o_orderpriority AS rule_no, o_orderstatus AS rule_type, "
    "strftime(o_orderdate, '%Y-%m-%d') AS rule_desc FROM orders"
)
OPINION_SRC = (
    "SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, "
    "CAST(conv_id AS VARCHAR) AS buss_no, role AS business_type, text AS approval_opinion "
    "FROM conversations"
)
MULTILINE_SRC = (
    "SELECT CAST(doc_id AS VARCHAR) AS id, source AS key, lang, text AS value FROM documents"
)


OPINION_WIDE_SRC = (
    "SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS buss_no, "
    "event_type AS business_type, props AS approval_opinion FROM events"
)
COLLISION_SRC = (
    "SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS k1, "
    "CAST(c_nationkey AS VARCHAR) AS k2, c_name AS name FROM customer"
)
DUP_SRC = (
    "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, "
    "CAST(l_orderkey AS VARCHAR) AS key, CAST(l_partkey AS VARCHAR) AS partkey, "
    "CAST(l_suppkey AS VARCHAR) AS suppkey, l_returnflag AS returnflag, l_linestatus AS linestatus, "
    "strftime(l_shipdate, '%Y-%m-%d') AS shipdate FROM lineitem"
)
CHECK_COLS = ("id", "check_id", "rule_no", "rule_type", "rule_desc")
OPINION_COLS = ("id", "buss_no", "business_type", "approval_opinion")


def _check_keyed(n: int = 3) -> str:
    return f"SELECT *, {_keys_sql('check_id', 'id', n)} FROM ({CHECK_SRC})"


def _opinion_keyed(n: int = 3, src: str = OPINION_SRC) -> str:
    return f"SELECT *, {_keys_sql('(buss_no || business_type)', 'id', n)} FROM ({src})"


def _fields(names, have, alias: str = "") -> str:
    """Fixed result schema: stored columns by name, the rest NULL."""
    a = f"{alias}." if alias else ""
    return ", ".join(f"{a}{c}" if c in have else f"NULL::VARCHAR AS {c}" for c in names)


def _cols(names, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return ", ".join(f"{a}{c}" for c in names)


def _versions_sql(n_loads: int) -> str:
    k = f"CAST(id AS BIGINT)"
    loads = [
        f"SELECT salt, prefix, row_key, 1::BIGINT AS v, id, check_id, rule_no, rule_type, rule_desc, "
        f"NULL::VARCHAR AS remarks FROM k",
        f"SELECT salt, prefix, row_key, 2::BIGINT, id, check_id, NULL, lower(rule_type) || '2', "
        f"CASE WHEN {k} % 2 = 0 THEN '' ELSE NULL END, NULL FROM k WHERE {k} % 3 = 0",
        f"SELECT salt, prefix, row_key, 3::BIGINT, id, check_id, NULL, NULL, NULL, 'r' || id "
        f"FROM k WHERE {k} % 5 = 0",
    ][:n_loads]
    merged = ", ".join(f"arg_max({c}, v) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in (*CHECK_COLS, "remarks"))
    return (
        f"WITH k AS ({_check_keyed(3)}), l AS ({' UNION ALL '.join(loads)}) "
        f"SELECT salt, prefix, row_key, {merged}, max(v) AS load_ts FROM l GROUP BY salt, prefix, row_key"
    )


_TOP_CHECK = "SELECT check_id FROM k GROUP BY check_id ORDER BY count(*) DESC, check_id ASC LIMIT 1"
_TOP_OPINION = (
    "SELECT buss_no || business_type AS qk FROM k GROUP BY buss_no, business_type "
    "ORDER BY count(*) DESC, buss_no ASC, business_type ASC LIMIT 1"
)

_CUSTOMER_REQS = (
    "SELECT 'c' || CAST(c_custkey AS VARCHAR) AS req_id, {known} AS check_id FROM customer "
    "UNION ALL SELECT 'm' || CAST(c_custkey AS VARCHAR), CAST(c_custkey + 100000000 AS VARCHAR) FROM customer"
)
_PAIR_REQS = (
    "WITH p AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS buss_no, event_type AS business_type FROM events) "
    "SELECT buss_no || '/' || business_type AS req_id, buss_no, business_type FROM p UNION ALL "
    "SELECT 'x/' || buss_no || '/' || business_type, buss_no, business_type || '_none' FROM p"
)


def _envelope_sql(bad: str) -> str:
    return (
        f"CASE WHEN {bad} THEN 'E' ELSE 'S' END AS rtn_sts, "
        f"CASE WHEN {bad} THEN '-1' ELSE '0' END AS rtn_code, "
        f"CASE WHEN {bad} THEN '系统查询异常' ELSE '交易成功' END AS rtn_msg, "
        "'475' AS sys_code"
    )


_DUP_MERGED = (
    "SELECT salt, prefix, row_key, " + ", ".join(f"max({c}) AS {c}" for c in FX.DUPLICATES.cols)
    + f" FROM (SELECT *, {_keys_sql('key', 'id', 3)} FROM ({DUP_SRC})) GROUP BY salt, prefix, row_key"
)

ORACLE: dict[str, str] = {
    "row_keys": f"SELECT id, check_id, salt, prefix, row_key FROM ({_check_keyed(3)})",
    "row_keys_mod10": f"SELECT id, check_id, salt, prefix, row_key FROM ({_check_keyed(10)})",
    "row_keys_mod12": f"SELECT id, check_id, salt, prefix, row_key FROM ({_check_keyed(12)})",
    "composite_row_keys": f"SELECT id, buss_no, business_type, salt, prefix, row_key FROM ({_opinion_keyed(3)})",
    "opinion_wide_row_keys": (
        f"SELECT id, buss_no, business_type, salt, prefix, row_key FROM ({_opinion_keyed(3, OPINION_WIDE_SRC)})"
    ),
    "document_row_keys": f"SELECT id, {_keys_sql('value', 'id', 10)} FROM ({MULTILINE_SRC})",
    # A delimited file has no NULL: an unwritten value reads back as ''.
    "delimited_roundtrip": (
        "SELECT coalesce(id, '') AS id, coalesce(key, '') AS key, coalesce(lang, '') AS lang, "
        f"coalesce(value, '') AS value FROM ({MULTILINE_SRC})"
    ),
    "delimited_failfast": f"SELECT {_cols(CHECK_COLS)} FROM ({CHECK_SRC})",
    "parsed_rows": f"SELECT {_cols(CHECK_COLS)} FROM ({CHECK_SRC}) WHERE CAST(id AS BIGINT) % 7 <> 0",
    "rejected_rows": f"SELECT id, 3 AS n_fields FROM ({CHECK_SRC}) WHERE CAST(id AS BIGINT) % 7 = 0",
    "salt_partition_counts": (
        f"SELECT salt AS partition_id, salt, count(*) AS n_rows FROM ({_check_keyed(3)}) GROUP BY salt"
    ),
    "salt_subpartition_counts": (
        f"SELECT salt, count(*) AS n_rows, 0::BIGINT AS n_misplaced FROM ({_check_keyed(3)}) GROUP BY salt"
    ),
    "partition_sorted_rank": (
        "SELECT salt, row_key, id, row_number() OVER (PARTITION BY salt ORDER BY row_key) AS rank_in_salt "
        f"FROM ({_check_keyed(3)})"
    ),
    "dedup_in_load": (
        "SELECT salt, prefix, row_key, id, key, partkey, suppkey, returnflag, linestatus, shipdate FROM ("
        "SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY id DESC, key DESC, partkey DESC, "
        "suppkey DESC, returnflag DESC, linestatus DESC, shipdate DESC) AS rn "
        f"FROM (SELECT *, {_keys_sql('key', 'id', 3)} FROM ({DUP_SRC}))) WHERE rn = 1"
    ),
    "to_cells": f"WITH k AS ({_check_keyed(3)}) " + " UNION ALL ".join(
        f"SELECT row_key, 'f' AS family, '{c}' AS qualifier, {c} AS value FROM k WHERE {c} IS NOT NULL"
        for c in CHECK_COLS
    ),
    "from_cells": f"SELECT row_key, {_fields(CHECK_FIELDS, CHECK_COLS)} FROM ({_check_keyed(3)})",
    "binary_cells_roundtrip": f"SELECT row_key, {_fields(OPINION_FIELDS, OPINION_COLS)} FROM ({_opinion_keyed(3)})",
    "latest_wins": _versions_sql(2),
    "latest_wins_added_column": _versions_sql(3),
    "load_job": f"SELECT salt, prefix, row_key, {_cols(CHECK_COLS)} FROM ({_check_keyed(3)})",
    "published_three_loads": _versions_sql(3),
    "compacted_three_loads": _versions_sql(3),
    "published_text_loads": (
        "SELECT salt, prefix, row_key, id, check_id, rule_no, "
        "CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN lower(rule_type) || '2' ELSE rule_type END AS rule_type, "
        "rule_desc, CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS load_ts "
        f"FROM ({_check_keyed(3)})"
    ),
    "sql_current_view": _versions_sql(3),
    "late_load_after_compaction": _versions_sql(3),
    "load_rejects_recorded": (
        f"SELECT id, CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN 'rejected' ELSE 'loaded' END AS outcome FROM ({CHECK_SRC})"
    ),
    "published_dup_load": _DUP_MERGED,
    "first_rows_dup_loads": f"SELECT * EXCLUDE (salt, prefix), 2::BIGINT AS load_ts FROM ({_DUP_MERGED}) ORDER BY row_key LIMIT 6",
    "lookup_check": (
        f"WITH k AS ({_check_keyed(3)}) SELECT row_key, {_fields(CHECK_FIELDS, CHECK_COLS)} "
        f"FROM k WHERE check_id = ({_TOP_CHECK})"
    ),
    "lookup_opinion": (
        f"WITH k AS ({_opinion_keyed(3)}) SELECT row_key, {_fields(OPINION_FIELDS, OPINION_COLS)} "
        f"FROM k WHERE buss_no || business_type = ({_TOP_OPINION})"
    ),
    "lookup_collision": (
        f"WITH t AS (SELECT *, {_keys_sql('(k1 || k2)', 'id', 3)} FROM ({COLLISION_SRC})), "
        f"r AS (SELECT id AS req_id, k1, k2 FROM ({COLLISION_SRC})) "
        "SELECT r.req_id, t.row_key, t.id, t.k1, t.k2, t.name FROM r JOIN t ON r.k1 || r.k2 = t.k1 || t.k2"
    ),
    "lookup_collision_exact": (
        f"WITH t AS (SELECT *, {_keys_sql('(k1 || k2)', 'id', 3)} FROM ({COLLISION_SRC})), "
        f"r AS (SELECT id AS req_id, k1, k2 FROM ({COLLISION_SRC})) "
        "SELECT r.req_id, t.row_key, t.id, t.k1, t.k2, t.name FROM r JOIN t ON r.k1 = t.k1 AND r.k2 = t.k2"
    ),
    "scan_range": f"SELECT row_key, id FROM ({_check_keyed(3)}) WHERE row_key >= '08' AND row_key < '1c'",
    "scan_prefix": (
        f"WITH k AS ({_check_keyed(3)}) SELECT row_key, id, rule_no FROM k "
        f"WHERE starts_with(row_key, (SELECT max(prefix) FROM k WHERE check_id = ({_TOP_CHECK})))"
    ),
    "scan_limit": f"SELECT row_key, {_cols(CHECK_COLS)} FROM ({_check_keyed(3)}) ORDER BY row_key LIMIT 6",
    "batch_lookup": (
        f"WITH k AS ({_check_keyed(3)}), r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')}) "
        f"SELECT r.req_id, k.row_key, {_fields(CHECK_FIELDS, CHECK_COLS, 'k')} FROM r JOIN k ON r.check_id = k.check_id"
    ),
    "batch_reply_rows": (
        f"WITH k AS ({_check_keyed(3)}), r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')}) "
        "SELECT r.req_id, row_number() OVER (PARTITION BY r.req_id ORDER BY k.row_key) AS pos, "
        f"{_fields(CHECK_FIELDS, CHECK_COLS, 'k')} FROM r JOIN k ON r.check_id = k.check_id"
    ),
    "batch_lookup_hot": (
        f"WITH h AS (SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'HOT' ELSE check_id END AS check_id) FROM ({CHECK_SRC})), "
        f"k AS (SELECT *, {_keys_sql('check_id', 'id', 3)} FROM h), "
        f"r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')} UNION ALL SELECT 'hot', 'HOT') "
        f"SELECT r.req_id, k.row_key, {_fields(CHECK_FIELDS, CHECK_COLS, 'k')} FROM r JOIN k ON r.check_id = k.check_id"
    ),
    "batch_envelope": (
        f"WITH k AS ({_check_keyed(3)}), "
        f"r AS ({_CUSTOMER_REQS.format(known='CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END')}), "
        "c AS (SELECT check_id, count(*) AS n FROM k GROUP BY check_id) "
        f"SELECT r.req_id, {_envelope_sql('r.check_id IS NULL')}, "
        "CASE WHEN r.check_id IS NULL THEN NULL ELSE coalesce(c.n, 0) END AS n_data "
        "FROM r LEFT JOIN c ON r.check_id = c.check_id"
    ),
    "lookup_check_versions": (
        f"WITH k AS ({_check_keyed(3)}), v AS ({_versions_sql(3)}) "
        f"SELECT v.row_key, {_fields(CHECK_FIELDS, (*CHECK_COLS, 'remarks'), 'v')} FROM v "
        f"WHERE v.check_id = ({_TOP_CHECK})"
    ),
    "scan_limit_versions": (
        f"SELECT row_key, {_cols((*CHECK_COLS, 'remarks'))}, load_ts FROM ({_versions_sql(3)}) ORDER BY row_key LIMIT 6"
    ),
    "batch_lookup_versions": (
        f"WITH v AS ({_versions_sql(3)}), r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')}) "
        f"SELECT r.req_id, v.row_key, {_fields(CHECK_FIELDS, (*CHECK_COLS, 'remarks'), 'v')} "
        "FROM r JOIN v ON r.check_id = v.check_id"
    ),
    "envelope_unknown_cells": (
        f"WITH k AS ({_check_keyed(3)}), r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')}), "
        "c AS (SELECT check_id, count(*) AS n, max(CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN 1 ELSE 0 END) AS u "
        "FROM k GROUP BY check_id) "
        f"SELECT r.req_id, {_envelope_sql('coalesce(c.u, 0) = 1')}, "
        "CASE WHEN coalesce(c.u, 0) = 1 THEN NULL ELSE coalesce(c.n, 0) END AS n_data "
        "FROM r LEFT JOIN c ON r.check_id = c.check_id"
    ),
    "batch_lookup_opinion": (
        f"WITH t AS ({_opinion_keyed(3, OPINION_WIDE_SRC)}), r AS ({_PAIR_REQS}) "
        f"SELECT r.req_id, t.row_key, {_fields(OPINION_FIELDS, OPINION_COLS, 't')} FROM r JOIN t "
        "ON r.buss_no || r.business_type = t.buss_no || t.business_type"
    ),
    "key_fallbacks": (
        "SELECT id, CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN NULL ELSE salt END AS salt, "
        f"CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 0 ELSE salt END AS partition_id FROM ({_check_keyed(3)})"
    ),
    "cells_open": (
        "WITH c AS (SELECT CAST(o_custkey AS VARCHAR) AS row_key, 'm' || month(o_orderdate) AS q, arg_max(o_orderpriority, o_orderkey) AS v "
        "FROM orders GROUP BY ALL), s AS (SELECT CAST(o_custkey AS VARCHAR) AS row_key, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY ALL) "
        "SELECT row_key, any_value(status) AS status, NULL::VARCHAR AS never, string_agg(q || '=' || v, ',' ORDER BY q || '=' || v) AS others "
        "FROM c JOIN s USING (row_key) GROUP BY row_key"
    ),
    "java_order_rank": (
        # code points above U+FFFF sort as surrogates: below U+E000
        "WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN chr(128512) WHEN 1 THEN chr(57344) WHEN 2 THEN chr(65533) ELSE 'z' END || "
        "string_split(text, chr(10))[1] AS k FROM documents), "
        "u AS (SELECT doc_id, list_transform(string_split(k, ''), lambda c: CASE WHEN unicode(c) > 65535 "
        "THEN CAST(55296 + ((unicode(c) - 65536) >> 10) AS BIGINT) * 65536 + 56320 + ((unicode(c) - 65536) & 1023) ELSE CAST(unicode(c) AS BIGINT) * 65536 END) AS k FROM t) "
        "SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) AS pos FROM u"
    ),
    "batch_lookup_bucketed": (
        f"WITH k AS ({_check_keyed(3)}), r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')}) "
        f"SELECT r.req_id, k.row_key, {_fields(CHECK_FIELDS, CHECK_COLS, 'k')} FROM r JOIN k ON r.check_id = k.check_id"
    ),
    "batch_lookup_bucketed_hot": (
        f"WITH h AS (SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'HOT' ELSE check_id END AS check_id) FROM ({CHECK_SRC})), "
        f"k AS (SELECT *, {_keys_sql('check_id', 'id', 3)} FROM h), "
        f"r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')} UNION ALL SELECT 'hot', 'HOT') "
        f"SELECT r.req_id, k.row_key, {_fields(CHECK_FIELDS, CHECK_COLS, 'k')} FROM r JOIN k ON r.check_id = k.check_id"
    ),
    "batch_lookup_prefiltered": (
        f"WITH k AS ({_check_keyed(3)}), r AS ({_CUSTOMER_REQS.format(known='CAST(c_custkey AS VARCHAR)')}) "
        f"SELECT r.req_id, k.row_key, {_fields(CHECK_FIELDS, CHECK_COLS, 'k')} FROM r JOIN k ON r.check_id = k.check_id WHERE r.check_id LIKE '%7'"
    ),
    "scan_ranges": (
        f"WITH k AS ({_check_keyed(3)}), l AS (SELECT 'c' || c_custkey AS req_id, (c_custkey % 3) || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3) AS start FROM customer), "
        "r AS (SELECT req_id, start, substr(start, 1, 3) || 'g' AS stop FROM l UNION ALL "
        "SELECT 'n' || n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN (n_nationkey % 3) || lower(hex(n_nationkey % 16)) END, "
        "CASE WHEN n_nationkey % 4 <> 0 THEN (n_nationkey % 3) || '8f' END FROM nation) "
        "SELECT r.req_id, k.row_key, k.id, k.rule_type FROM r JOIN k ON (r.start IS NULL OR k.row_key >= r.start) AND (r.stop IS NULL OR k.row_key < r.stop)"
    ),
    "sql_row_keys": f"SELECT id, check_id, salt, prefix, row_key FROM ({_check_keyed(3)})",
    "sql_lookup": f"WITH k AS ({_check_keyed(3)}) SELECT row_key, {_cols(CHECK_COLS)} FROM k WHERE check_id = ({_TOP_CHECK})",
    "sql_lookup_lateral": (
        f"WITH k AS ({_check_keyed(3)}), "
        f"r AS ({_CUSTOMER_REQS.format(known='CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END')}) "
        "SELECT r.req_id, k.row_key, k.id, k.rule_type FROM r JOIN k ON r.check_id = k.check_id"
    ),
    "sql_range": f"SELECT row_key, id FROM ({_check_keyed(3)}) WHERE row_key >= '08' AND row_key < '1c'",
    "described_job": (
        f"SELECT {_cols(OPINION_COLS)}, 'keyspace:opinion' AS table_name, 5::BIGINT AS load_ts, '3' AS executor_instances, "
        f"'4' AS executor_cores, '6G' AS executor_memory FROM ({OPINION_SRC})"
    ),
    "load_counts": (
        "SELECT count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS n_read, count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS n_loaded, "
        "count(*) FILTER (WHERE o_orderkey % 7 = 0) AS n_rejected FROM orders"
    ),
    "sketched_prefixes": (
        "SELECT salt, sum(CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 2 ELSE 1 END)::BIGINT AS n_rows, "
        f"count(DISTINCT prefix) AS n_prefixes, true AS near FROM ({_check_keyed(3)}) GROUP BY salt"
    ),
    "merged_bloom_rows": (
        "SELECT salt, prefix, row_key, id, check_id, rule_no, rule_type, "
        "CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'again' ELSE rule_desc END AS rule_desc, CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 3 "
        f"WHEN CAST(id AS BIGINT) % 3 = 0 THEN 1 ELSE 2 END::BIGINT AS load_ts FROM ({_check_keyed(3)})"
    ),
    "lookup_response": (
        f"WITH k AS ({_check_keyed(3)}) SELECT 'top' AS req_id, {_envelope_sql('false')}, row_number() OVER (ORDER BY row_key) AS pos, "
        f"{_fields(CHECK_FIELDS, CHECK_COLS)} FROM k WHERE check_id = ({_TOP_CHECK}) UNION ALL "
        f"SELECT 'none', {_envelope_sql('false')}, NULL, {_fields(CHECK_FIELDS, ())} UNION ALL "
        f"SELECT 'null', {_envelope_sql('true')}, NULL, {_fields(CHECK_FIELDS, ())}"
    ),
    "list_tables_by_priority": (
        "SELECT DISTINCT 'keyspace_priority:orders_' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') AS qualified_name FROM orders"
    ),
    "list_tables": "SELECT 'keyspace:check' AS qualified_name UNION ALL SELECT 'keyspace:opinion'",
    "batch_envelope_opinion": (
        f"WITH t AS ({_opinion_keyed(3, OPINION_WIDE_SRC)}), r AS ({_PAIR_REQS}), "
        "c AS (SELECT buss_no || business_type AS qk, count(*) AS n FROM t GROUP BY 1) "
        f"SELECT r.req_id, {_envelope_sql('false')}, coalesce(c.n, 0) AS n_data "
        "FROM r LEFT JOIN c ON r.buss_no || r.business_type = c.qk"
    ),
}


# ============================================================ pipeline operators

try:  # the subpackage and the pipeline may be absent; nothing else depends on them
    import corpus_pipeline
    from saltkv.llm import queries as _llm
except ImportError:
    pass
else:
    QUERIES |= _llm.QUERIES | {"pipeline": corpus_pipeline.run}
    ORACLE |= _llm.ORACLE
    if corpus_pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

# ============================================================ contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: key the ``check`` table, look up the busiest customer's rows
    (literal salt and prefix), in row-key order, in the fixed result schema."""
    t = check_table(spark, SF_SMOKE)
    top = (
        FX.check_rows(spark, SF_SMOKE).groupBy("check_id").count()
        .orderBy(F.desc("count"), F.asc("check_id")).first()
    )
    return LK.lookup(t, FX.CHECK, top["check_id"], CHECK_FIELDS, keep_row_key=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}

"""The published table: one directory per load, one sub-directory per salt.

::

    <table>/load_ts=<millis>/salt=<i>/part-*.parquet            (files sorted by row_key)
    <table>/load_ts=<millis>/_sketch/part-*.parquet             (loads with Bloom filters; sources.sketches)

A load is first written to a staging directory, outside the table, then
renamed into the table in one file-system call (atomic on HDFS), so a reader
sees a load entirely or not at all.  Reading uses an explicit schema, so no
file footer is opened to infer it; ``load_ts`` and ``salt`` come from the
directory names and are pruned by partition filters.

A reader merges the loads newest-wins.  ``sources.merged`` keeps a merged copy of
a table by upserts, where reading many loads costs too much.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.layout import KEY_COLS, cluster_for_write, files_per_bucket_for, partition_by_salt, sort_within
from ..operators.merge import latest_row_wins, latest_wins
from .spec import TableSpec

KEY_FIELDS = ("prefix", "row_key")
VERSION = "load_ts"
MANIFEST = "_manifest.json"
#: The largest Bloom filter of a row group, 32 MB (25 million keys at the default rate).
MOST_BLOOM_BYTES = 1 << 25


def table_location(spec: TableSpec, store_root: str | None = None) -> str:
    if spec.table_path:
        return spec.table_path.rstrip("/")
    if not store_root:
        raise ValueError(f"table {spec.table_name} has no tablePath and no store root was given")
    return f"{store_root.rstrip('/')}/{spec.namespace}/{spec.table_name}"


def stored_schema(value_cols) -> StructType:
    """Schema of a table's files plus its two partition columns."""
    fields = [StructField(c, StringType(), True) for c in value_cols]
    fields += [StructField(c, StringType(), True) for c in KEY_FIELDS]
    fields += [StructField(VERSION, LongType(), True), StructField("salt", IntegerType(), True)]
    return StructType(fields)


def new_load_ts() -> int:
    """Wall-clock milliseconds: a later load wins, even for an older batch date."""
    return int(time.time() * 1000)


# ----------------------------------------------------------------- file system


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst`` in one call; the parent of ``dst`` is created."""
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    if fs.exists(d):
        raise FileExistsError(dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename {src} -> {dst} failed")


def list_loads(spark: SparkSession, table_dir: str) -> list[int]:
    """Published load versions, oldest first (directory listing on the driver;
    one entry per load, not per file)."""
    fs, p = _fs(spark, table_dir)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{VERSION}="):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def write_manifest(spark: SparkSession, load_dir: str, columns, may_have_nulls: bool, unique_keys: bool = True, **more) -> None:
    """A small JSON file inside a (staged) load: the columns it wrote, whether
    any value may be NULL and whether its row keys are unique (``more``: the numbers of loaded and rejected records).  Readers of the
    data skip it (leading underscore); ``current`` uses it to choose the merge."""
    fs, p = _fs(spark, f"{load_dir.rstrip('/')}/{MANIFEST}")
    out = fs.create(p, True)
    body = {"columns": list(columns), "nulls": bool(may_have_nulls), "unique": bool(unique_keys), **more}
    try:
        out.write(bytearray(json.dumps(body).encode()))
    finally:
        out.close()


def read_manifest(spark: SparkSession, load_dir: str) -> dict | None:
    fs, p = _fs(spark, f"{load_dir.rstrip('/')}/{MANIFEST}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def table_columns(spark: SparkSession, table_dir: str, fallback=()) -> list[str]:
    """Every value column any load wrote, in order of first appearance, from the
    manifests; ``fallback`` columns are kept too."""
    dirs = [f"{table_dir.rstrip('/')}/{VERSION}={ts}" for ts in list_loads(spark, table_dir)]
    out: list[str] = []
    for d in dirs:
        for c in (read_manifest(spark, d) or {}).get("columns", []):
            if c not in out:
                out.append(c)
    for c in fallback:
        if c not in out:
            out.append(c)
    return out


def whole_rows(spark: SparkSession, load_dirs, value_cols) -> bool:
    """True when every load wrote exactly ``value_cols``, no NULL, and each row
    key once: then the newest row of a key carries the newest value of every
    column, and one whole-row aggregate replaces one aggregate per column."""
    want = sorted(value_cols)
    for d in load_dirs:
        m = read_manifest(spark, d)
        if m is None or m.get("nulls", True) or not m.get("unique", False) or sorted(m.get("columns", [])) != want:
            return False
    return True


def staging_dir(table_dir: str, name: str) -> str:
    """A fresh staging directory inside the table's hidden ``_staging`` folder:
    on the table's own file system, so the publishing rename never crosses
    file systems, and skipped by every reader (leading underscore)."""
    return f"{table_dir.rstrip('/')}/_staging/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (one metadata call, no data read)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


# ----------------------------------------------------------------- write side


def write_options(bloom_filter: bool = False, expected_keys: int | None = None) -> dict[str, str]:
    """Snappy pages, dictionary encoding (Parquet default), and optionally a
    Bloom filter on ``prefix`` for point lookups.  A Bloom filter without a
    key-count hint is sized at its maximum (about 1 MB per file); ``sketches.expected_keys`` gives the hint."""
    opts = {"compression": "snappy"}
    if bloom_filter:
        opts["parquet.bloom.filter.enabled#prefix"] = "true"
        if expected_keys:
            opts["parquet.bloom.filter.expected.ndv#prefix"] = str(int(expected_keys))
            # about 10 bits a key, in a power of two; the default limit serves 800,000 keys
            want = 1 << (2 * int(expected_keys)).bit_length()
            opts["parquet.bloom.filter.max.bytes"] = str(min(MOST_BLOOM_BYTES, max(1 << 20, want)))
    return opts


def layout_for_write(keyed: DataFrame, spec: TableSpec, files_per_bucket: int | None = None, exact_partitioner: bool = False) -> DataFrame:
    value_cols = [c for c in keyed.columns if c not in ("salt", *KEY_FIELDS)]
    df = keyed.select(*value_cols, *KEY_FIELDS, "salt")
    if exact_partitioner:
        return sort_within(partition_by_salt(df, spec.pre_regions))
    return cluster_for_write(df, spec.pre_regions, files_per_bucket)


def stage_load(laid_out: DataFrame, stage_dir: str, bloom_filter: bool = False, expected_keys: int | None = None) -> str:
    """Write a laid-out load (see ``layout_for_write``) below ``stage_dir``."""
    (
        laid_out.write.mode("errorifexists")
        .options(**write_options(bloom_filter, expected_keys))
        .partitionBy("salt")
        .parquet(stage_dir)
    )
    return stage_dir


def claim_version(spark: SparkSession, table_dir: str, ts: int, owner: str) -> bool:
    """Take a version for one writer: an exclusive create, which the file system grants once.  A rename alone doesn't
    exclude: two writers may both find the target missing, and the second rename would land inside the first's."""
    fs, p = _fs(spark, f"{table_dir.rstrip('/')}/_claims/{int(ts)}")
    try:
        out = fs.create(p, False)
    except Exception as e:  # the JVM's FileAlreadyExistsException, in one of its classes
        if "AlreadyExists" in str(e) or "already exists" in str(e).lower():
            return False
        raise
    try:
        out.write(bytearray(owner.encode()))
    finally:
        out.close()
    return True


def publish_load(spark: SparkSession, staged_dir: str, table_dir: str, load_ts: int | None = None) -> str:
    """Adopt a staged load as version ``load_ts`` of the table: an exclusive claim of the version, then one rename.
    Without a version it gets the wall clock of this moment, so a load that
    took long can't fall behind one that overtook it; if that is taken, the next free one."""
    ts = int(load_ts) if load_ts is not None else new_load_ts()
    while True:
        target = f"{table_dir.rstrip('/')}/{VERSION}={ts}"
        if claim_version(spark, table_dir, ts, staged_dir):
            rename(spark, staged_dir, target)
            return target
        if load_ts is not None:
            raise FileExistsError(f"{target}: version {ts} is published or claimed (see {table_dir.rstrip('/')}/_claims)")
        ts += 1


REJECTED = "_rejected"


def read_rejected(spark: SparkSession, table_dir: str, load_ts: int) -> DataFrame:
    """The records that a permissive load set aside: ``value, n_fields``."""
    d = f"{table_dir.rstrip('/')}/{VERSION}={int(load_ts)}/{REJECTED}"
    fs, p = _fs(spark, d)
    schema = "value string, n_fields int"
    return spark.read.schema(schema).parquet(d) if fs.exists(p) else spark.createDataFrame([], schema)


# ----------------------------------------------------------------- read side


def read_loads(spark: SparkSession, table_dir: str, value_cols, loads: list[int] | None = None) -> DataFrame:
    """All rows of all (or the given) loads, with ``load_ts`` and ``salt``.

    A column missing from an older load's files reads as NULL.
    """
    schema = stored_schema(value_cols)
    if loads is None:
        loads = list_loads(spark, table_dir)
    if not loads:
        return spark.createDataFrame([], schema)
    paths = [f"{table_dir.rstrip('/')}/{VERSION}={ts}" for ts in loads]
    return spark.read.schema(schema).option("basePath", table_dir).parquet(*paths)


def _load_dirs(table_dir: str, loads: list[int]) -> list[str]:
    return [f"{table_dir.rstrip('/')}/{VERSION}={ts}" for ts in loads]


def _unique_keys(spark: SparkSession, dirs: list[str]) -> bool:
    """Does every manifest say that its row keys are unique?"""
    return all((read_manifest(spark, d) or {}).get("unique", False) for d in dirs)


def current(spark: SparkSession, table_dir: str, value_cols=None, as_of: int | None = None) -> DataFrame:
    """The table as a reader sees it: per row key and column, the newest value.

    With a single load whose manifest says that row keys are unique the merge is skipped (no
    shuffle).  ``as_of`` reads the table as it was when that load was newest.
    ``value_cols`` defaults to every column the loads' manifests list.
    """
    if value_cols is None:
        value_cols = table_columns(spark, table_dir)
    loads = [ts for ts in list_loads(spark, table_dir) if as_of is None or ts <= as_of]
    cols = list(value_cols)
    df = read_loads(spark, table_dir, cols, loads)
    dirs = _load_dirs(table_dir, loads)
    if len(dirs) <= 1 and _unique_keys(spark, dirs):
        return df.select("salt", *KEY_FIELDS, *cols, VERSION)
    if len(dirs) == 1:  # one version: the larger value of each column, without a version beside each
        g = df.groupBy(*KEY_COLS).agg(*[F.max(c).alias(c) for c in cols], F.max(VERSION).alias(VERSION))
        return g.select(*KEY_COLS, *cols, VERSION)
    if whole_rows(spark, dirs, cols):
        return latest_row_wins(df).select("salt", *KEY_FIELDS, *cols, VERSION)
    return latest_wins(df, cols)


def _nth_key(raw: DataFrame, n: int, copies: int, rounds: int = 4) -> str | None:
    """The ``n``-th distinct row key in order, or ``None`` if there are fewer.  A top-n in each task of ``copies`` rows for each key
    wanted holds all copies of its keys but the last's; the next round goes on behind that.  Keys with far more copies than
    that leave the rest to a distinct after some rounds."""
    found = 0
    for _ in range(rounds):
        most = max(1, (n - found) * copies)
        keys = raw.orderBy("row_key").limit(most).groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).orderBy("row_key")
        place = F.row_number().over(Window.orderBy("row_key"))  # of at most ``most`` keys
        got = keys.select("row_key", "n", place.alias("k")).where(F.col("k") == n - found).first()
        if got is not None:
            return got["row_key"]
        end = keys.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"), F.max("row_key").alias("last")).first()
        if (end["rows"] or 0) < most:
            return None
        found += end["keys"]
        raw = raw.where(F.col("row_key") > F.lit(end["last"]))
    top = raw.distinct().orderBy("row_key").limit(n - found).agg(F.count(F.lit(1)).alias("keys"), F.max("row_key").alias("last")).first()
    return top["last"] if top["keys"] == n - found else None


def first_rows(spark: SparkSession, table_dir: str, n: int, value_cols=None) -> DataFrame:
    """The first ``n`` rows of the newest-wins table in row-key order (a
    top-n scan) without merging the whole table.

    Loads with unique row keys hold each key at most once, so the first
    ``n`` keys of the merged table are among the first ``n * loads`` rows of
    the raw loads.  Those rows are taken with a per-task top-n (no
    full shuffle) and semi-joined below the merge, so only their keys are
    merged.  Where a load may repeat keys, the ``n``-th distinct key is found first
    (``_nth_key``), and only rows up to it are merged.
    """
    cur = current(spark, table_dir, value_cols)
    loads = list_loads(spark, table_dir)
    dirs = _load_dirs(table_dir, loads)
    unique = _unique_keys(spark, dirs)
    if len(dirs) <= 1 and unique:
        return cur.orderBy("row_key").limit(n)
    raw = read_loads(spark, table_dir, [], loads).select("row_key")
    if not unique:
        last = _nth_key(raw, n, 4 * len(dirs))
        return (cur if last is None else cur.where(F.col("row_key") <= F.lit(last))).orderBy("row_key").limit(n)
    candidates = raw.orderBy("row_key").limit(n * len(dirs))
    top = cur.join(candidates, "row_key", "left_semi").select(*cur.columns)
    return top.orderBy("row_key").limit(n)


# ----------------------------------------------------------------- catalog


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`{loc}")


def create_table(spark: SparkSession, spec: TableSpec, table_dir: str, value_cols=None, bloom_filter: bool = False,
                 namespace_location: str | None = None) -> str:
    """Register the table (partitioned by ``load_ts, salt``) in the catalog and
    pick up its published loads.  The catalog table holds every stored version
    (one row per load); ``create_current_view`` adds the newest-wins view."""
    cols = list(value_cols or spec.cols)
    create_namespace(spark, spec.namespace, namespace_location)
    fs, p = _fs(spark, table_dir)
    fs.mkdirs(p)  # a table may be created before its first load
    ddl_cols = ", ".join([f"`{c}` STRING" for c in (*cols, *KEY_FIELDS)] + [f"`{VERSION}` BIGINT", "`salt` INT"])
    opts = ", ".join(f"'{k}' '{v}'" for k, v in write_options(bloom_filter).items())
    name = f"`{spec.namespace}`.`{spec.table_name}`"
    if spark.catalog.tableExists(name) and not registered_at(spark, spec, table_dir):
        spark.sql(f"DROP TABLE {name}")  # an entry for another place; its files stay
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl_cols}) USING parquet "
        f"OPTIONS ({opts}) PARTITIONED BY ({VERSION}, salt) LOCATION '{table_dir}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def create_current_view(spark: SparkSession, spec: TableSpec, value_cols=None, view_name: str | None = None) -> str:
    """A SQL view with the newest non-NULL value per row key and column over
    the catalog table (which itself holds every stored version).

    ``SELECT … FROM <ns>.<table>_current WHERE salt = 1 AND prefix = '…'`` is a
    pruned point lookup: both filters are grouping keys of the view's
    aggregate, so Catalyst pushes them to the scan.
    """
    cols = list(value_cols or spec.cols)
    view = view_name or f"{spec.table_name}_current"
    merged = ", ".join(
        f"max(CASE WHEN `{c}` IS NOT NULL THEN named_struct('v', `{VERSION}`, 'x', `{c}`) END).x AS `{c}`"
        for c in cols
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW `{spec.namespace}`.`{view}` AS "
        f"SELECT salt, prefix, row_key, {merged}, max(`{VERSION}`) AS `{VERSION}` "
        f"FROM `{spec.namespace}`.`{spec.table_name}` GROUP BY salt, prefix, row_key"
    )
    return f"`{spec.namespace}`.`{view}`"


def _norm_path(p: str) -> str:
    p = p.rstrip("/")
    return p[len("file:"):] if p.startswith("file:") else p


def registered_at(spark: SparkSession, spec: TableSpec, table_dir: str) -> bool:
    """Is ``<namespace>.<table>`` a catalog table whose location is ``table_dir``?"""
    name = f"`{spec.namespace}`.`{spec.table_name}`"
    if not spark.catalog.tableExists(name):
        return False
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location").collect()
    return bool(loc) and _norm_path(loc[0]["data_type"]) == _norm_path(table_dir)


def refresh_table(spark: SparkSession, spec: TableSpec, table_dir: str | None = None) -> None:
    """Make newly published loads visible to catalog readers, and (with
    ``table_dir``) columns that loads added, in the table and its newest-wins view."""
    name = f"`{spec.namespace}`.`{spec.table_name}`"
    if table_dir is not None:
        have = {c.lower() for c in spark.table(name).columns}
        new = [c for c in table_columns(spark, table_dir) if c.lower() not in have]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` STRING' for c in new)})")
            view = f"{spec.table_name}_current"
            if spark.catalog.tableExists(f"`{spec.namespace}`.`{view}`"):
                create_current_view(spark, spec, table_columns(spark, table_dir, spec.cols), view)
    spark.sql(f"MSCK REPAIR TABLE {name}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """``namespace:table`` per table of the namespace, sorted."""
    t = spark.sql(f"SHOW TABLES IN `{namespace}`").where(~F.col("isTemporary"))
    return t.select(F.concat(F.col("namespace"), F.lit(":"), F.col("tableName")).alias("qualified_name")).orderBy("qualified_name")


def list_tables_text(spark: SparkSession, namespace: str) -> str:
    """The listing as text, one name per line (a catalog call, not a data job)."""
    try:
        return "\n".join(r.qualified_name for r in list_tables(spark, namespace).collect())
    except Exception:  # noqa: BLE001 - the listing reports any failure as text
        return "get table list error"

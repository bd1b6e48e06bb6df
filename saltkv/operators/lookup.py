"""Key lookups, range scans and the response envelope.

* ``lookup``: one key (single or composite).  Salt and prefix are computed in
  Python and enter the plan as literals, so the salt partition is pruned and
  the prefix equality reaches the Parquet reader (row groups of the sorted
  files are skipped by their min/max).
* ``batch_lookup``: a DataFrame of requests joined to the table on
  ``(salt, prefix)``; the distinct keys and the requests are each broadcast
  only when their counts are under a bound, else the joins shuffle.
  Results stay flat, one row per (request, matching row), so no request's
  rows are ever gathered into a single task.
* ``batch_envelope``: the response header per request (status, code, message,
  system code, number of rows), from one count row per requested key.
* ``batch_reply_rows`` / ``lookup_response``: the answers' rows, flat, each with
  its position in row-key order.
* ``scan_range`` / ``scan_prefix`` / ``scan_limit``: row-key range scans with
  column projection and salt pruning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import NULL_TEXT, add_prefix, prefix_py, query_key_py, salt_width
from ..sources.spec import TableSpec
from .layout import rank_within_salt
from .prefilter import prefilter
from .skew import salted_join

# The response envelope.  Status, code, message and system code
# of a successful and of a failed lookup.
SUCCESS = ("S", "0", "交易成功", "475")
ERROR = ("E", "-1", "系统查询异常", "475")
ENVELOPE_FIELDS = ("rtn_sts", "rtn_code", "rtn_msg", "sys_code")

INTERNAL = ("salt", "prefix", "row_key", "load_ts")

class UnknownColumnError(ValueError):
    """The table stores a column the result schema does not have."""


class NullKeyError(ValueError):
    """A single-column lookup key is NULL."""


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in INTERNAL]


def check_fields(df: DataFrame, fields: Sequence[str]) -> None:
    unknown = [c for c in _value_columns(df) if c not in fields]
    if unknown:
        raise UnknownColumnError(f"stored columns outside the result schema: {unknown}")


def unknown_columns(df: DataFrame, fields: Sequence[str]) -> list[str]:
    return [c for c in _value_columns(df) if c not in fields]


def unknown_cell_flag(df: DataFrame, fields: Sequence[str]):
    """True for a row holding a cell (a non-NULL value) in a column outside
    ``fields``: the rows a fixed-schema reader cannot assemble."""
    flag = F.lit(False)
    for c in unknown_columns(df, fields):
        flag = flag | F.col(c).isNotNull()
    return flag


def project_fields(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), check: bool = True) -> DataFrame:
    """Fixed-schema projection: a stored column fills its field, a field never
    written is NULL, a stored column without a field raises before any job."""
    if check:
        check_fields(df, fields)
    have = set(df.columns)
    out = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in fields]
    return df.select(*[F.col(k) for k in keep], *out)


def _key_values(spec: TableSpec, key) -> list:
    if isinstance(key, Mapping):
        return [key.get(c) for c in spec.query_key]
    if isinstance(key, (list, tuple)):
        if len(key) != len(spec.query_key):
            raise ValueError(f"key needs {len(spec.query_key)} values")
        return list(key)
    if len(spec.query_key) != 1:
        raise ValueError("a composite key needs a mapping or a sequence")
    return [key]


def key_literals(spec: TableSpec, key) -> tuple[int, str, list]:
    """``(salt, prefix, values)`` of one lookup key, computed in Python."""
    values = _key_values(spec, key)
    if len(values) == 1 and values[0] is None:
        raise NullKeyError("lookup key is NULL")
    s, p = prefix_py(query_key_py(values), spec.pre_regions)
    return s, p, values


def lookup(
    table: DataFrame,
    spec: TableSpec,
    key,
    fields: Sequence[str] | None = None,
    exact: bool = False,
    keep_row_key: bool = False,
) -> DataFrame:
    """Rows of one key, in row-key order, projected to ``fields``.

    The default answers like a prefix scan: a composite key is matched by its
    concatenation, so ``("105", "19")`` also finds ``("1051", "9")``.
    ``exact=True`` adds equality on every key column.
    """
    s, p, values = key_literals(spec, key)
    df = table.where((F.col("salt") == F.lit(s)) & (F.col("prefix") == F.lit(p)))
    if exact:
        for c, v in zip(spec.query_key, values):
            df = df.where(F.col(c) == F.lit(NULL_TEXT if v is None else str(v)))
    fields = list(fields or spec.result_fields() or spec.cols)
    out = project_fields(df, fields, keep=["row_key"]).orderBy("row_key")
    return out if keep_row_key else out.drop("row_key")


def request_keys(requests: DataFrame, spec: TableSpec, key_cols: Sequence[str] | None = None, hash_method: str | None = None) -> DataFrame:
    """Add ``salt``, ``prefix`` and ``__bad`` (a NULL single key) to requests."""
    key_cols = list(key_cols or spec.query_key)
    bad = F.col(key_cols[0]).isNull() if len(key_cols) == 1 else F.lit(False)
    return add_prefix(requests.withColumn("__bad", bad), key_cols, spec.pre_regions, hash_method)


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _bytes(text: str) -> int:
    t = text.strip().lower()
    num = t.rstrip("kmgb")
    return int(float(num) * _UNITS[t[len(num):]])


def _broadcast_bound(spark: SparkSession) -> int:
    """Bytes that may be broadcast: the session's threshold (0 if it is ``-1``)."""
    return max(0, _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")))


def _row_bytes(cols: Sequence[str]):
    """Bytes of a row of these columns as text, with 16 a column for the row format."""
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in cols), F.lit(16)).cast("long")


def batch_lookup(
    table: DataFrame,
    spec: TableSpec,
    requests: DataFrame,
    req_id: str = "req_id",
    key_cols: Sequence[str] | None = None,
    fields: Sequence[str] | None = None,
    exact: bool = False,
    broadcast_requests: bool | None = None,
    flag_unknown: bool = False,
    salt_hot_keys: int = 16,
    hot_rows: int = 100_000,
    bloom: bool = True,
) -> DataFrame:
    """One row per (request, matching table row): ``req_id, row_key, fields…``.

    Requests whose single key is NULL match nothing (their envelope is an
    error).  One pass over the requests adds up the bytes of the requests and
    of their distinct keys: each side is broadcast only when its bytes fit the
    broadcast threshold, and the salts asked for become a partition filter on
    the table.  ``broadcast_requests=False`` never broadcasts; ``True`` still
    checks.  Only when even the distinct keys exceed the threshold does the
    table shuffle on ``(salt, prefix)``; then a Bloom filter of the requested
    prefixes (``prefilter``; ``bloom=False`` leaves it out) drops the rows that
    match nothing before the shuffle, and hot keys are split.

    A stored column outside ``fields`` raises, unless ``flag_unknown``: then
    the output gets ``__unknown_cell`` (the row holds a value in such a column).

    Where requests and rows meet in a shuffle, every key that matches at least
    ``hot_rows`` rows has them spread over ``salt_hot_keys`` sub-partitions by
    row-key hash and its requests copied to each; a key with as many
    requests has its requests spread and its rows copied.  Each (request, row)
    pair still meets exactly once.
    """
    spark = table.sparkSession
    key_cols = list(key_cols or spec.query_key)
    fields = list(fields or spec.result_fields() or spec.cols)
    if not flag_unknown:
        check_fields(table, fields)
    renamed = {c: f"__req_{i}" for i, c in enumerate(key_cols)}
    req = request_keys(requests.select(req_id, *key_cols), spec, key_cols)
    req = req.where(~F.col("__bad")).select(req_id, "salt", "prefix", *[F.col(c).alias(r) for c, r in renamed.items()])

    # At most n rows come back: bytes of requests and of distinct keys by salt.
    per_salt = req.groupBy("salt", "prefix").agg(F.sum(_row_bytes(req.columns)).alias("b")).groupBy("salt").agg(
        F.sum("b").alias("b"), F.sum(_row_bytes(["salt", "prefix"])).alias("k"), F.count(F.lit(1)).alias("n")
    ).collect()
    bound = 0 if broadcast_requests is False else _broadcast_bound(spark)
    small_requests = sum(r["b"] for r in per_salt) <= bound
    small_keys = sum(r["k"] for r in per_salt) <= bound
    salts = sorted(r["salt"] for r in per_salt)
    t = table
    if len(salts) < spec.pre_regions:
        t = t.where(F.col("salt").isin(salts) if salts else F.lit(False))
    # The semi join on the distinct keys is pushed by Catalyst below a
    # latest-wins merge (salt and prefix are its grouping keys), so only the
    # versions of requested keys are merged; the inner join then fans the
    # matches out to the requests.  The distinct keys are broadcast whenever
    # they fit, even when the requests do not: then the table never shuffles,
    # and only the matched rows meet the requests in a shuffle join.
    keys = req.select("salt", "prefix").distinct()
    on = ["salt", "prefix"]
    if small_requests:
        m = t.join(F.broadcast(keys), on, "left_semi").join(F.broadcast(req), on, "inner")
    elif small_keys:
        m = salted_join(t.join(F.broadcast(keys), on, "left_semi"), req, on, "row_key", req_id, salt_hot_keys, hot_rows)
    else:
        # no semi join: it would move a hot key whole.  The filter takes its place.
        m = salted_join(prefilter(t, keys, sum(r["n"] for r in per_salt)) if bloom else t, req, on, "row_key", req_id, salt_hot_keys, hot_rows)
    if exact:
        for c, r in renamed.items():
            m = m.where(F.col(c) == F.coalesce(F.col(r).cast("string"), F.lit(NULL_TEXT)))
    keep = [req_id, "row_key"]
    if flag_unknown:
        m = m.withColumn("__unknown_cell", unknown_cell_flag(table, fields))
        keep.append("__unknown_cell")
    return project_fields(m, fields, keep=keep, check=False)


def _envelope_cols(ok) -> list:
    return [F.when(ok, F.lit(s)).otherwise(F.lit(e)).alias(name) for name, s, e in zip(ENVELOPE_FIELDS, SUCCESS, ERROR)]


def batch_envelope(
    table: DataFrame,
    spec: TableSpec,
    requests: DataFrame,
    req_id: str = "req_id",
    key_cols: Sequence[str] | None = None,
    fields: Sequence[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Response header per request row: ``req_id, rtn_sts, rtn_code, rtn_msg,
    sys_code, n_data`` (``n_data`` NULL on error).

    A NULL single key, or a matched row holding a value in a column outside
    the result schema, gives the error envelope (a request that matches
    nothing is a success with no rows).  The table's matched rows are counted
    per key (combinable, before any request meets them), and each request is
    joined to its key's one count row: neither a repeated ``req_id`` nor a
    key with many rows and many requests multiplies anything.
    """
    key_cols = list(key_cols or spec.query_key)
    fields = list(fields or spec.result_fields() or spec.cols)
    texts = {f"__k{i}": c for i, c in enumerate(key_cols)} if exact else {}
    head = request_keys(requests.select(req_id, *key_cols), spec, key_cols)
    head = head.withColumns({k: F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for k, c in texts.items()})
    on = ["salt", "prefix", *texts]
    asked = head.where(~F.col("__bad")).select("salt", "prefix").distinct()
    t = table.withColumn("__unknown_cell", unknown_cell_flag(table, fields)).join(asked, ["salt", "prefix"], "left_semi")
    per = t.withColumns({k: F.col(c) for k, c in texts.items()}).groupBy(*on).agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.col("__unknown_cell").cast("int")).alias("__u")
    )
    j = head.join(per, on, "left")
    # An error: a NULL single key, or a matched row holding a cell the result
    # schema has no field for.
    ok = ~F.col("__bad") & (F.coalesce(F.col("__u"), F.lit(0)) == 0)
    return j.select(req_id, *_envelope_cols(ok), F.when(ok, F.coalesce(F.col("__n"), F.lit(0))).cast("long").alias("n_data"))


def with_position(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows`` (distinct row keys, with salt and prefix) plus ``pos``, the 1-based
    position of each among the rows of its key, in row-key order.  The rank
    inside a salt comes from range partitions, so no key passes through one
    task; a key's rows are contiguous in it, and its first rank is a combinable minimum."""
    ranked = rank_within_salt(rows, spec.pre_regions, name="__rank")
    first = ranked.groupBy("salt", "prefix").agg(F.min("__rank").alias("__first"))
    return ranked.join(first, ["salt", "prefix"]).withColumn("pos", F.col("__rank") - F.col("__first") + 1).drop("__rank", "__first")


def batch_reply_rows(
    table: DataFrame,
    spec: TableSpec,
    requests: DataFrame,
    req_id: str = "req_id",
    key_cols: Sequence[str] | None = None,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """The answers' rows in order, flat: ``req_id, pos, fields``.  ``pos`` numbers
    the rows of the requested key from 1 in row-key order; it is computed on the
    table's matched rows, before requests fan out."""
    key_cols = list(key_cols or spec.query_key)
    fields = list(fields or spec.result_fields() or spec.cols)
    req = request_keys(requests.select(req_id, *key_cols), spec, key_cols).where(~F.col("__bad"))
    matched = table.join(req.select("salt", "prefix").distinct(), ["salt", "prefix"], "left_semi")
    placed = with_position(matched, spec).withColumn("__pos", F.col("pos")).drop("pos")
    out = batch_lookup(placed, spec, requests, req_id, key_cols, [*fields, "__pos"])
    return out.select(req_id, F.col("__pos").cast("long").alias("pos"), *fields)


def lookup_response(table: DataFrame, spec: TableSpec, key, fields: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """The answer to one request, flat: the envelope and, on success, a row for
    each data row with its position (``pos`` from 1, in row-key order) and
    fields.  An error, or an answer without rows, is one row whose ``pos`` is NULL."""
    spark = table.sparkSession
    fields = list(fields or spec.result_fields() or spec.cols)

    def head(values):
        return spark.range(1).select(*[F.lit(v).alias(n) for n, v in zip(ENVELOPE_FIELDS, values)])

    nothing = [F.lit(None).cast("long").alias("pos"), *[F.lit(None).cast("string").alias(c) for c in fields]]
    try:
        salt, prefix, _ = key_literals(spec, key)
    except NullKeyError:
        return head(ERROR).select("*", *nothing)
    unknown = unknown_columns(table, fields)
    if unknown:
        flagged = table.withColumn("__unknown_cell", unknown_cell_flag(table, fields)).drop(*unknown)
        probe = lookup(flagged, spec, key, [*fields, "__unknown_cell"], exact, keep_row_key=True)
        if probe.where(F.col("__unknown_cell")).limit(1).count():
            return head(ERROR).select("*", *nothing)
        table = table.drop(*unknown)
    rows = lookup(table, spec, key, fields, exact, keep_row_key=True).select(F.lit(salt).alias("salt"), F.lit(prefix).alias("prefix"), "row_key", *fields)
    rows = with_position(rows, spec).select("pos", *fields)
    return head(SUCCESS).join(rows, F.lit(True), "left")  # one row with all: nothing is multiplied


# ----------------------------------------------------------------- range scans


def _salt_bounds(start: str | None, stop: str | None, n: int):
    w = salt_width(n)
    lo = int(start[:w]) if start and len(start) >= w and start[:w].isascii() and start[:w].isdecimal() else None
    hi = int(stop[:w]) if stop and len(stop) >= w and stop[:w].isascii() and stop[:w].isdecimal() else None
    return lo, hi


def _columns(spec: TableSpec, columns):
    if columns is None:
        return None
    out = []
    for c in columns:
        if ":" in c:
            fam, q = c.split(":", 1)
            if fam != spec.cf:
                raise ValueError(f"no column family {fam!r} in {spec.qualified_name}")
            out.append(q)
        else:
            out.append(c)
    return out


def scan_range(
    table: DataFrame,
    spec: TableSpec,
    start: str | None = None,
    stop: str | None = None,
    columns: Sequence[str] | None = None,
    family: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Rows with ``start <= row_key < stop`` (either bound optional).

    ``columns`` may be given as ``family:qualifier``; a family other than the
    table's raises.  The row-key bounds are pushed to Parquet and the salts
    they span become a partition filter.  ``ordered=True`` returns the rows in
    row-key order, as a store scan does (a range-partitioned sort).
    """
    if family is not None and family != spec.cf:
        raise ValueError(f"no column family {family!r} in {spec.qualified_name}")
    df = table
    if start is not None:
        df = df.where(F.col("row_key") >= F.lit(start))
    if stop is not None:
        df = df.where(F.col("row_key") < F.lit(stop))
    lo, hi = _salt_bounds(start, stop, spec.pre_regions)
    if lo is not None:
        df = df.where(F.col("salt") >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col("salt") <= F.lit(hi))
    cols = _columns(spec, columns)
    out = df.select("row_key", *cols) if cols is not None else df
    return out.orderBy("row_key") if ordered else out


def scan_prefix(table: DataFrame, spec: TableSpec, prefix: str, columns: Sequence[str] | None = None,
                ordered: bool = False) -> DataFrame:
    """Rows whose row key starts with ``prefix`` (the range [prefix, next_prefix(prefix)))."""
    df = table.where(F.col("row_key").startswith(prefix))
    lo, _ = _salt_bounds(prefix, None, spec.pre_regions)
    if lo is not None:
        df = df.where(F.col("salt") == F.lit(lo))
    cols = _columns(spec, columns)
    out = df.select("row_key", *cols) if cols is not None else df
    return out.orderBy("row_key") if ordered else out


def scan_limit(table: DataFrame, spec: TableSpec, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in row-key order (a top-n, not a full sort)."""
    cols = _columns(spec, columns)
    df = table.orderBy("row_key").limit(n)
    return df.select("row_key", *cols) if cols is not None else df

"""Delimited text batches: the input format of a load, and its export.

Records end with a record separator (default byte 0x10), columns are split by a
column separator (default byte 0x01), there is no header, and every value is a
string.  A newline is data, not a separator.  One directory holds one batch
date: ``<inputPathPrefix>/<batch_date>``.

The scan is Spark's ``text`` source with ``lineSep``: splittable, so a large
batch is read by as many tasks as it has file splits, and the split into
columns is one JVM expression (``split``) fused into the same stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spec import COL_SEP_HEX, RECORD_SEP_HEX, TableSpec, hex_to_text

RECORD_SEP = hex_to_text(RECORD_SEP_HEX)
COL_SEP = hex_to_text(COL_SEP_HEX)


@dataclass
class DelimitedBatch:
    """Parsed rows plus the records that could not be parsed (permissive mode)."""

    rows: DataFrame
    rejected: DataFrame


# Characters with a meaning in a Java regex.
_REGEX_META = ".$|()[]{}^?*+\\"


def _regex_literal(sep: str) -> str:
    """Java-regex form of a literal separator (``split`` takes a regex).

    A single plain character is passed as is and an escaped metacharacter as
    two characters: Java's ``String.split`` splits those without running the
    regex engine.  Anything longer is quoted.
    """
    if len(sep) == 1:
        return "\\" + sep if sep in _REGEX_META else sep
    if "\\E" in sep:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return "\\Q" + sep + "\\E"


def count_fields(value: Column, col_sep: str) -> Column:
    """Fields of a record when trailing empty fields are kept: separators + 1.
    A substring count, much cheaper than splitting."""
    n_sep = (F.length(value) - F.length(F.replace(value, F.lit(col_sep), F.lit("")))) / F.lit(len(col_sep))
    return (n_sep + 1).cast("int")


def split_record(value: Column, col_sep: str, drop_trailing_empty: bool) -> Column:
    """Split one record into its fields.

    ``drop_trailing_empty=True`` follows Java's ``String.split``: trailing empty
    fields vanish, so a record made only of separators has no field at all.
    Anchored with ``\\z`` (end of input), since ``$`` would also match before a
    final newline, and newlines are data here.
    """
    q = _regex_literal(col_sep)
    if not drop_trailing_empty:
        return F.split(value, q, -1)
    only_seps = value.rlike(f"^(?:{q})+\\z")
    trimmed = F.regexp_replace(value, f"(?:{q})+\\z", "")
    return F.when(only_seps, F.array().cast("array<string>")).otherwise(F.split(trimmed, q, -1))


def read_text_records(spark: SparkSession, path: str | list[str], record_sep: str = RECORD_SEP) -> DataFrame:
    """One row per record (column ``value``).  No empty record follows a final
    separator; a last record without separator is still read."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("lineSep", record_sep).option("wholetext", "false").text(paths)


def parse_records(
    records: DataFrame,
    cols: list[str] | tuple[str, ...],
    col_sep: str = COL_SEP,
    mode: str = "permissive",
) -> DelimitedBatch:
    """Turn ``value`` records into string columns named ``cols``.

    ``mode="failfast"``: Java split semantics; a record with fewer fields than
    ``cols`` (trailing empty fields included) fails the job, like the
    reference's array index error.  ``mode="permissive"``: trailing empty fields
    are kept as ``''``; short records go to ``rejected`` with their field count.
    Extra fields are ignored in both modes.
    """
    cols = list(cols)
    n = len(cols)
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    parts = split_record(F.col("value"), col_sep, drop_trailing_empty=(mode == "failfast"))
    staged = records.select(F.col("value"), parts.alias("__parts"))
    size = F.size("__parts")
    if mode == "failfast":
        msg = F.concat(F.lit(f"record has fewer than {n} fields: "), F.col("value"))
        fields = [
            F.when(size > i, F.get(F.col("__parts"), i)).otherwise(F.raise_error(msg)).alias(c)
            for i, c in enumerate(cols)
        ]
        rows = staged.select(*fields)
        rejected = staged.where(F.lit(False)).select("value", size.alias("n_fields"))
        return DelimitedBatch(rows, rejected)
    nf = count_fields(F.col("value"), col_sep)
    rows = (
        records.where(nf >= n)
        .select(parts.alias("__parts"))
        .select(*[F.get(F.col("__parts"), i).alias(c) for i, c in enumerate(cols)])
    )
    rejected = records.where(nf < n).select("value", nf.alias("n_fields"))
    return DelimitedBatch(rows, rejected)


def batch_path(spec: TableSpec, batch_date: str) -> str:
    if not spec.input_path_prefix:
        raise ValueError(f"table {spec.table_name} has no inputPathPrefix")
    return f"{spec.input_path_prefix.rstrip('/')}/{batch_date}"


def read_batch(
    spark: SparkSession,
    spec: TableSpec,
    batch_date: str | None = None,
    path: str | None = None,
    mode: str = "permissive",
    record_sep: str | None = None,
    col_sep: str | None = None,
) -> DelimitedBatch:
    """Read one dated batch of a table (``path`` overrides the dated path;
    separators default to the table description's)."""
    p = path or batch_path(spec, batch_date)
    rs = record_sep if record_sep is not None else spec.record_sep
    cs = col_sep if col_sep is not None else spec.col_sep
    return parse_records(read_text_records(spark, p, rs), spec.cols, cs, mode)


def to_record(df: DataFrame, cols, col_sep: str = COL_SEP, null_as: str = "", check: bool = True) -> Column:
    """One delimited record per row.  ``concat_ws`` would silently skip a NULL
    and shift every later field, so NULLs become ``null_as`` first."""
    vals = [F.coalesce(F.col(c).cast("string"), F.lit(null_as)) for c in cols]
    rec = F.concat_ws(col_sep, *vals)
    if not check:
        return rec
    bad = None
    for v in vals:
        hit = F.instr(v, col_sep) > 0
        bad = hit if bad is None else (bad | hit)
    return F.when(bad, F.raise_error(F.lit("value contains the column separator"))).otherwise(rec)


def write_delimited(
    df: DataFrame,
    path: str,
    cols=None,
    record_sep: str = RECORD_SEP,
    col_sep: str = COL_SEP,
    mode: str = "overwrite",
    null_as: str = "",
    check: bool = True,
) -> None:
    """Export rows as a delimited batch (fields ``col_sep``, records ``record_sep``).

    With ``check=True`` a value holding the column or record separator fails
    the job instead of producing a file that reads back differently.
    """
    cols = list(cols or df.columns)
    rec = to_record(df, cols, col_sep, null_as, check)
    if check:
        rec = F.when(F.instr(rec, record_sep) > 0, F.raise_error(F.lit("value contains the record separator"))).otherwise(rec)
    df.select(rec.alias("value")).write.mode(mode).option("lineSep", record_sep).text(path)

"""Rows <-> cells: the key/value view of a wide table.

A cell is ``(row_key, family, qualifier, value)``.  A cell exists or it does
not: a NULL column produces no cell, an empty string does.  ``to_cells`` is one
``Expand`` (``unpivot``), no shuffle.  ``from_cells`` groups the cells of a row
key with conditional ``max`` aggregates.  They are combinable, so repeated
copies of a cell collapse before the shuffle and no group ever holds more
than one entry per column.  (A ``collect_list`` form measured ~25% faster on
unique cells but would gather every copy of a repeated cell in one task.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_KEYS = ("salt", "prefix", "row_key")


def to_cells(df: DataFrame, value_cols: Sequence[str], family: str = "f", keys: Sequence[str] = ("row_key",), version: str | None = None) -> DataFrame:
    """One row per non-NULL column value: ``keys…, [version,] family, qualifier, value``."""
    ids = list(keys) + ([version] if version else [])
    cells = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in value_cols]).unpivot(
        ids, list(value_cols), "qualifier", "value"
    )
    return cells.where(F.col("value").isNotNull()).select(*ids, F.lit(family).alias("family"), "qualifier", "value")


def from_cells(
    cells: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = ("row_key",),
    family: str | None = None,
    version: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Assemble cells into rows with the fixed columns ``fields``.

    A field without a cell is NULL.  With ``version`` the newest cell of a
    column wins; otherwise the largest value (cells are unique per column in a
    load).  ``strict=True`` fails the job on a qualifier outside ``fields``,
    as assembling into a fixed schema cannot place it.  ``family`` keeps only
    that family's cells.
    """
    if family is not None:
        cells = cells.where(F.col("family") == F.lit(family))
    q = F.col("qualifier")
    aggs = []
    for c in fields:
        if version:
            aggs.append(F.max(F.when(q == F.lit(c), F.struct(F.col(version).alias("v"), F.col("value").alias("x"))))["x"].alias(c))
        else:
            aggs.append(F.max(F.when(q == F.lit(c), F.col("value"))).alias(c))
    if strict:
        aggs.append(F.max(F.when(~q.isin(list(fields)), q)).alias("__unknown"))
    rows = cells.groupBy(*keys).agg(*aggs)
    if strict:
        msg = F.concat(F.lit("no field for stored column "), F.col("__unknown"))
        guard = F.when(F.col("__unknown").isNotNull(), F.raise_error(msg))
        rows = rows.where(guard.isNull()).drop("__unknown")
    return rows.select(*keys, *fields)


def from_cells_open(
    cells: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = ("row_key",),
    version: str | None = None,
    others: str = "others",
) -> DataFrame:
    """Cells whose qualifiers aren't all declared, as rows: the fixed columns ``fields`` and a map ``others`` of
    every other qualifier to its value (empty if there is none).

    Copies of a cell combine first, by (key, qualifier) and before anything moves on; what a row then gathers is one entry for each of
    its qualifiers.  The newest value wins with ``version``, else the largest.  A cell without a value doesn't exist.
    """
    value = F.struct(F.col(version).alias("v"), F.col("value").alias("x")) if version else F.struct(F.col("value").alias("x"))
    one = cells.where(F.col("value").isNotNull()).groupBy(*keys, "qualifier").agg(F.max(value)["x"].alias("value"))
    q = F.col("qualifier")
    fixed = [F.max(F.when(q == F.lit(c), F.col("value"))).alias(c) for c in fields]
    entries = F.collect_list(F.when(~q.isin(list(fields)) if fields else F.lit(True), F.struct("qualifier", "value")))
    rows = one.groupBy(*keys).agg(*fixed, F.map_from_entries(F.array_sort(entries)).alias(others))
    return rows.select(*keys, *fields, others)


def to_binary_cells(cells: DataFrame) -> DataFrame:
    """The byte view of cells (UTF-8), as a store client receives them."""
    return cells.select(
        *[F.encode(F.col(c), "UTF-8").alias(c) for c in ("row_key", "family", "qualifier", "value")]
    )


def from_binary_cells(cells: DataFrame) -> DataFrame:
    return cells.select(
        *[F.decode(F.col(c), "UTF-8").alias(c) for c in ("row_key", "family", "qualifier", "value")]
    )

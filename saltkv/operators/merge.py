"""Versions across loads: the latest non-NULL value of every column wins.

Every load of a table is kept as written (a ``load_ts`` partition).  Reading
the table merges them per row key and column: a value written in a later load
replaces an older one, ``''`` included; a column the later load did not write
(NULL) keeps the older value.  That is the cell semantics of a versioned
key/value store with newest-version reads.

The grouping keys are ``(salt, prefix, row_key)``, so a filter on ``salt`` or
``prefix`` placed on the merged view is pushed below the aggregate, into the
partition filter and the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layout import KEY_COLS


def latest_wins(loads: DataFrame, value_cols, version: str = "load_ts", keys=KEY_COLS) -> DataFrame:
    """Merge all versions of every row key into one row (per-column newest non-NULL).

    Ties (one key twice in one load) resolve to the larger value, so the result
    is deterministic.  The aggregate is combinable: partial aggregation runs
    before the shuffle.
    """
    value_cols = [c for c in value_cols if c not in keys and c != version]
    aggs = []
    for c in value_cols:
        ver = F.when(F.col(c).isNotNull(), F.struct(F.col(version).alias("v"), F.col(c).alias("x")))
        aggs.append(F.max(ver)["x"].alias(c))
    aggs.append(F.max(version).alias(version))
    return loads.groupBy(*keys).agg(*aggs).select(*keys, *value_cols, version)


def latest_row_wins(loads: DataFrame, version: str = "load_ts", keys=KEY_COLS) -> DataFrame:
    """Whole-row variant for loads that always write every column: the newest
    row of each key, chosen with a combinable ``max(struct)`` (no window)."""
    others = [c for c in loads.columns if c not in keys and c != version]
    w = F.max(F.struct(F.col(version), *[F.col(c) for c in others])).alias("__w")
    return loads.groupBy(*keys).agg(w).select(*keys, *[F.col("__w")[c].alias(c) for c in others], F.col("__w")[version].alias(version))

"""Plan checks used by tests and the bench: read the physical plan text.

These look at what Catalyst chose (partition filters on the salt, pushed
Parquet filters, broadcast vs. nested-loop joins, exchanges), so a regression
in pruning or join strategy fails a test instead of only slowing a job.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """What ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def count_exchanges(df: DataFrame) -> int:
    """Shuffle exchanges in the physical plan (broadcasts not counted)."""
    return len(re.findall(r"\bExchange (?!.*Broadcast)", plan_text(df)))


def has_nested_loop_join(df: DataFrame) -> bool:
    txt = plan_text(df)
    return "BroadcastNestedLoopJoin" in txt or "CartesianProduct" in txt

"""Table descriptions, job resource settings and fixed result schemas.

A table is described by a Java-style ``.properties`` file::

    tableName=check
    namespace=keyspace
    cf=f
    preRegions=3
    uniqCol=id
    queryKey=check_id
    inputPathPrefix=/data/in/check
    hfilePathPrefix=/data/stage/check
    cols=id,check_id,rule_no,rule_type,rule_desc

``cols`` lists the delimited input columns in file order; every value is a
string.  ``queryKey`` lists the columns whose concatenation is hashed into the
row key; ``uniqCol`` is appended to make the key unique.  The optional
``tablePath`` names the directory of the published table (default:
``<store root>/<namespace>/<tableName>``); ``recordSepHex`` and ``colSepHex``
override the separators (hex bytes, default ``10`` and ``01``).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType

# Field names of the two result objects returned by lookups, in
# declaration order.  ``opinin`` is spelled as in the served schema.
CHECK_FIELDS = (
    "id", "check_id", "rule_no", "index_value", "rule_type", "hit_condition",
    "rule_desc", "hit_ind", "artificial_ver_result", "cause_code", "opinin",
    "create_by", "create_date", "update_by", "update_date", "remarks",
    "del_flag", "trunc_no",
)
OPINION_FIELDS = (
    "id", "buss_no", "current_queue", "target_queue", "submit_user",
    "submit_time", "submit_opinion", "submit_apply_summary", "business_type",
    "approval_opinion", "appr_result", "reason", "create_by", "create_date",
    "update_by", "update_date", "remarks", "del_flag", "trunc_no",
)
RESULT_FIELDS = {"check": CHECK_FIELDS, "opinion": OPINION_FIELDS}

# The record and column separators of the input files, as hex.
RECORD_SEP_HEX = "10"
COL_SEP_HEX = "01"

# The three job resource keys a <job>.conf file may set.
JOB_CONF_KEYS = ("spark.executor.cores", "spark.executor.instances", "spark.executor.memory")


def string_schema(names) -> StructType:
    """All-string, nullable schema in the given order."""
    return StructType([StructField(n, StringType(), True) for n in names])


def hex_to_text(h: str) -> str:
    """``"10"`` -> ``"\\x10"``: separators are configured as hex bytes."""
    return bytes.fromhex(h).decode("utf-8")


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    namespace: str
    uniq_col: str
    pre_regions: int
    query_key: tuple[str, ...]
    cols: tuple[str, ...]
    cf: str = "f"
    input_path_prefix: str | None = None
    hfile_path_prefix: str | None = None
    table_path: str | None = None
    record_sep: str = hex_to_text(RECORD_SEP_HEX)
    col_sep: str = hex_to_text(COL_SEP_HEX)
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if not self.cols:
            raise ValueError("cols is empty")
        dupes = sorted({c for c in self.cols if self.cols.count(c) > 1})
        if dupes:
            # A repeated name would silently shadow an earlier column index.
            raise ValueError(f"duplicate column names in cols: {dupes}")
        if self.pre_regions < 1:
            raise ValueError("preRegions must be positive")
        missing = [c for c in (*self.query_key, self.uniq_col) if c not in self.cols]
        if missing:
            raise ValueError(f"key columns not in cols: {missing}")
        if not self.query_key:
            raise ValueError("queryKey is empty")

    @property
    def qualified_name(self) -> str:
        return f"{self.namespace}:{self.table_name}"

    @property
    def schema(self) -> StructType:
        return string_schema(self.cols)

    def column_index(self) -> dict[str, int]:
        return {c: i for i, c in enumerate(self.cols)}

    def result_fields(self) -> tuple[str, ...] | None:
        return RESULT_FIELDS.get(self.table_name)

    def row_key_of(self, parts, n: int | None = None) -> str:
        """Row key of one parsed record (fields in ``cols`` order), in Python.
        ``n`` overrides the number of salts (e.g. a fixed modulus of 10)."""
        from ..functions.keys import query_key_py, row_key_py

        idx = self.column_index()
        qk = query_key_py(parts[idx[c]] for c in self.query_key)
        return row_key_py(qk, str(parts[idx[self.uniq_col]]), n or self.pre_regions)

    def with_(self, **changes) -> "TableSpec":
        d = {k: getattr(self, k) for k in self.__dataclass_fields__}
        d.update(changes)
        return TableSpec(**d)


def parse_properties(text: str) -> dict[str, str]:
    """Minimal Java ``.properties`` reader: ``key=value`` or ``key:value``,
    ``#``/``!`` comments, leading whitespace ignored.  Values are kept as is
    (no trimming of list items, as the column list is taken literally)."""
    out: dict[str, str] = {}
    for raw in text.splitlines():
        line = raw.lstrip()
        if not line or line[0] in "#!":
            continue
        cut = [i for i in (line.find("="), line.find(":")) if i >= 0]
        if not cut:
            out[line.rstrip()] = ""
            continue
        i = min(cut)
        out[line[:i].rstrip()] = line[i + 1 :].lstrip()
    return out


_REQUIRED = ("tableName", "namespace", "uniqCol", "preRegions", "queryKey", "cols")


def spec_from_properties(props: dict[str, str]) -> TableSpec:
    missing = [k for k in _REQUIRED if props.get(k) in (None, "")]
    if missing:
        raise ValueError(f"table description lacks {missing}")
    known = set(_REQUIRED) | {"cf", "inputPathPrefix", "hfilePathPrefix", "tablePath", "recordSepHex", "colSepHex"}
    return TableSpec(
        table_name=props["tableName"],
        namespace=props["namespace"],
        uniq_col=props["uniqCol"],
        pre_regions=int(props["preRegions"]),
        query_key=tuple(props["queryKey"].split(",")),
        cols=tuple(props["cols"].split(",")),
        cf=props.get("cf") or "f",
        input_path_prefix=props.get("inputPathPrefix") or None,
        hfile_path_prefix=props.get("hfilePathPrefix") or None,
        table_path=props.get("tablePath") or None,
        record_sep=hex_to_text(props.get("recordSepHex") or RECORD_SEP_HEX),
        col_sep=hex_to_text(props.get("colSepHex") or COL_SEP_HEX),
        extra={k: v for k, v in props.items() if k not in known},
    )


def load_spec(path: str) -> TableSpec:
    """Read ``<table>.properties``; a missing file or key raises."""
    with open(path, encoding="utf-8") as fh:
        return spec_from_properties(parse_properties(fh.read()))


def load_job_conf(path: str) -> dict[str, str]:
    """Read ``<job>.conf`` (``key=value`` lines) into Spark settings."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as fh:
        return parse_properties(fh.read())


def apply_job_conf(builder, conf: dict[str, str]):
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder

"""The row key and the lookups as SQL functions.

``create_functions`` registers, the scalar ones in a table's namespace and the table functions in the session::

    <table>_salt(key…)     INT      the salt
    <table>_prefix(key…)   STRING   salt text and hash
    <table>_row_key(key…, uniq)
    <table>_lookup(key…)   TABLE    the rows of one key, in the table's columns
    <table>_range(a, b)    TABLE    the rows with a <= row_key < b

They are Spark's own SQL functions (``CREATE FUNCTION … RETURN``): Catalyst puts their bodies into the query, so nothing is
called row by row.  The hash is the SQL form, which is deterministic: unlike a keyed view by ``reflect``, a filter on the business key
moves below it to the scan.

A lookup's salt is a deterministic expression over the partition column, so the scan lists one salt's directories.  Where a table
has at most ``PUSHED_SALTS`` salts, the prefix is also compared with one literal for each salt, which Spark folds and pushes to Parquet.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.keys import java_string_hash_sql, salt_width
from ..sources.spec import TableSpec
from ..sources.store import create_namespace

PUSHED_SALTS = 64


def _key(names) -> str:
    parts = [f"coalesce({n}, 'null')" for n in names]
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def create_functions(spark: SparkSession, spec: TableSpec, source: str | None = None, value_cols=None, namespace_location: str | None = None) -> list[str]:
    """Register the functions; ``source`` is the catalog name of a table or newest-wins view with salt, prefix and row_key
    (none: no table functions).  Returns the functions' names."""
    create_namespace(spark, spec.namespace, namespace_location)
    n, w = spec.pre_regions, salt_width(spec.pre_regions)
    name = f"`{spec.namespace}`.`{spec.table_name}"
    names = [f"k{i}" for i in range(len(spec.query_key))]
    args = ", ".join(f"{k} STRING" for k in names)
    key = _key(names)
    salt = f"CAST(abs({java_string_hash_sql(key)} % {n}) AS INT)"
    made = []

    def create(suffix, arguments, returns, body):
        if returns.startswith("TABLE"):  # Spark finds a table function by its bare name
            kind, named, called = "TEMPORARY FUNCTION", f"`{spec.table_name}_{suffix}`", f"{spec.table_name}_{suffix}"
        else:
            kind, named, called = "FUNCTION", f"{name}_{suffix}`", f"{spec.namespace}.{spec.table_name}_{suffix}"
        spark.sql(f"CREATE OR REPLACE {kind} {named}({arguments}) RETURNS {returns} RETURN {body}")
        made.append(called)

    create("salt", args, "INT", salt)
    prefix = f"concat(lpad(CAST({salt} AS STRING), {w}, '0'), md5({key}))"
    create("prefix", args, "STRING", prefix)
    create("row_key", f"{args}, uniq STRING", "STRING", f"concat({prefix}, uniq)")
    if source:
        cols = list(value_cols or spec.cols)
        table = ", ".join(f"`{c}` STRING" for c in ("row_key", *cols))
        chosen = ", ".join(f"t.`{c}`" for c in ("row_key", *cols))
        literal = ""
        if n <= PUSHED_SALTS:
            each = ", ".join(f"concat('{str(s).zfill(w)}', md5({key}))" for s in range(n))
            literal = f" AND t.prefix IN ({each})"
        # a NULL single key finds nothing; NULL parts of a composite key are the text null
        some = f" AND {names[0]} IS NOT NULL" if len(names) == 1 else ""
        create("lookup", args, f"TABLE({table})", f"SELECT {chosen} FROM {source} t WHERE t.salt = {salt} AND t.prefix = {prefix}{literal}{some}")
        create("range", "a STRING, b STRING", f"TABLE({table})", f"SELECT {chosen} FROM {source} t WHERE (a IS NULL OR t.row_key >= a) AND (b IS NULL OR t.row_key < b)")
    return made

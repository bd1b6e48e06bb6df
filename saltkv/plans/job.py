"""The load job and its command line.

``load_batch`` is one DataFrame chain and one write::

    text(lineSep) -> split -> row keys -> [dedup] -> range partition on
    (salt, row_key) + sort within partitions -> write partitionBy(salt) to a
    staging directory -> rename into the table as load_ts=<millis>

Catalyst fuses the scan, the split and the key expressions into the map stage;
the only shuffle is the layout's (two with dedup).  The write is the job's
single action.  A lost executor re-runs its tasks from the input files; the
staging directory is renamed only after the write has committed.

Command line (``python -m saltkv.plans.job <batch_date> <job> <table>``) reads
``<conf_dir>/<table>.properties`` and ``<conf_dir>/<table>.conf``, stops the
session in all cases and exits with 1 on failure.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import add_row_keys
from ..operators.layout import dedup_in_load, spread_small_input
from ..session import DEFAULT_CONF
from ..sources.delimited import batch_path, read_batch
from ..sources.spec import TableSpec, apply_job_conf, load_job_conf, load_spec
from ..operators.layout import files_per_bucket_for
from ..sources.store import (
    REJECTED, input_bytes, layout_for_write, new_load_ts, publish_load, read_rejected, refresh_table,
    registered_at, stage_load, staging_dir, table_location, write_manifest,
)
from ..sources.merged import upsert_loads
from ..sources.sketches import attach_sketches, expected_keys, files_for_rows, stage_sketches

log = logging.getLogger("saltkv.job")


@dataclass
class LoadResult:
    table_dir: str
    load_ts: int
    load_dir: str
    # The records a permissive load set aside (stored inside the load), and the numbers of
    # rows loaded and set aside, as the writes themselves observed them.
    rejected: object = None
    n_rejected: int = 0
    n_loaded: int = 0


def load_rows(
    spark: SparkSession,
    spec: TableSpec,
    rows,
    store_root: str | None = None,
    *,
    load_ts: int | None = None,
    dedup: bool = True,
    files_per_bucket: int | None = None,
    exact_partitioner: bool = False,
    bloom_filter: bool = False,
    hash_method: str | None = None,
    spread: bool = False,
    no_nulls: bool = False,
    upsert: bool = False,
    rejected=None,
) -> LoadResult:
    """Key, lay out, stage and publish a DataFrame of string rows as one load.

    A NULL value means "not written by this load": the column keeps its older
    value when the table is read.  ``dedup=False`` trusts the unique column and
    saves one shuffle.  ``load_ts`` defaults to the wall clock in milliseconds when the load is published.
    ``rejected`` records are stored inside the load; loaded and rejected rows are counted by the writes
    (``Observation``) and noted in its manifest.  ``bloom_filter`` sizes each file's filter by sketches of the load's prefixes, which are
    stored in it (``sources.sketches``; one more pass over the key columns); they also raise ``files_per_bucket``, if given, so that
    no file exceeds ``MOST_ROWS_PER_FILE``.  ``upsert`` folds the load into the table's merged copy.
    ``spread`` round-robins an input with fewer partitions than cores before
    the key work (a shuffle follows anyway); it has to plan the input to know, so only
    the load job, whose input is files, asks for it.
    """
    table_dir = table_location(spec, store_root)
    value_cols = [c for c in rows.columns]
    if spread:
        rows = spread_small_input(rows)
    keyed = add_row_keys(rows, spec.query_key, spec.uniq_col, spec.pre_regions, hash_method)
    if dedup:
        keyed = dedup_in_load(keyed, value_cols)
    if spec.hfile_path_prefix and store_root is None:
        stage_dir = f"{spec.hfile_path_prefix.rstrip('/')}/{load_ts or new_load_ts()}"
    else:
        stage_dir = staging_dir(table_dir, f"load-{load_ts or 'new'}")
    loaded, aside = Observation(), Observation()
    ndv = None
    if bloom_filter:
        sketches = stage_sketches(spark, keyed.select("salt", "prefix"), stage_dir)
        if files_per_bucket:  # the sketches count the rows: no task sorts more than it should
            files_per_bucket = max(files_per_bucket, files_for_rows(sketches, spec.pre_regions))
        ndv = expected_keys(sketches, spec.pre_regions * (files_per_bucket or 0))
    laid = layout_for_write(keyed, spec, files_per_bucket, exact_partitioner)
    stage_load(laid.observe(loaded, F.count(F.lit(1)).alias("n")), stage_dir, bloom_filter, ndv)
    if bloom_filter:
        attach_sketches(spark, stage_dir)
    n_loaded, n_rejected = loaded.get["n"], 0
    if rejected is not None:
        rejected.select("value", "n_fields").observe(aside, F.count(F.lit(1)).alias("n")).write.parquet(f"{stage_dir}/{REJECTED}")
        n_rejected = aside.get["n"]
    more = {"loaded": n_loaded} if rejected is None else {"loaded": n_loaded, "rejected": n_rejected}
    write_manifest(spark, stage_dir, list(rows.columns), not no_nulls, unique_keys=dedup, **more)
    load_dir = publish_load(spark, stage_dir, table_dir, load_ts)
    ts = int(load_dir.rpartition("=")[2])
    log.info("published %s as %s", spec.qualified_name, load_dir)
    if registered_at(spark, spec, table_dir):
        refresh_table(spark, spec, table_dir)  # catalog readers see the new load and its columns at once
    if upsert:
        upsert_loads(spark, spec, table_dir, [ts], bloom_filter=bloom_filter)
    return LoadResult(table_dir, ts, load_dir, n_rejected=n_rejected, n_loaded=n_loaded)


def load_batch(
    spark: SparkSession,
    spec: TableSpec,
    batch_date: str | None = None,
    store_root: str | None = None,
    *,
    path: str | None = None,
    mode: str = "failfast",
    record_sep: str | None = None,
    col_sep: str | None = None,
    **kw,
) -> LoadResult:
    """The load job: read one dated delimited batch and publish it as a load
    (keyword options as in ``load_rows``).  A short record fails the job, unless
    ``mode="permissive"``: then such records are stored in the load (``read_rejected``) and
    counted in its manifest.  Unless given, the number of files per salt follows the
    batch's size on disk."""
    src = path or batch_path(spec, batch_date)
    record_sep = record_sep if record_sep is not None else spec.record_sep
    col_sep = col_sep if col_sep is not None else spec.col_sep
    batch = read_batch(spark, spec, path=src, mode=mode, record_sep=record_sep, col_sep=col_sep)
    if kw.get("files_per_bucket") is None:
        kw["files_per_bucket"] = files_per_bucket_for(spark, spec.pre_regions, input_bytes(spark, src))
    # Parsed text has no NULL: every field of an accepted record is a string.
    kw.setdefault("no_nulls", True)
    kw.setdefault("spread", True)
    res = load_rows(spark, spec, batch.rows, store_root, rejected=batch.rejected if mode == "permissive" else None, **kw)
    res.rejected = read_rejected(spark, res.table_dir, res.load_ts)
    return res


def upsert_table(spark: SparkSession, spec: TableSpec, batch_date: str | None = None, store_root: str | None = None, load_ts: int | None = None, **_):
    """Maintenance job: fold the published loads (or the one given) into the table's merged copy
    (``sources.merged``).  ``batch_date`` is not used."""
    return upsert_loads(spark, spec, table_location(spec, store_root), None if load_ts is None else [load_ts])


# Jobs runnable by name from the command line.
JOBS = {"load": load_batch, "upsert": upsert_table}


def run_job(spark: SparkSession, name: str, spec: TableSpec, batch_date: str, **kw):
    try:
        job = JOBS[name]
    except KeyError:
        raise SystemExit(f"unknown job {name!r}; known: {sorted(JOBS)}") from None
    return job(spark, spec, batch_date, **kw)


def arguments() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="saltkv-job", description="Run a table job for one batch date.")
    ap.add_argument("batch_date")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("table", help="table name: reads <conf_dir>/<table>.properties")
    ap.add_argument("--conf-dir", default=os.path.join(os.path.dirname(__file__), "..", "..", "conf"))
    ap.add_argument("--store-root", default=None)
    ap.add_argument("--input", default=None, help="override the dated input path")
    ap.add_argument("--master", default=None)
    ap.add_argument("--mode", default="failfast", choices=["failfast", "permissive"],
                    help="permissive stores short records beside the load instead of failing")
    ap.add_argument("--no-dedup", action="store_true")
    ap.add_argument("--files-per-bucket", type=int, default=None)
    ap.add_argument("--load-ts", type=int, default=None)
    ap.add_argument("--exact-partitioner", action="store_true", help="one task per salt (the reference layout)")
    ap.add_argument("--bloom-filter", action="store_true", help="Parquet Bloom filter on the key prefix")
    ap.add_argument("--upsert", action="store_true", help="fold the load into the table's merged copy")
    return ap


def described(args) -> tuple[TableSpec, dict[str, str]]:
    """The table description and the job's resource settings that the arguments name."""
    spec = load_spec(os.path.join(args.conf_dir, f"{args.table}.properties"))
    return spec, load_job_conf(os.path.join(args.conf_dir, f"{args.table}.conf"))


def run_described(spark: SparkSession, args, spec: TableSpec):
    """The job that the arguments name, on a given session."""
    if args.job == "load":
        return run_job(
            spark, args.job, spec, args.batch_date,
            store_root=args.store_root, path=args.input, mode=args.mode,
            dedup=not args.no_dedup, files_per_bucket=args.files_per_bucket, load_ts=args.load_ts,
            exact_partitioner=args.exact_partitioner, bloom_filter=args.bloom_filter,
            upsert=args.upsert,
        )
    return run_job(spark, args.job, spec, args.batch_date, store_root=args.store_root, load_ts=args.load_ts)


def main(argv: list[str] | None = None) -> int:
    args = arguments().parse_args(argv)
    spec, conf = described(args)
    builder = SparkSession.builder.appName(f"{args.job}-{args.table}-{args.batch_date}")
    if args.master:
        builder = builder.master(args.master)
        conf = {k: v for k, v in conf.items() if not k.startswith("spark.executor.")}
    builder = apply_job_conf(builder, {**DEFAULT_CONF, **conf})
    spark = builder.getOrCreate()
    try:
        res = run_described(spark, args, spec)
        if args.job == "load":
            print(res.load_dir)
            if args.mode == "permissive":
                print(f"{res.n_rejected} records rejected")
        else:
            print(res)
        return 0
    except Exception:  # noqa: BLE001 - any failure ends the job with status 1
        log.exception("job %s failed for %s %s", args.job, args.table, args.batch_date)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())

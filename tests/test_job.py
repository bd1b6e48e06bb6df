import os
import subprocess
import sys

import pytest

from saltkv.plans import fixtures as FX
from saltkv.sources import delimited as D
from conftest import ROOT, SF_SMALL, local_path


def _run(args, timeout=300):
    return subprocess.run([sys.executable, "-m", "saltkv.plans.job", *args], cwd=ROOT, capture_output=True, text=True, timeout=timeout)


def _conf(tmp, name, body):
    conf = local_path(tmp(name))
    os.makedirs(conf)
    with open(os.path.join(conf, "check.properties"), "w") as fh:
        fh.write(body)
    return conf


def test_command_line_load(spark, tmp):
    inp = tmp("in")
    D.write_delimited(FX.check_rows(spark, SF_SMALL), f"{inp}/2024-01-01")
    conf = _conf(tmp, "conf", "tableName=check\nnamespace=keyspace\ncf=f\npreRegions=3\nuniqCol=id\nqueryKey=check_id\n"
                 f"inputPathPrefix={inp}\ncols=id,check_id,rule_no,rule_type,rule_desc\n")
    store = tmp("store")
    p = _run(["2024-01-01", "load", "check", "--conf-dir", conf, "--store-root", store, "--load-ts", "7", "--master", "local[2]",
              "--exact-partitioner", "--bloom-filter"])
    assert p.returncode == 0, p.stderr[-2000:]
    load_dir = os.path.join(local_path(store), "keyspace", "check", "load_ts=7")
    assert os.path.isdir(os.path.join(load_dir, "salt=0"))
    # the exact partitioner writes one file per salt
    assert all(len([f for f in os.listdir(os.path.join(load_dir, d)) if f.endswith(".parquet")]) == 1
               for d in os.listdir(load_dir) if d.startswith("salt="))
    assert spark.read.parquet(load_dir).count() == FX.check_rows(spark, SF_SMALL).count()
    p = _run(["-", "upsert", "check", "--conf-dir", conf, "--store-root", store, "--master", "local[2]"])
    assert p.returncode == 0, p.stderr[-2000:]
    assert os.path.isdir(os.path.join(local_path(store), "keyspace", "check", "_merged", "salt=0"))


def test_rejected_records_are_reported(spark, tmp):
    from saltkv.plans.job import load_batch
    from saltkv.sources.store import read_manifest

    inp = tmp("in-rej")
    os.makedirs(local_path(inp))
    with open(os.path.join(local_path(inp), "part-0"), "w") as fh:
        fh.write("1\x01a\x01x\x01y\x01z\x102\x01b\x10")
    spec = FX.CHECK.with_(input_path_prefix=None)
    with pytest.raises(Exception, match="fewer than 5 fields"):
        load_batch(spark, spec, path=inp, store_root=tmp("st-ff"), load_ts=1)  # the default
    res = load_batch(spark, spec, path=inp, store_root=tmp("st-rej"), load_ts=1, mode="permissive")
    assert [tuple(r) for r in res.rejected.collect()] == [("2\x01b", 2)] and res.n_rejected == 1
    assert read_manifest(spark, res.load_dir)["rejected"] == 1
    assert spark.read.parquet(res.load_dir).count() == 1


def test_command_line_failure_exit_code(tmp):
    conf = _conf(tmp, "conf-bad", "tableName=check\nnamespace=k\npreRegions=3\nuniqCol=id\nqueryKey=check_id\n"
                 "inputPathPrefix=/nonexistent/in\ncols=id,check_id\n")
    p = _run(["2024-01-01", "load", "check", "--conf-dir", conf, "--store-root", tmp("never"), "--master", "local[1]"])
    assert p.returncode == 1


def test_empty_batch_publishes_an_empty_load(spark, tmp):
    from saltkv.plans.job import load_batch, load_rows
    from saltkv.sources import store as ST

    inp = local_path(tmp("in-empty"))
    os.makedirs(inp)
    open(os.path.join(inp, "part-0"), "w").close()
    root = tmp("st-empty")
    load_rows(spark, FX.CHECK, FX.check_rows(spark, SF_SMALL), root, load_ts=1)
    res = load_batch(spark, FX.CHECK, path=inp, store_root=root, load_ts=2)
    assert ST.list_loads(spark, res.table_dir) == [1, 2]
    assert ST.read_loads(spark, res.table_dir, FX.CHECK.cols, [2]).count() == 0
    assert ST.current(spark, res.table_dir, FX.CHECK.cols).count() == FX.check_rows(spark, SF_SMALL).count()


def test_failed_write_leaves_the_table_untouched(spark, tmp):
    import pytest

    from saltkv.plans.job import load_batch, load_rows
    from saltkv.sources import store as ST

    root = tmp("st-fail")
    load_rows(spark, FX.CHECK, FX.check_rows(spark, SF_SMALL), root, load_ts=1)
    inp = local_path(tmp("in-fail"))
    os.makedirs(inp)
    with open(os.path.join(inp, "part-0"), "w") as fh:
        fh.write("1\x01a\x01x\x01y\x01z\x102\x01b\x10")  # second record is short
    with pytest.raises(Exception, match="fewer than 5 fields"):
        load_batch(spark, FX.CHECK, path=inp, store_root=root, load_ts=2, mode="failfast")
    d = ST.table_location(FX.CHECK, root)
    assert ST.list_loads(spark, d) == [1]
    assert ST.current(spark, d, FX.CHECK.cols).count() == FX.check_rows(spark, SF_SMALL).count()


RETRY_SCRIPT = r"""
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from saltkv.plans import fixtures as FX
from saltkv.plans.job import load_rows
from saltkv.sources import store as ST

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
rows = FX.check_rows(spark, sys.argv[2]).repartition(4)

def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected task failure")
    yield from batches

rows = rows.mapInPandas(flaky, rows.schema)
res = load_rows(spark, FX.CHECK, rows, sys.argv[3], load_ts=1)
got = sorted(map(tuple, ST.current(spark, res.table_dir, FX.CHECK.cols).select("row_key", *FX.CHECK.cols).collect()))
ref = load_rows(spark, FX.CHECK, FX.check_rows(spark, sys.argv[2]), sys.argv[4], load_ts=1)
want = sorted(map(tuple, ST.current(spark, ref.table_dir, FX.CHECK.cols).select("row_key", *FX.CHECK.cols).collect()))
print("RESULT", got == want, len(got))
spark.stop()
"""


def test_load_survives_task_retries(tmp):
    """Tasks that fail on their first attempt are retried; the published load
    equals a load without failures (the plan is retry-deterministic)."""
    import subprocess
    import sys as _sys

    p = subprocess.run(
        [_sys.executable, "-c", RETRY_SCRIPT, os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
         SF_SMALL, tmp("retry-a"), tmp("retry-b")],
        capture_output=True, text=True, timeout=600,
    )
    assert "RESULT True" in p.stdout, (p.stdout[-2000:], p.stderr[-3000:])


def test_a_short_record_fails_the_command(tmp):
    inp = local_path(tmp("in-short"))
    os.makedirs(f"{inp}/2024-01-01")
    with open(f"{inp}/2024-01-01/part-0", "w") as fh:
        fh.write("1\x01a\x102\x10")
    conf = _conf(tmp, "conf-short", "tableName=check\nnamespace=k\npreRegions=3\nuniqCol=id\nqueryKey=check_id\n"
                 f"inputPathPrefix={inp}\ncols=id,check_id\n")
    args = ["2024-01-01", "load", "check", "--conf-dir", conf, "--master", "local[1]", "--store-root"]
    assert _run([*args, tmp("short-a")]).returncode == 1
    p = _run([*args, tmp("short-b"), "--mode", "permissive"])
    assert p.returncode == 0 and "1 records rejected" in p.stdout

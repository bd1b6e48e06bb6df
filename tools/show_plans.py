"""Print the physical plans of the main operators (used to write PLANS.md).

usage: python tools/show_plans.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from pyspark.sql import functions as F  # noqa: E402

from saltkv.functions.keys import add_row_keys  # noqa: E402
from saltkv.operators import lookup as LK  # noqa: E402
from saltkv.operators.layout import dedup_in_load, spread_small_input  # noqa: E402
from saltkv.plans import fixtures as FX  # noqa: E402
from saltkv.plans.inspect import plan_text  # noqa: E402
from saltkv.plans.job import load_rows  # noqa: E402
from saltkv.session import get_session, scratch_path  # noqa: E402
from saltkv.sources import delimited as D  # noqa: E402
from saltkv.sources import merged as MG
from saltkv.sources import store as ST  # noqa: E402
from saltkv.sources.spec import CHECK_FIELDS  # noqa: E402


def clean(txt: str) -> str:
    txt = re.sub(r"#\d+L?", "", txt)
    txt = re.sub(r"file:/\S+?(checkpoints|testdata)/[^\],\s]*", r"<\1>", txt)
    txt = re.sub(r"\[plan_id=\d+\]", "", txt)
    return txt.strip()


def show(title, df):
    print(f"## {title}\n\n```\n{clean(plan_text(df))}\n```\n")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    cols = [*FX.CHECK.cols, "remarks"]
    inp = scratch_path(spark, "plans-in")
    D.write_delimited(FX.check_rows(spark, sf), f"{inp}/2024-01-01")
    batch = D.read_batch(spark, FX.CHECK.with_(input_path_prefix=inp), "2024-01-01")
    keyed = add_row_keys(spread_small_input(batch.rows), FX.CHECK.query_key, FX.CHECK.uniq_col, 3)
    laid = ST.layout_for_write(dedup_in_load(keyed, FX.CHECK.cols), FX.CHECK, files_per_bucket=2)
    show("Load job: parse, key, dedup (partial aggregate first), range layout", laid)

    root = scratch_path(spark, "plans-store")
    for i, d in enumerate(FX.check_loads(spark, sf, 3)):
        res = load_rows(spark, FX.CHECK, d, root, load_ts=i + 1)
    t = ST.current(spark, res.table_dir, cols)
    show("Point lookup on a three-load table: salt pruned, prefix pushed, merge above the scan",
         LK.lookup(t, FX.CHECK, "10", cols))
    reqs = FX.read(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("req_id"), F.col("c_custkey").cast("string").alias("check_id"))
    show("Batch lookup on a three-load table: semi join below the merge, requests broadcast after a count",
         LK.batch_lookup(t, FX.CHECK, reqs, fields=CHECK_FIELDS))
    show("Full newest-wins read of three loads", t)
    show("Top-6 rows of the three-load table: candidate keys semi-joined below the merge",
         ST.first_rows(spark, res.table_dir, 6, cols))
    MG.upsert_loads(spark, FX.CHECK, res.table_dir)
    show("Full read of the merged copy: no merge", MG.merged(spark, res.table_dir, cols))
    show("Range scan with column projection", LK.scan_range(t, FX.CHECK, "08", "1c", ["f:id"]))
    spark.stop()


if __name__ == "__main__":
    main()

"""Sketches of prefixes: estimates, unions over loads, and the size of the Bloom filters they set."""

from pathlib import Path

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from saltkv.functions.keys import add_row_keys
from saltkv.operators import lookup as LK
from saltkv.plans import fixtures as FX
from saltkv.plans.job import load_rows
from saltkv.sources import merged as MG
from saltkv.sources import sketches as SK
from saltkv.sources import store as ST


def size(d):
    return sum(p.stat().st_size for p in Path(d).rglob("salt=*/**/*.parquet"))


def unique_rows(spark, n):
    """Every row its own key, so that prefixes are stored plainly and filters are written."""
    return spark.range(n).select(*[F.col("id").cast("string").alias(c) for c in FX.CHECK.cols])


def test_filters_follow_the_number_of_keys(spark, tmp):
    rows, root = unique_rows(spark, 3000), tmp("grow")
    plain = load_rows(spark, FX.CHECK, rows, root, load_ts=1, files_per_bucket=2)
    sized = load_rows(spark, FX.CHECK, rows, root, load_ts=2, files_per_bucket=2, bloom_filter=True)
    # the filter without a hint: about 1 MB for each file
    guess = ST.staging_dir(sized.table_dir, "guess")
    ST.stage_load(ST.layout_for_write(add_row_keys(rows, FX.CHECK.query_key, "id", 3), FX.CHECK, 2), guess, True)
    a, b, c = size(plain.load_dir), size(sized.load_dir), size(guess)
    files = len(list(Path(sized.load_dir).rglob("salt=*/*.parquet")))
    assert a < b < a + 4096 * files and c > a + 900_000 * files


def test_lookups_through_filters_find_every_key(spark, tmp):
    rows = unique_rows(spark, 400)
    res = load_rows(spark, FX.CHECK, rows, tmp("find"), load_ts=1, bloom_filter=True)
    t = ST.current(spark, res.table_dir, FX.CHECK.cols)
    for k in ("0", "17", "399"):
        assert [r["id"] for r in LK.lookup(t, FX.CHECK, k).collect()] == [k]
    assert LK.lookup(t, FX.CHECK, "400").count() == 0


def test_loads_merge_by_union(spark, tmp):
    rows, root = FX.check_rows(spark, SF_MID), tmp("union")
    k = F.col("id").cast("long")
    for ts, some in enumerate((rows.where(k % 2 == 0), rows.where(k % 2 == 1), rows), 1):
        res = load_rows(spark, FX.CHECK, some, root, load_ts=ts, bloom_filter=ts != 2)  # the second has no sketch
    assert not (Path(res.table_dir) / "load_ts=2" / SK.SKETCH).exists()
    got = {r.salt: (r.n_rows, r.n_prefixes) for r in SK.table_sketches(spark, res.table_dir).collect()}
    raw = ST.read_loads(spark, res.table_dir, [])
    for r in raw.groupBy("salt").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("prefix").alias("d")).collect():
        assert got[r.salt][0] == r.n and abs(got[r.salt][1] - r.d) <= 0.1 * r.d
    one = {r.salt: r.n_prefixes for r in SK.table_sketches(spark, res.table_dir, [3]).collect()}
    # the third load holds the keys of both others: they count once (a union estimates in another way than one sketch)
    assert all(abs(one[s] - n) <= 0.05 * n for s, (_, n) in got.items())


def test_expected_keys(spark):
    keyed = add_row_keys(unique_rows(spark, 900), FX.CHECK.query_key, "id", 3)
    s = SK.prefix_sketches(keyed)
    most = max(r.n for r in keyed.groupBy("salt").agg(F.count(F.lit(1)).alias("n")).collect())
    assert abs(SK.expected_keys(s) - most) <= 0.05 * most
    assert SK.expected_keys(s, 90) == 15  # 1.5 x 900 / 90 rows of a file
    assert abs(SK.expected_keys(s, slices=16) - most / 16) <= 2
    hot = keyed.withColumn("prefix", F.lit("0x"))
    assert SK.expected_keys(SK.prefix_sketches(hot), 9) == 1  # one key, however many rows
    assert SK.expected_keys(SK.prefix_sketches(keyed.limit(0))) == 1
    odd = keyed.limit(4).select(F.lit(None).cast("int").alias("salt"), F.lit(None).cast("string").alias("prefix"))
    assert [(r.salt, r.n_rows) for r in SK.prefix_sketches(odd).collect()] == [(0, 4)]


def test_options_and_empty_loads(spark, tmp):
    assert "parquet.bloom.filter.max.bytes" not in ST.write_options(True)
    assert ST.write_options(True, 10)["parquet.bloom.filter.max.bytes"] == str(1 << 20)
    assert int(ST.write_options(True, 5_000_000)["parquet.bloom.filter.max.bytes"]) >= 5_000_000 * 10 // 8
    assert ST.write_options(True, 10**9)["parquet.bloom.filter.max.bytes"] == str(ST.MOST_BLOOM_BYTES)
    res = load_rows(spark, FX.CHECK, unique_rows(spark, 0), tmp("none"), load_ts=1, bloom_filter=True)
    assert SK.table_sketches(spark, res.table_dir).count() == 0
    assert SK.table_sketches(spark, tmp("nothing")).count() == 0


def test_merged_copy_with_filters(spark, tmp):
    rows, root = unique_rows(spark, 2000), tmp("merged")
    load_rows(spark, FX.CHECK, rows, root, load_ts=1, bloom_filter=True)
    res = load_rows(spark, FX.CHECK, rows.withColumn("rule_no", F.lit("new")), root, load_ts=2, bloom_filter=True, upsert=True)
    MG.upsert_loads(spark, FX.CHECK, res.table_dir, [1], slice_digits=0, bloom_filter=True)
    m = MG.merged(spark, res.table_dir, FX.CHECK.cols)
    assert m.count() == 2000 and m.where("rule_no = 'new'").count() == 2000
    assert size(MG.merged_dir(res.table_dir)) < 1_000_000  # not 1 MB for each file


def test_a_retried_load_after_a_failed_write(spark, tmp):
    """A load whose write fails publishes neither rows nor sketches, and the next one does."""
    root, rows = tmp("fail"), FX.check_rows(spark, SF_SMALL)
    bad = rows.withColumn("rule_no", F.raise_error(F.lit("no")).cast("string"))
    try:
        load_rows(spark, FX.CHECK, bad, root, load_ts=1, bloom_filter=True)
        raise AssertionError("the write should fail")
    except Exception as e:  # noqa: BLE001 - Spark's own error
        assert "should fail" not in str(e)
    d = ST.table_location(FX.CHECK, root)
    assert ST.list_loads(spark, d) == []
    load_rows(spark, FX.CHECK, rows, root, load_ts=1, bloom_filter=True)
    assert SK.table_sketches(spark, d).agg(F.sum("n_rows")).first()[0] == rows.count()

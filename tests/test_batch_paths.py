"""Batch lookups on a bucketed copy, the Bloom prefilter and the interval join."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from saltkv.functions.keys import add_row_keys
from saltkv.operators import bucketed as B
from saltkv.operators import lookup as LK
from saltkv.operators import prefilter as P
from saltkv.operators import ranges as R
from saltkv.operators.skew import hot_keys, salted_join
from saltkv.plans import fixtures as FX
from saltkv.plans.inspect import plan_text
from saltkv.session import scratch_path


@pytest.fixture(scope="module")
def check(spark):
    path = scratch_path(spark, "check-keyed")
    add_row_keys(FX.check_rows(spark, SF_SMALL), ("check_id",), "id", 3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def requests(spark):
    c = FX.read(spark, SF_SMALL, "customer")
    known = c.select(F.concat(F.lit("c"), "c_custkey").alias("req_id"), F.col("c_custkey").cast("string").alias("check_id"))
    more = spark.createDataFrame([("n", None), ("x", "none"), ("d", "7"), ("d", "7")], "req_id string, check_id string")
    return known.unionByName(more)


# ------------------------------------------------------------ bucketed copy


@pytest.mark.parametrize("hot_rows", [100_000, 12])
def test_bucketed_lookup_equals_the_plain_one(spark, check, hot_rows, no_broadcast):
    name = f"bucketed_{hot_rows}"
    B.bucket_table(spark, check, name, scratch_path(spark, name), 8, hot_rows=hot_rows, fan=3)
    want = rows(LK.batch_lookup(check, FX.CHECK, requests(spark)))
    got = B.batch_lookup_bucketed(spark, name, FX.CHECK, requests(spark), hot_rows=hot_rows)
    assert rows(got) == want and len(want) > 1000
    assert spark.table(f"{name}_hot").count() == (0 if hot_rows > 1000 else check.groupBy("prefix").count().where("count >= 12").count())
    key = check.groupBy("check_id").count().orderBy(F.desc("count"), "check_id").first().check_id
    fields = list(FX.CHECK.cols)
    assert [tuple(r)[1:] for r in B.lookup_bucketed(spark, name, FX.CHECK, key, fields).collect()] == [tuple(r) for r in LK.lookup(check, FX.CHECK, key, fields).collect()]


def test_the_table_side_has_no_exchange(spark, check, no_broadcast):
    B.bucket_table(spark, check, "bucketed_plan", scratch_path(spark, "b"), 8)
    req = LK.request_keys(requests(spark), FX.CHECK).where(~F.col("__bad"))
    plan = plan_text(B.matched_rows(spark, "bucketed_plan", req))
    side = plan[plan.index("SortMergeJoin"):]
    table_side = side[: side.index("Exchange")] if "Exchange" in side else side
    assert "Bucketed: true" in table_side and "bucketed_plan" in table_side
    assert "Bucketed: true" in plan and plan.count("Scan parquet spark_catalog.default.bucketed_plan[") + plan.count("bucketed_plan[") >= 1
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # or the plan doesn't name the buckets it prunes
    point = plan_text(B.lookup_bucketed(spark, "bucketed_plan", FX.CHECK, "7"), "formatted")
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")

    assert "SelectedBucketsCount: 1 out of 8" in point


# ------------------------------------------------------------ prefilter


def test_prefilter_keeps_matches_and_little_else(spark, check):
    keys = check.where("cast(check_id as int) % 10 = 3").select("prefix").distinct()
    n = keys.count()
    kept = P.prefilter(check, keys, n)
    matched = check.join(keys, "prefix", "left_semi").select(*check.columns)
    assert matched.exceptAll(kept).count() == 0
    assert matched.count() <= kept.count() <= 1.05 * matched.count()
    assert P.prefilter(check, keys.limit(0), 0).count() == 0
    assert "Exchange" not in plan_text(kept).split("Subquery")[0]


def test_prefilter_sizes():
    assert [P.filter_bits(n) for n in (0, 1, 1000, 1 << 20, 1 << 40)] == [15, 15, 15, 25, 27]


def test_batch_lookup_filters_before_its_shuffle(spark, check, no_broadcast):
    req = requests(spark).where("check_id like '%1'")
    old = LK.batch_lookup(check, FX.CHECK, req, broadcast_requests=False, bloom=False)
    new = LK.batch_lookup(check, FX.CHECK, req, broadcast_requests=False)
    assert rows(new) == rows(old) and new.count() > 100
    assert "getbit" in plan_text(new) and "getbit" not in plan_text(old)


def test_filtered_rows_enter_the_shuffle(spark, check, no_broadcast):
    """Records that shuffles of the table's rows write, from the plan's own metrics."""
    req = requests(spark).where("check_id like '%1'")
    keys = LK.request_keys(req, FX.CHECK).where(~F.col("__bad")).select("salt", "prefix").distinct()
    met = P.prefilter(check, keys, keys.count()).repartition(4, "salt", "prefix").join(keys, ["salt", "prefix"], "left_semi")
    matched = len(met.collect())
    assert matched and P.prefilter(check, keys, keys.count()).count() <= 1.05 * matched


# ------------------------------------------------------------ ranges


def brute_ranges(keys, ranges):
    return [(r, k) for r, a, b in ranges for k in keys if (a is None or k >= a) and (b is None or k < b)]


RANGES = [
    ("all", None, None), ("none", "2", "1"), ("same", "1a", "1a"), ("salt", "1", "2"), ("open", None, "08"), ("high", "2c", None), ("past", "9", None),
    ("odd", "0é", "1G"), ("upper", "0A", "0a"), ("empty", "", ""), ("from-empty", "", "02"), ("mid", "08f3", "1c01"), ("twice", "1b", "1c"), ("twice", "1b", "1c"), (None, "0", "01"),
]


@pytest.mark.parametrize("n_rows,hot", [(None, 100_000), (10_000_000, 100_000), (500_000, 20)])
def test_ranges_equal_brute_force(spark, check, n_rows, hot):
    ranges = spark.createDataFrame(RANGES, "req_id string, start string, stop string")
    got = R.scan_ranges(check, FX.CHECK, ranges, columns=["f:id"], n_rows=n_rows, hot_rows=hot, fan=4)
    keys = [r.row_key for r in check.select("row_key").collect()]
    want = brute_ranges(keys, [r for r in RANGES])
    key = str
    assert sorted(((r.req_id, r.row_key) for r in got.collect()), key=key) == sorted(want, key=key)


def test_ranges_use_no_nested_loop(spark, check, no_broadcast):
    ranges = spark.createDataFrame(RANGES, "req_id string, start string, stop string")
    plan = plan_text(R.scan_ranges(check, FX.CHECK, ranges))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@settings(max_examples=200, deadline=None)
@given(st.text("0123456789abcdefgGé~ ", max_size=6), st.text("0123456789abcdef", min_size=5, max_size=8), st.integers(1, 4))
def test_bins_never_lose_a_key(bound, key, length):
    """The rounding rule in Python: a key at or above a start is in its first bin or behind; one below a stop, in its last or before."""
    import re

    lead = re.match(f"^[0-9a-f]{{0,{length}}}", bound)[0]
    low = int(lead.ljust(length, "0"), 16)
    high = int(lead.ljust(length, "f" if len(bound) > len(lead) else "0"), 16)
    b = int(key[:length], 16)
    if key >= bound:
        assert b >= low
    if key < bound:
        assert b <= high


def test_salted_join_equals_a_join(spark):
    a = spark.range(1000).selectExpr("id as x", "if(id % 3 = 0, 0, id % 50) as k")
    b = spark.range(300).selectExpr("id as y", "if(id % 4 = 0, 7, id % 60) as k")
    want = rows(a.join(b, "k").select("k", "x", "y"))
    for hot in (10, 10_000):
        assert rows(salted_join(a, b, ["k"], "x", "y", 5, hot).select("k", "x", "y")) == want


def test_prefilter_names_a_prefix_few_times(spark):
    rows = add_row_keys(FX.check_rows(spark, SF_SMALL), ("check_id",), "id", 3).drop("salt", "row_key")
    keys = rows.select("prefix").limit(20).localCheckpoint()
    plan = P.prefilter(rows, keys, 20)._jdf.queryExecution().optimizedPlan().toString()
    at = next(line for line in plan.splitlines() if "Filter" in line)
    assert 1 <= at.count("md5(") <= 4


# ------------------------------------------------------------ ranges whose result is far larger than both sides


def joined_rows(df):
    """Rows that the joins of a collected query returned, from the plan's own metrics."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name:
            found += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return found


@pytest.mark.parametrize("hot", [100_000, 20])
def test_equal_requests_meet_a_row_once(spark, check, hot, no_broadcast):
    ranges = spark.range(600).select(F.concat(F.lit("r"), "id").alias("req_id"), F.lit("08").alias("start"), F.lit("0b55").alias("stop"))
    got = R.scan_ranges(check, FX.CHECK, ranges, columns=["f:id"], hot_rows=hot, fan=4)
    n = len(got.collect())
    keys = check.where("row_key >= '08' and row_key < '0b55'").count()
    assert n == 600 * keys and keys > 20
    assert keys <= joined_rows(got) <= 10 * keys  # before: a joined row for each row of the result


@pytest.mark.parametrize("length", [2, 3, 5])
def test_bounds_divide_only_their_own_bin(spark, length):
    bounds = ["", "0", "1a", "1g", "1G", "1:", "1 ", "2é", "0\x00", "G", "~", " ", "1c01", "08f", "08f3", "08f31", "08f31a2", "0ff", "ffg", "fffff", "fffffffG", "a~a", "0/9", "9`"]
    rows = spark.createDataFrame([(b,) for b in bounds], "b string").select("b", *[c.alias(x) for c, x in zip(R.bound_bin(F.col("b"), length), ("at", "cut"), strict=True)])
    keys = [f"{k:0{length}x}{tail}" for k in range(16**min(length, 3)) for tail in ("000", "31a2", "fff")]
    assert len(found := rows.collect()) == len(bounds)
    for r in found:
        assert r.cut == (len(r.b) > length and all(c in "0123456789abcdef" for c in r.b[:length]))
        for k in keys:
            own = int(k[:length], 16)
            if own != r.at or not r.cut:
                assert (k >= r.b) == (own >= r.at), (r, k)


def test_arrays_of_requests_are_bounded_and_whole(spark):
    reqs = [(f"r{i % 40}", 7, None, None) for i in range(100)] + [(None, 7, None, None)] * 5 + [("x", 7, "07a1", None), ("y", 8, None, None)]
    groups = R.request_groups(spark.createDataFrame(reqs, "__req string, __bin long, start string, stop string"), 10).collect()
    assert sorted(((q, g["__bin"], g.start, g.stop) for g in groups for q in g["__reqs"]), key=str) == sorted(reqs, key=str)
    assert all(len(g["__reqs"]) == g["__n"] <= 10 for g in groups) and len(groups) == 13
    assert len({(g["__bin"], g["__id"]) for g in groups}) == len(groups)


def test_the_join_of_ranges_has_tasks_for_its_result(spark, check, monkeypatch, no_broadcast):
    ranges = spark.createDataFrame(RANGES, "req_id string, start string, stop string")
    want = rows(R.scan_ranges(check, FX.CHECK, ranges, columns=["f:id"]))
    assert R.join_tasks(R.TASK_ROWS) is None and R.join_tasks(3 * R.TASK_ROWS + 1) == 4 and R.join_tasks(1e15) == R.MOST_TASKS
    monkeypatch.setattr(R, "join_tasks", lambda n_out: 11 if 1000 < n_out < 100_000 else 0)
    for hot in (100_000, 20):
        got = R.scan_ranges(check, FX.CHECK, ranges, columns=["f:id"], hot_rows=hot)
        assert got.rdd.getNumPartitions() == 11 and rows(got) == want


def test_salted_join_with_weights_equals_a_join(spark):
    a = spark.range(1000).selectExpr("id as x", "if(id % 3 = 0, 0, id % 50) as k")
    b = spark.range(300).selectExpr("id as y", "if(id % 4 = 0, 7, id % 60) as k", "if(id % 60 = 9, 500, 1) as n")
    want = rows(a.join(b, "k").select("k", "x", "y"))
    for hot, tasks in ((10, None), (10, 5), (10_000, 5), (900, 5)):
        assert rows(salted_join(a, b, ["k"], "x", "y", 5, hot, weight="n", tasks=tasks).select("k", "x", "y")) == want
    assert [r.k for r in hot_keys(a, b, ["k"], 900, "n").collect()] == [9] and hot_keys(a, b, ["k"], 900) is None

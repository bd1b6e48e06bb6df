import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from saltkv.operators import lookup as LK
from saltkv.plans import fixtures as FX
from saltkv.plans.inspect import has_nested_loop_join, partition_filters, plan_text
from saltkv.sources.spec import CHECK_FIELDS, OPINION_FIELDS
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def check(spark):
    return E.published_check(spark, SF_SMALL)


@pytest.fixture(scope="module")
def hot(spark):
    return E._top_key(FX.check_rows(spark, SF_SMALL), ["check_id"])["check_id"]


def test_lookup_equals_plain_filter_for_every_key(spark, check, hot):
    """Property: the batch lookup of every key equals a plain filter per key."""
    keys = FX.check_rows(spark, SF_SMALL).select("check_id").distinct()
    reqs = keys.select(F.col("check_id").alias("req_id"), "check_id")
    got = LK.batch_lookup(check, FX.CHECK, reqs, fields=FX.CHECK.cols)
    a = sorted((r.req_id, r.id) for r in got.collect())
    b = sorted((r.check_id, r.id) for r in FX.check_rows(spark, SF_SMALL).collect())
    assert a == b


def test_single_lookup_in_key_order(spark, check, hot):
    rows = LK.lookup(check, FX.CHECK, hot, CHECK_FIELDS, keep_row_key=True).collect()
    assert rows and [r.row_key for r in rows] == sorted(r.row_key for r in rows)
    assert all(r.check_id == hot and r.index_value is None for r in rows)
    # ids compare as text inside one key
    assert [r.id for r in rows] == sorted(r.id for r in rows)


def test_no_match_and_null_key(spark, check, hot):
    assert LK.lookup(check, FX.CHECK, "no-such-key").count() == 0
    with pytest.raises(LK.NullKeyError):
        LK.lookup(check, FX.CHECK, None)
    (ok,) = LK.lookup_response(check, FX.CHECK, "no-such-key").collect()
    assert (ok.rtn_sts, ok.rtn_code, ok.sys_code, ok.pos) == ("S", "0", "475", None)
    (err,) = LK.lookup_response(check, FX.CHECK, None).collect()
    assert (err.rtn_sts, err.rtn_code, err.pos) == ("E", "-1", None)


def test_response_rows_are_in_order(spark, check, hot):
    got = sorted(LK.lookup_response(check, FX.CHECK, hot, CHECK_FIELDS).collect(), key=lambda r: r.pos)
    want = LK.lookup(check, FX.CHECK, hot, CHECK_FIELDS).collect()
    assert {(r.rtn_sts, r.rtn_msg) for r in got} == {("S", LK.SUCCESS[2])}
    assert [r.pos for r in got] == list(range(1, len(want) + 1))
    assert [tuple(r)[5:] for r in got] == [tuple(r) for r in want]


def test_unknown_stored_column(spark, check, hot):
    odd = check.withColumn("surprise", F.lit("x"))
    with pytest.raises(LK.UnknownColumnError):
        LK.lookup(odd, FX.CHECK, hot, CHECK_FIELDS)
    reqs = spark.createDataFrame([("r1", hot), ("r2", "no-such-key")], "req_id string, check_id string")
    env = {r.req_id: tuple(r) for r in LK.batch_envelope(odd, FX.CHECK, reqs, fields=CHECK_FIELDS).collect()}
    # A matched row holding the unknown cell fails; a request matching nothing succeeds empty.
    assert env["r1"] == ("r1", "E", "-1", LK.ERROR[2], "475", None)
    assert env["r2"] == ("r2", "S", "0", LK.SUCCESS[2], "475", 0)
    # A column that exists but holds no cell (NULL) is no error.
    empty = check.withColumn("surprise", F.lit(None).cast("string"))
    assert LK.batch_envelope(empty, FX.CHECK, reqs, fields=CHECK_FIELDS).where("rtn_sts = 'E'").count() == 0
    assert LK.lookup_response(odd, FX.CHECK, hot, CHECK_FIELDS).first().rtn_sts == "E"
    assert LK.lookup_response(odd, FX.CHECK, "no-such-key", CHECK_FIELDS).first().rtn_sts == "S"
    r = LK.lookup_response(empty, FX.CHECK, hot, CHECK_FIELDS).first()
    assert r.rtn_sts == "S" and r.pos is not None


def test_composite_collision_and_exact(spark):
    t = E._collision_table(spark, "/root/testdata/sf0.01")
    both = LK.lookup(t, FX.COLLISION, ("1051", "9"), FX.COLLISION.cols).collect()
    exact = LK.lookup(t, FX.COLLISION, ("1051", "9"), FX.COLLISION.cols, exact=True).collect()
    assert {(r.k1, r.k2) for r in both} == {("1051", "9"), ("105", "19")}
    assert {(r.k1, r.k2) for r in exact} == {("1051", "9")}


def test_composite_null_part_is_text(spark):
    s, p, _ = LK.key_literals(FX.OPINION, ("1", None))
    assert (s, p) == LK.key_literals(FX.OPINION, ("1null", ""))[:2]


def test_batch_envelope_cases(spark, check, hot):
    reqs = spark.createDataFrame([("a", hot), ("b", None), ("c", "nope"), ("d", hot), ("d", hot)], "req_id string, check_id string")
    q = LK.batch_envelope(check, FX.CHECK, reqs, fields=CHECK_FIELDS)
    n = LK.lookup(check, FX.CHECK, hot).count()
    got = sorted((r.req_id, r.rtn_sts, r.rtn_code, r.n_data) for r in q.collect())
    # a repeated key, or a repeated req_id, gets its own count
    assert got == [("a", "S", "0", n), ("b", "E", "-1", None), ("c", "S", "0", 0), ("d", "S", "0", n), ("d", "S", "0", n)]
    rows = LK.batch_reply_rows(check, FX.CHECK, reqs, fields=CHECK_FIELDS).collect()
    want = [r.id for r in LK.lookup(check, FX.CHECK, hot).collect()]
    assert [r.id for r in sorted((r for r in rows if r.req_id == "a"), key=lambda r: r.pos)] == want
    assert len(rows) == 3 * n and {r.pos for r in rows} == set(range(1, n + 1))


def test_envelope_of_a_hot_key_does_not_fan_out(spark):
    t = E._keyed(spark.range(100_000).selectExpr("cast(id as string) id", "'k' check_id", "'r' rule_no", "'t' rule_type", "'d' rule_desc"), FX.CHECK)
    reqs = spark.range(10_000).selectExpr("cast(id as string) req_id", "'k' check_id")
    env = LK.batch_envelope(t, FX.CHECK, reqs, fields=CHECK_FIELDS)
    assert [tuple(r) for r in env.groupBy("n_data").count().collect()] == [(100_000, 10_000)]


def test_wide_requests_are_not_broadcast(spark, check):
    wide = spark.range(3000).select(F.col("id").cast("string").alias("req_id"), F.repeat(F.lit("x"), 4000).alias("check_id"))
    assert LK._broadcast_bound(spark) < wide.select(F.sum(LK._row_bytes(wide.columns))).first()[0]



def test_batch_plan_broadcasts_requests_and_prunes(spark, check, hot):
    reqs = spark.createDataFrame([("a", hot)], "req_id string, check_id string")
    q = LK.batch_lookup(check, FX.CHECK, reqs, fields=CHECK_FIELDS)
    txt = plan_text(q)
    assert "BroadcastHashJoin" in txt or "BroadcastExchange" in txt
    assert not has_nested_loop_join(q)
    assert "salt IN" in txt or "salt = " in txt or "isnotnull(salt" in txt


def test_batch_without_broadcast_is_shuffle_join(spark, check, hot):
    reqs = spark.createDataFrame([("a", hot)], "req_id string, check_id string")
    q = LK.batch_lookup(check, FX.CHECK, reqs, fields=CHECK_FIELDS, broadcast_requests=False)
    assert not has_nested_loop_join(q)
    assert q.count() == LK.lookup(check, FX.CHECK, hot).count()


def test_scans(spark, check, hot):
    rng = LK.scan_range(check, FX.CHECK, "08", "1c", columns=["f:id"])
    assert rng.columns == ["row_key", "id"]
    keys = [r.row_key for r in rng.collect()]
    assert all("08" <= k < "1c" for k in keys)
    assert "salt" in " ".join(partition_filters(rng))
    with pytest.raises(ValueError):
        LK.scan_range(check, FX.CHECK, "0", "1", columns=["g:id"])
    lim = LK.scan_limit(check, FX.CHECK, 6, columns=["id"])
    assert "TakeOrderedAndProject" in plan_text(lim)
    first6 = [r.row_key for r in lim.collect()]
    assert first6 == sorted(r.row_key for r in check.select("row_key").collect())[:6]
    _, p, _ = LK.key_literals(FX.CHECK, hot)
    pre = LK.scan_prefix(check, FX.CHECK, p, ["f:id"])
    assert pre.count() == LK.lookup(check, FX.CHECK, hot).count()


def test_opinion_lookup(spark):
    t = E.published_opinion(spark, SF_SMALL)
    one = t.select("buss_no", "business_type").first()
    rows = LK.lookup(t, FX.OPINION, {"buss_no": one.buss_no, "business_type": one.business_type}, OPINION_FIELDS).collect()
    assert rows and all(r.buss_no + r.business_type == one.buss_no + one.business_type for r in rows)


def test_scan_range_two_digit_salts_equals_brute_force(spark):
    spec = FX.CHECK.with_(pre_regions=12)
    t = E._keyed(FX.check_rows(spark, SF_SMALL), spec)
    for start, stop in (("03", "11"), ("10", "11f"), (None, "02"), ("11", None), ("0a", "0b")):
        got = sorted(r.row_key for r in LK.scan_range(t, spec, start, stop, ["id"]).collect())
        want = sorted(r.row_key for r in t.collect() if (start is None or r.row_key >= start) and (stop is None or r.row_key < stop))
        assert got == want, (start, stop)
    assert {r.salt for r in t.collect()} <= set(range(12))
    assert any(r.row_key.startswith("1") for r in t.collect())


def test_many_requests_few_keys_keep_the_table_unshuffled(spark, check, hot):
    """Requests over the broadcast bound but few distinct keys: the keys are
    broadcast to the semi join, so the table side is not shuffled."""
    reqs = spark.range(3000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("req_id"),
                                    F.lit(hot).alias("check_id"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(128 * 1000))  # bound: 1000 requests
    try:
        q = LK.batch_lookup(check, FX.CHECK, reqs, fields=CHECK_FIELDS)
        txt = plan_text(q)
        assert "LeftSemi, BuildRight" in txt and "BroadcastHashJoin" in txt
        assert q.count() == 3000 * LK.lookup(check, FX.CHECK, hot).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_prefix_scan_equals_start_stop_scan(spark, check, hot):
    """P7: [prefix, next_prefix(prefix)) is exactly the rows starting with prefix."""
    from saltkv.functions.keys import next_prefix

    _, p, _ = LK.key_literals(FX.CHECK, hot)
    for prefix in (p, p[:5], p[:1]):
        stop = next_prefix(prefix).decode("utf-8")
        a = sorted(r.row_key for r in LK.scan_prefix(check, FX.CHECK, prefix, ["id"]).collect())
        b = sorted(r.row_key for r in LK.scan_range(check, FX.CHECK, prefix, stop, ["id"]).collect())
        assert a == b and a


def test_ordered_scans(spark, check, hot):
    keys = [r.row_key for r in LK.scan_range(check, FX.CHECK, "08", "1c", ["id"], ordered=True).collect()]
    assert keys == sorted(keys, key=lambda k: k.encode()) and keys
    _, p, _ = LK.key_literals(FX.CHECK, hot)
    keys = [r.row_key for r in LK.scan_prefix(check, FX.CHECK, p, ["id"], ordered=True).collect()]
    assert keys == sorted(keys) and keys


def test_salted_hot_keys_give_the_same_rows(spark):
    base = FX.check_rows(spark, "/root/testdata/sf0.01")
    hot = base.withColumn("check_id", F.when(F.col("id").cast("long") % 3 == 0, F.lit("HOT")).otherwise(F.col("check_id")))
    t = E._keyed(hot, FX.CHECK)
    reqs = hot.select("check_id").distinct().select(F.concat(F.lit("r"), "check_id").alias("req_id"), "check_id")
    reqs = reqs.unionByName(spark.createDataFrame([("again", "HOT")], "req_id string, check_id string"))
    want = sorted(map(tuple, LK.batch_lookup(t, FX.CHECK, reqs, fields=FX.CHECK.cols).collect()))
    q = LK.batch_lookup(t, FX.CHECK, reqs, fields=FX.CHECK.cols, broadcast_requests=False, salt_hot_keys=4, hot_rows=1000)
    got = q.collect()
    assert sorted(map(tuple, got)) == want
    assert sum(1 for r in got if r.check_id == "HOT") == 2 * 5000
    assert "__sub" in plan_text(q)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():  # the joins must shuffle, and small partitions stay apart
        spark.conf.set(k, v)
    try:
        q = LK.batch_lookup(t, FX.CHECK, reqs, fields=FX.CHECK.cols, salt_hot_keys=4, hot_rows=1000)
        parts = q.where(F.col("check_id") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert parts > 1  # the hot key's rows meet the requests in several tasks

"""SQL functions: values against the Python twins, and their plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from saltkv.functions.keys import prefix_py, row_key_py
from saltkv.operators.cells import from_cells_open
from saltkv.operators.layout import java_order
from saltkv.plans import fixtures as FX
from saltkv.plans import sql_functions as S
from saltkv.plans.inspect import plan_text, pushed_filters
from saltkv.session import scratch_path


@pytest.fixture(scope="module")
def spec(spark):
    from saltkv.sources import store as ST

    spec = FX.CHECK.with_(namespace="fn_tests", table_name="fn")
    ST.create_table(spark, spec, E.check_dir(spark, SF_SMALL), namespace_location=scratch_path(spark, "ns"))
    S.create_functions(spark, spec, "fn_tests.fn")
    return spec


def test_scalars_equal_the_twins(spark, spec):
    keys = ["", "a", "polygenelubricants", "é\U0001F600x", None, "899"]
    df = spark.createDataFrame([(k, "u1") for k in keys], "k string, u string")
    got = df.selectExpr("k", "fn_tests.fn_salt(k) s", "fn_tests.fn_prefix(k) p", "fn_tests.fn_row_key(k, u) r").collect()
    for r in got:
        text = "null" if r.k is None else r.k
        assert (r.s, r.p) == prefix_py(text, 3) and r.r == row_key_py(text, "u1", 3)


def test_composite_keys(spark):
    spec = FX.OPINION.with_(namespace="fn_tests", table_name="two")
    S.create_functions(spark, spec, namespace_location=scratch_path(spark, "ns"))
    r = spark.sql("SELECT fn_tests.two_prefix('10', NULL) a, fn_tests.two_prefix('1', '0null') b, fn_tests.two_row_key('x', 'y', 'z') c").first()
    assert r.a == r.b == prefix_py("10null", 3)[1] and r.c == row_key_py("xy", "z", 3)


def test_a_lookup_prunes_and_pushes(spark, spec):
    q = spark.sql("SELECT * FROM fn_lookup('10')")
    plan = plan_text(q)  # long expressions end in "...", so the lists have no closing bracket
    assert "PartitionFilters: [isnotnull(salt" in plan and "PushedFilters: [IsNotNull(prefix), In(prefix, [0" in plan
    assert q.count() == FX.check_rows(spark, SF_SMALL).where("check_id = '10'").count() > 0
    assert spark.sql("SELECT * FROM fn_lookup(NULL)").count() == 0


def test_a_business_key_filter_is_pushed(spark, spec):
    q = spark.sql("SELECT * FROM (SELECT id, check_id, fn_tests.fn_row_key(check_id, id) AS k FROM fn_tests.fn) WHERE check_id = '10'")
    assert "EqualTo(check_id,10)" in pushed_filters(q)[0]


def test_a_lateral_lookup_is_a_hash_join(spark, spec):
    q = spark.sql("SELECT x, id FROM VALUES ('10'), ('11'), (NULL) r(x), LATERAL fn_lookup(r.x)")
    assert "HashJoin" in plan_text(q) and "NestedLoop" not in plan_text(q)
    assert {r.x for r in q.collect()} <= {"10", "11"} and q.count() > 0


def test_open_cells(spark):
    rows = [("r", "a", "1", 1), ("r", "a", "0", 2), ("r", "x", "p", 1), ("r", "y", None, 1), ("s", "x", "q", 1), ("s", "x", "q", 1), ("t", "y", None, 3)]
    df = spark.createDataFrame(rows, "row_key string, qualifier string, value string, v long")
    got = {r.row_key: (r.a, r.b, dict(r.others)) for r in from_cells_open(df, ["a", "b"], version="v").collect()}
    assert got == {"r": ("0", None, {"x": "p"}), "s": (None, None, {"x": "q"})}
    assert from_cells_open(df, ["a"]).where("row_key = 'r'").first().a == "1"


def test_java_order(spark):
    words = ["z", "", "￿", "\U0001F600", "\U00010000a", "", "é", "zz"]
    df = spark.createDataFrame([(w,) for w in words], "k string")
    got = [r.k for r in df.orderBy(java_order("k")).collect()]
    assert got == sorted(words, key=lambda w: w.encode("utf-16-be"))
    assert got != [r.k for r in df.orderBy("k").collect()]

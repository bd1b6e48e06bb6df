import random

import pytest
from pyspark.sql import functions as F

from saltkv.functions import keys as K
from conftest import SF_MID


def _random_strings(n=300, seed=7):
    rnd = random.Random(seed)
    pools = [(32, 126), (0x4E00, 0x9FFF), (0x1F300, 0x1F64F), (0xE000, 0xFFFD), (0x10000, 0x10FFFF), (0x80, 0x7FF)]
    out = ["", "a", "polygenelubricants", "x😀y", "中文", "hello", "899", "5", "line\nbreak"]
    for _ in range(n):
        chars = []
        for _ in range(rnd.randint(0, 15)):
            lo, hi = rnd.choice(pools)
            cp = rnd.randint(lo, hi)
            if 0xD800 <= cp <= 0xDFFF:
                cp = 0x41
            chars.append(chr(cp))
        out.append("".join(chars))
    return out


def test_python_hash_fixed_values():
    assert K.java_string_hash_py("") == 0
    assert K.java_string_hash_py("polygenelubricants") == -2147483648
    assert K.java_string_hash_py("abc") == 96354
    # A supplementary character hashes as its two UTF-16 surrogates.
    assert K.java_string_hash_py("😀") == 0xD83D * 31 + 0xDE00


def test_salt_fixed_values():
    assert K.salt_py("899", 3) == 2
    assert K.salt_py("5", 3) == 2
    assert K.salt_py("hello", 3) == 1
    # Java: -2147483648 % 3 == -2, so the salt is 2.
    assert K.salt_py("polygenelubricants", 3) == 2


def test_salt_width():
    assert K.salt_width(1) == 1
    assert K.salt_width(10) == 1
    assert K.salt_width(11) == 2
    assert K.salt_width(12) == 2
    with pytest.raises(ValueError):
        K.salt_width(0)


@pytest.mark.parametrize("method", ["reflect", "sql"])
def test_spark_hash_equals_python(spark, method):
    strings = _random_strings()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = dict(df.select("i", K.java_string_hash(F.col("s"), method).alias("h")).collect())
    for i, s in enumerate(strings):
        assert got[i] == K.java_string_hash_py(s), repr(s)


def test_hash_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(K.java_string_hash("s").alias("h")).first().h is None
    assert df.select(K.java_string_hash("s", "sql").alias("h")).first().h is None


def test_row_keys_match_python_twin(spark):
    rows = [(str(i), s, f"u{i}") for i, s in enumerate(_random_strings(80, seed=3))]
    df = spark.createDataFrame(rows, "id string, k string, u string")
    for n in (3, 10, 12):
        out = K.add_row_keys(df, ["k"], "id", n).collect()
        for r in out:
            s, p = K.prefix_py(r.k, n)
            assert (r.salt, r.prefix, r.row_key) == (s, p, p + r.id)
            assert len(r.prefix) == K.salt_width(n) + 32


def test_composite_key_null_part_is_text_null(spark):
    df = spark.createDataFrame([("1", "a", None)], "id string, k1 string, k2 string")
    r = K.add_row_keys(df, ["k1", "k2"], "id", 3, keep_query_key=True).first()
    assert r.query_key == "anull"
    assert r.prefix == K.prefix_py("anull", 3)[1]


def test_salt_distribution_on_orders(spark):
    o = spark.read.parquet(f"{SF_MID}/orders.parquet")
    t = K.add_row_keys(o.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("c")), ["c"], "id", 3)
    counts = {r.salt: r["count"] for r in t.groupBy("salt").count().collect()}
    assert counts == {0: 4968, 1: 5012, 2: 5020}


def test_next_prefix():
    assert K.next_prefix("01dbdebfbc84bad48d92aa7c045019e8d") == b"01dbdebfbc84bad48d92aa7c045019e8e"
    assert K.next_prefix("") is None
    assert K.next_prefix("é") == bytes([0xC3, 0xAA])


def test_null_unique_value_fails(spark):
    df = spark.createDataFrame([(None, "k")], "id string, k string")
    with pytest.raises(Exception, match="unique column id is NULL"):
        K.add_row_keys(df, ["k"], "id", 3).collect()


def test_reflect_hash_keeps_shuffles_retry_safe(spark):
    """Catalyst flags ``reflect`` as nondeterministic (so no rewrite moves it),
    but the shuffle it feeds stays DETERMINATE: a lost executor's map output is
    recomputed by a plain task retry, with identical keys (a pure function)."""
    df = spark.range(50).select(F.col("id").cast("string").alias("s"))
    k = df.select(K.java_string_hash("s").alias("h"), "s").repartition(4, "h")
    qe = k._jdf.queryExecution()
    plan = qe.executedPlan()
    # Unwrap adaptive execution to reach the exchange.
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    assert plan.nodeName() == "Exchange"
    assert str(plan.shuffleDependency().rdd().outputDeterministicLevel()) == "DETERMINATE"


def test_hash_sql_text_for_sql_users(spark):
    strings = _random_strings(60, seed=9)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = dict(df.selectExpr("i", f"{K.java_string_hash_sql('s')} AS h").collect())
    assert all(got[i] == K.java_string_hash_py(s) for i, s in enumerate(strings))


def test_session_switch_selects_the_sql_hash(spark):
    from saltkv.plans.inspect import plan_text

    df = spark.createDataFrame([("1", "abc")], "id string, k string")
    spark.conf.set(K.HASH_METHOD_CONF, "sql")
    try:
        q = K.add_row_keys(df, ["k"], "id", 3)
        txt = plan_text(q)
        assert "reflect" not in txt and "aggregate" in txt
        assert q.first().prefix == K.prefix_py("abc", 3)[1]
    finally:
        spark.conf.unset(K.HASH_METHOD_CONF)
    assert "reflect" in plan_text(K.add_row_keys(df, ["k"], "id", 3))

"""Operator 8 against the base rules in Python; the chains on strings they never saw."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from saltkv.llm import secrets as S

RULES = {
    "assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
}


def brute(text):
    out = []
    for k, rx in RULES.items():
        for m in re.finditer(rx, text or ""):
            if {"assign": lambda: len(m[2]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32}[k]():
                out.append((*m.span(), k))
    return sorted(out, key=lambda s: (s[0], S.KINDS.index(s[2])))


@pytest.fixture(scope="module")
def model(spark):
    return S.train_secrets(spark.read.parquet(f"{SF_MID}/documents.parquet"))


def compare(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as base", "'x' as spans")
    got = S.find_secrets(df, model).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert r.base_spans == ",".join(f"{k}:{a}:{b}" for a, b, k in want), repr(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in want) for k in S.KINDS[:3]]
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
    return {r.doc_id: r for r in got}


def test_base_rules_on_random_text(spark, model):
    rng = random.Random(1)
    pieces = ["token", "Secret", "passwd", "PASSWORD", "api_key", "apikey", "=", ":", " ", "  ", "\"", "'", "abcdefgh", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef",
              "deadbeef", "é", "漢", "😀", "\n", "x", "=", "ſecret", "toKen", "K"]
    compare(spark, model, ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + [None, "", "f" * 70_000, "token=" + "a" * 70_000, "token=abcdefgh " * 2000])


def test_added_spans(spark, model):
    rng = random.Random(5)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    texts = [f"see {key} there", "ordinary words and someLongIdentifierName_ofTheThing here", f"token = {key}", "thationerandtheationing " * 3]
    got = compare(spark, model, texts)
    assert got[0].spans == "random:4:44" and got[2].spans == got[2].base_spans and got[3].spans == ""


def test_chains_tell_unseen_strings_apart(spark, model):
    rng = random.Random(9)
    rand = ["".join(rng.choice("0123456789abcdef" if i % 2 else string.ascii_letters + string.digits) for _ in range(24)) for i in range(300)]
    words = [r.w for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select(F.explode(F.split("text", r"[^A-Za-z]+")).alias("w")).where("length(w) >= 14").limit(300).collect()]
    df = spark.createDataFrame([(s, 1) for s in rand] + [(s, 0) for s in words], "s string, y int")
    rows = df.select("y", (model.score(F.col("s")) > model.threshold).alias("p")).collect()
    assert sum(r.p for r in rows if r.y) >= 0.95 * 300 and sum(r.p for r in rows if not r.y) <= 0.01 * len(words)


def test_empty_table_and_no_samples(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.op8_secrets(spark, docs).count() == 0
    docs = spark.createDataFrame([(1, "just words"), (1, None)], "doc_id long, text string")
    assert [(r.n_hex, r.spans) for r in S.op8_secrets(spark, docs).collect()] == [(0, "")] * 2


def test_no_python_in_the_plan(spark):
    from saltkv.llm.queries import q_op8

    plan = q_op8(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_the_documents_table(spark):
    import duckdb
    from saltkv.llm.queries import q_op8

    texts = dict(duckdb.sql(f"select doc_id, text from '{SF_MID}/documents.parquet'").fetchall())
    got = q_op8(spark, SF_MID).collect()
    assert len(got) == len(texts)
    extra = 0
    for r in got:
        want = ",".join(f"{k}:{a}:{b}" for a, b, k in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        extra += len(r.spans) - len(want)
    assert extra < 200  # the table holds hardly any secret in another form

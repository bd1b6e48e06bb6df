"""Operator 4 against the base rules stated with plain regular expressions."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from saltkv.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    x = [int(c) for c in d][::-1]
    return sum(x[0::2] + [sum(divmod(2 * c, 10)) for c in x[1::2]]) % 10 == 0


def brute(text):
    out = []
    for k, rx in RULES.items():
        for m in re.finditer(rx, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if k == "ip" else 0,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[k]
            if ok:
                out.append((*m.span(), k))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@pytest.fixture(scope="module")
def model():
    return pii.train([])


def test_base_rules_on_random_text():
    rng = random.Random(3)
    for pool in ("ab.@-_1 é", "0123456789.-+() ", "+1 4(5)-", "a@b.c@", "4111 1111-.", "٣12.4"):
        for _ in range(3000):
            t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
            assert sorted(pii.base_spans(t)[0], key=lambda s: (s[0], pii.KINDS.index(s[2]))) == brute(t), repr(t)


def test_long_runs_are_linear(model):
    began = time.time()
    for t in ("1" * 300_000, "a" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 150_000, "+1" + " " * 300_000, "1 " * 150_000, "a@" * 150_000, "0" * 9000 + ".1.2.3"):
        pii.scan(t, model)
    assert time.time() - began < 20


def test_many_spans_in_one_text_are_linear(model):
    text = " ".join(f"write a{i}@b{i}.org or call (0{i % 900 + 100}) 555-{i % 9000 + 1000} now" for i in range(8000))
    start = time.perf_counter()
    base, extra = pii.scan(text, model)
    assert len(base) >= 8000 and time.perf_counter() - start < 8
    both = sorted(base + extra)
    assert not any(a < d and c < b for (a, b, _), (c, d, _) in zip(both, both[1:]))


def test_extra_spans_are_those_of_a_pairwise_comparison(model):
    rng = random.Random(12)
    for _ in range(60):
        text = " ".join(rng.choice(("(212) 555-0199", "a@b.org", "x [at] y [dot] com", "1.2.3.4", "2024-10-11", "+44 20 7946 0958", "tel", "4111.1111.1111.1111")) for _ in range(30))
        base, extra = pii.scan(text, model)
        over = lambda c, d: c[0] < d[1] and d[0] < c[1]
        cand = [c for c in pii.extra_candidates(text) if not any(over(c, b) for b in base)]
        p = model.trees.predict(np.array([pii.features(text, c) for c in cand], float)) if cand else []
        want = []
        for _, c in sorted(((-x, c) for x, c in zip(p, cand) if x >= model.thresholds[c[2]]), key=lambda x: (x[0], x[1][0], -x[1][1])):
            if not any(over(c, o) for o in want):
                want.append(c)
        assert extra == want


def test_trees_learn_a_rule_and_generalise():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0) & (x[:, 3] < 0.5)).astype(float)
    t = pii.BoostedTrees().fit(x[:2000], y[:2000])
    assert ((t.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97


def test_held_out_candidates(model):
    rows = pii.made_up(1000, seed=99)
    p = model.trees.predict(np.array([pii.features(t, s) for t, s, _ in rows], float))
    y = np.array([r[2] for r in rows])
    take = p >= [model.thresholds[s[2]] for _, s, _ in rows]
    assert y[take].mean() >= 0.97 and take[y == 1].mean() >= 0.8


def test_extra_spans_add_and_never_replace(model):
    t = "write to john (at) host (dot) com or call (212) 555-0199, a@b.cd, on 2024-01-12 v1.2.3"
    base, extra = pii.scan(t, model)
    assert base == [(t.index("a@b"), t.index("a@b") + 6, "email")]
    assert {t[a:b] for a, b, _ in extra} == {"john (at) host (dot) com", "(212) 555-0199"}
    assert pii.redact(t, base + extra) == "write to [EMAIL] or call [PHONE], [EMAIL], on 2024-01-12 v1.2.3"


def test_query_rows_and_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "a@b.cd 10.0.0.1 4111 1111 1111 1111 +1 (212) 555-0100"), (3, "dup"), (None, "x@y.zz"), (4, "😀 é 1.2.3.4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as __text")
    got = sorted(pii.op4_pii(spark, df).collect(), key=lambda r: (r.doc_id or 0, r.spans))
    assert len(got) == len(rows)
    for r in got:
        text = next(t for k, t in rows if k == r.doc_id and (k != 3 or bool(r.spans) == ("@" in t)))
        spans = brute(text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in spans) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
    assert pii.op4_pii(spark, df.limit(0)).count() == 0


def test_the_documents_table(spark):
    import duckdb

    from conftest import SF_MID
    from saltkv.llm.queries import q_op4

    want = {k: brute(t) for k, t in duckdb.sql(f"select doc_id, text from '{SF_MID}/documents.parquet'").fetchall()}
    got = q_op4(spark, SF_MID).collect()
    assert len(got) == len(want)
    for r in got:
        text = [f"{k}:{a}:{b}" for a, b, k in want[r.doc_id]]
        assert r.base_sha256 == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(filter(None, text)) <= set(r.spans.split(","))
    extra = sum(len(r.spans.split(",")) - len(want[r.doc_id]) for r in got if r.spans)
    assert extra <= 3  # the table holds no personal data in other layouts


def test_redact_keeps_all_columns(spark, model):
    df = spark.createDataFrame([(1, "x a@b.cd", "en"), (2, None, None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in pii.redact_documents(df, model).orderBy("doc_id").collect()] == [(1, "x [EMAIL]", "en"), (2, None, None)]


def test_every_document_trains_the_model(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('call +1 212 555 0', 100 + id % 800, ' or v', id, '.900.1.', id % 300) as text")
    rows = [r.text for r in docs.collect()]
    local, spread = pii.train_pii(docs), pii.train_pii(docs, local_rows=0)
    want = pii.train(rows)
    assert local.trees.trees == spread.trees.trees and local.thresholds == spread.thresholds
    assert local.trees.trees == want.trees.trees and local.thresholds == want.thresholds
    few = pii.train(rows[:2000])
    assert few.trees.trees != want.trees.trees  # the others count


def test_labelled_spans_are_those_of_a_pairwise_comparison():
    rng = random.Random(8)
    for _ in range(300):
        t = "".join(rng.choice("19.+-() @ab") for _ in range(rng.randint(0, 60)))
        ok, bad = pii.base_spans(t)
        assert pii.labelled(t) == [(s, 1) for s in ok] + [(s, 0) for s in bad if not any(a <= s[0] and s[1] <= b for a, b, _ in ok)]

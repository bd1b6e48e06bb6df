"""Operator 3: held-out accuracy, the fusion against plain Python, edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from saltkv.llm import langid as L


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    return L.train_text_model(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    held = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    got = L.identify(L.document_rows(held), model).join(held.select(F.col("doc_id").alias("id"), F.col("lang").alias("truth")), "id").collect()
    assert len(got) == held.count()
    assert np.mean([r.lang == r.truth for r in got]) > 0.98


def test_score_is_the_same_in_pieces(model, monkeypatch):
    texts = ["The and of.", "", "x", "Élle ÇA été", "ab  cd", "word " * 50, "漢字" * 40]
    import pyarrow as pa

    data, off = L.text_bytes(pa.array([*texts, None]))
    n, ll = model.score(data, off)
    for i, t in enumerate(texts):
        n1, ll1 = model.score(*L.text_bytes(pa.array([t])))
        assert (n1[0], ll1[0].tolist()) == (n[i], pytest.approx(ll[i].tolist(), abs=1e-4)), t
    monkeypatch.setattr(L, "_PIECE", 16)
    n2, ll2 = model.score(data, off)
    assert n2.tolist() == n.tolist() and np.allclose(ll, ll2, atol=1e-3)
    assert n[-1] == 0 and model.score(data[:0], np.zeros(1, np.int64))[0].size == 0


def plain_identify(rows, model):
    """The fusion in plain Python."""
    import pyarrow as pa

    names, unit = [*model.langs, L.UND], 1_000_000
    ev = []
    for i, text, host, declared in rows:
        n, ll = model.score(*L.text_bytes(pa.array([text], pa.string())))
        n, k = int(n[0]), min(int(n[0]), L.TEXT_WEIGHT)
        logs = [x / n * k if n else 0.0 for x in ll[0]] + [model.und * k if n else 0.0]
        e = np.exp(np.array(logs) - max(logs))
        host = (host or "").lower()
        dom = ".".join(host.split(".")[-2:])
        suf = host.split(".")[-1] if "." in host and not host.split(".")[-1].isdecimal() else ""
        d = None if not declared else declared.split("-")[0].lower()
        d = d if d is None or d in model.langs else "other"
        ev.append((i, n, np.array(logs), np.round(e / e.sum() * unit), host, dom, suf, d))
    tot = sum((e[3] for e in ev if e[1]), np.zeros(len(names)))
    base = (tot + unit) / (tot + unit).sum()
    add = lambda f: sum((e[3] for e in ev if e[1] and f(e)), np.zeros(len(names)))
    out = {}
    for i, n, logs, _, host, dom, suf, d in ev:
        c = add(lambda e: e[5] == dom)
        p = (c + L.DOMAIN_KAPPA * unit * base) / (c.sum() + L.DOMAIN_KAPPA * unit)
        c = add(lambda e: e[4] == host)
        p = (c + L.HOST_KAPPA * unit * p) / (c.sum() + L.HOST_KAPPA * unit) if any(e[1] and e[4] == host for e in ev) else base
        logs = logs + np.log(p)
        if suf and any(e[1] and e[6] == suf for e in ev):
            c = add(lambda e: e[6] == suf)
            logs = logs + np.log((c + unit * c.sum() / tot.sum()) / (tot + unit))
        if d:
            c, seen = add(lambda e: e[7] == d), add(lambda e: e[7] is not None)
            logs = logs + np.log((c + unit * np.array([0.9 if d == x else 0.1 / len(names) for x in names])) / (seen + unit))
        e = np.exp(logs - logs.max())
        out[i] = e / e.sum()
        if not n and not d and not suf:
            out[i] = None
    return out


def test_fusion_against_plain_python(spark, model):
    rows = [
        (1, "Der die das und ist nicht", "www.a.de", "de"), (2, "Der und die", "b.de", "xx"), (3, "The of and to", "c.example.com", "en-GB"),
        (4, "", "www.a.de", None), (5, None, None, None), (6, "123 ;;", "10.0.0.1", "fr"), (7, "qzx", "www.a.de", "de"),
        (8, "les que de la pour", "x.fr", None), (8, "les que de la pour", "x.fr", None), (9, "漢字漢字漢字漢字", "", None),
    ]
    df = spark.createDataFrame(rows, "id long, text string, host string, declared string")
    got = L.identify(df, model).collect()
    want = plain_identify(rows, model)
    assert len(got) == len(rows)
    names = [*model.langs, L.UND]
    for r in got:
        if want[r.id] is None:
            assert (r.lang, r.confidence) == (L.UND, 1.0)
            continue
        assert r.posterior == pytest.approx(want[r.id].tolist(), abs=1e-5), r.id
        assert r.lang == names[int(np.argmax(want[r.id]))] and math.isclose(r.confidence, max(want[r.id]), abs_tol=1e-5)
    assert {r.id: r.lang for r in got}[9] == L.UND


def test_empty_tables_and_kept_columns(spark, model):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert L.op3_language_id(spark, docs.limit(0)).count() == 0
    odd = docs.limit(50).select("doc_id", "text", "lang", "source", "n_chars", F.lit("k").alias("host"), F.lit(1).alias("n"))
    junk = odd.limit(1).select(F.lit(10**9).cast("long").alias("doc_id"), F.lit("漢字漢字漢字").alias("text"), "lang", "source", "n_chars", "host", "n")
    kept = L.keep_identified(odd.unionByName(junk), model)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in odd.collect())


def test_pages(spark):
    got = {r.page_id: r for r in L.language_id_pages(spark, SF_MID).collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/pages.parquet").count()
    assert np.mean([r.lang == r.declared for r in got.values() if r.declared in ("de", "en", "es", "fr")]) > 0.95

"""Operator 2: the lattice, and links against brute force."""

import itertools
import math

import numpy as np
import pytest

from conftest import SF_MID
from saltkv.llm import e8_dedup as E


def brute(rows):
    """``{vec_id: (links, component)}`` and the matrix of cosines."""
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    link = np.zeros((len(rows), len(rows)), bool)
    for d in {len(rows[i][1]) for i in ok}:
        at = np.array([i for i in ok if len(rows[i][1]) == d])
        u = np.array([rows[i][1] for i in at], float)
        u /= np.linalg.norm(u, axis=1)[:, None]
        link[np.ix_(at, at)] = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(rows))
    while True:
        new = np.array([min(label[i], label[link[i]].min(initial=len(rows))) for i in range(len(rows))])
        new = new[new]
        if (new == label).all():
            break
        label = new
    comp = {}
    for i, (k, _) in enumerate(rows):
        comp[label[i]] = min(comp.get(label[i], k), k)
    return [(k, int(link[i].sum()), comp[label[i]]) for i, (k, _) in enumerate(rows)], link


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).selectExpr("*", "1 as label", "2 as cid", "'x' as h")
    return E.op2_embedding_dedup(spark, df).collect()


def test_decoding_is_nearest():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(300, 8)) * 2
    p = E.decode(y)
    assert E.neighbours().shape == (240, 8) and np.allclose((E.neighbours() ** 2).sum(axis=1), 2)
    assert ((2 * p) % 1 == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    d = ((y - p) ** 2).sum(axis=1)
    assert (d <= 1 + 1e-9).all()  # the covering radius
    for v in E.neighbours():
        assert (d <= ((y - p - v) ** 2).sum(axis=1) + 1e-9).all()


def pairs_at(cos, n, dim, rng):
    u = rng.normal(size=(n, dim))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.normal(size=(n, dim))
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    return u, cos * u + np.sqrt(1 - cos**2) * w


@pytest.mark.parametrize("blocks", [1, 2, 3, 4])
def test_recall_of_the_index(blocks):
    rng = np.random.default_rng(3)
    tables = E.layout(400_000 * 100 ** (blocks - 1))[1]
    n = 2000 if blocks < 3 else 500
    for cos, least in ((0.901, 0.9), (0.95, 0.97), (0.98, 0.99)):
        u, v = pairs_at(cos, n, 64, rng)
        met = np.zeros(n, bool)
        for t in range(tables):
            cu, cv = E.cells(u, t, blocks), E.cells(v, t, blocks)
            met |= (cu == cv[:, :1]).any(axis=1) | (cv == cu[:, :1]).any(axis=1)
        assert met.mean() >= least, (cos, met.mean())


def test_layout_grows_slowly():
    assert [E.layout(n)[0] for n in (0, 400_000, 400_001, 40_000_000, 10**10)] == [1, 1, 2, 2, 4]


def test_edge_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [1.0] * 7 + [None]), (5, [1.0] * 7 + [math.inf]), (6, [math.nan] * 8), (7, [1.0] * 8), (8, [1.0] * 8),
            (8, [1.0] * 8), (9, [2.0] * 8), (10, [-1.0] * 8), (11, [1.0] * 9), (12, [1e-30] * 8), (13, [1e30] * 7 + [9e29]), (3, [0.0] * 8)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in run(spark, rows))
    assert got == sorted(brute([(k, v and [x if x is None else float(np.float32(x)) for x in v]) for k, v in rows])[0])
    assert all(r.kept == (r.vec_id == r.component_id) for r in run(spark, rows[:5]))
    assert run(spark, []) == []


def test_clusters_and_blocks(spark):
    rng = np.random.default_rng(4)
    far = rng.normal(size=(300, 32))
    center = rng.normal(size=(3, 32))
    near = np.concatenate([c + rng.normal(size=(n, 32)) * s for c, n, s in zip(center, (2600, 200, 150), (0.05, 0.2, 0.33))])
    v = np.concatenate((far, near, np.repeat(far[:3], 40, axis=0))).astype(np.float32)
    ids = rng.permutation(len(v))
    rows = [(int(k), [float(x) for x in r]) for k, r in zip(ids, v)]
    want, link = brute(rows)
    got = {r.vec_id: r for r in run(spark, rows)}
    found = sum(r.n_links for r in got.values())
    assert all(got[k].n_links <= n for k, n, _ in want)
    assert found >= 0.97 * link.sum()
    sure = [(k, n, c) for k, n, c in want if k in set(ids[: 300].tolist()) | set(ids[300:2900].tolist())]
    assert sum(got[k].component_id == c for k, _, c in sure) >= 0.99 * len(sure)


def test_the_embeddings_table(spark):
    import duckdb
    from saltkv.llm.queries import q_op2

    rows = duckdb.sql(f"select vec_id, embedding from '{SF_MID}/embeddings.parquet'").fetchall()
    want, link = brute(rows)
    got = {r.vec_id: r for r in q_op2(spark, SF_MID).collect()}
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.97 * link.sum()
    assert np.mean([got[k].component_id == c for k, _, c in want]) >= 0.99

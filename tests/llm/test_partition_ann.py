"""Operator 12 against brute force."""

import math

import numpy as np
import pytest

from conftest import SF_MID
from saltkv.llm import partition_ann as P


def brute(rows, n=20):
    """``{query: [(vec_id, score)]}`` in double precision."""
    def good(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    kept = sorted({(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows if i is not None and good(v)})
    out = {}
    for q, u in kept:
        if q % 20 == 0:
            near = [(-float((np.array(u) * np.array(v)).sum()), i) for i, v in kept if i != q and len(v) == len(u)]
            out.setdefault(q, []).extend(near)
    return {q: [(i, -s) for s, i in sorted(x)[:n]] for q, x in out.items() if x}


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).selectExpr("*", "1 as id", "2 as part", "'x' as v")
    got = {}
    out = P.op12_learned_partitions(spark, df).collect()
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    return got


def listed(v):
    return [float(x) for x in v]


def share(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hits / sum(len(x) for x in want.values())


def test_edge_rows(spark):
    rows = [(0, [1.0] * 8), (1, None), (2, []), (3, [0.0] * 8), (4, [1.0] * 7 + [None]), (5, [math.nan] * 8), (6, [math.inf] * 8), (None, [1.0] * 8),
            (7, [2.0] * 8), (7, [2.0] * 8), (8, [1.0] * 8), (9, [1.0] * 8), (20, [1.0] * 8), (40, [1.0, 2.0]), (41, [3.0, 1.0]), (60, [1.0] * 3), (11, [-1.0] * 8)]
    want = brute(rows)
    assert run(spark, rows) == want and want[0][0] == (7, 16.0) and [i for i, _ in want[0]][1:4] == [8, 9, 20] and 60 not in want
    assert run(spark, rows[1:6]) == {} and run(spark, []) == {}


def test_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    same = listed(rng.normal(size=16))
    rows = [(i, same if i % 3 == 0 else listed(rng.normal(size=16))) for i in range(900)]
    want, got = brute(rows), run(spark, rows)
    for q in range(0, 900, 60):  # copies: the smallest ids, exactly
        assert got[q] == want[q]
    assert share(got, want) >= 0.9


def test_small_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, listed(v)) for i, v in enumerate(rng.normal(size=(600, 8)))]
    whole = run(spark, rows)
    monkeypatch.setattr(P, "BLOCK_BYTES", 8 * 8 * 20)  # 20 vectors a block
    assert run(spark, rows) == whole


def test_recall_with_clusters(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 24))
    v = centers[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 24))
    rows = [(i, listed(x)) for i, x in enumerate(v)]
    rows = [(i, listed(np.array(x) * (1 + i % 3))) for i, x in rows]  # norms differ
    assert share(run(spark, rows), brute(rows)) >= 0.9


def test_recall_of_the_table(spark):
    import duckdb
    from saltkv.llm.queries import q_op12

    rows = duckdb.sql(f"select vec_id, embedding from '{SF_MID}/embeddings.parquet'").fetchall()
    want, got = brute(rows), {}
    for r in q_op12(spark, SF_MID).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert share(got, want) >= 0.9
    score = {(q, i): s for q, near in want.items() for i, s in near}
    assert all(score.get((q, i), s) == pytest.approx(s, abs=1e-12) for q, near in got.items() for i, s in near)


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(4)
    group = np.repeat(np.arange(8), 100)
    v = rng.normal(size=(8, 16))[group] + 0.3 * rng.normal(size=(800, 16))
    d = ((v[:, None] - v[None]) ** 2).sum(axis=2) + np.eye(800) * 1e9
    links = np.argsort(d, axis=1)[:, :10]
    label = P.balanced_parts(links, 8, rng)
    sizes = np.bincount(label, minlength=8)
    assert sizes.max() - sizes.min() <= 3
    random = rng.permutation(label)
    cut = (label[np.arange(800)[:, None]] != label[links]).mean()
    assert cut < 0.4 * (random[np.arange(800)[:, None]] != random[links]).mean()


def test_router_learns_the_parts():
    rng = np.random.default_rng(5)
    label = np.repeat(np.arange(4), 200)
    v = rng.normal(size=(4, 16))[label] * 2 + rng.normal(size=(800, 16))
    r = P.Router(16, 4, rng)
    r.fit(P.directions(v), label, np.full((800, 2), -1), rng)
    assert (r.ranked(v, 1)[:, 0] == label).mean() > 0.95


def test_best_of_is_exact_and_bounded():
    rng = np.random.default_rng(6)
    v = rng.integers(-2, 3, (500, 4)).astype(float)  # many ties
    ids = rng.permutation(500)
    q = np.arange(0, 500, 25)
    i, name, score, at = P.best_of(ids[q], v[q], ids, v, 7, step=64)
    for k, row in enumerate(q):
        want = sorted((-float(v[row] @ v[j]), ids[j]) for j in range(500) if j != row)[:7]
        assert [(-s, n) for s, n in zip(score[i == k], name[i == k])] == want
    assert (ids[at] == name).all()

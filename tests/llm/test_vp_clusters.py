"""Operator 11 against clustering in plain Python integers."""

import hashlib
import math

import numpy as np
import pytest

from conftest import SF_MID, SF_SMALL
from oracle import compare, duck
from saltkv.llm import vp_clusters as V


def brute(rows, k=16, rounds=3, dim=64, scale=64):
    def fits(v):
        return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x) < (1 << 62) // scale for x in v)

    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if fits(v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        who = [near(v)[1] for _, v in kept]
        for j in set(who):
            own = [v for (_, v), w in zip(kept, who) if w == j]
            cents[j] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, near(v)) for i, v in kept]
    total = sum(d for _, (d, _) in out)
    per = {}
    for _, (d, j) in out:
        per[j] = per.get(j, 0) + d
    long = (1 << 63) - 1
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, min(d, long), min(per[j], long), min(total, long), sha[j]) for i, (d, j) in out), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).selectExpr("*", "1 as id", "2 as v", "3 as cluster")
    return sorted((tuple(r) for r in V.op11_centroid_clusters(spark, df).collect()), key=str)


def vectors(n, rng, dim=64, spread=1.0):
    return [(i, [float(x) for x in rng.normal(size=dim) * spread]) for i in range(n)]


def test_random_vectors(spark):
    rows = vectors(300, np.random.default_rng(1))
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_few_values(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(0, 2, 64) * (np.arange(64) < 3)]) for i in range(200)]
    assert run(spark, rows) == brute(rows)
    rows = [(i % 7, [0.5] * 64) for i in range(60)]  # one group of copies, shared ids
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = vectors(20, rng) + [(30, None), (31, []), (32, [1.0] * 63), (33, [1.0] * 63 + [None]), (34, [math.nan] * 64), (35, [math.inf] * 64),
                               (None, [0.25] * 64), (36, [1e6] * 64), (37, [-3e9] * 64), (38, [1e30] * 64), (39, [-0.001] * 64)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:3]) == brute(rows[:3])
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []


@pytest.mark.parametrize("k", [1, 4, 5, 37, 300])
def test_search_equals_all_distances(k):
    rng = np.random.default_rng(k)
    for span in (2, 50, 1 << 25):
        c = rng.integers(-span, span + 1, (k, 6))
        v = np.concatenate((rng.integers(-span, span + 1, (400, 6)), c, (c[:1] + c[-1:]) // 2))
        d = V._squares(v, c)
        who, best = V.VantageTree(c).nearest(v)
        assert (best == d.min(axis=1)).all() and (who == d.argmin(axis=1)).all()  # argmin: the smaller number


def test_search_prunes():
    rng = np.random.default_rng(5)
    at = rng.integers(-1000, 1000, (64, 3))
    seen = []
    tree = V.VantageTree(at)
    visit = tree._visit
    tree._visit = lambda k, v, rows, *a: (seen.append(len(rows) * len(tree.points[k])), visit(k, v, rows, *a))
    tree.nearest(np.repeat(at, 20, axis=0) + rng.integers(-9, 10, (1280, 3)))
    assert sum(seen) < 0.5 * 1280 * 64


def test_the_tree_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(V, "TREE_BYTES", 100)
    with pytest.raises(ValueError):
        run(spark, vectors(5, np.random.default_rng(0)))


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_sql(spark, sf):
    from saltkv.llm.queries import ORACLE, q_op11

    s, d = compare(q_op11(spark, sf), duck(sf), ORACLE["op11_centroid_clusters"])
    assert s == d and s[0] > 0

"""Operator 1 against all pairs of shingle sets."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from conftest import SF_MID
from saltkv.llm.components import components
from saltkv.llm.ngram_join import keep_first_of_component, ngram_components
from saltkv.llm.shingles import shingle_sets


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """``{row: (n, component)}`` by union-find over all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    inter = Counter()
    for own in by.values():
        for k, i in enumerate(own):
            for j in own[:k]:
                inter[j, i] += 1
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for (i, j), n in inter.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return [(k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows)]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "1 as n", "2 as key", "'x' as __text")
    got = sorted(map(tuple, ngram_components(df, **kw).collect()))
    want = sorted(brute(rows))
    assert [r for r in got if r not in set(want)] == [] and got == want


def test_shingle_hashes_stand_for_shingles():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "B", "é", "漢", "ab", "c\x0bd", "x y"]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    texts += ["", " \n ", "one", "A" * 5000, " lead and trail "]
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    got = dict(shingle_sets(np.frombuffer(b"".join(raw), np.uint8), off))
    names = {}
    for i, t in enumerate(texts):
        s = shingles(t)
        assert len(got.get(i, ())) == len(s), repr(t)
        names.setdefault(frozenset(s), set()).add(got.get(i, np.zeros(0)).tobytes())
    assert all(len(v) == 1 for v in names.values()) and len({next(iter(v)) for v in names.values()}) == len(names)


def test_edge_rows(spark):
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (9, "a b c d e"), (7, "A B\x0bC d e"), (8, "a b c d e f"),
                  (8, "a b c d e f"), (10, "É x y z w"), (11, "é x y z w"), (12, "w" * 100_000)])


def test_empty_table(spark):
    assert ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_clusters_common_passages_and_chains(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    text = lambda n: [word() for _ in range(n)]
    rows, base, passage, boiler = [], text(120), text(50), text(90)

    def changed(w, n):
        w = list(w)
        for _ in range(n):
            w[rng.randrange(len(w))] = word()
        return w

    rows += [" ".join(changed(base, rng.randint(0, 6))) for _ in range(160)]  # near copies on both sides of the threshold
    rows += [" ".join(base)] * 70  # exact copies
    rows += [" ".join(text(rng.randint(30, 90)) + passage + text(rng.randint(30, 90))) for _ in range(130)]  # strangers with a passage
    rows += [" ".join(boiler + text(rng.randint(1, 30))) for _ in range(130)]  # mostly boilerplate
    rows += [" ".join(passage[: rng.randint(20, 50)]) for _ in range(80)]
    chain = text(100)
    for _ in range(25):  # neighbours link, the ends don't
        rows.append(" ".join(chain))
        chain = chain[4:] + text(4)
    rows += [" ".join(text(rng.randint(1, 9))) for _ in range(40)]
    rng.shuffle(rows)
    check(spark, [(i * 3 + 1, t) for i, t in enumerate(rows)])


def test_the_documents_table(spark):
    from saltkv.llm.queries import q_op1

    rows = duckdb.sql(f"select doc_id, text from '{SF_MID}/documents.parquet'").fetchall()
    assert sorted(map(tuple, q_op1(spark, SF_MID).collect())) == sorted(brute(rows))


def test_one_of_each_component_stays(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(5, t, "a"), (3, t + " x", "b"), (9, None, None), (8, "", "c"), (4, "other", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    assert sorted(r.doc_id for r in keep_first_of_component(df).collect()) == [3, 4, 8, 9]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (None, 3), (500, 500)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hashing_a_long_text_table_takes_little_memory():
    import tracemalloc

    from saltkv.llm import shingles as S

    data = np.frombuffer(b"some words of a text that goes on. " * 120_000, np.uint8)  # 4 MB in 1,000 texts
    offsets = np.linspace(0, len(data), 1001).astype(np.int64)
    S._POWERS.clear()
    tracemalloc.start()
    try:
        n = sum(len(x) > 0 for _, x in shingle_sets(data, offsets))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 1000 and peak < 30_000_000

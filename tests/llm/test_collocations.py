"""Operator 13 against counting in plain Python, and against SQL."""

import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_MID, SF_SMALL
from oracle import compare, duck
from saltkv.llm import collocations as C


def brute(rows, least=C.LEAST, first=C.FIRST):
    """Rows of ``collocations`` for ``(lang, text)``."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_of = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows_of.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows_of)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return df.selectExpr("*", "1 as doc_id", "'x' as word", "2 as n", "3 as route")


def run(spark, rows, **kw):
    return sorted(tuple(r) for r in C.collocations(frame(spark, rows), **kw).collect())


def texts(n, rng, words=12):
    vocabulary = [f"{c}{d}" for c in "abcÄé" for d in range(words)]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    out = []
    for _ in range(n):
        w = rng.choice(vocabulary, size=rng.integers(0, 60), p=weight / weight.sum())
        glue = rng.choice([" ", "  ", "\t", ", ", ".\n", " - "], size=len(w), p=[0.7, 0.05, 0.05, 0.1, 0.05, 0.05])
        out.append((str(rng.choice(["en", "de"])), "".join(x + g for x, g in zip(w, glue)) + " The Quick brown Fox jumps"))
    return out


def test_random_texts(spark):
    rows = texts(250, np.random.default_rng(1))
    want = brute(rows)
    assert run(spark, rows) == want and len(want) > 20
    assert run(spark, rows, least=3, first=40) == brute(rows, 3, 40)


def test_hot_pairs_and_triples_are_split(spark, monkeypatch):
    """Routes by three and four words, small flushes and slices: the same counts."""
    rows = texts(150, np.random.default_rng(2)) + [("en", "of the x1 y1 " * 50 + f"of the x1 z{i % 9} of the q{i % 7} r{i % 5}") for i in range(60)]
    want = brute(rows)
    monkeypatch.setattr(C, "FINE", 64)
    monkeypatch.setattr(C, "ROUTE", 400)
    monkeypatch.setattr(C, "FLUSH", 500)
    monkeypatch.setattr(C, "SLICE", 64)
    seen = []
    of = C.Routes.__init__
    monkeypatch.setattr(C.Routes, "__init__", lambda self, *a: (of(self, *a), seen.append((self.hot[0].sum(), self.hot[1].sum()))) and None)
    assert run(spark, rows) == want
    assert seen[0][0] > 0 and seen[0][1] > 0


def test_edge_rows(spark):
    rows = [(None, None), (None, ""), ("en", " \t "), ("en", "...\n"), (None, "A b\tc  D" * 40), ("und", "a B c d " * 40), ("en", "one")]
    rows += [("fr", "le chat\x0bnoir")] * 31 + [("fr", "x y z w")] * 30 + [("fr", "un deux")] * 29
    want = brute(rows)
    assert run(spark, rows) == want and any(r[2] == "x y z w" for r in want) and not any(r[2] == "un deux" for r in want)
    assert run(spark, rows[:4]) == [] and run(spark, []) == []


def test_one_long_text(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [("en", " ".join(rng.choice(["a", "b", "c", "dd", "e."], size=40_000)))]
    monkeypatch.setattr(C, "SLICE", 1000)
    monkeypatch.setattr(C, "FLUSH", 3000)
    assert run(spark, rows) == brute(rows)


def test_sorting_counts_prefixes():
    rng = np.random.default_rng(4)
    w = C.suffixes(np.concatenate((rng.integers(0, 6, 3000), [0, 0, 0])).astype(np.int32), 3000)
    w = w[:, w[1] > 0]
    for partial in (0, 2, 3):
        distinct, weight = C.combined(w)
        got = {tuple(distinct[:m, at]): n for at, m, n in C.frequent_prefixes(distinct, weight, 20, partial)}
        want = Counter(tuple(col[:m]) for col in w.T.tolist() for m in (2, 3, 4) if col[m - 1])
        assert got == {p: n for p, n in want.items() if n >= 20 or len(p) <= partial}


def test_infrequent_parts_are_abandoned():
    w = np.array([[1, 1], [2, 2], [3, 4], [5, 6]], np.int32)
    assert sorted(C.frequent_prefixes(w, np.array([20, 15]), 30)) == [(0, 2, 35)]


def test_scores_past_64_bits(spark):
    big = 1 << 60
    p = spark.createDataFrame([(b"en", b"a b", 2, big), (b"en", b"a b c", 3, 7 * big // 10)], "lang binary, phrase binary, words int, a long")
    w = spark.createDataFrame([(b"en", b"a", 2 * big), (b"en", b"b", 3 * big), (b"en", b"c", big)], "lang binary, word binary, n long")
    # b c isn't a candidate here, so only the cut behind "a b" counts
    got = {r.phrase: (r.l, r.r, r.score) for r in C.scored(w, p.where("words = 2")).collect()}
    assert got == {"a b": (2 * big, 3 * big, 400000)}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_sql(spark, sf):
    from saltkv.llm.queries import ORACLE, q_op13

    s, d = compare(q_op13(spark, sf), duck(sf), ORACLE["op13_collocations"])
    assert s == d and s[0] > 10

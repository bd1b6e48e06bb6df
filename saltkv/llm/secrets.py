"""Operator 8: secrets by rules and character Markov models (DataFrame functions only).

The *base* rules (assigned values, access keys, long hex runs) are always reported.  Any
other run of ``[A-Za-z0-9+/_=-]`` of at least ``LEAST`` characters is scored by two Markov chains over
characters: one of random strings, one of ordinary words and identifiers.  It is reported
as ``random`` if the mean log-likelihood ratio of its transitions passes a threshold.

Training.  The labelled samples come from the documents: values of base matches are
random strings, words of ``TRAIN_DOCS`` texts (the first by hash) that are left without their base matches are ordinary.  Transitions are
counted by grouped aggregation; the table (64 characters squared) and the score quantiles that set the threshold
are all that reaches the driver.

Scale.  Scoring is one map over the documents without a shuffle: regular expressions of Java, which stay linear
here (no pattern can match from two places of one run), and array functions on the few matches.

Defined cases.  Null texts are empty and have no spans.  Repeated rows and ids give a row each.
Without random or ordinary samples the smoothed chains are equal and nothing is added.  Empty tables give
empty results.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, written

KINDS = ("assign", "access", "hex", "random")
LEAST = 20
TRAIN_DOCS = 5000
SAMPLE_TASKS = 64
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(_ALPHABET)

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: What a base rule accepts, wherever it stands.
_BASE = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}"""
    r"|AKIA[A-Z0-9]{12,}|(?<![0-9a-f])[0-9a-f]{32,}"
)
_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """``struct(a, k, b, kind, s)`` of the leftmost non-overlapping matches, in code points.
    ``keep`` filters by the match and its first group."""
    order = KINDS.index(kind)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if keep is not None and "([A" in pattern else whole
    gaps = F.split(text, pattern, -1)  # what stands before each match, and behind the last
    rows = F.arrays_zip(whole.alias("m"), group.alias("g"), F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"))
    kind_of = "struct<a:int,k:int,b:int,kind:string,s:string,g:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind_of}>").alias("out"))

    def step(acc, r):
        a = acc["at"] + F.length(r["gap"])
        b = a + F.length(r["m"])
        one = F.struct(a.alias("a"), F.lit(order).alias("k"), b.alias("b"), F.lit(kind).alias("kind"), r["m"].alias("s"), r["g"].alias("g"))
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(one.cast(kind_of))).alias("out"))

    found = F.aggregate(rows, start, step, lambda acc: acc["out"])
    found = F.filter(found, keep) if keep is not None else found
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{kind_of}>"))


def base_spans(text: Column) -> Column:
    """All base spans of a text (not sorted)."""
    return F.concat(
        _spans(text, _ASSIGN, "assign", lambda s: F.length(s["g"]) >= 8),
        _spans(text, _ACCESS, "access", lambda s: F.length(s["s"]) >= 16),
        _spans(text, _HEX, "hex"),
    )


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["a"] < span["b"]) & (span["a"] < o["b"]))


# ------------------------------------------------------------ the chains


def _transitions(s: Column) -> Column:
    """Numbers of the character pairs of a string of the alphabet."""
    at = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(_ALPHABET), c) - 1)
    at = F.filter(at, lambda i: i >= 0)
    return F.zip_with(F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0))), F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), lambda x, y: x * _N + y)


class SecretModel:
    """Log-likelihood ratios of the transitions, and the threshold of their mean."""

    def __init__(self, ratio: np.ndarray, threshold: float):
        self.ratio, self.threshold = ratio, threshold

    def score(self, s: Column) -> Column:
        """Mean log-likelihood ratio of a string's transitions (null: none)."""
        table = F.array(*[F.lit(float(x)) for x in self.ratio])
        pairs = _transitions(s)
        return F.aggregate(pairs, F.lit(0.0), lambda a, i: a + F.get(table, i)) / F.nullif(F.size(pairs), F.lit(0))


def training_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = TRAIN_DOCS) -> DataFrame:
    """``s, y``: values of base matches of all documents (1), and words of at least six characters of ``n_docs`` sample
    texts without their base matches (0).  The sample is dealt over ``SAMPLE_TASKS`` tasks; a text that rows share counts once."""
    d = id_text(docs, id_col, text_col).where(F.col("__text").isNotNull())
    base = d.where(F.col("__text").rlike(f"{_ASSIGN}|{_ACCESS}|{_HEX}")).select(F.explode(base_spans(F.col("__text"))).alias("s"))
    random = base.select(F.when(F.col("s.kind") == "assign", F.col("s.g")).otherwise(F.col("s.s")).alias("s"), F.lit(1).alias("y"))
    h = F.xxhash64("__text")
    last = d.select(h.alias("h")).distinct().orderBy("h").limit(n_docs).agg(F.max("h")).first()[0]
    sample = d.select("__text", h.alias("h")).where(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).repartition(SAMPLE_TASKS, "h")
    rest = F.regexp_replace("__text", _BASE, "\n")  # no word of a match remains
    plain = sample.select(F.explode(F.regexp_extract_all(rest, F.lit(_RUN % 6), F.lit(0))).alias("s"), F.lit(0).alias("y"))
    return written(random.unionByName(plain), "secret-strings")


def train_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = TRAIN_DOCS) -> SecretModel:
    rows = training_strings(docs, id_col, text_col, n_docs)
    pairs = rows.select("y", F.explode(_transitions(F.col("s"))).alias("i")).groupBy("y", "i").agg(F.count(F.lit(1)).alias("n"))
    counts = np.full((2, _N * _N), 0.5)
    for r in pairs.collect():  # at most 2 * 67 * 67 rows
        counts[r.y, r.i] += r.n
    by = counts.reshape(2, _N, _N)
    logp = np.log(by / by.sum(axis=2, keepdims=True)).reshape(2, -1)
    model = SecretModel(np.round(logp[1] - logp[0], 6), 0.0)
    # midway between the greatest scores of ordinary runs and the least of random strings
    scored = rows.where(F.length("s") >= 12).select("y", model.score(F.col("s")).alias("x"))
    q = {r.y: r for r in scored.groupBy("y").agg(F.percentile_approx("x", [0.02, 0.999], 10_000).alias("q")).collect()}
    if len(q) == 2:
        model.threshold = max(0.1, (q[1].q[0] + q[0].q[1]) / 2, q[0].q[1])
    else:
        model.threshold = float("inf")
    return model


# ------------------------------------------------------------ documents


def find_secrets(docs: DataFrame, model: SecretModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, base counts, ``base_spans`` and ``spans`` as text."""
    d = id_text(docs, id_col, text_col).select(F.col("__id").alias("doc_id"), F.coalesce("__text", F.lit("")).alias("text"))
    runs = _spans(F.col("text"), _RUN % LEAST, "random")
    d = d.select("doc_id", base_spans(F.col("text")).alias("base"), runs.alias("runs"))
    good = F.filter("runs", lambda r: _apart(r, F.col("base")) & (model.score(r["s"]) > model.threshold))
    d = d.select("doc_id", "base", F.when(F.size("runs") > 0, good).otherwise(F.col("runs")).alias("more"))

    def text(spans):
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")

    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return d.select("doc_id", *counts, text(F.col("base")).alias("base_spans"), text(F.concat("base", "more")).alias("spans"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op8_secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    found = find_secrets(docs, train_secrets(docs))
    return found.withColumn("base_sha256", F.sha2(F.col("base_spans"), 256)).drop("base_spans")

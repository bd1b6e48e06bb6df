"""Operator 9: toxicity by a subsequence-kernel support vector machine.

Words are compared by the gap-weighted subsequence kernel (all subsequences of ``P`` letters, a
letter skipped costs ``DECAY``), normalised and raised to ``POWER``, so an insult with
letters or signs inserted stays close to the insult.  A sentence's
kernel with a landmark word is the sum over its words.  Landmarks are words of the training sentences;
the Nystroem map ``K(x, landmarks) K(landmarks, landmarks)^-1/2`` makes the machine linear, so a
sentence's margin is a sum of one number a word, which workers keep for words they meet again.
A document scores by its most toxic sentence or run of sentences of at most ``PASSAGE`` words, through a logistic fit.

Training.  On the driver from at most ``TRAIN_DOCS`` labelled documents, by hash of doc_id, none of
them held out.  Typical of documents marked 1 are words and word beginnings (stems) that stand there more often than chance
allows for as many as were tried, however weaker than the strongest; the strongest is taken, its words leave
the count, and so on until none is left, so that all languages and stems are covered and no number bounds the landmarks.
Sentences and passages are labelled by rounds: all of a document
marked 0 are negative, and of a document marked 1 those with a word that is ``SURE`` alone, and the one that the machine so far finds most toxic, are
positive.  Sure words with a letter inserted are added as positive sentences.

Scale.  Scoring is a map over Arrow batches; memory is a batch and ``CACHE_WORDS`` numbers.

Defined cases.  Null and empty texts score as a sentence without words.  Words over ``WINDOW``
letters are scored by overlapping windows; single letters in a row
(``s p a c e d``) also count as one word.  Repeated rows score alike.  With fewer than 5
documents of either label, or no word typical of label 1, every score is the share of label 1 (0 without labels).  An
empty table gives an empty result.  Extra columns are ignored; labels, lang, source and
doc_id are never inputs of a score.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections import Counter, deque

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KnownWords, hash_sample

P, DECAY, POWER, GAPS = 3, 0.8, 3, 2
TRAIN_DOCS, ROUNDS, C = 4000, 3, 5.0
#: What a positive sentence weighs in training; a negative one weighs 1.
POSITIVE = 3.0
WINDOW = 24
CHUNK = 4096  # words compared at once
LANES = 512  # of those, words whose tables are held at once
#: Words of a run of sentences that score together.
PASSAGE = 200
#: Share of a word's sentences in documents marked 1 from which it tells alone.
SURE = 0.9
CACHE_WORDS = 1 << 19
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:[ .*_-]{1,2}[^\W\d_]){2,}(?!\w)")
_OTHER = re.compile(r"[\W\d_]+")
_END = re.compile(r"[.!?]+[\"')\]]*$")
_LAST = frozenset(".!?\"')]")  # what such a word ends with


def letters(word: str) -> str:
    return word if word.isalpha() else _OTHER.sub("", word)


# ------------------------------------------------------------ the kernel


def _codes(words: list[str]) -> np.ndarray:
    """``letters x words``; zero pads and equals nothing."""
    n = max(map(len, words), default=1)
    out = np.zeros((n, len(words)), np.uint32)
    for k, w in enumerate(words):
        out[: len(w), k] = np.frombuffer(w.encode("utf-32-le"), np.uint32)
    return out


def prefix_kernels(s: np.ndarray, t: np.ndarray, sizes: set[int]) -> dict[int, np.ndarray]:
    """By size, the unnormalised kernel of the first ``size`` letters of each column of ``s`` with the same (or the only)
    column of ``t``.  What stands before a letter doesn't depend on those behind it, so all sizes share one table."""
    n, m = len(s), len(t)
    out = {size: np.empty(s.shape[1], np.float32) for size in sizes if 0 < size <= n}
    for k in range(0, s.shape[1], LANES):
        own, with_ = s[:, k : k + LANES], t if t.shape[1] == 1 else t[:, k : k + LANES]
        match = ((own[:, None] == with_[None]) & (own != 0)[:, None]) * np.float32(DECAY**2)
        below = None  # ones
        for _ in range(P - 1):
            here = np.zeros((n + 1, m + 1, own.shape[1]), np.float32)
            run = np.zeros_like(own, np.float32)
            for b in range(m):  # all letters of ``s`` at once
                run *= DECAY
                run += match[:, b] if below is None else match[:, b] * below[:-1, b]
                here[1:, b + 1] = run
            for a in range(1, n):
                here[a + 1, 1:] += here[a, 1:] * np.float32(DECAY)
            below = here
        match *= below[:-1, :-1]
        total = np.zeros(own.shape[1], np.float32)
        for a in range(n):
            match[a, 0] += total
            total = np.add.accumulate(match[a], axis=0)[-1]  # one after another, however few lanes
            if a + 1 in out:
                out[a + 1][k : k + LANES] = total
    return out


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Unnormalised kernel of each column of ``s`` with the same (or the only) column of ``t``."""
    return prefix_kernels(s, t, {len(s)})[len(s)]


def _pair_bits(codes: np.ndarray, gaps: int) -> np.ndarray:
    """256 bits for each word: the pairs of letters at most ``gaps`` letters apart."""
    n, w = codes.shape
    out = np.zeros((w, 4), np.uint64)
    for d in range(1, min(gaps + 2, n)):
        a, b = codes[:-d].astype(np.uint64), codes[d:].astype(np.uint64)
        cell = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(56)
        bit = np.where(b != 0, np.uint64(1) << (cell & np.uint64(63)), np.uint64(0))
        for k in range(4):
            out[:, k] |= np.bitwise_or.reduce(np.where(cell >> np.uint64(6) == k, bit, np.uint64(0)), axis=0)
    return out


class WordKernel:
    """Powered, normalised kernel values of words with the landmarks.  A word gets 0 for a
    landmark unless seven in ten of its neighbouring letters also stand in the word, in this order and with
    at most ``GAPS`` letters between.  A landmark of ``stems`` is compared with the word's beginnings of
    as many letters and of up to ``GAPS`` more, and the best counts, so that an ending takes nothing away."""

    def __init__(self, landmarks: list[str], stems: frozenset[str] = frozenset()):
        self.landmarks = landmarks
        self.heads = [range(len(x), len(x) + GAPS + 1) if x in stems else (WINDOW,) for x in landmarks]
        self.codes = [_codes([x]) for x in landmarks]
        self.own = [float(subsequence_kernel(c, c)[0]) for c in self.codes]
        self.bits = np.concatenate([_pair_bits(c, 0) for c in self.codes]) if landmarks else np.zeros((0, 4), np.uint64)
        self.least = np.ceil(0.7 * np.bitwise_count(self.bits).sum(axis=1)).astype(int)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)))
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) >= P:
                by.setdefault((len(w) + 3) // 4, []).append(i)  # few sizes: shorter words are padded
        for at in (x[i : i + CHUNK] for x in by.values() for i in range(0, len(x), CHUNK)):
            own = [words[i] for i in at]
            s = _codes(own)
            bits = _pair_bits(s, GAPS)
            lanes = np.ascontiguousarray(bits.T)
            near = np.stack([sum(np.bitwise_count(lanes[k] & x[k]).astype(np.int16) for k in range(4)) for x in self.bits], axis=1) >= self.least[None]
            some = np.flatnonzero(near.any(axis=1))
            if not len(some):
                continue
            s = s[:, some]
            norms = {}
            for j, t in enumerate(self.codes):
                k = np.flatnonzero(near[some, j])
                if len(k):
                    best = np.zeros(len(k))
                    sizes = {min(size, len(s)) for size in self.heads[j]}
                    for size, value in prefix_kernels(s[: max(sizes), k], t, sizes).items():
                        if size not in norms:
                            norms[size] = np.maximum(subsequence_kernel(s[:size], s[:size]), 1e-9)
                        best = np.maximum(best, value / np.sqrt(norms[size][k] * self.own[j]))
                    out[np.array(at)[some[k]], j] = np.minimum(best, 1.0) ** POWER
        return out


def _windows(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


# ------------------------------------------------------------ sentences


def sentences(text: str) -> list[list[str]]:
    """Words (as written, in lower case) of each sentence of a text, spaced words joined."""
    out: list[list[str]] = []
    for line in (text or "").lower().split("\n"):
        own: list[str] = []
        for w in line.split():
            own.append(w)
            if w[-1] in _LAST and _END.search(w):
                out.append(own)
                own = []
        if own:
            out.append(own)
        spaced = [letters(m[0]) for m in _SPACED.finditer(line)]
        if spaced:
            out.append(spaced)
    return out


def with_passages(sums: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Rows of ``sums`` (of sentences of ``sizes`` words), and below them, for each sentence, the sum
    over the longest run of sentences of at most ``PASSAGE`` words that ends with it."""
    total = np.concatenate((np.zeros((1, sums.shape[1])), sums.cumsum(axis=0)))
    words = np.concatenate(([0], np.cumsum(sizes)))
    end = np.arange(1, len(words))
    first = np.minimum(np.searchsorted(words, words[1:] - PASSAGE), end - 1)
    return np.concatenate((sums, total[end] - total[first]))


class ToxicModel:
    """Landmarks, the linear machine over the Nystroem map, and the logistic scale."""

    def __init__(self, kernel: WordKernel | None, weight: np.ndarray | None, bias: float, slope: float, offset: float):
        self.kernel, self.weight, self.bias, self.slope, self.offset = kernel, weight, bias, slope, offset
        self.key = uuid.uuid4().hex

    def words(self, words: list[str]) -> list[float]:
        """What each word adds to a margin."""
        parts = [_windows(letters(w)) for w in words]
        flat = list({p for x in parts for p in x})
        value = (self.kernel(flat) @ self.weight).round(3)  # next to nothing is nothing
        value = dict(zip(flat, value.tolist()))
        return [max((value[p] for p in x), key=abs, default=0.0) for x in parts]

    def margins(self, texts: list[str]) -> list[float]:
        """The greatest margin of a sentence or passage of each text."""
        if self.kernel is None:
            return [0.0] * len(texts)
        known = _known(self.key)
        get = known.__getitem__
        lower = [t.lower() for t in texts]
        lists = [t.split() for t in lower]
        spaced = [[letters(m[0]) for m in _SPACED.finditer(t)] for t in lower]
        for words in (*lists, *spaced):
            deque(map(get, words), 0)  # notes new words
        new = list(known.lacks)
        known.lacks = {}
        for i in range(0, len(new), 20_000):
            known.update(zip(new[i : i + 20_000], self.words(new[i : i + 20_000])))
        out = []
        for t, words, extra in zip(texts, lists, spaced):
            if any(map(get, words)) or extra:
                own = sentences(t)
                sums = np.array([sum(map(get, s)) for s in own], float).reshape(-1, 1)
                out.append(self.bias + with_passages(sums, [len(s) for s in own]).max(initial=-np.inf if own else 0.0))
            else:
                out.append(self.bias)
        if len(known) > CACHE_WORDS:
            known.clear()
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.array(self.margins(texts)) + self.offset, -50, 50)))


_CACHES: dict[str, KnownWords] = {}


def _known(key: str) -> KnownWords:
    if key not in _CACHES:
        _CACHES.clear()  # one model at a time
        _CACHES[key] = KnownWords()
    return _CACHES[key]


# ------------------------------------------------------------ training


def _svm(x: np.ndarray, y: np.ndarray, share: np.ndarray, c: float = C) -> tuple[np.ndarray, float]:
    """Linear squared-hinge machine over rows that weigh ``share``, by Newton steps on its support."""
    sign = np.where(y == 1, 1.0, -1.0)
    a = np.hstack((x, np.ones((len(x), 1))))
    w, ridge = np.zeros(a.shape[1]), np.eye(a.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        on = sign * (a @ w) < 1
        h = ridge + 2 * c * (a[on].T * share[on]) @ a[on]
        new = np.linalg.solve(h, 2 * c * a[on].T @ (share[on] * sign[on]))
        if np.allclose(new, w, atol=1e-9):
            break
        w = 0.5 * (w + new) if _ > 20 else new
    return w[:-1], float(w[-1])


def _slope(m: np.ndarray, y: np.ndarray) -> float:
    """Slope of a logistic fit of ``y`` by the margins ``m``; its middle stays at margin 0,
    where the machine decides."""
    grid = np.linspace(0.25, 10, 100)
    loss = [np.logaddexp(0, -np.where(y == 1, 1, -1) * g * m).sum() for g in grid]
    return float(grid[int(np.argmin(loss))])


def _constant(y: np.ndarray) -> ToxicModel:
    """Without anything to learn from: the share of label 1 for every text."""
    p = float(np.clip(y.mean() if len(y) else 0.0, 1e-12, 1 - 1e-12))
    return ToxicModel(None, None, 0.0, 0.0, float(np.log(p / (1 - p))))


def typical_words(count: list[Counter], n: list[int]) -> tuple[dict[str, bool], frozenset[str]]:
    """Words and beginnings of words surely over-represented in toxic sentences, strongest first, and whether each is
    ``SURE`` alone; which of them are beginnings of several words.  ``count``: sentences by word, ``n``: sentences, of clean and toxic documents."""
    share = n[1] / max(1, n[0] + n[1])
    stems: dict[str, list[int]] = {}
    words: dict[str, list[str]] = {}
    for w, k in count[1].items():
        for j in range(P, min(len(w), WINDOW) + 1):
            stems.setdefault(w[:j], [0, 0])[1] += k
    stems = {w: at for w, at in stems.items() if at[1] >= 4}
    for w in count[1].keys() | count[0].keys():
        for j in range(P, min(len(w), WINDOW) + 1):
            if w[:j] in stems:
                stems[w[:j]][0] += count[0][w]
                words.setdefault(w[:j], []).append(w)
    least = max(3.0, np.sqrt(2 * np.log(max(1, len(stems)))))

    def over(at):  # deviations from the expected count
        c, k = at
        odds = np.log((k + 0.5) / (n[1] + 1)) - np.log((c + 0.5) / (n[0] + 1))
        return (k - (k + c) * share) / np.sqrt((k + c) * share + 1) if k >= 4 and odds > 2 else 0.0

    left = {w: v for w, at in stems.items() if (v := over(at)) >= least}
    gone: set[str] = set()
    out: dict[str, bool] = {}
    several: set[str] = set()
    while left:
        best = min(left, key=lambda w: (-left[w], -len(w), w))
        c, k = stems[best]
        out[best] = (k + 0.5) / (k + c + 1) >= SURE
        if sum(count[1][w] > 0 for w in words[best] if w not in gone) > 1:
            several.add(best)
        for w in words[best]:  # they leave the count of their other beginnings
            if w in gone:
                continue
            gone.add(w)
            for j in range(P, min(len(w), WINDOW) + 1):
                if (at := stems.get(w[:j])) is not None:
                    at[0] -= count[0][w]
                    at[1] -= count[1][w]
        left = {w: v for w in left if (v := over(stems[w])) >= least}
    return out, frozenset(several)


def train(texts: list[str], labels: list[int]) -> ToxicModel:
    y = np.array(labels, float)
    if min((y == 1).sum(), (y == 0).sum()) < 5:
        return _constant(y)
    sents = [[s for s in ([sys.intern(letters(w)) for w in ws] for ws in sentences(t)) if any(s)] or [[""]] for t in texts]
    # words by distinct sentence, so that copies of a document count once
    seen: list[set] = [set(), set()]
    for own, label in zip(sents, labels):
        seen[int(label)].update(tuple(s) for s in own)
    seen[1] -= seen[0]
    count = [Counter(w for s in x for w in set(s) if len(w) >= P) for x in seen]
    n = [len(x) for x in seen]
    del seen  # the driver's memory is short
    typical, stems = typical_words(count, n)
    if not typical:
        return _constant(y)
    sure = [w for w in typical if typical[w]]
    marks = sure + [w for w in typical if not typical[w]]
    # and the words of clean documents that come closest to those
    plain = sorted({w for w in count[0] if len(w) <= WINDOW and w not in typical and not w.startswith(tuple(marks))})
    close = WordKernel(marks, stems)(plain).max(axis=1, initial=0.0) if plain else np.zeros(0)
    marks += [plain[i] for i in sorted(range(len(plain)), key=lambda i: (-close[i], plain[i]))[: len(typical) // 3 + 1] if close[i] > 0]
    kernel = WordKernel(marks, stems)
    gram = kernel(marks)
    lam, vec = np.linalg.eigh((gram + gram.T) / 2)
    root = vec @ np.diag(1 / np.sqrt(np.maximum(lam, 1e-3))) @ vec.T
    vocab = sorted({w for own in sents for s in own for w in s})
    value = kernel(vocab)
    some = np.flatnonzero(value.any(axis=1))
    value = dict(zip([vocab[i] for i in some], value[some] @ root))
    nothing = np.zeros(len(marks))
    starts, begins = tuple(typical), tuple(sure)
    lead = {w: w.startswith(starts) + (len(texts) if begins and w.startswith(begins) else 0) for w in vocab}  # sure ones count most
    phi = (with_passages(np.array([sum((value[w] for w in s if w in value), nothing) for s in own]), [len(s) for s in own]) for own in sents)
    phi = [f if label == 1 else (f[f.any(axis=1)], len(f)) for f, label in zip(phi, labels)]
    lead = [with_passages(np.array([[sum(lead[w] for w in s)] for s in own]), [len(s) for s in own])[:, 0] for own in sents]
    clean = [f for f, label in zip(phi, labels) if label == 0]
    empty = sum(k - len(f) for f, k in clean)  # those of clean documents that are nothing, in one row
    clean = np.concatenate((np.zeros((1, len(marks))), *[f for f, _ in clean]))
    times = np.concatenate(([empty], np.ones(len(clean) - 1)))
    phi = [f if label == 1 else None for f, label in zip(phi, labels)]
    # sure words written with a letter too many are positive sentences of their own
    rng = np.random.default_rng(9)
    made = [w[:i] + chr(97 + int(rng.integers(26))) + w[i:] for w in sure for i in range(1, len(w))]
    made = kernel([*sure, *made]) @ root
    weight = None
    for _ in range(ROUNDS):
        # a document without any typical word has no sentence to learn from
        bags = [(lead[i], f) for i, f in enumerate(phi) if labels[i] == 1 and lead[i].any()]
        pick = [f[(k >= len(texts)) | (np.arange(len(f)) == (k if weight is None else f @ weight).argmax())] for k, f in bags]
        toxic = np.concatenate((made, *pick))
        weight, bias = _svm(np.concatenate((clean, toxic)), np.concatenate((np.zeros(len(clean)), np.ones(len(toxic)))), np.concatenate((times, np.full(len(toxic), POSITIVE))))
    model = ToxicModel(kernel, root @ weight, bias, 1.0, 0.0)
    model.slope = _slope(np.array(model.margins(texts)), y)
    return model


# ------------------------------------------------------------ Spark


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train_toxicity(docs: DataFrame, labels: DataFrame, n_docs: int = TRAIN_DOCS) -> ToxicModel:
    own = labels.select(F.col("doc_id").alias("i"), F.col("toxic").cast("int").alias("y")).where("i is not null and y in (0, 1)")
    own = own.where(~held_out(F.col("i"))).groupBy("i").agg(F.max("y").alias("y"))
    own = hash_sample(own, "i", n_docs, ["i"])
    rows = docs.select(F.col("doc_id").alias("i"), F.col("text").alias("t")).where("t is not null").join(F.broadcast(own), "i")  # n_docs rows
    rows = rows.groupBy("i", "y").agg(F.max("t").alias("t")).orderBy("i").collect()
    return train([r.t for r in rows], [r.y for r in rows])


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 1500):
                part = batch.slice(i, 1500)
                p = model.scores([t or "" for t in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op9_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_toxicity(docs, train_toxicity(docs, labels))

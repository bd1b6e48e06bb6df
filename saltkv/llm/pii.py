"""Operator 4: personal data by candidate gradient boosting.

High-recall generators propose overlapping spans.  The *base* rules (e-mail, IP
address, card number with a Luhn digit, international phone number) are always
redacted.  Every other candidate (``name (at) host dot com``, national phone
numbers, grouped digit runs ...) is scored by gradient-boosted trees on its format
and context, and taken where its score passes a threshold calibrated on
held-out candidates for precision.

The trees are trained from labelled candidates: spans that a base
rule accepts (1) or checked and refused (0) in every document, and spans made up by format rules (``made_up``), with layouts the base rules
miss.  The features hold format and context, never a base rule's verdict.  Executors find the candidates and count equal ones; bins are
percentiles of all training candidates, and a tree is grown from sums over all of them (``histogram``: whole numbers, so no order
of addition changes a tree).  Equal binned candidates are one row with a count: up to ``LOCAL_ROWS`` such rows are summed on the driver,
more by a Spark job for each level of a tree, with the same result.  Thresholds are calibrated on all candidates of a third of the
texts, by a hash of the text.  Documents are scored batch by batch in ``mapInArrow``: no shuffle, and memory of one batch.

Defined cases.  A null text is empty and has no spans.  Every scan is linear in the text, so very
long texts and long digit or address runs cost no more than their length.
Repeated rows and ties are scored row by row.  An empty table trains on the made-up
candidates alone.  Extra columns are ignored by ``find_pii`` and kept by ``redact``.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, lean, written
from .spans import Span, span_text

KINDS = ("email", "ip", "card", "phone")
#: Distinct binned candidates (27 bytes each) whose sums are taken on the driver.
LOCAL_ROWS = 100_000
#: Gradients are summed in whole units of this; thresholds stand on a grid.
_UNIT, _GRID = 1 << 20, np.arange(10_001) / 10_000
#: Share of accepted held-out candidates that must be labelled positive.
PRECISION = 0.99

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a digit run starts, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping e-mails: around each ``@``, not at each letter."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
        # without a match, what stands before this @ can't belong to a later one
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans the base rules accept, and candidates they checked and refused."""
    ok, bad = emails(text), []
    for m in _IP.finditer(text):
        (ok if all(len(p := x.lstrip("0")) < 4 and int(p or 0) < 256 for x in m[0].split(".")) else bad).append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        (ok if 12 <= len(digits) <= 19 and luhn(digits) else bad).append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        (ok if 9 <= len(_DIGITS.sub("", m[0])) <= 15 else bad).append((*m.span(), "phone"))
    return ok, bad


# ------------------------------------------------------------ generators

_GENERATORS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?[\[({]\s?(?:at|AT)\s?[\])}]\s?[A-Za-z0-9-]{1,63}+(?:\s?[\[({]\s?(?:dot|DOT)\s?[\])}]\s?|\.)[A-Za-z]{2,24}")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])(?:00|\(?0)?[0-9]{0,3}[ .-]?\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,5}){1,4}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-][0-9]{3,6}){2,4}(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\s?\.\s?[0-9]{1,3}|\[\.\][0-9]{1,3}){3}(?![0-9A-Za-z])")),
)
_MAY = re.compile(r"[0-9]|(?i:[\[({]\s?at\s?[\])}])")
_CUES = (
    re.compile(r"(?i)\b(?:tel|phone|call|fax|mobile|cell|tél|telefon|teléfono)\w*"),
    re.compile(r"(?i)\b(?:card|visa|mastercard|amex|carte|karte|tarjeta|credit)\w*"),
    re.compile(r"(?i)\b(?:ip|addr|host|server|from)\b"),
    re.compile(r"(?i)\b(?:mail|email|contact|write|e-mail)\w*"),
)


def extra_candidates(text: str) -> list[Span]:
    if not _MAY.search(text):
        return []
    return [(*m.span(), kind) for kind, rx in _GENERATORS for m in rx.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    """Format and context of one candidate."""
    a, b, kind = span
    s, before = text[a:b], text[max(0, a - 24) : a]
    groups = re.findall(r"[0-9]+", s)
    lens = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    lead, tail = text[a - 1 : a] if a else " ", text[b : b + 1] or " "
    return [
        KINDS.index(kind), len(s), len(digits), len(groups), max(lens), min(lens), lens[0], lens[-1],
        s.count("."), s.count("-"), s.count(" "), s.count("("), s.count("/"), float(s[0] == "+"), float(s[:2] == "00"),
        float(lead.isalnum()), float(tail.isalnum()), float(lead.isspace() or lead in "\"'(:=<"), float(tail.isspace() or tail in ".,;)\"'>"),
        sum(c.isalpha() for c in s) / len(s), len(set(digits)), float(digits[:1] in "3456" and digits[:1] != ""),
        max([int(g) for g in groups if len(g) < 6], default=0),
        *(float(bool(rx.search(before))) for rx in _CUES),
    ]


# ------------------------------------------------------------ boosted trees


def _margin(codes: np.ndarray, trees: list[tuple], bias: float) -> np.ndarray:
    score = np.full(len(codes), bias)
    for f, k, fl, kl, l0, l1, fr, kr, r0, r1 in trees:
        left = np.where(codes[:, fl] <= kl, l0, l1)
        right = np.where(codes[:, fr] <= kr, r0, r1)
        score += np.where(codes[:, f] <= k, left, right)
    return score


def histogram(codes: np.ndarray, y: np.ndarray, n: np.ndarray, bins: int, trees: list[tuple], bias: float, split: tuple | None) -> np.ndarray:
    """``node, feature, bin``: sums of gradients and second derivatives (in whole ``_UNIT``-ths) and of rows, for the whole
    (``split`` ``None``) or for the two sides of a split.  Sums of parts add up to the whole's exactly."""
    p = 1 / (1 + np.exp(-_margin(codes, trees, bias)))
    sums = [np.rint((y - p) * _UNIT) * n, np.rint(p * (1 - p) * _UNIT) * n, n]
    every = np.ones(len(codes), bool)
    sides = [every] if split is None else [codes[:, split[0]] <= split[1], codes[:, split[0]] > split[1]]
    out = np.zeros((len(sides), codes.shape[1], bins + 1, 3))
    for i, rows in enumerate(sides):
        for f in range(codes.shape[1]):
            c = codes[rows, f]
            for j, w in enumerate(sums):
                out[i, f, :, j] = np.bincount(c, w[rows], bins + 1)
    return out


class BoostedTrees:
    """Logistic gradient boosting of depth-2 trees on binned features."""

    def __init__(self, rounds: int = 60, rate: float = 0.3, bins: int = 32, least: int = 5):
        self.rounds, self.rate, self.bins, self.least = rounds, rate, bins, least
        self.trees: list[tuple] = []
        self.bias = 0.0

    def _split(self, h: np.ndarray) -> tuple:
        """The best ``(gain, feature, bin)`` of one node's histogram; rows with a code <= bin go left."""
        best = (1e-6, 0, -1)
        for f in range(len(h)):
            gl, hl, n = np.cumsum(h[f], axis=0).T / np.array([[_UNIT], [_UNIT], [1]])
            gs, hs = gl[-1], hl[-1]
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            gain[(n < self.least) | (n[-1] - n < self.least)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        return best

    def cut(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1])) for f in range(x.shape[1])]

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = self.cut(x)
        codes, n = self.encode(x), np.ones(len(y))
        return self.grow(lambda *at: histogram(codes, y, n, self.bins, *at), y.mean())

    def grow(self, sums, share: float) -> BoostedTrees:
        """Trees from ``sums(trees, bias, split)``, the ``histogram`` of all training rows, of which ``share`` are positive."""
        p = np.clip(share, 1e-3, 1 - 1e-3)
        self.bias = float(np.log(p / (1 - p)))
        for _ in range(self.rounds):
            _, f, k = self._split(sums(self.trees, self.bias, None)[0])
            if k < 0:
                break
            tree = [f, k]
            for h in sums(self.trees, self.bias, (f, k)):
                _, f2, k2 = self._split(h)
                k2 = k2 if k2 >= 0 else self.bins + 1
                g, d = h[f2, :, 0] / _UNIT, h[f2, :, 1] / _UNIT
                tree += [f2, k2, *(float(self.rate * g[r].sum() / (d[r].sum() + 1)) for r in (slice(0, k2 + 1), slice(k2 + 1, None)))]
            self.trees.append(tuple(tree))
        return self

    def predict_codes(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_margin(codes, self.trees, self.bias)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.predict_codes(self.encode(x))


class PiiModel:
    """Trees and one threshold for each kind (over 1: the kind adds nothing)."""

    def __init__(self, trees: BoostedTrees, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def extra(self, text: str, base: list[Span]) -> list[Span]:
        cand = extra_candidates(text)
        if not cand:
            return []
        taken = bytearray(len(text))  # a mark for each code point of a span: linear in spans and candidates

        def free(c: Span) -> bool:
            return taken.find(1, c[0], c[1]) < 0

        def take(spans) -> None:
            for a, b, _ in spans:
                taken[a:b] = b"\1" * (b - a)

        take(base)
        cand = [c for c in cand if free(c)]
        if not cand:
            return []
        p = self.trees.predict(np.array([features(text, c) for c in cand], float))
        good = sorted(((-p[i], c) for i, c in enumerate(cand) if p[i] >= self.thresholds[c[2]]), key=lambda x: (x[0], x[1][0], -x[1][1]))
        out: list[Span] = []
        for _, c in good:  # the surest of overlapping candidates stays
            if free(c):
                take([c])
                out.append(c)
        return out


def made_up(n: int, seed: int = 4) -> list[tuple[str, Span, int]]:
    """``n`` labelled candidates from format rules: personal data in layouts that
    the base rules miss, and dates, versions, amounts and lists that look alike."""
    rng = random.Random(seed)
    num = lambda k, lo=0: "".join([str(rng.randint(lo, 9))] + [str(rng.randint(0, 9)) for _ in range(k - 1)])
    word = lambda: "".join(rng.choice("abcdefghinorstuv") for _ in range(rng.randint(3, 9)))

    def card() -> str:
        d = rng.choice("3456") + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return rng.choice("./_").join((d[:4], d[4:8], d[8:12], d[12:]))

    good = (
        ("email", lambda: f"{word()} {'[('[(k := rng.randint(0, 1))]}at{'])'[k]} {word()} {'[('[k]}dot{'])'[k]} com", ("mail ", "contact: ", "")),
        ("phone", lambda: rng.choice((f"({num(3, 2)}) {num(3, 2)}-{num(4)}", f"0{num(3, 1)} {num(3)} {num(4)}", f"{num(3, 2)}-{num(3, 2)}-{num(4)}")), ("tel ", "call ", "phone: ", "")),
        ("card", card, ("card ", "visa: ", "")),
        ("ip", lambda: "[.]".join(str(rng.randint(1, 255)) for _ in range(4)), ("from ", "host ", "")),
    )
    bad = (
        ("phone", lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", ("on ", "")),
        ("phone", lambda: f"{rng.randint(10, 28)}.{rng.randint(10, 12)}.{rng.randint(1900, 2030)}", ("am ", "")),
        ("phone", lambda: f"{num(2)} {num(2)} {num(2)}", ("", "numbers ")),
        ("phone", lambda: f"{num(4)}-{num(4)}", ("pages ", "ISBN ")),
        ("card", lambda: " ".join(num(4) for _ in range(3)), ("", "table ")),
        ("ip", lambda: ". ".join(num(2) for _ in range(4)), ("steps ", "")),
        ("ip", lambda: ".".join((num(1), num(2), num(3, 3), num(3, 3))), ("version ", "v")),
    )
    out = []
    for i in range(n):
        kind, form, cues = rng.choice(good if i % 2 else bad)
        before = f"{word()} {rng.choice(cues)}"
        s = form()
        out.append((f"{before}{s} {word()}", (len(before), len(before) + len(s), kind), i % 2))
    return out


def labelled(text: str) -> list[tuple[Span, int]]:
    """Spans that a base rule accepts (1), and those refused (0) that don't lie inside an accepted one."""
    ok, bad = base_spans(text)
    by_start = sorted(ok)
    starts, reach = [s[0] for s in by_start], list(accumulate((s[1] for s in by_start), max))
    out = [(s, 1) for s in ok]
    for s in bad:
        i = bisect_right(starts, s[0])
        if not i or reach[i - 1] < s[1]:
            out.append((s, 0))
    return out


def calibrates(text: str) -> bool:
    """Does the text belong to the third that calibrates thresholds?"""
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % 3 == 2


def candidate_counts(texts) -> Counter:
    """How often each ``(features, label, calibrates)`` occurs."""
    seen: Counter = Counter()
    for t in texts:
        held = calibrates(t)
        for s, y in labelled(t):
            seen[tuple(map(float, features(t, s))), y, held] += 1
    return seen


def made_up_counts(n: int) -> Counter:
    return Counter((tuple(map(float, features(t, s))), y, i // 2 % 3 == 2) for i, (t, s, y) in enumerate(made_up(n)))


def score_counts(trees: BoostedTrees, codes: np.ndarray, kind: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``kind, place of the score on the grid``: candidates and positive ones."""
    out = np.zeros((len(KINDS), len(_GRID), 2))
    at = np.searchsorted(_GRID, trees.predict_codes(codes), "right") - 1
    np.add.at(out, (kind, at), np.stack((n, n * y), axis=1))
    return out


def thresholds(counts: np.ndarray, precision: float = PRECISION) -> dict[str, float]:
    """By kind the least score on the grid (0.5 at least) from which so many candidates are positive."""
    out = {}
    for k, c in zip(KINDS, counts):
        n, good = np.cumsum(c[::-1], axis=0).T
        at = np.flatnonzero((c[::-1, 0] > 0) & (good >= precision * n))
        # a kind without a threshold of that precision adds nothing
        out[k] = max(0.5, float(_GRID[::-1][at.max()])) if len(at) else 2.0
    return out


def _arrays(counts: Counter):
    x, y, held = zip(*counts)
    return np.array(x, float), np.array(y, float), np.array(held, bool), np.array(list(counts.values()), float)


def train(texts: list[str], precision: float = PRECISION, n_made_up: int = 2000) -> PiiModel:
    """Fit on two thirds of the labelled candidates, calibrate on the rest."""
    x, y, held, n = _arrays(made_up_counts(n_made_up) + candidate_counts(texts))
    trees, fit = BoostedTrees(), ~held
    trees.cuts = trees.cut(np.repeat(x[fit], n[fit].astype(int), axis=0))
    codes = trees.encode(x)
    trees.grow(lambda *at: histogram(codes[fit], y[fit], n[fit], trees.bins, *at), (y * n)[fit].sum() / n[fit].sum())
    return PiiModel(trees, thresholds(score_counts(trees, codes[held], x[held, 0].astype(int), y[held], n[held]), precision))


# ------------------------------------------------------------ Spark


def _batch_arrays(batch):
    codes = np.frombuffer(b"".join(batch.column("c").to_pylist()), np.uint8)
    k, y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "y", "n"))
    return codes.reshape(batch.num_rows, -1), k, y.astype(float), n.astype(float)


def _summed(rows: DataFrame, sums) -> np.ndarray:
    """The sum of ``sums(codes, kind, y, n)`` over all rows; every task sends one array of the same size."""

    def run(batches):
        import pyarrow as pa

        out = None
        for batch in batches:
            if batch.num_rows:
                own = sums(*_batch_arrays(batch))
                out = own if out is None else out + own
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary()), pa.array([list(out.shape)], pa.list_(pa.int64()))], ["s", "shape"])

    parts = rows.mapInArrow(lean(run), "s binary, shape array<long>").collect()
    return sum(np.frombuffer(r["s"], np.float64).reshape(r["shape"]) for r in parts)


def train_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", local_rows: int = LOCAL_ROWS) -> PiiModel:
    """A model from the labelled candidates of every document; up to ``local_rows`` distinct ones (binned) come to the driver."""
    d = id_text(docs, id_col, text_col).where(F.col("__text").rlike("[0-9@]")).select("__text")
    schema = "x array<double>, y int, held boolean, n long"

    def found(batches):
        import pyarrow as pa

        for batch in batches:
            seen = candidate_counts(batch.column(0).to_pylist())
            x, y, held = ([k[i] for k in seen] for i in range(3))
            cols = [pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32()), pa.array(held, pa.bool_()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["x", "y", "held", "n"])

    more = docs.sparkSession.createDataFrame([(list(x), y, held, n) for (x, y, held), n in made_up_counts(2000).items()], schema)
    rows = d.mapInArrow(lean(found), schema).unionByName(more).groupBy("x", "y", "held").agg(F.sum("n").alias("n"))
    rows = written(rows, "pii-candidates")

    trees, size = BoostedTrees(), len(more.first()["x"])
    places = np.linspace(0, 1, trees.bins)[1:-1].tolist()
    fit = rows.where(~F.col("held"))
    at = fit.agg(*[F.percentile(F.col("x")[f], places, F.col("n")).alias(f"x{f}") for f in range(size)], (F.sum(F.col("n") * F.col("y")) / F.sum("n")).alias("share")).first()
    trees.cuts = [np.unique(at[f"x{f}"]) for f in range(size)]

    def coded(batches):
        import pyarrow as pa

        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, size)
            c = pa.array([r.tobytes() for r in trees.encode(x)], pa.binary())
            cols = [c, pa.array(x[:, 0].astype(np.int32)), batch.column("y"), batch.column("held"), batch.column("n")]
            yield pa.RecordBatch.from_arrays(cols, ["c", "k", "y", "held", "n"])

    codes = rows.mapInArrow(lean(coded), "c binary, k int, y int, held boolean, n long").groupBy("c", "k", "y", "held").agg(F.sum("n").alias("n"))
    codes = written(codes, "pii-codes")
    if codes.count() <= local_rows:
        own = codes.toArrow().combine_chunks().to_batches()[0]
        held = own.column("held")
        parts = {h: _batch_arrays(own.filter(held if h else _negated(held))) for h in (True, False)}

        def summed(h, sums):
            return sums(*parts[h])
    else:

        def summed(h, sums):
            return _summed(codes.where(F.col("held") == h), sums)

    def histograms(grown, bias, split):
        bins = trees.bins
        return summed(False, lambda c, k, y, n: histogram(c, y, n, bins, grown, bias, split))

    trees.grow(histograms, at["share"])
    return PiiModel(trees, thresholds(summed(True, lambda c, k, y, n: score_counts(trees, c, k, y, n))))


def _negated(mask):
    import pyarrow.compute as pc

    return pc.invert(mask)


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string"


def scan(text: str | None, model: PiiModel) -> tuple[list[Span], list[Span]]:
    base, _ = base_spans(text or "")
    return base, model.extra(text or "", base)


def find_pii(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, base counts, base spans and all spans, a row for each document."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                base, extra = scan(text, model)
                for i, k in enumerate(KINDS):
                    cols[i].append(sum(s[2] == k for s in base))
                cols[4].append(span_text(base, KINDS))
                cols[5].append(span_text(base + extra, KINDS))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"],
            )

    d = id_text(docs, id_col, text_col)
    return d.mapInArrow(lean(run), f"doc_id {d.schema['__id'].dataType.simpleString()}, {_FOUND}")


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span (overlapping ones as one) replaced by its kind."""
    if text is None or not spans:
        return text
    out, at, joined = [], 0, []
    for a, b, k in sorted(spans, key=lambda s: (s[0], -s[1])):
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b, k])
    for a, b, k in joined:
        out += [text[at:a], f"[{k.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and every found span of ``text_col`` replaced."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [redact(t, sum(scan(t, model), [])) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(lean(run), docs.schema)


def op4_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    found = find_pii(docs, train_pii(docs))
    return found.withColumn("base_sha256", F.sha2(F.col("base_spans"), 256)).drop("base_spans")

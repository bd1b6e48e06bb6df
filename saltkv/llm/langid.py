"""Operator 3: language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior over the trained languages and ``und``
(none of them):

* text: log-likelihood of the byte trigrams of the whole text, as a mean per
  trigram times ``min(trigrams, TEXT_WEIGHT)`` (neighbouring trigrams aren't
  independent, so a long text doesn't outvote all else without bound);
* the language that markup declares, through a confusion table;
* the suffix of the address (``fr`` of ``x.example.fr``), through its counts by language;
* the host's prior: language counts of the host, smoothed towards those of its
  domain, smoothed towards those of all rows.

Tables and priors come from grouped aggregation over *all* rows of text posteriors
in whole millionths (so that no order of addition can change a digit).

Scale.  One map pass in Arrow batches scores the texts (no text is shuffled); what is
aggregated and joined are rows of about 100 bytes.  Sums combine before the shuffle, and the host
priors are copied ``SALTS`` times for the join, so a host that holds a third of all
rows is spread over as many tasks.

Defined cases.  A null, empty or letterless text has a flat likelihood: priors and other evidence
decide, and with no other evidence it is ``und``.  A null host is the host ``''``; a declared
language that isn't trained is ``other``.  Repeated ids are scored row by row; an exact tie goes
to the first language in alphabetical order, ``und`` last.  An empty table gives an empty result.
Extra columns are ignored; ``keep_identified`` keeps them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, ship_package, table, written

UND = "und"
#: Labelled texts of each label (the first by hash) that train the text model.
TRAIN_DOCS = 500
TEXT_WEIGHT = 200
#: Pseudo-counts with which a domain smooths its hosts, and all rows the domains.
HOST_KAPPA, DOMAIN_KAPPA = 20.0, 20.0
SALTS = 16
_UNIT = 1_000_000
_BUCKETS = 1 << 16
_PIECE = 1 << 18  # bytes scored at once: their tables take about 100 times that


# ------------------------------------------------------------ byte trigrams


def _fold(b: np.ndarray) -> np.ndarray:
    """Lower case (ASCII and Latin-1 letters in UTF-8); other ASCII becomes a space."""
    b = b.copy()
    upper = (b >= 65) & (b <= 90)
    b[upper] += 32
    b[(b < 97) | ((b > 122) & (b < 128))] = 32
    second = np.zeros(len(b), bool)
    second[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
    b[second] += 32
    return b


def _trigrams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram that starts at each byte, and whether it counts: it
    lies in one text and has at most one space in a row."""
    b = _fold(data).astype(np.uint32)
    n = len(b)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    space = b == 32
    ok = ~((space[:-2] & space[1:-1]) | (space[1:-1] & space[2:]))
    for k in (1, 2):
        at = ends - k
        ok[at[(at >= 0) & (at < n - 2)]] = False
    return (h >> np.uint32(16)).astype(np.int64), ok


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """``(first text, data, offsets)`` of about ``_PIECE`` bytes; a longer text comes
    in several pieces that overlap by two bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _PIECE, "right")) - 1)
        a, b = int(offsets[i]), int(offsets[j])
        if j == i + 1 and b - a > _PIECE:
            for x in range(a, b - 2, _PIECE):
                y = min(b, x + _PIECE + 2)
                yield i, data[x:y], np.array([0, y - x])
        else:
            yield i, data[a:b], offsets[i : j + 1] - a
        i = j


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column (nulls are empty)."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    raw = column.buffers()
    if not len(column) or raw[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class TextModel:
    """Trigram log-probabilities by language, and the level of ``und``."""

    def __init__(self, langs: list[str], logp: np.ndarray, und: float):
        self.langs, self.logp, self.und = langs, logp, und

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counted trigrams and log-likelihoods of each text."""
        n = np.zeros(len(offsets) - 1, np.int64)
        ll = np.zeros((len(offsets) - 1, len(self.langs)))
        for first, d, off in _pieces(data, offsets):
            h, ok = _trigrams(d, off[1:])
            if not len(h):
                continue
            w = self.logp[h] * ok[:, None]
            some = np.flatnonzero(np.minimum(off[1:], len(h)) > np.minimum(off[:-1], len(h)))
            start = off[:-1][some]
            ll[first + some] += np.add.reduceat(w, start, axis=0, dtype=np.float64)
            n[first + some] += np.add.reduceat(ok.astype(np.int64), start)
        return n, ll


def training_rows(docs: DataFrame, per_label: int = TRAIN_DOCS, text_col="text", lang_col="lang") -> DataFrame:
    """``l, t``: of every label that occurs in the table about ``per_label`` rows (all, if it has fewer), those with the
    smallest hash of their text.  Limits are found on hashes alone."""
    d = docs.select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).cast("string").alias("t")).where("t is not null and l is not null")
    d = d.withColumn("h", F.xxhash64("t"))
    first = Window.partitionBy("l").orderBy("h")
    # of copies one counts, and one is taken: a group of copies can't fill the sample
    last = d.select("l", "h").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_label).groupBy("l").agg(F.max("h").alias("last"))
    return d.join(F.broadcast(last), "l").where(F.col("h") <= F.col("last")).dropDuplicates(["l", "h"]).select("l", "t")  # a row for each label


def train_text_model(docs: DataFrame, per_label: int = TRAIN_DOCS, id_col="doc_id", text_col="text", lang_col="lang") -> TextModel:
    """The label set is that of all rows; each label's trigrams are counted on executors over its ``training_rows``.
    The driver gets numbers only: a count for each label and trigram bucket, and a level for each training row."""
    spark = docs.sparkSession
    rows = written(training_rows(docs, per_label, text_col, lang_col), "language-samples")

    def counted(batches):
        import pyarrow as pa

        per: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("l").to_pylist(), batch.column("t")):
                d = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                h, ok = _trigrams(d, np.array([len(d)]))
                own = per.setdefault(lang, np.zeros(_BUCKETS, np.int64))
                own += np.bincount(h[ok], minlength=_BUCKETS)
        for lang, own in per.items():
            b = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(b), pa.string()), pa.array(b.astype(np.int32)), pa.array(own[b])], ["l", "b", "n"])

    langs = sorted(r.l for r in rows.select("l").distinct().collect())
    at = {lang: k for k, lang in enumerate(langs)}
    counts = np.zeros((len(langs), _BUCKETS))
    got = rows.mapInArrow(lean(counted), "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()
    label = got.column("l").combine_chunks().dictionary_encode()
    rank = np.array([at[x] for x in label.dictionary.to_pylist()], np.int64)
    counts[rank[label.indices.to_numpy()], got.column("b").to_numpy()] = got.column("n").to_numpy()
    logp = np.log((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * _BUCKETS)).astype(np.float32).T
    logp = np.ascontiguousarray(logp)
    shared = spark.sparkContext.broadcast((at, logp))

    def levels(batches):
        import pyarrow as pa

        at, logp = shared.value
        for batch in batches:
            own = []
            for lang, text in zip(batch.column("l").to_pylist(), batch.column("t")):
                d = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                h, ok = _trigrams(d, np.array([len(d)]))
                if ok.any():
                    own.append(float(logp[h[ok], at[lang]].mean()))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.float64())], ["x"])

    own = rows.mapInArrow(lean(levels), "x double").toArrow().column("x").to_numpy() if langs else np.empty(0)
    shared.destroy()
    # "none of them" lies one unit a trigram below what the least likely labelled texts reach
    return TextModel(langs, logp, float(np.quantile(own, 0.005)) - 1.0 if len(own) else 0.0)


# ------------------------------------------------------------ evidence


def host_domain(host: Column) -> Column:
    """The last two labels of a host (the host itself if it has fewer)."""
    return F.substring_index(host, ".", -2)


def host_suffix(host: Column) -> Column:
    """The last label of a dotted host that isn't a number, else ``''``."""
    last = F.substring_index(host, ".", -1)
    return F.when(host.contains(".") & ~last.rlike("^[0-9]*$"), last).otherwise("")


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows`` (id, text, host, declared) without the text, with its trigram
    count ``n`` and log-likelihoods ``ll``."""
    at = rows.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, ll = model.score(*text_bytes(batch.column(at)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * ll.shape[1], pa.int32()), pa.array(ll.ravel()))
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(n), flat], [*(batch.schema.names[i] for i in keep), "n", "ll"])

    out = rows.drop("text").withColumn("n", F.lit(0).cast("long")).withColumn("ll", F.array(F.lit(0.0)))
    return rows.mapInArrow(lean(run), out.schema)


def with_softmax(df: DataFrame, logs: str, name: str) -> DataFrame:
    """``df`` with the softmax of the array ``logs``.  Languages are elements of arrays, not columns: a plan with an expression for
    each pair of them takes hundreds of MB on the driver."""
    df = df.withColumn("__exps", F.transform(logs, lambda x: F.exp(x - F.array_max(logs))))
    total = F.aggregate("__exps", F.lit(0.0), lambda a, x: a + x)
    return df.withColumn(name, F.transform("__exps", lambda x: x / total)).drop("__exps")


def _literals(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows``: ``id, text, host, declared``.  Returns ``id, lang, confidence,
    text_lang, declared, n_trigrams`` and the posterior of each language."""
    names = [*model.langs, UND]
    if not model.langs:  # nothing to train on: nothing can be identified
        nothing = F.lit(None).cast("string")
        return rows.select("id", F.lit(UND).alias("lang"), F.lit(1.0).alias("confidence"), F.lit(UND).alias("text_lang"),
                           nothing.alias("declared"), F.lit(0).cast("long").alias("n_trigrams"), F.array(F.lit(1.0)).alias("posterior"))
    rows = rows.withColumn("host", F.coalesce(F.lower("host"), F.lit("")))
    said = F.lower(F.regexp_extract(F.coalesce("declared", F.lit("")), "^([A-Za-z]+)", 1))
    rows = rows.withColumn("declared", F.when(said != "", F.when(said.isin(model.langs), said).otherwise("other")))
    e = text_evidence(rows, model)
    e = e.withColumns({"domain": host_domain(F.col("host")), "suffix": host_suffix(F.col("host"))})
    scale = F.when(F.col("n") > 0, F.least("n", F.lit(TEXT_WEIGHT)) / F.col("n")).otherwise(0.0)
    text = F.transform("ll", lambda x: x * scale)
    # no counted trigram: every language as likely as any other
    und = F.when(F.col("n") > 0, F.lit(model.und) * F.least("n", F.lit(TEXT_WEIGHT))).otherwise(0.0)
    e = with_softmax(e.withColumn("text_log", F.concat(text, F.array(und))), "text_log", "soft")
    e = written(e.withColumn("soft", F.transform("soft", lambda p: F.round(p * _UNIT).cast("long"))).drop("ll"), "language-evidence")

    sums = [F.sum(F.col("soft")[i]).alias(f"c{i}") for i in range(len(names))]
    add = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(names))]
    evident = e.where("n > 0")  # a letterless text says nothing about its host
    hosts = written(evident.groupBy("host", "domain", "suffix", "declared").agg(*sums), "language-hosts")
    # three tables whose size is bounded by the languages, not the rows
    total = hosts.agg(*add).first()
    every = np.array([c or 0 for c in total], float)
    base = (every + _UNIT) / (every + _UNIT).sum()
    confusion = {r.declared: np.array(r[1:], float) for r in hosts.where("declared is not null").groupBy("declared").agg(*add).collect()}

    def smoothed(parent, kappa):  # counts in c0.., towards the parent's shares
        n = sum((F.col(f"c{i}") for i in range(1, len(names))), F.col("c0"))
        return [(F.col(f"c{i}") + kappa * _UNIT * p) / (n + kappa * _UNIT) for i, p in enumerate(parent)]

    domains = hosts.groupBy("domain").agg(*add)
    domains = domains.select("domain", F.array(*smoothed([F.lit(float(x)) for x in base], DOMAIN_KAPPA)).alias("up"))
    prior = hosts.groupBy("host", "domain").agg(*add).join(domains, "domain")
    prior = prior.select("host", F.array(*smoothed([F.col("up")[i] for i in range(len(names))], HOST_KAPPA)).alias("prior"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    by_suffix = hosts.where("suffix != ''").groupBy("suffix").agg(*add)
    # share of each language's rows under the suffix, smoothed by one row at the suffix's own share
    own = sum((F.col(f"c{i}") for i in range(1, len(names))), F.col("c0"))
    share = own / float(every.sum() or 1)
    by_suffix = by_suffix.select("suffix", F.array(*[F.log((F.col(f"c{i}") + _UNIT * share) / float(every[i] + _UNIT)) for i in range(len(names))]).alias("at_suffix"), salts)

    e = e.withColumn("salt", F.pmod(F.xxhash64("id", "n"), F.lit(SALTS)))
    e = e.join(prior.select("host", "prior", salts), ["host", "salt"], "left").join(by_suffix, ["suffix", "salt"], "left")
    seen = sum(confusion.values(), np.zeros(len(names)))
    said = _literals([0.0] * len(names))
    for d in (*model.langs, "other"):
        own = confusion.get(d, np.zeros(len(names)))
        # one made-up row that agrees (or, for "other", is spread) for each language
        one = [0.9 if d == name else 0.1 / len(names) for name in names]
        said = F.when(F.col("declared") == d, _literals(np.log((own[i] + _UNIT * one[i]) / (seen[i] + _UNIT)) for i in range(len(names)))).otherwise(said)
    logs = F.zip_with("text_log", F.coalesce("prior", _literals(base)), lambda t, p: t + F.log(p))
    logs = F.zip_with(logs, F.coalesce("at_suffix", _literals([0.0] * len(names))), lambda t, x: t + x)
    e = with_softmax(e.withColumn("logs", F.zip_with(logs, said, lambda t, x: t + x)), "logs", "posterior")
    label = F.array(*[F.lit(x) for x in names])

    def best(a):  # array_position finds the first of equals
        return F.element_at(label, F.array_position(a, F.array_max(a)).cast("int"))

    nothing = (F.col("n") == 0) & F.col("declared").isNull() & (F.col("suffix") == "")
    return e.select(
        "id", F.when(nothing, UND).otherwise(best(F.col("posterior"))).alias("lang"),
        F.when(nothing, 1.0).otherwise(F.array_max("posterior")).alias("confidence"),
        F.when(F.col("n") == 0, UND).otherwise(best(F.col("text_log"))).alias("text_lang"), "declared",
        F.col("n").alias("n_trigrams"), "posterior",
    )


# ------------------------------------------------------------ tables


def document_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents as evidence: ``source`` is the host, markup may declare a language
    (the label column ``lang`` is training data, never evidence)."""
    declared = F.regexp_extract("text", r"(?i)<html[^<>]*\slang=[\"']?([A-Za-z]+)", 1)
    return docs.select(F.col(id_col).alias("id"), "text", F.col("source").alias("host"), F.nullif(declared, F.lit("")).alias("declared"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages as evidence: tags, scripts and styles are no text."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]{1,8};", " ")
    declared = F.regexp_extract("html", r"(?i)<html[^<>]*\slang=[\"']?([A-Za-z]+)", 1)
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.select(F.col("page_id").alias("id"), bare.alias("text"), host.alias("host"), F.nullif(declared, F.lit("")).alias("declared"))


def keep_identified(docs: DataFrame, model: TextModel, least: float = 0.5) -> DataFrame:
    """``docs``, all columns, without those whose language is ``und`` or less
    sure than ``least``.  Every row goes by its own verdict: it is joined by a 128-bit hash of id, text and source, so a
    null doc_id or one that rows share matters to no other row."""
    part = [F.hex(F.xxhash64("doc_id", "text", "source", F.lit(k))) for k in (0, 1)]
    marked = docs.withColumn("__row", F.concat(part[0], F.lit("-"), part[1]))
    verdict = identify(document_rows(marked, "__row"), model)
    gone = verdict.where((F.col("lang") == UND) | (F.col("confidence") < least)).select(F.col("id").alias("__row")).distinct()
    # equal rows share a hash: any deal over the copies of the verdicts does
    gone = gone.select("__row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("__deal"))
    marked = marked.withColumn("__deal", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    return marked.join(gone, ["__row", "__deal"], "left_anti").select(*docs.columns)


def op3_language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, lang, confidence, text_lang, declared, n_trigrams, posterior``."""
    return identify(document_rows(docs), train_text_model(docs)).withColumnRenamed("id", "doc_id")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on web pages, with the text model of the documents."""
    model = train_text_model(table(spark, sf_dir, "documents"))
    return identify(page_rows(table(spark, sf_dir, "pages")), model).withColumnRenamed("id", "page_id")

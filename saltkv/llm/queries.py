"""Registered queries of the pipeline operators and their DuckDB oracles."""

from __future__ import annotations

from .common import table


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def q_op6(spark, sf_dir):
    from .tokenbin import op6_token_binary

    return op6_token_binary(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def q_op10(spark, sf_dir):
    from .warc import op10_warc_captures

    return op10_warc_captures(spark, table(spark, sf_dir, "pages"))


def q_op4(spark, sf_dir):
    from .pii import op4_pii

    return op4_pii(spark, table(spark, sf_dir, "documents"))


def q_op5(spark, sf_dir):
    from .spm import op5_sentencepiece

    return op5_sentencepiece(spark, table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def q_op3(spark, sf_dir):
    from .langid import op3_language_id

    return op3_language_id(spark, table(spark, sf_dir, "documents"))


def q_language_id_pages(spark, sf_dir):
    from .langid import language_id_pages

    return language_id_pages(spark, sf_dir)


def q_op1(spark, sf_dir):
    from .ngram_join import op1_ngram_jaccard

    return op1_ngram_jaccard(spark, table(spark, sf_dir, "documents"))


def q_op2(spark, sf_dir):
    from .e8_dedup import op2_embedding_dedup

    return op2_embedding_dedup(spark, table(spark, sf_dir, "embeddings"))


def q_op7(spark, sf_dir):
    from .decontam import op7_decontamination

    return op7_decontamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_op8(spark, sf_dir):
    from .secrets import op8_secrets

    return op8_secrets(spark, table(spark, sf_dir, "documents"))


def q_op9(spark, sf_dir):
    from .toxicity import op9_toxicity

    return op9_toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_op11(spark, sf_dir):
    from .vp_clusters import op11_centroid_clusters

    return op11_centroid_clusters(spark, table(spark, sf_dir, "embeddings"))


def q_op12(spark, sf_dir):
    from .partition_ann import op12_learned_partitions

    return op12_learned_partitions(spark, table(spark, sf_dir, "embeddings"))


def q_op13(spark, sf_dir):
    from .collocations import op13_collocations

    return op13_collocations(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    "op11_centroid_clusters": q_op11,
    "op12_learned_partitions": q_op12,
    "op13_collocations": q_op13,
    "op9_toxicity": q_op9,
    "op8_secrets": q_op8,
    "op7_decontamination": q_op7,
    "op2_embedding_dedup": q_op2,
    "op1_ngram_jaccard": q_op1,
    "op3_language_id": q_op3,
    "language_id_pages": q_language_id_pages,
    "op4_pii": q_op4,
    "op5_sentencepiece": q_op5,
    "op10_warc_captures": q_op10,
    "op6_token_binary": q_op6,
}

_OP10 = """
WITH p AS (SELECT page_id, coalesce(url, 'urn:none') AS target_uri, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, target_uri, strlen(h) AS payload_bytes, sha1(h) AS hx, max(page_id) OVER (PARTITION BY h) AS top,
  row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, target_uri DESC) AS nth FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hx, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nth = 1 THEN NULL ELSE top END AS refers_to, target_uri
FROM d
"""



def _op11(k: int = 16, rounds: int = 3) -> str:
    """Clustering in integers: components as rows, a pair of steps for each round."""
    def nearest(n):
        return f"""
d{n} AS (SELECT r.rid, c.c, sum((r.x - c.x) * (r.x - c.x)) AS d FROM v r JOIN c{n} c USING (i) GROUP BY ALL),
a{n} AS (SELECT rid, min(struct_pack(d := d, c := c)) AS b FROM d{n} GROUP BY rid)"""

    def moved(n):
        return f"""
m{n} AS (SELECT a.b.c AS c, v.i, CAST(sum(v.x) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{n - 1} a JOIN v USING (rid) GROUP BY ALL),
c{n} AS (SELECT c.c, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE CAST((m.s - (((m.s % m.n) + m.n) % m.n)) // m.n AS BIGINT) END AS x
  FROM c{n - 1} c LEFT JOIN m{n} m USING (c, i))"""

    steps = [nearest(0)]
    for n in range(1, rounds + 1):
        steps += [moved(n), nearest(n)]
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) AS rid, vec_id, x
  FROM (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)),
v AS (SELECT rid, unnest(range(1, 65)) AS i, unnest(x) AS x FROM kept),
c0 AS (SELECT rid - 1 AS c, i, x FROM v WHERE rid <= {k}),
{",".join(steps)},
sha AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c),
o AS (SELECT k.vec_id, CAST(a.b.c AS INTEGER) AS cluster, CAST(a.b.d AS BIGINT) AS distance FROM a{rounds} a JOIN kept k USING (rid))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM o JOIN sha ON sha.c = o.cluster
"""


_OP13 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(t, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
h AS (SELECT lang, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase FROM g, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(ws)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM h GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND a >= 30),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r, CAST(2000000 * CAST(k.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score FROM k
  JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(list_slice(k.ws, 1, k.k), ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(list_slice(k.ws, k.k + 1, k.m), ' ')),
b AS (SELECT lang, phrase, a, min(struct_pack(score := score, k := k, l := l, r := r)) AS c FROM s GROUP BY ALL),
u AS (SELECT lang, a, ws, m, unnest(range(1, m)) AS i FROM c WHERE m >= 3),
v AS (SELECT lang, a, ws, m, i, unnest(range(2, m)) AS j FROM u),
held AS (SELECT lang, array_to_string(list_slice(ws, i, i + j - 1), ' ') AS phrase, max(a) AS longer FROM v WHERE i + j - 1 <= m GROUP BY ALL),
o AS (SELECT b.* FROM b LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * b.a),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY c.score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, c.l AS l, c.r AS r, n, c.score AS score FROM q JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op13_collocations": _OP13, "op10_warc_captures": _OP10, "op11_centroid_clusters": _op11()}

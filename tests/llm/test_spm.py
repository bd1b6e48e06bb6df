"""Operator 5 against the sentencepiece library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from saltkv.llm import spm

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return spm.PieceCodec(PATH)


def texts(n, seed=1):
    rng = random.Random(seed)
    pool = [*"abc .,\n\t\r  éß漢😀▁\x00́ ", "<s>", "</s>", "<unk>", "<0x0A>", "the ", "  ", "▁▁", "\n\n", " \n"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_model_fields(codec, sp):
    m = codec.model
    assert len(m.pieces) == sp.get_piece_size() and m.byte_fallback and m.dummy_prefix and not m.squeeze
    assert [p for p, _, _ in m.pieces] == [sp.id_to_piece(i) for i in range(len(m.pieces))]
    assert [s for _, s, _ in m.pieces] == pytest.approx([sp.get_score(i) for i in range(len(m.pieces))])


def test_random_texts(codec, sp):
    assert codec.cuts
    t = texts(4000)
    ids = codec.encode(t)
    assert [np.frombuffer(x, codec.dtype).tolist() for x in ids] == sp.encode(t)
    assert codec.decode(ids) == [x.replace("▁", " ") for x in t]


def test_any_ids_decode_as_the_library_does(codec):
    rng = random.Random(6)
    rows = [[rng.choice((rng.randrange(32_000), rng.randrange(3, 259), 28705)) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    got = codec.decode([np.array(r, codec.dtype).tobytes() for r in rows])
    assert got == codec.tok.decode_batch(rows, skip_special_tokens=False)


def test_a_full_cache_and_small_chunks(sp, monkeypatch):
    monkeypatch.setattr(spm, "CACHE_UNITS", 20)
    monkeypatch.setattr(spm, "CHUNK_CHARS", 50)
    c, t = spm.PieceCodec(PATH), texts(500, 2)
    assert [np.frombuffer(x, c.dtype).tolist() for x in c.encode(t)] == sp.encode(t)


def test_whole_text_path(codec, sp):
    t = ["the cat", "", "é漢\n x"]
    assert [e.ids for e in codec.tok.encode_batch(t, add_special_tokens=False)] == sp.encode(t)


def unigram_model(**norm) -> bytes:
    """A small unigram model in the wire format, written by hand."""
    def msg(n, body):
        assert len(body) < 128 * 128
        size = bytes([len(body)]) if len(body) < 128 else bytes([len(body) & 127 | 128, len(body) >> 7])
        return bytes([n << 3 | 2]) + size + body

    import struct

    def piece(p, score, kind):
        return msg(1, msg(1, p.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))

    out = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    out += b"".join(piece(f"<0x{i:02X}>", 0, 6) for i in range(256))
    for i, p in enumerate(["▁", "a", "b", "c", "ab", "▁a", "▁ab", "bc", "abc", "ca"]):
        out += piece(p, -1.0 - (0.37 * i) % 2, 1)
    trainer = bytes([3 << 3, 1]) + b"\x98\x02\x01"  # unigram; byte_fallback
    return out + msg(2, trainer) + msg(3, b"".join(bytes([k << 3, v]) for k, v in norm.items()) if norm else b"\x18\x01\x20\x00")


def test_a_unigram_model_is_rebuilt_from_scores():
    raw = unigram_model()
    m = spm.parse_model(raw)
    assert (m.kind, m.byte_fallback) == (spm.UNIGRAM, True)
    c = spm.PieceCodec("", raw=raw)  # verifies each text against the library
    t = ["abc", "a b c", "cab abcabc", "  aa  bb", "bca", "x", "aéc", ""]
    ids = [np.frombuffer(x, c.dtype).tolist() for x in c.encode(t)]
    assert ids == c.sp.encode(t)
    assert c.decode([np.array(x, c.dtype).tobytes() for x in ids]) == t


def test_columns_are_kept_and_edges(spark, sp):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (3, "", "y"), (4, "w" * 40_000 + "\n", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded_x string")
    enc = spm.encode_pieces(df, PATH)
    got = spm.decode_pieces(enc, PATH).orderBy("doc_id").collect()
    assert [tuple(r)[:3] for r in got] == rows and [r.decoded for r in got] == [t for _, t, _ in rows]
    assert [None if r.ids is None else np.frombuffer(r.ids, "<u2").tolist() for r in got] == [None if t is None else sp.encode(t) for _, t, _ in rows]
    assert spm.encode_pieces(df.limit(0), PATH).count() == 0


def test_the_documents_table(spark, sp):
    import duckdb

    from conftest import SF_MID
    from saltkv.llm.queries import q_op5

    rows = dict(duckdb.sql(f"select doc_id, text from '{SF_MID}/documents.parquet'").fetchall())
    got = q_op5(spark, SF_MID).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = sp.encode(rows[r.doc_id])
        assert (r.n_tokens, r.ids_crc32, r.decoded_chars) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(rows[r.doc_id]))
        assert r.round_trip


def test_other_operators_let_go(spark):
    """A reused worker drops the codec and its units before a task of another operator."""
    from pyspark.sql import functions as F

    from saltkv.llm import ngram_join
    from saltkv.llm.common import lean

    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of text "), "id").alias("text"))

    def codecs(batches):
        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(spm._CODECS)])], ["n"])

    def most(owner):
        return docs.coalesce(1).mapInArrow(lean(codecs, owner), "n long").agg(F.max("n")).first()[0]

    assert spm.op5_sentencepiece(spark, docs.coalesce(1), PATH).where("round_trip").count() == 40
    spm.codec(PATH)
    assert list(lean(lambda b: (len(spm._CODECS) for _ in b), "spm")(range(1))) == [1]
    assert list(lean(lambda b: (len(spm._CODECS) for _ in b))(range(1))) == [0]
    assert most(None) == 0
    assert ngram_join.keep_first_of_component(docs).count() == 40

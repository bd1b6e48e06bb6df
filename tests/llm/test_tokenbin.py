"""Operator 6 against a plain encoding, and its index against a dictionary."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from saltkv.llm.tokenbin import PerfectHash, WordEncoder, lookup_tokens, read_token_shards, write_token_shards
from saltkv.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_the_library():
    rng = random.Random(7)
    pool = list("abcXYZ019'.,-_ \t\n\x0b\x1c\x85\xa0     　éÉßΣςİ́̈한漢😀") + ["<|endoftext|>", "<|", "'s", "ll ", "\x01", " \x01 "]
    enc, tok = WordEncoder(PATH), Tokenizer.from_file(PATH)
    for letter in map(chr, range(0x250)):
        t = f"{letter} a{letter}B. {letter}{letter}, x{letter}.."
        assert np.frombuffer(enc.encode([t])[0], enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for t, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_word_encoder_with_a_full_cache(monkeypatch):
    monkeypatch.setattr("saltkv.llm.tokenbin.CACHE_WORDS", 5)
    monkeypatch.setattr("saltkv.llm.tokenbin.CHUNK_CHARS", 10)
    enc = WordEncoder(PATH)
    t = "one two three four five six seven one two"
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode([t, "six " + t, ""] * 3)] == [plain(t), plain("six " + t), []] * 3


def test_perfect_hash_is_minimal_and_survives_a_dump():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    mph = PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    again = PerfectHash.load([len(x) for x in mph.levels], mph.dump())
    assert (again.slots(keys) == mph.slots(keys)).all()
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(9, "nine"), (3, None), (-4, ""), (None, "no key"), (9, "again nine"), (70, "w" * 50_000 + " end"), (8, "tie"), (8, "tie")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as __id", "'x' as ids_crc32")
    out = scratch_path(spark, "shards")
    return rows, out, write_token_shards(df.repartition(3), out, PATH)


def test_edge_rows_come_back_in_order(spark, stored):
    rows, out, manifest = stored
    got = sorted(read_token_shards(spark, out).collect(), key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [plain(t) + [1] for _, t in want]
    assert [r.doc_id for r in got] == [k for k, _ in want]
    assert [r.n_tokens for r in got] == [len(x) for x in ids]
    assert [r.start for r in got] == [sum(map(len, ids[:i])) for i in range(len(ids))]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [r.found for r in got] == [k is not None for k, _ in want]


def test_keyed_reads(spark, stored):
    rows, out, _ = stored
    keys = spark.createDataFrame([(9,), (-4,), (70,), (71,), (-99,), (None,), (9,)], "doc_id long")
    got = {r.doc_id: r.ids for r in lookup_tokens(spark, out, keys).collect()}
    assert got == {9: plain("again nine") + [1], -4: [1], 70: plain(rows[5][1]) + [1]}


def test_empty_table(spark):
    out = scratch_path(spark, "shards")
    df = spark.createDataFrame([], "doc_id long, text string")
    assert write_token_shards(df, out, PATH).count() == 0
    assert read_token_shards(spark, out).count() == 0


def test_the_documents_table(spark):
    import duckdb

    from conftest import SF_SMALL
    from saltkv.llm.queries import q_op6

    at, want = 0, {}
    for key, text in duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet' order by doc_id").fetchall():
        ids = plain(text) + [1]
        want[key] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in q_op6(spark, SF_SMALL).collect()} == want

"""Operator 6: token-id shards with a minimal perfect hash index.

``write_token_shards`` encodes every whole text with a public ``tokenizers``
file and writes the ids, in ascending id order, into shard files.  Each shard
holds the raw ids of its documents back to back and, behind them, a minimal
perfect hash over its document keys: a key hashes to a slot, the slot stores a
fingerprint and the document's position, and the position gives the offset of
its ids.  A keyed read is one manifest look-up, one hash and one ranged read.

Scale.  One range shuffle by id (the order the format asks for); every task then
streams its rows into its own shard, holding the keys and offsets (20 bytes a
document) but never the ids.  A shard file has a name of its own for each task
attempt, and only the names that successful attempts return enter the manifest,
so a lost executor or a speculative copy leaves no trace in the result.

Defined cases.  A null text is empty and holds the end id alone.  A null key is
stored first and can be scanned but not looked up.  Rows that repeat a key are
all stored, ordered by text; the key's look-up gives the first.  A look-up of
an absent key finds nothing but for one chance in 2**32.  An empty table
gives an empty manifest.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saltkv.session import scratch_path

from .common import KnownWords, id_text, open_fs

MAGIC = b"SKTOKID1"
#: Words a worker keeps encoded (about 150 bytes each).  Beyond it new words are
#: encoded and forgotten, until as many were; then it starts anew.  Speed only.
CACHE_WORDS = 1 << 19
#: Characters whose words are looked up together.
CHUNK_CHARS = 1 << 19
_OTHER_SPACE = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_PLAIN_SPACE = re.compile(r"[ \t\r\n]+")


_TOUCHING = re.compile(r"[^\w\s][^\w\s]|_")


def _latin1(t: str) -> bool:
    if t.isascii():
        return True
    try:
        t.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids of a text whose tokenizer drops white space and never joins words:
    the ids of its words, one after the other, so repeated words are encoded once.

    New words go to the tokenizer in one string, held apart by a control
    character that has one id; words that hold it go alone.  Most words are
    letters that the normaliser only lower-cases, and perhaps a stop or comma, which
    is a word of its own to the tokenizer: their letters go to the same
    model behind a plainer set-up, which neither normalises nor matches patterns.
    """

    def __init__(self, path: str, separator: str = "\x01"):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tok, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.sep, (self.sep_id,) = separator, self.tok.encode(separator, add_special_tokens=False).ids
        byte = [pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(i))[0][0] for i in range(128)]
        self.bare_sep = byte[ord(separator)]
        self.letters = self._byte_letters()
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache = KnownWords()
        self.forgotten = 0

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """How the byte-level step spells each Latin letter, lower-cased."""
        from tokenizers import pre_tokenizers

        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {i: spell(c.lower())[0][0] for i in range(0x250) if (c := chr(i)).isalpha() and len(c.lower()) == 1 and unicodedata.is_normalized("NFC", c)}

    def _plain(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encode_apart(self, tok, sep: str, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        n = self.dtype.itemsize
        for i in range(0, len(words), 1000):
            part = words[i : i + 1000]
            ids = np.array(tok.encode(f" {sep} ".join(part), add_special_tokens=False).ids, self.dtype)
            cuts = np.flatnonzero(ids == self.sep_id)
            if len(cuts) != len(part) - 1:
                raise RuntimeError("the tokenizer joined words")
            raw = ids.tobytes()
            starts, ends = np.concatenate(([0], cuts + 1)) * n, np.concatenate((cuts, [len(ids)])) * n
            out += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        simple, other, out = {}, [], {}
        for w in words:
            stem = w if w[-1] not in ".," else w[:-1]
            if stem.isalpha() and (stem.isascii() or max(stem) < "\u0250" and "\u0130" not in stem):
                simple[w] = stem
            elif self.sep in w:
                out[w] = self._plain(w)
            else:
                other.append(w)
        out.update(zip(other, self._encode_apart(self.tok, self.sep, other)))
        stems = list(set(simple.values()))
        spelt = [x.lower() if x.isascii() else x.translate(self.letters) for x in stems]
        ids = dict(zip(stems, self._encode_apart(self.bare, self.bare_sep, spelt)))
        end = {c: self._plain(c) for c in ".,"}
        out.update((w, ids[x] if len(w) == len(x) else ids[x] + end[w[-1]]) for w, x in simple.items())
        return out

    def _encode_words(self, texts: list[list[str]]) -> list[bytes]:
        get = self.cache.__getitem__
        for words in texts:
            deque(map(get, words), 0)  # notes the words that the cache lacks
        new = self.cache.lacks
        if new:
            self.cache.lacks = {}
            self.cache.update(self._learn(list(new)))
        out = [b"".join(map(get, words)) for words in texts]
        if len(self.cache) > CACHE_WORDS:
            self.forgotten += len(new)
            for w in new:
                del self.cache[w]
            if self.forgotten > CACHE_WORDS:
                self.cache, self.forgotten = KnownWords(), 0
        return out

    @staticmethod
    def words(t: str) -> list[str]:
        """The text cut where the tokenizer cuts anyway, so that few words are
        distinct: at plain spaces and, in Latin-1 text whose symbols don't touch,
        before stops and commas.  Latin-1 text is lower-cased here (there Python's
        lower case is the tokenizer's)."""
        if _OTHER_SPACE.search(t):
            return list(filter(None, _PLAIN_SPACE.split(t)))
        if "<|" not in t and _latin1(t):
            t = t.lower()
            if not _TOUCHING.search(t):
                t = t.replace(",", " ,").replace(".", " .")
        return t.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian bytes of ``dtype``."""
        out: list[bytes] = []
        some: list[list[str]] = []
        size = 0
        for t in texts:
            some.append(self.words(t))
            size += len(t)
            if size >= CHUNK_CHARS:
                out += self._encode_words(some)
                some, size = [], 0
        return out + self._encode_words(some)


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------ minimal perfect hash


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash by cascaded bit arrays: a key settles at the first
    level where it is alone in its cell; its number is the rank of that bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # booleans
        self.base = np.cumsum([0] + [int(x.sum()) for x in levels])
        self.ranks = [np.cumsum(x) - 1 for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 1.5) -> PerfectHash:
        """``keys``: distinct 64-bit integers."""
        left, levels = keys.astype(np.int64).view(np.uint64), []
        while len(left):
            n = max(1, int(len(left) * gamma))
            cell = (_mix(left, len(levels)) % np.uint64(n)).astype(np.int64)
            alone = np.bincount(cell, minlength=n) == 1
            levels.append(alone)
            left = left[~alone[cell]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key outside the set gets any slot, or -1."""
        keys = np.asarray(keys, np.int64).view(np.uint64)
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            cell = (_mix(keys[todo], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[cell]
            out[todo[hit]] = self.base[k] + self.ranks[k][cell[hit]]
            todo = todo[~hit]
        return out

    def dump(self) -> bytes:
        return b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, sizes: list[int], raw: bytes) -> PerfectHash:
        out, at = [], 0
        for n in sizes:
            k = (n + 7) // 8
            out.append(np.unpackbits(np.frombuffer(raw, np.uint8, k, at), count=n).astype(bool))
            at += k
        return cls(out)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(np.asarray(keys, np.int64).view(np.uint64), 1000) >> np.uint64(32)).astype("<u4")


# ------------------------------------------------------------ shard files


class ShardWriter:
    """Streams documents into one shard; ``close`` adds the index and trailer."""

    def __init__(self, stream, dtype: np.dtype):
        self.f, self.dtype = stream, dtype
        self.keys, self.valid, self.counts = [], [], []
        self.f.write(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(0 if key is None else key)
        self.valid.append(key is not None)
        self.counts.append(len(ids) // self.dtype.itemsize)
        self.f.write(ids)

    def close(self) -> dict:
        keys, valid = np.array(self.keys, "<i8"), np.array(self.valid, bool)
        ends = np.cumsum(np.array(self.counts, "<u8"), dtype="<u8")
        own, first = np.unique(keys[valid], return_index=True)
        first = np.flatnonzero(valid)[first]
        mph = PerfectHash.build(own)
        slot = mph.slots(own)
        prints, place = np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4")
        prints[slot], place[slot] = fingerprint(own), first
        parts = {"keys": keys.tobytes(), "valid": np.packbits(valid).tobytes(), "ends": ends.tobytes(),
                 "mph": mph.dump(), "prints": prints.tobytes(), "place": place.tobytes()}
        head = {"dtype": self.dtype.str, "docs": len(keys), "keys": len(own), "levels": [len(x) for x in mph.levels],
                "parts": {k: len(v) for k, v in parts.items()}}
        raw = json.dumps(head).encode()
        for v in parts.values():
            self.f.write(v)
        self.f.write(raw + struct.pack("<QQ", sum(map(len, parts.values())), len(raw)) + MAGIC)
        self.f.close()
        return {"docs": len(keys), "tokens": int(ends[-1]) if len(ends) else 0}


class ShardReader:
    """Keyed and sequential access to one shard; ids are read by range."""

    def __init__(self, fs, path: str):
        self.f = fs.open_input_file(path)
        size = self.f.size()
        tail = self.f.read_at(24, size - 24)
        if tail[16:] != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        n, h = struct.unpack("<QQ", tail[:16])
        head = json.loads(self.f.read_at(h, size - 24 - h))
        raw, at, part = self.f.read_at(n, size - 24 - h - n), 0, {}
        for k, m in head["parts"].items():
            part[k], at = raw[at : at + m], at + m
        self.dtype = np.dtype(head["dtype"])
        self.keys = np.frombuffer(part["keys"], "<i8")
        self.valid = np.unpackbits(np.frombuffer(part["valid"], np.uint8), count=head["docs"]).astype(bool)
        self.ends = np.frombuffer(part["ends"], "<u8").astype(np.int64)
        self.mph = PerfectHash.load(head["levels"], part["mph"])
        self.prints, self.place = np.frombuffer(part["prints"], "<u4"), np.frombuffer(part["place"], "<u4")

    def ids(self, place: int) -> np.ndarray:
        a = int(self.ends[place - 1]) if place else 0
        n = self.dtype.itemsize
        return np.frombuffer(self.f.read_at((int(self.ends[place]) - a) * n, len(MAGIC) + a * n), self.dtype)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key's (first) document, -1 where its fingerprint is not stored."""
        keys = np.asarray(keys, np.int64)
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64)
        slot = self.mph.slots(keys)
        ok = (slot >= 0) & (self.prints[slot] == fingerprint(keys))
        return np.where(ok, self.place[slot].astype(np.int64), -1)


# ------------------------------------------------------------ Spark jobs

_MANIFEST = "shard int, path string, docs long, tokens long, min_key long, max_key long"


def write_token_shards(
    docs: DataFrame, out_dir: str, tokenizer: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode ``docs`` into shards below ``out_dir``; returns the manifest (a row
    for each shard: order, file, documents, ids, key range, ids before it)."""
    spark = docs.sparkSession

    def encoded(enc, batch, rows=500):
        for i in range(0, batch.num_rows, rows):
            part = batch.slice(i, rows)
            yield from zip(part.column(0).to_pylist(), enc.encode([t or "" for t in part.column(1).to_pylist()]))

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        enc, fs_path, out, lo, hi = encoder(tokenizer), None, None, None, None
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for key, ids in encoded(enc, batch):
                if out is None:
                    fs, root = open_fs(out_dir)
                    fs.create_dir(root, recursive=True)
                    fs_path = f"{root}/shard-{task.partitionId():06d}-{uuid.uuid4().hex[:12]}.tok"
                    out = ShardWriter(fs.open_output_stream(fs_path), enc.dtype)
                if key is not None:
                    lo, hi = key if lo is None else lo, key
                out.add(key, ids + end)
        if out is not None:
            import pyarrow as pa

            got = out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([task.partitionId()], pa.int32()), "path": [fs_path.rpartition("/")[2]],
                 "docs": [got["docs"]], "tokens": [got["tokens"]], "min_key": pa.array([lo], pa.int64()), "max_key": pa.array([hi], pa.int64())}
            )

    rows = id_text(docs, id_col, text_col).repartitionByRange("__id").sortWithinPartitions("__id", "__text")
    rows.mapInArrow(write, _MANIFEST).write.parquet(f"{out_dir.rstrip('/')}/_manifest")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row for each shard, with the number of ids in the shards before it."""
    m = spark.read.schema(_MANIFEST).parquet(f"{out_dir.rstrip('/')}/_manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a few bytes for each shard file
    return m.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_shards(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every stored document, from the files: ``doc_id, start, n_tokens,
    ids_crc32`` and ``found`` (its key's look-up leads to these ids)."""

    def read(batches):
        import pyarrow as pa

        fs, root = open_fs(out_dir)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r = ShardReader(fs, f"{root}/{path}")
                place = r.places(r.keys)
                same = np.zeros(len(place), bool)
                same[place >= 0] = r.keys[place[place >= 0]] == r.keys[place >= 0]
                starts = np.concatenate(([0], r.ends[:-1])) if len(r.ends) else r.ends
                crc = [zlib.crc32(r.ids(i).astype("<u4").tobytes()) for i in range(len(r.keys))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.keys, mask=~r.valid), pa.array(starts + base), pa.array(r.ends - starts),
                     pa.array(crc, pa.int64()), pa.array(same & r.valid)],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "found"],
                )

    m = read_manifest(spark, out_dir).select("path", "base", "shard")
    n = max(1, m.count())
    return m.repartition(n, "shard").select("path", "base").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, found boolean"
    )


def lookup_tokens(spark: SparkSession, out_dir: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` of the requested keys that are stored, through the index.
    Keys are routed by the shards' first keys and answered shard by shard."""
    shards = read_manifest(spark, out_dir).where("min_key is not null").orderBy("shard").select("path", "min_key").collect()
    paths, lows = [r.path for r in shards], np.array([r.min_key for r in shards], np.int64)  # two values for each file

    def route(batches):
        import pyarrow as pa

        for batch in batches:
            at = np.searchsorted(lows, batch.column(0).to_numpy(), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), batch.column(0)], ["at", "key"])

    def read(batches):
        import pyarrow as pa

        fs, root = open_fs(out_dir)
        for batch in batches:
            at, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for k in np.unique(at[at >= 0]):
                own = key[at == k]
                r = ShardReader(fs, f"{root}/{paths[k]}")
                hit = [(x, r.ids(i).astype(np.int64)) for x, i in zip(own.tolist(), r.places(own).tolist()) if i >= 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in hit], pa.int64()), pa.array([x for _, x in hit], pa.list_(pa.int64()))],
                    ["doc_id", "ids"],
                )

    k = keys.select(F.col(key_col).cast("long").alias("key")).where("key is not null").distinct()
    routed = k.mapInArrow(route, "at int, key long").repartition("at")
    return routed.mapInArrow(read, "doc_id long, ids array<long>")


def op6_token_binary(spark: SparkSession, docs: DataFrame, tokenizer: str, out_dir: str | None = None) -> DataFrame:
    """Write ``docs`` and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    out_dir = out_dir or scratch_path(spark, "token-shards")
    write_token_shards(docs, out_dir, tokenizer)
    return read_token_shards(spark, out_dir).drop("found")

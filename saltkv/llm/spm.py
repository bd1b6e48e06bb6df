"""Operator 5: SentencePiece models on the tokenizers library.

``load_model`` reads the model protobuf (wire format, no generated code) and
rebuilds it on the ``tokenizers`` library: the normaliser, the meta-space marker
and dummy prefix, unigram scores or the merges that BPE scores imply, byte
fallback, and the decoder.  Texts are cut where no piece can reach across
(``units``: spaces with the word behind them, and newlines), so each
distinct unit of a batch is encoded once, in multithreaded batches, and its ids are reused.

Parity.  With ``verify`` (the default) every new unit is also encoded by the
``sentencepiece`` library; a difference raises.  As ids of a text are those of its
units in order, this covers whole texts.

Scale.  Pure map over Arrow batches; the unit cache has a fixed size.

Defined cases.  A null text stays null (``ids`` null); the empty text has no ids
and decodes to the empty text.  Repeated rows give repeated results; an empty table
an empty one.  The marker character inside a text reads as a space when decoded, as
in the original library.  Other columns, of any name, are kept.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import deque
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KnownWords, id_text, kept, lean

MARK = "▁"  # U+2581
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Units a worker keeps (about 150 bytes each); beyond it new ones are encoded and forgotten.
CACHE_UNITS = 1 << 19
CHUNK_CHARS = 1 << 19


# ------------------------------------------------------------ protobuf


def _varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        c = b[i]
        n |= (c & 127) << shift
        i, shift = i + 1, shift + 7
        if c < 128:
            return n, i


def proto_fields(b: bytes):
    """``(number, value)`` of each field of one message: ints, floats' raw bytes, or bytes."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            v, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            v, i = b[i : i + n], i + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            v, i = b[i : i + n], i + n
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, v


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze: bool = True  # remove_extra_whitespaces
    escape: bool = True
    suffix: bool = False  # treat_whitespace_as_suffix
    charsmap: bytes = b""


def parse_model(raw: bytes) -> PieceModel:
    m = PieceModel()
    for n, v in proto_fields(raw):
        if n == 1:
            p = dict(proto_fields(v))
            score = struct.unpack("<f", p[2])[0] if 2 in p else 0.0
            m.pieces.append((p.get(1, b"").decode(), score, p.get(3, NORMAL)))
        elif n == 2:
            t = dict(proto_fields(v))
            m.kind, m.byte_fallback, m.suffix = t.get(3, UNIGRAM), bool(t.get(35, 0)), bool(t.get(24, 0))
        elif n == 3:
            s = dict(proto_fields(v))
            m.charsmap = s.get(2, b"")
            m.dummy_prefix, m.squeeze, m.escape = bool(s.get(3, 1)), bool(s.get(4, 1)), bool(s.get(5, 1))
    return m


def merges_of(m: PieceModel) -> list[tuple[str, str]]:
    """The pairs that BPE may merge, best score of the result first."""
    score = {p: s for p, s, kind in m.pieces if kind in (NORMAL, USER_DEFINED)}
    found = []
    for rank, (p, s, kind) in enumerate(m.pieces):
        if kind in (NORMAL, USER_DEFINED):
            found += [(-s, rank, i, p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in score and p[i:] in score]
    return [(a, b) for *_, a, b in sorted(found)]


def build_tokenizer(m: PieceModel):
    """The model on the tokenizers library, as a whole-text tokenizer."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if m.suffix or not m.escape:
        raise ValueError("markers as suffixes, or none, are not supported")
    unk = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), None)
    if m.kind == UNIGRAM:
        # types that the text can't produce get a score that no path would take
        vocab = [(p, s if kind in (NORMAL, USER_DEFINED, BYTE) else -1e9) for p, s, kind in m.pieces]
        model = models.Unigram(vocab, unk_id=unk, byte_fallback=m.byte_fallback)
    elif m.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        name = None if unk is None else m.pieces[unk][0]
        model = models.BPE(vocab, merges_of(m), unk_token=name, fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"model type {m.kind}")
    tok = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tok.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    tail = [decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return tok


# ------------------------------------------------------------ encoding

_UNIT = re.compile(r" *[^ \n]+|\n| +")


class ParityError(RuntimeError):
    pass


class PieceCodec:
    """Encodes and decodes batches of texts with one model."""

    def __init__(self, path: str, verify: bool = True, raw: bytes | None = None):
        from tokenizers import normalizers

        self.raw = raw if raw is not None else open(path, "rb").read()
        self.model = parse_model(self.raw)
        self.tok = build_tokenizer(self.model)
        m = self.model
        joins = re.compile(f"[^{MARK}]{MARK}")
        nl = [p for p, _, _ in m.pieces if "\n" in p]
        byte_nl = [i for i, (p, _, k) in enumerate(m.pieces) if k == BYTE and p == "<0x0A>"]
        #: Cutting into units is exact if no piece reaches across a cut.
        self.cuts = m.kind == BPE and m.byte_fallback and not nl and len(byte_nl) == 1 and not m.squeeze and not m.charsmap
        self.cuts = self.cuts and m.dummy_prefix and not any(joins.search(p) for p, _, _ in m.pieces)
        self.dtype = np.dtype("<u2" if len(m.pieces) <= 1 << 16 else "<u4")
        self.spelt = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in m.pieces]
        self.verify, self.cache, self.forgotten = verify, KnownWords(), 0
        if self.cuts:
            from tokenizers import Tokenizer, pre_tokenizers

            self.newline = byte_nl[0]
            self.bare = Tokenizer(self.tok.model)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
        if verify:
            import sentencepiece

            self.sp = sentencepiece.SentencePieceProcessor(model_proto=self.raw)

    # the unit of a cut text, as the model sees it: spaces are markers
    def _learn(self, units: list[str]) -> dict[str, bytes]:
        n, size = self.dtype.itemsize, 500
        words = [u for u in units if u != "\n"]
        marked = [u.replace(" ", MARK) for u in words]
        lines = ["\n".join(marked[i : i + size]) for i in range(0, len(marked), size)]
        out = {"\n": np.array([self.newline], self.dtype).tobytes()}
        got = [e.ids for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]
        if self.verify and lines:
            # behind a newline no dummy prefix can touch a unit: marker, newline, the line's ids
            for line, ids, other in zip(lines, got, self.sp.encode(["\n" + x for x in lines], num_threads=os.cpu_count() or 1)):
                if other[2:] != ids:
                    raise ParityError(f"ids differ in {line!r}")
        for k, ids in enumerate(got):
            part = words[k * size : (k + 1) * size]
            ids = np.array(ids, self.dtype)
            cut = np.flatnonzero(ids == self.newline)
            if len(cut) != len(part) - 1:
                raise ParityError("units were joined")
            raw = ids.tobytes()
            starts, ends = np.concatenate(([0], cut + 1)) * n, np.concatenate((cut, [len(ids)])) * n
            out.update(zip(part, (raw[a:b] for a, b in zip(starts.tolist(), ends.tolist()))))
        return out

    def _texts(self, texts: list[str]) -> list[bytes]:
        cut = [_UNIT.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        get = self.cache.__getitem__
        for units in cut:
            deque(map(get, units), 0)  # notes the units that the cache lacks
        new = self.cache.lacks
        if new:
            self.cache.lacks = {}
            self.cache.update(self._learn(list(new)))
        out = [b"".join(map(get, units)) for units in cut]
        if len(self.cache) > CACHE_UNITS:
            self.forgotten += len(new)
            for u in new:
                del self.cache[u]
            if self.forgotten > CACHE_UNITS:
                self.cache, self.forgotten = KnownWords(), 0
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``."""
        if not self.cuts:
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            if self.verify and ids != self.sp.encode(texts, num_threads=os.cpu_count() or 1):
                raise ParityError("ids differ")
            return [np.array(x, self.dtype).tobytes() for x in ids]
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for t in texts:
            some.append(t)
            size += len(t)
            if size >= CHUNK_CHARS:
                out += self._texts(some)
                some, size = [], 0
        return out + self._texts(some)

    def decode(self, ids: list[bytes]) -> list[str]:
        """The text of each row of ids.  Pieces are joined as bytes; rows whose byte
        pieces aren't UTF-8 go to the library's decoder, which replaces them."""
        get, skip, out = self.spelt.__getitem__, int(self.model.dummy_prefix), []
        for x in ids:
            own = np.frombuffer(x, self.dtype).tolist()
            raw = b"".join(map(get, own))
            try:
                out.append((raw[1:] if skip and raw[:1] == b" " else raw).decode())
            except UnicodeDecodeError:
                out.append(self.tok.decode(own, skip_special_tokens=False))
        return out


_CODECS: dict[tuple, PieceCodec] = kept("spm")


def codec(path: str, verify: bool = True) -> PieceCodec:
    if (path, verify) not in _CODECS:
        _CODECS[path, verify] = PieceCodec(path, verify)
    return _CODECS[path, verify]


# ------------------------------------------------------------ Spark


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", out_col: str = "ids", verify: bool = True) -> DataFrame:
    """``docs`` with the ids of ``text_col`` (little-endian binary, two bytes an id
    up to 65,536 pieces, four beyond)."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        c = codec(model, verify)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            got = iter(c.encode([t for t in texts if t is not None]))
            yield batch.append_column(out_col, pa.array([None if t is None else next(got) for t in texts], pa.binary()))

    schema = docs.withColumn(out_col, F.lit(None).cast("binary")).schema
    return docs.mapInArrow(lean(run, "spm"), schema)


def decode_pieces(docs: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids in ``ids_col``."""
    at = docs.columns.index(ids_col)

    def run(batches):
        import pyarrow as pa

        c = codec(model)
        for batch in batches:
            ids = batch.column(at).to_pylist()
            got = iter(c.decode([x for x in ids if x is not None]))
            yield batch.append_column(out_col, pa.array([None if x is None else next(got) for x in ids], pa.string()))

    schema = docs.withColumn(out_col, F.lit(None).cast("string")).schema
    return docs.mapInArrow(lean(run, "spm"), schema)


def op5_sentencepiece(spark: SparkSession, docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """Every text encoded and decoded again: ``doc_id, n_tokens, ids_crc32,
    decoded_chars, round_trip`` (the decoded text equals the text, markers read as
    spaces) and, if asked for, the ids as little-endian binary.  Null texts count as empty."""
    d = id_text(docs, "doc_id", "text").withColumn("__text", F.coalesce("__text", F.lit("")))

    def run(batches):
        import pyarrow as pa

        c = codec(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = part.column(1).to_pylist()
                ids = c.encode(texts)
                back = c.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [*([pa.array(ids, pa.binary())] if with_ids else []), part.column(0), pa.array([len(x) // c.dtype.itemsize for x in ids], pa.int64()),
                     pa.array([zlib.crc32(np.frombuffer(x, c.dtype).astype("<u4").tobytes()) for x in ids], pa.int64()),
                     pa.array([len(b) for b in back], pa.int64()),
                     pa.array([b == t.replace(MARK, " ") for b, t in zip(back, texts)])],
                    [*(["ids"] if with_ids else []), "doc_id", "n_tokens", "ids_crc32", "decoded_chars", "round_trip"],
                )

    kind = d.schema["__id"].dataType.simpleString()
    ids = "ids binary, " if with_ids else ""
    return d.mapInArrow(lean(run, "spm"), f"{ids}doc_id {kind}, n_tokens long, ids_crc32 long, decoded_chars long, round_trip boolean")

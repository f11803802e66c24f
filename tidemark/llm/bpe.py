"""Operator 8: byte-level BPE by a sentencepiece model that is serialised from the vocabulary.

Each byte is mapped to a visible character, each token of the vocabulary becomes a piece of those characters with its
negative rank as score, and normalisation is the identity; sentencepiece then merges by the same order as ranks do. Texts
are cut into pre-tokens by the given pattern, each encoded separately; ids are decoded by the inverse mapping.

Rows: null text is an empty one (no ids); texts of any length are encoded whole; repeated rows give equal results; other
columns aren't read. Caches are bounded by entries and by the length of what they keep.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

CACHE, CACHED_CHARS = 100_000, 64
#: A space between two characters that aren't white space, as Python has it: more than the patterns' \\s, so that cuts are safe.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: A space beside other white space: such texts aren't cut at each space.
UNEVEN = re.compile(r"\s[ ]|[ ]\s|^[ ]|[ ]$")


def byte_characters() -> list[str]:
    """A visible character for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """token -> rank, from lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model file: <unk> as piece 0 and the token of rank r as piece r + 1."""
    import struct

    show, by_rank = byte_characters(), sorted((r, t) for t, r in ranks.items())
    if [r for r, _ in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    unknown, bpe = 2, 2
    out = [_message(1, _message(1, b"<unk>") + _varint(3 << 3) + _varint(unknown))]
    for r, t in by_rank:
        piece = "".join(show[b] for b in t).encode()
        out.append(_message(1, _message(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(r))))
    out.append(_message(2, _varint(3 << 3) + _varint(bpe)))
    plain = b"".join(_varint(f << 3) + b"\0" for f in (3, 4, 5))  # no prefix, blanks kept, none replaced
    return b"".join(out) + _message(3, _message(1, b"identity") + plain)


class Cut:
    """Encodes texts by chunks that start at single spaces, each encoded once while the cache holds it.

    Between two characters that aren't white space, a single space always starts a pre-token of a pattern of the form
    ` ?\\p{L}+|...|\\s+(?!\\S)|\\s+`, so the ids of a text are those of its chunks in turn. What was used since the cache last
    filled up stays when it does again, so frequent chunks are encoded once.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[tuple[int, ...]]]):
        self.encode = encode
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def __call__(self, batch: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. Works on a few texts at a time, so that memory holds one slice's new chunks."""
        for some in slices(batch, 1_000_000):
            yield from self._slice(some)

    def _ids(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """Of distinct chunks."""
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        out = list(map(young.get, chunks))
        for k in [k for k, x in enumerate(out) if x is None]:
            if (x := old.get(chunks[k])) is not None:
                out[k] = young[chunks[k]] = x
        new = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(new, self.encode([chunks[k] for k in new]), strict=True):
            out[k] = x
            if len(chunks[k]) <= CACHED_CHARS:
                young[chunks[k]] = x
        return out

    def _slice(self, batch: list[str]) -> Iterator[np.ndarray]:
        uneven = [k for k, x in enumerate(batch) if UNEVEN.search(x)]
        known = set(uneven)
        order = [k for k in range(len(batch)) if k not in known] + uneven
        even = pc.split_pattern(pa.array([batch[k] for k in order[: len(order) - len(uneven)]], pa.string()), " ")
        others = [LONE_SPACE.split(batch[k]) for k in uneven]
        words = pa.chunked_array([even.flatten(), pa.array(list(chain.from_iterable(others)), pa.string())]).combine_chunks().dictionary_encode()
        sizes = np.concatenate([even.value_lengths().to_numpy(zero_copy_only=False), [len(x) for x in others]]).astype(np.int64)
        kind = words.indices.to_numpy().astype(np.int64) * 2
        ends = np.cumsum(sizes)
        kind[ends - sizes] += 1  # a text's first chunk has no space before it
        kinds, of = np.unique(kind, return_inverse=True)
        names = words.dictionary.to_pylist()
        ids = self._ids([names[k >> 1] if k & 1 else " " + names[k >> 1] for k in kinds.tolist()])
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
        begin, n = (np.cumsum(length) - length)[of], length[of]
        after = np.cumsum(n)
        flat = flat[np.repeat(begin - (after - n), n) + np.arange(int(n.sum()))]
        out: list = [None] * len(batch)
        for k, x in zip(order, np.split(flat, after[ends - 1][:-1]), strict=True):
            out[k] = x
        yield from out


class SentencePieceBPE:
    """Ids of texts by the serialised model."""

    def __init__(self, data: bytes, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(data)
        self.tokens = [t for t, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.find = regex.compile(pattern).findall
        self.show = {b: c for b, c in enumerate(byte_characters())}
        self.cut = Cut(self._chunks)

    def _chunks(self, chunks: list[str]) -> list[tuple[int, ...]]:
        pieces = [[p.encode("utf-8") for p in self.find(c)] for c in chunks]
        flat = {p: None for x in pieces for p in x}
        for p in flat:
            if (r := self.ranks.get(p)) is not None:  # a token as it is, whether merges lead to it or not
                flat[p] = (r,)
        rest = [p for p, ids in flat.items() if ids is None]
        mapped = [p.decode("latin-1").translate(self.show) for p in rest]
        for p, ids in zip(rest, self.model.encode(mapped, num_threads=1), strict=True):
            flat[p] = tuple(i - 1 for i in ids)
        return [tuple(chain.from_iterable(flat[p] for p in x)) for x in pieces]

    def encode(self, batch: list[str]) -> Iterator[np.ndarray]:
        return self.cut(batch)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_models: dict[tuple[int, str], SentencePieceBPE] = {}


def _model(data: bytes, pattern: str) -> SentencePieceBPE:
    key = (hash(data), pattern)
    if key not in _models:
        _models.clear()
        _models[key] = SentencePieceBPE(data, pattern)
    return _models[key]


def _mapped(docs: DataFrame, row: Callable, schema: str, arrow: pa.Schema, vocabulary: str, pattern: str) -> DataFrame:
    """vocabulary: a file of the driver; its bytes (under 2 MB) go out with the tasks."""
    with open(vocabulary, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(data.value, pattern)
        for b in batches:
            rows = [row(bpe, ids) for ids in bpe.encode(texts(b))]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(len(arrow) - len(b.schema) + 1)]
            kept = [b.column(i) for i, n in enumerate(b.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, t) for c, t in zip(cols, arrow.types[len(kept) :], strict=True)]], schema=arrow)

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes decoded back)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def row(bpe: SentencePieceBPE, ids: np.ndarray) -> tuple:
        ids = ids.tolist()
        return len(ids), sha(",".join(map(str, ids)).encode()), sha(bpe.decode(ids))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _mapped(own, row, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", arrow, vocabulary, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids (array<int>) of each text."""
    arrow = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.col("text").cast("string").alias("text"))
    return _mapped(own, lambda _, ids: (len(ids), ids), "doc_id long, lang string, source string, n_tokens long, ids array<int>", arrow, vocabulary, pattern)

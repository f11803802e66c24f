"""Operator 3: language-model scoring by an Elias-Fano n-gram trie, sharded by context.

No model is whole anywhere. Documents become blocks of tokens; a block asks each shard that it needs once for each distinct
word and word pair it holds, and gives its training counts with the question. A shard owns the words and contexts whose
hash falls to it: it adds up the counts, numbers its words and their successors, and builds the trie: its words in order,
with counts and back-off weights, point into a level of context-relative successor ids (Elias-Fano pointers and ids in
memory-mapped files, probabilities quantised to a byte), in which it answers by successor search. The blocks then score
their texts. What is shuffled is distinct pairs of blocks, with their counts, and at most a row for each of them.

There are as many shards as tokens need at SHARD_TOKENS each, so a shard doesn't grow with the corpus. Words that occur
more than CONTEXT_TOKENS times are frequent: how often each occurs is summed beforehand and known everywhere, so no shard
is asked for it by all blocks, and its pairs are dealt over several shards by their successors' hashes; its kinds of
successors are summed over its shards afterwards.

The model interpolates absolute discounting over pairs with the base distribution of words:
p(w | h) = WEIGHT * (max(c(h w) - DISCOUNT, 0) / c(h) + DISCOUNT * types(h) / c(h) * base(w)) + (1 - WEIGHT) * base(w).

Rows: null text has one token, its end; null doc_ids count as the text "null"; repeated rows are trained on and scored as
rows of their own; texts of any length stay whole in one block; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, mix
from .trie import Level

BLOCK_TOKENS = 1 << 20
#: A shard is asked for no more pairs than these, but for the chance of hashes.
SHARD_TOKENS = 1 << 21
#: Contexts that occur more often are dealt over shards.
CONTEXT_TOKENS = SHARD_TOKENS // 8
DISCOUNT, WEIGHT, ALPHA = 0.75, 0.3, 0.1
#: Log10 of a quantised probability is -STEP * (code - 1); code 0 is "none".
STEP = 0.03
END = np.uint64(0x5DEECE66D1234567)
#: Successors are told apart by the first 48 bits of their hashes, words by all 64.
CUT = np.uint64(16)
_hash = WordHash()
_NONE = np.zeros(0, np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, compressed: planes of small or near-constant bytes take next to nothing."""
    z = zstandard.ZstdCompressor(level=1)
    out = []
    for a in arrays:
        body = z.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()) if len(a) else b""
        out += [len(body).to_bytes(8, "little"), a.dtype.str.encode().ljust(8), len(a).to_bytes(8, "little"), body]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at, z = [], 0, zstandard.ZstdDecompressor()
    while at < len(data):
        size, kind, n = int.from_bytes(data[at : at + 8], "little"), np.dtype(data[at + 8 : at + 16].strip().decode()), int.from_bytes(data[at + 16 : at + 24], "little")
        planes = np.frombuffer(z.decompress(data[at + 24 : at + 24 + size]) if n else b"", np.uint8).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 24 + size
    return out


def _gaps(sorted_hashes: np.ndarray) -> np.ndarray:
    return np.diff(sorted_hashes, prepend=np.uint64(0))


def _sums(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=np.uint64)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def tokens(text: str) -> list[bytes]:
    """Words between the ASCII blanks, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def owner(words: np.ndarray, shards: int) -> np.ndarray:
    return ((words >> np.uint64(17)) % np.uint64(shards)).astype(np.int64)


@dataclass(frozen=True)
class Frequent:
    """Contexts dealt over shards: hashes in order, shards of each, and how often each occurs in training texts."""

    words: np.ndarray
    parts: np.ndarray
    total: np.ndarray

    def among(self, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in vocab, which is in order, of those that are there, and their own places."""
        at = np.searchsorted(vocab, self.words)
        own = np.flatnonzero(vocab[np.minimum(at, len(vocab) - 1)] == self.words) if len(vocab) else np.zeros(0, np.int64)
        return at[own], own


_BLOCKS = "block string, docs binary, data binary, tokens long"
_BLOCK = pa.schema([("block", pa.string()), ("docs", pa.binary()), ("data", pa.binary()), ("tokens", pa.int64())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, nth = TaskContext.get().partitionId(), 0
    ids: list[int | None] = []
    parts: list[np.ndarray] = []
    size = 0

    def close() -> pa.RecordBatch:
        nonlocal ids, parts, size, nth
        vocab, word = np.unique(np.concatenate(parts), return_inverse=True)
        known = np.array([i is not None for i in ids], np.uint8)
        doc = np.array([i or 0 for i in ids], np.int64)
        length = np.array([len(p) for p in parts], np.int64)
        train = np.array([not held_out(i) for i in ids], np.uint8)
        row = [f"{task}-{nth}"], [_pack(doc, known, length, train)], [_pack(_gaps(vocab), word.astype(np.uint32))], [len(word)]
        ids, parts, size, nth = [], [], 0, nth + 1
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, _BLOCK.types, strict=True)], schema=_BLOCK)

    few = (b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256))
    for b in few:
        for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            ids.append(i)
            parts.append(np.append(_hash.of(tokens(text or "")), END))
            size += len(parts[-1])
            if size >= BLOCK_TOKENS:
                yield close()
    if ids:
        yield close()


class Block:
    """The distinct words and pairs of a block, in the order in which shards are asked."""

    def __init__(self, docs: bytes, data: bytes, shards: int, frequent: Frequent):
        self.doc, self.known, self.length, train = _unpack(docs)
        gaps, self.word = _unpack(data)
        self.vocab = _sums(gaps)
        n = np.uint64(len(self.vocab))
        end = np.searchsorted(self.vocab, END)
        previous = np.concatenate([[end], self.word[:-1]]).astype(np.uint64)  # before a text stands an end
        previous *= n
        previous += self.word
        self.pair, of = np.unique(previous, return_inverse=True)
        del previous
        self.of = of.astype(np.uint32)
        del of
        self.context, self.successor = (self.pair // n).astype(np.int64), (self.pair % n).astype(np.int64)
        trained = np.repeat(train.astype(bool), self.length)
        self.word_count = np.bincount(self.word[trained], minlength=len(self.vocab)).astype(np.uint32)
        self.pair_count = np.bincount(self.of[trained], minlength=len(self.pair)).astype(np.uint32)
        shard = owner(self.vocab, shards)
        at, own = frequent.among(self.vocab)
        asked = np.ones(len(self.vocab), bool)
        asked[at] = False  # their counts are known
        words = np.flatnonzero(asked)
        self.words_of = Parts(words[np.argsort(shard[words], kind="stable")], shard, shards)
        shard = shard[self.context]
        parts = np.ones(len(self.vocab), np.int64)
        parts[at] = frequent.parts[own]
        dealt = np.flatnonzero(parts[self.context] > 1)
        part = mix(self.vocab[self.successor[dealt]]) % parts[self.context[dealt]].astype(np.uint64)
        shard[dealt] = (shard[dealt] + part.astype(np.int64)) % shards
        self.pairs_of = Parts(np.lexsort((self.successor, self.context, shard)), shard, shards)

    def shards(self) -> list[int]:
        """Those that there is something to ask."""
        return sorted({*self.words_of.there, *self.pairs_of.there})

    def ask(self, s: int) -> bytes:
        w, p = self.words_of[s], self.pairs_of[s]
        contexts, n = np.unique(self.context[p], return_counts=True)
        w = np.union1d(w, contexts)  # the shard's own words, and contexts that are dealt to it
        has = np.zeros(len(w), np.uint32)
        has[np.searchsorted(w, contexts)] = n
        successors, of = np.unique(self.successor[p], return_inverse=True)
        kind = np.uint16 if len(successors) <= 1 << 16 else np.uint32
        return _pack(_gaps(self.vocab[w]), self.word_count[w], has, _gaps(self.vocab[successors] >> CUT), of.astype(kind), self.pair_count[p])


class Parts:
    """Places by shard, in order; only the shards that have some take memory."""

    def __init__(self, order: np.ndarray, shard: np.ndarray, shards: int):
        kinds, start = np.unique(shard[order], return_index=True)
        self.there, self.shards = dict(zip(kinds.tolist(), np.split(order, start[1:]), strict=False)), shards

    def __getitem__(self, s: int) -> np.ndarray:
        return self.there.get(s, _NONE)

    def __iter__(self) -> Iterator[np.ndarray]:
        return (self[s] for s in range(self.shards))


def _occurrences(least: float, only: np.ndarray | None = None):
    """How often words occur in a block and in its training texts: those that do so `least` times, or `only` some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for docs, data in zip(b.column("docs").to_pylist(), b.column("data").to_pylist(), strict=True):
                _, _, length, train = _unpack(docs)
                gaps, word = _unpack(data)
                vocab = _sums(gaps)
                n = np.bincount(word, minlength=len(vocab))
                trained = np.bincount(word[np.repeat(train.astype(bool), length)], minlength=len(vocab))
                at = np.flatnonzero(n >= least if only is None else np.isin(vocab, only))
                yield pa.RecordBatch.from_arrays([pa.array(vocab[at].view(np.int64)), pa.array(n[at]), pa.array(trained[at])], ["word", "n", "trained"])

    return run


def _frequent(blocks: DataFrame, tokens: int, n_blocks: int, shards: int, most: int) -> Frequent:
    none = np.zeros(0, np.int64)
    if shards == 1 or tokens <= most:
        return Frequent(none.astype(np.uint64), none, none)
    # a word that stays below `least` in some blocks misses at most half of `most` there
    sums = lambda *of: blocks.mapInArrow(_occurrences(*of), "word long, n long, trained long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))
    words = [r.word for r in sums(most / 2 / n_blocks).where(F.col("n") >= most // 2).collect()]
    rows = sorted((r.word % (1 << 64), r.n, r.trained) for r in sums(0, np.array(words, np.int64).view(np.uint64)).collect()) if words else []
    rows = [r for r in rows if r[1] > most]
    return Frequent(np.array([r[0] for r in rows], np.uint64), np.array([min(shards, -(-r[1] // most)) for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))


def _ask(shards: int, frequent: Frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, docs, data in zip(*(b.column(k).to_pylist() for k in ("block", "docs", "data")), strict=True):
                block = Block(docs, data, shards, frequent)
                asked = block.shards()
                for k in range(0, len(asked), 64):
                    some = asked[k : k + 64]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([name] * len(some)), pa.array([block.ask(s) for s in some], pa.binary())], ["shard", "block", "data"])
                del block  # before the next one is made

    return run


def quantise(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, 1 + np.clip(np.round(-np.log10(np.maximum(p, 1e-300)) / STEP), 0, 254), 0).astype(np.uint8)


def value(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-STEP * (code.astype(float) - 1)), 0.0)


def back_off(types: np.ndarray, total: np.ndarray) -> np.ndarray:
    return quantise(np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 0))


def _answers(shards: int, frequent: Frequent):
    """One shard: counts of its words, and quantised probabilities of its pairs and back-off weights of its contexts. A row
    without a block has the dealt contexts, and how many kinds of successors each has in this shard."""

    def run(asked: pd.DataFrame) -> pd.DataFrame:
        return _answer(asked, shards, frequent)

    return run


def _answer(asked: pd.DataFrame, shards: int, frequent: Frequent) -> pd.DataFrame:
    shard, names = int(asked["shard"].iloc[0]), asked["block"].tolist()
    parts = [_unpack(x) for x in asked["data"]]
    words = [_sums(p[0]) for p in parts]
    vocab, of = np.unique(np.concatenate(words), return_inverse=True)
    dealt, own = frequent.among(vocab)
    mine = owner(vocab, shards) == shard
    mine[dealt] = False
    count = np.where(mine, np.bincount(of, weights=np.concatenate([p[1] for p in parts]), minlength=len(vocab)), 0)
    rank = [np.repeat(np.searchsorted(vocab, w), p[2]) for w, p in zip(words, parts, strict=True)]
    successors = [_sums(p[3]) for p in parts]
    known = np.unique(np.concatenate(successors))
    ids = [np.searchsorted(known, x)[p[4]].astype(np.uint64) for x, p in zip(successors, parts, strict=True)]
    del successors
    key = (np.concatenate(rank).astype(np.uint64) << np.uint64(32)) | np.concatenate(ids)
    times = np.concatenate([p[5] for p in parts]).astype(np.int64)
    del parts
    key, times = key[times > 0], times[times > 0]
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    del order
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key, times = key[first], np.add.reduceat(times, first) if len(first) else times
    context = (key >> np.uint64(32)).astype(np.int64)
    total = np.bincount(context, weights=times, minlength=len(vocab))
    types = np.bincount(context, minlength=len(vocab))
    total[dealt] = frequent.total[own]
    level = Level(context, key & np.uint64((1 << 32) - 1), quantise((times - DISCOUNT) / total[context]), len(vocab))
    backoff = back_off(types, total)
    out = [(None, shard, _pack(own, types[dealt]), int(count.sum()), int((count > 0).sum()))]
    for name, w, r, i in zip(names, words, rank, ids, strict=True):
        at = level.find(r, i)
        own = np.searchsorted(vocab, w)
        own = own[mine[own]]
        found = np.where(at >= 0, level.codes[at], 0).astype(np.uint8) if level.ids.n else np.zeros(len(r), np.uint8)
        out.append((name, shard, _pack(count[own].astype(np.uint64), backoff[own], found), 0, 0))
    return pd.DataFrame(out, columns=["block", "shard", "data", "total", "types"])


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(shards: int, total: int, types: int, frequent: Frequent, dealt_types: np.ndarray):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        body = rows[rows["shard"] < 0].iloc[0]
        block = Block(body["docs"], body["data"], shards, frequent)
        count, backoff, pair = np.zeros(len(block.vocab)), np.zeros(len(block.vocab), np.uint8), np.zeros(len(block.pair), np.uint8)
        for s, data in zip(rows["shard"], rows["data"], strict=True):
            if s >= 0:
                count[block.words_of[s]], backoff[block.words_of[s]], pair[block.pairs_of[s]] = _unpack(data)
        at, own = frequent.among(block.vocab)
        count[at] = frequent.total[own]
        backoff[at] = back_off(dealt_types[own], frequent.total[own])
        base = (count + ALPHA) / (total + ALPHA * (types + 1))
        rest = np.where(backoff > 0, value(backoff), 1.0)  # a context without counts leaves all to the base
        p = WEIGHT * (value(pair) + rest[block.context] * base[block.successor]) + (1 - WEIGHT) * base[block.successor]
        cuts = np.cumsum(block.length) - block.length
        doc = [int(i) if k else None for i, k in zip(block.doc, block.known, strict=True)]
        return pd.DataFrame(
            {
                "doc_id": pd.array(doc, "Int64"),
                "held_out": [held_out(i) for i in doc],
                "n_tokens": block.length,
                "n_known": np.add.reduceat((count[block.word] > 0).astype(np.int64), cuts),
                "train_tokens": total,
                "base_score": np.add.reduceat(np.log10(base)[block.word], cuts),
                "score": np.add.reduceat(np.log10(p)[block.of], cuts),
            }
        )

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = own.mapInArrow(_blocks, _BLOCKS).checkpoint()
    tokens, n_blocks = blocks.agg(F.sum("tokens"), F.count("*")).first()
    shards = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(tokens or 0) // SHARD_TOKENS))
    frequent = _frequent(blocks, tokens or 0, n_blocks, shards, CONTEXT_TOKENS)
    asked = blocks.mapInArrow(_ask(shards, frequent), "shard int, block string, data binary")
    answers = asked.groupBy("shard").applyInPandas(_answers(shards, frequent), "block string, shard int, data binary, total long, types long").checkpoint()
    total, types, dealt_types = int(frequent.total.sum()), int((frequent.total > 0).sum()), np.zeros(len(frequent.words), np.int64)
    for r in answers.where("block is null").collect():
        at, n = _unpack(r.data)
        total, types = total + r.total, types + r.types
        dealt_types[at] += n
    bodies = blocks.select("block", F.lit(-1).alias("shard"), "docs", "data")
    rows = bodies.union(answers.where("block is not null").select("block", "shard", F.lit(None).cast("binary"), "data"))
    return rows.groupBy("block").applyInPandas(_score(shards, total, types, frequent, dealt_types), _SCORES)

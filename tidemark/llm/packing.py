"""Operator 10: token ids as files of a context-mixing range coder.

A file holds the ids of consecutive documents: a checksummed header (documents, lengths, frequencies of the ids) and blocks
of BLOCK ids, each a stream of the coder with a checksum of its own. The blocks of a file are coded side by side, one id of
each at a time, and share one model, which learns from all of them, so the work is on arrays. The chance of an id is a
mixture of three predictions: order 2 and order 1 put all on the id that has followed their context most often, order 0
spreads over all ids, by the header's frequencies and what the file has had so far. The weights of the mixture, by how often
both contexts have been right, move towards what each prediction has contributed. The model changes between spans of at most
EPOCH ids of each block, never within one.

Files are rows of a Parquet table in the shared folder, so any store that Spark writes to will do and a lost executor's
files are written again. Documents are dealt out in ranges of doc_id (null first; ties by a hash of the text, so that rows
without an id or with the same one are spread), as many as PART_CHARS characters each need.

Rows: null text is an empty one and has its end id alone; repeated rows are written again; texts of any length are
encoded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import shared

from .bpe import LONE_SPACE
from .common import slices, texts

BLOCK, FILE_BLOCKS = 1024, 4096
#: Characters that a task is to encode, about.
PART_CHARS = 64_000_000
MAGIC = b"TMID\x05"
END_ID = 0
#: Bits of the header's frequencies, of the hash of two ids and of the share of order 0; levels of confidence.
SCALE, SLOTS, PARTS, LEVELS = 21, 17, 9, 16
#: Ids below this are counted and looked up in arrays.
DENSE = 1 << 22
#: Ids of each block after which the contexts learn anew from all so far; ids between other changes; rows at a time.
LEARN, EPOCH, ROWS = (4, 16, 64, 256, 512), 32, 4
U = np.uint64
BOTTOM, HALF = U(1 << 32), U(32)


def followers(context: np.ndarray, ids: np.ndarray, contexts: int, bits: int) -> np.ndarray:
    """For each context the id that has followed it most often, times LEVELS, plus the level of its share."""
    kind = np.uint32 if contexts.bit_length() + bits <= 32 else np.uint64
    key = (context.astype(kind) << kind(bits)) | ids.astype(kind)
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n, key = np.diff(at, append=len(key)), key[at].astype(np.int64)
    of = key >> bits
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    low = (1 << bits) - 1
    most = np.maximum.reduceat((n << bits) | (key & low), first)
    level = LEVELS * (2 * (most >> bits) - 1) // (2 * np.add.reduceat(n, first) + 2)
    out = np.zeros(contexts, np.int64)
    out[of[first]] = (most & low) * LEVELS + level
    return out


class Model:
    """The predictions of all blocks of a file, over places in the order of the distinct ids. Coder and decoder have the same
    ones: sums are of whole numbers, and doubles are added, multiplied and divided one by one.

    An interval of 2 ** scale is laid out by order 0 first; the shares of orders 1 and 2 are put in where their ids begin."""

    def __init__(self, freq: np.ndarray):
        self.kinds = len(freq)
        self.bits = max(self.kinds, 1).bit_length()
        self.total = max(self.bits + 1, min(self.bits + 5, 18))
        self.scale = self.total + PARTS
        self.seen = freq.astype(np.int64)
        self.one, self.two = np.zeros(max(self.kinds, 1), np.int64), np.zeros(1 << SLOTS, np.int64)
        rate = (np.arange(LEVELS) + 0.5) / LEVELS
        second = np.tile(np.repeat(0.9 * rate, LEVELS), 2)
        self.n = np.full(2 * LEVELS**2, 8.0)
        self.n2, self.n1 = self.n * second, self.n * (1 - second) * np.tile(0.8 * rate, 2 * LEVELS)
        self._fit()

    def _fit(self) -> None:
        if self.kinds:
            self.f = 1 + self.seen * ((1 << self.total) - self.kinds) // self.seen.sum()
            self.f[self.f.argmax()] += (1 << self.total) - self.f.sum()
            self.cum = np.cumsum(self.f) - self.f
            self.place = np.repeat(np.arange(self.kinds, dtype=np.uint32), self.f)
        w2, w1 = self.n2 / self.n, self.n1 / self.n
        self.parts = np.clip(((1.0 - w2 - w1) * (1 << PARTS)).astype(np.int64), 1, 1 << PARTS)
        guessed = ((1 << PARTS) - self.parts) << self.total
        self.share2 = (guessed * (w2 / (w2 + w1))).astype(np.int64)
        self.share1 = guessed - self.share2
        self.sums = np.zeros((3, len(self.n)), np.int64)

    def _slot(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return ((one * 0x9E3779B1 + two * 0x85EBCA77) >> 7) & ((1 << SLOTS) - 1)

    def learn(self, *some: np.ndarray) -> None:
        """The contexts' followers, from all ids so far (steps by lanes; of one of them three steps at least)."""
        flat = lambda x: np.concatenate([a.reshape(-1) for a in x])
        self.one = followers(flat([x[:-1] for x in some]), flat([x[1:] for x in some]), self.kinds, self.bits)
        self.two = followers(flat([self._slot(x[1:-1], x[:-2]) for x in some]), flat([x[2:] for x in some]), 1 << SLOTS, self.bits)

    def predict(self, one: np.ndarray, two: np.ndarray) -> None:
        """For places whose last one and the one before it are these."""
        e2, e1 = self.two.take(self._slot(one, two)), self.one.take(one)
        self.p2, self.p1 = e2 // LEVELS, e1 // LEVELS
        self.way = (e2 % LEVELS) * LEVELS + e1 % LEVELS + LEVELS**2 * (self.p2 == self.p1)
        self.m0, self.m2, self.m1 = self.parts.take(self.way), self.share2.take(self.way), self.share1.take(self.way)

    def interval(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where these places' intervals begin in the mixture, and their widths."""
        self.hit2, self.hit1 = self.p2 == q, self.p1 == q
        begin = self.m0 * self.cum.take(q) + self.m2 * (self.p2 < q) + self.m1 * (self.p1 < q)
        width = self.m0 * self.f.take(q) + self.m2 * self.hit2 + self.m1 * self.hit1
        return begin, width

    def count(self, width: np.ndarray) -> None:
        """What the predictions have contributed to these widths: whole numbers, so that it doesn't matter how many rows come
        at a time."""
        self.sums[0] += np.bincount(self.way, minlength=len(self.n))
        for k, hit, m in ((1, self.hit2, self.m2), (2, self.hit1, self.m1)):
            at = np.flatnonzero(hit)
            self.sums[k] += np.bincount(self.way.take(at), np.floor(m.take(at) * 65536.0 / width.take(at)), len(self.n)).astype(np.int64)

    def find(self, v: np.ndarray) -> np.ndarray:
        """The places whose intervals hold these numbers: the shares of order 2, then of order 1 are taken out again."""
        begin1 = self.m0 * self.cum.take(self.p1)
        begin2 = self.m0 * self.cum.take(self.p2) + self.m1 * (self.p1 < self.p2)
        v = np.maximum(np.minimum(v, begin2), v - self.m2)
        v = np.maximum(np.minimum(v, begin1), v - self.m1)
        return self.place.take(v // self.m0).astype(np.int64)

    def update(self, ids: np.ndarray) -> None:
        """After a span of these places. Older spans count half as much for the weights with each."""
        n, n2, n1 = self.sums
        self.n, self.n2, self.n1 = self.n * 0.5 + n + 1.0, self.n2 * 0.5 + n2 / 65536 + 0.01, self.n1 * 0.5 + n1 / 65536 + 0.01
        self.seen += np.bincount(ids.reshape(-1), minlength=self.kinds)
        self._fit()


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and their order-0 frequencies, scaled to a sum of 2 ** SCALE."""
    if len(ids) and ids.max() < DENSE:
        n = np.bincount(ids)
        kinds = np.flatnonzero(n)
        n = n[kinds]
    else:
        kinds, n = np.unique(ids, return_counts=True)
    if len(kinds) > 1 << (SCALE - 1):
        raise ValueError("too many distinct ids in a file")
    freq = np.maximum(1, n * ((1 << SCALE) - len(kinds)) // max(len(ids), 1))
    if len(kinds):
        freq[freq.argmax()] += (1 << SCALE) - freq.sum()
    return kinds.astype(np.uint32), freq.astype(np.uint32)


def places_of(ids: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The places of ids among the distinct ones."""
    if not len(kinds) or kinds[-1] >= DENSE:
        return np.searchsorted(kinds, ids)
    table = np.zeros(int(kinds[-1]) + 1, np.uint32)
    table[kinds] = np.arange(len(kinds))
    return table.take(ids)


def spans(length: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Steps from, to, and the blocks that have them; only the last block may be shorter than the first."""
    steps, least = int(length[0]), int(length[-1])
    cuts = sorted(c for c in {0, 1, 2, 8, *LEARN, *range(EPOCH, steps, EPOCH), least, steps} if c <= steps)
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield a, b, len(length) - (least <= a)


def encode_blocks(places: np.ndarray, length: np.ndarray, freq: np.ndarray) -> list[bytes]:
    """The coded bytes of each block (places: steps by lanes). Blocks must come longest first."""
    steps, lanes = places.shape
    had = np.zeros((steps + 2, lanes), np.int64)  # two places before the first
    had[2:] = places
    model, low, rng = Model(freq), np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    words = np.zeros((lanes, steps + 4), np.int64)  # of 32 bits, and what is carried over
    out, at = words.reshape(-1), np.arange(lanes) * (steps + 4) + 1
    shift = U(model.scale)
    for a, b, n in spans(length) if lanes else ():
        if a in LEARN:
            model.learn(had[2 : a + 2, :n], had[2 : int(length[-1]) + 2, n:])
        for s in range(a, b, ROWS):
            e = min(s + ROWS, b)
            model.predict(had[s + 1 : e + 1, :n].reshape(-1), had[s:e, :n].reshape(-1))
            begin, width = model.interval(had[s + 2 : e + 2, :n].reshape(-1))
            model.count(width)
            begin, width = begin.astype(U).reshape(-1, n), width.astype(U).reshape(-1, n)
            for t in range(e - s):
                r = rng[:n] >> shift
                step = r * begin[t]
                low[:n] += step
                over = np.flatnonzero(low[:n] < step)
                out[at[over] - 1] += 1
                np.multiply(r, width[t], out=rng[:n])
                todo = np.flatnonzero(rng[:n] < BOTTOM)
                out[at[todo]] = low[todo] >> HALF
                at[todo] += 1
                low[todo] <<= HALF
                rng[todo] <<= HALF
        model.update(had[a + 2 : b + 2, :n])
    for _ in range(2):
        out[at] = low >> HALF
        at += 1
        low <<= HALF
    while (over := words >> 32).any():
        words &= 0xFFFFFFFF
        words[:, :-1] += over[:, 1:]
    used = at - np.arange(lanes) * (steps + 4)
    return [words[k, 1 : used[k]].astype("<u4").tobytes() for k in range(lanes)]


def decode_blocks(data: list[bytes], length: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The places of the blocks (steps by lanes), longest first."""
    lanes, steps = len(data), int(length[0]) if len(data) else 0
    words = np.zeros((lanes, max(map(len, data), default=0) // 4 + 4), np.uint32)
    for k, d in enumerate(data):
        words[k, : len(d) // 4] = np.frombuffer(d, "<u4")
    text, at = words.reshape(-1), np.arange(lanes) * words.shape[1] + 2
    model, rng = Model(freq), np.full(lanes, 2**64 - 1, U)
    code = (words[:, 0].astype(U) << HALF) | words[:, 1]  # less what the coder has in `low`
    had = np.zeros((steps + 2, lanes), np.int64)
    shift, last = U(model.scale), U((1 << model.scale) - 1)
    for a, b, n in spans(length) if lanes else ():
        if a in LEARN:
            model.learn(had[2 : a + 2, :n], had[2 : int(length[-1]) + 2, n:])
        for t in range(a, b):
            model.predict(had[t + 1, :n], had[t, :n])
            r = rng[:n] >> shift
            q = had[t + 2, :n] = model.find(np.minimum(code[:n] // r, last).view(np.int64))
            begin, width = model.interval(q)
            model.count(width)
            code[:n] -= r * begin.view(U)
            np.multiply(r, width.view(U), out=rng[:n])
            todo = np.flatnonzero(rng[:n] < BOTTOM)
            code[todo] = (code[todo] << HALF) | text[at[todo]]
            rng[todo] <<= HALF
            at[todo] += 1
        model.update(had[a + 2 : b + 2, :n])
    return had[2:]


def write_file(docs: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file of the ids of these documents."""
    kinds, freq = frequencies(ids)
    lanes, steps = -(-len(ids) // BLOCK), min(BLOCK, len(ids))
    places = np.zeros(lanes * steps, np.uint32)
    places[: len(ids)] = places_of(ids, kinds)
    coded = encode_blocks(places.reshape(lanes, steps).T, np.minimum(BLOCK, len(ids) - BLOCK * np.arange(lanes)), freq)
    known = np.array([d is not None for d in docs], np.uint8)
    head = b"".join(
        [
            struct.pack("<QQQQ", len(docs), len(ids), len(kinds), len(coded)),
            np.array([d or 0 for d in docs], "<i8").tobytes(), known.tobytes(), np.array(lengths, "<u8").tobytes(), kinds.astype("<u4").tobytes(), freq.astype("<u4").tobytes(),
            np.array([len(c) for c in coded], "<u4").tobytes(), np.array([zlib.crc32(c) for c in coded], "<u4").tobytes(),
        ]
    )
    head = zlib.compress(head, 1)
    return b"".join([MAGIC, struct.pack("<QI", len(head), zlib.crc32(head)), head, *coded])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The documents, their lengths and all ids. A wrong checksum is an error that names the block."""
    if data[:5] != MAGIC:
        raise ValueError("not a file of token ids")
    size, crc = struct.unpack_from("<QI", data, 5)
    raw = data[17 : 17 + size]
    if zlib.crc32(raw) != crc:
        raise ValueError("damaged header")
    head = zlib.decompress(raw)
    n_docs, n_ids, n_kinds, n_blocks = struct.unpack_from("<QQQQ", head)
    at = 32

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(head, kind, n, at)
        at += a.nbytes
        return a

    doc, known, lengths, kinds, freq, sizes, crcs = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs), take("<u4", n_kinds), take("<u4", n_kinds), take("<u4", n_blocks), take("<u4", n_blocks)
    ends = 17 + size + np.cumsum(sizes.astype(np.int64))
    coded = [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    for k, (c, want) in enumerate(zip(coded, crcs.tolist(), strict=True)):
        if zlib.crc32(c) != want:
            raise ValueError(f"damaged block {k}")
    length = np.array([min(BLOCK, n_ids - k * BLOCK) for k in range(n_blocks)], np.int64)
    whole = kinds[decode_blocks(coded, length, freq).T.reshape(-1)[:n_ids]]
    return [int(d) if k else None for d, k in zip(doc, known, strict=True)], lengths.astype(np.int64), whole


#: White space as Python has it, which is more than the pattern's \\s; letters that any Unicode version has.
_WHITE = r"\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: A space beside other white space or at an end, or the mark of cuts; a piece without white space inside; where texts are cut.
UNEVEN, PLAIN = rf"[{_WHITE}] | [{_WHITE}]|\A | \z|\x00", rf"\A ?[^{_WHITE}]+\z"
#: Pieces that are one pre-token.
WORD = rf"\A ?[{_LETTER}]+\z"
TAIL, LINE = rf"([{_LETTER}])([.,;:!?$&|*#%)]+)", rf"([^{_WHITE}])\n([^{_WHITE}])"
#: Characters that are cut at a time; pieces and ids that are kept, and the characters of the longest piece that stays.
SLICE, KEPT, KEPT_IDS, KEPT_CHARS = 8_000_000, 600_000, 6_000_000, 64


def runs(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """n numbers from each begin on, in turn."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + int(begin.max(initial=0)) < 1 << 31 else np.int64
    out = np.repeat((begin - (ends - n)).astype(kind), n)
    out += np.arange(total, dtype=kind)
    return out


class LibraryBPE:
    """Ids by the tokenizers library, for patterns of the form ` ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`.

    Texts are cut where a pre-token ends: before single spaces, around single line ends and between letters and punctuation
    (only before spaces where there is other white space beside one, or an added token). Each distinct piece is encoded once
    while it is kept; new ones in few calls, told apart by line ends between them."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_buffer(data)
        self.uneven = "|".join([UNEVEN, *[re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]])
        (self.line,) = self._encode(["\n"])[0]
        self.words = Tokenizer.from_buffer(data)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit("\n"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.width = np.array([len(self.tokenizer.id_to_token(k) or "") for k in range(self.tokenizer.get_vocab_size())])
        self.number: dict[str, int] = {}
        self.ids, self.begin, self.n, self.uses = np.zeros(0, np.int32), *np.zeros((3, 0), np.int64)

    def _encode(self, some: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def _shrink(self) -> None:
        """Keeps short pieces that several slices had, unless these are too many."""
        again = (self.uses > 1).tolist()
        kept = [(p, k) for p, k in self.number.items() if again[k] and len(p) <= KEPT_CHARS]
        kept = kept if len(kept) <= KEPT // 2 else []
        at = np.array([k for _, k in kept], np.int64)
        n = self.n[at]
        self.number = {p: k for k, (p, _) in enumerate(kept)}
        self.ids, self.begin, self.n, self.uses = self.ids[runs(self.begin[at], n)], np.cumsum(n) - n, n, np.zeros(len(n), np.int64)

    def _plain(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces without white space inside, and how many each has: a line end between two is a token."""
        joined = self._encode(["\n".join(pieces[k : k + 500]) for k in range(0, len(pieces), 500)])
        ids = np.concatenate([np.zeros(0, np.int32), *[np.array(x, np.int32) for got in joined for x in (got, [self.line])]])
        at = np.flatnonzero(ids == self.line)
        if len(at) != len(pieces):
            raise ValueError("pieces and line ends differ in number")
        return ids[ids != self.line], np.diff(at, prepend=-1) - 1

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that are one pre-token each: the library needs no pattern, and bytes tell them apart."""
        joined = self.words.encode_batch_fast(["\n".join(pieces[k : k + 500]) for k in range(0, len(pieces), 500)], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.int32), *[np.array(x.ids, np.int32) for x in joined]])
        size = np.cumsum(pc.binary_length(pa.array(pieces, pa.string())).to_numpy().astype(np.int64))
        ends = np.cumsum(self.width[ids])
        last = np.searchsorted(ends, size)
        if len(ids) and (ends[-1] != size[-1] or (ends[last] != size).any()):
            raise ValueError("words and tokens differ in length")
        return ids, np.diff(last, prepend=-1)

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._encode(pieces)
        return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn(self, pieces: list[str]) -> None:
        column = pa.array(pieces, pa.string())
        word, plain = (pc.match_substring_regex(column, x).to_numpy(zero_copy_only=False) for x in (WORD, PLAIN))
        for encode, some in ((self._words, word), (self._plain, plain & ~word), (self._alone, ~plain)):
            own = [pieces[k] for k in np.flatnonzero(some).tolist()]
            ids, n = encode(own)
            self.number.update(zip(own, range(len(self.n), len(self.n) + len(n)), strict=True))
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(n) - n])
            self.ids, self.n = np.concatenate([self.ids, ids]), np.concatenate([self.n, n])
        self.uses = np.concatenate([self.uses, np.zeros(len(self.n) - len(self.uses), np.int64)])

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Of distinct pieces."""
        if len(self.n) > KEPT or len(self.ids) > KEPT_IDS:
            self._shrink()
        out = np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))
        if len(at := np.flatnonzero(out < 0)):
            new = [pieces[k] for k in at.tolist()]
            self._learn(new)
            out[at] = np.fromiter(map(self.number.__getitem__, new), np.int64, len(new))
        self.uses[out] += 1
        return out

    def _joined(self, pieces: pa.Array, sizes: np.ndarray) -> list[np.ndarray]:
        """The ids of texts that have so many pieces each, one at least."""
        coded = pieces.dictionary_encode()
        number, of = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy()
        begin, n = self.begin[number][of], self.n[number][of]
        after = np.cumsum(n)
        return np.split(self.ids[runs(begin, n)], after[np.cumsum(sizes) - 1][:-1])

    def cut(self, batch: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for some in slices(batch, SLICE):
            yield from self._slice(some)

    def _slice(self, batch: list[str]) -> Iterator[np.ndarray]:
        column, out = pa.array(batch, pa.string()), [np.zeros(0, np.int32)] * len(batch)
        uneven = pc.match_substring_regex(column, self.uneven).to_numpy(zero_copy_only=False)
        if not uneven.all():
            marked = pc.replace_substring_regex(column.filter(pa.array(~uneven)), TAIL, "\\1\0\\2")
            marked = pc.replace_substring_regex(marked, LINE, "\\1\0\n\0\\2")
            pieces = pc.split_pattern(pc.replace_substring(marked, " ", "\0 "), "\0")
            for k, ids in zip(np.flatnonzero(~uneven).tolist(), self._joined(pieces.flatten(), pieces.value_lengths().to_numpy()), strict=True):
                out[k] = ids
        if uneven.any():
            at = np.flatnonzero(uneven).tolist()
            chunks = [[" " * (k > 0) + x for k, x in enumerate(LONE_SPACE.split(batch[i]))] for i in at]
            for k, ids in zip(at, self._joined(pa.array(list(chain.from_iterable(chunks)), pa.string()), np.array(list(map(len, chunks)))), strict=True):
                out[k] = ids
        yield from out


_libraries: dict[int, LibraryBPE] = {}


def _library(data: bytes) -> LibraryBPE:
    if (key := hash(data)) not in _libraries:
        _libraries.clear()
        _libraries[key] = LibraryBPE(data)
    return _libraries[key]


_FILE = pa.schema([("part", pa.int64()), ("nth", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Writes the ids of docs (doc_id, text) as files under `path`; gives them back as (part, nth, n_docs, n_tokens, data)."""
    with open(vocabulary, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())  # a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, part, nth = _library(data.value), TaskContext.get().partitionId(), 0
        own: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal own, ids, size, nth
            whole = np.concatenate(ids)
            row = [part], [nth], [len(own)], [size], [write_file(own, [len(x) for x in ids], whole)]
            own, ids, size, nth = [], [], 0, nth + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, _FILE.types, strict=True)], schema=_FILE)

        for b in batches:
            for doc, x in zip(b.column("doc_id").to_pylist(), bpe.cut(texts(b)), strict=True):
                own.append(doc)
                ids.append(np.append(x, end_id).astype(np.uint32))
                size += len(ids[-1])
                if size >= BLOCK * FILE_BLOCKS:
                    yield close()
        if own:
            yield close()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chars = own.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS))
    placed = own.withColumns({"hash": F.xxhash64(F.coalesce("text", F.lit(""))), "row": F.monotonically_increasing_id()})
    ordered = placed.repartitionByRange(n, "doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash").select("doc_id", "text")
    ordered.mapInArrow(run, "part long, nth long, n_docs long, n_tokens long, data binary").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            doc, lengths, ids = read_file(b.column("data")[k].as_py())
            ids = ids.astype("<u4")
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[e - n : e]) for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
            start = b.column("before")[k].as_py() + ends - lengths
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start), pa.array(lengths), pa.array(crc, pa.int64())], schema=_INDEX)


def index(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, decoded from the files. A file's own start is the sum of the files before it:
    one small row for each of them (up to 4 million ids)."""
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "nth", "n_tokens").withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).drop("n_tokens")
    return files.select("part", "nth", "data").join(starts, ["part", "nth"]).select("before", "data").mapInArrow(_index, "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed(docs: DataFrame, vocabulary: str) -> DataFrame:
    return index(write(docs, vocabulary, shared.scratch(docs.sparkSession, "ids")))

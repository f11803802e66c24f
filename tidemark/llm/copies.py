"""Operator 12: exact copies by a minimal perfect hash over the distinct digests of history.

An index of history is a table of shards, each a minimal perfect hash of about SHARD digests: levels of bits, where a digest
takes the place that it alone hits on a level and goes to the next level otherwise; its slot is the number of bits before
its own. Slots hold the whole digest, the locator of the winner (the row with the largest doc_id) and the number of copies.
New rows are folded batch by batch, sent to their shard and looked up there: the slot's digest is compared byte by byte, a
repeat updates the slot, anything else isn't in history and is grouped separately. Only classes that changed or have
several rows are joined back to the rows.

Memory: a shard's slots in a task (about 60 kB) and one batch of lookups; copies of one text reach a shard as one row for
each batch of rows that holds some, and are joined back by a plain join that Spark splits where it is skewed.

Rows: null text counts as empty; texts are equal when their bytes are; a null doc_id is smaller than any; of repeated rows
with the winning doc_id one is kept; keep_id is null where a class has no doc_id; other columns aren't read; an empty table,
or an empty history, gives an empty result or one without repeats of history.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import shared

from .common import binary, mix

SHARD, SPREAD, LEVELS, WIDTH = 1_024, 2, 40, 32

SQL = """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
     n as (select *, row_number() over (partition by text_sha256 order by doc_id desc nulls last) as nth, count(*) over (partition by text_sha256) as group_size,
                  max(doc_id) over (partition by text_sha256) as keep_id from d)
select doc_id, keep_id, group_size, nth = 1 as kept, text_sha256 from n
"""


class PerfectHash:
    """Levels of bits over rows of 32 bytes; slots 0 to n - 1. Rows that no level separates are listed at the end."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.before = [np.concatenate([[0], np.cumsum(np.bitwise_count(x))]) for x in levels]
        sizes = [int(b[-1]) for b in self.before]
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @staticmethod
    def _place(digests: np.ndarray, level: int, bits: int) -> np.ndarray:
        w = np.ascontiguousarray(digests).view(np.uint64)
        with np.errstate(over="ignore"):
            return mix(w[:, 1] ^ mix(w[:, 2] + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))) % np.uint64(bits)

    @classmethod
    def of(cls, digests: np.ndarray) -> PerfectHash:
        """digests: distinct rows."""
        levels: list[np.ndarray] = []
        rest = digests
        while len(rest) and len(levels) < LEVELS:
            bits = -(-max(SPREAD * len(rest), 64) // 64) * 64
            place = cls._place(rest, len(levels), bits)
            hits = np.bincount(place.astype(np.int64), minlength=bits)
            levels.append(np.packbits(hits == 1, bitorder="little").view(np.uint64))
            rest = rest[hits[place.astype(np.int64)] > 1]
        return cls(levels, rest)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for each row: its own for a row that is in, any or -1 for another."""
        out, left = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for k, words in enumerate(self.levels):
            if not len(left):
                break
            place = self._place(digests[left], k, 64 * len(words))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (words[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.base[k] + self.before[k][word] + below)[hit]
            left = left[~hit]
        if len(self.rest) and len(left):
            known = {x.tobytes(): int(self.base[-1]) + i for i, x in enumerate(self.rest)}
            out[left] = [known.get(digests[i].tobytes(), -1) for i in left]
        return out

    def blob(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels), len(self.rest)], np.int64)
        return head.tobytes() + b"".join(x.tobytes() for x in self.levels) + self.rest.tobytes()

    @classmethod
    def read(cls, blob: bytes) -> PerfectHash:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        sizes = np.frombuffer(blob, np.int64, n, 8)
        at, levels = 8 * (n + 2), []
        for s in sizes:
            levels.append(np.frombuffer(blob, np.uint64, s, at))
            at += 8 * int(s)
        return cls(levels, np.frombuffer(blob, np.uint8, offset=at).reshape(-1, WIDTH))


class Winners:
    """Locators (whether there is a doc_id, it, the row) and numbers of copies, by slot."""

    kinds = (np.int8, np.int64, np.int64, np.int64)

    def __init__(self, columns: list[np.ndarray]):
        self.has, self.doc, self.row, self.size = columns

    def columns(self) -> list[np.ndarray]:
        return [self.has, self.doc, self.row, self.size]

    def add(self, slot: np.ndarray, new: list[np.ndarray]) -> None:
        """Of a slot's own and new locators the largest stays; copies add up. There may be no new ones."""
        if not len(slot):
            return
        has, doc, row, size = new
        np.add.at(self.size, slot, size)
        here = np.unique(slot)
        all_slots = np.concatenate([here, slot])
        parts = [np.concatenate([own[here], x]) for own, x in ((self.has, has), (self.doc, doc), (self.row, row))]
        order = np.lexsort((parts[2], parts[1], parts[0], all_slots))
        last = order[np.flatnonzero(np.append(all_slots[order][1:] != all_slots[order][:-1], True))]
        for own, x in zip((self.has, self.doc, self.row), parts, strict=True):
            own[all_slots[last]] = x[last]


_LOCATORS = ["has", "doc", "row", "size"]
_TYPES = "digest binary, has byte, doc long, row long, size long"


def _locators(b: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
    return [b.column(n).to_numpy(zero_copy_only=False).astype(k) if isinstance(b, pa.RecordBatch) else b.column(n).to_numpy().astype(k) for n, k in zip(_LOCATORS, Winners.kinds, strict=True)]


def _out(digests: np.ndarray, columns: list[np.ndarray], known: np.ndarray) -> pa.RecordBatch:
    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(digests), [None, pa.py_buffer(np.ascontiguousarray(digests).tobytes())])
    return pa.RecordBatch.from_arrays([raw.cast(pa.binary()), *map(pa.array, columns), pa.array(known)], ["digest", *_LOCATORS, "known"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of batches with one shard each."""
    for b in batches:
        if b.num_rows:
            k = b.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                yield int(k[s]), b.slice(s, e - s)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shard from rows sorted by shard; each digest comes once."""

    def close(shard: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        digests = binary(t.column("digest"))
        table = PerfectHash.of(digests)
        to = np.argsort(table.slots(digests))
        blobs = [table.blob(), digests[to].tobytes(), *(x[to].tobytes() for x in _locators(t))]
        return pa.RecordBatch.from_arrays([pa.array([shard]), *(pa.array([x], pa.binary()) for x in blobs)], ["shard", "hash", "digests", *_LOCATORS])

    held: list[pa.RecordBatch] = []
    last = None
    for shard, b in _runs(batches):
        if held and shard != last:
            yield close(last, held)
            held = []
        held.append(b)
        last = shard
    if held:
        yield close(last, held)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each batch by digest, so that a frequent text is sent once a batch."""
    for b in batches:
        if b.num_rows:
            digests = binary(b.column("digest"))
            _, first, slot = np.unique(digests.view(f"V{WIDTH}").ravel(), return_index=True, return_inverse=True)
            fold = Winners([np.full(len(first), -1, np.int8), *(np.zeros(len(first), np.int64) for _ in range(3))])
            fold.add(slot, _locators(b))
            yield _out(digests[first], fold.columns(), np.zeros(len(first), bool))


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, the shard's index first. Gives changed slots (known), and rows that are in no slot."""
    shard, table, digests, own, touched = None, None, np.zeros((0, WIDTH), np.uint8), None, np.zeros(0, bool)

    def changed() -> Iterator[pa.RecordBatch]:
        if touched.any():
            yield _out(digests[touched], [x[touched] for x in own.columns()], np.ones(int(touched.sum()), bool))

    for k, b in _runs(batches):
        if k != shard:
            yield from changed()
            shard, table, touched = k, None, np.zeros(0, bool)
        if b.column("hash")[0].is_valid:
            table = PerfectHash.read(b.column("hash")[0].as_py())
            digests = np.frombuffer(b.column("digests")[0].as_py(), np.uint8).reshape(-1, WIDTH)
            own = Winners([np.frombuffer(b.column(f"slot_{n}")[0].as_py(), t).copy() for n, t in zip(_LOCATORS, Winners.kinds, strict=True)])
            touched = own.size > 1  # classes of several rows are told whether new rows belong to them or not
            b = b.slice(1)
            if not b.num_rows:
                continue
        asked, new = binary(b.column("digest")), _locators(b)
        if table is None:
            yield _out(asked, new, np.zeros(len(asked), bool))
            continue
        slot = table.slots(asked)
        member = slot >= 0
        member[member] = (digests[slot[member]] == asked[member]).all(1)
        own.add(slot[member], [x[member] for x in new])
        touched[slot[member]] = True
        if not member.all():
            yield _out(asked[~member], [x[~member] for x in new], np.zeros(int((~member).sum()), bool))
    yield from changed()


def digests(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """(digest, has, doc, row, size, old) of each row: the SHA-256 of its text in UTF-8, its locator, whether it is history."""
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("digest")
    doc, is_old = F.col("doc_id").cast("long"), F.lit(False) if old is None else F.coalesce(old, F.lit(False))
    return docs.select(digest, doc.isNotNull().cast("byte").alias("has"), F.coalesce(doc, F.lit(0)).alias("doc"), F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("size"), is_old.alias("old"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


class Index:
    """The shards as a table of the shared folder, and how many there are."""

    def __init__(self, table: DataFrame, shards: int):
        self.table, self.shards = table, shards

    @classmethod
    def of(cls, history: DataFrame) -> Index:
        """From rows of digests(): one row of each digest wins."""
        top = F.max(F.struct("has", "doc", "row")).alias("top")
        distinct = shared.written(history.groupBy("digest").agg(top, F.sum("size").alias("size")).select("digest", "top.*", "size"), "history")
        shards = max(1, -(-distinct.count() // SHARD))
        rows = distinct.withColumn("shard", _shard(shards)).repartition("shard").sortWithinPartitions("shard")
        return cls(shared.written(rows.mapInArrow(_build, "shard long, hash binary, digests binary, has binary, doc binary, row binary, size binary"), "shards"), shards)

    def look_up(self, new: DataFrame) -> DataFrame:
        """Classes (digest, has, doc, row, size) that have several rows of history and new ones together, or a single new one."""
        folded = new.select("digest", *_LOCATORS).mapInArrow(_fold, f"{_TYPES}, known boolean").drop("known")
        asked = folded.withColumn("shard", _shard(self.shards))
        slots = self.table.select("shard", "hash", "digests", *[F.col(n).alias(f"slot_{n}") for n in _LOCATORS])
        both = slots.unionByName(asked, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", F.col("hash").isNull())
        found = shared.written(both.mapInArrow(_look_up, f"{_TYPES}, known boolean"), "lookups")
        top = F.max(F.struct("has", "doc", "row")).alias("top")
        strange = found.where("not known").groupBy("digest").agg(top, F.sum("size").alias("size")).select("digest", "top.*", "size")
        return found.where("known").drop("known").unionByName(strange)


def exact_copies(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256. old: which rows are history, whose index the
    others are looked up in; by default those whose doc_id has an even hash. The result is the same whatever it says."""
    even = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2)) == 0
    rows = shared.written(digests(docs, even if old is None else old), "digests")
    index = Index.of(rows.where("old"))
    classes = shared.written(index.look_up(rows.where("not old")).where("size > 1"), "classes")
    named = classes.select("digest", F.when(F.col("has") == 1, F.col("doc")).alias("keep_id"), F.col("row").alias("keep_row"), F.col("size").alias("group_size"))
    doc = F.when(F.col("has") == 1, F.col("doc"))
    single = F.col("group_size").isNull()
    return rows.join(named, "digest", "left").select(
        doc.alias("doc_id"), F.when(single, doc).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )

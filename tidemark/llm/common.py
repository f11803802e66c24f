"""What several operators share: session set-up, hashing, streaming over sorted groups, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import shared

ROOT = str(Path(__file__).resolve().parents[2])
WORD_CACHE = 300_000
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def prepare(spark: SparkSession) -> None:
    """Executors import this package from the same place, and checkpoint() has a shared folder."""
    sc = spark.sparkContext
    here = sc.environment.get("PYTHONPATH", "")
    if ROOT not in here.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, here) if x)
    if not spark.conf.get("spark.checkpoint.dir", None) and sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(f"{shared.folder(spark)}/{uuid.uuid4().hex}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHash(dict):
    """64-bit hashes of words, kept for the next use; bounded."""

    def __missing__(self, word) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * M1
        x = (x ^ (x >> np.uint64(33))) * M2
    return x ^ (x >> np.uint64(33))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in batch.column(name).to_pylist()]


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column of df has (case doesn't tell names apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(docs: list[str], chars: int) -> Iterator[list[str]]:
    """Consecutive texts of so many characters in all, or a single longer one."""
    start, size = 0, 0
    for k, x in enumerate(docs):
        if size and size + len(x) > chars:
            yield docs[start:k]
            start, size = k, 0
        size += len(x)
    if start < len(docs):
        yield docs[start:]


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows with equal consecutive keys, from batches of a partition that is sorted by the key."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if held and k[s] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = k[s]
    if held:
        yield pa.Table.from_batches(held)


def binary(column) -> np.ndarray:
    """Fixed-width binary values as a matrix of bytes; none may be null."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest row that each row reaches."""
    n = len(linked)
    root = np.arange(n)
    near = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(near, root[None, :], n).min(1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def block_pairs(df: DataFrame, key: str, size: str, member: str, block: int) -> DataFrame:
    """Deals a group out over tasks of at most two blocks, so that each pair of members meets in one of them.

    Adds `task` (a hash of group and block pair), `side` (the row's block) and `lo`, `hi` (the pair of blocks; equal:
    all pairs within it count, else only those across). Groups of up to `block` rows stay whole.
    """
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    side = F.pmod(F.xxhash64(F.lit(7), F.col(member)), F.col("_n")).cast("int")
    return (
        df.withColumn("_n", n)
        .withColumn("side", side)
        .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("lo", F.least("side", "_j"))
        .withColumn("hi", F.greatest("side", "_j"))
        .withColumn("task", F.xxhash64(key, "lo", "hi"))
        .drop("_n", "_j")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each id of the edges (u, v): the smallest id that it reaches.

    Alternates large-star and small-star rounds; each round is a few joins and min() aggregates, whose hubs are
    pre-aggregated or split by the skew join, and ends in a checkpoint. Ids never come to the driver, only a count and
    a checksum of the edges.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct().checkpoint()
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        e = large.join(least, "u").select(F.inline(pairs)).where("u != v").distinct().checkpoint()
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).groupBy("id").agg(F.min("component").alias("component"))

"""Operator 2: n-gram Jaccard join by chosen paths.

Sets are the distinct five-word shingles of a text (white-space words, lower case; a text of one to four words is one
shingle; a text without words has no set and links with nothing). Equal sets fold into one class first. Each class then
walks down random paths: a node picks coordinates of a min-hash embedding with probability 1 / (threshold * t), so
similar sets choose the same shared tokens, and its bucket splits by the value there. Buckets of up to BUCKET classes are
compared whole (by their embeddings), larger ones split again; the limit is eight times as large after each split, and
what remains after DEPTH of them is compared whole as well, large buckets in tasks of two blocks. Runs are repeated until
a pair at the threshold is found with the target recall. Whatever the buckets connect is then verified: each candidate group's shingle sets meet once, in tasks of at most two blocks, and all
pairs in it are counted exactly, so no pair is emitted as a row.

A class is known by a number of its own, not by a doc_id, so rows that share a doc_id are classed by their texts, and rows
without one like others.

Rows: null text counts as empty; repeated rows are copies; the class_id of a group without any doc_id is null. Other columns
pass by unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import shared

from .common import WordHash, binary, block_pairs, components, free_name, groups, local_roots, mix

WORDS, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.9995
T, BUCKET, DEPTH, BLOCK = 64, 256, 4, 256
#: A path with more than this part of a level's rows is hot; there are fewer than HOT_PATHS of them at any size.
HOT_PATHS = 2000
#: Share of equal coordinates that makes a pair of a bucket a candidate: four standard deviations under THRESHOLD.
LIKELY = THRESHOLD - 4 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / T)
_hash = WordHash()
_step = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_odd = mix(np.arange(1, T + 1, dtype=np.uint64)) | np.uint64(1)


def runs_for(recall: float, threshold: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a bucket of that depth, and passed for LIKELY there, with the
    given recall. How many of the T coordinates such a pair shares is a matter of chance, and pairs that share few are
    found less often, so the recall is that of the mean over these numbers."""
    share = [(n, math.comb(T, n) * threshold**n * (1 - threshold) ** (T - n)) for n in range(math.ceil(LIKELY * T), T + 1)]
    met = []
    for n, _ in share:
        p = 1.0
        for _ in range(depth):  # a node has Poisson(1 / threshold) children, of which the pair shares n in T
            p = 1 - math.exp(-p * n / T / threshold)
        met.append(p)
    runs = 1
    while sum(w * (1 - (1 - p) ** runs) for (_, w), p in zip(share, met, strict=True)) < recall:
        if runs == 1000:
            raise ValueError(f"no number of runs has a recall of {recall}")
        runs += 1
    return runs


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = _hash.of(words)
    n = min(n, len(h))
    with np.errstate(over="ignore"):
        x = sum((h[k : len(h) - n + 1 + k] * _step[k] for k in range(n)), np.uint64(n))
    return np.unique(mix(x))


def embedding(s: np.ndarray) -> np.ndarray:
    """T min-hashes of a set."""
    low = np.full(T, np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 2048):
            np.minimum(low, (s[i : i + 2048, None] * _odd).min(0), out=low)
    return low


def _chosen(path: np.ndarray) -> np.ndarray:
    """Which coordinates the nodes at these paths split on: a boolean row for each."""
    with np.errstate(over="ignore"):
        h = mix(path[:, None] + np.arange(1, T + 1, dtype=np.uint64) * _step[0])
    return h < np.uint64(int(2**64 / (THRESHOLD * T)))


def _child(path: np.ndarray, i: np.ndarray, value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(path * _step[1] + i.astype(np.uint64)) + value.astype(np.uint64))


def _roots(runs: int) -> list[tuple[int, int]]:
    at = mix(np.arange(1, runs + 1, dtype=np.uint64) * _step[2])
    return [(int(at[r]), int(i)) for r, row in enumerate(_chosen(at)) for i in np.flatnonzero(row)]


def _sketches(runs: int):
    roots = _roots(runs)
    path, coord = np.array([r for r, _ in roots], np.uint64), np.array([i for _, i in roots], np.int64)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.binary()), ("sig", pa.binary()), ("paths", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sigs, paths = [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text or "")
                if not len(s):
                    keys.append(None), sigs.append(None), paths.append([])
                    continue
                low = embedding(s)
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                sigs.append((mix(low) >> np.uint64(56)).astype(np.uint8).tobytes())  # of the smallest values themselves the high bits are all but equal
                paths.append(_child(path, coord, low[coord]).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(paths, pa.list_(pa.int64()))], schema=schema)

    return sketch


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, rep, sig) of a large bucket go on to its children."""
    for b in batches:
        if not b.num_rows:
            continue
        path, sig = b.column("path").to_numpy().view(np.uint64), binary(b.column("sig"))
        row, i = np.nonzero(_chosen(path))
        child = _child(path[row], i, sig[row, i]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(child), b.column("rep").take(pa.array(row)), b.column("sig").take(pa.array(row))], ["path", "rep", "sig"])


def _sized(level: DataFrame) -> DataFrame:
    """The rows (path, rep, sig) whose path has others too, and n, how many it has. Rows of hot paths stay where they are,
    since so few counts are broadcast; the others are shuffled by their path, and no task gets many of one."""
    many = level.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").checkpoint()
    share = level.count() / HOT_PATHS
    hot, others = F.broadcast(many.where(F.col("n") > share)), many.where(F.col("n") <= share)
    return level.join(hot, "path").unionByName(level.join(hot, "path", "left_anti").join(others, "path"))


def agreement(sig: np.ndarray) -> np.ndarray:
    """How many coordinates each pair of rows shares, some rows at a time."""
    step = max(1, 16_000_000 // sig.size)
    return np.concatenate([(sig[i : i + step, None, :] == sig[None, :, :]).sum(2, dtype=np.uint16) for i in range(0, len(sig), step)])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of each task by their embeddings: (member, smallest member that it may be linked to)."""
    edges: list[np.ndarray] = []
    size = 0

    def distinct() -> pa.RecordBatch:  # a pair meets in many buckets
        e = np.unique(np.concatenate(edges), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["u", "v"])

    for g in groups(batches, "task"):
        sig, rep = binary(g.column("sig")), g.column("rep").to_numpy()
        order = np.argsort(rep)
        root = order[local_roots((agreement(sig) >= LIKELY * T)[np.ix_(order, order)])]
        other = rep[order] != rep[root]
        edges.append(np.stack([rep[order][other], rep[root][other]], 1))
        size += len(edges[-1])
        if size > 500_000:
            yield distinct()
            edges, size = [], 0
    if size:
        yield distinct()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of candidates, once a batch; rows whose text isn't the class's own go."""
    for b in batches:
        _, first = np.unique(np.array(b.column("rep").to_numpy()), return_index=True)
        if len(first) < b.num_rows and len(set(zip(b.column("rep").to_pylist(), b.column("text_hash").to_pylist(), strict=True))) == len(first):
            b = b.take(pa.array(np.sort(first)))
        s = [shingles(x or "") for x in b.column("text").to_pylist()]
        own = [xxhash.xxh3_128_digest(x.tobytes()) == k for x, k in zip(s, b.column("key").to_pylist(), strict=True)]
        out = b.select(["rep", "copies", "component", "members"]).append_column("set", pa.array([x.tobytes() for x in s], pa.binary()))
        yield out.filter(pa.array(own))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over slices of the universe."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    _, col, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    shared = many > 1  # others meet in no pair
    rank = np.cumsum(shared) - 1
    keep = shared[col]
    row, col = row[keep], rank[col[keep]]
    out = np.zeros((n, n), np.float64)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = 4096
    cuts = np.searchsorted(col, np.arange(0, (col[-1] + 1 if len(col) else 0) + width, width))
    for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
        m = np.zeros((n, min(width, int(col[e - 1]) + 1 - k * width) if e > s else 1), np.float32)
        m[row[s:e], col[s:e] - k * width] = 1
        out += m @ m.T
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact Jaccard similarity of all pairs of a task: links of each class, and the smallest class that it reaches."""
    for g in groups(batches, "task"):
        rep, first = np.unique(g.column("rep").to_numpy(), return_index=True)
        copies, side = g.column("copies").to_numpy()[first], g.column("side").to_numpy()[first]
        raw = g.column("set").to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in first]
        both, size = overlaps(sets), np.array([len(s) for s in sets])
        linked = both >= THRESHOLD * (size[:, None] + size[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if g.column("lo")[0].as_py() != g.column("hi")[0].as_py():
            linked &= side[:, None] != side[None, :]
        links = linked @ copies
        has = links > 0
        if has.any():
            yield pa.RecordBatch.from_arrays([pa.array(rep[has]), pa.array(links[has].astype(np.int64)), pa.array(rep[local_roots(linked)][has])], ["rep", "links", "root"])


def _classed(docs: DataFrame, target_recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows of docs as (doc_id, text_hash, key), and the classes: key, low (whether it has no doc_id, the smallest, and the
    hash of that row's text), component, links and copies."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_hash(docs))
    base = own.mapInArrow(_sketches(runs_for(target_recall, THRESHOLD)), "doc_id long, text_hash long, key binary, sig binary, paths array<long>").checkpoint()
    folded = base.where("key is not null").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("low"), F.count("*").alias("copies"), F.first(F.struct("sig", "paths")).alias("s"))
    classes = shared.written(folded.withColumn("rep", F.monotonically_increasing_id()), "classes")
    level = classes.where("size(s.paths) > 0").select(F.explode("s.paths").alias("path"), "rep", F.col("s.sig").alias("sig"))
    edges = []
    for depth in range(1, DEPTH + 1):
        limit = BUCKET * 8 ** (depth - 1)  # what stays large after a split is alike, and splits on to little avail
        rows = _sized(level)
        small = rows.where(f"n <= {limit}") if depth < DEPTH else rows
        tasks = block_pairs(small, "path", "n", "rep", BUCKET if depth == 1 else 4 * BUCKET).select("task", "rep", "sig")
        edges.append(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_compare, "u long, v long"))
        if depth < DEPTH:
            level = rows.where(f"n > {limit}").select("path", "rep", "sig").mapInArrow(_split, "path long, rep long, sig binary").distinct().checkpoint()
            if level.isEmpty():
                break
    found = edges[0]
    for e in edges[1:]:
        found = found.union(e)
    member = components(found)
    sizes = member.groupBy("component").agg(F.count("*").alias("members"))
    of_rep = classes.select("rep", "key", "copies", F.col("low.doc_id").alias("of"), F.col("low.text_hash").alias("hash"))
    wanted = member.join(sizes, "component").select(F.col("id").alias("rep"), "component", "members").join(of_rep, "rep")
    # a class is fetched by its row's doc_id and text together: an id that many texts share brings each of them once
    fetched = own.join(wanted, (own.text_hash == wanted["hash"]) & own.doc_id.eqNullSafe(wanted.of))
    sets = fetched.select("rep", "text_hash", "key", "copies", "component", "members", "text").mapInArrow(_sets, "rep long, copies long, component long, members long, set binary")
    dealt = block_pairs(sets, "component", "members", "rep", BLOCK).select("task", "rep", "copies", "side", "lo", "hi", "set")
    links = dealt.repartition("task").sortWithinPartitions("task").mapInArrow(_verify, "rep long, links long, root long").checkpoint()
    classed = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v"))).withColumnRenamed("id", "rep")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.select("key", "rep", "low", "copies").join(counted, "rep", "left").join(classed, "rep", "left")
    return base.select("doc_id", "text_hash", "key"), known.select("key", "low", "copies", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))


def text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")


def near_copies(docs: DataFrame, target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, class_id (the smallest doc_id that it reaches by links), n_links
    (other rows at a Jaccard similarity of at least THRESHOLD) and n_copies (other rows with an equal set)."""
    rows, classes = _classed(docs, target_recall)
    least = classes.groupBy("component").agg(F.min("low.doc_id").alias("class_id"))
    of = classes.join(least, "component").select("key", "class_id", "links", (F.col("copies") - 1).alias("n_copies"))
    return rows.join(of, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("n_copies"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(0)).cast("long").alias("n_copies"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class with all its columns, that with the smallest doc_id (none is larger than any); of rows with the
    same doc_id and text, one. Rows without words stay, but for such repeats with a doc_id."""
    rows, classes = _classed(docs, TARGET_RECALL)
    wordless = rows.where("key is null").select("doc_id", "text_hash").distinct()
    winners = classes.groupBy("component").agg(F.min("low").alias("low")).select("low.doc_id", "low.text_hash")
    kept = winners.withColumn("words", F.lit(True)).unionByName(wordless.withColumn("words", F.lit(False)))
    id_, hash_, nth_, of_, as_, words_ = (free_name(docs, n) for n in ("_id", "_hash", "_nth", "_of", "_as", "_words"))
    named = kept.select(F.col("doc_id").alias(of_), F.col("text_hash").alias(as_), F.col("words").alias(words_))
    same = Window.partitionBy(id_, hash_).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith(("map", "variant"))]))
    own = docs.withColumns({id_: F.col("doc_id").cast("long"), hash_: text_hash(docs)})
    found = own.join(named, (F.col(hash_) == F.col(as_)) & F.col(id_).eqNullSafe(F.col(of_)))
    loose = F.col(id_).isNull() & ~F.col(words_)
    one = found.where(~loose).withColumn(nth_, F.row_number().over(same)).where(F.col(nth_) == 1)
    return one.select(*docs.columns).unionByName(found.where(loose).select(*docs.columns))

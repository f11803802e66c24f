"""Operator 13: hard negatives by exact integer inner products of tiles.

Components are quantised to integers. Anchors and candidates are dealt into blocks by a hash, and each pair of an anchor
block and a candidate block is one task's tile, whose scores come from Strassen's recursion on 64-bit integers: sides are
padded with zeros to even lengths, halves are added and subtracted exactly (in the ring modulo 2 ** 64, so that sums on the
way may wrap), and blocks of at most LEAF on a side are multiplied plainly. Each tile gives an anchor's first rows only, and
these heaps merge: first the best rows of the same label over all tiles, then, by their scores, the best rows of other labels
within each positive's window. In the first pass only sub-tiles of one label are multiplied.

Work is anchors times rows, as the contract has it; a task holds ANCHORS and CANDIDATES rows at most (times the unevenness of
a hash) and the scores of ROWS anchors. Rows that all have one label, or are all alike, change nothing in that.

Rows: those with a null label, a null or empty vector, a component that is null or not finite, or a sum of squares (after
quantising) of 2 ** 62 or more, whose products 64 bits can't hold, take no part. Vectors of different lengths don't meet.
Repeated rows are rows of their own. Null vec_ids are no anchors and come last in ties. Other columns aren't read. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import shared

from .common import groups

ANCHOR_EVERY, RELABEL_EVERY, SCALE, POSITIVES, NEGATIVES, LOW_PERCENT = 100, 7, 256, 5, 5, 80
ANCHORS, CANDIDATES, ROWS, LEAF = 2_048, 8_192, 256, 32
NO_ID = np.iinfo(np.int64).max

SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q,
                  case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
           from embeddings
           where label is not null and embedding is not null and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))),
     s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as alike,
                  list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
           from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
     p as (select anchor_id, vec_id as positive_id, score as positive_score from s where alike
           qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
     n as (select anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
                  row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id) as nth
           from p join s using (anchor_id)
           where not s.alike and 80 * positive_score <= 100 * s.score and s.score <= positive_score)
select anchor_id, positive_id, nth::int as rank, negative_id, positive_score, negative_score from n where nth <= 5
"""


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The quarters of a matrix, padded with zeros to even sides."""
    m, n = x.shape
    x = np.pad(x, ((0, m % 2), (0, n % 2))) if m % 2 or n % 2 else x
    m, n = x.shape[0] // 2, x.shape[1] // 2
    return x[:m, :n], x[:m, n:], x[m:, :n], x[m:, n:]


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a times b transposed, by Strassen's recursion; int64, exact where the result fits."""
    m, n = len(a), len(b)
    if min(m, n, a.shape[1]) <= leaf:
        return np.ascontiguousarray(a) @ np.ascontiguousarray(b).T
    a11, a12, a21, a22 = _halves(a)
    b11, b21, b12, b22 = _halves(b)  # b is given transposed
    p1, p2, p3, p4 = product(a11 + a22, b11 + b22, leaf), product(a21 + a22, b11, leaf), product(a11, b12 - b22, leaf), product(a22, b21 - b11, leaf)
    p5, p6, p7 = product(a11 + a12, b22, leaf), product(a21 - a11, b11 + b12, leaf), product(a12 - a22, b21 + b22, leaf)
    h, w = p1.shape
    out = np.empty((2 * h, 2 * w), np.int64)
    out[:h, :w], out[:h, w:], out[h:, :w], out[h:, w:] = p1 + p4 - p5 + p7, p3 + p5, p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def first_of_rows(row: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k entries of each row: higher scores first, then smaller ties."""
    order = np.lexsort((tie, -score, row))
    sorted_row = row[order]
    start = np.flatnonzero(np.append(True, sorted_row[1:] != sorted_row[:-1])) if len(order) else np.zeros(0, np.int64)
    nth = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[nth < k]


class Tile:
    """The rows of a task: quantised vectors, labels, ids, row numbers; anchors with their windows in the second pass."""

    def __init__(self, t: pa.Table):
        d = t.column("d")[0].as_py()
        x = np.frombuffer(b"".join(t.column("vector").to_pylist()), np.int64).reshape(-1, d)
        side = t.column("is_anchor").to_numpy()
        label, ids, row = (t.column(n).to_numpy() for n in ("label", "tie", "row"))
        at = np.flatnonzero(~side)
        at = at[np.lexsort((ids[at], label[at]))]
        self.x, self.label, self.ids, self.row = x[at], label[at], ids[at], row[at]
        at = np.flatnonzero(side)
        at = at[np.argsort(label[at], kind="stable")]
        self.ax, self.alabel, self.arow = x[at], label[at], row[at]
        self.windows = [t.column("windows")[i].as_py() for i in at.tolist()]

    def label_runs(self, start: int, end: int) -> Iterator[slice]:
        """The anchors from start to end by label."""
        label = self.alabel[start:end]
        cuts = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), len(label)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            yield slice(start + s, start + e)

    def same_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]).tolist())


def _positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor row, vec_id, score, row) of the best rows of an anchor's label in each tile."""
    for g in groups(batches, "task"):
        t = Tile(g.combine_chunks())
        for block in (b for s in range(0, len(t.ax), ROWS) for b in t.label_runs(s, s + ROWS)):
            own = t.same_label(int(t.alabel[block.start]))
            if own.start == own.stop:
                continue
            score = product(t.ax[block], t.x[own])
            other = t.arow[block][:, None] != t.row[own][None, :]
            if score.shape[1] > POSITIVES + 1:  # the anchor itself may be among the rows
                other &= score >= np.partition(score, -POSITIVES - 1, axis=1)[:, [-POSITIVES - 1]]
            i, j = np.nonzero(other)
            best = first_of_rows(i, score[i, j], t.ids[own][j], POSITIVES)
            i, j = i[best], j[best]
            yield pa.RecordBatch.from_arrays([pa.array(t.arow[block][i]), pa.array(t.ids[own][j]), pa.array(score[i, j]), pa.array(t.row[own][j])], ["anchor", "tie", "score", "row"])


def _negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor row, number of its positive, vec_id, score, row) of the best rows of other labels in each window of a tile."""
    for g in groups(batches, "task"):
        t = Tile(g.combine_chunks())
        for start in range(0, len(t.ax) if len(t.x) else 0, ROWS):
            block = slice(start, start + ROWS)
            score = product(t.ax[block], t.x)
            most = max(len(w) for w in t.windows[block])
            highs = np.array([[w[k] if k < len(w) else -1 for k in range(most)] for w in t.windows[block]], np.int64)
            lows = np.array([[-(-LOW_PERCENT * w[k] // 100) if k < len(w) else 0 for k in range(most)] for w in t.windows[block]], np.int64)
            bottom = np.where(highs >= 0, lows, NO_ID).min(1)
            may = (score >= bottom[:, None]) & (score <= highs.max(1)[:, None])
            for run in t.label_runs(start, start + ROWS):
                may[run.start - start : run.stop - start, t.same_label(int(t.alabel[run.start]))] = False
            i, j = np.nonzero(may)
            s = score[i, j]
            for k in range(most):
                within = np.flatnonzero((s >= lows[i, k]) & (s <= highs[i, k]))
                best = within[first_of_rows(i[within], s[within], t.ids[j[within]], NEGATIVES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.arow[block][i[best]]), pa.array(np.full(len(best), k, np.int32)), pa.array(t.ids[j[best]]), pa.array(s[best]), pa.array(t.row[j[best]])], ["anchor", "nth", "tie", "score", "row"]
                )


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = b.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
        blobs = np.full(len(sizes), None, object)
        for width in np.unique(sizes):
            at = np.flatnonzero(sizes == width)
            x = np.floor(SCALE * b.column("embedding").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width))
            with np.errstate(over="ignore"):
                fits = (x * x).sum(1) < 2.0**62
            for i, v in zip(at[fits].tolist(), x[fits].astype(np.int64), strict=True):
                blobs[i] = v.tobytes()
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(sizes.astype(np.int32)), pa.array(blobs, pa.binary())], ["vec_id", "label", "d", "vector"])


def relabelled(df: DataFrame) -> DataFrame:
    """The contract's labels: every RELABEL_EVERY-th row has the next of ten."""
    label = F.col("label").cast("long")
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % 10).otherwise(label).alias("label"))


def _tasks(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, windows) -> DataFrame:
    """Every anchor block beside every candidate block, each pair with a task of its own; vectors of one length meet."""
    a, c = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))
    block = lambda n: F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    columns = ["row", "tie", "label", "d", "vector"]
    left = anchors.select(*columns, windows.alias("windows"), F.lit(True).alias("is_anchor"), block(a).alias("a"), all_of(c).alias("c"))
    right = rows.select(*columns, F.lit(None).cast("array<long>").alias("windows"), F.lit(False).alias("is_anchor"), all_of(a).alias("a"), block(c).alias("c"))
    tasks = left.unionByName(right).withColumn("task", F.xxhash64("d", "a", "c")).drop("a", "c")
    return tasks.repartition("task").sortWithinPartitions("task")


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "tie", "row")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score from rows (vec_id, embedding, label)."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    own = df.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("embedding"))
    quantised = own.mapInArrow(_quantised, "vec_id long, label long, d int, vector binary").where("vector is not null")
    rows = shared.written(quantised.withColumns({"row": F.monotonically_increasing_id(), "tie": F.coalesce("vec_id", F.lit(int(NO_ID)))}), "rows")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    n_anchors, n_rows = anchors.count(), rows.count()
    found = _tasks(anchors, rows, n_anchors, n_rows, F.lit(None).cast("array<long>")).mapInArrow(_positives, "anchor long, tie long, score long, row long")
    # one small row for each anchor, which the second pass and the result both read
    best = _first(found, POSITIVES, "anchor").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "tie", "score"))).alias("positives"))
    positives = shared.written(best, "positives")
    asked = anchors.join(positives.where(F.exists("positives.score", lambda x: x >= 0)), F.col("row") == F.col("anchor"))
    tiles = _tasks(asked, rows, n_anchors, n_rows, F.col("positives.score"))
    negatives = _first(tiles.mapInArrow(_negatives, "anchor long, nth int, tie long, score long, row long"), NEGATIVES, "anchor", "nth").withColumnsRenamed({"tie": "negative", "row": "negative_row"})
    known = anchors.select("row", F.col("vec_id").alias("anchor_id")).join(positives, F.col("row") == F.col("anchor")).drop("row")
    positive = F.element_at("positives", F.col("nth") + 1)
    name = lambda c: F.when(c != F.lit(int(NO_ID)), c)
    return negatives.join(known, "anchor").select(
        "anchor_id", name(positive["tie"]).alias("positive_id"), F.col("rank").cast("int").alias("rank"), name(F.col("negative")).alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score")
    )

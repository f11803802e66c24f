"""Operator 9: toxicity by a linear-chain conditional random field.

Words of a line form a chain of two labels. A bounded sample of labelled texts (SAMPLE of each label by hash of doc_id, as
far as they fit into SAMPLE_CHARS) gives token labels: words, and families of words with one beginning, that stand in many
different surroundings in toxic texts and next to never in others. The field (hashed features of words and their
beginnings, transitions, a start weight) is trained on all lines of the sample, whole, by the gradients of its likelihood
from forward-backward; texts are then scored by the marginals of all their tokens, which a logistic model turns into one score, and runs of likely tokens are the offending
spans. Every text is scored whole, in the task that reads it, a slice of texts at a time; weights (one table of BUCKETS
floats) go out with the tasks. Training is in the driver and costs the same whatever the corpus.

Rows: null text has no words and gets the score of that; labels for no document or with a null label are not used;
repeated rows get equal scores; texts of any length are scored whole; without any labels of both kinds the score is the
share of toxic labels, or 0; an empty table gives an empty result. Only `text` is an input of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

BUCKETS, BEGINNINGS = 1 << 18, (3, 4, 5, 6)
EPOCHS, RATE, RIDGE = 60, 0.15, 1e-4
SEEN, RATIO = 3, 12.0
#: Lines without toxic tokens weigh together as much as so many times those with some, and so many more, at most.
PLAIN, PLAIN_LEAST = 2, 500
#: The one bound on what is learnt from: so many rows of each label, and so many characters of them together.
SAMPLE, SAMPLE_CHARS = 600, 6_000_000
#: A task holds the words of so many characters, numbers of the messages, and known words at a time.
SLICE_CHARS, CELLS, WORD_CACHE = 500_000, 1 << 18, 100_000
_letters = re.compile(r"[^\W\d_]+")
_word = re.compile(r"\S+")


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def normal(word: str) -> str:
    """The longest run of letters, in lower case."""
    return max(_letters.findall(word.lower()), key=len, default="")


def bucket(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % BUCKETS


def hashed(word: str) -> list[int]:
    w = normal(word)
    return [bucket(k) for k in ([f"w {w}", *[f"{k} {w[:k]}" for k in BEGINNINGS if len(w) >= k]] if w else ["none"])]


@dataclass
class Field:
    weights: np.ndarray  # of features, for the toxic label
    step: np.ndarray  # log weights of transitions [from, to]
    start: float
    final: tuple[float, ...]  # of the document score: bias, strongest token, sum, share
    base: float | None = None  # without both labels, this is every score
    known: dict = field(default_factory=dict)
    begins: dict = field(default_factory=dict)

    def begin(self, part: str) -> float:
        if len(self.begins) > WORD_CACHE:
            self.begins.clear()
        self.begins[part] = x = float(self.weights[bucket(f"{len(part)} {part}")])
        return x

    def emission(self, word: str) -> float:
        w = normal(word)
        if not w:
            return float(self.weights[bucket("none")])
        x, begins = float(self.weights[bucket(f"w {w}")]), self.begins
        for k in BEGINNINGS:
            if len(w) < k:
                break
            part = begins.get(w[:k])
            x += self.begin(w[:k]) if part is None else part
        return x

    def emissions(self, words: list[str]) -> np.ndarray:
        """The sum of each word's weights; those of words and of their beginnings are kept for the next use, bounded."""
        known = self.known
        out = np.fromiter(map(known.get, words, repeat(math.nan)), float, len(words))
        for i in np.flatnonzero(np.isnan(out)).tolist():
            x = known.get(words[i])
            if x is None:
                if len(known) > WORD_CACHE:
                    known.clear()
                known[words[i]] = x = self.emission(words[i])
            out[i] = x
        return out


def odds(e: np.ndarray, sizes: np.ndarray, step: np.ndarray, start: float, chances: np.ndarray | None = None) -> np.ndarray:
    """Log odds of the toxic label for each token, from the emissions of lines that follow each other: forward and backward
    messages, lines of like length at a time, CELLS numbers at most (but for a single longer line). chances, if given, gets
    for each token but a line's first the chances that it is toxic after a token that isn't, and after one that is."""
    g_all, out = np.exp(np.clip(e, -30, 30)), np.zeros(len(e))
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    (oo, ot), (to, tt) = np.exp(step)
    k = 0
    while k < len(order) and (n := int(sizes[order[k]])):
        some = order[k : k + max(1, CELLS // n)]
        k += len(some)
        size = sizes[some]
        some, size = some[size > 0], size[size > 0]
        lanes = np.searchsorted(-size, -np.arange(n), side="left")  # lines that have a token at this place
        line = np.repeat(np.arange(len(some)), size)
        t_of = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size)
        place = first[some][line] + t_of
        g = np.ones((n, len(some)))
        g[t_of, line] = g_all[place]
        ahead, back = np.empty_like(g), np.ones_like(g)
        ahead[0] = math.exp(start) * g[0]
        for t in range(1, n):
            m = lanes[t]
            r = ahead[t - 1, :m]
            ahead[t, :m] = g[t, :m] * (ot + r * tt) / (oo + r * to)
        for t in range(n - 2, -1, -1):
            m = lanes[t + 1]
            b = g[t + 1, :m] * back[t + 1, :m]
            back[t, :m] = (to + tt * b) / (oo + ot * b)
        out[place] = np.log(ahead[t_of, line]) + np.log(back[t_of, line])
        if chances is not None:
            inner = t_of > 0
            t, c = t_of[inner], line[inner]
            r, b = ahead[t - 1, c], g[t, c] * back[t, c]
            chances[:, place[inner]] = np.stack([ot * b, r * tt * b]) / (oo + ot * b + r * (to + tt * b))
    return out


def summary(x: np.ndarray) -> list[float]:
    """What a document score is made of."""
    if not len(x):
        return [1.0, -8.0, 0.0, 0.0]
    p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    return [1.0, float(np.clip(x.max(), -8, 8)), math.log1p(p.sum()), min(1.0, 20 * float(p.mean()))]


def _lines(text: str) -> list[list[str]]:
    return [w for w in (x.split() for x in text.split("\n")) if w]


def token_labels(docs: list[tuple[str, int]]) -> set[str]:
    """Normal words that count as toxic, alone or by their beginning (as `word*`)."""
    seen = [Counter(), Counter()]
    for kind in (0, 1):
        around = set()
        for text, label in docs:
            if label == kind:
                for words in _lines(text):
                    w = ["", *map(normal, words), ""]
                    around |= {(w[i - 1], w[i], w[i + 1]) for i in range(1, len(w) - 1) if w[i]}
        for before, w, after in around:
            del before, after
            seen[kind].update([w, *[w[:k] + "*" for k in BEGINNINGS[1:] if len(w) >= k]])
    n = [max(1, sum(v for k, v in s.items() if k[-1] != "*")) for s in seen]
    return {w for w, c in seen[1].items() if c >= SEEN and c / n[1] > RATIO * (seen[0][w] + 0.3) / n[0]}


def train(docs: list[tuple[str, int]], share: float) -> Field:
    """The field from (text, label) pairs, and the model of document scores; share: of toxic labels where no sample was
    taken."""
    if len({label for _, label in docs}) < 2:
        return Field(np.zeros(BUCKETS, np.float32), np.zeros((2, 2)), 0.0, (0.0,) * 4, share)
    made = train_field(docs)
    x, label = np.array([text_summary(made, text) for text, _ in docs]), np.array([t for _, t in docs], float)
    b = np.zeros(4)
    for _ in range(30):  # Newton's steps of a ridge logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = x.T @ (x * (q * (1 - q))[:, None]) + 0.5 * np.eye(4)
        b = b + np.linalg.solve(h, x.T @ (label - q) - 0.5 * b * np.array([0, 1, 1, 1]))
    sampled = label.mean()
    b[0] += math.log(share / (1 - share)) - math.log(sampled / (1 - sampled))
    made.final = tuple(b.tolist())
    return made


def train_field(docs: list[tuple[str, int]]) -> Field:
    toxic = token_labels(docs)
    is_toxic = lambda w: w in toxic or any(w[:k] + "*" in toxic for k in BEGINNINGS[1:])
    lines = [(words, np.array([label == 1 and is_toxic(normal(w)) for w in words])) for text, label in docs for words in _lines(text)]
    lines = lines or [([""], np.zeros(1, bool))]
    # all lines count, those without toxic tokens less where there are very many of them
    marked = np.array([y.any() for _, y in lines])
    weight = np.where(marked, 1.0, min(1.0, (PLAIN * marked.sum() + PLAIN_LEAST) / max(1, (~marked).sum())))
    words = [w for x, _ in lines for w in x]
    kinds = {w: k for k, w in enumerate(dict.fromkeys(words))}
    kind = np.fromiter(map(kinds.__getitem__, words), np.int64, len(words))
    feats = [hashed(w) for w in kinds]
    flat, of = np.concatenate([np.array(f) for f in feats]), np.repeat(np.arange(len(kinds)), [len(f) for f in feats])
    used, flat = np.unique(flat, return_inverse=True)
    y = np.concatenate([y for _, y in lines]).astype(float)
    size = np.array([len(x) for x, _ in lines])
    first = np.cumsum(size) - size
    inner = np.ones(len(words), bool)
    inner[first] = False
    inner = np.flatnonzero(inner)
    each = np.repeat(weight, size)
    w, step, start = np.zeros(len(used)), np.array([[0.0, -3.0], [0.0, -3.0]]), -3.0
    m, v = np.zeros(len(used) + 3), np.zeros(len(used) + 3)
    for epoch in range(1, EPOCHS + 1):
        e = np.bincount(of, weights=w[flat], minlength=len(kinds))[kind]
        chances = np.zeros((2, len(words)))
        p = 1 / (1 + np.exp(-np.clip(odds(e, size, step, start, chances), -30, 30)))
        turned, stayed = chances[:, inner]
        gap = (y - p) * each
        grad = np.append(np.bincount(flat, weights=np.bincount(kind, weights=gap, minlength=len(kinds))[of], minlength=len(used)) / weight.sum() - RIDGE * w, np.zeros(3))
        grad[-3] = gap[first].sum() / weight.sum()
        mean = lambda x: (x * each[inner]).sum() / max(each[inner].sum(), 1e-9)
        grad[-2] = mean(y[inner] * (1 - y[inner - 1]) - turned)
        grad[-1] = mean(y[inner] * y[inner - 1] - stayed)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
        w, start, step[0, 1], step[1, 1] = w + move[:-3], start + move[-3], step[0, 1] + move[-2], step[1, 1] + move[-1]
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return Field(weights, step, start, (0.0,) * 4)


def _flat(f: Field, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of all tokens of some texts, and how many each text has."""
    lines = [_lines(x) for x in some]
    sizes = np.array([len(y) for x in lines for y in x], np.int64)
    counts = np.array([sum(map(len, x)) for x in lines], np.int64)
    return odds(f.emissions([w for x in lines for y in x for w in y]), sizes, f.step, f.start), counts


def text_summary(f: Field, text: str) -> list[float]:
    return summary(_flat(f, [text])[0])


_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", pa.string())])


def spans(text: str, likely: np.ndarray) -> str:
    """Runs of likely tokens as start:end, in code points."""
    out: list[list[int]] = []
    for k, m in enumerate(_word.finditer(text)):
        if likely[k]:
            if k and likely[k - 1] and out:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
    return ",".join(f"{s}:{e}" for s, e in out)


def _apply(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = weights.value
        for b in batches:
            score, found = [], []
            for docs in slices(texts(b), SLICE_CHARS):
                x, counts = _flat(f, docs)
                for text, n, end in zip(docs, counts.tolist(), np.cumsum(counts).tolist(), strict=True):
                    own = x[end - n : end]
                    z = float(np.dot(summary(own), f.final))
                    score.append(f.base if f.base is not None else 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                    found.append(spans(text, own > 0) if n and own.max() > 0 else "")
            ids = b.column("doc_id").to_pylist()
            cols = ids, [held_out(i) for i in ids], score, [int(s >= 0.5) for s in score], found
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _SCORE.types, strict=True)], schema=_SCORE)

    return run


def sampled(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> list[tuple[str, int]]:
    """(text, label) of at most `rows` different rows of each label, by hash of doc_id, as far as they fit into `chars`.
    Only the chosen rows come to the driver, however often a row or an id is repeated."""
    first = F.xxhash64(F.lit(11), "doc_id")
    few = [labels.where(F.col("toxic") == k).orderBy(first, "doc_id").limit(rows) for k in (0, 1)]
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    there = own.join(F.broadcast(few[0].union(few[1])), "doc_id").groupBy("doc_id", "hash", "toxic").agg(F.max(F.char_length("text")).alias("chars"))
    chosen = []
    for kind in (0, 1):
        left = chars
        for r in there.where(F.col("toxic") == kind).orderBy(first, "doc_id", "hash").limit(rows).collect():
            if r.chars <= left:
                left -= r.chars
                chosen.append((r.doc_id, r.hash, kind))
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, hash long, toxic int")
    found = own.join(F.broadcast(wanted), ["doc_id", "hash"]).groupBy("doc_id", "hash", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id", "hash", "toxic").collect()
    return [(r.text, r.toxic) for r in found]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Trains on a sample of labelled rows, none of them held out; its bound is SAMPLE's."""
    usable = labels.where("doc_id is not null and toxic in (0, 1) and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return train(sampled(docs, usable, sample, SAMPLE_CHARS), min(max(share, 1e-6), 1 - 1e-6) if counts else 0.0)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of each row of docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(fit(own, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), sample))
    return own.mapInArrow(_apply(weights), "doc_id long, held_out boolean, score double, predicted int, spans string")

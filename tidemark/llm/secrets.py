"""Operator 5: secret scans by a randomness test battery.

Known kinds are found by pattern (assign, access, hex). Other runs of encoded characters are candidates: an encoding is
inferred from the characters they use, and chi-squared uniformity over its alphabet, runs of character classes and serial
correlation are tested; their combined p-value must not reject randomness. For those left, the likelihood of a random
token against that of corpus characters (counted over all texts) bounds the p-value under "ordinary text" by its
inverse, and Benjamini-Hochberg thresholds, one for each class of lengths and over all candidates of the corpus, control
the share of false discoveries.

Rows: null text is an empty one; texts are scanned whole; repeated rows give equal results; rows aren't joined, so null
or repeated doc_ids do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

KINDS = ["assign", "access", "hex", "random"]
_any_case = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
ASSIGN = re.compile("(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key"))) + """)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{16,}"), re.compile("[0-9a-f]{24,}")
STEMS = ("passw", "secret", "token", "api")
CANDIDATE = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
#: Characters of encoded text in the order of their codes.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
#: A candidate is tested as random over the smallest of these that holds its characters.
ENCODINGS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": ALPHABET[:62], "base64": ALPHABET[:64], "base64url": ALPHABET[:62] + "-_", "mixed": ALPHABET,
}
LENGTHS = [20, 24, 32, 40, 64, 128]
RANDOM_AT, FDR = 1e-3, 0.01
_code = np.full(128, -1, np.int64)
_code[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_kind_of = np.array([0] * 26 + [1] * 26 + [2] * 10 + [3] * 4)
_sets = [(frozenset(v), len(v)) for v in ENCODINGS.values()]
_orders = [np.array([v.index(c) if c in v else -1 for c in ALPHABET]) for v in ENCODINGS.values()]
#: Chance that neighbours differ in class, for random text of each encoding.
_change = np.array([1 - sum((sum(_kind_of[ALPHABET.index(c)] == k for c in v) / len(v)) ** 2 for k in range(4)) for v in ENCODINGS.values()])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, by start and kind."""
    out = []
    low = text.lower()
    if any(s in low for s in STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _upper_normal(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in np.atleast_1d(z)])


def battery(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each token the number of its encoding, and the combined p-value of the three tests of randomness over it."""
    if not tokens:
        return np.zeros(0, int), np.zeros(0)
    enc = np.array([next(i for i, (s, _) in enumerate(_sets) if used <= s) for used in map(set, tokens)])
    n, k = np.array([len(t) for t in tokens]), np.array([_sets[e][1] for e in enc])
    codes = _code[np.frombuffer("".join(tokens).encode(), np.uint8)]
    of = np.repeat(np.arange(len(tokens)), n)
    counts = np.bincount(of * 66 + codes, minlength=66 * len(tokens)).reshape(-1, 66)
    chi = (counts.astype(float) ** 2).sum(1) * k / n - n
    df = k - 1.0
    uniform = _upper_normal(((np.maximum(chi, 1e-9) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df)))  # Wilson-Hilferty
    inner = of[1:] == of[:-1]
    moves = np.bincount(of[1:][inner], weights=(_kind_of[codes[1:]] != _kind_of[codes[:-1]])[inner], minlength=len(tokens))
    p = _change[enc]
    z = (moves - (n - 1) * p) / np.sqrt(np.maximum((n - 1) * p * (1 - p), 1e-9))
    runs = 2 * _upper_normal(np.abs(z))
    value = np.array([o for o in _orders])[enc[of], codes].astype(float)
    centred = value - (k[of] - 1) / 2
    serial = np.bincount(of[1:][inner], weights=(centred[1:] * centred[:-1])[inner], minlength=len(tokens))
    z = serial / (np.sqrt(n - 1.0) * (k**2 - 1) / 12)
    correlated = 2 * _upper_normal(np.abs(z))
    cauchy = np.mean([np.tan((0.5 - np.clip(q, 1e-15, 1 - 1e-9)) * math.pi) for q in (uniform, runs, correlated)], axis=0)
    return enc, 0.5 - np.arctan(cauchy) / math.pi


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of encoded runs that overlap no base span and aren't plain numbers."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if not m.group().isdigit() and not any(b < e and s < f for b, _, f in base):
            out.append((s, e))
    return out


#: Texts are tested together, so many characters of them at a time.
SLICE_CHARS = 2_000_000
_row = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32()), ("length", pa.int32()), ("token", pa.string())])
_schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))), ("candidates", pa.list_(_row)), ("tested", pa.list_(pa.int64())), ("characters", pa.list_(pa.int64()))])
_ddl = "doc_id long, base array<struct<start:int,kind:int,end:int>>, candidates array<struct<start:int,end:int,size:int,length:int,token:string>>, tested array<long>, characters array<long>"


def _promising(docs: list[str]) -> Iterator[tuple[list, list, list]]:
    """For each text its base spans, its candidates that pass for random, and how many candidates of each length class it has."""
    for some in slices(docs, SLICE_CHARS):
        bases = [base_spans(x) for x in some]
        spans = [candidates(x, b) for x, b in zip(some, bases, strict=True)]
        tokens = [x[s:e].rstrip("=") for x, own in zip(some, spans, strict=True) for s, e in own]
        enc, p = battery(tokens)
        at = 0
        for base, own in zip(bases, spans, strict=True):
            kept, tested = [], [0] * (len(LENGTHS) + 1)
            for s, e in own:
                length = int(np.searchsorted(LENGTHS, len(tokens[at]), side="right"))
                tested[length] += 1
                if p[at] > RANDOM_AT:
                    kept.append({"start": s, "end": e, "size": _sets[enc[at]][1], "length": length, "token": tokens[at]})
                at += 1
            yield base, kept, tested


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs = texts(b)
        if not docs:
            continue
        rows = list(_promising(docs))
        seen = np.zeros(66, np.int64)
        for x in docs:
            c = _code[(a := np.frombuffer(x.encode("utf-8", "surrogatepass"), np.uint8))[a < 128]]
            seen += np.bincount(c[c >= 0], minlength=66)
        chars = [seen.tolist(), *[None] * (len(docs) - 1)]  # of the whole batch, on its first row
        base = [[{"start": s, "kind": k, "end": e} for s, k, e in r[0]] for r in rows]
        cols = [b.column("doc_id"), base, [r[1] for r in rows], [r[2] for r in rows], chars]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c for c, t in zip(cols, _schema.types, strict=True)], schema=_schema)


def _units(x: float) -> int:
    """Logarithms in whole millionths: sums are exact, so that a score is one number wherever it is computed."""
    return round(x * 1_000_000)


_CHOICE = _units(math.log10(len(ENCODINGS)))


@dataclass(frozen=True)
class Rule:
    """Log10 frequencies (in millionths) of the ALPHABET's characters in the corpus, and the least score of each length class."""

    log_q: tuple[int, ...]
    least: tuple[int, ...]

    def score(self, token: str, size: int) -> int:
        """Tenths of log10 of the likelihood ratio, less the choice among encodings."""
        token = token.lower() if token == token.upper() else token  # capitals throughout are ordinary text too
        ratio = -len(token) * _units(math.log10(size)) - sum(self.log_q[_code[ord(c)]] for c in token) - _CHOICE
        return max(0, min(1000, ratio // 100_000))


def scan(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, _ddl).checkpoint()


def _log_q(scanned: DataFrame) -> tuple[int, ...]:
    rows = scanned.where("characters is not null").select(F.posexplode("characters").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    n = np.ones(66)
    for r in rows:
        n[r["k"]] += r["n"]
    return tuple(map(_units, np.log10(n / n.sum()).tolist()))


def _scores(log_q: tuple[int, ...]) -> Column:
    """Rule.score as an expression on the candidates."""
    table = F.create_map(*[x for c, q in zip(ALPHABET, log_q, strict=True) for x in (F.lit(c), F.lit(q).cast("long"))])
    sizes = F.create_map(*[x for k in sorted({k for _, k in _sets}) for x in (F.lit(k), F.lit(_units(math.log10(k))).cast("long"))])

    def score(c: Column) -> Column:
        plain = F.when(c["token"] == F.upper(c["token"]), F.lower(c["token"])).otherwise(c["token"])
        natural = F.aggregate(F.filter(F.split(plain, ""), lambda x: x != ""), F.lit(0).cast("long"), lambda a, x: a + table[x])
        ratio = -F.char_length(c["token"]) * sizes[c["size"]] - natural - F.lit(_CHOICE)
        return F.greatest(F.lit(0), F.least(F.lit(1000), F.floor(ratio / 100_000).cast("int")))

    return F.transform("candidates", lambda c: F.struct(c["start"], c["end"], c["length"], score(c).alias("score")))


def fit(scanned: DataFrame, fdr: float = FDR) -> Rule:
    """Character frequencies and thresholds from all texts; tables of at most 66 and 7 x 1001 rows come to the driver."""
    log_q = _log_q(scanned)
    tested = {r["k"]: r["n"] for r in scanned.select(F.posexplode("tested").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()}
    scores = scanned.where("size(candidates) > 0").select(F.inline(_scores(log_q))).groupBy("length", "score").agg(F.count("*").alias("n")).collect()
    least = []
    for k in range(len(LENGTHS) + 1):
        rank, found = 0, 1001
        for r in sorted((r for r in scores if r["length"] == k), key=lambda r: -r["score"]):
            rank += r["n"]
            if 10 ** (-r["score"] / 10) * max(tested.get(k, 0), 1) <= fdr * rank:
                found = r["score"]
        least.append(found)
    return Rule(log_q, tuple(least))


def secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    scanned = scan(docs)
    rule = fit(scanned, fdr)
    least = F.array(*[F.lit(x) for x in rule.least])
    new = F.filter(_scores(rule.log_q), lambda c: c["score"] >= F.element_at(least, c["length"] + 1))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")
    df = scanned.select("doc_id", "base", F.transform(new, lambda c: F.struct(c["start"], F.lit(3).alias("kind"), c["end"])).alias("new"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "new"))).alias("spans"),
        F.size("new").cast("long").alias("n_random"),
    )


def redact(docs: DataFrame, fdr: float = FDR, mark: str = "[SECRET]") -> DataFrame:
    """docs with each found span of `text` replaced and `n_chars`, where there is one, counted anew. A first pass fits the
    thresholds; the second scans again and replaces, so that documents needn't be joined with their spans."""
    rule = fit(scan(docs), fdr)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("text").to_pylist()
            out = list(raw)
            for k, (base, kept, _) in enumerate(_promising([x or "" for x in raw])):
                new = [(c["start"], 3, c["end"]) for c in kept if rule.score(c["token"], c["size"]) >= rule.least[c["length"]]]
                x, at, parts = raw[k], 0, []
                for s, _, e in sorted(base + new):
                    if s >= at:
                        parts += [x[at:s], mark]
                    at = max(at, e)
                if parts:
                    out[k] = "".join([*parts, x[at:]])
            cols = {n: b.column(n) for n in names} | {"text": pa.array(out, pa.string())}
            if "n_chars" in cols:
                same = b.column("n_chars").to_pylist()
                cols["n_chars"] = pa.array([n if o is r else len(o) for n, o, r in zip(same, out, raw, strict=True)], b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names)

    return docs.mapInArrow(run, docs.schema)

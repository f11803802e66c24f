"""Operator 6: quality rules by weak supervision, in DataFrame functions alone.

Rules vote good (+1), bad (-1) or abstain (0). Expectation-maximisation over the table of vote patterns (3 ** rules rows
at most, whatever the corpus) estimates each rule's accuracy and the share of good texts without labels; the posterior
of a text is then a sum of log odds. A text that fails the base rules is rejected in any case.

Rows: null text has no words (and fails); other columns, null or not, pass by; repeated rows get equal verdicts; an empty
table gives an empty result. Line and window statistics cover the whole text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50
ROUNDS, KEEP_AT = 50, 0.5
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_stops", "n_lines", "n_symbol_words"]


def _without(text: Column, chars: str) -> Column:
    """How many characters of the text are among these."""
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the FEATURES of each text. Words that 3-word windows repeat are found by sorting the windows' 64-bit
    hashes with their places, only where some window repeats at all."""
    # one step per select: an expression used twice would otherwise be computed twice
    df = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("x"))
    df = df.select("doc_id", "x", F.filter(F.split("x", SPACE), lambda w: w != "").alias("w"), F.split("x", "\n").alias("l"))
    df = df.select("*", F.size("w").alias("n"), F.filter("l", lambda y: F.translate(y, BLANKS, "") != "").alias("full"))
    hashes = F.transform(F.sequence(F.lit(0), F.col("n") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
    df = df.select("*", F.when(F.col("n") >= 3, hashes).otherwise(F.array().cast("array<long>")).alias("h"))
    df = df.select("*", (F.size(F.array_distinct("h")) < F.size("h")).alias("again"))
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.select("*", F.when(F.col("again"), placed).alias("s"))
    near = lambda x, k: F.coalesce(F.get("s", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("s", lambda x, k: near(x, k - 1) | near(x, k + 1))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    x = F.col("x")
    return df.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.char_length(F.translate(x, BLANKS, "")).cast("long").alias("word_chars"),
        _without(x, SYMBOLS).alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("again"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        _without(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _without(x, "!?").alias("n_marks"),
        _without(x, ".").alias("n_stops"),
        F.size("full").cast("long").alias("n_lines"),
        F.size(F.filter("w", lambda w: F.translate(w, SYMBOLS, "") != w)).cast("long").alias("n_symbol_words"),
    )


def _rule(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    c = F.col
    return {
        "symbols": _rule(c("n_symbols") * 100 > c("word_chars") * 5, c("n_symbols") * 200 < c("word_chars")),
        "symbol_words": _rule(c("n_symbol_words") * 100 > c("n_words") * 20, c("n_symbol_words") * 100 < c("n_words") * 2),
        "capitals": _rule(c("n_upper") * 100 > c("word_chars") * 40, c("n_upper") * 100 < c("word_chars") * 15),
        "marks": _rule(c("n_marks") * 100 > c("n_words") * 25, c("n_marks") * 100 < c("n_words") * 5),
        "sentences": _rule(c("n_stops") * 100 < c("n_words"), c("n_stops") * 40 > c("n_words")),
        "lines": _rule((c("n_dup_lines") * 100 > c("n_lines") * 30) & (c("n_dup_lines") >= 3), c("n_dup_lines") == 0),
        "windows": _rule(c("n_repeat_words") * 100 > c("n_words") * 30, c("n_repeat_words") * 100 < c("n_words") * 10),
    }


#: Chances of the votes -1, 0, +1 by a bad and a good text, where EM starts and, with PRIOR of all texts' weight, stays near.
START = ((0.3, 0.2, 0.5), (0.01, 0.09, 0.9))
PRIOR = 0.02


def fit(patterns: list[tuple[tuple[int, ...], int]], m: int, rounds: int = ROUNDS) -> tuple[float, list[list[list[float]]]]:
    """Share of good texts, and for each rule the chances of its votes by a bad and a good text (its accuracies), from the
    counts of vote patterns by m rules. Rules are independent given the kind of text; abstaining is a vote like others."""
    total = sum(n for _, n in patterns)
    weight = PRIOR * total + 1
    share, chance = 0.8, [[list(x) for x in START] for _ in range(m)]
    for _ in range(rounds):
        kinds, votes_of = [0.2 * weight, 0.8 * weight], [[[p * weight for p in x] for x in START] for _ in range(m)]
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, _odds(votes, share, chance)))))
            for k, q in ((0, 1 - p), (1, p)):
                kinds[k] += n * q
                for r, v in enumerate(votes):
                    votes_of[r][k][v + 1] += n * q
        share = kinds[1] / sum(kinds)
        chance = [[[x / sum(row) for x in row] for row in rule] for rule in votes_of]
    return share, chance


def _odds(votes: tuple[int, ...], share: float, chance: list[list[list[float]]]) -> float:
    return math.log(share / (1 - share)) + sum(math.log(c[1][v + 1] / c[0][v + 1]) for v, c in zip(votes, chance, strict=True))


def _fitted(votes: DataFrame, names: list[str]) -> Column:
    """The posterior as an expression on the vote columns."""
    counts = votes.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    share, chance = fit([(tuple(r[k] for k in names), r["n"]) for r in counts], len(names))
    odds = F.lit(math.log(share / (1 - share)))
    for k, c in zip(names, chance, strict=True):
        bad, none, good = (F.lit(math.log(g / b)) for b, g in zip(*c, strict=True))
        odds = odds + F.when(F.col(k) < 0, bad).when(F.col(k) > 0, good).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the FEATURES, the votes, base_failed, posterior (that the text is good) and kept."""
    votes = {f"vote_{k}": v for k, v in rules().items()}
    df = features(docs, text).withColumns(votes).checkpoint()
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    df = df.select("*", failed.alias("base_failed"), _fitted(df, list(votes)).alias("posterior"))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_AT))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, ...) that are kept, with all their columns: rows with equal doc_id and equal text
    have equal verdicts, so the verdicts of rejected pairs go against the documents as an anti-join on id and text hash."""
    bad = quality(docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h")).alias("doc_id"), "text")).where("not kept")
    bad = bad.select(F.col("doc_id.id").alias("_id"), F.col("doc_id.h").alias("_h")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(bad["_id"]) & (F.xxhash64("text") == bad["_h"]), "left_anti")

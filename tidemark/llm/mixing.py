"""Operator 4: mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A source with n rows and target weight w is repeated at the mean rate w * total / n. Each document's count is the inverse
of that Poisson distribution at a uniform number hashed from seed and doc_id; it is exploded by its count and every copy
goes to a hashed place of the whole output.

Rows: a null source is a source of its own; null doc_ids draw one common number; repeated rows draw the same number; an
empty table gives an empty result. A doc with count 0 isn't in the output: that is the operator. Columns named copy,
mean_rate and shuffle_key in docs are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name

ALPHA, SEED = 0.5, "mix-1"
#: A table of sources up to this many rows is broadcast; beyond it the join is Spark's own choice, with skew splitting.
BROADCAST_SOURCES = 10_000
#: Poisson terms up to this many standard deviations above the mean (and 20 more): what is beyond has less than 1e-16.
TAIL = 12


def mean_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, rows: int | None = None) -> tuple[DataFrame, int]:
    """source, n and mean_rate, and how many sources there are. Without weights, a source weighs n ** alpha. rows: the
    wanted total, by default as many. The counts are one pass over docs, kept as a checkpoint."""
    n = docs.groupBy("source").agg(F.count("*").alias("n")).checkpoint()
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        w = F.lit(0.0)
        for k, v in weights.items():
            w = F.when(F.col("source") == k, F.lit(float(v))).otherwise(w)
    n = n.select("source", "n", w.alias("w"))
    total, weight, sources = n.agg(F.sum("n"), F.sum(F.round("w", 9).cast("decimal(28,9)")), F.count("*")).first()
    total, weight = rows or total or 0, float(weight or 1) or 1.0
    return n.select("source", "n", (F.col("w") / F.lit(weight) * F.lit(float(total)) / F.col("n")).alias("mean_rate")), sources


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, rows: int | None = None, seed: str = SEED) -> DataFrame:
    """The columns of docs (doc_id, source, ...), copy (from 1), mean_rate and shuffle_key, in shuffled order."""
    docs = docs.drop("copy", "mean_rate", "shuffle_key")
    rates, sources = mean_rates(docs, weights, alpha, rows)
    source_, cdf_, n_ = (free_name(docs, x) for x in ("_source", "_cdf", "_n"))
    few = sources <= BROADCAST_SOURCES
    terms = F.sequence(F.lit(1), F.ceil(F.col("mean_rate") + TAIL * F.sqrt("mean_rate") + 20).cast("int"))
    start = F.struct((-F.col("mean_rate")).alias("log"), F.array(F.exp(-F.col("mean_rate"))).alias("cdf"))

    def term(acc, k):
        log = acc["log"] + F.log(F.col("mean_rate")) - F.log(k.cast("double"))
        return F.struct(log.alias("log"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + F.exp(log))).alias("cdf"))

    cdf = F.when(F.col("mean_rate") > 0, F.aggregate(terms, start, term)["cdf"]).otherwise(F.array(F.lit(2.0)))
    rates = rates.select(F.col("source").alias(source_), "mean_rate", cdf.alias(cdf_))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    hashed = lambda *x, n: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *x).cast("binary")), 1, n), 16, 10).cast("long")
    uniform = hashed(key, n=13) / F.lit(float(1 << 52))
    joined = docs.join(F.broadcast(rates) if few else rates, docs["source"].eqNullSafe(rates[source_]))
    counted = joined.withColumn(n_, F.size(F.filter(cdf_, lambda c: c <= uniform))).where(F.col(n_) > 0)
    out = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(n_)))).drop(source_, cdf_, n_)
    out = out.withColumn("shuffle_key", hashed(key, F.col("copy").cast("string"), n=15))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id")


SQL = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, pow(n::DOUBLE, {ALPHA}) AS w FROM n),
t AS (SELECT sum(n)::DOUBLE AS total, sum(round(w, 9)::DECIMAL(28,9))::DOUBLE AS weight FROM w),
r AS (SELECT source, w / weight * total / n AS mean_rate FROM w, t),
terms AS (SELECT source, mean_rate, k, exp(-mean_rate + k * ln(mean_rate) - lgamma(k + 1.0)) AS p
          FROM r, range(0, 400) g(k) WHERE k <= ceil(mean_rate + {TAIL} * sqrt(mean_rate) + 20)),
cdf AS (SELECT source, mean_rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
steps AS (SELECT source, mean_rate, list(c ORDER BY k) AS cs FROM cdf GROUP BY source, mean_rate),
u AS (SELECT d.*, s.mean_rate, s.cs, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u
      FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
c AS (SELECT *, len(list_filter(cs, lambda x: x <= u)) AS k FROM u)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, round(mean_rate, 9) AS mean_rate,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 15))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, k + 1)) AS copy FROM c WHERE k > 0)
"""

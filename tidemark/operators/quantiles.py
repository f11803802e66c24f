"""Exact quantiles of groups of any size, in two steps: counts of buckets tell which bucket holds a rank, and only those
buckets are looked into. No task holds more of a group than its bucket counts, or the distinct values of one bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets to a doubling of 1 + |value|; a double's range has about two million of them at most.
FINE = 1024


def bucket(v: Column) -> Column:
    """A whole number that doesn't fall as the value rises."""
    size = F.floor(F.least(F.log2(F.abs(v) + 1) * FINE, F.lit(2.0e9)))
    return F.when(F.isnan(v), F.lit(2**31 - 1)).otherwise((F.signum(v) * size).cast("int"))


def quantiles(df: DataFrame, keys: list[str], value: Column, at: dict[str, float]) -> DataFrame:
    """keys, and for each name its quantile of the group's values that aren't NULL, interpolated between neighbours as
    percentile() does it; a group without values isn't there. NULL keys are a group like others."""
    counted = df.select(*keys, value.cast("double").alias("_v")).where("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_n")).withColumn("_b", bucket(F.col("_v")))
    group, run = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy(*keys, "_b").agg(F.sum("_n").alias("_m"))
    buckets = sums.select(*keys, "_b", "_m", F.coalesce(F.sum("_m").over(run), F.lit(0)).alias("_start"), F.sum("_m").over(group).alias("_all"))
    place = {n: F.lit(float(q)) * (F.col("_all") - 1) for n, q in at.items()}
    ranks = [f(p) for p in place.values() for f in (F.floor, F.ceil)]
    held = lambda rank, start, n: (rank >= start) & (rank < start + n)
    hit = F.lit(False)
    for r in ranks:
        hit = hit | held(r, F.col("_start"), F.col("_m"))
    wanted = buckets.where(hit).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_wb"), "_start", "_all")
    same = F.col("_b") == F.col("_wb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    found = counted.join(wanted, same).withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    value_at = lambda rank: F.max(F.when(held(rank, F.col("_before"), F.col("_n")), F.col("_v")))
    ends = found.groupBy(*keys).agg(F.max("_all").alias("_all"), *[value_at(f(p)).alias(f"{n}_{side}") for n, p in place.items() for side, f in (("low", F.floor), ("high", F.ceil))])

    def between(n: str) -> Column:
        p, low, high = place[n], F.col(f"{n}_low"), F.col(f"{n}_high")
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return ends.select(*keys, *[between(n).alias(n) for n in at])

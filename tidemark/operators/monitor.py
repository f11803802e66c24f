"""Operational views as DataFrames; the time of the run is passed in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.quantiles import quantiles


def _age(run_ts, c: str):
    return F.unix_seconds(F.lit(run_ts).cast("timestamp")) - F.unix_seconds(c)


def cdc_freshness(audit: DataFrame, run_ts, hours: int = 24) -> DataFrame:
    """Freshness, lag quantiles and counts by table over the last hours."""
    age = F.unix_micros(F.lit(run_ts).cast("timestamp")) - F.unix_micros("source_commit_at")
    within = lambda minutes: F.count_if(age < minutes * 60_000_000)
    op = lambda x: F.count_if(F.col("op") == x)
    recent = audit.where(age < hours * 3_600_000_000)
    lag = quantiles(recent, ["source_table"], F.col("lag_ms"), {"lag_p50_seconds": 0.5, "lag_p95_seconds": 0.95})
    counts = recent.groupBy("source_table").agg(
        F.max("source_commit_at").alias("last_source_commit_at"), F.max("landed_at").alias("last_landed_at"), F.min(_age(run_ts, "source_commit_at")).alias("freshness_seconds"), (F.max("lag_ms") / 1000).alias("lag_max_seconds"),
        within(5).alias("events_last_5m"), within(60).alias("events_last_1h"), op("c").alias("creates"), op("u").alias("updates"), op("d").alias("deletes"), op("r").alias("snapshot_reads"),
    )
    return counts.join(lag, "source_table", "left").withColumns({n: F.col(n) / 1000 for n in ("lag_p50_seconds", "lag_p95_seconds")})


def raw_health(tables: dict[str, DataFrame], run_ts) -> DataFrame:
    one = lambda df: df.agg(F.count("*").alias("row_count"), F.count_if(F.col("_is_deleted") == 1).alias("deleted_rows"), F.max("_landed_at").alias("last_insert_at"))
    return cdc.surrogate_union({k: one(df) for k, df in tables.items()}, "table_name").withColumn("seconds_since_insert", _age(run_ts, "last_insert_at"))


def reconciliation(tables: dict[str, DataFrame], keys: dict[str, str], collapsed: bool = True) -> DataFrame:
    """Distinct and live keys. Collapsed: a key lives if its newest version does; else if any version does."""

    def one(name: str) -> DataFrame:
        k, df = keys[name], tables[name]
        if not collapsed:
            return df.agg(F.countDistinct(k).alias("distinct_keys"), F.countDistinct(F.when(F.col("_is_deleted") == 0, F.col(k))).alias("live_keys"))
        return cdc.newest(df, k, columns=[]).agg(F.count("*").alias("distinct_keys"), F.count_if(F.col("_is_deleted") == 0).alias("live_keys"))

    return cdc.surrogate_union({n: one(n) for n in tables}, "entity")


def row_delta(source: dict[str, DataFrame], target: DataFrame) -> DataFrame:
    """entity, source_rows, live_keys, delta; target as reconciliation() gives it."""
    n = cdc.surrogate_union({k: df.agg(F.count("*").alias("source_rows")) for k, df in source.items()}, "entity")
    return n.join(target.select("entity", "live_keys"), "entity", "left").withColumn("delta", F.col("source_rows") - F.coalesce("live_keys", F.lit(0)))


def caught_up(delta: DataFrame, fresh: DataFrame, tolerance: int = 0, max_lag: float = 300.0) -> DataFrame:
    """One row: all deltas within the tolerance, and no table's p95 lag above the limit; no lag at all passes."""
    d = delta.agg(F.max(F.abs("delta")).alias("largest_delta"))
    p = fresh.agg(F.max("lag_p95_seconds").alias("largest_p95"))
    return d.crossJoin(p).withColumn("caught_up", (F.coalesce("largest_delta", F.lit(0)) <= tolerance) & (F.coalesce("largest_p95", F.lit(0.0)) <= max_lag))  # one row each


def latest_run(runs: DataFrame, key: str, started: str, *tie: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col(started).desc(), *[F.col(c).desc() for c in tie])
    nth = cdc.free_name("_nth", runs)
    return runs.withColumn(nth, F.row_number().over(w)).where(F.col(nth) == 1).drop(nth)


def last_success(runs: DataFrame, run_ts, max_age_seconds: int) -> DataFrame:
    ok = runs.where("status = 'success'").groupBy("entity").agg(F.max("finished_at").alias("last_success_at"))
    return ok.withColumn("fresh", _age(run_ts, "last_success_at") <= max_age_seconds)


def newest_invocation(results: DataFrame) -> DataFrame:
    """The rows of the invocation that ran last (ties by its id): one id, found first, is a literal of the scan's filter."""
    newest = results.orderBy(F.col("executed_at").desc(), "invocation_id").select("invocation_id").first()
    return results.where(F.col("invocation_id") == newest[0]) if newest else results.where("false")


def latest_tests(results: DataFrame) -> DataFrame:
    """Of the newest invocation, passes, warnings and failures by layer."""
    has = lambda *x: F.count_if(F.col("status").isin(*x))
    return newest_invocation(results).groupBy("layer").agg(
        has("pass", "success").alias("passed"), has("warn").alias("warned"), has("fail", "error").alias("failed"), F.round(F.sum("execution_time"), 2).alias("total_seconds"), F.max("executed_at").alias("executed_at")
    )


def model_runtimes(runs: DataFrame) -> DataFrame:
    """model_name and execution_time of the newest invocation."""
    return newest_invocation(runs).select("model_name", "execution_time")


def rejects(df: DataFrame, run_ts, hours: int = 24) -> DataFrame:
    """Rejects of the last hours by entity and rule, most first."""
    return df.where(_age(run_ts, "rejected_at") < hours * 3600).groupBy("entity", "rule").agg(F.count("*").alias("rejects")).orderBy(F.col("rejects").desc(), "entity", "rule")


def reject_totals(df: DataFrame, run_ts, hours: int = 24) -> DataFrame:
    """Rejects of the last hours by entity alone, with the number of rules that were broken and the latest reject."""
    recent = df.where(_age(run_ts, "rejected_at") < hours * 3600)
    by = recent.groupBy("entity", "rule").agg(F.count("*").alias("n"), F.max("rejected_at").alias("last"))
    return by.groupBy("entity").agg(F.sum("n").alias("rejects"), F.count("rule").alias("rules"), F.max("last").alias("last_rejected_at")).orderBy(F.col("rejects").desc(), "entity")


def rolling_counts(audit: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Events by window, table and op; on a stream, state is dropped 48 hours behind the newest commit."""
    if audit.isStreaming:
        audit = audit.withWatermark("source_commit_at", "48 hours")
    return audit.groupBy(F.window("source_commit_at", width).alias("w"), "source_table", "op").agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), "source_table", "op", "events")

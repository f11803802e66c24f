"""Change-data operators: collapse by version, incremental windows, merges, change detection, control tables.

A raw table holds many versions of a key, in any order and more than once; `ORDER` decides which is newest, so every
operator gives the same result whatever the order of arrival.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("_version", "_lsn", "_tx_id")
META = ("_op", "_source_commit_at", "_cdc_read_at", "_version", "_lsn", "_tx_id", "_is_deleted", "_landed_at")


def free_name(name: str, *frames: DataFrame) -> str:
    """The name, or one like it that no column has; case doesn't tell names apart."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _rest(df: DataFrame) -> list[str]:
    return [c for c, t in sorted(df.dtypes) if c not in ORDER and not t.startswith(("map", "variant"))]


def order(df: DataFrame) -> Column:
    """Equal versions fall back on the log position, then on a hash of the whole row, so that ties have one result. The
    order is a few numbers: an aggregate that keeps it doesn't keep a second copy of the row."""
    return F.struct(*[F.col(c) for c in ORDER if c in df.columns], F.xxhash64(*_rest(df)).alias("_hash"))


def narrow(df: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """The columns that a collapse needs besides those that are asked for. The hash of ties has to read what is there, so a
    reader of few columns says so before the collapse, and the scan reads these alone."""
    return df.select(*dict.fromkeys([*keys, *columns, *[c for c in (*ORDER, "_is_deleted", "_source_commit_at") if c in df.columns]]))


def newest(df: DataFrame, *keys: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The newest row of each key; with `columns`, of these and the change metadata alone. Spark keeps one row of a key in
    each task before the shuffle (a group limit), so a key with very many versions is no hot spot."""
    df = df if columns is None else narrow(df, keys, columns)
    tie, nth = free_name("_tie", df), free_name("_nth", df)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ORDER if c in df.columns], F.col(tie).desc())
    return df.withColumn(tie, F.xxhash64(*_rest(df))).withColumn(nth, F.row_number().over(w)).where(F.col(nth) == 1).drop(tie, nth)


def current_rows(df: DataFrame, *keys: str) -> DataFrame:
    """The newest whole row of each key, unless it is a delete."""
    return newest(df, *keys).where("_is_deleted = 0")


def latest_by_key(df: DataFrame, keys: list[str], columns: list[str], skip_nulls: bool = False, where: Column | None = None, collapsed: bool = False) -> DataFrame:
    """The columns at each key's newest version, with is_deleted, cdc_commit_at and cdc_version; deletes stay, marked.

    skip_nulls: each column by itself takes its newest value that isn't NULL; otherwise all come from one row. collapsed: there
    is but the newest row of each key."""
    df = df if where is None else df.where(where)
    named = {**{c: c for c in columns}, "_is_deleted": "is_deleted", "_source_commit_at": "cdc_commit_at"}
    if skip_nulls:
        by = order(df)
        return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), by)).alias(n) for c, n in named.items()], F.max("_version").alias("cdc_version"))
    return (df if collapsed else newest(df, *keys, columns=columns)).select(*keys, *[F.col(c).alias(n) for c, n in named.items()], F.col("_version").alias("cdc_version"))


def incremental_filter(df: DataFrame, target: DataFrame | None, column: str, target_column: str, hours: int = 48) -> DataFrame:
    """Rows since the target's newest commit less the lookback; all rows without a target. The bound is a literal, so it
    is pushed down to the scan."""
    newest = target.agg(F.max(target_column)).first()[0] if target is not None else None
    return df if newest is None else df.where(F.col(column) >= F.lit(newest - dt.timedelta(hours=hours)))


def merge_by_key(target: DataFrame, batch: DataFrame, keys: list[str], deleted: str | None = None) -> DataFrame:
    """Rows of target whose key isn't in the batch, and the batch's; keys whose batch row is deleted go. Idempotent."""
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    new = batch.where(F.coalesce(F.col(deleted) == 0, F.lit(True))).drop(deleted) if deleted else batch
    return kept.unionByName(new.select(*target.columns))


def payload_hash(*columns: str) -> Column:
    """SHA-256 of the columns as JSON by name, NULLs included."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def classify_changes(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The batch with `change`: inserted, updated or unchanged, by payload hash."""
    was, there = free_name("_old", batch), free_name("_there", batch)
    old = target.select(*keys, payload_hash(*columns).alias(was), F.lit(True).alias(there))
    state = F.when(F.col(there).isNull(), "inserted").when(~F.col(was).eqNullSafe(payload_hash(*columns)), "updated").otherwise("unchanged")
    return batch.join(old, keys, "left").withColumn("change", state).drop(was, there)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], now: dt.datetime, touched: str = "_updated_at", kept: str | None = None) -> DataFrame:
    """Target after the batch: `touched` moves only on rows that differ, an unchanged row stays as it was, and `kept` (when
    a row first came) stays on all that were there."""
    change = classify_changes(target, batch, keys, columns).where("change <> 'unchanged'").drop("change").withColumn(touched, F.lit(now).cast("timestamp"))
    if kept:
        change = change.join(target.select(*keys, F.col(kept).alias("_kept")), keys, "left").withColumn(kept, F.coalesce("_kept", kept)).drop("_kept")
    return merge_by_key(target, change, keys)


def last_wins(batch: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """Of rows with one key in a batch, the last to arrive."""
    nth = free_name("_nth", batch)
    return batch.withColumn(nth, F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(arrival).desc()))).where(F.col(nth) == 1).drop(nth)


def surrogate_union(frames: dict[str, DataFrame], name: str = "entity") -> DataFrame:
    """UNION ALL of like frames, each with its name."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias(name), *df.columns) for k, df in frames.items()])


def watermark(previous: DataFrame | None, batch: DataFrame, entity: str, key: str, now: dt.datetime) -> DataFrame:
    """entity, last_success_at, last_cursor (largest key; an empty batch keeps the old), last_row_count, total_rows_loaded."""
    new = batch.agg(F.max(key).cast("string").alias("cursor"), F.count("*").alias("n")).select(F.lit(entity).alias("entity"), "cursor", "n")
    at = F.lit(now).cast("timestamp").alias("last_success_at")
    if previous is None:
        return new.select("entity", at, F.col("cursor").alias("last_cursor"), F.col("n").alias("last_row_count"), F.col("n").alias("total_rows_loaded"))
    old = previous.where(F.col("entity") == entity).select(F.col("entity"), F.col("last_cursor").alias("_cursor"), F.col("total_rows_loaded").alias("_total"))
    return new.join(old, "entity", "left").select(
        "entity", at, F.coalesce("cursor", "_cursor").alias("last_cursor"), F.col("n").alias("last_row_count"), (F.coalesce("_total", F.lit(0)) + F.col("n")).alias("total_rows_loaded")
    )


def shrunk(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """entity, rows_before, rows_after and shrank for a backfill's row-count guard."""
    count = lambda frames, n: surrogate_union({k: df.agg(F.count("*").alias(n)) for k, df in frames.items()})
    both = count(before, "rows_before").join(count(after, "rows_after"), "entity", "full")
    return both.withColumn("shrank", F.coalesce(F.col("rows_after"), F.lit(0)) < F.coalesce(F.col("rows_before"), F.lit(0)))

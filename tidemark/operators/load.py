"""Atomic loads of entities: a batch lands whole or not at all, and every attempt leaves a run record.

A run is committed as running before anything else. Its rows, rejects, expectations, watermark and the end of its record are
staged and become visible by one commit; a failure leaves nothing but a failed run, a killed driver a running one.

Entity tables are laid out in buckets by a hash of the key, and rows carry the hash of their payload. A batch is compared
with key, hash and first arrival of its own buckets, in one join, and only buckets with changes are written anew. A first
batch whose size is known about is written in its buckets at once, and what was written is the table.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.config import Settings
from tidemark.operators import cdc, quality
from tidemark.operators.commits import Change, Log, LogTable
from tidemark.operators.tables import Conflict, _ddl
from tidemark.sources.landing import REGISTRY, Entity

RUN = "run_id string, batch_id string, entity string, started_at timestamp, finished_at timestamp, status string, rows_read long, rows_inserted long, rows_updated long, rows_unchanged long, rows_rejected long, error_message string"
ORDER = tuple(n for n in ("offices", "staff", "loan_products", "savings_products", "clients", "loans", "savings_accounts", "loan_transactions") if n in REGISTRY)
HASH, REJECTS, CONTROL = "_row_hash", "rejects", ("runs", "rejects", "expectations")
#: Parts of a bucket, each of which a task of a first load has.
PARTS = 4
#: A batch that meets another writer's change of its buckets is merged again so often.
ATTEMPTS = 5


@dataclass(frozen=True)
class Outcome:
    entity: str
    status: str  # running, success, skipped (a dry run) or failed
    read: int = 0
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    rejected: int = 0
    error: str | None = None


@dataclass(frozen=True)
class Batch:
    """A batch as written: accepted rows (the last of each key) as a table has them, rejects, results of expectations; how many
    there are. staged: the folders of so many buckets that the rows are in, if they were written as a table's first."""

    rows: DataFrame
    rejects: DataFrame
    checks: DataFrame | None
    read: int
    rejected: int
    staged: tuple[int, list[dict]] | None = None


class Lake:
    """The entity tables of one folder, with the control tables runs, rejects, expectations and watermarks beside them, all
    under one commit log. bucket_rows: of a bucket of an entity table, about."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings | None = None, bucket_rows: int = 1 << 20):
        self.spark, self.path, self.set, self.bucket_rows = spark, path.rstrip("/"), settings or Settings(), bucket_rows
        self.log = Log(spark, path)

    def table(self, name: str) -> LogTable:
        return self.log.table(name)

    def _staged_run(self, out: Outcome, run: str, batch: str, started: dt.datetime, finished: dt.datetime | None) -> list[dict]:
        row = (run, batch, out.entity, started, finished, out.status, out.read, out.inserted, out.updated, out.unchanged, out.rejected, out.error and out.error[:2000])
        folders = self.table("runs").stage(self.spark.createDataFrame([row], RUN).coalesce(1))
        return [{**x, "open": True} for x in folders] if finished is None else folders

    def load(self, entity: Entity, rows: DataFrame, now: dt.datetime, batch: str | None = None, arrival: str | None = None, dry_run: bool = False, expected: int | None = None, mapping: dict[str, Column] | None = None) -> Outcome:
        """Loads rows of an entity as of `now`. arrival: the column by which the last of equal keys wins; without it, repeated
        keys fail the batch where the entity expects unique ones. expected: how many rows come, about; a first load is then
        written once, in buckets for so many. mapping: the entity's columns, where rows are what these are made of: the few
        columns that come are shuffled, and the last of each key is mapped."""
        run, batch, began = uuid.uuid4().hex, batch or uuid.uuid4().hex, time.monotonic()
        opened = self._staged_run(Outcome(entity.name, "running"), run, batch, now, None)
        self.log.commit({"runs": Change(RUN, opened)}, f"begin {run}")

        def ended(out: Outcome) -> dict[str, Change]:
            folders = self._staged_run(out, run, batch, now, now + dt.timedelta(seconds=time.monotonic() - began))
            return {"runs": Change(RUN, folders, gone={x["path"] for x in opened})}

        try:
            ready = self._prepare(entity, rows, now, f"{self.path}/batches/{run}", arrival, None if dry_run else expected, mapping)
            if dry_run:
                out = Outcome(entity.name, "skipped", read=ready.read, rejected=ready.rejected)
                self.log.commit(ended(out), f"end {run}")
            else:
                for attempt in range(ATTEMPTS):
                    try:
                        out, changes = self._merged(entity, ready, now, batch, f"{self.path}/batches/{run}/{attempt}")
                        self.log.commit(changes | ended(out), f"end {run}")
                        break
                    except Conflict:
                        if attempt == ATTEMPTS - 1:
                            raise
        except Exception as e:  # whatever it was, the attempt is on record and the caller goes on
            out = Outcome(entity.name, "failed", error=str(e).strip() or type(e).__name__)
            self.log.commit(ended(out), f"end {run}")
        self.log.store.delete(f"{self.path}/batches/{run}")
        self.log.tidy(CONTROL)
        return out

    def _prepare(self, entity: Entity, rows: DataFrame, now: dt.datetime, at: str, arrival: str | None, expected: int | None, mapping: dict[str, Column] | None) -> Batch:
        """The source is read once, into what the later steps read; raises if the batch is not to be loaded. Until it is
        written a row is one struct, whose fields needn't be taken apart by each step. Where the table's buckets are to be
        written, rows are shuffled once, by parts of these. Else, of rows with one key each task sends one; rejects that are
        the same in all are sent once, with their number."""
        business = [c for c in entity.columns if c != entity.key]
        if mapping is None:
            named, row, order = rows, F.struct(*entity.columns), arrival
        else:
            inputs = [F.struct(*[c for c in rows.columns if c != arrival]).alias("_row"), *([F.col(arrival).alias("_at")] if arrival is not None else [])]
            named, row, order = rows.select(*[mapping[c].alias(c) for c in entity.columns], *inputs), F.col("_row"), "_at"
        rule = quality.reject_rule(entity.key, business)
        reject = F.when(rule.isNotNull(), F.struct(*quality.reject_row(named.drop("_row", "_at"), entity.key, rule, entity.name)))
        marked = named.select(F.col(entity.key).alias("key"), reject.alias("reject"), F.when(rule.isNull(), row).alias("row"), *([F.struct(order).alias("at")] if arrival is not None else []))
        table, staged = self.table(entity.name), None
        n = None if expected is None or table.exists() else self._buckets(expected)
        deal = []
        if n is not None and n > 1:  # a file of a bucket for each of its parts
            deal = ["deal"]
            marked = marked.withColumn("deal", F.when(F.col("reject").isNull(), F.pmod(F.xxhash64("key"), F.lit(n * PARTS))).otherwise(F.pmod(F.xxhash64("key", "reject"), F.lit(n * PARTS)))).repartition(n * PARTS, "deal")
        if arrival is None:
            marked = marked.drop("deal").withColumn("seen", F.lit(1).cast("long"))
        else:
            marked = marked.groupBy(*deal, "key", "reject").agg(F.max_by("row", "at").alias("row"), F.count("*").alias("seen"))
        stamp, good = F.lit(now).cast("timestamp"), F.col("reject").isNull()
        batch = marked.select("row.*", "reject", "seen")
        if mapping is not None:
            batch = batch.select(*[F.when(good, mapping[c]).alias(c) for c in entity.columns], "reject", "seen")
        batch = batch.withColumns({HASH: F.when(good, F.unhex(cdc.payload_hash(*entity.columns))), "_ingested_at": stamp, "_updated_at": stamp})
        if n is None:
            with shared.swept(self.spark):
                batch.write.parquet(f"{at}/read")
            whole, folders = self.spark.read.schema(batch.schema).parquet(f"{at}/read"), []
        else:
            part = F.when(good, F.pmod(F.xxhash64(entity.key), F.lit(n)).cast("string")).otherwise(REJECTS)
            folders = table.stage(batch, part=part, dealt=True)
            whole = table.frame({"schema": _ddl(batch), "folders": folders})
            staged = n, [x for x in folders if x["part"] != REJECTS]
        try:
            return self._checked(entity, whole, staged)
        except Exception:
            table.discard(folders)
            raise

    def _checked(self, entity: Entity, whole: DataFrame, staged: tuple[int, list[dict]] | None) -> Batch:
        n = {r.bad: r for r in whole.groupBy(F.col("reject").isNotNull().alias("bad")).agg(F.sum("seen").alias("seen"), F.count("*").alias("kept")).collect()}
        accepted, rejected = (n[bad].seen if bad in n else 0 for bad in (False, True))
        read = accepted + rejected
        if read and rejected / read > self.set.max_reject_ratio:
            raise ValueError(f"reject ratio {rejected / read:.1%} exceeds {self.set.max_reject_ratio:.1%} ({rejected} of {read} rows)")
        own = whole.where("reject is null").drop("reject", "seen")
        checks = None
        if entity.expectations:
            checks = quality.expectations(own, list(entity.expectations))
            failed = [r.check_name for r in checks.where("not passed and severity = 'error'").collect()]
            if failed:
                raise ValueError(f"failed expectations: {', '.join(failed)}")
        # as often as they came, by steps that hold a thousand at most
        rejects = whole.where("reject is not null").select("reject", "seen", F.explode(F.sequence(F.lit(0), F.expr("(seen - 1) div 1000"))).alias("k"))
        rejects = rejects.select("reject", F.explode(F.sequence(F.lit(1), F.least(F.lit(1000), F.col("seen") - F.col("k") * 1000)))).select("reject.*")
        return Batch(own, rejects, checks, n[False].kept if False in n else 0, rejected, staged)

    def _buckets(self, rows: int) -> int:
        """A power of two, so that a bucket holds about bucket_rows or less."""
        return 1 << max(0, (-(-rows // self.bucket_rows) - 1).bit_length())

    def _merged(self, entity: Entity, batch: Batch, now: dt.datetime, name: str, at: str) -> tuple[Outcome, dict[str, Change]]:
        """What the batch changes, staged. An unchanged row stays as it was, and a changed one keeps its first arrival."""
        table, key = self.table(entity.name), entity.key
        stamp = F.lit(now).cast("timestamp")
        own, schema = batch.rows, _ddl(batch.rows)
        old = table.pointer() if table.exists() else None
        changes: dict[str, Change] = {}
        if old is None:
            count = {"inserted": batch.read}
            table.buckets = (key, batch.staged[0] if batch.staged else self._buckets(batch.read))
            folders = batch.staged[1] if batch.staged else table.stage(own) if batch.read else []
            changes[entity.name] = Change(schema, folders, parts=None, rows=batch.read, notes={"buckets": list(table.buckets)})
        else:
            parts = lambda df: {r.p for r in df.select(table.part().alias("p")).distinct().collect()}  # noqa: E731 - buckets, at most
            there = table.frame(old, parts(own).__contains__).select(key, F.col(HASH).alias("_was"), F.col("_ingested_at").alias("_first"))
            state = F.when(F.col("_first").isNull(), "inserted").when(F.col("_was") != F.col(HASH), "updated").otherwise("unchanged")
            compared = own.join(there, key, "left").withColumns({"_change": state, "_ingested_at": F.coalesce("_first", "_ingested_at")}).drop("_was", "_first")
            with shared.swept(self.spark):
                compared.write.parquet(at)
            compared = self.spark.read.schema(compared.schema).parquet(at)
            count = {r._change: r["count"] for r in compared.groupBy("_change").count().collect()}
            changed = compared.where("_change <> 'unchanged'").drop("_change")
            if set(count) - {"unchanged"}:
                grown = old["rows"] + count.get("inserted", 0)
                again = self._buckets(grown) >= 4 * table.buckets[1]  # the table has outgrown its buckets
                touched = None if again else parts(changed)
                within = lambda value: touched is None or value in touched
                gone = [x for x in old["folders"] if within(x["part"])]
                stay = table.frame(old, within).join(changed.select(key), key, "left_anti")
                if again:
                    table.buckets = (key, self._buckets(grown))
                folders = table.stage(stay.select(*own.columns).unionByName(changed.select(*own.columns)))
                changes[entity.name] = Change(schema, folders, gone, touched, {x["path"] for x in gone}, count.get("inserted", 0), {"buckets": list(table.buckets)})
        record = {"batch_id": F.lit(name), "recorded_at": stamp}
        appended = {"rejects": batch.rejects.withColumns({"batch_id": F.lit(name), "rejected_at": stamp}) if batch.rejected else None, "expectations": batch.checks.withColumns({"entity": F.lit(entity.name), **record}) if batch.checks else None}
        for n, df in appended.items():
            if df is not None:
                changes[n] = Change(_ddl(df), self.table(n).stage(df.coalesce(1) if n == "expectations" else df))
        changes["watermarks"] = self._watermark(entity, batch.rows, now)
        return Outcome(entity.name, "success", batch.read, *[count.get(k, 0) for k in ("inserted", "updated", "unchanged")], batch.rejected), changes

    def _watermark(self, entity: Entity, rows: DataFrame, now: dt.datetime) -> Change:
        """The entity's folder of the watermarks, in place of its former one."""
        marks = self.table("watermarks")
        old = marks.pointer()["folders"] if marks.exists() else []
        before = [x for x in old if x["part"] == entity.name]
        previous = marks.frame(marks.pointer(), lambda value: value == entity.name) if before else None
        new = cdc.watermark(previous, rows, entity.name, entity.key, now)
        folders = [{**x, "part": entity.name} for x in marks.stage(new.coalesce(1))]
        return Change(_ddl(new), folders, old, {entity.name}, {x["path"] for x in before})

    def load_all(self, source: Callable[[str], DataFrame], now: dt.datetime, entities: Iterable[str] | None = None, fail_fast: bool = False, dry_run: bool = False, arrival: str | None = None, expected: Callable[[str], int] | None = None, mapping: Callable[[str], dict[str, Column]] | None = None) -> list[Outcome]:
        """Loads entities in their order, parents before children; a failed one is on record and the rest go on, unless
        fail_fast. expected, mapping: about how many rows an entity has and what its columns are made of, as in load()."""
        out, batch = [], uuid.uuid4().hex
        wanted = set(entities or ORDER)
        for name in [n for n in ORDER if n in wanted]:
            out.append(self.load(REGISTRY[name], source(name), now, batch, arrival, dry_run, expected(name) if expected else None, mapping(name) if mapping else None))
            if fail_fast and out[-1].status == "failed":
                break
        return out

    def vacuum(self, keep: int = 2, grace_hours: float = 24.0) -> int:
        """Removes all commits but the newest ones, data that these don't name, and what killed loads have left."""
        since = time.time() * 1000 - grace_hours * 3_600_000
        for n, _, _, changed in self.log.store.entries(f"{self.path}/batches"):
            if changed <= since:
                self.log.store.delete(f"{self.path}/batches/{n}")
        return self.log.vacuum(keep, grace_hours)

    def parents(self, limit: int | None = None) -> DataFrame:
        """Disbursed loans, last touched first: those whose transactions are to be fetched. limit: the newest so many."""
        loans = self.table("loans").read().where("disbursed_on_date is not null").orderBy(F.coalesce("_updated_at", "_ingested_at").desc(), "loan_id").select("loan_id")
        return loans if limit is None else loans.limit(limit)

    def backfill(self, source: Callable[[str], DataFrame], now: dt.datetime, entities: Iterable[str]) -> DataFrame:
        """load_all, then entity, rows_before, rows_after and shrank: a table that lost rows is to be looked into."""
        names = list(entities)
        before = {n: self.table(n).read() for n in names if self.table(n).exists()}
        self.load_all(source, now, names)
        return cdc.shrunk(before, {n: self.table(n).read() for n in names if self.table(n).exists()})

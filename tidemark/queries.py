"""Every operator and model as a registered query over the star-schema tables, and its SQL for DuckDB."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import oracle, shared
from tidemark.columns import COLUMNS
from tidemark.functions import scalars as s
from tidemark.operators import cdc, footers, load, monitor, quality
from tidemark.operators.tables import Table
from tidemark.plans.models import Models
from tidemark.sources import landing, seeds, star
from tidemark.streaming import continuous, topics

KINDS = {"d": "double", "l": "bigint", "i": "int", "s": "string", "t": "date", "b": "boolean"}
AUDIT_RUN = dt.datetime(2024, 1, 31)


def tidy(df: DataFrame, name: str) -> DataFrame:
    """The query's columns in their kinds. Doubles are exact quotients of exact sums and stay as they are; only those that
    depend on the order of additions (kind a) are rounded."""

    def one(c: str, k: str) -> Column:
        if k == "a":
            return F.col(c).cast("double").cast("decimal(28,6)").cast("double")
        return F.unix_micros(F.col(c).cast("timestamp")) if k == "m" else F.col(c).cast(KINDS[k])

    return df.select(*[one(*x.split(":")).alias(x.split(":")[0]) for x in COLUMNS[name].split()])


def pinned(name: str) -> str:
    sql = {"a": "CAST(CAST(CAST({c} AS DOUBLE) AS DECIMAL(28,6)) AS DOUBLE)", "m": "CAST(epoch_us({c}) AS BIGINT)", "s": "CAST({c} AS VARCHAR)"}
    out = [f"{sql.get(k, 'CAST({c} AS ' + KINDS.get(k, '').upper() + ')').format(c=c)} AS {c}" for c, k in (x.split(":") for x in COLUMNS[name].split())]
    return f"SELECT {', '.join(out)} FROM ({oracle.ORACLE[name]}) q"


class Source:
    """The raw entities and models of one directory. `shared` are the models with stages that several others read written
    to the shared folder once; `models` has them in each plan, for queries that read each stage once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.models = Models(lambda e: star.raw(spark, sf_dir, e))
        self.shared = Models(lambda e: star.raw(spark, sf_dir, e), keep=shared.written)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def raw(self, entity: str) -> DataFrame:
        return star.raw(self.spark, self.dir, entity)

    def raws(self) -> dict[str, DataFrame]:
        return {e: self.raw(e) for e in star.KEYS}

    def audit(self) -> DataFrame:
        op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "purchase", "d").when(F.col("event_type") == "error", "r").otherwise("u")
        return self.table("events").select(F.lit("events").alias("source_table"), F.col("user_id").alias("primary_key"), op.alias("op"), F.col("ts").cast("timestamp").alias("source_commit_at"), F.col("ts").cast("timestamp").alias("landed_at"), F.col("event_id").alias("lsn"), F.round(F.col("value") * 1000).cast("long").alias("lag_ms"))


def latest_by_key(x: Source) -> DataFrame:
    raw, c = x.raw("loan_transactions"), "outstanding_loan_balance"
    whole = cdc.latest_by_key(raw, ["transaction_id"], [c]).withColumnRenamed(c, "newest")
    known = cdc.latest_by_key(raw, ["transaction_id"], [c], skip_nulls=True).select("transaction_id", F.col(c).alias("newest_known"))
    return whole.join(known, "transaction_id")


def incremental_window(x: Source) -> DataFrame:
    raw = x.raw("loan_transactions")
    return cdc.incremental_filter(raw, raw.where("transaction_date < date'2000-01-01'"), "_source_commit_at", "_source_commit_at")


def merge_by_key(x: Source) -> DataFrame:
    """A target that is a batch behind, brought up to date: as a full rebuild would give it."""
    raw, m = x.raw("loan_transactions"), x.models
    old = m.ledger(raw.where("_source_commit_at < timestamp'1998-01-01'")).where("is_deleted = 0").drop("is_deleted")
    touched = raw.where("_source_commit_at >= timestamp'1998-01-01'").select("transaction_id").distinct()
    return cdc.merge_by_key(old, m.ledger(raw.join(touched, "transaction_id", "left_semi")), ["transaction_id"], "is_deleted")


def change_detection(x: Source) -> DataFrame:
    new = x.table("customer")
    old = new.where("c_custkey % 7 <> 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return cdc.classify_changes(old, new, ["c_custkey"], new.columns).groupBy("change").agg(F.count("*").alias("n"))


def _checked(x: Source) -> DataFrame:
    e = quality.Expectation
    checks = [e("pk_not_null", "not_null", ("loan_id",)), e("pk_unique", "unique", ("loan_id",)), e("amounts_non_negative", "non_negative", ("principal", "total_overdue")), e("rate_in_range", "range", ("annual_interest_rate",), "warn", 0, 20), e("has_rows", "row_count_min")]
    return quality.expectations(x.raw("loans"), checks)


def _schema_tests(x: Source) -> dict[str, DataFrame]:
    fct = shared.written(x.shared.fct_loan.select("loan_id", "par_bucket", "client_id"), "fct_loan")
    return {
        "loan_id_not_null": quality.not_null(fct, "loan_id"), "loan_id_unique": quality.unique(fct, "loan_id"), "par_bucket_accepted": quality.accepted(fct, "par_bucket", ["Current", "PAR 1-30"]),
        "client_relationship": quality.relationships(fct, "client_id", x.shared.stg_clients, "client_id"),
    }


def failures_stored(x: Source) -> DataFrame:
    return quality.failing_rows(_schema_tests(x), shared.scratch(x.spark, "failures"))


def quality_gate(x: Source) -> DataFrame:
    """Each table is built once, with the columns that are looked at, and one pass over it answers all its checks. Loans and
    ledger, which several tables are built from, are collapsed once, and what the checks depend on is written."""
    looked_at = {"stg_loans": ("loan_id", "client_id", "product_id", "is_active", "days_past_due", "total_outstanding", "disbursed_on_date"), "stg_loan_transactions": ("transaction_id", "loan_id", "transaction_date", "amount", "transaction_category", "is_countable")}
    m = Models(x.raw, keep=shared.written, kept=tuple(looked_at), columns=looked_at)
    less, n = lambda c: F.count("*") - F.countDistinct(c), F.count("*")
    errors = landing.poison(landing.parse_events(wire_events(x), landing.REGISTRY["savings_accounts"]), "savings_accounts", F.lit(AUDIT_RUN)).where(F.col("observed_at") > F.lit(AUDIT_RUN - dt.timedelta(days=1)))
    return quality.gate_of(
        [
            (m.fct_loan, [("marts_not_empty", n, ">", 0, True), ("no_duplicate_loans", less("loan_id"), "==", 0, True), ("no_negative_outstanding", F.count_if(F.col("total_outstanding") < 0), "==", 0, True), ("dimension_coverage", F.count_if(F.col("client_segment").isNull() | (F.col("client_segment") == "")), "==", 0, False)]),
            (m.fct_loan_transaction, [("no_duplicate_transactions", less("transaction_id"), "==", 0, True)]), (m.default_features, [("ml_label_leakage", F.count_if(F.col("feat_days_since_prior_loan") <= 0), "==", 0, True)]), (errors, [("cdc_parse_errors", n, "==", 0, False)]),
        ]
    )


def gate_isolated(x: Source) -> DataFrame:
    """Checks of which one names a column that isn't there and one fails while it runs: the others keep their values."""
    loans = x.models.loans("loan_id", "status", "principal")
    out = quality.gate_of([(loans, [("loans_there", F.count("*"), ">", 0, True), ("status_is_a_number", F.sum(F.col("status").cast("int")), ">=", 0, True), ("gone", F.max("no_such_column"), ">", 0, False), ("principal_non_negative", F.count_if(F.col("principal") < 0), "==", 0, True)])])
    return out.withColumn("error", F.regexp_extract("error", r"^\[([A-Z_]+)", 1))


def results_history(x: Source) -> DataFrame:
    """Three runs' worth of results appended to the histories, of which the last ten days are kept, counted by day."""
    at, all_of = shared.scratch(x.spark, "history"), results(x)
    tests, models = Table(x.spark, f"{at}/tests", "day"), Table(x.spark, f"{at}/models", "day")
    for k in range(3):
        quality.keep_results(all_of.where(F.pmod("rows_affected", F.lit(3)) == k), tests, models, AUDIT_RUN, 10)
    return cdc.surrogate_union({"test": tests.read().groupBy("day").agg(F.count("*").alias("n")), "model": models.read().groupBy("day").agg(F.count("*").alias("n"))}, "kind")


def leakage_planted(x: Source) -> DataFrame:
    """The leakage rule on features with leaks put in."""
    on = lambda k: F.col("loan_id") % k == 0
    f = x.shared.default_features.withColumns(
        {
            "feat_days_since_prior_loan": F.when(on(50), 0).otherwise(F.col("feat_days_since_prior_loan")), "feat_days_since_prior_repayment": F.when(on(41), 0).otherwise(F.col("feat_days_since_prior_repayment")),
            "feat_is_first_time_borrower": F.when(on(70), 1 - F.col("feat_is_first_time_borrower")).otherwise(F.col("feat_is_first_time_borrower")),
        }
    )
    return quality.leaking(f)


def balance_sanity(x: Source) -> DataFrame:
    """The balance rules on loans with wrong balances put in."""
    put = lambda c, n, v: F.when(F.col("loan_id") % 90 == n, v).otherwise(F.col(c))
    f = x.shared.fct_loan.withColumns(
        {
            "principal_outstanding": put("principal_outstanding", 1, -F.col("principal_outstanding")), "total_overdue": put("total_overdue", 2, F.col("total_overdue") + 2 * F.col("total_outstanding") + 5),
            "is_closed": put("is_closed", 3, F.col("is_active")), "principal_disbursed": put("principal_disbursed", 4, F.lit(0).cast("decimal(38,6)")),
        }
    )
    return quality.balance_reasons(f)


def row_rejects(x: Source) -> DataFrame:
    """Row rules on loans of which some have no key, a negative one, or nothing but the key."""
    k, key = F.col("loan_id"), F.col("loan_id") % 60
    some = x.raw("loans").where("_version = 2").select("loan_id", "client_id", "account_no", "principal").withColumn("n", k)
    empty = lambda c: F.when(key != 3, F.col(c)).alias(c)
    rows = some.select(F.when(key == 1, None).when(key == 2, -k).otherwise(k).alias("loan_id"), empty("client_id"), empty("account_no"), empty("principal"))
    good, bad = quality.split_rejects(rows, "loan_id", ["client_id", "account_no", "principal"], "loans")
    return bad.select("entity", "source_key", "rule").unionByName(good.agg(F.lit("loans").alias("entity"), F.count("*").cast("string").alias("source_key")).withColumn("rule", F.lit("valid rows")))


def row_delta(x: Source) -> DataFrame:
    some = {k: x.raw(k) for k in ("clients", "loans")}
    return monitor.row_delta({"clients": x.table("customer"), "loans": x.table("orders")}, monitor.reconciliation(some, star.KEYS))


def caught_up(x: Source) -> DataFrame:
    return monitor.caught_up(row_delta(x), monitor.cdc_freshness(x.audit(), AUDIT_RUN, 720), tolerance=100)


def parity(x: Source) -> DataFrame:
    """All eight entities: keys that the source has ever had against those that live."""
    raws = x.raws()
    return monitor.row_delta({e: raws[e].select(k).distinct() for e, k in star.KEYS.items()}, monitor.reconciliation(raws, star.KEYS))


def source_freshness(x: Source) -> DataFrame:
    return quality.freshness(x.raws(), dt.datetime(2001, 11, 5), "_landed_at", 24.0, 24.0 * 365 * 31)


def runs(x: Source) -> DataFrame:
    """Events as runs: an entity, when it finished and how."""
    status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    return x.table("events").select(F.concat(F.lit("e"), F.col("user_id").cast("string")).alias("entity"), F.col("ts").cast("timestamp").alias("finished_at"), status.alias("status"))


def results(x: Source) -> DataFrame:
    """Events as results of tests and models, a day's being one invocation."""
    kind = F.element_at(F.array(*map(F.lit, ("test.p.staging.t_", "model.p.marts.fct_", "model.p.stg_", "test.p.t_", "model.p.x_"))), (F.col("event_id") % 5 + 1).cast("int"))
    status = F.element_at(F.array(*map(F.lit, ("pass", "success", "warn", "fail", "error"))), (F.col("user_id") % 5 + 1).cast("int"))
    return x.table("events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("invocation_id"), F.lit("r").alias("run_id"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("executed_at"), F.concat(kind, F.col("event_id").cast("string")).alias("node_id"), status.alias("status"),
        (F.col("event_id") % 100 / 4).alias("execution_time"), (F.col("user_id") % 3).alias("failures"), F.lit(None).cast("string").alias("materialization"), F.col("event_id").alias("rows_affected"), F.col("props").alias("message"),
    )


def results_by_layer(x: Source) -> DataFrame:
    """Both history tables of all runs, counted by layer, status and severity."""
    tests, models = quality.split_results(results(x))
    count = lambda df, kind: df.groupBy("layer", "status", *[c for c in ("severity",) if c in df.columns]).agg(F.count("*").alias("n"), F.sum("execution_time").alias("seconds")).select(F.lit(kind).alias("kind"), "layer", "status", *[F.col("severity") if "severity" in df.columns else F.lit("").alias("severity")], "n", "seconds")
    return count(tests, "test").unionByName(count(models, "model"))


def rejected(x: Source) -> DataFrame:
    return x.table("events").select(F.col("event_type").alias("entity"), F.concat(F.lit("rule"), (F.col("user_id") % 3).cast("string")).alias("rule"), F.col("ts").cast("timestamp").alias("rejected_at"))


def provisions(x: Source) -> DataFrame:
    """What is provided for by band of days past due and group of loan statuses: both lookups, from CSV files, joined to the
    loans."""
    at = shared.scratch(x.spark, "seeds")
    status, bands = seeds.through_csv(seeds.loan_status(x.spark), f"{at}/status"), seeds.through_csv(seeds.par_buckets(x.spark), f"{at}/buckets")
    days = F.greatest(F.col("days_past_due"), F.lit(0))
    loans = x.models.loans("status_id", "days_past_due", "total_outstanding").join(F.broadcast(status.select("status_id", "status_group")), "status_id", "left")  # 10 rows
    joined = loans.join(F.broadcast(bands), (days >= F.col("min_days")) & (days <= F.col("max_days")), "left")  # 6 rows
    return joined.groupBy("bucket_order", "bucket_name", "status_group").agg(F.count("*").alias("loans"), F.sum((F.col("total_outstanding").cast("decimal(19,6)") * F.col("provision_rate").cast("decimal(4,2)")).cast("decimal(38,8)")).cast("decimal(38,8)").alias("provision"))


def backfill_guard(x: Source) -> DataFrame:
    """Rows before and after a rebuild of three tables, one of which lost some."""
    before = {k: x.table(k) for k in ("customer", "orders", "supplier")}
    return cdc.shrunk(before, {**before, "orders": before["orders"].where("o_orderkey % 10 <> 0")})


def retained(x: Source) -> DataFrame:
    """Events by day as a table with partitions: two appends, then what is older than ten days goes, day folders unread."""
    events = x.table("events").withColumns({"ts": F.col("ts").cast("timestamp"), "day": F.to_date("ts")})
    t = Table(x.spark, shared.scratch(x.spark, "events"), "day")
    t.replace(events.where("event_id % 2 = 0"))
    t.append(events.where("event_id % 2 = 1"))
    t.expire("day", 10, AUDIT_RUN)
    return t.read().groupBy("day").agg(F.count("*").alias("events"))


def merged_by_month(x: Source) -> DataFrame:
    """The ledger as a table with months: built behind, then brought up to date; months without changes aren't written."""
    entity, m = "loan_transactions", x.models
    rows, raw = star.source(x.spark, x.dir, entity), star.columns(entity)
    rows, month = rows.withColumn("transaction_id", raw["transaction_id"]), F.trunc(raw["transaction_date"], "month").cast("string")
    behind = raw["_source_commit_at"] < F.lit("1998-01-01").cast("timestamp")
    t = Table(x.spark, shared.scratch(x.spark, "ledger"), "transaction_month_start")
    ledger = lambda df: m.ledger(star.of(df, entity), collapsed=True)
    t.replace(star.newest(rows.where(behind), entity), part=month, made=lambda df: ledger(df).where("is_deleted = 0").drop("is_deleted"))
    touched = rows.where(~behind).select("transaction_id").distinct()
    t.merge(shared.written(ledger(star.newest(rows.join(touched, "transaction_id", "left_semi"), entity)), "batch", "zstd"), ["transaction_id"], "is_deleted")
    return t.read()


def packed(x: Source) -> DataFrame:
    """Events by day, appended in three parts and packed: fewer files, rows as they were."""
    events = x.table("events").withColumn("day", F.to_date("ts"))
    t = Table(x.spark, shared.scratch(x.spark, "packed"), "day")
    for k in range(3):
        t.append(events.where(F.pmod("event_id", F.lit(3)) == k))
    before = sum(len(t.files(f)) for f in t.pointer()["folders"])
    t.pack()
    after = sum(len(t.files(f)) for f in t.pointer()["folders"])
    return t.read().groupBy("day").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids")).withColumn("fewer_files", F.lit(after < before))


def failing_loans(x: Source) -> DataFrame:
    """The stored rows of a test that fails, as they are read back."""
    at = shared.scratch(x.spark, "failures")
    quality.failing_rows({"par_bucket_accepted": quality.accepted(x.models.loans("loan_id", "client_id", "par_bucket"), "par_bucket", ["Current", "PAR 1-30"])}, at)
    return x.spark.read.parquet(f"{at}/par_bucket_accepted")


def compacted(x: Source) -> DataFrame:
    t = Table(x.spark, shared.scratch(x.spark, "clients"))
    t.replace(x.raw("clients").where("_version = 1"))
    t.append(x.raw("clients").where("_version = 2"))
    t.compact(["client_id"])
    return t.read()


def table_files(x: Source) -> DataFrame:
    """Rows of each table by its files' footers; how many files there are and their size depend on the writer, not on the data."""
    return table_storage(x).select("table_name", "rows")


def table_storage(x: Source) -> DataFrame:
    """Files, rows, sizes and compression ratio of the tables, from their footers alone."""
    return footers.statistics({k: x.table(k) for k in ("customer", "orders", "supplier", "lineitem")})


def dim_date(x: Source) -> DataFrame:
    """From the first to the last order's day."""
    low, high = x.table("orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return Models(x.raw, dataclasses.replace(x.models.set, spine_start=low, spine_end=high)).dim_date(x.spark)


def wire_events(x: Source) -> DataFrame:
    """Customers as change events: amounts as text, days as numbers, some deletes and some messages that can't be read."""
    body = F.struct(
        F.col("c_custkey").alias("savings_id"), F.col("c_custkey").alias("client_id"), F.lit(1).cast("long").alias("product_id"), F.format_string("%.2f", "c_acctbal").alias("account_balance"), (F.col("c_custkey") % 20000).cast("int").alias("activated_on_date"),
        (F.col("c_custkey") % 2 == 0).alias("is_active"), F.when(F.col("c_custkey") % 9 == 0, "d").otherwise("u").alias("__op"), (F.col("c_custkey") * 1000).alias("__source_ts_ms"), (F.col("c_custkey") * 1000 + 250).alias("__ts_ms"),
    )
    text = F.to_json(body)
    return x.table("customer").select(F.when(F.col("c_custkey") % 50 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def wire_landing(x: Source) -> DataFrame:
    e = landing.REGISTRY["savings_accounts"]
    return landing.typed_rows(landing.parse_events(wire_events(x), e), e, F.lit(AUDIT_RUN)).select("savings_id", "account_balance", "activated_on_date", "is_active", "_op", "_version", "_is_deleted")


def wire_round_trip(x: Source) -> DataFrame:
    """All eight entities as messages and landed again: how many rows, and whether all their columns are what they were."""

    def one(name: str) -> DataFrame:
        e, raw = landing.REGISTRY[name], x.raw(name)
        back = landing.typed_rows(landing.parse_events(landing.as_events(raw, e), e), e, F.lit(AUDIT_RUN))
        types = dict(back.dtypes)
        columns = [F.col(c).cast(types[c]) for c in [*e.columns, "_source_commit_at", "_lsn", "_is_deleted"] if c in raw.columns]
        total = lambda df, side: df.select(F.pmod(F.xxhash64(*columns), F.lit(1 << 31)).alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("h")).withColumn("side", F.lit(side))
        both = total(raw, 0).unionByName(total(back, 1))
        return both.agg(F.max("n").alias("rows"), (F.count_distinct("n", "h") == 1).alias("same"))

    return cdc.surrogate_union({n: one(n) for n in landing.REGISTRY})


def wire_quarantine(x: Source) -> DataFrame:
    e = landing.REGISTRY["savings_accounts"]
    return landing.poison(landing.parse_events(wire_events(x), e), e.name, F.lit(AUDIT_RUN)).groupBy("topic", "error").agg(F.count("*").alias("messages"))


def rest_landing(x: Source) -> DataFrame:
    """Orders as pages of nested resources, landed flat."""
    day = lambda d: F.array(F.year(d), F.month(d), F.dayofmonth(d))
    item = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("clientId"), F.struct(F.lit(300).alias("id"), F.col("o_orderstatus").alias("value"), F.lit(True).alias("active")).alias("status"),
        F.struct(day("o_orderdate").alias("submittedOnDate"), day("o_orderdate").alias("expectedDisbursementDate")).alias("timeline"), F.format_string("%.2f", "o_totalprice").alias("principal"),
    )
    pages = x.table("orders").groupBy((F.col("o_orderkey") / 100).cast("long").alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("pageItems"))).alias("value"))
    return landing.rest_loans(landing.unwrap(pages)).select("loan_id", "client_id", "status_id", "status_value", "is_active", "submitted_on_date", "disbursed_on_date", "principal")


def _clients(x: Source, balance: Column) -> DataFrame:
    """Customers as pages' client rows."""
    c = F.col("c_custkey")
    own = {"client_id": c, "office_id": F.lit(1).cast("long"), "account_no": F.col("c_name"), "external_id": balance.cast("string")}
    columns = landing.REGISTRY["clients"].columns
    kinds = {"id": "long", "int": "int", "flag": "int", "text": "string", "date": "date", "money": "decimal(19,6)"}
    return x.table("customer").select(*[own.get(n, F.lit(None)).cast(kinds[k]).alias(n) for n, k in columns.items()], c.alias("_nth"))


def atomic_load(x: Source) -> DataFrame:
    """Run records of five loads of clients: all new; the same again; with changed balances, new keys twice and some
    rejects; a dry run; and one that fails for its rejects, after which the table is as it was."""
    lake, e, at = load.Lake(x.spark, shared.scratch(x.spark, "lake")), landing.REGISTRY["clients"], AUDIT_RUN
    first, c = _clients(x, F.col("c_acctbal")), F.col("client_id")
    some = first.where(c % 7 != 0)
    changed = first.withColumn("external_id", F.when(c % 5 == 0, F.lit("changed")).otherwise(F.col("external_id")))
    twice = changed.where(c % 7 == 0).withColumns({"external_id": F.lit("older"), "_nth": F.lit(-1).cast("long")})
    bad = lambda df, k: df.withColumn("client_id", F.when(c % k == 3, -c).otherwise(c))
    batches = [("1 new", some, False), ("2 same", some, False), ("3 changed", bad(changed, 100).unionByName(twice), False), ("4 dry", first, True), ("5 rejected", bad(first, 10), False)]
    for k, (name, rows, dry) in enumerate(batches):
        lake.load(e, rows, at + dt.timedelta(hours=k), name, "_nth", dry)
    marks, final = lake.table("watermarks").read(), lake.table("clients").read()
    runs = lake.table("runs").read().select("batch_id", "status", "rows_read", "rows_inserted", "rows_updated", "rows_unchanged", "rows_rejected")
    whole = final.agg(F.count("*").alias("rows_inserted"), F.count_if(F.col("external_id") == "changed").alias("rows_updated"), F.count_if(F.col("_updated_at") == F.col("_ingested_at")).alias("rows_unchanged"))
    total = marks.select(F.lit("table").alias("batch_id"), F.col("last_cursor").alias("status"), F.col("total_rows_loaded").alias("rows_read")).crossJoin(whole)  # one row each
    return runs.unionByName(total.withColumn("rows_rejected", F.lit(0).cast("long")))


def load_order(x: Source) -> DataFrame:
    """All eight entities loaded as one batch, parents first, of which staff fails; the others land all the same."""
    lake = load.Lake(x.spark, shared.scratch(x.spark, "lake"))

    def mapping(n: str) -> dict[str, Column]:
        made, kinds = star.columns(n), {"id": "long", "int": "int", "flag": "int", "text": "string", "date": "date", "money": "decimal(19,6)"}
        made |= {"staff_id": F.lit(None)} if n == "staff" else {}
        return {c: made.get(c, F.lit(None)).cast(kinds[k]) for c, k in landing.REGISTRY[n].columns.items()}

    source = lambda n: star.source(x.spark, x.dir, n).withColumn("_nth", star.columns(n)["_version"])
    lake.load_all(source, AUDIT_RUN, arrival="_nth", expected=lambda n: x.raw(n).count(), mapping=mapping)
    return lake.table("runs").read().select("entity", "status", "rows_read", "rows_inserted", "rows_rejected")


def stream_replay(x: Source) -> DataFrame:
    """Change events as a stream of files, landed twice under two checkpoints, and collapsed: what arrives again changes
    nothing."""
    at, e = shared.scratch(x.spark, "stream"), landing.REGISTRY["savings_accounts"]
    wire_events(x).write.text(f"{at}/in")
    for k in (1, 2):
        q = continuous.land(continuous.from_files(x.spark, f"{at}/in"), e, f"{at}/out", f"{at}/checkpoint-{k}", {"availableNow": True}).start()
        q.awaitTermination()
    typed = x.spark.read.parquet(f"{at}/out/typed")
    now = cdc.current_rows(typed.drop("stream", "batch", "_landed_at"), e.key)
    return now.select("savings_id", "account_balance", "activated_on_date", "is_active", "_op", "_version")


def messages(x: Source) -> tuple[DataFrame, Column]:
    """All entities' versions (topic, key, at, lsn, and what they are made of), and the text of their messages."""
    made = {n: star.columns(n) for n in landing.REGISTRY}

    def one(n: str, e: landing.Entity) -> DataFrame:
        return star.source(x.spark, x.dir, n).select(F.lit(n).alias("topic"), *[made[n][c].alias(to) for c, to in ((e.key, "key"), ("_version", "at"), ("_lsn", "lsn"))], "*")

    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(n, e) for n, e in landing.REGISTRY.items()])
    return rows, F.coalesce(*[F.when(F.col("topic") == n, landing.event(made[n], e)) for n, e in landing.REGISTRY.items()])


def topics_landed(x: Source) -> DataFrame:
    """All eight entities' versions as one log of messages, landed by one stream that routes them by topic. The log grows and
    the stream starts anew from its checkpoint twice: what lands is every message, once."""
    at = shared.scratch(x.spark, "topics")
    said, text = messages(x)
    for part in range(3):
        some = said.where(F.pmod(F.xxhash64("key", "at"), F.lit(3)) == part)
        topics.append(some, f"{at}/log", F.col("key"), [F.col("at"), F.col("lsn")], value=text)
        stream = topics.stream(x.spark, f"{at}/log")  # which keeps the messages
        continuous.land_topics(stream, f"{at}/out", f"{at}/checkpoint", {"availableNow": True}, keep=False).start().awaitTermination()

    def one(name: str, e: landing.Entity) -> DataFrame:
        typed = x.spark.read.parquet(f"{at}/out/typed/{name}").drop("stream", "batch", "_landed_at")
        return cdc.newest(typed.select(e.key, "_version", "_lsn", "_tx_id", "_is_deleted"), e.key).agg(F.count("*").alias("distinct_keys"), F.count_if(F.col("_is_deleted") == 0).alias("live_keys"))

    landed = x.spark.read.parquet(f"{at}/out/audit").groupBy(F.col("source_table").alias("entity")).agg(F.count("*").alias("messages"))
    return cdc.surrogate_union({n: one(n, e) for n, e in landing.REGISTRY.items()}).join(landed, "entity")


def streamed_counts(x: Source) -> DataFrame:
    """Events by window as a stream in append mode, in three rounds: some of the eve come with the second, those of the first
    week that come with the third are more than 48 hours late and dropped, and windows are out once nothing can change them."""
    at, ts = shared.scratch(x.spark, "counts"), F.col("source_commit_at")
    day = lambda n: F.lit(dt.datetime(2024, 1, n))
    late = ((F.col("lsn") % 17 == 0) & (ts >= day(10)) & (ts < day(11)), (F.col("lsn") % 13 == 0) & (ts < day(8)))
    rounds = F.when(late[1], 3).when(late[0], 2).when(ts < day(11), 1).when(ts < day(21), 2).otherwise(3)
    events = x.audit()
    for k in (1, 2, 3):
        events.where(rounds == k).write.mode("append").parquet(f"{at}/in")
        counts = monitor.rolling_counts(x.spark.readStream.schema(events.schema).parquet(f"{at}/in"))
        counts.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{at}/checkpoint").start(f"{at}/out").awaitTermination()
    return x.spark.read.parquet(f"{at}/out").withColumn("window_start", F.unix_seconds("window_start"))


def stream_collapsed(x: Source) -> DataFrame:
    """Clients' versions as a stream, newest first for some keys, in three rounds of which the last brings all of them again;
    the table that it keeps is the current rows."""
    at, raw = shared.scratch(x.spark, "collapse"), x.raw("clients")
    table = Table(x.spark, f"{at}/clients", buckets=("client_id", 8))
    first = (F.col("client_id") % 3 == 0) == (F.col("_version") % 2 == 0)
    for part in (raw.where(first), raw.where(~first), raw):
        part.write.mode("append").parquet(f"{at}/in")
        versions = x.spark.readStream.schema(raw.schema).parquet(f"{at}/in")
        continuous.collapse(versions, "client_id", table, f"{at}/checkpoint", {"availableNow": True}).start().awaitTermination()
    return table.read()


def par_by_branch(x: Source) -> DataFrame:
    d = x.models.dim_office.where("total_outstanding > 0")
    return d.select("office_name", "total_loans", F.round(s.ratio(F.col("total_overdue") * 100, F.col("total_outstanding")), 2).alias("par_percent")).orderBy(F.col("par_percent").desc())


def default_rate_by_split(x: Source) -> DataFrame:
    return x.models.default_features.where("is_label_mature = 1").groupBy("split_hint").agg(F.count("*").alias("loans"), F.round(F.avg("label_defaulted"), 6).alias("default_rate")).orderBy("split_hint")


BUILD: dict[str, Callable[[Source], DataFrame]] = {
    "current_rows": lambda x: cdc.current_rows(x.raw("clients"), "client_id"),
    "latest_by_key": latest_by_key, "incremental_window": incremental_window, "merge_by_key": merge_by_key, "change_detection": change_detection,
    "dedup_last_wins": lambda x: cdc.last_wins(x.table("events"), ["user_id", "event_type"], "event_id"),
    "watermark": lambda x: cdc.watermark(None, x.raw("loans"), "loans", "loan_id", AUDIT_RUN),
    **{n: (lambda x, n=n: getattr(x.models, n)) for n in "stg_clients stg_loans stg_loan_transactions stg_offices stg_staff stg_loan_products stg_savings_products stg_savings_accounts client_portfolio dim_client dim_office dim_staff dim_loan_product fct_loan_transaction fct_savings_account portfolio_snapshot loan_repayment_behaviour fct_loan loan_performance_monthly scoring_features".split()},
    "default_features": lambda x: x.models.default_features,
    "expectations": _checked, "expectation_summary": lambda x: quality.summary(_checked(x)), "schema_tests": lambda x: quality.test_counts(_schema_tests(x)), "failures_stored": failures_stored, "failing_loans": failing_loans, "row_rejects": row_rejects,
    "ledger_reconciles": lambda x: quality.ledger_off(x.shared.fct_loan),
    "leakage": lambda x: quality.leaking(x.shared.default_features), "leakage_planted": leakage_planted,
    "future_dated": lambda x: quality.future_dated(x.models.fct_loan_transaction, x.models.set.as_of),
    "dated_after": lambda x: quality.future_dated(x.models.fct_loan_transaction, x.models.set.as_of, 2 - 60),
    "bucket_agrees": lambda x: quality.bucket_mismatch(x.shared.fct_loan.withColumn("par_bucket", F.when(F.col("loan_id") % 41 == 0, "Current").otherwise(F.col("par_bucket")))),
    "balance_sanity": balance_sanity,
    "quality_gate": quality_gate, "source_freshness": source_freshness, "caught_up": caught_up,
    "last_success": lambda x: monitor.last_success(runs(x), AUDIT_RUN, 86400),
    "latest_tests": lambda x: monitor.latest_tests(quality.split_results(results(x))[0]), "model_runtimes": lambda x: monitor.model_runtimes(quality.split_results(results(x))[1]), "results_by_layer": results_by_layer,
    "recent_rejects": lambda x: monitor.rejects(rejected(x), AUDIT_RUN), "reject_totals": lambda x: monitor.reject_totals(rejected(x), AUDIT_RUN), "gate_isolated": gate_isolated, "results_history": results_history, "parity": parity,
    "caught_up_all": lambda x: monitor.caught_up(parity(x), monitor.cdc_freshness(x.audit(), AUDIT_RUN, 720)),
    "provisions": provisions, "backfill_guard": backfill_guard, "retained": retained, "merged_by_month": merged_by_month, "compacted": compacted, "packed": packed, "table_files": table_files,
    "wire_round_trip": wire_round_trip, "atomic_load": atomic_load, "load_order": load_order, "stream_replay": stream_replay, "topics_landed": topics_landed, "streamed_counts": streamed_counts, "stream_collapsed": stream_collapsed,
    "cdc_freshness": lambda x: monitor.cdc_freshness(x.audit(), AUDIT_RUN, 720),
    "rolling_counts": lambda x: monitor.rolling_counts(x.audit()).withColumn("window_start", F.unix_seconds("window_start")),
    "raw_health": lambda x: monitor.raw_health(x.raws(), AUDIT_RUN),
    "reconciliation": lambda x: monitor.reconciliation(x.raws(), star.KEYS),
    "row_delta": row_delta,
    "latest_run": lambda x: monitor.latest_run(x.table("events"), "user_id", "ts", "event_id"),
    "par_by_branch": par_by_branch, "default_rate_by_split": default_rate_by_split, "dim_date": dim_date,
}
ROWS_ONLY: dict[str, Callable[[Source], DataFrame]] = {"rest_landing": rest_landing, "table_storage": table_storage}


def _query(build: Callable[[Source], DataFrame], name: str | None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(Source(spark, sf_dir))
        return tidy(df, name) if name else df

    return run


QUERIES = {k: _query(f, k) for k, f in BUILD.items()} | {k: _query(f, None) for k, f in ROWS_ONLY.items()} | {"wire_landing": _query(wire_landing, None), "wire_quarantine": _query(wire_quarantine, None)}
_BAD = "c_custkey % 50 = 0"
ORACLE = {k: pinned(k) for k in BUILD} | {
    "wire_landing": f"""SELECT c_custkey AS savings_id, CAST(c_acctbal AS DECIMAL(19,6)) AS account_balance, DATE '1970-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS activated_on_date, CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_active,
        CASE WHEN c_custkey % 9 = 0 THEN 'd' ELSE 'u' END AS _op, c_custkey * 1000 AS _version, CAST(CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS INTEGER) AS _is_deleted FROM customer WHERE NOT ({_BAD})""",
    "wire_quarantine": f"SELECT 'savings_accounts' AS topic, 'malformed JSON' AS error, count(*) AS messages FROM customer WHERE {_BAD}",
    "rest_landing": "SELECT o_orderkey AS loan_id, o_custkey AS client_id, CAST(300 AS INTEGER) AS status_id, o_orderstatus AS status_value, CAST(1 AS INTEGER) AS is_active, CAST(o_orderdate AS DATE) AS submitted_on_date, CAST(o_orderdate AS DATE) AS disbursed_on_date, CAST(o_totalprice AS DECIMAL(19,6)) AS principal FROM orders",
}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portfolio at risk by office and product."""
    return QUERIES["portfolio_snapshot"](spark, sf_dir)

"""Data quality: row rules with quarantine, batch expectations in one pass, schema tests, invariants and the gate."""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.operators.tables import Table


@dataclass(frozen=True)
class Expectation:
    name: str
    kind: str  # not_null, unique, non_negative, range, row_count_min
    columns: tuple[str, ...] = ()
    severity: str = "error"
    low: float | None = None
    high: float | None = None


def reject_rule(key: str, business: list[str]) -> Column:
    """Which rule a row breaks; NULL for a valid one."""
    empty = reduce(operator.and_, [F.col(c).isNull() for c in business])
    return F.when(F.col(key).isNull(), "primary_key_not_null").when(F.col(key) < 0, "primary_key_positive").when(empty, "record_not_empty")


def reject_row(df: DataFrame, key: str, rule: Column, entity: str) -> list[Column]:
    """entity, source_key, rule and the row as JSON."""
    return [F.lit(entity).alias("entity"), F.col(key).cast("string").alias("source_key"), rule.alias("rule"), F.to_json(F.struct(*df.columns)).alias("payload")]


def split_rejects(df: DataFrame, key: str, business: list[str], entity: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejects with entity, source_key, rule and the row as JSON."""
    rule = reject_rule(key, business)
    return df.where(rule.isNull()), df.where(rule.isNotNull()).select(*reject_row(df, key, rule, entity))


def expectations(df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """check_name, kind, severity, passed, observed_value, threshold_value of each; one aggregation answers all of them."""

    def observed(e: Expectation) -> Column:
        if e.kind == "row_count_min":
            return F.count("*").cast("double")
        if e.kind == "not_null":
            parts = [F.count_if(F.col(c).isNull()) for c in e.columns]
        elif e.kind == "unique":
            parts = [F.count(c) - F.countDistinct(c) for c in e.columns]
        elif e.kind == "non_negative":
            parts = [F.count_if(F.col(c) < 0) for c in e.columns]
        elif e.kind == "range":
            outside = lambda c: F.coalesce(F.col(c) < F.lit(e.low), F.lit(False)) | F.coalesce(F.col(c) > F.lit(e.high), F.lit(False))
            parts = [F.count_if(outside(c)) for c in e.columns]
        else:
            return F.first(F.lit(None).cast("double"))
        return reduce(operator.add, parts, F.lit(0)).cast("double")

    row = df.agg(*[observed(e).alias(f"c{k}") for k, e in enumerate(checks)])

    def result(k: int, e: Expectation) -> Column:
        known, least = e.kind in ("not_null", "unique", "non_negative", "range", "row_count_min"), e.low or 1.0
        passed = F.lit(True) if not known else F.col(f"c{k}") >= least if e.kind == "row_count_min" else F.col(f"c{k}") == 0
        return F.struct(
            F.lit(e.name).alias("check_name"), F.lit(e.kind).alias("kind"), F.lit(e.severity if known else "warn").alias("severity"), passed.alias("passed"), F.col(f"c{k}").alias("observed_value"), F.lit(least if e.kind == "row_count_min" else 0.0).alias("threshold_value")
        )

    return row.select(F.inline(F.array(*[result(k, e) for k, e in enumerate(checks)])))


def summary(results: DataFrame) -> DataFrame:
    failed = ~F.col("passed")
    return results.agg(
        F.count("*").alias("total"), F.count_if(F.col("passed")).alias("passed"), F.count_if(failed & (F.col("severity") == "warn")).alias("warned"), F.count_if(failed & (F.col("severity") != "warn")).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(failed, F.col("check_name")))), ",").alias("failed_names"),
    )


def not_null(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNull())


def unique(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).where("n > 1")


def accepted(df: DataFrame, c: str, values: list) -> DataFrame:
    return df.where(F.col(c).isNotNull() & ~F.col(c).isin(values))


def relationships(df: DataFrame, c: str, parent: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).join(parent.select(F.col(key).alias(c)).distinct(), c, "left_anti")


def test_counts(tests: dict[str, DataFrame]) -> DataFrame:
    """test_name and failures of each set of failing rows."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("failures")).select(F.lit(k).alias("test_name"), "failures") for k, df in tests.items()])


def ledger_off(fct_loan: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Disbursed loans with repayments whose own total isn't that of their ledger."""
    off = fct_loan.where(F.abs(F.col("repayment_reconciliation_delta").cast("double")) > tolerance).where("disbursed_on_date is not null and repayment_count > 0")
    return off.select("loan_id", "total_repayment", "ledger_total_repaid", "repayment_reconciliation_delta")


def leaking(features: DataFrame) -> DataFrame:
    """Rows with a prior feature of their own day or later, or that disagree on whether there is a prior loan."""
    late = (F.col("feat_days_since_prior_loan") <= 0) | (F.col("feat_days_since_prior_repayment") <= 0)
    first, prior = F.col("feat_is_first_time_borrower"), F.col("feat_prior_loan_count")
    bad = features.where(late | ((first == 1) & (prior > 0)) | ((first == 0) & (prior == 0)))
    names = "loan_id observation_date feat_days_since_prior_loan feat_days_since_prior_repayment feat_is_first_time_borrower feat_prior_loan_count".split()
    return bad.select(*names, F.lit("leakage: prior feature is not strictly before observation_date").alias("failure_reason"))


def future_dated(facts: DataFrame, as_of, slack: int = 2) -> DataFrame:
    late = facts.where(F.col("transaction_date") > F.date_add(F.lit(as_of), slack))
    return late.select("transaction_id", "loan_id", "transaction_date", F.datediff("transaction_date", F.lit(as_of)).alias("days_in_future"))


def bucket_mismatch(fct_loan: DataFrame) -> DataFrame:
    return fct_loan.select("loan_id", "days_past_due", "par_bucket", s.par_bucket("days_past_due").alias("expected_bucket")).where("par_bucket <> expected_bucket")


#: What is wrong with a balance, in the order in which it is looked for.
BALANCES = {
    "outstanding principal exceeds disbursed": "principal_outstanding > principal_disbursed + 1",
    "negative balance": "principal_outstanding < 0 or total_outstanding < 0 or total_overdue < 0",
    "overdue exceeds total outstanding": "total_overdue > total_outstanding + 1",
    "loan is both active and closed": "is_active = 1 and is_closed = 1",
}


def balance_reasons(fct_loan: DataFrame) -> DataFrame:
    """Disbursed loans whose balances can't be, with the first reason that holds."""
    reason = F.coalesce(*[F.when(F.expr(rule), F.lit(name)) for name, rule in BALANCES.items()])
    names = "loan_id principal_disbursed principal_outstanding total_outstanding total_overdue is_active is_closed".split()
    return fct_loan.where("disbursed_on_date is not null").select(*names, reason.alias("failure_reason")).where("failure_reason is not null")


_COMPARE: dict[str, Callable] = {">": operator.gt, ">=": operator.ge, "==": operator.eq, "<=": operator.le, "<": operator.lt}


def gate(checks: list[tuple[str, DataFrame, str, float, bool]]) -> DataFrame:
    """check_name, value, passed, blocking of (name, one-number frame, comparison, threshold, blocking). No number is a failure."""
    rows = []
    for name, df, how, threshold, blocking in checks:
        value = F.col(df.columns[0]).cast("double")
        ok = F.coalesce(_COMPARE[how](value, F.lit(float(threshold))), F.lit(False))
        rows.append(df.select(F.lit(name).alias("check_name"), value.alias("value"), ok.alias("passed"), F.lit(blocking).alias("blocking")))
    return reduce(DataFrame.unionByName, rows)


def gate_of(parts: list[tuple[DataFrame, list[tuple[str, Column, str, float, bool]]]]) -> DataFrame:
    """The gate's rows for (table, checks) pairs, where each check has an aggregate. One pass over a table answers all of its
    checks; if that can't be planned or fails while it runs, each check gets a pass of its own, so that one which fails is a
    row with its error and the others keep their values. Runs when it is called."""
    rows = []
    for df, checks in parts:
        try:
            values = df.agg(*[value.cast("double").alias(f"c{k}") for k, (_, value, *_) in enumerate(checks)]).first()
            answers: list[tuple[float | None, str | None]] = [(values[k], None) for k in range(len(checks))]
        except Exception:  # one of them, or the table
            answers = [_answer(df, value) for _, value, *_ in checks]
        for (name, _, how, threshold, blocking), (value, error) in zip(checks, answers, strict=True):
            rows.append((name, value, value is not None and _COMPARE[how](value, float(threshold)), blocking, error))
    return parts[0][0].sparkSession.createDataFrame(rows, "check_name string, value double, passed boolean, blocking boolean, error string")


def _answer(df: DataFrame, value: Column) -> tuple[float | None, str | None]:
    try:
        return df.agg(value.cast("double").alias("value")).first()[0], None
    except Exception as e:
        return None, (str(e).strip().split("\n")[0] or type(e).__name__)[:2000]


def keep_results(results: DataFrame, tests: Table, models: Table, now: dt.datetime, days: int = 180) -> None:
    """Appends a run's results to the two histories, which are partitioned by the `day` of the run, and lets go of what is
    older than so many days; folders of whole days go unread."""
    for rows, table in zip(split_results(results), (tests, models), strict=True):
        table.append(rows.withColumn("day", F.to_date("executed_at")))
        table.expire("day", days, now)


def failing_rows(tests: dict[str, DataFrame], path: str) -> DataFrame:
    """Writes the failing rows of each test under its name, those of earlier runs replaced, and gives test_name and failures
    as counted in what was written. Tests without failures leave an empty table."""
    for name, df in tests.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    session = next(iter(tests.values())).sparkSession
    return test_counts({name: session.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in tests.items()})


def layer_of(name: Column) -> Column:
    """The layer of a node: by a layer's own name in its path, then by prefix; tests of no layer are "tests"."""
    out = F.lit(None).cast("string")
    for layer in ("staging", "intermediate", "marts", "ml"):
        out = F.coalesce(out, F.when(name.contains(f".{layer}.") | name.startswith(f"test.{layer}"), layer))
    for prefix, layer in (("stg_", "staging"), ("int_", "intermediate")):
        out = F.coalesce(out, F.when(name.contains(prefix), layer))
    return F.coalesce(out, F.when(name.startswith("test."), "tests"), F.lit("other"))


def split_results(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Test rows and model rows of a run's results (invocation_id, run_id, executed_at, node_id, status, execution_time,
    failures, materialization, rows_affected, message), as the two history tables have them."""
    name = F.element_at(F.split("node_id", "[.]"), -1)
    common = results.withColumns({"layer": layer_of(F.col("node_id")), "name": name, "execution_time": F.round("execution_time", 4), "message": F.substring(F.coalesce("message", F.lit("")), 1, 2000)})
    failures, is_test = F.coalesce(F.col("failures"), F.lit(0)), F.col("node_id").startswith("test.")
    head, tail = ["invocation_id", "run_id", "executed_at", "node_id"], ["execution_time", "message"]
    tests = common.where(is_test).select(*head, F.col("name").alias("test_name"), F.col("name").alias("model_name"), "layer", "status", F.when(failures > 0, "error").otherwise("ok").alias("severity"), failures.alias("failures"), *tail)
    models = common.where(~is_test).select(*head, F.col("name").alias("model_name"), "layer", F.coalesce("materialization", F.lit("")).alias("materialization"), "status", F.coalesce("rows_affected", F.lit(0)).alias("rows_affected"), *tail)
    return tests, models


def freshness(tables: dict[str, DataFrame], run_ts, column: str, warn_hours: float, error_hours: float) -> DataFrame:
    age = (F.unix_seconds(F.lit(run_ts).cast("timestamp")) - F.unix_seconds("newest")) / 3600.0
    newest = reduce(DataFrame.unionByName, [df.agg(F.max(column).alias("newest")).select(F.lit(k).alias("table_name"), "newest") for k, df in tables.items()])
    state = F.when(F.col("newest").isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    return newest.withColumns({"age_hours": age, "status": state})

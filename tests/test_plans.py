"""Scans that read what is asked for, and quantiles of groups of any size."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.functions import parsing as p
from tidemark.operators import cdc
from tidemark.operators.quantiles import bucket, quantiles
from tidemark.plans.models import Models
from tidemark.sources import landing, star

SF = "/root/testdata/sf0.001"


def read_columns(df):
    """Columns of the Parquet scans of a plan."""
    schemas = [line.split("ReadSchema: struct<", 1)[1].rstrip(">") for line in df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted").split("\n") if "ReadSchema: struct<" in line]
    return {c.split(":")[0] for s in schemas for c in s.split(",") if c}


def test_collapse_reads_what_is_asked_for(spark, tmp_path):
    raw = spark.range(100).select((F.col("id") % 9).alias("k"), *[F.lit(n).alias(f"c{n}") for n in range(20)], F.col("id").alias("_version"), F.lit(0).alias("_lsn"), F.lit(0).alias("_tx_id"), F.lit(0).alias("_is_deleted"), F.lit("u").alias("_op"))
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert read_columns(cdc.newest(raw, "k", columns=[]).select("k")) == {"k", "_version", "_lsn", "_tx_id", "_is_deleted"}
    assert read_columns(cdc.latest_by_key(raw.withColumn("_source_commit_at", F.lit(0)), ["k"], ["c3"])) == {"k", "c3", "_version", "_lsn", "_tx_id", "_is_deleted"}
    assert cdc.newest(raw, "k").columns == raw.columns and cdc.newest(raw, "k").count() == 9


def test_collapse_keeps_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(1, "a", 1, 7), (1, "b", 2, 8)], "k long, _tie string, _version long, _NTH long")
    assert [tuple(r) for r in cdc.newest(df, "k").collect()] == [(1, "b", 2, 8)]
    assert [tuple(r) for r in cdc.last_wins(df, ["k"], "_version").collect()] == [(1, "b", 2, 8)]
    changed = cdc.classify_changes(df.withColumn("_old", F.lit(1)), df.withColumn("_old", F.lit(2)), ["k"], ["_tie", "_old"])
    assert changed.columns == ["k", "_tie", "_version", "_NTH", "_old", "change"] and {r["_old"] for r in changed.collect()} == {2}


def test_narrow_loans_are_the_stage(spark):
    m = Models(lambda e: star.raw(spark, SF, e))
    for names in (("loan_id", "par_bucket", "is_in_default"), ("office_id", "status", "principal_repaid_ratio", "term_days"), ("loan_key", "cdc_version", "days_past_due", "repayment_progress_ratio", "days_since_disbursement", "is_written_off")):
        a, b = m.loans(*names), m.stg_loans.select(*names)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    names = ("transaction_id", "transaction_category", "is_countable", "transaction_month", "amount")
    a, b = m.transactions(*names), m.stg_loan_transactions.select(*names)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_a_stage_keeps_what_is_looked_at(spark):
    kept = {}
    keep = lambda df, name: kept.setdefault(name, shared.written(df, name))
    few = ("loan_id", "client_id", "product_id", "is_active", "days_past_due", "total_outstanding", "disbursed_on_date")
    m, whole = Models(lambda e: star.raw(spark, SF, e), keep=keep, columns={"stg_loans": few}), Models(lambda e: star.raw(spark, SF, e))
    assert m.stg_loans.columns == whole.stg_loans.columns and m.stg_loans.dtypes == whole.stg_loans.dtypes and kept["stg_loans"].columns == list(few)
    for table, names in (("fct_loan", ("loan_id", "total_outstanding", "client_segment")), ("default_features", ("loan_id", "feat_days_since_prior_loan"))):
        a, b = getattr(m, table).select(*names), getattr(whole, table).select(*names)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    with pytest.raises(Exception, match="principal wasn't kept"):
        m.stg_loans.select("principal").collect()


def test_quantiles_are_those_of_percentile(spark):
    rng = random.Random(9)
    values = [0.0, -0.0, 1.0, 1.0, -5.5, 1e-300, 1e300, -1e300, 123.45, float("inf"), float("-inf")]
    rows = [(rng.choice(["a", "b", None, "one"][:3]), rng.choice([*values, None, rng.gauss(0, 1e3), rng.gauss(0, 1), float(rng.randrange(50))])) for _ in range(3000)] + [("one", 7.25), ("none", None)]
    rows += [("hot", float(k % 977) / 3) for k in range(20_000)]
    df = spark.createDataFrame(rows, "g string, x double")
    at = {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    want = {r.g: r for r in df.where("x is not null").groupBy("g").agg(*[F.percentile("x", F.lit(q)).alias(n) for n, q in at.items()]).collect()}
    got = {r.g: r for r in quantiles(df, ["g"], F.col("x"), at).collect()}
    assert got.keys() == want.keys() and "none" not in got
    for g, r in want.items():
        for n in at:
            assert r[n] == got[g][n] or math.isclose(r[n], got[g][n], rel_tol=1e-12) or (math.isnan(r[n]) and math.isnan(got[g][n])), (g, n, r[n], got[g][n])
    total = quantiles(df.where("g = 'hot'"), [], F.col("x"), {"m": 0.5}).collect()
    assert [r.m for r in total] == [want["hot"].p50]
    assert quantiles(df.where("false"), ["g"], F.col("x"), at).count() == 0


def test_buckets_are_in_order_and_small(spark):
    df = spark.range(200_000).select((F.col("id") / 100).alias("v")).withColumn("b", bucket(F.col("v")))
    assert df.where("v < 2000").groupBy("b").count().agg(F.max("count")).first()[0] < 300
    pairs = spark.createDataFrame([(float(x),) for x in (float("-inf"), -1e9, -2.5, -0.1, 0, 0.1, 2.5, 1e9, float("inf"), float("nan"))], "v double").select("v", bucket(F.col("v")).alias("b")).collect()
    assert [r.b for r in pairs] == sorted(r.b for r in pairs)


@pytest.mark.parametrize(
    ("text", "at"),
    [
        ("[2026,8,11]", (2026, 8, 11)), ("[2026,8,11,14,30,5]", (2026, 8, 11, 14, 30, 5)), ("[2026,8,11,14,30]", (2026, 8, 11, 14, 30)), ("[2026,13,1]", None), ("[2026,8]", None),
        ("2026-08-11T14:30:05Z", (2026, 8, 11, 14, 30, 5)), ("2026-08-11 14:30:05", (2026, 8, 11, 14, 30, 5)), ("2026-08-11T14:30:05+02:00", (2026, 8, 11, 12, 30, 5)), (" 2026-08-11 ", (2026, 8, 11)),
        ("1786458605", (2026, 8, 11, 14, 30, 5)), ("1786458605000", (2026, 8, 11, 14, 30, 5)), ("soon", None), ("", None), (None, None),
    ],
)
def test_timestamps(spark, text, at):
    got = spark.createDataFrame([(text,)], "x string").select(p.parse_timestamp(F.col("x"))).first()[0]
    assert got == (dt.datetime(*at) if at else None)


def test_enumerations(spark):
    rows = [('{"id":300,"value":"Active"}',), ("7",), ("Flat",), (None,)]
    got = spark.createDataFrame(rows, "x string").select(p.enum_id(F.col("x")), p.enum_value(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [(300, "Active"), (7, "7"), (None, "Flat"), (None, None)]


def test_what_old_sessions_left_is_swept(spark):
    root = shared.folder(spark).removeprefix("file://")
    for name, age in (("tidemark-old", 9), ("tidemark-young", 1), ("other", 30)):
        os.makedirs(f"{root}/{name}/stage")
        os.utime(f"{root}/{name}", times=(0, dt.datetime.now().timestamp() - age * 86_400))
    kept = shared.written(spark.range(3).toDF("k"))
    assert shared.sweep(spark) == 1 and sorted(x for x in os.listdir(root) if x in ("tidemark-old", "tidemark-young", "other")) == ["other", "tidemark-young"]
    assert kept.count() == 3


def test_messages_are_parsed_once(spark):
    e = landing.REGISTRY["loan_transactions"]
    events = landing.parse_events(spark.range(1).select(F.col("id").cast("string").alias("value")), e)
    plan = landing.typed_rows(events, e, F.current_timestamp())._jdf.queryExecution().optimizedPlan().toString()
    parsing = [line.strip(" +-") for line in plan.split("\n") if "from_json(StructField(transaction_id" in line]
    assert len(parsing) == 1 and parsing[0].startswith("Generate") and parsing[0].count("from_json(StructField(transaction_id") == 1

"""Change-data semantics on small frames, and registered queries against their SQL."""

import datetime as dt
import json
import re
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import queries, shared
from tidemark.functions import parsing as p
from tidemark.functions import scalars as s
from tidemark.operators import asof, cdc, load, quality, tables
from tidemark.operators.tables import Conflict, Table, replace_day
from tidemark.plans.models import Models
from tidemark.sources import landing, seeds, star
from tidemark.streaming import continuous

SF = "/root/testdata/sf0.001"
SCHEMA = "k long, v string, _version long, _lsn long, _tx_id long, _is_deleted int, _source_commit_at timestamp"


def versions(spark, rows):
    return spark.createDataFrame([(k, v, n, lsn, 0, d, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=n)) for k, v, n, lsn, d in rows], SCHEMA)


def test_collapse_ties_nulls_and_deletes(spark):
    df = versions(spark, [(1, "a", 1, 0, 0), (1, None, 2, 0, 0), (2, "b", 5, 1, 0), (2, "c", 5, 2, 0), (3, "x", 1, 0, 0), (3, None, 2, 0, 1)])
    assert {(r.k, r.v) for r in cdc.current_rows(df, "k").collect()} == {(1, None), (2, "c")}
    assert {r.k: r.v for r in cdc.latest_by_key(df, ["k"], ["v"], skip_nulls=True).collect()} == {1: "a", 2: "c", 3: "x"}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["a", "b", None]), st.integers(1, 5), st.integers(0, 3), st.integers(0, 1)), min_size=1, max_size=12), st.randoms())
def test_collapse_ignores_order_of_arrival(spark, rows, random):
    mixed = rows[:]
    random.shuffle(mixed)
    out = lambda x: {tuple(r) for r in cdc.current_rows(versions(spark, x), "k").collect()}
    assert out(rows) == out(mixed)


def test_merge_is_idempotent_and_deletes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "z", 0), (1, None, 1), (3, "c", 0)], "k long, v string, gone int")
    once = cdc.merge_by_key(old, new, ["k"], "gone")
    assert {tuple(r) for r in once.collect()} == {(2, "z"), (3, "c")} == {tuple(r) for r in cdc.merge_by_key(once, new, ["k"], "gone").collect()}


def test_incremental_equals_rebuild(spark):
    m = Models(lambda e: star.raw(spark, SF, e))
    full = m.stg_loan_transactions
    behind = Models(lambda e: star.raw(spark, SF, e).where("_version < 10500"))
    target = behind.stg_loan_transactions
    m.set = type(m.set)(lookback_hours=24 * 3650)
    got = m.stg_loan_transactions_incremental(target)
    assert sorted(got.select("transaction_id", "cdc_version").collect()) == sorted(full.select("transaction_id", "cdc_version").collect())


def test_change_detection_sees_null_updates(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string"), spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "d")], "k long, v string")
    assert {r.k: r.change for r in cdc.classify_changes(old, new, ["k"], ["v"]).collect()} == {1: "unchanged", 2: "updated", 3: "unchanged", 4: "inserted"}


@pytest.mark.parametrize(("text", "day"), [("[2026,8,11]", "2026-08-11"), ("[2026,8,11,14,30,0]", "2026-08-11"), ("2026-08-11", "2026-08-11"), ("11 August 2026", "2026-08-11"), ("11/08/2026", "2026-08-11"), ("1786406400000", "2026-08-11"), ("[2026,2,31]", None), ("no", None), (None, None)])
def test_dates(spark, text, day):
    got = spark.createDataFrame([(text,)], "x string").select(p.parse_date(F.col("x"))).first()[0]
    assert got == (dt.date.fromisoformat(day) if day else None)


def test_scalars(spark):
    row = spark.createDataFrame([(None, 0)], "a int, z int").select(
        s.par_bucket("a").alias("none"), s.par_bucket(F.lit(31)).alias("b31"), s.ratio(F.lit(1), F.col("z")).alias("r"), s.months_between(F.lit(dt.date(2020, 1, 31)), F.lit(dt.date(2020, 2, 1))).alias("m"),
        s.week_start(F.lit(dt.date(2026, 8, 12))).alias("w"), s.category(F.lit(7)).alias("c"), p.parse_int(F.lit("3.0")).alias("i"), p.parse_bool(F.lit("Yes")).alias("y"),
    ).first()
    assert tuple(row) == ("Current", "PAR 31-60", None, 1, dt.date(2026, 8, 9), "recovery_repayment", 3, True)


def test_windows_agree_with_the_range_join(spark):
    loans = Models(lambda e: star.raw(spark, SF, e)).stg_loans.where("disbursed_on_date is not null")
    c = ["loan_id", "prior_loan_count", "prior_last_disbursement_date"]
    assert sorted(asof.prior_loans(loans).select(*c).collect()) == sorted(asof.prior_loans_by_join(loans).select(*c).collect())


def test_expectations_and_gate(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -2.0), (None, None)], "k long, x double")
    e = quality.Expectation
    got = {r.check_name: (r.passed, r.observed_value) for r in quality.expectations(df, [e("n", "not_null", ("k",)), e("u", "unique", ("k",)), e("g", "non_negative", ("x",)), e("r", "range", ("x",), "error", 0, 4), e("m", "row_count_min", (), "error", 2), e("q", "what")]).collect()}
    assert got == {"n": (False, 1.0), "u": (False, 1.0), "g": (False, 1.0), "r": (False, 2.0), "m": (True, 3.0), "q": (True, None)}
    assert not quality.gate([("none", df.agg(F.max(F.lit(None).cast("double"))), "==", 0, True)]).first().passed


def test_table_versions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    rows = lambda: {tuple(r) for r in t.read().collect()}
    t.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), sort=["k"], bloom="k")
    t.merge(spark.createDataFrame([(2, "c")], "k long, v string"), ["k"])
    before = {x["path"] for x in t.pointer()["folders"]}
    t.append(spark.createDataFrame([(9, "z")], "k long, v string"))
    assert rows() == {(1, "a"), (2, "c"), (9, "z")} and before < {x["path"] for x in t.pointer()["folders"]}
    staged = t.stage(spark.createDataFrame([(0, "lost")], "k long, v string"))
    with pytest.raises(Conflict):
        t.publish(staged, "k long, v string", after=t.versions()[-2])  # another writer was first
    assert t.versions() == [1, 2, 3] and rows() == {(1, "a"), (2, "c"), (9, "z")}
    assert t.vacuum(keep=1) == 2 and t.versions() == [3] and len(rows()) == 3
    day = spark.createDataFrame([(dt.date(2020, 1, 1), 1)], "snapshot_date date, n int")
    assert replace_day(day, day.withColumn("n", F.lit(2))).collect() == [(dt.date(2020, 1, 1), 2)]


def test_table_partitions_are_written_only_where_touched(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "day")
    day = lambda n: dt.date(2020, 1, n)
    t.replace(spark.createDataFrame([(1, day(1)), (2, day(2)), (3, day(3)), (4, None)], "k long, day date"))
    old = {x["part"]: x["path"] for x in t.pointer()["folders"]}
    t.merge(spark.createDataFrame([(1, day(2), 0), (3, day(3), 1), (5, day(4), 0)], "k long, day date, gone int"), ["k"], "gone")
    new = {x["part"]: x["path"] for x in t.pointer()["folders"]}
    assert {tuple(r) for r in t.read().collect()} == {(1, day(2)), (2, day(2)), (4, None), (5, day(4))}
    assert new["__HIVE_DEFAULT_PARTITION__"] == old["__HIVE_DEFAULT_PARTITION__"] and new["2020-01-02"] != old["2020-01-02"] and "2020-01-03" not in new
    t.expire("day", 2, dt.datetime(2020, 1, 5, 12))
    assert {tuple(r) for r in t.read().collect()} == {(5, day(4))}


def test_a_merge_shuffles_rows_that_stay_once(spark, tmp_path, monkeypatch):
    old = spark.range(400).select(F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 300).alias("k"), (F.col("id") % 7).alias("m"), F.concat(F.lit("old"), "id").alias("v"))
    new = spark.range(100).select(F.when(F.col("id") == 0, None).otherwise(F.col("id") * 4).alias("k"), F.lit(2).cast("long").alias("m"), F.lit("new").alias("v"), F.when(F.col("id") % 10 == 1, 1).when(F.col("id") % 10 == 2, None).otherwise(0).alias("gone"))
    t = Table(spark, str(tmp_path / "t"), "m")
    t.replace(old)
    monkeypatch.setattr(tables, "MERGED", 1 + sum(size for x in t.pointer()["folders"] for _, size in t.files(x)) // (3 * 7))
    plans, stage = [], Table.stage
    monkeypatch.setattr(Table, "stage", lambda self, df, **how: plans.append((how.get("dealt", False), df._jdf.queryExecution().optimizedPlan().toString())) or stage(self, df, **how))
    t.merge(new, ["k"], "gone")
    want = cdc.merge_by_key(old, new, ["k"], "gone")
    assert want.count() == t.read().count() and not want.exceptAll(t.read()).count()
    assert [dealt for dealt, _ in plans] == [True, False] and plans[0][1].count("RepartitionByExpression") == 1 and "LeftAnti" not in plans[0][1]


def test_source_rows_make_the_same_newest_rows_and_tables(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    for name, key in star.KEYS.items():
        want, got = cdc.newest(star.raw(spark, d, name), key), star.of(star.newest(star.source(spark, d, name), name), name)
        assert got.columns == want.columns and want.count() == got.count() > 0 and not want.exceptAll(got).count()
    t, plain = (Table(spark, str(tmp_path / n), "m") for n in ("t", "plain"))
    made = lambda df: df.select("id", (F.col("id") % 3).alias("m"), F.concat(F.lit("n"), "id").alias("v"))
    t.replace(spark.range(50), part=(F.col("id") % 3).cast("string"), made=made)
    plain.replace(made(spark.range(50)))
    assert sorted(x["part"] for x in t.pointer()["folders"]) == ["0", "1", "2"] and t.pointer()["schema"] == plain.pointer()["schema"]
    assert sorted(map(tuple, t.read().collect())) == sorted(map(tuple, plain.read().collect())) and t.frame(t.pointer(), lambda p: p == "1").count() == 17


def test_lake_loads_are_atomic(spark, tmp_path):
    lake, e = load.Lake(spark, str(tmp_path / "lake")), landing.REGISTRY["offices"]
    frame = lambda rows: spark.createDataFrame([(i, None, name, None, None, None, None, None) for i, name in rows], ", ".join(["office_id long", "parent_id long", *[f"{c} string" for c in ("name", "name_decorated", "external_id", "parent_name", "hierarchy")], "opening_date date"])).select(*e.columns)
    at = [dt.datetime(2026, 1, n) for n in range(1, 9)]
    assert lake.load(e, frame([(1, "a"), (2, "b")]), at[0]) == load.Outcome("offices", "success", 2, 2)
    assert lake.load(e, frame([(1, "a"), (2, "b")]), at[1]) == load.Outcome("offices", "success", 2, 0, 0, 2) and lake.table("offices").versions() == [1]
    assert lake.load(e, frame([(1, "z"), (2, "b"), (3, "c")]), at[2], dry_run=True).status == "skipped" and lake.table("offices").versions() == [1]
    assert lake.load(e, frame([(1, "z"), (2, "b"), (3, "c")]), at[2]) == load.Outcome("offices", "success", 3, 1, 1, 1)
    row = {r.office_id: r for r in lake.table("offices").read().collect()}
    assert (row[1]["name"], row[1]._ingested_at, row[1]._updated_at, row[2]._updated_at) == ("z", at[0], at[2], at[0])
    failed = lake.load(e, frame([(1, "q"), (None, "x"), (-5, "y")]), at[3])
    assert failed.status == "failed" and "reject ratio" in failed.error and lake.table("offices").versions() == [1, 2]
    empty = lake.load(e, frame([(1, "q")]).where("false"), at[4])
    assert empty.status == "failed" and "has_head_office" in empty.error
    twice = lake.load(e, frame([(1, "q"), (1, "r")]), at[5])
    assert twice.status == "failed" and "office_id_unique" in twice.error
    mark = lake.table("watermarks").read().first()
    assert (mark.last_cursor, mark.last_row_count, mark.total_rows_loaded, mark.last_success_at) == ("3", 3, 7, at[2])
    assert [r.status for r in lake.table("runs").read().orderBy("started_at", "status").collect()] == ["success", "success", "skipped", "success", "failed", "failed", "failed"]
    gone = lambda name: frame([(None, "x")]) if name == "offices" else spark.range(1).selectExpr("no_such_column")
    assert [o.status for o in lake.load_all(gone, at[6], ["offices"], fail_fast=True)] == ["failed"]
    order = lake.load_all(lambda name: frame([(1, "a")]), at[7], ["offices", "staff"])
    assert [(o.entity, o.status) for o in order] == [("offices", "success"), ("staff", "failed")]


def test_watermark_keeps_its_cursor(spark):
    one = spark.createDataFrame([(3,), (5,)], "k long")
    first = cdc.watermark(None, one, "e", "k", dt.datetime(2020, 1, 1))
    none = cdc.watermark(first, one.where("false"), "e", "k", dt.datetime(2020, 1, 2)).first()
    assert (none.last_cursor, none.last_row_count, none.total_rows_loaded) == ("5", 0, 2)


def test_gate_counts_errors_as_failures(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    got = {r.check_name: r for r in quality.gate_of([(df, [("there", F.count("*"), ">", 0, True), ("gone", F.sum("no_such_column"), "==", 0, True), ("none", F.max(F.lit(None).cast("long")), "==", 0, False)])]).collect()}
    assert got["there"].passed and not got["gone"].passed and "no_such_column" in got["gone"].error and not got["none"].passed and got["none"].error is None


def test_seed_types(spark, tmp_path):
    (tmp_path / "s.csv").write_text("bucket_order,bucket_name\n1,Current\n")
    assert seeds.read_csv(spark, str(tmp_path / "s.csv"), "bucket_order int, bucket_name string").first() == (1, "Current")
    (tmp_path / "t.csv").write_text("bucket_order,bucket_name\nx,Current\n")
    with pytest.raises(Exception, match="MALFORMED"):
        seeds.read_csv(spark, str(tmp_path / "t.csv"), "bucket_order int, bucket_name string").collect()


def test_shared_folder(spark):
    df = shared.written(spark.range(3).toDF("k"))
    assert shared.folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = shared.written(spark.range(3).toDF("k"))
    assert df.count() == 3 and shared.folder(spark) in df.inputFiles()[0]


def test_stream_lands_replays_and_quarantines(spark, tmp_path):
    e = landing.REGISTRY["loans"]
    lines = [
        {"loan_id": 9001, "principal": "250000.000000", "submitted_on_date": -3, "is_active": True, "__op": "u", "__ts_ms": 1786440600250, "__source_ts_ms": 1786440600000, "later": 1},
        {"loan_id": 9001, "__op": "d", "__ts_ms": 1786440605000, "__source_ts_ms": 1786440604000, "__deleted": "true"},
        {"loan_id": 9001, "status_value": "Stale", "__op": "u", "__ts_ms": 1786440609000, "__source_ts_ms": 1786440540000},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*map(json.dumps, lines), "{not json"]))

    def run(checkpoint):
        q = continuous.land(continuous.from_files(spark, str(tmp_path / "in")), e, str(tmp_path / "out"), str(tmp_path / checkpoint), {"availableNow": True}).start()
        q.awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "out/typed"))

    run("c")
    for f in (tmp_path / "c" / "commits").iterdir():
        f.unlink()  # as if the run had died before it could say that the batch was done
    typed = run("c")
    assert typed.count() == 3 and cdc.current_rows(typed.drop("batch", "stream"), "loan_id").count() == 0
    first = typed.where("_op = 'u' and principal is not null").first()
    assert str(first.principal) == "250000.000000" and first.submitted_on_date == dt.date(1969, 12, 29) and first.is_active == 1
    assert spark.read.parquet(str(tmp_path / "out/errors")).first().raw_message == "{not json" and spark.read.parquet(str(tmp_path / "out/audit")).count() == 3
    again = run("another")  # a stream of its own: nothing of the first is overwritten, and the collapse sees no difference
    assert again.count() == 6 and cdc.current_rows(again.drop("batch", "stream"), "loan_id").count() == 0


def fixture_columns():
    """Name and type of every business column by entity, from FIXTURES.md section 2."""
    text = (Path(__file__).parents[1] / "FIXTURES.md").read_text().split("\n## ")[2]
    for part in text.split("\n### ")[1:]:
        rows = re.findall(r"^\| (bigint|int|string|date|decimal\(19,6\)) \| (.*) \|$", part, re.M)
        yield part.split()[0], {c: t for t, names in rows for c in re.findall(r"`(\w+)!?`", names)}


def as_events(raw, columns):
    wire = lambda c, t: F.unix_date(c) if t == "date" else F.col(c).cast("string") if t.startswith("decimal") else F.col(c).cast("boolean") if c.startswith("is_") else F.col(c)
    meta = {"__op": F.col("_op"), "__source_ts_ms": F.unix_millis("_source_commit_at"), "__source_lsn": F.col("_lsn"), "__deleted": F.col("_is_deleted").cast("boolean").cast("string")}
    return raw.select(F.to_json(F.struct(*[wire(c, t).alias(c) for c, t in columns.items()], *[x.alias(n) for n, x in meta.items()])).alias("value"))


def test_every_business_column_is_landed(spark):
    fixtures = dict(fixture_columns())
    assert fixtures.keys() == landing.REGISTRY.keys() and len(fixtures["loans"]) == 58
    values = {"bigint": 1 << 40, "int": 1, "string": "é", "date": dt.date(1969, 12, 30), "decimal(19,6)": Decimal("1234567890.123456")}

    def raw(name):
        df = star.raw(spark, SF, name)
        return df.withColumns({c: F.lit(values[t]).cast(t) for c, t in fixtures[name].items() if c not in df.columns})

    def landed(name):
        e = landing.REGISTRY[name]
        return landing.typed_rows(landing.parse_events(as_events(raw(name), fixtures[name]), e), e, F.lit(dt.datetime(2026, 1, 1)))

    for name, columns in fixtures.items():
        got = landed(name).select(*columns)
        assert {f.name: f.dataType.simpleString() for f in got.schema} == columns
        want = raw(name).select(*columns)
        assert want.count() > 0 and want.exceptAll(got).count() == 0 == got.exceptAll(want).count()
    loans = Models(landed).stg_loans
    want = Models(raw).stg_loans
    same = [c for c in want.columns if not c.startswith(("cdc_", "source_"))]
    assert loans.select("principal_repaid_ratio").where("principal_repaid_ratio > 0").count() > 0 and want.select(same).exceptAll(loans.select(same)).count() == 0


def test_pages_of_every_resource_are_landed(spark):
    status = {"id": 300, "code": "s.active", "value": "Active", "active": True, "closed": False, "overpaid": False}
    pages = {
        "offices": ([{"id": 2, "name": " Head ", "nameDecorated": "..Head", "parentId": 1, "openingDate": [2009, 1, 5]}], {"office_id": 2, "name": "Head", "name_decorated": "..Head", "parent_id": 1, "opening_date": dt.date(2009, 1, 5), "external_id": None}),
        "staff": ([{"id": 3, "displayName": "A, B", "officeId": 2, "isLoanOfficer": True, "isActive": False, "mobileNo": "", "joiningDate": "11 August 2026"}], {"staff_id": 3, "display_name": "A, B", "office_id": 2, "is_loan_officer": 1, "is_active": 0, "mobile_no": None, "joining_date": dt.date(2026, 8, 11)}),
        "loan_products": ([{"id": 4, "shortName": "L", "currency": {"code": "KES", "decimalPlaces": 2}, "minPrincipal": 10.5, "repaymentFrequencyType": {"id": 2, "value": "Months"}, "interestType": "Flat", "closeDate": [2026, 2, 31]}], {"product_id": 4, "short_name": "L", "currency_code": "KES", "currency_decimal_places": 2, "min_principal": Decimal("10.5"), "repayment_frequency_type": "Months", "interest_type": "Flat", "close_date": None}),
        "savings_products": ([{"id": 5, "nominalAnnualInterestRate": "3.25", "interestPostingPeriodType": {"value": "Monthly"}, "minRequiredOpeningBalance": 0}], {"product_id": 5, "nominal_annual_interest_rate": Decimal("3.25"), "interest_posting_period_type": "Monthly", "min_required_opening_balance": Decimal(0)}),
        "clients": ({"pageItems": [{"id": 6, "status": status, "subStatus": {"id": 1}, "active": True, "timeline": {"submittedOnDate": [2025, 1, 3]}, "gender": {"id": 9, "value": "F"}, "legalForm": "PERSON", "emailAddress": "a@b.c"}]}, {"client_id": 6, "status_id": 300, "status_code": "s.active", "status_value": "Active", "sub_status_value": None, "is_active": 1, "submitted_on_date": dt.date(2025, 1, 3), "gender_value": "F", "legal_form_value": "PERSON", "email_address": "a@b.c"}),
        "loans": ({"pageItems": [{"id": 7, "loanProductId": 4, "status": status, "timeline": {"expectedDisbursementDate": [2025, 1, 12], "actualMaturityDate": [2025, 9, 1]}, "termPeriodFrequencyType": {"value": "Months"}, "summary": {"principalPaid": 1.5, "penaltyChargesOutstanding": 2, "totalRepayment": 3}, "delinquent": {"pastDueDays": 0, "delinquentDays": 8, "delinquentAmount": 4}}]}, {"loan_id": 7, "product_id": 4, "status_id": 300, "is_closed": 0, "is_overpaid": 0, "disbursed_on_date": dt.date(2025, 1, 12), "closed_on_date": dt.date(2025, 9, 1), "term_frequency_type": "Months", "principal_paid": Decimal("1.5"), "penalty_charges_outstanding": Decimal(2), "total_repayment": Decimal(3), "delinquent_days": 8, "delinquent_amount": Decimal(4)}),
        "loan_transactions": ([{"id": 8, "type": {"id": 2, "code": "t.repayment", "value": "Repayment"}, "date": [2025, 2, 3], "amount": 9.25, "feeChargesPortion": 1}], {"transaction_id": 8, "loan_id": 77, "type_id": 2, "type_code": "t.repayment", "type_value": "Repayment", "is_reversed": 0, "transaction_date": dt.date(2025, 2, 3), "amount": Decimal("9.25"), "fee_charges_portion": Decimal(1)}),
        "savings_accounts": ({"id": 9, "savingsProductId": 5, "fieldOfficerId": 3, "status": status, "timeline": {"activatedOnDate": [2025, 3, 4]}, "summary": {"accountBalance": 5.5, "totalInterestPosted": 0.25}}, {"savings_id": 9, "product_id": 5, "field_officer_id": 3, "status_value": "Active", "is_active": 1, "activated_on_date": dt.date(2025, 3, 4), "account_balance": Decimal("5.5"), "total_interest_posted": Decimal("0.25")}),
    }
    assert pages.keys() == landing.REGISTRY.keys()
    for name, (page, want) in pages.items():
        e = landing.REGISTRY[name]
        rows = landing.rest_rows(landing.unwrap(spark.createDataFrame([(77, json.dumps(page))], "parent_id long, value string")), e, "parent_id").collect()
        assert len(rows) == 1 and set(rows[0].asDict()) == set(e.columns)
        assert {c: rows[0][c] for c in want} == want, name


@pytest.mark.parametrize("name", ["current_rows", "stg_loans", "fct_loan_transaction", "default_features", "portfolio_snapshot", "wire_landing", "reconciliation", "wire_round_trip", "topics_landed", "streamed_counts", "stream_collapsed", "atomic_load", "merged_by_month", "balance_sanity", "leakage_planted", "scoring_features"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.execute(queries.ORACLE[name]).df(), queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)

    def plain(v):
        if pd.isna(v):
            return ""
        if isinstance(v, (int, float, Decimal)) or hasattr(v, "dtype") and v.dtype.kind in "ifu":
            return f"{float(v):.4f}"
        return str(v)[:10]

    key = lambda d: sorted(tuple(map(plain, r)) for r in d[cols].astype(object).itertuples(index=False))
    assert cols == sorted(got.columns) and key(want) == key(got)


def test_sql_of_the_newest_version_where_parts_have_large_numbers(spark, tmp_path):
    """A part's number is in the log position: from a million on that must not outweigh the version."""
    day = lambda n: dt.datetime(1995, 1, n)
    rows = [(1, 4, 5, 1, day(3)), (1, 9_000_001, 5, 1, day(2)), (2, 8, 7, 1, day(2)), (2, 2_000_001, 7, 1, day(2)), (2, 2_000_001, 8, 1, day(2))]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz")
    lines.withColumns({"l_extendedprice": F.lit(1.0), "l_returnflag": F.lit("A")}).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    got = queries.QUERIES["latest_by_key"](spark, str(tmp_path))
    want = con.sql(f"select {', '.join(got.columns)} from ({queries.ORACLE['latest_by_key']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r.transaction_id: (r.newest, r.newest_known) for r in got.collect()} == {9: (None, 9_000_001.0), 17: (2_000_001.0, 2_000_001.0)}


def test_a_large_partition_is_written_by_several_tasks_and_packed_into_one_file(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        t = Table(spark, str(tmp_path / "t"), "p")
        t.replace(spark.range(0, 100_000, 1, 8).select(F.xxhash64("id").alias("h"), (F.col("id") % 50 == 49).cast("int").alias("p")))
        assert {x["part"]: len(t.files(x)) > 1 for x in t.pointer()["folders"]} == {"0": True, "1": False}
        t.pack()
        assert all(len(t.files(x)) == 1 for x in t.pointer()["folders"]) and t.read().distinct().count() == 100_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")

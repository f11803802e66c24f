"""The star-schema tables as raw entity tables: several versions of a key, deletes, NULLs and unmatched sides included.

Each entity is a select list in the SQL that both Spark and DuckDB read, so that oracle queries start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc

_cents = "CAST(CAST(round({0} * 100) AS BIGINT) AS DECIMAL(18,0))"


def _share(column: str, eighths: str) -> str:
    """So many eighths of an amount, exactly."""
    return f"CAST({_cents.format(column)} * CAST({eighths} AS DECIMAL(2,0)) * 0.00125 AS DECIMAL(19,6))"


def _meta(version: str, lsn: str, deleted: str = "0", op: str = "'u'") -> dict[str, str]:
    commit = "CAST('1970-01-01 00:00:00' AS TIMESTAMP)"
    return {
        "_op": op, "_version": f"CAST({version} AS BIGINT)", "_lsn": f"CAST({lsn} AS BIGINT)", "_tx_id": "CAST(0 AS BIGINT)", "_is_deleted": f"CAST({deleted} AS INTEGER)",
        "_commit_seconds": f"CAST({version} AS BIGINT)", "_base": commit,
    }


_day = "CAST('{0}' AS DATE) + CAST({1} AS INTEGER)"
_status = "CASE o_orderstatus WHEN 'F' THEN 600 WHEN 'O' THEN 300 ELSE CASE o_orderkey % 3 WHEN 0 THEN 601 WHEN 1 THEN 100 ELSE 700 END END"
_odate = "CAST(o_orderdate AS DATE)"
_paid8 = "CASE WHEN o_orderstatus = 'F' THEN 8 ELSE o_orderkey % 8 END"
_due8 = "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 8 - o_orderkey % 8 END"
_text = "CAST({0} AS STRING)"

#: entity -> (source, where, {column: expression}).
ENTITIES: dict[str, tuple[str, str, dict[str, str]]] = {
    "offices": (
        "(SELECT 10 + r_regionkey AS id, CAST(NULL AS INTEGER) AS parent, r_name AS nm, CAST(NULL AS STRING) AS pname, concat('.', CAST(10 + r_regionkey AS STRING), '.') AS path FROM region"
        " UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, n_name, r_name, concat('.', CAST(10 + n_regionkey AS STRING), '.', CAST(100 + n_nationkey AS STRING), '.') FROM nation JOIN region ON n_regionkey = r_regionkey) s",
        "true",
        {
            "office_id": "CAST(id AS BIGINT)", "parent_id": "CAST(parent AS BIGINT)", "name": "nm", "name_decorated": "concat('..', nm)", "external_id": "CAST(NULL AS STRING)", "parent_name": "pname",
            "hierarchy": "path", "opening_date": f"CASE WHEN id % 7 = 0 THEN CAST(NULL AS DATE) ELSE {_day.format('1990-01-01', 'id')} END", **_meta("id", "0"),
        },
    ),
    "staff": (
        "supplier", "true",
        {
            "staff_id": "s_suppkey", "office_id": "CAST(100 + s_nationkey AS BIGINT)", "is_loan_officer": "CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS INTEGER)",
            "is_active": "CAST(CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 1 END AS INTEGER)", "display_name": "s_name", "firstname": "s_name", "lastname": "CAST(NULL AS STRING)", "office_name": "CAST(NULL AS STRING)",
            "mobile_no": "CAST(NULL AS STRING)", "joining_date": _day.format("1992-01-01", "s_suppkey % 900"), **_meta("s_suppkey", "0"),
        },
    ),
    "loan_products": (
        "(SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS id, o_orderpriority AS nm FROM orders) s", "true",
        {
            "product_id": "id", "name": "nm", "short_name": "substring(nm, 1, 4)", "currency_code": "'KES'", "principal": "CAST(id * 50000 AS DECIMAL(19,6))", "min_principal": "CAST(id * 100 AS DECIMAL(19,6))",
            "max_principal": "CAST(id * 900000 AS DECIMAL(19,6))", "number_of_repayments": "CAST(12 AS INTEGER)", "annual_interest_rate": "CAST(10 + id AS DECIMAL(19,6))", "status": "CASE WHEN id = 5 THEN 'loanProduct.closed' ELSE 'loanProduct.active' END",
            "start_date": "CAST('1992-01-01' AS DATE)", "close_date": "CAST(NULL AS DATE)", **_meta("id", "0"),
        },
    ),
    "savings_products": (
        "(SELECT 1 AS id, 'Ordinary' AS nm UNION ALL SELECT 2, 'Fixed') s", "true",
        {
            "product_id": "CAST(id AS BIGINT)", "name": "nm", "short_name": "substring(nm, 1, 3)", "currency_code": "'KES'", "nominal_annual_interest_rate": "CAST(id AS DECIMAL(19,6))",
            "interest_posting_period_type": "'Monthly'", "status": "'Active'", **_meta("id", "0"),
        },
    ),
    "clients": (
        "customer CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2) s", "v = 2 OR c_custkey % 3 = 0",
        {
            "client_id": "c_custkey", "office_id": "CAST(100 + c_nationkey AS BIGINT)", "staff_id": "CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 1 + c_custkey % 10 END AS BIGINT)",
            "account_no": f"concat('C', {_text.format('c_custkey')})", "external_id": "CAST(NULL AS STRING)", "status_id": "CAST(CASE v WHEN 1 THEN 100 ELSE 300 END AS INTEGER)", "status_value": "CASE v WHEN 1 THEN 'Pending' ELSE 'Active' END",
            "is_active": "CAST(CASE WHEN v = 1 THEN NULL WHEN c_custkey % 6 = 0 THEN 0 ELSE 1 END AS INTEGER)", "office_name": "CAST(NULL AS STRING)", "staff_name": "CAST(NULL AS STRING)", "legal_form_value": "'Person'",
            "gender_value": "CASE c_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE CAST(NULL AS STRING) END", "client_type_value": "c_mktsegment", "client_classification_value": "CASE WHEN c_custkey % 2 = 0 THEN 'Rural' ELSE 'Urban' END",
            "firstname": "c_name", "lastname": "CAST(NULL AS STRING)", "display_name": "c_name", "mobile_no": "CAST(NULL AS STRING)", "email_address": "CAST(NULL AS STRING)",
            "activation_date": f"CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS DATE) ELSE {_day.format('1994-01-01', 'c_custkey % 1000')} END", "submitted_on_date": _day.format("1993-12-01", "c_custkey % 1000"),
            "closed_on_date": "CAST(NULL AS DATE)", "date_of_birth": _day.format("1960-01-01", "c_custkey * 37 % 12000 - 2000"), **_meta("v", "c_custkey", "CASE WHEN v = 2 AND c_custkey % 50 = 0 THEN 1 ELSE 0 END"),
        },
    ),
    "loans": (
        "orders LEFT JOIN customer ON o_custkey = c_custkey CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2) s", "v = 2 OR o_orderkey % 10 = 0",
        {
            "loan_id": "o_orderkey", "client_id": "o_custkey", "product_id": "CAST(substring(o_orderpriority, 1, 1) AS BIGINT)", "office_id": "CAST(100 + c_nationkey AS BIGINT)",
            "loan_officer_id": "CAST(CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 1 + o_orderkey % 10 END AS BIGINT)", "account_no": f"concat('L', {_text.format('o_orderkey')})", "loan_type": "'individual'", "currency_code": "'KES'",
            "status_id": f"CAST(CASE v WHEN 1 THEN 100 ELSE {_status} END AS INTEGER)", "status_value": "CASE v WHEN 1 THEN 'Submitted' ELSE o_orderstatus END",
            "is_active": f"CAST(CASE WHEN v = 2 AND ({_status}) = 300 THEN 1 ELSE 0 END AS INTEGER)", "is_closed": f"CAST(CASE WHEN v = 2 AND ({_status}) IN (600, 601) THEN 1 ELSE 0 END AS INTEGER)",
            "is_overpaid": f"CAST(CASE WHEN v = 2 AND ({_status}) = 700 THEN 1 ELSE NULL END AS INTEGER)", "submitted_on_date": f"{_odate} - 20", "approved_on_date": f"CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS DATE) ELSE {_odate} - CAST(o_orderkey % 15 AS INTEGER) END",
            "disbursed_on_date": f"CASE WHEN v = 1 OR ({_status}) = 100 THEN CAST(NULL AS DATE) ELSE {_odate} END", "expected_maturity_date": f"{_odate} + 365",
            "closed_on_date": f"CASE WHEN ({_status}) IN (600, 601) THEN {_odate} + 400 ELSE CAST(NULL AS DATE) END",
            "overdue_since_date": f"CASE WHEN o_orderkey % 8 = 1 THEN {_day.format('2001-11-05', '-(o_orderkey % 250)')} ELSE CAST(NULL AS DATE) END", "number_of_repayments": "CAST(CASE WHEN o_orderkey % 23 = 0 THEN 0 ELSE 6 + o_orderkey % 18 END AS INTEGER)",
            "repayment_frequency_type": "'Months'", "interest_rate_per_period": "CAST(1 AS DECIMAL(19,6))", "annual_interest_rate": "CAST(12 + o_orderkey % 12 AS DECIMAL(19,6))",
            "principal": _share("o_totalprice", "CASE v WHEN 1 THEN 4 ELSE 8 END"), "approved_principal": _share("o_totalprice", "8"), "principal_disbursed": _share("o_totalprice", f"CASE WHEN ({_status}) = 100 THEN 0 ELSE 8 END"),
            "principal_paid": _share("o_totalprice", _paid8), "principal_written_off": _share("o_totalprice", f"CASE WHEN ({_status}) = 601 THEN 2 ELSE 0 END"), "principal_outstanding": _share("o_totalprice", _due8),
            "principal_overdue": _share("o_totalprice", f"CASE WHEN o_orderkey % 3 = 0 THEN {_due8} ELSE 0 END"), "interest_charged": _share("o_totalprice", "1"), "interest_paid": "CAST(NULL AS DECIMAL(19,6))", "interest_outstanding": _share("o_totalprice", "1"),
            "fee_charges_charged": "CAST(NULL AS DECIMAL(19,6))", "fee_charges_paid": "CAST(NULL AS DECIMAL(19,6))", "penalty_charges_charged": "CAST(NULL AS DECIMAL(19,6))",
            "total_expected_repayment": _share("o_totalprice", "9"), "total_repayment": _share("o_totalprice", _paid8), "total_outstanding": _share("o_totalprice", _due8),
            "total_overdue": _share("o_totalprice", f"CASE WHEN o_orderkey % 3 = 0 THEN {_due8} ELSE 0 END"), "delinquent_amount": "CAST(NULL AS DECIMAL(19,6))", "delinquent_days": "CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 211 END AS INTEGER)",
            **_meta("v", "o_orderkey", "CASE WHEN v = 2 AND o_orderkey % 97 = 0 THEN 1 ELSE 0 END"),
        },
    ),
    "loan_transactions": (
        "lineitem", "true",
        {
            "transaction_id": "l_orderkey * 8 + l_linenumber", "loan_id": "l_orderkey", "office_id": "CAST(NULL AS BIGINT)", "type_id": "CAST(CASE WHEN l_linenumber = 1 THEN 1 WHEN l_suppkey % 3 = 0 THEN l_suppkey % 10 ELSE 2 END AS INTEGER)",
            "type_value": "CAST(NULL AS STRING)", "is_reversed": "CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE NULL END AS INTEGER)", "transaction_date": "CAST(l_shipdate AS DATE)", "submitted_on_date": "CAST(l_shipdate AS DATE)", "currency_code": "'KES'",
            "amount": _share("l_extendedprice", "8"), "principal_portion": _share("l_extendedprice", "6"), "interest_portion": _share("l_extendedprice", "1"), "fee_charges_portion": "CAST(NULL AS DECIMAL(19,6))", "penalty_charges_portion": _share("l_extendedprice", "1"),
            "overpayment_portion": "CAST(NULL AS DECIMAL(19,6))", "outstanding_loan_balance": "CAST(CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_partkey END AS DECIMAL(19,6))",
            **_meta("{days}", "l_partkey * 1000000 + l_suppkey", "CASE WHEN l_partkey % 40 = 0 THEN 1 ELSE 0 END"),
        },
    ),
    "savings_accounts": (
        "customer", "c_custkey % 4 <> 3",
        {
            "savings_id": "c_custkey", "client_id": "CASE WHEN c_custkey % 31 = 0 THEN c_custkey + 10000000 ELSE c_custkey END", "product_id": "CAST(1 + c_custkey % 3 AS BIGINT)", "office_id": "CAST(100 + c_nationkey AS BIGINT)", "field_officer_id": "CAST(NULL AS BIGINT)",
            "account_no": f"concat('S', {_text.format('c_custkey')})", "client_name": "c_name", "status_id": "CAST(300 AS INTEGER)", "status_value": "'Active'", "is_active": "CAST(CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS INTEGER)", "currency_code": "'KES'",
            "submitted_on_date": _day.format("1995-01-01", "c_custkey % 700"), "activated_on_date": f"CASE WHEN c_custkey % 19 = 0 THEN CAST(NULL AS DATE) ELSE {_day.format('1995-02-01', 'c_custkey % 700')} END", "closed_on_date": "CAST(NULL AS DATE)",
            "nominal_annual_interest_rate": "CAST(3 AS DECIMAL(19,6))", "account_balance": _share("c_acctbal", "8"), "available_balance": _share("c_acctbal", "8"), "total_deposits": "CAST(c_custkey % 17 * 1000 AS DECIMAL(19,6))",
            "total_withdrawals": "CAST(c_custkey % 7 * 1500 AS DECIMAL(19,6))", "total_interest_posted": "CAST(NULL AS DECIMAL(19,6))", **_meta("1", "c_custkey"),
        },
    ),
}

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")
KEYS = {"offices": "office_id", "staff": "staff_id", "loan_products": "product_id", "savings_products": "product_id", "clients": "client_id", "loans": "loan_id", "loan_transactions": "transaction_id", "savings_accounts": "savings_id"}


def _columns(entity: str, dialect: str) -> dict[str, str]:
    columns = ENTITIES[entity][2]
    days = "datediff(CAST(l_shipdate AS DATE), CAST('1970-01-01' AS DATE))" if dialect == "spark" else "(CAST(l_shipdate AS DATE) - CAST('1970-01-01' AS DATE))"
    commit = "timestamp_seconds({0} * 86400)" if dialect == "spark" else "make_timestamp({0} * 86400000000)"
    out = {k: v.replace("{days}", days) for k, v in columns.items() if k not in ("_base", "_commit_seconds")}
    version = columns["_commit_seconds"].replace("{days}", days)
    return out | {k: commit.format(version) for k in ("_source_commit_at", "_cdc_read_at", "_landed_at", "source_ingested_at", "source_updated_at")}


def sql(entity: str, dialect: str) -> str:
    """The raw table as a SELECT for "spark" or "duckdb"."""
    source, where, _ = ENTITIES[entity]
    return f"SELECT {', '.join(f'{v} AS {k}' for k, v in _columns(entity, dialect).items())} FROM {source} WHERE {where}"


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Sources are read under names of this directory's own, so several directories can be open."""
    text = f" {text} "
    for t in TABLES:
        if f" {t} " in text or f" {t})" in text:
            text = text.replace(f"FROM {t} ", f"FROM parquet.`{sf_dir}/{t}.parquet` AS {t} ").replace(f"FROM {t})", f"FROM parquet.`{sf_dir}/{t}.parquet` AS {t})").replace(f"JOIN {t} ", f"JOIN parquet.`{sf_dir}/{t}.parquet` AS {t} ")
    return spark.sql(text.strip())


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw table."""
    return _run(spark, sf_dir, sql(entity, "spark"))


def columns(entity: str) -> dict[str, Column]:
    """The raw table's columns, of rows as source() has them."""
    return {k: F.expr(v) for k, v in _columns(entity, "spark").items()}


def source(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The rows that the raw table is made of, one for each of its rows, with the few columns that it reads: a shuffle of these
    moves less than one of raw rows, whose columns can be made after it."""
    of, where, _ = ENTITIES[entity]
    rows, read = _run(spark, sf_dir, f"SELECT * FROM {of} WHERE {where}"), " ".join(_columns(entity, "spark").values())
    return rows.select(*[c for c in rows.columns if re.search(rf"\b{c}\b", read)])


def newest(rows: DataFrame, entity: str) -> DataFrame:
    """Of rows as source() has them, those that make the newest raw row of each key."""
    made = columns(entity)
    return cdc.newest(rows.select("*", *[made[c].alias(c) for c in (KEYS[entity], *cdc.ORDER) if c not in rows.columns]), KEYS[entity])


def of(rows: DataFrame, entity: str) -> DataFrame:
    """The raw rows that these make."""
    return rows.select(*[c.alias(k) for k, c in columns(entity).items()])

"""The 22 models. Each is a method that gives a DataFrame; a Models object builds each of them once.

Aggregations come before joins, dimensions stay small on the right of left joins, and what several models read can be
materialised by `keep` (a function that writes and reads again) instead of being computed for each of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions import scalars as s
from tidemark.operators import asof, cdc
from tidemark.operators.quantiles import quantiles

DETAIL = ("source_ingested_at", "source_updated_at")
MONEY = (
    "principal approved_principal principal_disbursed principal_paid principal_written_off principal_outstanding principal_overdue interest_charged interest_paid interest_outstanding fee_charges_charged "
    "fee_charges_paid penalty_charges_charged total_expected_repayment total_repayment total_outstanding total_overdue delinquent_amount"
).split()
#: Raw columns that a derived column of the loans reads, and the one that a column of the ledger does.
_LATE = {"delinquent_days", "overdue_since_date"}
LOAN_INPUTS = {
    "status": {"status_value"}, "loan_key": set(), "cdc_commit_at": set(), "cdc_version": set(), "is_written_off": {"status_id"}, "days_past_due": _LATE, "par_bucket": _LATE, "is_in_default": _LATE, "principal_repaid_ratio": {"principal_paid", "principal_disbursed"},
    "repayment_progress_ratio": {"total_repayment", "total_expected_repayment"}, "days_since_disbursement": {"disbursed_on_date"}, "term_days": {"expected_maturity_date", "disbursed_on_date"},
}
LEDGER_INPUTS = {"transaction_category": "type_id", "is_countable": "is_reversed", **{f"transaction_{x}": "transaction_date" for x in ("year", "month", "month_start", "day_of_week")}}
LEDGER = "amount principal_portion interest_portion fee_charges_portion penalty_charges_portion overpayment_portion outstanding_loan_balance".split()


def count_if(c: Column) -> Column:
    return F.count_if(c)


def sum_if(x: str, c: Column) -> Column:
    return F.coalesce(F.sum(F.when(c, F.col(x))), F.lit(0)).cast("decimal(38,6)")


def total(x: str) -> Column:
    return F.sum(x).cast("decimal(38,6)")


def mean(x: str, where: Column | None = None) -> Column:
    """Of exact amounts: the sum is exact, and only the last step a double, so that the order of rows doesn't matter."""
    c = F.col(x) if where is None else F.when(where, F.col(x))
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def zero(*names: str, prefix: str = "") -> list[Column]:
    return [F.coalesce(F.col(prefix + n), F.lit(0)).alias(n) for n in names]


class Models:
    def __init__(self, raw: Callable[[str], DataFrame], settings: Settings | None = None, keep: Callable[[DataFrame, str], DataFrame] | None = None, kept: tuple[str, ...] = ("stg_loans",), columns: dict[str, tuple[str, ...]] | None = None):
        """keep writes a stage and reads it again; kept: the stages that it is used for. columns: of a stage, those that are
        written; plans may name the others, which Spark prunes, and a query that reads one of them fails."""
        self.raw, self.set, self._keep, self.kept, self.columns = raw, settings or Settings(), keep, kept, columns or {}
        self.today = F.lit(self.set.as_of)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self._keep or name not in self.kept:
            return df
        if name not in self.columns:
            return self._keep(df, name)
        some = self._keep(df.select(*self.columns[name]), name)
        return some.select(*[F.col(c) if c in some.columns else F.raise_error(F.lit(f"{name}: {c} wasn't kept")).cast(t).alias(c) for c, t in df.dtypes])

    def _current(self, entity: str, key: str, name: str, columns: list[str] | None = None) -> DataFrame:
        df = cdc.newest(self.raw(entity), key, columns=columns).where("_is_deleted = 0")
        return df.withColumns({name: s.surrogate_key(key), "cdc_commit_at": F.col("_source_commit_at"), "cdc_version": F.col("_version")}).drop(*cdc.META)

    def _days(self, c: str) -> Column:
        return F.datediff(self.today, c)

    @cached_property
    def stg_clients(self) -> DataFrame:
        names = {"status_value": "status", "staff_name": "loan_officer_name", "legal_form_value": "legal_form", "gender_value": "gender", "client_type_value": "client_type", "client_classification_value": "client_classification"}
        df = self._current("clients", "client_id", "client_key").withColumnsRenamed(names)
        return df.withColumns(
            {
                "is_active": F.coalesce("is_active", F.lit(0)),
                "age_years": s.years_between(F.col("date_of_birth"), self.today),
                "tenure_days": self._days("activation_date"),
                "tenure_months": s.months_between(F.col("activation_date"), self.today),
            }
        )

    def _loans(self, columns: list[str] | None = None) -> DataFrame:
        """Staged loans, or what raw columns of them give: a derived column is there if those that it reads are."""
        df = self._current("loans", "loan_id", "loan_key", columns).withColumnsRenamed({"status_value": "status"})
        there = set(df.columns)
        df = df.withColumns({m: s.money(m) for m in MONEY if m in there} | {f: F.coalesce(f, F.lit(0)) for f in ("is_active", "is_closed", "is_overpaid") if f in there})
        late = lambda: s.days_past_due(F.col("delinquent_days"), F.col("overdue_since_date"), self.set.as_of)
        made = {
            "is_written_off": lambda: s.flag(F.col("status_id") == 601),
            "days_past_due": late,
            "par_bucket": lambda: s.par_bucket("days_past_due", self.set.par_edges),
            "is_in_default": lambda: s.flag(F.col("days_past_due") > self.set.default_threshold_days),
            "principal_repaid_ratio": lambda: s.ratio("principal_paid", "principal_disbursed"),
            "repayment_progress_ratio": lambda: s.ratio("total_repayment", "total_expected_repayment"),
            "days_since_disbursement": lambda: self._days("disbursed_on_date"),
            "term_days": lambda: F.datediff("expected_maturity_date", "disbursed_on_date"),
        }
        first = ("is_written_off", "days_past_due")
        for names in (first, [n for n in made if n not in first]):
            df = df.withColumns({n: made[n]() for n in names if LOAN_INPUTS[n] <= there})
        return df.drop("delinquent_days")

    @cached_property
    def stg_loans(self) -> DataFrame:
        return self.keep(self._loans(), "stg_loans")

    def loans(self, *names: str) -> DataFrame:
        """Columns of the staged loans: from the stage where it is kept, else collapsed from what these columns read alone."""
        if self._keep and "stg_loans" in self.kept:
            return self.stg_loans.select(*names)
        raw = sorted({x for n in names for x in LOAN_INPUTS.get(n, {n})} - {"loan_id"})
        return self._loans(raw).select(*names)

    def ledger(self, raw: DataFrame, collapsed: bool = False) -> DataFrame:
        """Staged transactions from raw rows, or from some of their columns; deleted keys are still there, marked. collapsed:
        there is but the newest row of each."""
        meta = {*cdc.META, "transaction_id", "source_updated_at"}
        df = cdc.latest_by_key(raw, ["transaction_id"], [c for c in raw.columns if c not in meta], collapsed=collapsed)
        d, there = F.col("transaction_date"), set(raw.columns)
        df = df.withColumns({m: s.money(m) for m in LEDGER if m in there} | ({"is_reversed": F.coalesce("is_reversed", F.lit(0))} if "is_reversed" in there else {}))
        made = {
            "transaction_category": lambda: s.category("type_id"),
            "is_countable": lambda: F.when(F.col("is_reversed") == 1, 0).otherwise(1),
            "transaction_year": lambda: F.year(d),
            "transaction_month": lambda: F.month(d),
            "transaction_month_start": lambda: F.trunc(d, "month"),
            "transaction_day_of_week": lambda: F.weekday(d) + 1,
        }
        return df.withColumns({n: f() for n, f in made.items() if LEDGER_INPUTS[n] in there})

    @cached_property
    def stg_loan_transactions(self) -> DataFrame:
        return self.keep(self.ledger(self.raw("loan_transactions")).where("is_deleted = 0").drop("is_deleted"), "stg_loan_transactions")

    def transactions(self, *names: str) -> DataFrame:
        """Columns of the staged transactions, like loans()."""
        if self._keep and "stg_loan_transactions" in self.kept:
            return self.stg_loan_transactions.select(*names)
        raw = self.raw("loan_transactions")
        read = sorted({LEDGER_INPUTS.get(n, n) for n in names} - {"transaction_id"})
        return self.ledger(cdc.narrow(raw, ["transaction_id"], read)).where("is_deleted = 0").select(*names)

    def stg_loan_transactions_incremental(self, target: DataFrame | None) -> DataFrame:
        """The target after what was committed since its newest commit less the lookback; keys deleted there go."""
        raw = cdc.incremental_filter(self.raw("loan_transactions"), target, "_source_commit_at", "cdc_commit_at", self.set.lookback_hours)
        batch = self.ledger(raw)
        return batch.where("is_deleted = 0").drop("is_deleted") if target is None else cdc.merge_by_key(target, batch, ["transaction_id"], "is_deleted")

    @cached_property
    def stg_offices(self) -> DataFrame:
        df = self._current("offices", "office_id", "office_key")
        df = df.withColumnsRenamed({"name": "office_name", "name_decorated": "office_name_decorated", "parent_id": "parent_office_id", "parent_name": "parent_office_name"})
        return df.withColumns({"hierarchy_depth": s.hierarchy_depth(F.col("hierarchy")), "is_head_office": s.flag(F.col("parent_office_id").isNull()), "days_open": self._days("opening_date")})

    @cached_property
    def stg_staff(self) -> DataFrame:
        df = self._current("staff", "staff_id", "staff_key").withColumnRenamed("display_name", "staff_name")
        return df.withColumns({f: F.coalesce(f, F.lit(0)) for f in ("is_loan_officer", "is_active")} | {"tenure_days": self._days("joining_date")})

    @cached_property
    def stg_loan_products(self) -> DataFrame:
        df = self._current("loan_products", "product_id", "product_key").withColumnsRenamed({"name": "product_name", "short_name": "product_short_name", "principal": "default_principal", "number_of_repayments": "default_number_of_repayments", "status": "product_status"})
        df = df.withColumns({m: s.money(m) for m in ("default_principal", "min_principal", "max_principal")})
        return df.withColumn("is_active", s.flag(F.col("product_status") == "loanProduct.active"))

    @cached_property
    def stg_savings_products(self) -> DataFrame:
        return self._current("savings_products", "product_id", "product_key").withColumnsRenamed({"name": "product_name", "short_name": "product_short_name", "status": "product_status"})

    @cached_property
    def stg_savings_accounts(self) -> DataFrame:
        df = self._current("savings_accounts", "savings_id", "savings_key").withColumnRenamed("status_value", "status")
        df = df.withColumns({m: s.money(m) for m in ("account_balance", "available_balance", "total_deposits", "total_withdrawals", "total_interest_posted")})
        return df.withColumns({"is_active": F.coalesce("is_active", F.lit(0)), "withdrawal_ratio": s.ratio("total_withdrawals", "total_deposits"), "days_since_activation": self._days("activated_on_date")})

    @cached_property
    def loan_repayment_behaviour(self) -> DataFrame:
        """One pass by loan over the ledger, gaps between repayments included, on one shuffle: a loan is there if any
        transaction is, so that full joins of separate rollups would only give the same keys."""
        kind = lambda k: F.col("transaction_category") == k
        counts = F.col("is_countable") == 1
        paid, lent = kind("repayment") & counts, kind("disbursement") & counts
        amount = F.when(paid, F.col("amount"))
        day = lambda c: F.when(c, F.col("transaction_date"))
        t = self.transactions("loan_id", "transaction_id", "transaction_date", "transaction_month_start", "transaction_category", "is_countable", "is_reversed", *LEDGER[:5]).withColumn("_gap", asof.gaps("loan_id", "transaction_date", ["transaction_id"], paid))
        by_loan = t.groupBy("loan_id").agg(
            count_if(paid).alias("repayment_count"),
            *[sum_if(c, paid).alias(n) for c, n in (("amount", "total_repaid"), ("principal_portion", "principal_repaid"), ("interest_portion", "interest_repaid"), ("fee_charges_portion", "fees_repaid"), ("penalty_charges_portion", "penalties_repaid"))],
            F.min(day(paid)).alias("first_repayment_date"),
            F.max(day(paid)).alias("last_repayment_date"),
            mean("amount", paid).alias("avg_repayment_amount"),
            F.stddev_pop(amount.cast("double")).alias("stddev_repayment_amount"),
            F.median(amount.cast("double")).alias("median_repayment_amount"),
            F.max(amount).alias("max_repayment_amount"),
            F.size(F.collect_set(F.when(paid, F.col("transaction_month_start")))).alias("active_repayment_months"),
            count_if(lent).alias("disbursement_count"),
            sum_if("amount", lent).alias("total_disbursed"),
            F.min(day(lent)).alias("first_disbursement_date"),
            F.max(day(lent)).alias("last_disbursement_date"),
            count_if(F.col("is_reversed") == 1).alias("reversed_transaction_count"),
            count_if(kind("write_off")).alias("write_off_transaction_count"),
            count_if(kind("waive_interest")).alias("interest_waiver_count"),
            count_if(kind("recovery_repayment")).alias("recovery_count"),
            F.count("*").alias("total_transaction_count"),
            F.max("transaction_date").alias("last_activity_date"),
            F.avg("_gap").alias("avg_days_between_repayments"),
            F.stddev_pop("_gap").alias("stddev_days_between_repayments"),
            F.max("_gap").alias("max_days_between_repayments"),
        )
        return self.keep(
            by_loan.withColumns(
                {"days_since_last_activity": self._days("last_activity_date"), "repayment_regularity_cv": s.ratio("stddev_days_between_repayments", "avg_days_between_repayments")}
            ),
            "loan_repayment_behaviour",
        )

    @cached_property
    def client_portfolio(self) -> DataFrame:
        active = F.col("is_active") == 1
        loans = self.loans(
            "client_id", "product_id", "is_active", "is_closed", "is_written_off", "days_past_due", "is_in_default", "principal", "principal_disbursed", "total_repayment", "principal_outstanding", "total_outstanding", "total_overdue", "principal_written_off", "disbursed_on_date", "closed_on_date"
        ).groupBy("client_id").agg(
            F.count("*").alias("total_loans"),
            count_if(active).alias("active_loans"),
            count_if(F.col("is_closed") == 1).alias("closed_loans"),
            count_if(F.col("is_written_off") == 1).alias("written_off_loans"),
            count_if(F.col("days_past_due") > 0).alias("delinquent_loans"),
            count_if(F.col("is_in_default") == 1).alias("defaulted_loans"),
            total("principal_disbursed").alias("lifetime_disbursed"),
            total("total_repayment").alias("lifetime_repaid"),
            *[sum_if(c, active).alias(f"current_{c}") for c in ("principal_outstanding", "total_outstanding", "total_overdue")],
            total("principal_written_off").alias("lifetime_written_off"),
            F.max("days_past_due").alias("worst_days_past_due"),
            F.max(F.when(active, F.col("days_past_due"))).alias("current_worst_days_past_due"),
            F.min("disbursed_on_date").alias("first_disbursement_date"),
            F.max("disbursed_on_date").alias("latest_disbursement_date"),
            F.max("closed_on_date").alias("latest_closure_date"),
            mean("principal").alias("avg_loan_principal"),
            F.max("principal").alias("max_loan_principal"),
            F.size(F.collect_set("product_id")).cast("long").alias("distinct_products_used"),
        )
        savings = self.stg_savings_accounts.groupBy("client_id").agg(
            F.count("*").alias("total_savings_accounts"),
            count_if(active).alias("active_savings_accounts"),
            total("account_balance").alias("total_savings_balance"),
            total("total_deposits").alias("lifetime_deposits"),
            total("total_withdrawals").alias("lifetime_withdrawals"),
            F.min("activated_on_date").alias("first_savings_date"),
        )
        both = loans.join(savings, "client_id", "full").withColumns(
            {
                "historical_write_off_rate": s.ratio("written_off_loans", "total_loans"),
                "lifetime_repayment_ratio": s.ratio("lifetime_repaid", "lifetime_disbursed"),
                "savings_to_debt_ratio": s.ratio("total_savings_balance", "current_total_outstanding"),
                "days_since_first_loan": self._days("first_disbursement_date"),
            }
        )
        numbers = [n for n, t in both.dtypes if n != "client_id" and t != "date" and n not in ("avg_loan_principal", "max_loan_principal", "days_since_first_loan") and not n.endswith(("_ratio", "_rate"))]
        both = both.withColumns({n: F.coalesce(n, F.lit(0)) for n in numbers})
        return self.keep(
            both.withColumns(
                {
                    "is_multi_product_client": s.flag((F.col("total_loans") > 0) & (F.col("total_savings_accounts") > 0)),
                    "is_repeat_borrower": s.flag(F.col("total_loans") > 1),
                    "prior_loan_count": F.greatest(F.col("total_loans") - 1, F.lit(0)),
                }
            ),
            "client_portfolio",
        )

    @cached_property
    def dim_client(self) -> DataFrame:
        taken = "total_loans active_loans closed_loans written_off_loans delinquent_loans lifetime_disbursed lifetime_repaid current_total_outstanding current_total_overdue total_savings_balance active_savings_accounts is_repeat_borrower is_multi_product_client current_worst_days_past_due".split()
        p = self.client_portfolio.select("client_id", *taken, "historical_write_off_rate", "lifetime_repayment_ratio", "savings_to_debt_ratio")
        o = self.stg_offices.select("office_id", F.col("office_name").alias("_office"), "parent_office_name", F.col("hierarchy_depth").alias("office_depth"))
        c = self.stg_clients.drop("mobile_no", "email_address", "status_id", "date_of_birth", "cdc_version", *DETAIL).withColumnRenamed("cdc_commit_at", "source_updated_at")
        df = c.join(p, "client_id", "left").join(o, "office_id", "left")
        segment = s.client_segment(*[F.col(x) for x in ("total_loans", "active_loans", "current_worst_days_past_due", "is_repeat_borrower")], self.set.default_threshold_days)
        return df.withColumns(
            {
                "office_name": F.coalesce("_office", "office_name"),
                "age_band": s.band(F.col("age_years"), *s.AGE_BANDS, "Unknown"),
                "tenure_band": s.band(F.col("tenure_months"), *s.TENURE_BANDS, "Unknown"),
                "current_par_bucket": s.par_bucket("current_worst_days_past_due", self.set.par_edges),
                "client_segment": segment,
                **{n: F.coalesce(n, F.lit(0)) for n in taken},
            }
        ).drop("_office")

    def _book(self, by: str) -> DataFrame:
        """What several dimensions say about the loans of one of their members."""
        active = F.col("is_active") == 1
        book = self.loans(by, *[c for c in ("client_id", "is_active", "is_closed", "is_written_off", "days_past_due", "principal", "principal_disbursed", "principal_outstanding", "total_outstanding", "total_overdue", "principal_written_off") if c != by])
        return book.where(F.col(by).isNotNull()).groupBy(by).agg(
            F.count("*").alias("total_loans"),
            count_if(active).alias("active_loans"),
            count_if(F.col("is_closed") == 1).alias("closed_loans"),
            count_if(F.col("is_written_off") == 1).alias("written_off_loans"),
            count_if(F.col("days_past_due") > 0).alias("delinquent_loans"),
            count_if((F.col("days_past_due") > 0) & active).alias("active_delinquent_loans"),
            F.countDistinct("client_id").alias("distinct_borrowers"),
            sum_if("principal_outstanding", active).alias("principal_outstanding"),
            sum_if("total_outstanding", active).alias("total_outstanding"),
            sum_if("total_overdue", active).alias("total_overdue"),
            total("principal_disbursed").alias("lifetime_disbursed"),
            total("principal_written_off").alias("lifetime_written_off"),
            mean("principal").alias("avg_principal"),
            F.avg(F.col("days_past_due").cast("double")).alias("avg_days_past_due"),
        )

    @cached_property
    def dim_office(self) -> DataFrame:
        o = self.stg_offices.drop("cdc_commit_at", "cdc_version", *DETAIL)
        book = self._book("office_id").select("office_id", "total_loans", "active_loans", "distinct_borrowers", "principal_outstanding", "total_outstanding", "total_overdue", "lifetime_disbursed")
        clients = self.stg_clients.groupBy("office_id").agg(F.count("*").alias("total_clients"), count_if(F.col("is_active") == 1).alias("active_clients"))
        staff = self.stg_staff.groupBy("office_id").agg(F.count("*").alias("total_staff"), count_if((F.col("is_loan_officer") == 1) & (F.col("is_active") == 1)).alias("active_loan_officers"))
        df = o.join(book, "office_id", "left").join(clients, "office_id", "left").join(staff, "office_id", "left")
        df = df.withColumns({"par_ratio": s.ratio("total_overdue", "total_outstanding"), "loans_per_officer": s.ratio("active_loans", "active_loan_officers")})
        return df.withColumns({n: F.coalesce(n, F.lit(0)) for n in (*book.columns[1:], *clients.columns[1:], *staff.columns[1:])})

    @cached_property
    def dim_staff(self) -> DataFrame:
        book = self._book("loan_officer_id").select(
            F.col("loan_officer_id").alias("staff_id"), "total_loans", "active_loans", "distinct_borrowers", F.col("total_outstanding").alias("outstanding_portfolio"), F.col("total_overdue").alias("overdue_portfolio"),
            F.col("active_delinquent_loans").alias("delinquent_loans"), "written_off_loans", "avg_days_past_due",
        )
        df = self.stg_staff.drop("mobile_no", "cdc_commit_at", "cdc_version", *DETAIL).join(book, "staff_id", "left")
        df = df.withColumns({"par_ratio": s.ratio("overdue_portfolio", "outstanding_portfolio"), "delinquency_rate": s.ratio("delinquent_loans", "active_loans")})
        return df.withColumns({n: F.coalesce(n, F.lit(0)) for n in book.columns[1:] if n != "avg_days_past_due"})

    @cached_property
    def dim_loan_product(self) -> DataFrame:
        book = self._book("product_id").withColumnsRenamed({"total_outstanding": "current_outstanding", "total_overdue": "current_overdue"}).drop("principal_outstanding", "active_delinquent_loans")
        p = self.stg_loan_products.drop("cdc_commit_at", "cdc_version", *DETAIL).withColumnRenamed("is_active", "is_product_active")
        middle = quantiles(self.loans("product_id", "principal").where("product_id is not null"), ["product_id"], F.col("principal"), {"median_principal": 0.5})
        df = p.join(book, "product_id", "left").join(middle, "product_id", "left")
        df = df.withColumns({"par_ratio": s.ratio("current_overdue", "current_outstanding"), "write_off_rate": s.ratio("written_off_loans", "total_loans"), "delinquency_rate": s.ratio("delinquent_loans", "active_loans")})
        return df.withColumns({n: F.coalesce(n, F.lit(0)) for n in book.columns[1:] if not n.startswith(("avg_", "median_"))})

    def dim_date(self, spark) -> DataFrame:
        d, today = F.col("date_day"), self.today
        days = spark.range(1).select(F.explode(F.sequence(F.lit(self.set.spine_start), F.lit(self.set.spine_end))).alias("date_day"))
        dow = F.weekday(d) + 1
        return days.withColumns(
            {
                "date_key": s.date_key(d), "year_number": F.year(d), "quarter_number": F.quarter(d), "month_number": F.month(d), "day_of_month": F.dayofmonth(d), "day_of_week": dow, "day_of_year": F.dayofyear(d), "iso_week": F.weekofyear(d),
                "month_short_name": F.date_format(d, "MMM"), "month_name": F.date_format(d, "MMMM"), "day_short_name": F.date_format(d, "E"), "day_name": F.date_format(d, "EEEE"),
                "year_quarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")), "year_month": F.date_format(d, "yyyy-MM"), "week_start_date": s.week_start(d), "month_start_date": F.trunc(d, "month"),
                "month_end_date": F.last_day(d), "quarter_start_date": F.trunc(d, "quarter"), "year_start_date": F.trunc(d, "year"), "is_weekend": s.flag(dow >= 6), "is_weekday": s.flag(dow < 6), "is_month_end": s.flag(d == F.last_day(d)),
                "is_month_start": s.flag(F.dayofmonth(d) == 1), "is_quarter_start": s.flag(d == F.trunc(d, "quarter")), "is_past": s.flag(d <= today), "is_today": s.flag(d == today), "days_ago": F.datediff(today, d),
            }
        )

    @cached_property
    def fct_loan(self) -> DataFrame:
        b = self.loan_repayment_behaviour.select("loan_id", "repayment_count", F.col("total_repaid").alias("ledger_total_repaid"), "avg_repayment_amount", "first_repayment_date", "last_repayment_date", "days_since_last_activity", "avg_days_between_repayments", "repayment_regularity_cv", "reversed_transaction_count")
        c = self.dim_client.select("client_id", "client_segment", "client_classification", "gender", "legal_form", "age_band", "tenure_band")
        loans = self.stg_loans.drop("cdc_version", *DETAIL).withColumnRenamed("cdc_commit_at", "source_updated_at")
        df = loans.join(b, "loan_id", "left").join(c, "client_id", "left")
        exposure = lambda days: F.when(F.col("days_past_due") > days, F.col("total_outstanding")).otherwise(F.lit(0)).cast("decimal(38,6)")
        df = df.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("repayment_count", "ledger_total_repaid", "reversed_transaction_count")})
        return df.withColumns(
            {
                "disbursement_date_key": s.date_key(F.col("disbursed_on_date")), "days_to_approval": F.datediff("approved_on_date", "submitted_on_date"), "days_to_disbursement": F.datediff("disbursed_on_date", "approved_on_date"),
                "par30_exposure": exposure(30), "par90_exposure": exposure(90), "overdue_ratio": s.ratio("total_overdue", "total_outstanding"),
                "repayment_reconciliation_delta": (F.col("total_repayment") - F.col("ledger_total_repaid")).cast("decimal(38,6)"),
            }
        )

    def transaction_facts(self, transactions: DataFrame) -> DataFrame:
        """Facts of staged transactions. Loan attributes are those of now; rows outside an incremental batch keep older ones."""
        loans = self.loans("loan_id", "client_id", "product_id", "office_id", "loan_officer_id", "status", "par_bucket", "disbursed_on_date").withColumnsRenamed({"office_id": "_office", "status": "loan_status", "par_bucket": "loan_par_bucket_now"})
        t = transactions.drop("cdc_version", "source_ingested_at").withColumnRenamed("cdc_commit_at", "source_updated_at").withColumn("amount_including_reversals", F.col("amount"))
        counts = F.col("is_countable") == 1
        only = lambda kind: F.when(counts & (F.col("transaction_category") == kind), F.col("amount_including_reversals")).otherwise(F.lit(0)).cast("decimal(38,6)")
        parts = {m: F.when(counts, F.col(m)).otherwise(F.lit(0)).cast("decimal(38,6)") for m in LEDGER[:-1]}
        return t.join(loans, "loan_id", "left").withColumns(
            {
                **parts, "office_id": F.coalesce("office_id", "_office"), "transaction_date_key": s.date_key(F.col("transaction_date")), "repayment_amount": only("repayment"), "disbursement_amount": only("disbursement"), "write_off_amount": only("write_off"),
                "days_since_disbursement": F.datediff("transaction_date", "disbursed_on_date"),
            }
        ).drop("_office", "disbursed_on_date")

    @cached_property
    def fct_loan_transaction(self) -> DataFrame:
        return self.transaction_facts(self.stg_loan_transactions)

    @cached_property
    def fct_savings_account(self) -> DataFrame:
        p = self.stg_savings_products.select("product_id", "product_name", F.col("interest_posting_period_type").alias("interest_posting_period"))
        c = self.dim_client.select("client_id", "client_segment", "client_classification", "gender", "office_name")
        df = self.stg_savings_accounts.drop("cdc_version", "client_name", "status_id", *DETAIL).withColumnRenamed("cdc_commit_at", "source_updated_at").join(p, "product_id", "left").join(c, "client_id", "left")
        return df.withColumns({"office_name": F.coalesce("office_name", F.lit("")), "avg_daily_deposit_rate": s.ratio("total_deposits", "days_since_activation"), "savings_behaviour": s.savings_behaviour(F.col("is_active"), F.col("account_balance"), F.col("withdrawal_ratio"))})

    @cached_property
    def portfolio_snapshot(self) -> DataFrame:
        """Today's rows; `tables.replace_day` keeps earlier days. It can't be rebuilt for days that have passed."""
        active = F.col("is_active") == 1
        late = lambda d: active & (F.col("days_past_due") > d)
        loans = self.loans("office_id", "product_id", "client_id", "is_active", "is_closed", "is_written_off", "days_past_due", "principal", "principal_outstanding", "interest_outstanding", "total_outstanding", "total_overdue", "principal_disbursed", "principal_written_off")
        df = loans.groupBy("office_id", "product_id").agg(
            F.count("*").alias("loans_total"), count_if(active).alias("loans_active"), count_if(F.col("is_closed") == 1).alias("loans_closed"), count_if(F.col("is_written_off") == 1).alias("loans_written_off"), count_if(late(0)).alias("loans_delinquent"),
            count_if(late(30)).alias("loans_par30"), count_if(late(90)).alias("loans_par90"), F.countDistinct("client_id").alias("distinct_borrowers"),
            *[sum_if(c, active).alias(c) for c in ("principal_outstanding", "interest_outstanding", "total_outstanding", "total_overdue")], sum_if("total_outstanding", late(30)).alias("par30_amount"), sum_if("total_outstanding", late(90)).alias("par90_amount"),
            total("principal_disbursed").alias("cumulative_disbursed"), total("principal_written_off").alias("cumulative_written_off"), mean("principal", active).alias("avg_active_principal"),
            F.max(F.when(active, F.col("days_past_due"))).alias("max_days_past_due"), F.avg(F.when(active, F.col("days_past_due").cast("double"))).alias("avg_days_past_due"),
        )
        df = df.withColumns({"snapshot_date": self.today, "par30_ratio": s.ratio("par30_amount", "total_outstanding"), "par90_ratio": s.ratio("par90_amount", "total_outstanding"), "write_off_ratio": s.ratio("cumulative_written_off", "cumulative_disbursed")})
        return df.withColumns({"snapshot_date_key": s.date_key(F.col("snapshot_date")), "snapshot_key": s.surrogate_key("snapshot_date", "office_id", "product_id")})

    @cached_property
    def loan_performance_monthly(self) -> DataFrame:
        """Flows and vintages by month, office and product. Keys with a NULL stand for themselves on either side."""
        is_kind = lambda k: F.col("transaction_category") == k
        keys = ["month_start", "office_id", "product_id"]
        flows = self.fct_loan_transaction.groupBy(F.col("transaction_month_start").alias("month_start"), "office_id", "product_id").agg(
            count_if(is_kind("repayment")).alias("repayment_count"), *[total(c).alias(n) for c, n in (("repayment_amount", "repayment_amount"), ("principal_portion", "principal_collected"), ("interest_portion", "interest_collected"), ("fee_charges_portion", "fees_collected"), ("penalty_charges_portion", "penalties_collected"))],
            count_if(F.col("is_reversed") == 1).alias("reversal_count"), F.countDistinct("loan_id").alias("loans_with_activity"), count_if(is_kind("disbursement")).alias("disbursement_count"), total("disbursement_amount").alias("disbursement_amount"), total("write_off_amount").alias("write_off_amount"),
        )
        originated = self.loans("office_id", "product_id", "client_id", "principal", "principal_disbursed", "submitted_on_date", "approved_on_date", "disbursed_on_date", "is_in_default", "is_written_off")
        loans = originated.where("disbursed_on_date is not null").groupBy(F.trunc("disbursed_on_date", "month").alias("month_start"), "office_id", "product_id")
        vintages = loans.agg(
            F.count("*").alias("loans_originated"), total("principal_disbursed").alias("principal_originated"), F.countDistinct("client_id").alias("borrowers_served"), mean("principal").alias("avg_origination_principal"),
            F.avg(F.datediff("approved_on_date", "submitted_on_date").cast("double")).alias("avg_days_to_approval"), F.avg(F.datediff("disbursed_on_date", "approved_on_date").cast("double")).alias("avg_days_to_disbursement"),
            count_if(F.col("is_in_default") == 1).alias("vintage_loans_in_default"), count_if(F.col("is_written_off") == 1).alias("vintage_loans_written_off"),
        )
        df = flows.join(vintages, keys, "full").withColumns({"month_key": s.date_key(F.col("month_start"), "yyyyMM"), "vintage_default_rate": s.ratio("vintage_loans_in_default", "loans_originated")})
        filled = [c for c in (*flows.columns, *vintages.columns) if c not in keys and not c.startswith("avg_")]
        df = df.withColumns({c: F.coalesce(c, F.lit(0)) for c in filled})
        return df.withColumn("net_cash_flow", (F.col("repayment_amount") - F.col("disbursement_amount")).cast("decimal(38,6)"))

    def _repayments(self) -> DataFrame:
        return self.transactions("loan_id", "transaction_date", "amount", "transaction_category", "is_countable").where("transaction_category = 'repayment' and is_countable = 1").select("loan_id", "transaction_date", "amount")

    @cached_property
    def default_features(self) -> DataFrame:
        """Features of a loan as they were known on its day of disbursement. prior_reversal_count is always 0: only countable
        repayments are looked at; the column is part of the contract."""
        loans = self.loans(
            "loan_id", "client_id", "product_id", "office_id", "loan_officer_id", "principal", "principal_disbursed", "number_of_repayments", "annual_interest_rate", "term_days", "submitted_on_date", "disbursed_on_date", "days_past_due", "is_in_default", "is_written_off"
        ).where("disbursed_on_date is not null")
        prior = asof.prior_loans(loans)
        paid = self._repayments()
        repaid = asof.prior_repayments(loans, paid)
        c = self.stg_clients.select("client_id", "gender", "legal_form", "client_type", "client_classification", "date_of_birth", "activation_date")
        p = self.stg_loan_products.select("product_id", "product_name", "default_principal")
        d, real = F.col("disbursed_on_date"), lambda x: F.coalesce(F.col(x).cast("double"), F.lit(0.0))
        return loans.join(c, "client_id", "left").join(p, "product_id", "left").join(prior, "loan_id", "left").join(repaid, "loan_id", "left").select(
            "loan_id", "client_id", d.alias("observation_date"), s.date_key(d, "yyyyMM").alias("observation_month"), s.flag((F.col("is_in_default") == 1) | (F.col("is_written_off") == 1)).alias("label_defaulted"), F.col("days_past_due").alias("label_days_past_due"), F.col("is_written_off").alias("label_written_off"),
            F.col("principal").cast("double").alias("feat_principal"), F.col("number_of_repayments").alias("feat_number_of_repayments"), F.col("annual_interest_rate").cast("double").alias("feat_annual_interest_rate"), F.col("term_days").alias("feat_term_days"),
            s.ratio("principal", "number_of_repayments").alias("feat_installment_size"), F.datediff(d, "submitted_on_date").alias("feat_days_application_to_disbursement"), F.col("product_id").alias("feat_product_id"), F.col("product_name").alias("feat_product_name"),
            F.col("default_principal").cast("double").alias("feat_product_default_principal"), s.ratio("principal", "default_principal").alias("feat_principal_vs_product_default"), F.col("gender").alias("feat_gender"), F.col("legal_form").alias("feat_legal_form"), F.col("client_type").alias("feat_client_type"),
            F.col("client_classification").alias("feat_client_classification"), s.years_between(F.col("date_of_birth"), d).alias("feat_age_at_origination"), F.datediff(d, "activation_date").alias("feat_client_tenure_days"), F.col("office_id").alias("feat_office_id"), F.col("loan_officer_id").alias("feat_loan_officer_id"),
            F.coalesce("prior_loan_count", F.lit(0)).alias("feat_prior_loan_count"), real("prior_total_disbursed").alias("feat_prior_total_disbursed"), real("prior_max_principal").alias("feat_prior_max_principal"), F.coalesce("prior_distinct_products", F.lit(0)).cast("long").alias("feat_prior_distinct_products"),
            F.datediff(d, "prior_last_disbursement_date").alias("feat_days_since_prior_loan"), s.ratio("principal", "prior_max_principal").alias("feat_principal_vs_prior_max"), F.coalesce("prior_repayment_count", F.lit(0)).alias("feat_prior_repayment_count"), real("prior_total_repaid").alias("feat_prior_total_repaid"),
            F.coalesce("prior_avg_repayment", F.lit(0.0)).alias("feat_prior_avg_repayment"), F.lit(0).cast("long").alias("feat_prior_reversal_count"), F.datediff(d, "prior_last_repayment_date").alias("feat_days_since_prior_repayment"), s.flag(F.coalesce("prior_loan_count", F.lit(0)) == 0).alias("feat_is_first_time_borrower"),
            s.split_hint(d, self.set.as_of).alias("split_hint"), s.flag(F.datediff(self.today, d) >= self.set.mature_days).alias("is_label_mature"),
        )

    @cached_property
    def scoring_features(self) -> DataFrame:
        since = lambda n: F.col("transaction_date") >= F.date_sub(self.today, n)
        paid = self._repayments()
        recent = paid.join(self.loans("loan_id", "client_id"), "loan_id").groupBy("client_id").agg(
            *[count_if(since(n)).alias(f"repayments_last_{n}d") for n in (30, 90)], *[sum_if("amount", since(n)).alias(f"repaid_last_{n}d") for n in (30, 90)], F.max("transaction_date").alias("last_repayment_date")
        )
        whole = lambda x, n: F.coalesce(F.col(x), F.lit(0)).alias(n)
        real = lambda x, n: F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(n)
        c = self.stg_clients.select("client_id", F.col("gender").alias("feat_gender"), F.col("legal_form").alias("feat_legal_form"), F.col("client_type").alias("feat_client_type"), F.col("client_classification").alias("feat_client_classification"), F.col("age_years").alias("feat_age_at_origination"), F.col("tenure_days").alias("feat_client_tenure_days"), F.col("office_id").alias("feat_office_id"), F.col("staff_id").alias("feat_loan_officer_id"))
        return c.join(self.client_portfolio, "client_id", "left").join(recent, "client_id", "left").select(
            *c.columns, self.today.alias("scoring_date"), whole("total_loans", "feat_prior_loan_count"), whole("written_off_loans", "feat_prior_written_off_count"), whole("delinquent_loans", "feat_prior_delinquent_count"), real("lifetime_disbursed", "feat_prior_total_disbursed"),
            real("max_loan_principal", "feat_prior_max_principal"), whole("distinct_products_used", "feat_prior_distinct_products"), F.col("historical_write_off_rate").alias("feat_prior_write_off_rate"), F.col("lifetime_repayment_ratio").alias("feat_lifetime_repayment_ratio"), s.flag(F.coalesce("total_loans", F.lit(0)) == 0).alias("feat_is_first_time_borrower"),
            whole("active_loans", "feat_active_loans"), real("current_total_outstanding", "feat_current_outstanding"), real("current_total_overdue", "feat_current_overdue"), whole("current_worst_days_past_due", "feat_current_days_past_due"), s.par_bucket("current_worst_days_past_due", self.set.par_edges).alias("feat_current_par_bucket"),
            real("total_savings_balance", "feat_savings_balance"), F.col("savings_to_debt_ratio").alias("feat_savings_to_debt_ratio"), whole("repayments_last_30d", "feat_repayments_last_30d"), whole("repayments_last_90d", "feat_repayments_last_90d"), real("repaid_last_30d", "feat_repaid_last_30d"), real("repaid_last_90d", "feat_repaid_last_90d"),
            self._days("last_repayment_date").alias("feat_days_since_last_repayment"), s.flag(F.coalesce("active_loans", F.lit(0)) > 0).alias("is_currently_borrowing"), s.flag(F.coalesce("current_worst_days_past_due", F.lit(0)) > 0).alias("needs_collections_review"),
        )

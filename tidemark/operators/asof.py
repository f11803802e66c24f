"""Point-in-time features by windows: what was known strictly before a day, without an inequality join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _day(c: str):
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def _before(key: str):
    """Rows of the key with an earlier day; rows of one day don't see each other."""
    return Window.partitionBy(key).orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)


def prior_loans(loans: DataFrame) -> DataFrame:
    """By loan, what the client's loans of earlier days amount to; loans without any are left out."""
    w = _before("client_id")
    seen = loans.where("client_id is not null").select("loan_id", "client_id", "product_id", "principal", "principal_disbursed", "disbursed_on_date", _day("disbursed_on_date").alias("_day"))
    return seen.select(
        "loan_id",
        F.count("*").over(w).alias("prior_loan_count"),
        F.sum("principal_disbursed").over(w).cast("decimal(38,6)").alias("prior_total_disbursed"),
        F.max("principal").over(w).alias("prior_max_principal"),
        F.avg(F.col("principal").cast("double")).over(w).alias("prior_avg_principal"),
        F.size(F.collect_set("product_id").over(w)).alias("prior_distinct_products"),
        F.max("disbursed_on_date").over(w).alias("prior_last_disbursement_date"),
        F.min("disbursed_on_date").over(w).alias("prior_first_disbursement_date"),
    ).where("prior_loan_count > 0")


def prior_repayments(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """By loan, the client's repayments before its day on loans of earlier days. A repayment counts from the later of its own
    day and its loan's, so one strict window does for both conditions. Repayments of a day are added up before the window."""
    own = loans.where("client_id is not null").select("loan_id", "client_id", "disbursed_on_date")
    days = (
        repayments.join(own, "loan_id")
        .groupBy("client_id", F.greatest("disbursed_on_date", "transaction_date").alias("_at"))
        .agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,6)").alias("amount"), F.max("transaction_date").alias("last"))
    )
    events = days.select(F.lit(None).cast("long").alias("loan_id"), "client_id", _day("_at").alias("_day"), "n", "amount", "last").union(
        own.select("loan_id", "client_id", _day("disbursed_on_date"), F.lit(0).cast("long"), F.lit(None).cast("decimal(38,6)"), F.lit(None).cast("date"))
    )
    w = _before("client_id")
    out = events.select("loan_id", F.sum("n").over(w).alias("prior_repayment_count"), F.sum("amount").over(w).cast("decimal(38,6)").alias("prior_total_repaid"), F.max("last").over(w).alias("prior_last_repayment_date"))
    return out.where("loan_id is not null and prior_repayment_count > 0").withColumn("prior_avg_repayment", F.col("prior_total_repaid").cast("double") / F.col("prior_repayment_count"))


def prior_loans_by_join(loans: DataFrame) -> DataFrame:
    """The same counts by a range join, to check the windows against; it grows with the square of a client's loans."""
    now, before = loans.alias("now"), loans.alias("before")
    pair = (F.col("now.client_id") == F.col("before.client_id")) & (F.col("now.loan_id") != F.col("before.loan_id")) & (F.col("before.disbursed_on_date") < F.col("now.disbursed_on_date"))
    return now.join(before, pair).groupBy(F.col("now.loan_id").alias("loan_id")).agg(F.count("*").alias("prior_loan_count"), F.max("before.disbursed_on_date").alias("prior_last_disbursement_date"))


def gaps(key: str, day: str, tie: list[str], where: Column) -> Column:
    """Days since the key's last row before this one, among rows that `where` holds for; its first such row has no gap."""
    before = Window.partitionBy(key).orderBy(day, *tie).rowsBetween(Window.unboundedPreceding, -1)
    gap = F.datediff(F.col(day), F.last(F.when(where, F.col(day)), ignorenulls=True).over(before))
    return F.when(where & (gap >= 0), gap)

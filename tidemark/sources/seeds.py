"""Small lookup tables: CSV files with declared types, and the two that the lending models come with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOAN_STATUS = "status_id int, status_code string, status_label string, status_group string, is_terminal int"
PAR_BUCKETS = "bucket_order int, bucket_name string, min_days int, max_days int, provision_rate double"
#: Loan statuses.
STATUSES = [
    (100, "loanStatusType.submitted.and.pending.approval", "Submitted and pending approval", "Pipeline", 0),
    (200, "loanStatusType.approved", "Approved", "Pipeline", 0),
    (300, "loanStatusType.active", "Active", "Book", 0),
    (303, "loanStatusType.transfer.in.progress", "Transfer in progress", "Book", 0),
    (400, "loanStatusType.withdrawn.by.client", "Withdrawn by client", "Terminated", 1),
    (500, "loanStatusType.rejected", "Rejected", "Terminated", 1),
    (600, "loanStatusType.closed.obligations.met", "Closed (obligations met)", "Terminated", 1),
    (601, "loanStatusType.closed.written.off", "Closed (written off)", "Terminated", 1),
    (602, "loanStatusType.closed.rescheduled", "Closed (rescheduled)", "Terminated", 1),
    (700, "loanStatusType.overpaid", "Overpaid", "Terminated", 1),
]
#: Bands of days past due, with the share that is provided for.
BUCKETS = [(1, "Current", 0, 0, 0.01), (2, "PAR 1-30", 1, 30, 0.1), (3, "PAR 31-60", 31, 60, 0.25), (4, "PAR 61-90", 61, 90, 0.5), (5, "PAR 91-180", 91, 180, 0.75), (6, "PAR 180+", 181, 99999, 1.0)]


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header, in the declared types; a value that isn't of its type fails the job."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def through_csv(df: DataFrame, path: str) -> DataFrame:
    """A lookup published as CSV and read back in its types."""
    df.coalesce(1).write.option("header", True).csv(path)
    return read_csv(df.sparkSession, path, ", ".join(f"{n} {t}" for n, t in df.dtypes))


def loan_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUSES, LOAN_STATUS)


def par_buckets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUCKETS, PAR_BUCKETS)

"""Scalars of the models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import Settings

#: Names of the bands of days past due, by the edges 0, 30, 60, 90, 180.
PAR_BANDS = ("Current", "PAR 1-30", "PAR 31-60", "PAR 61-90", "PAR 91-180", "PAR 180+")
#: Transaction type ids.
CATEGORIES = {1: "disbursement", 2: "repayment", 4: "accrual", 5: "waive_interest", 6: "write_off", 7: "recovery_repayment", 8: "waive_charges", 9: "charge_payment", 10: "refund"}
#: Bands as (below, name), then the name of the rest.
AGE_BANDS = ([(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")], "55+")
TENURE_BANDS = ([(6, "0-6 months"), (12, "6-12 months"), (24, "1-2 years"), (60, "2-5 years")], "5+ years")


def money(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(0)).cast("decimal(38,6)")


def ratio(n: Column | str, d: Column | str) -> Column:
    """As a double; NULL where the divisor is 0 or NULL."""
    n, d = (F.col(x) if isinstance(x, str) else x for x in (n, d))
    return F.try_divide(n.cast("double"), d.cast("double"))


def surrogate_key(*columns: str) -> Column:
    """A 60-bit hash of the columns as text, joined by | with <null> for NULL: the first digits of its MD5, which other
    engines can compute as well."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def band(x: Column, bands: list[tuple[int, str]], rest: str, missing: str | None = None) -> Column:
    out = F.when(x.isNull(), F.lit(missing)) if missing else None
    for below, name in bands:
        out = out.when(x < below, name) if out is not None else F.when(x < below, name)
    return out.otherwise(rest)


def par_bucket(days: Column | str, edges: tuple[int, ...] = Settings().par_edges) -> Column:
    """NULL days are current."""
    days = F.col(days) if isinstance(days, str) else days
    out = F.when(days.isNull() | (days <= edges[0]), PAR_BANDS[0])
    for edge, name in zip(edges[1:], PAR_BANDS[1:], strict=False):
        out = out.when(days <= edge, name)
    return out.otherwise(PAR_BANDS[-1])


def category(type_id: Column | str) -> Column:
    type_id = F.col(type_id) if isinstance(type_id, str) else type_id
    table = F.create_map(*[F.lit(x) for k, v in CATEGORIES.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(table, type_id.cast("int")), F.lit("other"))


def days_past_due(counter: Column, since: Column, as_of: dt.date) -> Column:
    """The counter where it is positive, else the days since the loan became overdue, else 0."""
    return F.when(counter > 0, counter).when(since.isNotNull(), F.datediff(F.lit(as_of), since)).otherwise(0).cast("int")


def flag(condition: Column) -> Column:
    """1 or 0; NULL counts as not."""
    return F.when(condition, 1).otherwise(0)


def years_between(a: Column, b: Column) -> Column:
    """Year boundaries crossed."""
    return F.year(b) - F.year(a)


def months_between(a: Column, b: Column) -> Column:
    """Month boundaries crossed."""
    return 12 * (F.year(b) - F.year(a)) + F.month(b) - F.month(a)


def week_start(d: Column) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def date_key(d: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.date_format(d, pattern).cast("int")


def hierarchy_depth(path: Column) -> Column:
    path = F.coalesce(path, F.lit("."))
    return F.greatest(F.length(path) - F.length(F.replace(path, F.lit("."), F.lit(""))) - 1, F.lit(0))


def client_segment(total: Column, active: Column, worst: Column, repeat: Column, threshold: int) -> Column:
    total, active, worst = (F.coalesce(x, F.lit(0)) for x in (total, active, worst))
    return (
        F.when((active == 0) & (total == 0), "Prospect").when(active == 0, "Dormant").when(worst > threshold, "At risk")
        .when(worst > 0, "Watch").when(F.coalesce(repeat, F.lit(0)) == 1, "Repeat - performing").otherwise("New - performing")
    )


def savings_behaviour(is_active: Column, balance: Column, withdrawal_ratio: Column) -> Column:
    return (
        F.when(is_active == 0, "Closed").when(balance <= 0, "Empty").when(withdrawal_ratio.isNull(), "No activity")
        .when(withdrawal_ratio > 0.9, "Transactional").when(withdrawal_ratio > 0.5, "Mixed").otherwise("Accumulating")
    )


def split_hint(day: Column, as_of: dt.date) -> Column:
    at = F.lit(as_of)
    return F.when(day < F.add_months(at, -12), "train").when(day < F.add_months(at, -6), "validation").otherwise("test")

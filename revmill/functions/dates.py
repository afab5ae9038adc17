"""Reference-date arithmetic. Every function takes the reference date as an
argument (date, datetime, ISO text or Column), so a run can be repeated."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

When = date | datetime | str | Column


def moment(as_of: When) -> Column:
    """The reference date as TIMESTAMP without zone; a literal folds in the plan."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def day(as_of: When) -> Column:
    return moment(as_of).cast("date")


def month_start(as_of: When) -> Column:
    return F.trunc(day(as_of), "MM")


def months_before(as_of: When, months: int) -> Column:
    """Calendar months back, clamped at month ends."""
    return F.add_months(day(as_of), -months)


def period_bounds(as_of: When, boundary: str = "date") -> dict[str, Column]:
    """Start of each reporting period around ``as_of``.

    ``boundary="date"`` puts starts at midnight. ``boundary="timestamp"`` keeps the
    time of day of ``as_of`` in every start, so that a row dated the first of a
    month lies before the start of that month.
    """
    today = day(as_of)
    month, quarter = F.trunc(today, "MM"), F.trunc(today, "QUARTER")
    starts = {
        "last_month_start": F.add_months(month, -1),
        "last_quarter_start": F.add_months(quarter, -3),
        "current_quarter_start": quarter,
        "prev_quarter_start": F.add_months(quarter, -3),
        "mtd_start": month,
        "ytd_start": F.trunc(today, "YEAR"),
    }
    if boundary == "date":
        return starts
    if boundary != "timestamp":
        raise ValueError("boundary is 'date' or 'timestamp'")
    clock = moment(as_of) - today.cast("timestamp_ntz")
    return {name: start.cast("timestamp_ntz") + clock for name, start in starts.items()}


def period_conditions(
    date_col: Column, as_of: When, boundary: str = "date", until: When | None = None
) -> dict[str, Column]:
    """Half-open membership per period. The running periods have no upper bound
    unless ``until`` (exclusive) is given, so rows dated later than ``as_of`` count."""
    at = period_bounds(as_of, boundary)

    def running(start: Column) -> Column:
        open_ended = date_col >= start
        return open_ended if until is None else open_ended & (date_col < moment(until))

    def between(start: Column, end: Column) -> Column:
        return (date_col >= start) & (date_col < end)

    return {
        "last_month": between(at["last_month_start"], at["mtd_start"]),
        "last_quarter": between(at["last_quarter_start"], at["current_quarter_start"]),
        "mtd": running(at["mtd_start"]),
        "ytd": running(at["ytd_start"]),
        "current_quarter": running(at["current_quarter_start"]),
        "prev_quarter": between(at["prev_quarter_start"], at["current_quarter_start"]),
    }


def period_flags(df: DataFrame, date_col: str, as_of: When, boundary: str = "date") -> DataFrame:
    """Adds one boolean column per period; a row without a date is in none."""
    inside = period_conditions(F.col(date_col), as_of, boundary)
    return df.withColumns({f"is_{n}": F.coalesce(c, F.lit(False)) for n, c in inside.items()})


def since(
    df: DataFrame,
    date_col: str,
    as_of: When,
    months: int = 12,
    until: When | None = None,
    month_partition: str | None = None,
) -> DataFrame:
    """Rows from ``months`` before ``as_of`` on, inclusive; open at the top unless
    ``until`` (exclusive) is given. Plain range predicates, so they reach the scan.
    ``month_partition`` names a column holding the month start of ``date_col``, by
    which the table is laid out; whole folders are then skipped too."""
    start = months_before(as_of, months)
    kept = df.where(F.col(date_col) >= start)
    if month_partition:
        kept = kept.where(F.col(month_partition) >= F.trunc(start, "MM"))
    if until is not None:
        kept = kept.where(F.col(date_col) < day(until))
    return kept


def from_date(df: DataFrame, date_col: str, start: When) -> DataFrame:
    return df.where(F.col(date_col) >= day(start))


def same_month(date_col: Column, as_of: When) -> Column:
    """Same calendar month, written as a range on the bare column so that it is pushed down."""
    first = month_start(as_of)
    return (date_col >= first) & (date_col < F.add_months(first, 1))


def truncate(date_col: Column, grain: str) -> Column:
    """First day of the period holding the date; ``grain`` is day, week, month, quarter or year."""
    return date_col.cast("date") if grain == "day" else F.trunc(date_col, grain)


def back(start: Column, grain: str, n: int) -> Column:
    """``n`` whole periods before a period start."""
    if grain in ("day", "week"):
        return F.date_sub(start, n * (7 if grain == "week" else 1))
    return F.add_months(start, -n * {"month": 1, "quarter": 3, "year": 12}[grain])


def period_number(date_col: Column, grain: str) -> Column:
    """Running number of the period holding the date; whole numbers that differ by one
    between neighbours. Weeks start on Monday."""
    date_col = date_col.cast("date")
    if grain == "day":
        return F.unix_date(date_col)
    if grain == "week":
        return F.floor((F.unix_date(date_col) + 3) / 7).cast("int")
    if grain == "month":
        return F.year(date_col) * 12 + F.month(date_col)
    if grain == "quarter":
        return F.year(date_col) * 4 + F.quarter(date_col)
    if grain == "year":
        return F.year(date_col)
    raise ValueError(f"unknown grain {grain}")


def periods_between(start: Column, date_col: Column, grain: str) -> Column:
    """Number of periods from the one of ``start`` to the one of the date."""
    return period_number(date_col, grain) - period_number(start, grain)

"""Column helpers, all built from Spark's own expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.schema import EVENT_TIME_PATTERN


def parse_event_time(date: Column | str) -> Column:
    """Wire date text to timestamp; NULL, never an error, when the text does not fit."""
    return F.try_to_timestamp(date, F.lit(EVENT_TIME_PATTERN))


def format_event_time(ts: Column | str) -> Column:
    return F.date_format(ts, EVENT_TIME_PATTERN)


def exact_part(amount: Column | str) -> Column:
    """The amount to nine decimals, so that sums do not depend on row order; NULL from 1e18 on and for NaN.

    Sums of it are decimal(38,9) and hold 1e11 of the largest.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.when(F.abs(amount) < F.lit(1e18), amount).try_cast("decimal(28,9)")


def rest_part(amount: Column | str) -> Column:
    """What :func:`exact_part` leaves out: 0 for money values, digits beyond the ninth, or the whole amount."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount - F.coalesce(exact_part(amount).cast("double"), F.lit(0.0))


def money(exact: Column, rest: Column) -> Column:
    """The total of both sums; NULL where there was no amount."""
    return F.coalesce(exact.cast("double"), F.lit(0.0)) + rest


def round2(value: Column | str) -> Column:
    """Two-decimal display rounding: scale, round half to even, scale back."""
    value = F.col(value) if isinstance(value, str) else value
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def or_zero(value: Column | str) -> Column:
    return F.coalesce(value if isinstance(value, Column) else F.col(value), F.lit(0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; 0 when either is NULL or the denominator is 0."""
    return F.coalesce(numerator / F.nullif(denominator.cast("double"), F.lit(0.0)), F.lit(0.0))


def user_id(number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.format_string("user_%07d", number.cast("bigint"))


def utc(moment: datetime) -> datetime:
    """A datetime without zone means UTC, never the zone of the Python process."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def instant(as_of: datetime | Column | None, tx: DataFrame) -> Column:
    """The moment trailing windows end at. ``None`` means the newest event time in ``tx``.

    The default stays inside the plan as a scalar subquery: nothing is fetched to the driver.
    """
    if as_of is None:
        return tx.agg(F.max("ts")).scalar()
    if isinstance(as_of, datetime):
        return F.lit(utc(as_of))
    return as_of


def before(moment: Column, seconds: int) -> Column:
    return moment - F.make_dt_interval(secs=F.lit(seconds))

"""Column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from ..schema import WEEKDAYS


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def timestamp_literal(moment: datetime) -> Column:
    """A naive timestamp, passed as text so that no time zone gets between."""
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def trip_minutes(pickup: Column, dropoff: Column) -> Column:
    """Minutes between two timestamps, whole seconds, two decimals.

    ``seconds * 100 / 60`` is a multiple of one third, so it never lies half way between two
    integers: ``rint`` gives what decimal rounding gives, without a BigDecimal per row.
    """
    seconds = F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)
    return F.rint(seconds * 100 / 60) / 100


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def weekday_name(ts: Column) -> Column:
    """English day name, by lookup instead of a date formatter."""
    return F.elt(F.dayofweek(ts.cast("date")), *[F.lit(day) for day in WEEKDAYS])


def tip_rate(tip: Column, fare: Column) -> Column:
    return F.round(F.try_divide(tip, fare), 4)


def month_start(ts: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(ts.cast("date"), "month")


def as_timestamp(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def distance_bucket(distance: Column) -> Column:
    """Distance rounded half up to a tenth of a mile."""
    return F.round(distance, 1)


def round_half_up(value: Column, digits: int) -> Column:
    """Round a computed average half up, as a decimal database would.

    A mean of doubles carries a last-bit error, so a true tie may sit just below the half. The
    inner rounding takes that error away; NaN and infinity pass through.
    """
    return F.round(F.round(value, 10), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division giving NULL for a zero or NULL denominator."""
    return F.try_divide(numerator, denominator)


def number(value: Column) -> Column:
    """The value, or NULL where it is NaN."""
    return F.when(~F.isnan(value), value)


def elapsed_hours(later: Column, earlier: Column) -> Column:
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 3600


def interleave(a: Column, b: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of two integers taken in turn: near in this order is near in both."""
    out = F.lit(0)
    for k in range(bits):
        for column, place in ((a, 2 * k + 1), (b, 2 * k)):
            bit = F.shiftright(column, k).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(bit, place))
    return out

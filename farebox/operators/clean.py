"""Outlier rules and derived columns for normalised trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions import scalar

# Every rule is NULL or false for a missing value, so such rows are dropped. Spark orders NaN above
# every number: rules with an upper bound reject it by themselves, the others say so. The plain
# comparison comes first, because only that form can be pushed into the Parquet scan.


def valid_amounts() -> Column:
    distance, fare, total = F.col("trip_distance"), F.col("fare_amount"), F.col("total_amount")
    return (
        (distance > 0) & ~F.isnan(distance)
        & (fare > 0) & (fare <= S.MAX_FARE)
        & (total > 0) & ~F.isnan(total)
    )


def valid_passengers() -> Column:
    return F.col("passenger_count").between(S.MIN_PASSENGERS, S.MAX_PASSENGERS)


def minutes() -> Column:
    return scalar.trip_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))


def valid_duration() -> Column:
    """Tested on the rounded duration."""
    return minutes().between(S.MIN_MINUTES, S.MAX_MINUTES)


def rules() -> dict[str, Column]:
    """What a trip must satisfy, by the name a violation is reported under; NULL is a violation."""
    return {
        "bad_distance": (F.col("trip_distance") > 0) & ~F.isnan("trip_distance"),
        "bad_fare_low": F.col("fare_amount") > 0,
        "bad_fare_high": F.col("fare_amount") <= S.MAX_FARE,
        "bad_total": (F.col("total_amount") > 0) & ~F.isnan("total_amount"),
        "bad_passengers": valid_passengers(),
        "bad_duration_short": minutes() >= S.MIN_MINUTES,
        "bad_duration_long": minutes() <= S.MAX_MINUTES,
    }


# Violations in the order of their bits; the last one is known where files are read.
VIOLATIONS = (
    "bad_distance", "bad_fare_low", "bad_fare_high", "bad_total", "bad_passengers", "bad_duration_short",
    "bad_duration_long", "foreign_month")


def _derived(trips: DataFrame) -> DataFrame:
    pickup = F.col("tpep_pickup_datetime")
    return trips.withColumn("tip_amount", scalar.number(F.col("tip_amount"))).withColumns({
        "trip_duration_min": minutes(),
        "pickup_hour": scalar.hour_of_day(pickup),
        "pickup_weekday": scalar.weekday_name(pickup),
        "tip_rate": scalar.tip_rate(F.col("tip_amount"), F.col("fare_amount")),
    })


def clean(trips: DataFrame) -> DataFrame:
    """Apply all rules and add the derived columns, in table order.

    One narrow stage: filter, project, no shuffle. The rules on fare run before the tip rate, so
    its divisor is positive.
    """
    kept = trips.where(valid_amounts() & valid_passengers() & valid_duration())
    return _derived(kept).select(*S.TABLE_COLUMNS)


def judge(trips: DataFrame) -> DataFrame:
    """Every trip in table order, with ``broken``: one bit for each rule it breaks, 0 if it is clean.

    The clean ones are exactly what ``clean`` keeps. A column ``own_month`` says whether a trip belongs
    to the month it was read for; where there is none, all do. Other columns go along.
    """
    tests = list(rules().values())
    tests.append(F.col("own_month") if "own_month" in trips.columns else F.lit(True))
    bits = [F.when(F.coalesce(test, F.lit(False)), 0).otherwise(1 << k) for k, test in enumerate(tests)]
    broken = reduce(lambda a, b: a.bitwiseOR(b), bits)
    extra = [c for c in trips.columns if c not in S.TABLE_COLUMNS and c != "own_month"]
    return _derived(trips.withColumn("broken", broken)).select(*S.TABLE_COLUMNS, *extra, "broken")


def violation_counts(judged: DataFrame, *keys: str) -> DataFrame:
    """Rejected rows per key and set of broken rules, spelled out; one pass, pre-aggregated."""
    names = F.array(*[
        F.when(F.col("broken").bitwiseAND(F.lit(1 << k)) != 0, name) for k, name in enumerate(VIOLATIONS)])
    counts = judged.where("broken <> 0").groupBy(*keys, "broken").agg(F.count(F.lit(1)).alias("rejected"))
    return counts.select(*keys, "broken", F.concat_ws(",", F.array_compact(names)).alias("violations"), "rejected")


def cleaning_report(trips: DataFrame) -> DataFrame:
    """Rows before and after cleaning, and how many rows each rule would reject by itself.

    One pass with conditional counts; a row that breaks several rules counts under each.
    """
    tests = rules()
    kept = reduce(lambda a, b: a & b, tests.values())
    return trips.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        *[F.count_if(~F.coalesce(test, F.lit(False))).alias(name) for name, test in tests.items()],
        F.count_if(kept).alias("clean_rows"),
    )

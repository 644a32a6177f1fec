"""Each cleaning rule at both sides of its limit."""

import math
from datetime import date, datetime, timedelta

import pytest

from farebox.functions.months import months_of_year
from farebox.operators.clean import clean, cleaning_report
from farebox.operators.months import in_month_set
from farebox.schema import TABLE_COLUMNS, TRIP_SCHEMA
from farebox.sources.raw import MonthFile, in_own_month
from pyspark.sql import functions as F

MONDAY = datetime(2024, 1, 15, 9)


def trip(pickup=MONDAY, seconds=600, passengers=1.0, distance=1.0, fare=10.0, tip=2.0, total=13.0):
    dropoff = None if seconds is None else pickup + timedelta(seconds=seconds)
    return (1, pickup, dropoff, passengers, distance, fare, tip, total)


def cleaned(spark, rows):
    return clean(spark.createDataFrame(rows, TRIP_SCHEMA))


DERIVED = ("trip_duration_min", "pickup_hour", "pickup_weekday", "tip_rate")

KEPT = {
    "plain": (trip(), (10.0, 9, "Monday", 0.2)),
    "fare at cap": (trip(fare=1000.0), (10.0, 9, "Monday", 0.002)),
    "six passengers": (trip(passengers=6.0), (10.0, 9, "Monday", 0.2)),
    "fractional passengers": (trip(passengers=1.5), (10.0, 9, "Monday", 0.2)),
    "one minute": (trip(seconds=60), (1.0, 9, "Monday", 0.2)),
    "three hours": (trip(seconds=10800), (180.0, 9, "Monday", 0.2)),
    "no tip known": (trip(tip=None), (10.0, 9, "Monday", None)),
    "tip not a number": (trip(tip=math.nan), (10.0, 9, "Monday", None)),
    "third": (trip(fare=3.0, tip=1.0, total=5.0), (10.0, 9, "Monday", 0.3333)),
    "negative tip": (trip(seconds=100, tip=-1.0, total=9.0), (1.67, 9, "Monday", -0.1)),
    "tie rounds up": (trip(fare=8.0, tip=1.25), (10.0, 9, "Monday", 0.1563)),
    "first second": (trip(pickup=datetime(2024, 1, 1)), (10.0, 0, "Monday", 0.2)),
    "last second": (
        trip(pickup=datetime(2024, 1, 31, 23, 59, 59), seconds=601), (10.02, 23, "Wednesday", 0.2)),
    "infinite total": (trip(total=math.inf), (10.0, 9, "Monday", 0.2)),
}

DROPPED = {
    "distance 0": trip(distance=0.0),
    "distance unknown": trip(distance=None),
    "distance not a number": trip(distance=math.nan),
    "fare 0": trip(fare=0.0),
    "fare above cap": trip(fare=1000.01),
    "fare not a number": trip(fare=math.nan),
    "total 0": trip(total=0.0),
    "total not a number": trip(total=math.nan),
    "no passengers": trip(passengers=0.0),
    "seven passengers": trip(passengers=7.0),
    "passengers unknown": trip(passengers=None),
    "passengers not a number": trip(passengers=math.nan),
    "59 seconds": trip(seconds=59),
    "a second over three hours": trip(seconds=10801),
    "backwards": trip(seconds=-600),
    "no dropoff": trip(seconds=None),
}


def test_kept_rows_and_derived_columns(spark):
    rows = cleaned(spark, [row for row, _ in KEPT.values()]).select(*DERIVED).collect()
    assert sorted(map(tuple, rows), key=str) == sorted((d for _, d in KEPT.values()), key=str)


def test_dropped_rows(spark):
    assert cleaned(spark, list(DROPPED.values())).collect() == []


def test_columns(spark):
    assert cleaned(spark, [trip()]).columns == list(TABLE_COLUMNS)


def test_cleaning_twice_is_cleaning_once(spark):
    once = cleaned(spark, [row for row, _ in KEPT.values()])
    again = clean(once.select(*TRIP_SCHEMA.names))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_duration_equals_decimal_rounding_for_every_second(spark):
    seconds = spark.range(-100, 12_000).select(
        (F.rint(F.col("id") * 100 / 60) / 100).alias("fast"), F.round(F.col("id") / 60, 2).alias("slow")
    )
    assert seconds.where("fast <> slow").count() == 0


def test_own_month_and_month_set_differ_on_strays(spark):
    stray = trip(pickup=datetime(2024, 2, 1))
    early = trip(pickup=datetime(2023, 12, 31, 23, 59, 59))
    frame = spark.createDataFrame([trip(), stray, early], TRIP_SCHEMA)
    january = MonthFile(date(2024, 1, 1), "/raw/2024-01.parquet", "file:/raw/2024-01.parquet")
    april = MonthFile(date(2024, 4, 1), "/raw/2024-04.parquet", "file:/raw/2024-04.parquet")
    pickup = F.col("tpep_pickup_datetime")
    own = frame.where(in_own_month(pickup, F.lit(f"{january.uri}/part-0"), [january, april]))
    assert [r.tpep_pickup_datetime for r in own.collect()] == [MONDAY]
    assert frame.where(in_own_month(pickup, F.lit(april.uri), [january, april])).count() == 0
    months = months_of_year(2024, "1-2")
    assert in_month_set(frame, months).count() == 2
    assert in_month_set(frame, []).count() == 0


def test_report_counts_each_rule(spark):
    rows = [row for row, _ in KEPT.values()] + list(DROPPED.values())
    report = cleaning_report(spark.createDataFrame(rows, TRIP_SCHEMA)).first()
    assert report.raw_rows == len(rows)
    assert report.clean_rows == len(KEPT)
    assert (report.bad_distance, report.bad_fare_low, report.bad_fare_high) == (3, 1, 2)
    assert (report.bad_total, report.bad_passengers) == (2, 4)
    assert (report.bad_duration_short, report.bad_duration_long) == (3, 2)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Seoul"])
def test_zone_of_the_session_does_not_matter(spark, zone):
    """A trip over the change of clocks, without and with a zone; the session keeps its zone."""
    from datetime import datetime

    from farebox.sources.raw import normalise

    values = "1 AS passenger_count, 1D AS trip_distance, 9D AS fare_amount, 0D AS tip_amount, 9D AS total_amount"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for kind, mark in (("TIMESTAMP_NTZ", ""), ("TIMESTAMP", "Z")):
            raw = spark.sql(f"""SELECT 1 AS vendorid, {kind}'2024-11-03 05:20:00{mark}' AS
                tpep_pickup_datetime, {kind}'2024-11-03 06:40:00{mark}' AS tpep_dropoff_datetime, {values}""")
            row = clean(normalise(raw)).first()
            assert row.trip_duration_min == 80.0 and row.pickup_hour == 5
            assert row.tpep_pickup_datetime == datetime(2024, 11, 3, 5, 20)
        assert spark.conf.get("spark.sql.session.timeZone") == zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

"""Joins of the views where keys meet, and queries that are built without running."""

import pytest

import __spark_entry__ as contract
from farebox.operators import joins

HOURLY = "month int, pickup_hour int, pickup_weekday string, trip_count long"


def test_equal_counts_find_their_partners(spark):
    hourly = spark.createDataFrame([(1, 8, "Monday", 5), (2, 9, "Friday", 7), (2, 9, "Sunday", 1)], HOURLY)
    monthly = spark.createDataFrame([(1, 5, 2.5), (2, 9, 3.5)], "month int, trip_count long, avg_fare double")
    rows = joins.hourly_with_month_by_count(hourly, monthly).collect()
    assert {(r.month, r.trip_count, r.month_avg_fare) for r in rows} == {(1, 5, 2.5), (2, 7, None), (2, 1, None)}
    weekday = spark.createDataFrame(
        [("Monday", 7, 1.5), ("Tuesday", 7, 4.5), ("Friday", 2, 9.5)],
        "pickup_weekday string, trip_count long, avg_fare double")
    rows = joins.hourly_with_weekday_by_count(hourly, weekday).collect()
    assert sorted((r.trip_count, r.weekday_pickup_weekday) for r in rows if r.weekday_avg_fare) == [
        (7, "Monday"), (7, "Tuesday")]
    assert len(rows) == 4


@pytest.mark.parametrize("name", ["hourly_month_join", "hourly_weekday_join", "month_coverage", "missing_months"])
def test_building_a_query_runs_nothing(spark, name):
    context, folder = spark.sparkContext, "/root/testdata/sf0.001"

    def jobs(action):
        context.setJobGroup(f"{name}-{action.__name__}", "count")
        try:
            action()
            return len(context.statusTracker().getJobIdsForGroup(f"{name}-{action.__name__}"))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    def read():
        spark.read.parquet(f"{folder}/lineitem.parquet")

    def build():
        contract.queries()[name](spark, folder)

    assert jobs(build) <= jobs(read)

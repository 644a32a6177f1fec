"""Gate, health checks and ledger, with their empty-table and boundary behaviour."""

from datetime import date, datetime, timedelta

import pytest

from farebox.operators import quality as Q
from farebox.operators.summary import summarise
from farebox.schema import LEDGER_SCHEMA
from farebox.operators.dashboards import best_hour_per_weekday, golden_hour_heatmap, top_revenue_slots
from farebox.operators import views

NOW = datetime(2024, 6, 1, 12)
JAN = date(2024, 1, 1)
TRIPS = "tpep_pickup_datetime timestamp_ntz, fare_amount double, loaded_at timestamp_ntz"


def trips(spark, *fares, age_hours=1, pickup=datetime(2024, 1, 10)):
    rows = [(pickup, fare, NOW - timedelta(hours=age_hours)) for fare in fares]
    return spark.createDataFrame(rows, TRIPS)


def ledger(spark, *runs):
    rows = [
        (str(i), 2024, 1, 5, status, None, 1.0, NOW - timedelta(hours=age))
        for i, (status, age) in enumerate(runs)
    ]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def verdict(check):
    row = check.first()
    return row.value, row.passed


def test_gate(spark):
    good = trips(spark, 10.0, 1000.0)
    assert tuple(Q.quality_gate(good, JAN).first()) == (2, 0, True)
    assert Q.require_quality(good, JAN) == 2
    with pytest.raises(ValueError, match="2024-02 has no rows"):
        Q.require_quality(good, date(2024, 2, 1))
    # The fare check covers the whole table, not just the month.
    elsewhere = good.union(trips(spark, 1000.01, 0.0, pickup=datetime(2020, 5, 5)))
    assert tuple(Q.quality_gate(elsewhere, JAN).first()) == (2, 2, False)
    with pytest.raises(ValueError, match="2 fares"):
        Q.require_quality(elsewhere, JAN)


@pytest.mark.parametrize("age, passed", [(0, True), (48, True), (49, False)])
def test_freshness(spark, age, passed):
    assert verdict(Q.freshness(trips(spark, 1.0, age_hours=age), as_of=NOW)) == (float(passed), passed)


def test_null_rate(spark):
    assert verdict(Q.null_rate(trips(spark))) == (0.0, True)
    assert verdict(Q.null_rate(trips(spark, *[1.0] * 199, None))) == (0.5, True)
    assert verdict(Q.null_rate(trips(spark, *[1.0] * 99, None))) == (1.0, False)


def test_average_fare(spark):
    assert verdict(Q.average_fare(trips(spark))) == (0.0, False)
    assert verdict(Q.average_fare(trips(spark, 5.0))) == (5.0, True)
    assert verdict(Q.average_fare(trips(spark, 100.0))) == (100.0, True)
    assert verdict(Q.average_fare(trips(spark, 100.01))) == (100.01, False)
    # 10.015 is stored just below the half.
    assert verdict(Q.average_fare(trips(spark, 10.01, 10.02))) == (10.02, True)


def test_last_run_looks_at_the_status_only(spark):
    assert verdict(Q.last_run_check(ledger(spark), NOW)) == (None, False)
    assert verdict(Q.last_run_check(ledger(spark, ("failed", 9), ("success", 500)), NOW)) == (9.0, False)
    assert verdict(Q.last_run_check(ledger(spark, ("failed", 900), ("success", 500)), NOW)) == (500.0, True)


def test_report_and_summary(spark):
    report = Q.health_report(trips(spark, 10.0), ledger(spark, ("success", 2)), NOW)
    assert {r.check_name: r.passed for r in report.collect()} == {
        "fresh_rows": True, "null_fare_percent": True, "average_fare": True, "last_run": True}
    assert tuple(Q.health_summary(report).first()) == (True, 0)
    bad = Q.health_report(trips(spark, age_hours=99), ledger(spark), NOW)
    assert tuple(Q.health_summary(bad).first()) == (False, 3)


FACTS = """tpep_pickup_datetime timestamp_ntz, pickup_hour int, pickup_weekday string,
    fare_amount double, tip_amount double, total_amount double, tip_rate double,
    trip_duration_min double, trip_distance double"""


def facts(spark, *totals, duration=10.0, distance=1.0, hour=9):
    rows = [
        (datetime(2024, 1, 15, hour), hour, "Monday", 10.0, 1.0, t, 0.1, duration, distance)
        for t in totals
    ]
    return spark.createDataFrame(rows, FACTS)


def test_revenue_is_exact_in_any_order(spark):
    # Summed as doubles these end a little below or above the half.
    totals = [0.1] * 5 + [1e9 + 0.25, 0.75, 1e9]
    for order in (totals, totals[::-1]):
        for parts in (1, 3, 8):
            frame = facts(spark, *order).repartition(parts)
            assert views.monthly_trend(frame).first().total_revenue == 2e9 + 2
    assert views.monthly_trend(facts(spark, 0.25, 0.25)).first().total_revenue == 1.0
    assert views.monthly_trend(facts(spark, 0.25, 0.24)).first().total_revenue == 0.0
    assert views.monthly_trend(facts(spark, 5.0, float("inf"))).first().total_revenue == float("inf")


def test_zero_divisors_give_null(spark):
    row = views.driver_revenue(facts(spark, 5.0, duration=0.0, distance=0.0)).first()
    assert row.revenue_per_hour is None and row.revenue_per_mile is None


def test_ratio_of_averages(spark):
    frame = facts(spark, 10.0, duration=10.0).union(facts(spark, 30.0, duration=50.0))
    assert views.driver_revenue(frame).first().revenue_per_hour == 40.0


def test_descending_views_put_nulls_first(spark):
    frame = facts(spark, 5.0, duration=0.0, hour=3).union(facts(spark, 5.0, hour=4))
    assert [r.pickup_hour for r in views.driver_revenue(frame).collect()] == [3, 4]
    assert [r.pickup_hour for r in top_revenue_slots(frame).collect()] == [4, 3]
    assert [r.pickup_hour for r in best_hour_per_weekday(frame).collect()] == [4]
    assert golden_hour_heatmap(frame).first().hour_04 == 5.0


def test_distance_groups_by_tenths(spark):
    frame = facts(spark, 1.0, distance=2.25).union(facts(spark, 1.0, distance=2.349)).union(
        facts(spark, 1.0, distance=2.35))
    rows = views.distance_revenue(frame).collect()
    assert [(r.avg_distance, r.trip_count) for r in rows] == [(2.3, 2), (2.4, 1)]


def test_summaries_merge(spark):
    from farebox.operators.clean import clean
    from farebox.operators.summary import trip_summary
    from farebox.plans import inputs

    trips = clean(inputs.trips(spark, "/root/testdata/sf0.001"))
    n = trips.count()
    summary = trip_summary(trips).cache()
    for view in views.VIEWS.values():
        assert sum(r.trip_count for r in view(trips).collect()) == n
    for view in (views.hourly_stats, views.weekday_stats, views.monthly_trend, views.driver_revenue):
        assert view(trips).exceptAll(view(summary)).count() == 0
    with pytest.raises(ValueError):
        summarise(trips, ["moon_phase"])

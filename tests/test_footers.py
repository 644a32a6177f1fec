"""Checks from footers, views from one scan, months without trips, committed exports."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farebox.operators import dashboards, months, quality, views
from farebox.operators.clean import clean
from farebox.operators.summary import trip_summary
from farebox.plans import inputs, jobs
from farebox.sources import arrow_sink
from farebox.sources.footers import FooterChecks
from farebox.sources.ledger import RunLedger
from farebox.sources.tables import TripTable
from support import explained, month_file

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def write(spark, path, rows, **options):
    frame = spark.createDataFrame(rows, "fare_amount double, loaded_at timestamp_ntz").coalesce(1)
    frame.write.mode("append").options(**options).parquet(path)


def test_a_clean_table_reads_no_data_page(spark, folder):
    old, new = datetime(2024, 1, 1), datetime(2024, 5, 5, 5, 5, 5, 500)
    write(spark, f"{folder}/t/m=1", [(float(k), old) for k in range(1, 100)])
    write(spark, f"{folder}/t/m=2", [(None, new), (1000.0, new), (5.5, new)])
    checks = FooterChecks(spark, f"{folder}/t")
    assert checks.rows("fare_amount") == 102 and checks.outside("fare_amount", 0, 1000) == 0
    assert checks.nulls("fare_amount") == 1
    assert checks.since("loaded_at", new) == 3 and checks.since("loaded_at", datetime(2025, 1, 1)) == 0
    assert checks.since("loaded_at", old) == 102
    assert checks.scanned == []


def test_only_doubtful_files_are_read(spark, folder):
    now = datetime(2024, 1, 1)
    write(spark, f"{folder}/t", [(float(k), now) for k in range(1, 100)])
    write(spark, f"{folder}/t", [(0.0, now), (5.0, now), (1000.5, datetime(2024, 2, 1)), (None, now)])
    write(spark, f"{folder}/t", [(-1.0, now), (-2.0, now)])  # all of them are out of range
    checks = FooterChecks(spark, f"{folder}/t")
    assert checks.outside("fare_amount", 0, 1000) == 4 and len(checks.scanned) == 1
    trips = spark.read.parquet(f"{folder}/t")
    assert quality.bad_fares(trips).first().bad_fares == 4
    assert checks.since("loaded_at", datetime(2024, 1, 2)) == 1 and len(checks.scanned) == 2
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{folder}/bare")
    pq.write_table(pa.table({"fare_amount": [1.0, 2000.0, None]}), f"{folder}/bare/x.parquet", write_statistics=False)
    bare = FooterChecks(spark, f"{folder}/bare")
    assert (bare.outside("fare_amount", 0, 1000), bare.nulls("fare_amount")) == (1, 1) and len(bare.scanned) == 2


def test_empty_table_and_the_gate(spark, folder):
    store = jobs.Store(f"{folder}/table", f"{folder}/ledger")
    TripTable(spark, store.table).create()
    checks = FooterChecks(spark, store.table)
    assert checks.rows("fare_amount") == 0 and checks.outside("fare_amount", 0, 1000) == 0
    with pytest.raises(ValueError, match="2024-01 has no rows"):
        jobs.require_table_quality(spark, store, JAN)
    month_file(f"{folder}/raw", JAN, rows=9)
    jobs.monthly_load(spark, f"{folder}/raw", store, 2024, 1)
    assert jobs.require_table_quality(spark, store, JAN) == 9


def test_five_views_from_one_scan(spark, folder):
    trips = clean(inputs.trips(spark, "/root/testdata/sf0.001"))
    summary = trip_summary(trips)
    assert explained(summary).count(") Scan parquet") == 1
    plan = explained(views.all_views(trips))
    assert plan.count(") Scan parquet") == 1
    summary.write.parquet(f"{folder}/summary")
    kept = spark.read.parquet(f"{folder}/summary")
    together = views.all_views(trips)
    for name, view in views.VIEWS.items():
        expected = view(trips, ordered=False)
        assert view(kept, ordered=False).exceptAll(expected).count() == 0
        assert expected.exceptAll(view(kept, ordered=False)).count() == 0
        shown = together.where(F.col("view") == name).select(*views.VIEW_COLUMNS[name])
        assert shown.exceptAll(expected.select(*shown.columns)).count() == 0 and shown.count() == expected.count()


def test_distance_view_reads_the_stored_summary(spark, folder):
    store = jobs.Store(f"{folder}/table", f"{folder}/ledger", f"{folder}/summary")
    TripTable(spark, store.table).create()
    month_file(f"{folder}/raw", JAN, rows=9)
    month_file(f"{folder}/raw", FEB, rows=4, variant="B")
    jobs.backfill(spark, f"{folder}/raw", store, "2024-01", "2024-02")
    table = TripTable(spark, store.table)
    views.register_views(spark, table.read(), jobs.read_summary(table, store.summary))
    plan = explained(spark.table("v_distance_revenue"))
    assert "/summary" in plan and "/table" not in plan
    assert [r.trip_count for r in spark.table("v_distance_revenue").collect()] == [13]
    # A summary kept without distances is worked out again.
    old = spark.read.parquet(store.summary).where("grain = 'time'").drop("grain", "distance_bucket")
    old.write.partitionBy("pickup_month").parquet(f"{folder}/old")
    again = jobs.read_summary(table, f"{folder}/old")
    assert [r.trip_count for r in views.distance_revenue(again).collect()] == [13]


def test_a_missing_month_has_no_change(spark):
    trips = clean(inputs.trips(spark, "/root/testdata/sf0.001"))
    whole = {r.month: r for r in dashboards.revenue_mom(trips).collect()}
    gone = [date(1997, 3, 1), date(1997, 4, 1)]
    rows = {r.month: r for r in dashboards.revenue_mom(months.delete_month_range(trips, gone)).collect()}
    assert rows.keys() == whole.keys()
    for month, row in rows.items():
        if month.date() in gone:
            assert row.total_revenue is None and row.change_pct is None
        elif month.date() == date(1997, 5, 1):
            assert row.total_revenue is not None and row.change_pct is None
        else:
            assert row == whole[month]
    assert dashboards.revenue_mom(trips.limit(0)).count() == 0


def test_an_export_replaces_the_one_before(spark, folder):
    frame = spark.range(8).selectExpr("id", "id * 2 AS d")
    target = f"{folder}/csv"
    assert sum(p.rows for p in arrow_sink.export_partitions(frame.repartition(4), target)) == 8
    parts = arrow_sink.export_partitions(spark.range(0, 11, 1, 2).selectExpr("id", "id * 2 AS d"), target)
    assert sorted(p.rows for p in parts) == [5, 6]
    assert [n for n in sorted(os.listdir(target)) if not n.startswith(".")] == sorted(
        [arrow_sink.MANIFEST, *(p.name for p in parts)])
    assert arrow_sink.exported_parts(spark, target) == parts
    back = spark.read.option("header", True).schema("id long, d long").csv(target)
    assert back.count() == 11


def test_a_failed_export_leaves_nothing(spark, folder):
    target = f"{folder}/csv"
    arrow_sink.export_partitions(spark.range(6), target)
    before = sorted(os.listdir(target))
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("disk on fire")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="disk on fire"):
        arrow_sink.export_partitions(broken, target)
    assert sorted(os.listdir(target)) == before
    assert arrow_sink.export_partitions(spark.range(0), f"{folder}/none") == []


@pytest.mark.parametrize("summary", [False, True])
def test_health_of_the_table_is_that_of_its_trips(spark, folder, summary):
    store = jobs.Store(f"{folder}/table", f"{folder}/ledger", f"{folder}/summary" if summary else None)
    table = TripTable(spark, store.table).create()
    moments = (datetime(2024, 1, 1), datetime.now())

    def both(moment):
        ledger = RunLedger(spark, store.ledger).read()
        return [sorted(tuple(r) for r in report.collect()) for report in (
            jobs.table_health(spark, store, moment), quality.health_report(table.read(), ledger, moment))]

    for moment in moments:
        ours, plain = both(moment)
        assert ours == plain and len(ours) == 4 and not all(c[2] for c in ours)
    month_file(f"{folder}/raw", JAN, rows=9)
    month_file(f"{folder}/raw", FEB, rows=4, variant="B", fare=31.5)
    jobs.backfill(spark, f"{folder}/raw", store, "2024-01", "2024-02")
    for moment in moments:
        ours, plain = both(moment)
        assert ours == plain and all(c[2] for c in ours)

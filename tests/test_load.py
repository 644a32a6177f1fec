"""Month replacement on disk: reruns, gaps, failures, ledger and stored summary."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farebox.operators import views
from farebox.operators.clean import clean
from farebox.plans import inputs, jobs
from farebox.schema import TABLE_SCHEMA, TRIP_SCHEMA
from farebox.sources.ledger import RunLedger
from farebox.sources.raw import find_months, read_months
from farebox.sources.tables import TripTable, export_csv
from support import explained, month_file

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


@pytest.fixture
def store(spark, folder):
    store = jobs.Store(f"{folder}/table", f"{folder}/ledger", f"{folder}/summary")
    TripTable(spark, store.table).create()
    return store


@pytest.fixture
def raw(folder):
    month_file(f"{folder}/raw", JAN, rows=10)
    month_file(f"{folder}/raw", FEB, rows=20, variant="B")
    return f"{folder}/raw"


def counts(spark, store):
    rows = TripTable(spark, store.table).month_counts().collect()
    return {r.pickup_month: r.trip_count for r in rows}


def ledger(spark, store):
    return [
        (r.year, r.month, r.rows_loaded, r.status)
        for r in RunLedger(spark, store.ledger).read().orderBy("created_at", "year", "month").collect()
    ]


def test_create_and_guard(spark, folder):
    table = TripTable(spark, f"{folder}/t")
    assert not table.exists()
    with pytest.raises(RuntimeError, match="no trip table"):
        table.read()
    assert table.create().exists() and table.create().read().count() == 0
    assert table.read().schema == TABLE_SCHEMA


def test_load_and_rerun(spark, raw, store):
    first = jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    assert first.rows == {JAN: 10, FEB: 20} and first.total == 30
    again = jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    assert again.total == 30
    assert counts(spark, store) == {JAN: 10, FEB: 20}
    assert ledger(spark, store) == [
        (2024, 1, 10, "success"), (2024, 2, 20, "success")] * 2


def test_replacing_one_month_leaves_the_other(spark, folder, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    month_file(raw, JAN, rows=3, fare=99.0)
    jobs.monthly_load(spark, raw, store, 2024, 1)
    assert counts(spark, store) == {JAN: 3, FEB: 20}
    fares = TripTable(spark, store.table).read([JAN]).select("fare_amount").distinct().collect()
    assert [r.fare_amount for r in fares] == [99.0]


def test_missing_month_keeps_its_rows(spark, folder, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    other = f"{folder}/other"
    month_file(other, JAN, rows=1)
    month_file(other, MAR, rows=2)
    result = jobs.backfill(spark, other, store, "2024-01", "2024-03")
    assert result.missing == [FEB]
    assert counts(spark, store) == {JAN: 1, FEB: 20, MAR: 2}


def test_rejected_month_keeps_its_rows(spark, folder, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    month_file(f"{folder}/bad", JAN, drop=["total_amount"])
    result = jobs.backfill(spark, f"{folder}/bad", store, "2024-01", "2024-02")
    assert [r.file.month for r in result.rejected] == [JAN] and result.missing == [FEB]
    assert result.total == 0
    assert counts(spark, store) == {JAN: 10, FEB: 20}


def test_month_without_valid_rows(spark, folder, store):
    month_file(f"{folder}/none", JAN, rows=4, fare=5000.0)
    result = jobs.monthly_load(spark, f"{folder}/none", store, 2024, 1)
    assert result.rows == {JAN: 0}
    assert counts(spark, store) == {}


def test_empty_frame_changes_nothing(spark, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    empty = clean(spark.createDataFrame([], TRIP_SCHEMA))
    assert TripTable(spark, store.table).replace_months(empty) == 0
    assert counts(spark, store) == {JAN: 10, FEB: 20}


@pytest.mark.parametrize("layout", ["as_read", "rebalance"])
def test_failing_load_keeps_old_rows(spark, raw, store, layout):
    table = TripTable(spark, store.table)
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    trips = clean(read_months(spark, find_months(spark, raw)).trips)
    broken = trips.withColumn(
        "vendor_id", F.when(F.col("pickup_hour") < 99, F.raise_error(F.lit("disk on fire")).cast("int")))
    with pytest.raises(Exception, match="disk on fire"):
        table.replace_months(broken, layout=layout)
    assert counts(spark, store) == {JAN: 10, FEB: 20}


def test_null_timestamps_are_refused(spark, raw, store):
    trips = clean(read_months(spark, find_months(spark, raw)).trips)
    with pytest.raises(Exception, match="tpep_dropoff_datetime must not be NULL"):
        TripTable(spark, store.table).replace_months(
            trips.withColumn("tpep_dropoff_datetime", F.lit(None).cast("timestamp_ntz")))
    assert counts(spark, store) == {}


def test_failure_is_recorded(spark, folder, raw):
    store = jobs.Store(f"{folder}/absent", f"{folder}/ledger")
    with pytest.raises(RuntimeError, match="no trip table"):
        jobs.monthly_load(spark, raw, store, 2024, "1-2")
    rows = RunLedger(spark, store.ledger).read().orderBy("month").collect()
    assert [(r.month, r.status, r.rows_loaded, r.duration_sec) for r in rows] == [
        (1, "failed", None, None), (2, "failed", None, None)]
    assert "no trip table" in rows[0].error_msg
    assert len({r.id for r in rows}) == 2


def test_scheduled_load_runs_the_gate(spark, folder, raw, store):
    assert jobs.scheduled_load(spark, raw, store, date(2024, 4, 15)).rows == {JAN: 10}
    assert jobs.scheduled_load(spark, raw, store, date(2024, 11, 1)).missing == [date(2024, 8, 1)]
    month_file(f"{folder}/none", MAR, fare=5000.0)
    with pytest.raises(ValueError, match="2024-03 has no rows"):
        jobs.scheduled_load(spark, f"{folder}/none", store, date(2024, 6, 1))


def test_scheduled_load_is_not_satisfied_by_old_rows(spark, folder, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    month_file(f"{folder}/bad", JAN, drop=["total_amount"])
    with pytest.raises(ValueError, match="2024-01 was rejected"):
        jobs.scheduled_load(spark, f"{folder}/bad", store, date(2024, 4, 15))
    month_file(f"{folder}/none", JAN, fare=5000.0)
    with pytest.raises(ValueError, match="2024-01 has no rows"):
        jobs.scheduled_load(spark, f"{folder}/none", store, date(2024, 4, 15))
    assert counts(spark, store) == {JAN: 10, FEB: 20}
    assert [row[3] for row in ledger(spark, store)] == ["success", "success", "rejected", "empty"]


def test_every_requested_month_is_in_the_ledger(spark, folder, raw, store):
    month_file(raw, MAR, drop=["tip_amount"])
    month_file(raw, date(2024, 4, 1), rows=3, fare=5000.0)
    result = jobs.backfill(spark, raw, store, "2024-01", "2024-05")
    assert ledger(spark, store) == [
        (2024, 1, 10, "success"), (2024, 2, 20, "success"), (2024, 3, None, "rejected"),
        (2024, 4, 0, "empty"), (2024, 5, None, "missing")]
    rows = RunLedger(spark, store.ledger).read().collect()
    assert abs(sum(r.duration_sec or 0 for r in rows) - result.seconds) < 0.01
    assert "lacks tip_amount" in next(r.error_msg for r in rows if r.month == 3)
    assert result.raw == {JAN: 10, FEB: 20, date(2024, 4, 1): 3}
    assert result.dropped == {JAN: 0, FEB: 0, date(2024, 4, 1): 3} and result.nulled == {}


def test_month_is_taken_whole_or_not_at_all(spark, folder, store):
    """A part lacks a column, a second file does, a part cannot be read: old rows stay."""
    good, bad = f"{folder}/good", f"{folder}/bad"
    month_file(good, JAN, rows=20)
    month_file(good, FEB, rows=20)
    month_file(good, MAR, rows=20)
    jobs.backfill(spark, good, store, "2024-01", "2024-03")
    month_file(bad, JAN, rows=5, part="a")
    lacking = month_file(bad, JAN, rows=5, part="b", drop=["fare_amount"])
    month_file(f"{bad}/x", FEB, rows=5)
    month_file(f"{bad}/y", FEB, rows=5, drop=["fare_amount"])
    month_file(bad, MAR, rows=5, part="a")
    month_file(bad, MAR, rows=5, part="b", variant="B")
    broken = month_file(bad, MAR, rows=5, part="c", variant="B")
    with open(broken, "wb") as file:
        file.write(b"no parquet")
    result = jobs.backfill(spark, bad, store, "2024-01", "2024-03")
    assert result.total == 0 and counts(spark, store) == {JAN: 20, FEB: 20, MAR: 20}
    named = [r.file.path for r in result.rejected]
    assert any(p.endswith(lacking) for p in named) and any(p.endswith(broken) for p in named)
    assert len(named) == 3
    assert [row[3] for row in ledger(spark, store)][3:] == ["rejected"] * 3


def test_footers_are_read_in_few_jobs(spark, folder):
    for k in range(60):
        month_file(f"{folder}/raw", JAN, rows=2, part=f"{k:03d}", variant="AB"[k % 2])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        trips = read_months(spark, find_months(spark, f"{folder}/raw")).trips
        jobs_started = len(tracker.getJobIdsForGroup("footers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_started <= 8
    assert trips.count() == 120


def test_values_lost_to_a_cast_are_counted(spark, folder, store):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = month_file(f"{folder}/raw", JAN, rows=3)
    table = pq.read_table(path)
    at = table.schema.get_field_index("VendorID")
    pq.write_table(table.set_column(at, "VendorID", pa.array([1, 2**40, 2])), path)
    result = jobs.monthly_load(spark, f"{folder}/raw", store, 2024, 1)
    assert result.nulled == {"vendor_id": 1} and result.rows == {JAN: 3}


def test_stray_names_are_ignored(spark, folder, raw):
    month_file(raw, JAN, rows=1)
    import shutil

    shutil.copy(f"{raw}/trips_2024-01.parquet", f"{raw}/zones_2024-13.parquet")
    assert [f.month for f in find_months(spark, raw)] == [JAN, FEB]


def test_months_are_deleted_on_disk(spark, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    assert jobs.delete_months(spark, store, [JAN, MAR]) == [JAN]
    assert counts(spark, store) == {FEB: 20}
    table = TripTable(spark, store.table)
    views.register_views(spark, table.read(), jobs.read_summary(table, store.summary))
    assert spark.sql("SELECT sum(trip_count) FROM v_monthly_trend").first()[0] == 20


def test_stale_or_failing_summary(spark, folder, raw, store):
    """A failing refresh leaves the load standing; readers take the month from the trips."""
    jobs.monthly_load(spark, raw, store, 2024, 1)
    other = jobs.Store(store.table, store.ledger)
    jobs.monthly_load(spark, raw, other, 2024, 2)
    table = TripTable(spark, store.table)
    for _ in range(2):
        trips, summary = table.read(), jobs.read_summary(table, store.summary)
        for view in (views.hourly_stats, views.monthly_trend, views.driver_revenue):
            assert sorted(view(trips).collect()) == sorted(view(summary).collect())
    with open(f"{folder}/file", "w") as file:
        file.write("in the way")
    blocked = jobs.Store(store.table, store.ledger, f"{folder}/file/summary")
    month_file(raw, JAN, rows=4)
    result = jobs.monthly_load(spark, raw, blocked, 2024, 1)
    assert result.rows == {JAN: 4} and result.summary_error
    assert [row[3] for row in ledger(spark, store)][-2:] == ["success", "summary_failed"]
    views.register_views(spark, table.read(), jobs.read_summary(table, store.summary))
    assert spark.sql("SELECT sum(trip_count) FROM v_monthly_trend").first()[0] == 24


def test_layout_options_reach_the_table(spark, raw, store):
    from farebox.sources.tables import Layout

    jobs.monthly_load(spark, raw, store, 2024, "1-2", Layout("rebalance", 7, True))
    files = TripTable(spark, store.table).read().groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count"), F.sum("count")).first() == (7, 30)


def test_stored_summary_follows_the_table(spark, folder, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    month_file(raw, JAN, rows=3, fare=99.0)
    jobs.monthly_load(spark, raw, store, 2024, 1)
    trips, summary = TripTable(spark, store.table).read(), jobs.read_summary(TripTable(spark, store.table), store.summary)
    for view in (views.hourly_stats, views.weekday_stats, views.monthly_trend, views.driver_revenue):
        assert sorted(view(trips).collect()) == sorted(view(summary).collect())
    views.register_views(spark, trips, summary)
    assert spark.sql("SELECT sum(trip_count) FROM v_monthly_trend").first()[0] == 23
    assert spark.sql("SELECT count(*) FROM clean_taxi_trips").first()[0] == 23
    assert spark.table("v_distance_revenue").count() == 1


def test_layouts_hold_the_same_rows(spark, folder):
    trips = clean(inputs.trips(spark, "/root/testdata/sf0.001"))
    contents = []
    for name, options in {
        "read": {}, "even": {"layout": "rebalance"},
        "sorted": {"sort_by_time": True, "max_records_per_file": 50},
    }.items():
        table = TripTable(spark, f"{folder}/{name}").create()
        assert table.replace_months(trips, datetime(2024, 1, 1), **options) == 4331
        contents.append(table.read().groupBy(*TABLE_SCHEMA.names).count())
    assert contents[0].exceptAll(contents[1]).count() == 0
    assert contents[0].exceptAll(contents[2]).count() == 0
    sizes = TripTable(spark, f"{folder}/sorted").read().groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50
    with pytest.raises(ValueError):
        TripTable(spark, f"{folder}/read").replace_months(trips, layout="other")


def test_csv_export(spark, folder):
    trips = clean(inputs.trips(spark, "/root/testdata/sf0.001"))
    export_csv(trips, f"{folder}/csv", max_records_per_file=1000)
    back = spark.read.option("header", True).schema(trips.schema).csv(f"{folder}/csv")
    assert back.exceptAll(trips).count() == 0 and back.count() == 4331


def test_union_of_months_is_the_multi_month_scan(spark, raw):
    files = find_months(spark, raw)
    whole = read_months(spark, files).trips
    parts = [read_months(spark, [f]).trips for f in files]
    assert whole.exceptAll(parts[0].unionByName(parts[1])).count() == 0
    assert whole.count() == sum(p.count() for p in parts)


def test_checks_on_the_table_read_little(spark, raw, store):
    from farebox.operators import months, quality

    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    trips = TripTable(spark, store.table).read()
    assert tuple(quality.quality_gate(trips, FEB).first()) == (20, 0, True)

    count = explained(months.month_row_count(trips, FEB))
    assert "ReadSchema: struct<>" in count and "(pickup_month" in _line(count, "PartitionFilters")
    fares = explained(quality.bad_fares(trips))
    assert "Or(LessThanOrEqual(fare_amount,0.0),GreaterThan(fare_amount,1000.0))" in fares
    assert "GreaterThanOrEqual(loaded_at" in explained(
        quality.freshness(trips, as_of=datetime(2024, 1, 1)))
    hourly = _line(explained(views.hourly_stats(trips)), "ReadSchema")
    assert "datetime" not in hourly and "tip_amount" not in hourly

    kept = months.delete_month_range(trips, [JAN])
    assert "(pickup_month" in _line(explained(kept), "PartitionFilters") and kept.count() == 20
    fresh = trips.where(F.col("pickup_month") == F.lit(JAN)).withColumn("vendor_id", F.lit(9))
    replaced = months.replace_months(trips, fresh, [JAN])
    assert replaced.where("vendor_id = 9").count() == 10 and replaced.count() == 30


def _line(plan, start):
    return next(line for line in plan.splitlines() if line.startswith(start))


def test_hot_month_is_split(spark, folder):
    """Most rows in one month: rebalancing cuts it into several files."""
    trips = inputs.trips(spark, "/root/testdata/sf0.01")
    hot = F.make_timestamp_ntz(*[F.lit(n) for n in (1998, 3, 5, 10, 0, 0)])
    skewed = trips.withColumn("hot", F.col("vendor_id") + F.col("passenger_count") % 3 > 1).withColumns({
        "tpep_pickup_datetime": F.when(F.col("hot"), hot).otherwise(F.col("tpep_pickup_datetime")),
        "tpep_dropoff_datetime": F.when(F.col("hot"), hot + F.expr("INTERVAL '600' SECOND"))
        .otherwise(F.col("tpep_dropoff_datetime")),
    }).drop("hot")
    cleaned = clean(skewed.repartition(16))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "400k")
    try:
        table = TripTable(spark, f"{folder}/t").create()
        written = table.replace_months(cleaned, layout="rebalance")
    finally:
        spark.conf.set(key, before)
    files = (
        table.read().groupBy("pickup_month", F.input_file_name().alias("file")).count()
        .groupBy("pickup_month").agg(F.count("*").alias("files"), F.sum("count").alias("rows"))
        .orderBy(F.desc("rows")).collect()
    )
    assert sum(f.rows for f in files) == written
    assert files[0].rows > written / 2 and files[0].files > 2
    # Months that share a shuffle partition with the hot one are cut along with it.
    assert sum(f.files == 1 for f in files[1:]) > len(files) / 2


def test_sql_views_prune(spark, raw, store):
    """A month asked of a view reaches the partitions, an hour reaches the scan."""
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    views.register_views(spark, TripTable(spark, store.table).read())
    month = spark.sql("SELECT * FROM v_hourly_stats WHERE month = TIMESTAMP_NTZ'2024-02-01 00:00:00'")
    assert "= 2024-02-01)" in _line(explained(month), "PartitionFilters")
    assert [r.trip_count for r in month.collect()] == [20]
    hour = spark.sql("SELECT avg_fare FROM v_hourly_stats WHERE pickup_hour = 8")
    assert "EqualTo(pickup_hour,8)" in explained(hour)
    assert _line(explained(hour), "ReadSchema") == (
        "ReadSchema: struct<fare_amount:double,pickup_hour:int,pickup_weekday:string>")

"""Month files of differing schema, the schema gate, and what reaches the scan."""

from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq

from farebox.schema import RAW_COLUMNS, TRIP_SCHEMA
from farebox.sources import arrow_sink
from farebox.sources.raw import find_months, listed_months, missing_columns, normalise, read_months, row_count
from support import explained, month_file


def test_finds_files_and_directories(spark, folder):
    month_file(folder, date(2024, 1, 1))
    month_file(folder, date(2024, 2, 1), part=True)
    month_file(f"{folder}/2023", date(2023, 12, 1))
    (pq.write_table(pa.table({"x": [1]}), f"{folder}/other.parquet"))
    assert listed_months(spark, folder).count() == 3
    found = find_months(spark, folder)
    assert [f.month for f in found] == [date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    assert all(f.path.endswith(f"{f.month:%Y-%m}.parquet") for f in found)
    assert [f.month for f in find_months(spark, folder, [date(2024, 2, 1)])] == [date(2024, 2, 1)]


def test_mixed_schemas_are_read_together(spark, folder):
    month_file(folder, date(2024, 1, 1), rows=10, variant="A")
    month_file(folder, date(2024, 2, 1), rows=20, variant="B")
    month_file(folder, date(2024, 3, 1), rows=40, variant="A", part=True)
    raw = read_months(spark, find_months(spark, folder))
    assert raw.trips.schema.simpleString() == TRIP_SCHEMA.simpleString()
    assert raw.trips.count() == 70
    # Three months, two schemas, two scans.
    assert explained(raw.trips).count("(1) Scan parquet") == 1
    assert explained(raw.trips).count(") Scan parquet") == 2
    assert row_count(raw.trips).first().raw_rows == 70


def test_one_month_with_two_schemas(spark, folder):
    month_file(folder, date(2024, 1, 1), rows=10, variant="A", part="a")
    for part in "bcd":
        month_file(folder, date(2024, 1, 1), rows=20, variant="B", part=part)
    month_file(folder, date(2024, 2, 1), rows=5, variant="B", strays=[datetime(2024, 1, 9)])
    raw = read_months(spark, find_months(spark, folder, [date(2024, 1, 1)]))
    assert raw.trips.count() == 70
    assert explained(raw.trips).count(") Scan parquet") == 2
    assert read_months(spark, find_months(spark, folder)).trips.count() == 75
    assert {f.month for f in raw.accepted} == {date(2024, 1, 1)}


def test_one_month_in_two_places(spark, folder):
    month_file(f"{folder}/a b", date(2024, 1, 1), rows=10)
    month_file(f"{folder}/c", date(2024, 1, 1), rows=20)
    month_file(f"{folder}/c", date(2024, 2, 1), rows=40, strays=[datetime(2024, 1, 1)])
    assert read_months(spark, find_months(spark, folder)).trips.count() == 70


def test_gate_reports_missing_columns(spark, folder):
    month_file(folder, date(2009, 1, 1), drop=["passenger_count", "total_amount"])
    month_file(folder, date(2024, 1, 1), rows=10)
    raw = read_months(spark, find_months(spark, folder))
    assert raw.trips.count() == 10
    report = {r.month: r for r in raw.gate_report().collect()}
    assert report[date(2009, 1, 1)].missing_columns == "passenger_count, total_amount"
    assert not report[date(2009, 1, 1)].accepted and report[date(2024, 1, 1)].accepted


def test_all_files_rejected(spark, folder):
    month_file(folder, date(2009, 1, 1), drop=["passenger_count"])
    raw = read_months(spark, find_months(spark, folder))
    assert raw.trips.count() == 0 and raw.trips.schema == TRIP_SCHEMA
    assert len(raw.rejected) == 1


def test_foreign_months_are_dropped(spark, folder):
    strays = [datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 2, 1), datetime(2002, 1, 1)]
    month_file(folder, date(2024, 1, 1), rows=5, strays=strays)
    month_file(folder, date(2024, 2, 1), rows=7)
    assert read_months(spark, find_months(spark, folder)).trips.count() == 12


def test_scan_is_pruned_and_filtered(spark, folder):
    from farebox.operators.clean import clean

    month_file(folder, date(2024, 1, 1), rows=5, variant="B")
    plan = explained(clean(read_months(spark, find_months(spark, folder)).trips))
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "extra_column" not in schema
    assert all(c in schema for c in RAW_COLUMNS)
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for condition in (
        "GreaterThan(trip_distance,0.0)", "GreaterThan(fare_amount,0.0)",
        "LessThanOrEqual(fare_amount,1000.0)", "GreaterThan(total_amount,0.0)",
        "GreaterThanOrEqual(passenger_count,1.0)", "LessThanOrEqual(passenger_count,6.0)",
        "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)",
        "LessThan(tpep_pickup_datetime,2024-02-01T00:00)",
    ):
        assert condition in pushed
    assert "Exchange" not in plan and "Python" not in plan


def test_normalise_ignores_case_and_nulls_misfits(spark):
    frame = spark.sql("""SELECT 9999999999L AS VendorID, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS
        TPEP_pickup_datetime, TIMESTAMP_NTZ'2024-01-01 00:10:00' AS tpep_dropoff_datetime,
        'many' AS passenger_count, 1 AS trip_distance, 2.5BD AS fare_amount, 0D AS tip_amount,
        3F AS total_amount""")
    row = normalise(frame).first()
    assert row.vendor_id is None and row.passenger_count is None
    assert (row.trip_distance, row.fare_amount, row.total_amount) == (1.0, 2.5, 3.0)


def test_zoned_timestamps_lose_their_zone(spark):
    frame = spark.sql("""SELECT 1 AS vendorid, TIMESTAMP'2024-01-01 05:00:00Z' AS tpep_pickup_datetime,
        TIMESTAMP'2024-01-01 05:10:00Z' AS tpep_dropoff_datetime, 1 AS passenger_count,
        1 AS trip_distance, 1 AS fare_amount, 1 AS tip_amount, 1 AS total_amount""")
    assert normalise(frame).first().tpep_pickup_datetime == datetime(2024, 1, 1, 5)


def test_missing_columns_ignores_case(spark):
    assert missing_columns(spark.createDataFrame([], "VENDORID int, trip_distance int").schema) == (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "fare_amount",
        "tip_amount", "total_amount")


def test_arrow_writer_sees_every_row_once(spark):
    frame = spark.range(0, 1000, 1, 7)
    counts = arrow_sink.write_partitions(frame)
    assert counts.count() == 7
    assert arrow_sink.total_rows(counts).first().rows == 1000
    assert arrow_sink.total_rows(arrow_sink.write_partitions(spark.range(0))).first().rows == 0

    def add_up(batches):
        return sum(sum(batch.column(0).to_pylist()) for batch in batches)

    assert arrow_sink.total_rows(arrow_sink.write_partitions(frame, add_up)).first().rows == 499_500


def test_csv_writer_repeats_a_partition(spark, folder):
    frame = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 AS k")
    for _ in range(2):  # a second run puts the same files in place
        counts = arrow_sink.write_partitions(frame, arrow_sink.csv_writer(f"{folder}/csv"))
        assert arrow_sink.total_rows(counts).first().rows == 1000
    back = spark.read.option("header", True).schema("id long, k long").csv(f"{folder}/csv")
    assert back.count() == 1000 and back.exceptAll(frame).count() == 0

"""Staged loads: audit before publication, recovery of an interrupted one, quarantine, deletes."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farebox.operators.clean import VIOLATIONS, clean, judge, violation_counts
from farebox.plans import inputs, jobs
from farebox.schema import MONTH_COLUMN
from farebox.sources import publish, tables
from farebox.sources.files import Files
from farebox.sources.ledger import RunLedger
from farebox.sources.raw import find_months, read_months
from farebox.sources.tables import AuditError, TripTable, read_quarantine
from support import explained, month_file

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


@pytest.fixture
def store(spark, folder):
    store = jobs.Store(f"{folder}/table", f"{folder}/ledger", quarantine=f"{folder}/rejected")
    TripTable(spark, store.table).create()
    return store


@pytest.fixture
def raw(folder):
    month_file(f"{folder}/raw", JAN, rows=10)
    month_file(f"{folder}/raw", FEB, rows=20, variant="B")
    return f"{folder}/raw"


def counts(spark, store):
    return {r.pickup_month: r.trip_count for r in TripTable(spark, store.table).month_counts().collect()}


def statuses(spark, store):
    return [r.status for r in RunLedger(spark, store.ledger).read().orderBy("created_at", "month").collect()]


def leftovers(store):
    path = f"{store.table}/{publish.LOADS}"
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_a_count_mismatch_leaves_the_old_rows(spark, raw, store, monkeypatch):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    month_file(raw, JAN, rows=7)
    audit = tables.StagedMonths.audit

    def losing_a_month(staged, expected=None):
        Files(spark).delete(f"{staged.load.new}/side=kept/{MONTH_COLUMN}=2024-01-01")
        audit(staged, expected)

    monkeypatch.setattr(tables.StagedMonths, "audit", losing_a_month)
    with pytest.raises(AuditError, match="27 rows were written, 20 are there"):
        jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    assert counts(spark, store) == {JAN: 10, FEB: 20} and leftovers(store) == []
    assert statuses(spark, store) == ["success"] * 2 + ["failed"] * 2


@pytest.mark.parametrize("moves", range(5))
def test_an_interrupted_publication_is_finished_by_the_next_load(spark, raw, store, monkeypatch, moves):
    """Killed after each number of renames: two months, each with an old folder to put away."""
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    month_file(raw, JAN, rows=3)
    month_file(raw, FEB, rows=4, variant="B")
    real, done = Files.move, []

    def move(files, source, target):
        if len(done) == moves:
            raise KeyboardInterrupt
        done.append(target)
        real(files, source, target)

    monkeypatch.setattr(Files, "move", move)
    if moves < 4:
        with pytest.raises(KeyboardInterrupt):
            jobs.backfill(spark, raw, store, "2024-01", "2024-02")
        assert len(leftovers(store)) == 1
    else:
        jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    monkeypatch.setattr(Files, "move", real)
    month_file(raw, MAR, rows=2)
    jobs.monthly_load(spark, raw, store, 2024, 3)
    assert counts(spark, store) == {JAN: 3, FEB: 4, MAR: 2} and leftovers(store) == []


def test_a_load_that_never_published_is_no_load(spark, raw, store, monkeypatch):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    table = TripTable(spark, store.table)
    month_file(raw, JAN, rows=3)
    trips = clean(read_months(spark, find_months(spark, raw, [JAN])).trips)
    table.stage_months(trips)
    assert counts(spark, store) == {JAN: 10, FEB: 20} and len(leftovers(store)) == 1
    publish.recover(spark, store.table)  # it may still be running
    assert len(leftovers(store)) == 1
    monkeypatch.setattr(publish, "ORPHAN_HOURS", -1)
    assert publish.recover(spark, store.table) == []
    assert counts(spark, store) == {JAN: 10, FEB: 20} and leftovers(store) == []


def test_another_file_system_is_refused(spark, folder):
    load = publish.Publication(spark, f"{folder}/t")
    with pytest.raises(ValueError, match="another file system"):
        load.publish([publish.Move("http://other/t")])


def test_clean_and_rejected_rows_are_all_rows(spark, folder, raw, store):
    strays = [datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 2, 1)]
    month_file(raw, JAN, rows=10, strays=strays)
    month_file(raw, MAR, rows=6, fare=5000.0)
    result = jobs.backfill(spark, raw, store, "2024-01", "2024-03")
    assert result.raw == {JAN: 12, FEB: 20, MAR: 6}
    assert result.rows == {JAN: 10, FEB: 20, MAR: 0} and result.quarantined == {JAN: 2, FEB: 0, MAR: 6}
    kept = read_quarantine(spark, store.quarantine)
    found = {(r.pickup_month, r.violations): r.rejected for r in violation_counts(kept, MONTH_COLUMN).collect()}
    assert found == {(JAN, "foreign_month"): 2, (MAR, "bad_fare_high"): 6}
    assert kept.where("fare_amount is null or loaded_at is null").count() == 0
    # A later load of the month takes the place of what was rejected before.
    month_file(raw, JAN, rows=5)
    jobs.monthly_load(spark, raw, store, 2024, 1)
    assert {r.pickup_month for r in read_quarantine(spark, store.quarantine).collect()} == {MAR}
    assert counts(spark, store) == {JAN: 5, FEB: 20}
    plain = jobs.Store(f"{folder}/plain", store.ledger)
    TripTable(spark, plain.table).create()
    jobs.backfill(spark, raw, plain, "2024-01", "2024-02")
    ours, theirs = (TripTable(spark, s.table).read().drop("loaded_at") for s in (store, plain))
    assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_files_that_lose_rows_fail_the_load(spark, raw, store, monkeypatch):
    """Rows that are neither kept nor quarantined: the footers have more."""
    monkeypatch.setattr(jobs, "judge", lambda trips: judge(trips).where("tpep_pickup_datetime > '2024-01-01 08:02'"))
    with pytest.raises(AuditError, match="the files have 10 rows, 7 were written"):
        jobs.monthly_load(spark, raw, store, 2024, 1)
    assert counts(spark, store) == {} and statuses(spark, store) == ["failed"]


def test_judged_rows_are_the_cleaned_ones(spark):
    trips = inputs.trips(spark, "/root/testdata/sf0.001")
    judged = judge(trips)
    cleaned = clean(trips)
    assert judged.where("broken = 0").drop("broken").exceptAll(cleaned).count() == 0
    assert judged.count() == 6000 and judged.where("broken = 0").count() == cleaned.count() == 4331
    nothing = trips.select([F.lit(None).cast(f.dataType).alias(f.name) for f in trips.schema]).limit(1)
    assert judge(nothing).first().broken == (1 << len(VIOLATIONS) - 1) - 1
    assert judge(nothing.withColumn("own_month", F.lit(None).cast("boolean"))).first().broken == (
        1 << len(VIOLATIONS)) - 1


def test_one_job_reads_the_rows_of_a_load(spark, raw, store):
    """Misfits are counted, and rejects written, by the job that writes the table."""
    raw_months = read_months(spark, find_months(spark, raw), watch=True)
    assert len(raw_months.watched) == 1  # the files with 64-bit vendors
    table = TripTable(spark, store.table)
    staged = table.stage_months(judge(raw_months.marked), quarantine=store.quarantine)
    assert raw_months.misfit_counts() == {} and staged.written == 30
    plan = explained(judge(raw_months.marked))
    assert plan.count(") Scan parquet") == 2 and "Exchange" not in plan


@pytest.mark.parametrize("layout", ["as_read", "rebalance", "clustered"])
def test_misfits_are_counted_once_in_every_layout(spark, raw, store, layout):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = month_file(raw, JAN, rows=3)
    table = pq.read_table(path)
    at = table.schema.get_field_index("VendorID")
    pq.write_table(table.set_column(at, "VendorID", pa.array([1, 2**40, 2])), path)
    result = jobs.load_months(spark, raw, store, [JAN, FEB], tables.Layout(layout))
    assert result.nulled == {"vendor_id": 1} and result.rows == {JAN: 3, FEB: 20}


def test_deletes_are_in_the_ledger(spark, raw, store):
    jobs.backfill(spark, raw, store, "2024-01", "2024-02")
    assert jobs.delete_months(spark, store, [JAN, MAR]) == [JAN]
    rows = RunLedger(spark, store.ledger).read().where("status = 'deleted'").collect()
    assert [(r.year, r.month, r.rows_loaded) for r in rows] == [(2024, 1, 10)]
    assert leftovers(store) == [] and counts(spark, store) == {FEB: 20}
    from farebox.operators.quality import last_run

    assert last_run(RunLedger(spark, store.ledger).read()).first().status == "success"


def test_clustered_layout_is_narrow_in_both_keys(spark, folder):
    """A month's files are narrow in day and hour; sorted by time they are narrow in the day alone."""
    import pyarrow.parquet as pq

    month = spark.range(0, 31 * 24 * 60).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("t"))
    trips = clean(month.select(
        F.lit(1).alias("vendor_id"), F.col("t").alias("tpep_pickup_datetime"),
        (F.col("t") + F.expr("INTERVAL '10' MINUTE")).alias("tpep_dropoff_datetime"),
        *[F.lit(float(x)).alias(n) for n, x in (
            ("passenger_count", 1), ("trip_distance", 2), ("fare_amount", 10), ("tip_amount", 1), ("total_amount", 12))]))

    def read_share(name, column, low, high, **layout):
        table = TripTable(spark, f"{folder}/{name}").create()
        table.replace_months(trips.repartition(4), **layout)
        files = [f"{d}/{n}" for d, _, names in os.walk(table.path) for n in names if n.endswith(".parquet")]
        ranges = []
        for file in files:
            meta = pq.ParquetFile(file).metadata
            at = [meta.schema.column(k).path for k in range(meta.num_columns)].index(column)
            ranges += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        return sum(r.min <= high and r.max >= low for r in ranges) / len(ranges)

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        options = {"layout": "clustered", "max_records_per_file": 1000}
        assert read_share("a", "pickup_hour", 3, 3, **options) < 0.6
        assert read_share("b", "tpep_pickup_datetime", datetime(2024, 1, 9), datetime(2024, 1, 9, 23), **options) < 0.6
        assert read_share("c", "pickup_hour", 3, 3, layout="as_read", sort_by_time=True) == 1
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_ledger_stays_a_few_files(spark, folder):
    ledger = RunLedger(spark, f"{folder}/ledger", compact_files=5)
    for k in range(14):
        ledger.record({date(2024, 1 + k % 12, 1): ("success", k, None)}, 1.0)
    files = [n for n in os.listdir(f"{folder}/ledger") if n.endswith(".parquet")]
    assert len(files) <= 6
    total = ledger.read().agg(F.count("*").alias("n"), F.sum("rows_loaded").alias("rows")).first()
    assert tuple(total) == (14, sum(range(14)))
    # Interrupted after the merged file appeared: rows are there twice and count once.
    import shutil

    shutil.copy(f"{folder}/ledger/{files[0]}", f"{folder}/ledger/again-{files[0]}")
    assert ledger.read().count() == 14

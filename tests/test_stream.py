from datetime import date

from farebox.plans.jobs import Store
from farebox.sources.ledger import RunLedger
from farebox.sources.tables import TripTable
from farebox.streaming.pickup import pick_up_months
from support import month_file

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def test_new_months_are_loaded_once(spark, folder):
    raw, store = f"{folder}/raw", Store(f"{folder}/table", f"{folder}/ledger")
    table = TripTable(spark, store.table).create()

    def run():
        query = pick_up_months(spark, raw, store, f"{folder}/checkpoint")
        assert query.awaitTermination(120)
        counts = {r.pickup_month: r.trip_count for r in table.month_counts().collect()}
        return counts, RunLedger(spark, store.ledger).read().count()

    month_file(raw, JAN, rows=5)
    assert run() == ({JAN: 5}, 1)
    assert run() == ({JAN: 5}, 1)
    month_file(raw, FEB, rows=7, variant="B", part="a")
    assert run() == ({JAN: 5, FEB: 7}, 2)
    # A late part of February: the month is loaded again from both parts.
    month_file(raw, FEB, rows=2, part="b")
    assert run() == ({JAN: 5, FEB: 9}, 3)


def test_state_belongs_to_the_store(spark, folder):
    """Without a checkpoint: nothing new for the same store, everything for another one."""
    raw = f"{folder}/raw"
    month_file(raw, JAN, rows=5)
    first, second = (Store(f"{folder}/{n}/table", f"{folder}/{n}/ledger") for n in "ab")

    def runs(store, session):
        TripTable(session, store.table).create()
        assert pick_up_months(session, raw, store).awaitTermination(120)
        return RunLedger(session, store.ledger).read().count()

    assert runs(first, spark) == 1 and runs(first, spark) == 1
    assert runs(first, spark.newSession()) == 1
    assert runs(second, spark) == 1
    assert TripTable(spark, second.table).read().count() == 5


def test_a_replaced_file_is_loaded_again(spark, folder):
    """Overwritten in place: same path, other time or size."""
    raw = f"{folder}/raw"
    store = Store(f"{folder}/table", f"{folder}/ledger")
    TripTable(spark, store.table).create()

    def watch():
        pick_up_months(spark, raw, store).awaitTermination()
        rows = TripTable(spark, store.table).month_counts().collect()
        runs = RunLedger(spark, store.ledger).read().count()
        return {r.pickup_month: r.trip_count for r in rows}, runs

    jan, feb, mar = (date(2024, m, 1) for m in (1, 2, 3))
    month_file(raw, jan, rows=5)
    month_file(raw, feb, rows=6, variant="B")
    assert watch() == ({jan: 5, feb: 6}, 2)
    assert watch() == ({jan: 5, feb: 6}, 2)
    month_file(raw, jan, rows=8)
    assert watch() == ({jan: 8, feb: 6}, 3)
    month_file(raw, feb, rows=7, variant="B")
    month_file(raw, mar, rows=2)
    assert watch() == ({jan: 8, feb: 7, mar: 2}, 5)
    assert watch() == ({jan: 8, feb: 7, mar: 2}, 5)

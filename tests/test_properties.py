"""Invariants on generated input."""

from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from farebox.functions import months as M
from farebox.operators import views
from farebox.operators.clean import clean, cleaning_report
from farebox.schema import TRIP_SCHEMA
from farebox.session import shared_dir

some_months = st.lists(st.dates(date(2009, 1, 1), date(2030, 12, 31)).map(lambda d: d.replace(day=1)))
quick = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


@given(some_months)
def test_bounds_cover_exactly_the_months(months):
    bounds = M.month_bounds(months)
    covered = [m for low, high in bounds for m in M.month_span(low, high - timedelta(days=1))]
    assert covered == sorted(set(months))
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


@given(st.lists(st.integers(1, 12), min_size=1))
def test_month_lists_round_trip(numbers):
    assert M.parse_months(",".join(map(str, numbers))) == sorted(set(numbers))


@given(st.dates(date(2009, 1, 1), date(2030, 12, 31)), st.integers(0, 40))
def test_target_month_lies_lag_months_back(run, lag):
    assert len(M.month_span(M.target_month(run, lag), run)) == lag + 1


cents = st.integers(1, 200_000).map(lambda n: n / 100)
trips = st.lists(
    st.tuples(
        st.integers(0, 59), st.integers(0, 12_000), st.sampled_from([0.0, 1.0, 4.0, 6.0, 7.0, None]),
        st.sampled_from([0.0, 0.1, 3.0, None]), cents, st.sampled_from([0.0, 1.5, None]), cents,
    ),
    min_size=1, max_size=60,
)


@quick
@given(trips)
def test_cleaning_and_totals_against_plain_arithmetic(spark, generated):
    start = datetime(2024, 1, 15, 9)
    rows = [
        (1, start + timedelta(minutes=m), start + timedelta(minutes=m, seconds=s), p, d, f, t, total)
        for m, s, p, d, f, t, total in generated
    ]
    frame = spark.createDataFrame(rows, TRIP_SCHEMA)
    kept = [
        row for row, (_, s, p, d, f, _, _) in zip(rows, generated)
        if d and p is not None and 1 <= p <= 6 and f <= 1000 and 60 <= s <= 10_800
    ]
    cleaned = clean(frame)
    assert cleaned.count() == len(kept) == cleaning_report(frame).first().clean_rows
    if kept:
        row = views.monthly_trend(cleaned).first()
        total = sum(Decimal(str(r[7])) for r in kept)
        assert row.total_revenue == float(total.quantize(Decimal(1), ROUND_HALF_UP))
        mean = sum(Decimal(str(r[5])) for r in kept) / len(kept)
        assert row.avg_fare == float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_checkpoints_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farebox.functions import months as M
from farebox.operators.months import target_month


@pytest.mark.parametrize("spec, expected", [
    (3, [3]), ("1", [1]), ("1-3", [1, 2, 3]), ("1,4,7", [1, 4, 7]), ("4,1-2,2", [1, 2, 4]),
])
def test_parse_months(spec, expected):
    assert M.parse_months(spec) == expected


@pytest.mark.parametrize("spec", [0, 13, "0", "12-13", "3-1", "x"])
def test_parse_months_rejects(spec):
    with pytest.raises(ValueError):
        M.parse_months(spec)


def test_month_span_crosses_years():
    assert M.month_span("2023-11", "2024-02") == [
        date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    with pytest.raises(ValueError):
        M.month_span("2024-02", "2024-01")


def test_bounds_merge_neighbours():
    months = [date(2023, 12, 1), date(2024, 1, 1), date(2024, 4, 1)]
    assert M.month_bounds(months) == [
        (date(2023, 12, 1), date(2024, 2, 1)), (date(2024, 4, 1), date(2024, 5, 1))]


@pytest.mark.parametrize("run, lag, expected", [
    (date(2024, 11, 1), 3, date(2024, 8, 1)),
    (datetime(2024, 4, 15), 3, date(2024, 1, 1)),
    (date(2024, 1, 31), 1, date(2023, 12, 1)),
    (date(2024, 3, 1), 3, date(2023, 12, 1)),
])
def test_target_month(spark, run, lag, expected):
    assert M.target_month(run, lag) == expected
    column = spark.range(1).select(target_month(F.lit(f"{run:%Y-%m-%d}"), lag).alias("m"))
    assert column.first().m == expected

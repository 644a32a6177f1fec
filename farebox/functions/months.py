"""Month arithmetic for job arguments (driver side, a handful of values)."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from ..schema import PUBLICATION_LAG_MONTHS


def _shift(day: date, count: int) -> date:
    total = day.year * 12 + day.month - 1 + count
    return date(total // 12, total % 12 + 1, 1)


def next_month(day: date) -> date:
    return _shift(day, 1)


def parse_month(text: str) -> date:
    """``YYYY-MM`` to the first day of that month."""
    year, month = text.split("-")
    return date(int(year), int(month), 1)


def parse_months(spec: int | str) -> list[int]:
    """``3``, ``"1-3"`` or ``"1,4,7"`` to sorted month numbers."""
    numbers: set[int] = set()
    for part in str(spec).split(","):
        first, _, last = part.partition("-")
        low, high = int(first), int(last or first)
        if low > high:
            raise ValueError(f"month range runs backwards: {spec}")
        numbers.update(range(low, high + 1))
    if min(numbers) < 1 or max(numbers) > 12:
        raise ValueError(f"months must lie between 1 and 12: {spec}")
    return sorted(numbers)


def months_of_year(year: int, spec: int | str) -> list[date]:
    return [date(year, month, 1) for month in parse_months(spec)]


def month_span(first: str | date, last: str | date) -> list[date]:
    """Every month from ``first`` to ``last``, both included."""
    low = parse_month(first) if isinstance(first, str) else first.replace(day=1)
    high = parse_month(last) if isinstance(last, str) else last.replace(day=1)
    if low > high:
        raise ValueError(f"month span runs backwards: {first}..{last}")
    count = (high.year - low.year) * 12 + high.month - low.month + 1
    return [_shift(low, i) for i in range(count)]


def month_bounds(months: Iterable[date]) -> list[tuple[date, date]]:
    """Half-open date ranges covering the months; neighbours are merged into one range."""
    ranges: list[tuple[date, date]] = []
    for month in sorted(set(months)):
        if ranges and ranges[-1][1] == month:
            ranges[-1] = (ranges[-1][0], next_month(month))
        else:
            ranges.append((month, next_month(month)))
    return ranges


def target_month(run: date | datetime, lag: int = PUBLICATION_LAG_MONTHS) -> date:
    """The month a scheduled run should load: files appear ``lag`` months late."""
    return _shift(date(run.year, run.month, 1), -lag)

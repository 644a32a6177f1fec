"""Mergeable sums and counts behind every average and total.

``summarise`` takes either trips or an earlier, finer summary and returns one row per key. Sums
and counts merge, averages do not: this is what lets one pass over the trips, or a small stored
summary per month, feed all views. The full summary holds each month twice, in two *grains*: by hour
and weekday, and by distance; both come from one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalar
from ..schema import MONTH_COLUMN

MEASURES = {
    "fare": "fare_amount",
    "tip": "tip_amount",
    "total": "total_amount",
    "tip_rate": "tip_rate",
    "duration": "trip_duration_min",
    "distance": "trip_distance",
}

#: Finest keys the views of time need: at most 168 rows a month.
SUMMARY_KEYS = (MONTH_COLUMN, "pickup_hour", "pickup_weekday")
#: Key of the view of distances: one row a month for every tenth of a mile that occurs.
DISTANCE_KEY = "distance_bucket"
#: Which of the two a row of the full summary belongs to.
GRAIN, TIME, DISTANCE = "grain", "time", "distance"

_MICRO = 1_000_000


def is_summary(frame: DataFrame) -> bool:
    return "revenue_whole" in frame.columns


def _key(frame: DataFrame, name: str) -> Column:
    if name in frame.columns:
        return F.col(name)
    if name == MONTH_COLUMN:
        return scalar.month_start(F.col("tpep_pickup_datetime")).alias(name)
    if name == DISTANCE_KEY:
        return scalar.distance_bucket(F.col("trip_distance")).alias(name)
    raise ValueError(f"no such key: {name}")


def summarise(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trips or summary rows to one row per combination of ``keys``.

    Tasks aggregate before the shuffle, so what travels is at most one row per key and task, and a
    key that holds most of the trips is no heavier than any other.

    The revenue sum has to come out the same however the rows are split, as it is shown in whole
    units. It is kept as whole units (integers, exact in a double up to 2^53) plus millionths (an
    exact bigint), which costs a tenth of a decimal sum.
    """
    if GRAIN in frame.columns:
        frame = frame.where(F.col(GRAIN) == (DISTANCE if DISTANCE_KEY in keys else TIME))
    return frame.groupBy(*[_key(frame, k) for k in keys]).agg(*_sums(frame))


def _sums(frame: DataFrame) -> list[Column]:
    if is_summary(frame):
        columns = ["trip_count", "revenue_whole", "revenue_micro"]
        columns += [f"{kind}_{m}" for m in MEASURES for kind in ("sum", "n")]
        return [F.sum(c).alias(c) for c in columns]
    total = F.col(MEASURES["total"])
    # NaN for an infinite total, which then stays in the whole part.
    fraction = F.nanvl(total % 1, F.lit(0.0))
    aggregates = [
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(total - fraction).alias("revenue_whole"),
        F.sum(F.rint(fraction * _MICRO).cast("bigint")).alias("revenue_micro"),
    ]
    for name, column in MEASURES.items():
        aggregates += [F.sum(column).alias(f"sum_{name}"), F.count(column).alias(f"n_{name}")]
    return aggregates


def trip_summary(trips: DataFrame) -> DataFrame:
    """The full summary of trips, both grains in one pass of grouping sets."""
    keys = [*SUMMARY_KEYS, DISTANCE_KEY]
    keyed = trips.select(*[_key(trips, k) for k in keys], *MEASURES.values())
    sets = [list(SUMMARY_KEYS), [MONTH_COLUMN, DISTANCE_KEY]]
    rows = keyed.groupingSets(sets, *keys).agg(*_sums(keyed), F.grouping(DISTANCE_KEY).alias("by_time"))
    grain = F.when(F.col("by_time") == 1, TIME).otherwise(DISTANCE)
    return rows.withColumn(GRAIN, grain).drop("by_time")


def merge_sets(summary: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """A full summary grouped by several sets of keys at once; ``view`` names the set of a row.

    Each set belongs to the grain that has its keys; the rows of the other grain are left out of it.
    """
    keys = [*SUMMARY_KEYS, DISTANCE_KEY]
    rows = summary.groupingSets([[GRAIN, *s] for s in sets.values()], GRAIN, *keys).agg(
        *_sums(summary), F.grouping_id().alias("left_out"))
    view = F.lit(None).cast("string")
    for name, own in sets.items():
        left_out = sum(1 << len(keys) - 1 - i for i, k in enumerate(keys) if k not in own)
        grain = DISTANCE if DISTANCE_KEY in own else TIME
        view = F.when((F.col("left_out") == left_out) & (F.col(GRAIN) == grain), name).otherwise(view)
    return rows.withColumn("view", view).where("view is not null")


def mean(measure: str) -> Column:
    return scalar.ratio(F.col(f"sum_{measure}"), F.col(f"n_{measure}"))


def rounded_mean(measure: str, digits: int) -> Column:
    return scalar.round_half_up(mean(measure), digits)


def revenue_per_hour() -> Column:
    """Ratio of the averages, not average of the ratios."""
    return scalar.round_half_up(scalar.ratio(mean("total"), mean("duration")) * 60, 2)


def revenue_per_mile() -> Column:
    return scalar.round_half_up(scalar.ratio(mean("total"), mean("distance")), 2)


def total_revenue() -> Column:
    """Revenue in whole units, rounded half up."""
    shifted = F.col("revenue_micro") + _MICRO // 2
    carried = (shifted - F.pmod(shifted, F.lit(_MICRO))) / _MICRO
    return F.col("revenue_whole") + carried

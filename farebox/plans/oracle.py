"""The same queries as SQL text, for checking against another database."""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendor_id,
         p AS tpep_pickup_datetime,
         p + to_seconds((l_partkey * 13 + l_linenumber * 71) % 12000) AS tpep_dropoff_datetime,
         CAST(CAST(l_quantity AS INTEGER) % 8 AS DOUBLE) AS passenger_count,
         CAST(l_partkey % 300 AS DOUBLE) / 10 AS trip_distance,
         l_extendedprice / 100 AS fare_amount,
         l_extendedprice / 100 * l_discount * 2 AS tip_amount,
         l_extendedprice / 100 * (1 + l_tax) + l_extendedprice / 100 * l_discount * 2 AS total_amount
  FROM (SELECT *, l_shipdate + to_minutes((l_orderkey * 37 + l_linenumber * 211) % 1440) AS p
        FROM lineitem)
)"""


def _round(expression: str, digits: int) -> str:
    """Half up on the decimal value, as the Spark side rounds."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


_SECONDS = "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"
_MINUTES = _round(f"{_SECONDS} / 60", 2)
_HOUR = "CAST(hour(tpep_pickup_datetime) AS INTEGER)"
_WEEKDAY = "dayname(tpep_pickup_datetime)"
_TIP_RATE = _round("tip_amount / NULLIF(fare_amount, 0)", 4)
_AMOUNTS = "trip_distance > 0 AND fare_amount > 0 AND fare_amount <= 1000 AND total_amount > 0"
_PASSENGERS = "passenger_count BETWEEN 1 AND 6"
_DURATION = f"{_MINUTES} BETWEEN 1 AND 180"

_CLEAN = f"""
clean AS (
  SELECT *, {_MINUTES} AS trip_duration_min, {_HOUR} AS pickup_hour,
         {_WEEKDAY} AS pickup_weekday, {_TIP_RATE} AS tip_rate
  FROM raw WHERE {_AMOUNTS} AND {_PASSENGERS} AND {_DURATION}
)"""

_REVENUE = "CAST(ROUND(SUM(CAST(total_amount AS DECIMAL(18, 6))), 0) AS DOUBLE)"
_MONTH = "CAST(date_trunc('month', tpep_pickup_datetime) AS TIMESTAMP)"


def _avg(column: str, digits: int) -> str:
    return _round(f"AVG({column})", digits)


_PER_HOUR = _round("AVG(total_amount) / NULLIF(AVG(trip_duration_min), 0) * 60", 2)
_PER_MILE = _round("AVG(total_amount) / NULLIF(AVG(trip_distance), 0)", 2)

_HOURLY = f"""
hourly AS (
  SELECT {_MONTH} AS month, pickup_hour, pickup_weekday, COUNT(*) AS trip_count,
         {_avg('fare_amount', 2)} AS avg_fare, {_avg('trip_duration_min', 1)} AS avg_duration_min,
         {_avg('tip_rate', 4)} AS avg_tip_rate, {_REVENUE} AS total_revenue
  FROM clean GROUP BY 1, 2, 3
)"""

_BY_WEEKDAY = f"""
weekday AS (
  SELECT pickup_weekday, COUNT(*) AS trip_count,
         {_avg('fare_amount', 2)} AS avg_fare, {_avg('tip_rate', 4)} AS avg_tip_rate
  FROM clean GROUP BY 1
)"""

_MONTHLY = f"""
monthly AS (
  SELECT {_MONTH} AS month, COUNT(*) AS trip_count,
         {_avg('fare_amount', 2)} AS avg_fare, {_REVENUE} AS total_revenue
  FROM clean GROUP BY 1
)"""

_DRIVER = f"""
driver AS (
  SELECT pickup_hour, pickup_weekday, COUNT(*) AS trip_count,
         {_avg('total_amount', 2)} AS avg_revenue, {_avg('tip_amount', 2)} AS avg_tip,
         {_avg('tip_rate', 4)} AS avg_tip_rate,
         {_avg('trip_duration_min', 1)} AS avg_duration_min,
         {_avg('trip_distance', 2)} AS avg_distance,
         {_PER_HOUR} AS revenue_per_hour, {_PER_MILE} AS revenue_per_mile
  FROM clean GROUP BY 1, 2
)"""

_BY_WEEKDAY_REVENUE = f"""
weekday_revenue AS (
  SELECT pickup_weekday, COUNT(*) AS trip_count,
         {_avg('total_amount', 2)} AS avg_revenue, {_avg('tip_rate', 4)} AS avg_tip_rate
  FROM clean GROUP BY 1
)"""

_LEDGER = """
ledger AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS id,
         CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS rows_loaded,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 100 AS DOUBLE) END AS duration_sec,
         o_orderdate AS created_at
  FROM orders
)"""

_LAST_RUN = """
last_run AS (
  SELECT id, status, created_at,
         date_diff('second', created_at, (SELECT max(created_at) FROM ledger)) / 3600 AS hours_ago,
         status = 'success' AS passed
  FROM ledger ORDER BY created_at DESC, id DESC LIMIT 1
)"""

_FRESH = """
fresh AS (
  SELECT 'fresh_rows' AS check_name, CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) > 0 AS passed
  FROM {table} WHERE {column} >= (SELECT max({column}) FROM {table}) - INTERVAL 48 HOUR
)"""

_NULL_SHARE = "100.0 * COUNT(*) FILTER (WHERE fare_amount IS NULL) / NULLIF(COUNT(*), 0)"
_NULL_RATE = f"""
null_rate AS (
  SELECT 'null_fare_percent' AS check_name, v AS value, v < 1 AS passed FROM (
    SELECT coalesce({_round(_NULL_SHARE, 2)}, 0) AS v FROM raw)
)"""

_AVG_FARE = f"""
avg_fare AS (
  SELECT 'average_fare' AS check_name, v AS value, v BETWEEN 5 AND 100 AS passed FROM (
    SELECT coalesce({_avg('fare_amount', 2)}, 0) AS v FROM raw)
)"""

_HEALTH = f"""
health AS (
  SELECT * FROM fresh UNION ALL SELECT * FROM null_rate UNION ALL SELECT * FROM avg_fare
  UNION ALL SELECT 'last_run', hours_ago, passed FROM last_run
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_R = _with(_RAW)
_C = _with(_RAW, _CLEAN)
_FRESH_TRIPS = _FRESH.format(table="raw", column="tpep_pickup_datetime")
_HEALTH_CTES = _with(_RAW, _LEDGER, _LAST_RUN, _FRESH_TRIPS, _NULL_RATE, _AVG_FARE, _HEALTH)

_COLUMNS = """vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
  trip_distance, fare_amount, tip_amount, total_amount"""
_CLEAN_COLUMNS = f"{_COLUMNS}, trip_duration_min, pickup_hour, pickup_weekday, tip_rate"
_CONTEXT = "tpep_pickup_datetime, tpep_dropoff_datetime, fare_amount, tip_amount"
_IN_MARCH = """tpep_pickup_datetime >= TIMESTAMP '1998-03-01'
  AND tpep_pickup_datetime < TIMESTAMP '1998-04-01'"""

_COVERAGE = """
requested AS (
  SELECT CAST(unnest(generate_series(
    date_trunc('month', (SELECT min(tpep_pickup_datetime) FROM raw)),
    make_timestamp(year((SELECT max(tpep_pickup_datetime) FROM raw)), 12, 1, 0, 0, 0),
    INTERVAL 1 MONTH)) AS TIMESTAMP) AS month
),
loaded AS (
  SELECT DISTINCT CAST(date_trunc('month', tpep_pickup_datetime) AS TIMESTAMP) AS month FROM raw
)"""

_RULES = {
    "bad_distance": "trip_distance > 0",
    "bad_fare_low": "fare_amount > 0",
    "bad_fare_high": "fare_amount <= 1000",
    "bad_total": "total_amount > 0",
    "bad_passengers": _PASSENGERS,
    "bad_duration_short": f"{_MINUTES} >= 1",
    "bad_duration_long": f"{_MINUTES} <= 180",
}
_BROKEN = " + ".join(
    f"CASE WHEN coalesce({rule}, FALSE) THEN 0 ELSE {1 << k} END" for k, rule in enumerate(_RULES.values()))
_VIOLATIONS = ", ".join(
    f"CASE WHEN broken & {1 << k} <> 0 THEN '{name}' END" for k, name in enumerate([*_RULES, "foreign_month"]))
_REJECTED = ",\n  ".join(
    f"COUNT(*) FILTER (WHERE NOT coalesce({rule}, FALSE)) AS {name}" for name, rule in _RULES.items()
)

_DISTANCES = f"""
distances AS (
  SELECT {_avg('trip_distance', 1)} AS avg_distance, COUNT(*) AS trip_count,
         {_avg('total_amount', 2)} AS avg_revenue, {_avg('tip_rate', 4)} AS avg_tip_rate,
         {_avg('trip_duration_min', 1)} AS avg_duration_min, {_PER_HOUR} AS revenue_per_hour
  FROM clean GROUP BY ROUND(CAST(trip_distance AS DECIMAL(38, 10)), 1)
)"""


def _monthly_change(rows: str) -> str:
    """Change against the calendar month before, over all months from the first to the last."""
    return f"""{_with(_RAW, _CLEAN, _MONTHLY)}, held AS ({rows}),
        months AS (SELECT CAST(unnest(generate_series(
          (SELECT min(month) FROM held), (SELECT max(month) FROM held), INTERVAL 1 MONTH)) AS TIMESTAMP) AS month)
        SELECT month, total_revenue,
               {_round('(total_revenue / lag(total_revenue) OVER (ORDER BY month) - 1) * 100', 2)} AS change_pct
        FROM months LEFT JOIN held USING (month)"""


_GATE = f"""
SELECT month_rows, bad_fares, month_rows > 0 AND bad_fares = 0 AS passed FROM (
  SELECT COUNT(*) FILTER (WHERE {_IN_MARCH}) AS month_rows,
         COUNT(*) FILTER (WHERE fare_amount <= 0 OR fare_amount > 1000) AS bad_fares
  FROM {{source}})"""


def _derived(expression: str, name: str) -> str:
    return f"{_R} SELECT {_CONTEXT}, {expression} AS {name} FROM raw"


def oracle_sql() -> dict[str, str]:
    hours = ",\n  ".join(
        f"MAX(CASE WHEN pickup_hour = {h} THEN avg_revenue END) AS hour_{h:02d}" for h in range(24)
    )
    return {
        "scan_pruned": f"{_R} SELECT vendor_id AS vendorid, {_COLUMNS.split(',', 1)[1]} FROM raw",
        "scan_multi_month": f"{_R} SELECT {_COLUMNS} FROM raw",
        "raw_row_count": "SELECT COUNT(*) AS raw_rows FROM lineitem",
        "arrow_partition_counts": f"{_C} SELECT COUNT(*) AS rows FROM clean",
        "schema_gate": f"""{_R} SELECT date_trunc('month', tpep_pickup_datetime) AS month,
            COUNT(*) AS trip_count, CAST(SUM(vendor_id) AS BIGINT) AS vendors,
            COUNT(passenger_count) AS passenger_counts FROM raw GROUP BY 1""",
        "delete_month_range": f"""{_C} SELECT {_CLEAN_COLUMNS} FROM clean
            WHERE NOT (tpep_pickup_datetime >= TIMESTAMP '1997-01-01'
                       AND tpep_pickup_datetime < TIMESTAMP '1997-07-01')""",
        "replace_month": f"""{_C} SELECT {_CLEAN_COLUMNS} FROM (
            SELECT * REPLACE (CAST(CASE WHEN {_IN_MARCH} THEN vendor_id + 10 ELSE vendor_id END
                                   AS INTEGER) AS vendor_id)
            FROM clean)""",
        "month_coverage": f"""{_with(_RAW, _COVERAGE)}
            SELECT month, month IN (SELECT month FROM loaded) AS loaded FROM requested""",
        "missing_months": f"""{_with(_RAW, _COVERAGE)}
            SELECT month FROM requested WHERE month NOT IN (SELECT month FROM loaded)""",
        "target_month": """SELECT o_orderkey, o_orderdate,
            CAST(date_trunc('month', o_orderdate - INTERVAL 3 MONTH) AS TIMESTAMP) AS target_month
            FROM orders""",
        "trip_duration": _derived(_MINUTES, "trip_duration_min"),
        "pickup_hour": _derived(_HOUR, "pickup_hour"),
        "pickup_weekday": _derived(_WEEKDAY, "pickup_weekday"),
        "tip_rate": _derived(_TIP_RATE, "tip_rate"),
        "filter_month_set": f"""{_R} SELECT {_COLUMNS} FROM raw
            WHERE year(tpep_pickup_datetime) = 1997 AND month(tpep_pickup_datetime) IN (1, 2, 3)""",
        "filter_amounts": f"{_R} SELECT {_COLUMNS} FROM raw WHERE {_AMOUNTS}",
        "filter_passengers": f"{_R} SELECT {_COLUMNS} FROM raw WHERE {_PASSENGERS}",
        "filter_duration": f"{_R} SELECT {_COLUMNS} FROM raw WHERE {_DURATION}",
        "clean_trips": f"{_C} SELECT {_CLEAN_COLUMNS} FROM clean",
        "cleaning_report": f"""{_R} SELECT COUNT(*) AS raw_rows, {_REJECTED},
            COUNT(*) FILTER (WHERE {_AMOUNTS} AND {_PASSENGERS} AND {_DURATION}) AS clean_rows
            FROM raw""",
        "quarantine": f"""{_R} SELECT * FROM (
            SELECT {_COLUMNS}, {_MINUTES} AS trip_duration_min, {_HOUR} AS pickup_hour,
                   {_WEEKDAY} AS pickup_weekday, {_TIP_RATE} AS tip_rate, CAST({_BROKEN} AS INTEGER) AS broken
            FROM raw) WHERE broken <> 0""",
        "violation_counts": f"""{_R} SELECT month, broken, concat_ws(',', {_VIOLATIONS}) AS violations,
            COUNT(*) AS rejected FROM (
              SELECT {_MONTH} AS month, CAST({_BROKEN}
                + CASE WHEN month(tpep_pickup_datetime) % 2 = 0 THEN 0 ELSE 128 END AS INTEGER) AS broken
              FROM raw) WHERE broken <> 0 GROUP BY ALL""",
        "all_views": f"""{_with(_RAW, _CLEAN, _HOURLY, _BY_WEEKDAY, _MONTHLY, _DRIVER, _DISTANCES)}
            SELECT * REPLACE (CAST(pickup_hour AS DOUBLE) AS pickup_hour) FROM (
            SELECT 'v_hourly_stats' AS view, * FROM hourly
            UNION ALL BY NAME SELECT 'v_weekday_stats' AS view, * FROM weekday
            UNION ALL BY NAME SELECT 'v_monthly_trend' AS view, * FROM monthly
            UNION ALL BY NAME SELECT 'v_driver_revenue' AS view, * FROM driver
            UNION ALL BY NAME SELECT 'v_distance_revenue' AS view, * FROM distances)""",
        "footer_checks": """SELECT COUNT(*) AS all_rows,
            COUNT(*) FILTER (WHERE l_extendedprice <= 0 OR l_extendedprice > 100000) AS bad_prices,
            COUNT(*) FILTER (WHERE l_extendedprice IS NULL) AS null_prices,
            COUNT(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-06-01') AS late_rows FROM lineitem""",
        "hourly_stats": f"{_with(_RAW, _CLEAN, _HOURLY)} SELECT * FROM hourly ORDER BY 1, 2, 3",
        "weekday_stats": f"{_with(_RAW, _CLEAN, _BY_WEEKDAY)} SELECT * FROM weekday",
        "monthly_trend": f"{_with(_RAW, _CLEAN, _MONTHLY)} SELECT * FROM monthly ORDER BY 1",
        "driver_revenue": f"{_with(_RAW, _CLEAN, _DRIVER)} SELECT * FROM driver",
        "distance_revenue": f"""{_C} SELECT {_avg('trip_distance', 1)} AS avg_distance,
            COUNT(*) AS trip_count, {_avg('total_amount', 2)} AS avg_revenue,
            {_avg('tip_rate', 4)} AS avg_tip_rate,
            {_avg('trip_duration_min', 1)} AS avg_duration_min, {_PER_HOUR} AS revenue_per_hour
            FROM clean GROUP BY ROUND(CAST(trip_distance AS DECIMAL(38, 10)), 1)""",
        "month_row_count": f"{_C} SELECT COUNT(*) AS month_rows FROM clean WHERE {_IN_MARCH}",
        "quality_gate": _C + _GATE.format(source="clean"),
        "quality_gate_raw": _R + _GATE.format(source="raw"),
        "health_freshness": f"{_with(_FRESH.format(table='events', column='ts'))} SELECT * FROM fresh",
        "health_null_rate": f"{_with(_RAW, _NULL_RATE)} SELECT * FROM null_rate",
        "health_avg_fare": f"{_with(_RAW, _AVG_FARE)} SELECT * FROM avg_fare",
        "health_last_run": f"{_with(_LEDGER, _LAST_RUN)} SELECT * FROM last_run",
        "health_report": f"{_HEALTH_CTES} SELECT * FROM health",
        "health_summary": f"""{_HEALTH_CTES} SELECT bool_and(passed) AS all_passed,
            COUNT(*) FILTER (WHERE NOT passed) AS failed_checks FROM health""",
        "run_ledger_summary": f"""{_with(_LEDGER)} SELECT status, COUNT(*) AS runs,
            CAST(coalesce(SUM(rows_loaded), 0) AS BIGINT) AS rows_loaded, SUM(duration_sec) AS duration_sec,
            {_avg('duration_sec', 2)} AS avg_duration_sec, MAX(created_at) AS last_run
            FROM ledger GROUP BY status""",
        "hourly_month_join": f"""{_with(_RAW, _CLEAN, _HOURLY, _MONTHLY)}
            SELECT h.*, m.trip_count AS month_trip_count, m.avg_fare AS month_avg_fare,
                   m.total_revenue AS month_total_revenue
            FROM hourly h LEFT JOIN monthly m ON h.month = m.month""",
        "hourly_weekday_join": f"""{_with(_RAW, _CLEAN, _HOURLY, _BY_WEEKDAY)}
            SELECT h.*, w.trip_count AS weekday_trip_count, w.avg_fare AS weekday_avg_fare,
                   w.avg_tip_rate AS weekday_avg_tip_rate
            FROM hourly h LEFT JOIN weekday w ON h.pickup_weekday = w.pickup_weekday""",
        "hourly_month_literal_join": f"""{_with(_RAW, _CLEAN, _HOURLY, _MONTHLY)}
            SELECT h.*, m.avg_fare AS month_avg_fare, m.total_revenue AS month_total_revenue
            FROM hourly h
            LEFT JOIN monthly m ON h.trip_count = m.trip_count AND h.month = m.month""",
        "hourly_weekday_literal_join": f"""{_with(_RAW, _CLEAN, _HOURLY, _BY_WEEKDAY)}
            SELECT h.*, w.pickup_weekday AS weekday_pickup_weekday, w.avg_fare AS weekday_avg_fare,
                   w.avg_tip_rate AS weekday_avg_tip_rate
            FROM hourly h LEFT JOIN weekday w ON h.trip_count = w.trip_count""",
        "hourly_detail": f"{_with(_RAW, _CLEAN, _HOURLY)} SELECT pickup_hour, trip_count FROM hourly",
        "hour_month_fare": f"""{_with(_RAW, _CLEAN, _HOURLY)} SELECT pickup_hour, month,
            CAST(SUM(CAST(avg_fare AS DECIMAL(18, 2))) AS DOUBLE) AS sum_avg_fare
            FROM hourly GROUP BY 1, 2""",
        "weekday_trips": f"{_C} SELECT pickup_weekday, COUNT(*) AS trip_count FROM clean GROUP BY 1",
        "month_of_year_revenue": f"""{_with(_RAW, _CLEAN, _MONTHLY)}
            SELECT CAST(month(month) AS INTEGER) AS month_of_year, SUM(total_revenue) AS total_revenue
            FROM monthly GROUP BY 1""",
        "golden_hour_heatmap": f"""{_with(_RAW, _CLEAN, _DRIVER)} SELECT pickup_weekday,
            {hours} FROM driver GROUP BY 1""",
        "hour_tip_volume": f"""{_C} SELECT pickup_hour, COUNT(*) AS trip_count,
            {_avg('tip_rate', 4)} AS avg_tip_rate FROM clean GROUP BY 1""",
        "weekday_revenue": f"""{_with(_RAW, _CLEAN, _BY_WEEKDAY_REVENUE)}
            SELECT * FROM weekday_revenue""",
        "weekpart_revenue": f"""{_C},
            parts AS (
              SELECT CASE WHEN pickup_weekday IN ('Saturday', 'Sunday') THEN 'weekend'
                          WHEN pickup_weekday = 'Friday' THEN 'friday' ELSE 'mon_thu' END AS weekpart,
                     COUNT(*) AS trip_count, AVG(total_amount) AS revenue, AVG(tip_rate) AS rate
              FROM clean GROUP BY 1)
            SELECT weekpart, trip_count, {_round('revenue', 2)} AS avg_revenue,
                   {_round('rate', 4)} AS avg_tip_rate,
                   {_round("(revenue / (SELECT revenue FROM parts WHERE weekpart = 'weekend') - 1) * 100", 2)}
                     AS vs_weekend_pct
            FROM parts""",
        "weekday_tip_corr": f"""{_with(_RAW, _CLEAN, _BY_WEEKDAY_REVENUE)}
            SELECT {_round('corr(avg_revenue, avg_tip_rate)', 6)} AS revenue_tip_corr
            FROM weekday_revenue""",
        "revenue_mom": _monthly_change("SELECT * FROM monthly"),
        "revenue_mom_gaps": _monthly_change("""SELECT * FROM monthly
            WHERE NOT (month >= TIMESTAMP '1997-01-01' AND month < TIMESTAMP '1997-07-01')"""),
        "best_hour_per_weekday": f"""{_with(_RAW, _CLEAN, _DRIVER)}
            SELECT pickup_weekday, pickup_hour, revenue_per_hour, trip_count FROM (
              SELECT *, row_number() OVER (PARTITION BY pickup_weekday
                ORDER BY revenue_per_hour DESC NULLS LAST, pickup_hour) AS r FROM driver)
            WHERE r = 1""",
        "top_revenue_slots": f"""{_with(_RAW, _CLEAN, _DRIVER)}
            SELECT pickup_hour, pickup_weekday, trip_count, avg_revenue, revenue_per_hour
            FROM driver ORDER BY revenue_per_hour DESC NULLS LAST, pickup_hour, pickup_weekday
            LIMIT 10""",
    }

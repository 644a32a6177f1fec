"""Column lists, types and cleaning limits shared by every module."""

from pyspark.sql import types as T

# --- Fixed values: names, types and limits that results depend on. ---

# Columns read from a raw month file (names are matched without regard to case).
RAW_COLUMNS = (
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "fare_amount", "tip_amount", "total_amount",
)

# Columns of a cleaned trip, in table order.
TABLE_COLUMNS = (
    "vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "fare_amount", "tip_amount", "total_amount",
    "trip_duration_min", "pickup_hour", "pickup_weekday", "tip_rate",
)

# Inclusive unless said otherwise.
MIN_PASSENGERS, MAX_PASSENGERS = 1, 6
MAX_FARE = 1000                      # the lower bound 0 is exclusive
MIN_MINUTES, MAX_MINUTES = 1, 180

# Health limits.
FRESH_HOURS = 48
MAX_NULL_PERCENT = 1.0               # exclusive
MIN_AVG_FARE, MAX_AVG_FARE = 5.0, 100.0
PUBLICATION_LAG_MONTHS = 3

WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

TRIP_TABLE = "clean_taxi_trips"
LEDGER_TABLE = "pipeline_runs"

# --- End of fixed values. ---

#: Partition column of the stored trip table: first day of the pickup month.
MONTH_COLUMN = "pickup_month"

_FIELD_TYPES = {
    "vendor_id": T.IntegerType(),
    "tpep_pickup_datetime": T.TimestampNTZType(),
    "tpep_dropoff_datetime": T.TimestampNTZType(),
    "pickup_hour": T.IntegerType(),
    "pickup_weekday": T.StringType(),
}

#: A raw month after type and name normalisation.
TRIP_SCHEMA = T.StructType([
    T.StructField(name, _FIELD_TYPES.get(name, T.DoubleType()))
    for name in ("vendor_id", *RAW_COLUMNS[1:])
])

#: The stored trip table. Timestamps are checked for NULL when written (see sources.tables).
TABLE_SCHEMA = T.StructType(
    [T.StructField(name, _FIELD_TYPES.get(name, T.DoubleType())) for name in TABLE_COLUMNS]
    + [T.StructField("loaded_at", T.TimestampNTZType()), T.StructField(MONTH_COLUMN, T.DateType())]
)

#: Ledger status of a month taken out of the table; such a row is no run.
DELETED = "deleted"

#: One row per month and load. ``rows_loaded`` is 64-bit: a month may pass 2^31 rows.
LEDGER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

"""Small raw month files for the tests."""

import contextlib
import io
import os
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq


def month_file(folder, month: date, rows=5, variant="A", part=False, strays=(), drop=(), fare=10.0):
    """One month file, or a part file in a month directory.

    Variant A has mixed-case names and bigint counts, variant B lower-case names, int vendors and
    double counts. Each file also has a column nobody needs.
    """
    start = datetime(month.year, month.month, 1, 8)
    pickups = [start + timedelta(minutes=i) for i in range(rows)] + list(strays)
    n = len(pickups)
    stamp = pa.timestamp("us")
    upper = variant == "A"
    table = {
        "VendorID" if upper else "vendorid": pa.array([1] * n, pa.int64() if upper else pa.int32()),
        "tpep_pickup_datetime": pa.array(pickups, stamp),
        "tpep_dropoff_datetime": pa.array([p + timedelta(minutes=10) for p in pickups], stamp),
        "passenger_count": pa.array([2] * n, pa.int64() if upper else pa.float64()),
        "trip_distance": pa.array([2.5] * n, pa.float64()),
        "fare_amount": pa.array([fare] * n, pa.float64()),
        "tip_amount": pa.array([2.0] * n, pa.float64()),
        "total_amount": pa.array([fare + 2.5] * n, pa.float64()),
        "extra_column": pa.array(["x"] * n),
    }
    for name in drop:
        del table[name]
    path = f"{folder}/trips_{month:%Y-%m}.parquet"
    if part:
        path = f"{path}/part-{part}.parquet"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(table), path)
    return path


def explained(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()

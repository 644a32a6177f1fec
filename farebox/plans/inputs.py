"""Trips, ledger and run dates derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as raw trips, with the normalised names and types."""
    c = F.col
    waited = (c("l_orderkey") * 37 + c("l_linenumber") * 211) % 1440 * F.expr("INTERVAL '1' MINUTE")
    driven = (c("l_partkey") * 13 + c("l_linenumber") * 71) % 12000 * F.expr("INTERVAL '1' SECOND")
    fare = c("l_extendedprice") / 100
    return (
        table(spark, folder, "lineitem")
        .withColumns({
            "tpep_pickup_datetime": c("l_shipdate") + waited,
            "tip_amount": fare * c("l_discount") * 2,
        })
        .select(
            (c("l_suppkey") % 2 + 1).cast("int").alias("vendor_id"),
            "tpep_pickup_datetime",
            (c("tpep_pickup_datetime") + driven).alias("tpep_dropoff_datetime"),
            (c("l_quantity").cast("int") % 8).cast("double").alias("passenger_count"),
            ((c("l_partkey") % 300).cast("double") / 10).alias("trip_distance"),
            fare.alias("fare_amount"),
            "tip_amount",
            (fare * (1 + c("l_tax")) + c("tip_amount")).alias("total_amount"),
        )
    )


def drifted_months(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The raw trips as two families of month files would hold them.

    Odd months have mixed-case names and bigint counts, even months lower-case names and double
    counts.
    """
    raw = trips(spark, folder)
    odd = F.month("tpep_pickup_datetime") % 2 == 1
    first = raw.where(odd).select(
        F.col("vendor_id").cast("bigint").alias("VendorID"),
        "tpep_pickup_datetime", "tpep_dropoff_datetime",
        F.col("passenger_count").cast("bigint").alias("Passenger_Count"),
        F.col("trip_distance").alias("Trip_Distance"),
        "fare_amount", "tip_amount", "total_amount",
    )
    second = raw.where(~odd).withColumnRenamed("vendor_id", "vendorid")
    return [first, second]


def loaded_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips with a load time, which here is the pickup time."""
    return trips(spark, folder).withColumn("loaded_at", F.col("tpep_pickup_datetime"))


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as ledger rows; pending orders are failed runs."""
    failed = F.col("o_orderstatus") == "P"
    return table(spark, folder, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 20, "0").alias("id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.when(~failed, F.floor("o_totalprice")).alias("rows_loaded"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("priority "), F.col("o_orderpriority"))).alias("error_msg"),
        F.when(~failed, (F.col("o_custkey") % 100).cast("double")).alias("duration_sec"),
        F.col("o_orderdate").alias("created_at"),
    )

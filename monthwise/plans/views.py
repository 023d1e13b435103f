"""Trip-shaped views of the driver's TPC-H-like tables.

The engine loads monthly trip files; the test data is TPC-H-like.  These
views rename table columns to raw trip column names (see FIXTURES.md) so the
real load path runs over the given tables and grows with them.  Columns
without a source stay absent, which exercises the null-fill of ``conform``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions.calendar import month_start
from monthwise.session import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def lineitem_trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_linenumber").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_extendedprice").alias("airport_fee"),
        month_start("l_shipdate").alias("date"),
    )


def orders_trips_raw(spark: SparkSession, sf_dir: str, with_date: bool = True) -> DataFrame:
    """Orders as trips: one month file per order month; ``PULocationID``
    carries the unique order key."""
    o = table(spark, sf_dir, "orders")
    cols = [
        F.col("o_custkey").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("o_orderstatus").alias("store_and_fwd_flag"),
        F.col("o_orderkey").alias("PULocationID"),
        F.col("o_totalprice").alias("fare_amount"),
        F.col("o_totalprice").alias("total_amount"),
    ]
    if with_date:
        cols.append(month_start("o_orderdate").alias("date"))
    return o.select(*cols)


# Oracle SQL (DuckDB) for the same views after conform, timestamps as
# TIMESTAMP (no zone) like the NTZ contract.
LINEITEM_TRIPS_SQL = """
SELECT CAST(l_suppkey AS BIGINT) AS vendor_id,
       CAST(l_shipdate AS TIMESTAMP) AS tpep_pickup_datetime,
       CAST(NULL AS TIMESTAMP) AS tpep_dropoff_datetime,
       CAST(l_linenumber AS DOUBLE) AS passenger_count,
       CAST(l_quantity AS DOUBLE) AS trip_distance,
       CAST(l_linenumber AS DOUBLE) AS ratecode_id,
       CAST(l_returnflag AS VARCHAR) AS store_and_fwd_flag,
       CAST(l_partkey AS BIGINT) AS pu_location_id,
       CAST(NULL AS BIGINT) AS do_location_id,
       CAST(l_linenumber AS BIGINT) AS payment_type,
       CAST(l_extendedprice AS DOUBLE) AS fare_amount,
       CAST(l_discount AS DOUBLE) AS extra,
       CAST(l_tax AS DOUBLE) AS mta_tax,
       CAST(NULL AS DOUBLE) AS tip_amount,
       CAST(NULL AS DOUBLE) AS tolls_amount,
       CAST(NULL AS DOUBLE) AS improvement_surcharge,
       CAST(NULL AS DOUBLE) AS total_amount,
       CAST(NULL AS DOUBLE) AS congestion_surcharge,
       TRY_CAST(trunc(l_extendedprice) AS INTEGER) AS airport_fee,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date
FROM lineitem
"""

ORDERS_TRIPS_SQL = """
SELECT CAST(o_custkey AS BIGINT) AS vendor_id,
       CAST(o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
       CAST(NULL AS TIMESTAMP) AS tpep_dropoff_datetime,
       CAST(NULL AS DOUBLE) AS passenger_count,
       CAST(NULL AS DOUBLE) AS trip_distance,
       CAST(NULL AS DOUBLE) AS ratecode_id,
       CAST(o_orderstatus AS VARCHAR) AS store_and_fwd_flag,
       CAST(o_orderkey AS BIGINT) AS pu_location_id,
       CAST(NULL AS BIGINT) AS do_location_id,
       CAST(NULL AS BIGINT) AS payment_type,
       CAST(o_totalprice AS DOUBLE) AS fare_amount,
       CAST(NULL AS DOUBLE) AS extra,
       CAST(NULL AS DOUBLE) AS mta_tax,
       CAST(NULL AS DOUBLE) AS tip_amount,
       CAST(NULL AS DOUBLE) AS tolls_amount,
       CAST(NULL AS DOUBLE) AS improvement_surcharge,
       CAST(o_totalprice AS DOUBLE) AS total_amount,
       CAST(NULL AS DOUBLE) AS congestion_surcharge,
       CAST(NULL AS INTEGER) AS airport_fee,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS date
FROM orders
"""

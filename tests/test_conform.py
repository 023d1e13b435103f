"""Conform: the reference's two schema cases, then values per cast and per
missing column."""

import datetime as dt
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.contract import TRIP_CONTRACT, schema_signature
from monthwise.functions.conform import AmbiguousColumnError, column_or_null, conform
from monthwise.plans.views import lineitem_trips_raw

from .conftest import SF_SMALL

EXPECTED = T.StructType(
    [
        T.StructField("vendor_id", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("ratecode_id", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("pu_location_id", T.LongType()),
        T.StructField("do_location_id", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.IntegerType()),
        T.StructField("date", T.DateType()),
    ]
)


def test_month_file_conforms_to_contract(spark):
    raw = lineitem_trips_raw(spark, SF_SMALL).drop("date").withColumn(
        "date", F.to_date(F.lit("2020-02-03"), "yyyy-MM-dd")
    )
    out = conform(raw)
    assert schema_signature(out.schema) == schema_signature(EXPECTED)
    assert out.count() == raw.count()
    assert {r.date for r in out.select("date").distinct().collect()} == {dt.date(2020, 2, 3)}


def test_frame_without_known_columns_conforms(spark):
    schema = T.StructType(
        [
            T.StructField("column1", T.StringType()),
            T.StructField("column2", T.StringType()),
            T.StructField("date", T.DateType()),
        ]
    )
    out = conform(spark.createDataFrame([], schema))
    assert schema_signature(out.schema) == schema_signature(EXPECTED)
    assert out.count() == 0


def test_contract_schema_is_expected():
    assert schema_signature(TRIP_CONTRACT.schema) == schema_signature(EXPECTED)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_bad_value_to_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        s = spark.createDataFrame(
            [("abc",), ("12",), (None,)], "v string"
        )
        got = [r[0] for r in s.select(column_or_null(s, "v", T.LongType())).collect()]
        assert got == [None, 12, None]
        d = spark.createDataFrame([(1e12,), (float("nan"),), (-2.7,), (2.5,), (None,)], "v double")
        ints = [r[0] for r in d.select(column_or_null(d, "v", T.IntegerType())).collect()]
        assert ints == [None, None, -2, 2, None]
        longs = [r[0] for r in d.select(column_or_null(d, "v", T.LongType())).collect()]
        assert longs[0] == 1000000000000 and longs[2:] == [-2, 2, None]
        dbl = [r[0] for r in s.select(column_or_null(s, "v", T.DoubleType())).collect()]
        assert dbl == [None, 12.0, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_nan_double_stays_nan(spark):
    d = spark.createDataFrame([(float("nan"),)], "v double")
    assert math.isnan(d.select(column_or_null(d, "v", T.DoubleType())).first()[0])


def test_case_variant_counts_as_missing(spark):
    df = spark.createDataFrame([(7, dt.date(2020, 1, 1))], "vendorid long, date date")
    assert conform(df).first().vendor_id is None


def test_case_twins_raise_clear_error(spark):
    spark.conf.set("spark.sql.caseSensitive", "false")
    df = spark.createDataFrame([(1, 2, dt.date(2020, 1, 1))], "VendorID long, vendorid long, date date")
    with pytest.raises(AmbiguousColumnError):
        conform(df)


def test_case_twins_ok_when_case_sensitive(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([(1, 2, dt.date(2020, 1, 1))], "VendorID long, vendorid long, date date")
        assert conform(df).first().vendor_id == 1
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_extra_column_dropped_and_missing_date_fails(spark):
    df = spark.createDataFrame([(1, "x", dt.date(2020, 1, 1))], "VendorID long, junk string, date date")
    assert "junk" not in conform(df).columns
    with pytest.raises(AnalysisException):
        conform(spark.createDataFrame([(1,)], "VendorID long")).schema


def test_fee_fraction_is_cut(spark):
    df = spark.createDataFrame([(2.99, dt.date(2020, 1, 1)), (-2.7, dt.date(2020, 1, 1))], "airport_fee double, date date")
    assert [r.airport_fee for r in conform(df).collect()] == [2, -2]


def test_conform_plan_is_one_projection_and_count_reads_no_columns(spark):
    out = conform(lineitem_trips_raw(spark, SF_SMALL))
    plan = out.groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan or "ReadSchema: struct<l_shipdate" in plan

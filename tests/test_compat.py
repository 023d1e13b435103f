"""The reference's helper names: the two schema cases of its own test,
column-or-null, database creation, and the file-order sampler."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.compat import get_create_schema, minimize_parquet, select_or_null, set_schema
from monthwise.contract import TRIP_CONTRACT, schema_diff
from monthwise.plans.views import lineitem_trips_raw

from .conftest import SF_SMALL


def test_set_schema_reference_cases(spark):
    # a month file plus a run date unrelated to its month
    raw = lineitem_trips_raw(spark, SF_SMALL).drop("date").withColumn("date", F.to_date(F.lit("2020-02-03")))
    assert not schema_diff(set_schema(raw).schema, TRIP_CONTRACT.schema)
    # an empty frame with unrelated columns and a date
    empty = spark.createDataFrame([], "column1 string, column2 string, date date")
    assert not schema_diff(set_schema(empty).schema, TRIP_CONTRACT.schema)


def test_select_or_null(spark):
    df = spark.createDataFrame([(1,)], "VendorID long")
    row = df.select(select_or_null(df, "VendorID"), select_or_null(df, "vendorid")).first()
    assert tuple(row) == (1, None) and df.select(select_or_null(df, "x")).columns == ["x"]


def test_get_create_schema_runs(spark):
    db = f"c_{uuid.uuid4().hex[:8]}"
    spark.sql(get_create_schema(db))
    spark.sql(get_create_schema(db))  # idempotent
    assert spark.catalog.databaseExists(db)


def test_minimize_parquet_keeps_file_order(spark, scratch):
    src, out = scratch("src"), scratch("head")
    # rows stored in descending key order: file order is not key order
    spark.range(500).select((F.lit(1000) - F.col("id")).alias("k")).coalesce(1).write.parquet(src)
    minimize_parquet(spark, src, out, 7)
    got = [r.k for r in spark.read.parquet(out).collect()]
    assert sorted(got, reverse=True) == [1000, 999, 998, 997, 996, 995, 994]
    assert spark.read.parquet(out).schema == T.StructType([T.StructField("k", T.LongType(), True)])

"""split_row_number equals the plain window on skewed groups."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from monthwise.operators.sequence import split_row_number


def test_matches_window_on_skewed_groups(spark):
    df = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 11).alias("h"),
    )
    got = split_row_number(df, ["g", "h"], ["id"], out="rn", partitions=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g", "h").orderBy("id")).cast("long"))
    assert got.count() == df.count()
    assert got.select("id", "g", "h", "rn").exceptAll(want.select("id", "g", "h", "rn")).count() == 0

"""Small public helpers: gate summary, landing path, schema match,
partition recovery of the catalog table."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT, schema_diff
from monthwise.functions.calendar import landing_path
from monthwise.operators.checks import gate_summary, month_gates


def test_gate_summary_counts_out_of_range_and_nulls(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 1), (dt.date(2020, 1, 1), None), (dt.date(2020, 2, 1), 2), (None, 3)],
        "date date, v int",
    )
    gates = month_gates(df, "date", ["v"])
    months = spark.createDataFrame([(dt.date(2020, 1, 1),)], "date date")
    r = gate_summary(gates, months).first()
    assert (r.rows_in_range, r.out_of_range, r.null_v) == (2, 2, 1)
    r = gate_summary(gates, None).first()  # every non-null month counts as requested
    assert (r.rows_in_range, r.out_of_range, r.null_v) == (3, 1, 1)


def test_landing_path(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 1),)], "m date")
    assert df.select(landing_path("m", "/land/")).first()[0] == "/land/yellow_tripdata_2020_03.parquet"


def test_schema_diff_ignores_nullability(spark):
    a = TRIP_CONTRACT.schema
    b = spark.createDataFrame([], TRIP_CONTRACT.schema).select(
        *[F.col(c) for c in TRIP_CONTRACT.names[:-1]], F.lit(dt.date(2020, 1, 1)).alias("date")
    ).schema
    assert not schema_diff(a, b)
    assert schema_diff(a, TRIP_CONTRACT.with_timestamp_ntz().schema)


def test_recover_months_registers_folders(spark, scratch):
    from monthwise.plans import catalog
    from monthwise.plans.load import publish_months

    C = TRIP_CONTRACT.with_timestamp_ntz()
    root = scratch("recover")
    db = f"r_{uuid.uuid4().hex[:8]}"
    t, _ = catalog.init_tables(spark, root, db=db, stage_db=f"{db}_s", contract=C)
    rows = spark.createDataFrame([], C.schema).unionByName(
        spark.range(3).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in C.schema.fields if f.name != "date"],
            F.add_months(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"),
        )
    )
    publish_months(rows, catalog.table_location(spark, t))
    assert catalog.attached_months(spark, t).count() == 0
    catalog.recover_months(spark, t)
    assert sorted(r.date for r in catalog.attached_months(spark, t).collect()) == [
        dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)
    ]

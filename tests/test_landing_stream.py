"""Landing scan over unlike file schemas, newest file per month, and the
incremental file stream (each file once; rerun does nothing)."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions.calendar import month_from_file_name
from monthwise.plans.load import read_target
from monthwise.session import local_path
from monthwise.sources.landing import (
    MonthSource,
    list_files,
    newest_file_per_month,
    scan_months,
    with_month,
    write_month_files,
)
from monthwise.streaming.incremental import IncrementalLoad

C = TRIP_CONTRACT.with_timestamp_ntz()


def test_month_from_name(spark):
    df = spark.createDataFrame(
        [("/l/yellow_tripdata_2020_02.parquet",), ("/l/yellow_tripdata_2019-12.parquet",), ("/l/other.parquet",),
         ("/l/yellow_tripdata_2020_13.parquet",), ("/yellow_tripdata_raw/yellow_tripdata_2021_03.parquet",),
         ("/l/yellow_tripdata_2021_04/part-0.parquet",), ("/l/yellow_tripdata_2021_05/yellow_tripdata_old.parquet",),
         ("/l/yellow_tripdata_2o21_06.parquet",), ("/l/yellow_tripdata_2021_6.parquet",)], "p string")
    got = [r[0] for r in df.select(month_from_file_name("p")).collect()]
    assert got == [dt.date(2020, 2, 1), dt.date(2019, 12, 1), None, None, dt.date(2021, 3, 1), dt.date(2021, 4, 1),
                   dt.date(2021, 5, 1), None, None]


def test_int_and_double_files_scan_together(spark, scratch):
    land = scratch("mixed")
    a = spark.createDataFrame([(1, 2, dt.date(2020, 1, 1))], "VendorID int, passenger_count int, date date")
    b = spark.createDataFrame([(3, 4.5, dt.date(2020, 2, 1))], "VendorID long, passenger_count double, date date")
    write_month_files(spark, a, land, layout="file")
    write_month_files(spark, b, land, layout="file")
    assert sorted(f for f in os.listdir(local_path(land)) if not f.startswith(".")) == ["yellow_tripdata_2020_01.parquet", "yellow_tripdata_2020_02.parquet"]
    paths = [r.path for r in list_files(spark, land).collect()]
    out = scan_months(spark, paths, C)
    got = sorted((r.vendor_id, r.passenger_count, r.date) for r in out.collect())
    assert got == [(1, 2.0, dt.date(2020, 1, 1)), (3, 4.5, dt.date(2020, 2, 1))]
    # explicit months override the name
    out2 = scan_months(spark, [MonthSource(paths[0], dt.date(2001, 1, 1))], C)
    assert out2.first().date == dt.date(2001, 1, 1)


def test_month_folders_as_units(spark, scratch):
    from monthwise.sources.landing import month_units

    land = scratch("folders")
    a = spark.range(3000).select((F.col("id") % 7).alias("VendorID"), F.lit(dt.date(2020, 1, 1)).alias("date"))
    b = spark.createDataFrame([(3.5, dt.date(2020, 2, 1))], "VendorID double, date date")
    write_month_files(spark, a, land)
    write_month_files(spark, b, land)
    units = month_units(list_files(spark, land, recursive=True)).collect()
    assert sorted(r.date for r in units) == [dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
    assert all(r.unit.rstrip("/").split("/")[-1].startswith("yellow_tripdata_2020_0") for r in units)
    out = scan_months(spark, [r.unit for r in units], C)
    assert out.count() == 3001
    assert out.where(F.col("date") == F.lit(dt.date(2020, 2, 1))).first().vendor_id == 3


def test_newest_file_wins(spark):
    listing = spark.createDataFrame(
        [("a/yellow_tripdata_2020_01.parquet", dt.datetime(2020, 2, 1), 1),
         ("b/yellow_tripdata_2020_01.parquet", dt.datetime(2020, 3, 1), 1),
         ("c/yellow_tripdata_2020_02.parquet", dt.datetime(2020, 3, 1), 1),
         ("d/yellow_tripdata_2020_02.parquet", dt.datetime(2020, 3, 1), 1)],
        "path string, modificationTime timestamp, length long")
    got = {r.date: r.path for r in newest_file_per_month(with_month(listing)).collect()}
    assert got == {dt.date(2020, 1, 1): "b/yellow_tripdata_2020_01.parquet",
                   dt.date(2020, 2, 1): "d/yellow_tripdata_2020_02.parquet"}


def test_incremental_each_file_once_and_rearrival_replaces(spark, scratch):
    root = scratch("inc")
    job = IncrementalLoad(f"{root}/landing", f"{root}/target", f"{root}/ledger", f"{root}/ckpt", contract=C)
    jan = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 1))], "VendorID long, date date")
    write_month_files(spark, jan, job.landing)
    job.run_available(spark)
    assert read_target(spark, job.target_root, C).count() == 2
    job.run_available(spark)  # nothing new
    assert read_target(spark, job.target_root, C).count() == 2
    time.sleep(1.1)
    jan2 = spark.createDataFrame([(9, dt.date(2020, 1, 1))], "VendorID long, date date")
    feb = spark.createDataFrame([(5, dt.date(2020, 2, 1))], "VendorID long, date date")
    os.makedirs(local_path(job.landing) + "/later", exist_ok=True)
    write_month_files(spark, jan2, job.landing + "/later")
    write_month_files(spark, feb, job.landing)
    job.run_available(spark)
    got = sorted((r.vendor_id, r.date) for r in read_target(spark, job.target_root, C).collect())
    assert got == [(5, dt.date(2020, 2, 1)), (9, dt.date(2020, 1, 1))]


def test_stream_archives_loaded_files(spark, scratch):
    root = scratch("arch")
    job = IncrementalLoad(f"{root}/landing", f"{root}/target", f"{root}/ledger", f"{root}/ckpt", contract=C,
                          clean_source="archive", archive_dir=f"{root}/archive", max_files_per_trigger=1)
    for m in (1, 2, 3):
        df = spark.createDataFrame([(m, dt.date(2020, m, 1))], "VendorID long, date date")
        write_month_files(spark, df, job.landing, layout="file")
    job.run_available(spark)
    got = sorted(r.vendor_id for r in read_target(spark, job.target_root, C).collect())
    assert got == [1, 2, 3]
    # files of batches before the last one have been moved to the archive
    archived = [f for _, _, fs_ in os.walk(local_path(f"{root}/archive")) for f in fs_ if f.endswith(".parquet")]
    assert len(archived) >= 1


def test_given_months_and_named_units(spark, scratch):
    # month folders of one schema, some with a given month, the others named
    # by their folder name: each row gets its unit's month
    land = scratch("given")
    df = spark.range(600).select(
        (F.col("id") % 5).alias("VendorID"),
        F.add_months(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 6).cast("int")).alias("date"),
    )
    units = sorted(write_month_files(spark, df, land))
    assert len(units) == 6
    given = {u: dt.date(1990 + i, 1, 1) for i, u in enumerate(units[:4])}
    sources = [MonthSource(u, given.get(u)) for u in units]
    out = scan_months(spark, sources, C)
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    # the named units share one scan; each given month is a scan with a literal month
    assert plan.count("FileScan parquet") == 1 + len(given)
    got = {r.date: r.n for r in out.groupBy("date").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {given.get(u, dt.date(2020, 5 if u.endswith("05") else 6, 1)): 100 for u in units}
    assert got == want


def test_stream_into_catalog_table(spark, scratch):
    import uuid

    from monthwise.plans import catalog

    root = scratch("inc-table")
    db = f"s_{uuid.uuid4().hex[:8]}"
    t, ledger = catalog.init_tables(spark, f"{root}/wh", db=db, stage_db=f"{db}_s", contract=C)
    job = IncrementalLoad(f"{root}/landing", None, None, f"{root}/ckpt", contract=C, table=t, ledger_table=ledger)
    jan = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 1))], "VendorID long, date date")
    write_month_files(spark, jan, job.landing)
    job.run_available(spark)
    time.sleep(1.1)
    write_month_files(spark, spark.createDataFrame([(9, dt.date(2020, 1, 1))], "VendorID long, date date"),
                      job.landing + "/later")
    write_month_files(spark, spark.createDataFrame([(5, dt.date(2020, 2, 1))], "VendorID long, date date"), job.landing)
    job.run_available(spark)
    got = sorted((r.vendor_id, r.date) for r in spark.table(t).collect())
    assert got == [(5, dt.date(2020, 2, 1)), (9, dt.date(2020, 1, 1))]


def test_file_head_per_month_is_each_files_first_rows(spark, scratch):
    import pyarrow.parquet as pq

    from monthwise.operators.sample import file_head_per_month
    from monthwise.plans.views import orders_trips_raw

    from .conftest import SF_SMALL

    land = scratch("heads")
    units = write_month_files(spark, orders_trips_raw(spark, SF_SMALL), land, layout="file")
    got = file_head_per_month(spark, units, 3, C)
    want = []
    for u in units:
        t = pq.read_table(local_path(u)).slice(0, 3)
        month = dt.date(int(u[-15:-11]), int(u[-10:-8]), 1)
        want += [(k, month) for k in t.column("PULocationID").to_pylist()]
    assert sorted((r.pu_location_id, r.date) for r in got.collect()) == sorted(want)
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    # rows come from leading row groups alone: no scan of the month files
    assert "MapInArrow" in plan and "Scan parquet" not in plan and "FileScan parquet" not in plan

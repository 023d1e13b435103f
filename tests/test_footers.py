"""Footers read by tasks: schema groups, heads by row groups."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.operators.sample import file_head, file_head_per_month
from monthwise.session import local_path
from monthwise.sources import footers
from monthwise.sources.landing import list_files, month_units, scan_months, scan_path

C = TRIP_CONTRACT.with_timestamp_ntz()


def write(folder, name, rows, group=None, **columns):
    import os

    path = f"{local_path(folder)}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns or {"VendorID": pa.array(rows, pa.int64())}), path, row_group_size=group)
    return path


def test_scan_path(spark):
    got = {
        "a/yellow_tripdata_2020_01.parquet": "a/yellow_tripdata_2020_01.parquet",
        "a/yellow_tripdata_2020_01/part-0.parquet": "a/yellow_tripdata_2020_01",
        "a/yellow_tripdata_2020_01/x/part-0.parquet": "a/yellow_tripdata_2020_01",
        "a/yellow_tripdata_2020_01-00002.parquet": "a/yellow_tripdata_2020_01-[0-9][0-9][0-9][0-9][0-9].parquet",
        "a/other.parquet": "a/other.parquet",
    }
    df = spark.createDataFrame([(p,) for p in got], "path string").withColumn("scan", scan_path("path"))
    assert {r.path: r.scan for r in df.collect()} == got


def test_many_files_few_scans(spark, scratch):
    land = scratch("groups")
    for m in range(1, 7):
        for part in range(5):
            name = f"yellow_tripdata_2020_{m:02d}/part-{part}.parquet"
            odd = m == 4 and part == 2  # one file of another type in one month
            write(land, name, [], VendorID=pa.array([m * 10 + part], pa.int32() if m > 4 or odd else pa.int64()))
    files = list_files(spark, land, recursive=True).select("path").withColumn("scan", scan_path("path"))
    groups = sorted(sorted(p.rsplit("_", 1)[1] for p in paths) for paths, _ in footers.schema_groups(files))
    # whole folders where a month has one schema, single files where it has two
    assert groups == [
        ["01", "02", "03", "04/part-0.parquet", "04/part-1.parquet", "04/part-3.parquet", "04/part-4.parquet"],
        ["04/part-2.parquet", "05", "06"],
    ]
    units = month_units(list_files(spark, land, recursive=True)).collect()
    assert all(len(u.scans) == 1 and u.n_files == 5 for u in units)
    got = scan_months(spark, [s for u in units for s in u.scans], C).collect()
    assert sorted((r.vendor_id, r.date.month) for r in got) == [(m * 10 + p, m) for m in range(1, 7) for p in range(5)]


def test_merging_where_pyarrow_cannot_open(spark, scratch):
    land = scratch("merge")
    paths = []
    for m in range(1, 9):
        kind = pa.int64() if m < 4 else pa.float64() if m < 7 else pa.string()
        values = [str(m)] if kind == pa.string() else [m]
        paths.append(write(land, f"m{m}.parquet", [], a=pa.array(values, kind), **{f"c{m}": pa.array([m])}))
    groups = footers.merge_groups(spark, paths)
    for files, schema in groups:
        assert spark.read.schema(schema).parquet(*files).select("a").count() == len(files)
    assert [p for files, _ in groups for p in files] == paths
    # the cuts are where types change, and at halves
    kinds = [{int(p[-9]) < 4, int(p[-9]) < 7} for files, _ in groups for p in files]
    assert len(kinds) == 8 and len(groups) <= 5
    mixed = scratch("merge-mixed")
    write(mixed, "d/a.parquet", [], a=pa.array([1]))
    write(mixed, "d/b.parquet", [], a=pa.array(["x"]))
    assert sorted(len(f) for f, _ in footers.merge_groups(spark, [f"{mixed}/d"])) == [1, 1]
    assert footers.read_footer("nosuch://host/x.parquet") == (None, None, None)


def test_leading_groups():
    assert footers.leading_groups([10, 10, 10], 15) == [0, 1]
    assert footers.leading_groups([10, 10], 10) == [0]
    assert footers.leading_groups([0, 4], 9) == [0, 1]
    assert footers.leading_groups([], 1) == []


def test_file_head_reads_leading_row_groups_only(spark, scratch):
    land = scratch("head")
    for i in range(40):
        write(land, f"part-{i:02d}.parquet", range(i * 100, i * 100 + (0 if i == 1 else 100)), group=10)
    # a later row group of the first file is broken: a read of it would fail
    meta = pq.read_metadata(f"{local_path(land)}/part-02.parquet")
    broken = meta.row_group(5).column(0)
    at = broken.dictionary_page_offset or broken.data_page_offset
    with open(f"{local_path(land)}/part-02.parquet", "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * broken.total_compressed_size)
    for n in (1, 99, 100, 101, 145):
        got = [r.VendorID for r in file_head(spark, land, n).collect()]
        assert got == [*range(100), *range(200, 300)][:n]
    with pytest.raises(Exception, match="."):
        spark.read.parquet(land).agg(F.sum("VendorID")).collect()
    with pytest.raises(ValueError):
        file_head(spark, land, 0)


def test_file_head_of_fewer_rows(spark, scratch):
    land = scratch("head-few")
    for i in range(3):
        write(land, f"p{i}.parquet", [i])
    assert [r.VendorID for r in file_head(spark, land, 50).collect()] == [0, 1, 2]


def test_head_per_month_over_files_and_schemas(spark, scratch):
    land = scratch("head-month")
    for m, kind in ((1, pa.int64()), (2, pa.int32())):
        for part in range(4):
            write(land, f"yellow_tripdata_2020_{m:02d}/part-{part}.parquet", [], VendorID=pa.array(range(part * 3, part * 3 + 3), kind))
    units = [u for r in month_units(list_files(spark, land, recursive=True)).collect() for u in r.scans]
    got = sorted((r.date, r.vendor_id) for r in file_head_per_month(spark, units, 7, C).collect())
    assert got == [(dt.date(2020, m, 1), v) for m in (1, 2) for v in range(7)]

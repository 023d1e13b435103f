"""Small parts: written by tasks with pyarrow, as Spark's writer would write them."""

import datetime as dt
import decimal
import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.session import held_setting, local_path
from monthwise.sources import parts
from monthwise.sources.footers import at_once, listing_tasks
from monthwise.sources.landing import list_files, write_month_files

JAN, FEB = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
STEM = "yellow_tripdata_2020_0"

TYPES = (
    "yes boolean, b byte, s short, i int, n long, f float, x double, t string, raw binary, day date, "
    "at timestamp_ntz, price decimal(9,2), big decimal(30,4)"
)


def odd_rows(spark):
    full = (True, 1, 2, 3, 4, 0.5, float("nan"), "é\x00", b"\x00\xff", dt.date(900, 2, 28), dt.datetime(1500, 1, 1, 1),
            decimal.Decimal("1.25"), decimal.Decimal("-7.5"))
    rows = [
        *[(k, *full, JAN) for k in range(7)],
        *[(k, *[None] * len(full), FEB) for k in range(3)],
        (8, *full, None),
        (8, *full, None),
    ]
    return spark.createDataFrame(rows, f"k long, {TYPES}, date date")


def read(spark, land):
    # a hidden file is not to be read
    files = sorted(f for f in glob.glob(f"{local_path(land)}/*.parquet") if "/__HIVE" not in f)
    frames = {f.rsplit("/", 1)[1]: spark.read.parquet(f"file:{f}") for f in files}
    return {
        name: (df.schema, df.count(), sorted(str(r) for r in df.drop("k").collect())) for name, df in frames.items()
    }, sorted(r.k for df in frames.values() for r in df.select("k").collect())


def made_by(land):
    return {pq.read_metadata(f).created_by.split()[0] for f in glob.glob(f"{local_path(land)}/*.parquet")}


def test_small_parts_hold_what_sparks_writer_writes(spark, scratch, monkeypatch):
    new, old = scratch("new"), scratch("old")
    got = write_month_files(spark, odd_rows(spark), new, layout="file", max_records=3)
    monkeypatch.setattr(parts, "writes_small_parts", lambda *_: False)
    was = write_month_files(spark, odd_rows(spark), old, layout="file", max_records=3)
    assert (made_by(new), made_by(old)) == ({"parquet-cpp-arrow"}, {"parquet-mr"})
    # rows of no month have a hidden name in both
    names = ["__HIVE_DEFAULT_PARTITION__", *(f"{STEM}1-{i:05d}" for i in range(3)), f"{STEM}2"]
    assert [p.rsplit("/", 1)[1] for p in got] == [p.rsplit("/", 1)[1] for p in was] == [f"{n}.parquet" for n in names]
    hidden = [pq.read_table(f"{local_path(p[0])}").to_pylist() for p in (got, was)]
    assert len(hidden[0]) == 2 and str(hidden[0]) == str(hidden[1])
    assert read(spark, new) == read(spark, old)
    assert [n for _, n, _ in read(spark, new)[0].values()] == [3, 3, 1, 3]


def test_nothing_to_write(spark, scratch):
    land = scratch("none")
    assert write_month_files(spark, odd_rows(spark).where("false"), land, layout="file", max_records=3) == []
    assert glob.glob(f"{local_path(land)}/*") == []


def test_instants_keep_their_time(spark, scratch):
    land = scratch("instants")
    df = spark.sql("SELECT timestamp'2020-01-05 03:04:05.000006' AS at, date'2020-01-01' AS date")
    with held_setting(spark, "spark.sql.session.timeZone", "America/New_York"):
        df = df.select(F.expr("timestamp'2020-01-05 03:04:05.000006'").alias("at"), "date")
        write_month_files(spark, df, land, layout="file", max_records=3)
    [row] = spark.read.parquet(land).select(F.col("at").cast("string").alias("at")).collect()
    assert row.at == "2020-01-05 08:04:05.000006" and made_by(land) == {"parquet-cpp-arrow"}


@pytest.mark.parametrize(
    "setting",
    [
        ("spark.sql.parquet.compression.codec", "lz4_raw"),
        ("spark.sql.parquet.writeLegacyFormat", "true"),
        ("spark.sql.parquet.datetimeRebaseModeInWrite", "LEGACY"),
    ],
)
def test_settings_of_sparks_writer_are_kept(spark, scratch, setting):
    land = scratch("settings")
    with held_setting(spark, *setting):
        write_month_files(spark, odd_rows(spark).select("k", "n", "date"), land, layout="file", max_records=3)
    assert made_by(land) == {"parquet-mr"}


def test_what_stays_with_sparks_writer(spark, scratch):
    def small(schema, rows=3, folder="file:/tmp/x"):
        return parts.writes_small_parts(spark, T._parse_datatype_string(schema), folder, rows)

    assert small(TYPES)
    assert not small(TYPES, rows=parts.SMALL_PART + 1)
    assert not small("a array<int>") and not small("m map<string,int>") and not small("a int, A int")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.parts.link./in", "file:///tmp")
    assert not small(TYPES, folder="viewfs://parts/in/x")
    with held_setting(spark, "spark.sql.parquet.outputTimestampType", "INT96"):
        assert small("t timestamp_ntz") and not small("t timestamp")
    with held_setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
        land = scratch("zstd")
        write_month_files(spark, odd_rows(spark), land, layout="file", max_records=3)
    file = glob.glob(f"{local_path(land)}/*.parquet")[0]
    assert pq.read_metadata(file).row_group(0).column(0).compression == "ZSTD"


def test_parts_are_cut_where_the_month_ends():
    def batches(*lengths):
        names = [*"aaaaaaabbb", *"cccc"]
        at = 0
        for n in lengths:
            columns = [pa.array(names[at:at + n], pa.string()), pa.array(range(at, at + n), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["m", "v"])
            at += n

    whole = [("a", [0, 1, 2]), ("a", [3, 4, 5]), ("a", [6]), ("b", [7, 8, 9]), ("c", [10, 11, 12]), ("c", [13])]
    for lengths in ((14,), (7, 7), (1,) * 14, (0, 5, 0, 6, 3, 0), (10, 4), (3, 3, 4, 4)):
        got = [(name, rows.column("v").to_pylist()) for name, rows in parts.cut(batches(*lengths), "m", 3)]
        assert got == whole
    assert list(parts.cut(iter(()), "m", 3)) == []


def test_a_listing_takes_few_tasks(spark, scratch):
    land = scratch("listing")
    base = local_path(land)
    os.makedirs(base)
    for i in range(1000):
        with open(f"{base}/{i}.parquet", "w") as f:
            f.write("x")
    before = list_files(spark, land).rdd.getNumPartitions()
    with listing_tasks(spark):
        during = list_files(spark, land).rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    assert during <= cores + 1 < before and list_files(spark, land).count() == 1000


def test_far_files_are_read_in_threads():
    with at_once("file:/a", 2) as run:
        assert run is map
    with at_once("hdfs://host/a", 2) as run:
        assert run is not map and list(run(str, [1, 2])) == ["1", "2"]

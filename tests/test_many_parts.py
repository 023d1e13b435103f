"""Deliveries of very many small parts: renamed by tasks, listed by one pattern."""

import datetime as dt
import os

import pytest

from monthwise.contract import TRIP_CONTRACT
from monthwise.session import held_setting, local_path
from monthwise.sources import fs
from monthwise.sources.footers import PARTS, join_patterns
from monthwise.sources.landing import list_files, month_units, scan_months, write_month_files

C = TRIP_CONTRACT.with_timestamp_ntz()
JAN, FEB = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def trips(spark, *months):
    rows = [(m * 100 + i, d) for m, (d, n) in enumerate(months) for i in range(n)]
    return spark.createDataFrame(rows, "VendorID long, date date")


def back(spark, land):
    units = month_units(list_files(spark, land, recursive=True)).collect()
    frame = scan_months(spark, [p for u in units for p in u.scans], C)
    return sorted((r.vendor_id, r.date) for r in frame.select("vendor_id", "date").collect())


def test_parts_are_not_renamed_one_by_one(spark, scratch, monkeypatch):
    land = scratch("parts")
    df = trips(spark, (JAN, 7), (FEB, 2))

    def never(*_):
        raise AssertionError("a rename by the driver")

    monkeypatch.setattr(fs, "replace", never)
    monkeypatch.setattr(fs, "rename", never)
    written = write_month_files(spark, df, land, layout="file", max_records=2)
    stem = f"{land}/yellow_tripdata_2020_0"
    assert written == [*(f"{stem}1-{i:05d}.parquet" for i in range(4)), f"{stem}2.parquet"]
    assert sorted(os.listdir(local_path(land))) == sorted(
        n for n in os.listdir(local_path(land)) if n.startswith((".yellow", "yellow"))
    )
    assert back(spark, land) == [*((i, JAN) for i in range(7)), (100, FEB), (101, FEB)]
    # the same names written again replace the files, whatever checksums lie beside them
    write_month_files(spark, trips(spark, (JAN, 8), (FEB, 1)), land, layout="file", max_records=2)
    assert back(spark, land) == [*((i, JAN) for i in range(8)), (100, FEB)]


def test_replace_all(spark, scratch):
    root = scratch("replace")
    base = local_path(root)
    os.makedirs(f"{base}/a b")

    def put(name, text, sums=None):
        with open(f"{base}/{name}", "w") as f:
            f.write(text)
        if sums:
            folder, _, last = name.rpartition("/")
            with open(f"{base}/{folder}/.{last}.crc", "w") as f:
                f.write(sums)

    put("a b/1", "one")
    put("a b/2", "two", "sums of two")
    put("a b/3", "old", "sums of old")
    put("a b/4", "four")
    fs.replace_all(spark, [(f"{root}/a b/1", f"{root}/new/1"), (f"{root}/a b/2", f"{root}/new/2"), (f"{root}/a b/4", f"{root}/a b/3")])
    assert sorted(os.listdir(f"{base}/new")) == [".2.crc", "1", "2"]
    assert os.listdir(f"{base}/a b") == ["3"]  # nothing set aside stays, no checksums of the old file
    assert open(f"{base}/a b/3").read() == "four"
    fs.replace_all(spark, [(f"{root}/a b/1", f"{root}/new/1")])  # tried again: done before
    with pytest.raises(Exception, match="No such file|FileNotFound|does not exist"):
        fs.replace_all(spark, [(f"{root}/a b/nosuch", f"{root}/new/nosuch")])
    fs.replace_all(spark, [])


def test_one_pattern_a_folder(spark):
    got = join_patterns(["x/a/m_1" + PARTS, "x/a/m_2" + PARTS, "x/b/m_1" + PARTS, "x/a/m,3" + PARTS, "x/a/m_4.parquet", "x/c"])
    assert sorted(got) == sorted(
        ["x/a/{m_1,m_2}" + PARTS, "x/b/m_1" + PARTS, "x/a/m,3" + PARTS, "x/a/m_4.parquet", "x/c"]
    )


def test_held_setting(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    with held_setting(spark, name, "5"), held_setting(spark, name, "6"):
        assert spark.conf.get(name) == "5"
    assert spark.conf.get(name) == before


def test_many_small_parts_are_shuffled_by_month(spark, scratch, monkeypatch):
    from monthwise.plans.load import read_target
    from monthwise.streaming import incremental

    root = scratch("small")
    job = incremental.IncrementalLoad(
        landing=f"{root}/landing", target_root=f"{root}/target", ledger_root=f"{root}/ledger",
        checkpoint=f"{root}/checkpoint", contract=C, clean_source="archive", archive_dir=f"{root}/archive",
    )
    asked, load = [], incremental.load_months

    def load_months(*args, **options):
        asked.append(options["rebalance"])
        return load(*args, **options)

    monkeypatch.setattr(incremental, "load_months", load_months)
    write_month_files(spark, trips(spark, (JAN, 12), (FEB, 6)), job.landing, layout="file", max_records=1)
    job.run_available(spark)
    assert [len(fs.list_dir(spark, f"{root}/{d}")) for d in ("archive/batch=1",)] == [18]
    assert not [n for n in fs.list_dir(spark, job.landing) if n.endswith(".parquet")]
    # a few files a month come as they are: a split holds rows of few months
    write_month_files(spark, trips(spark, (dt.date(2020, 3, 1), 3)), job.landing, layout="file", max_records=1)
    job.run_available(spark)
    assert asked == [True, False]
    got = sorted((r.vendor_id, r.date.month) for r in read_target(spark, job.target_root, C).collect())
    assert got == sorted([*((i, 1) for i in range(12)), *((100 + i, 2) for i in range(6)), *((i, 3) for i in range(3))])

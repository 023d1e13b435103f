"""The stream source of whole deliveries: manifests, replay, archive."""

import datetime as dt
import os
import pickle
import shutil
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from monthwise.contract import TRIP_CONTRACT
from monthwise.plans.load import read_target
from monthwise.session import local_path
from monthwise.sources.landing import month_unit
from monthwise.streaming import deliveries
from monthwise.streaming.deliveries import DeliveryReader, unit_of
from monthwise.streaming.incremental import IncrementalLoad

C = TRIP_CONTRACT.with_timestamp_ntz()
MONTH = "yellow_tripdata_2020_{:02d}".format


def put(folder, name, *ids):
    """A file that arrives by rename."""
    path = f"{local_path(folder)}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({"VendorID": pa.array(ids, pa.int64())}), f"{path}.tmp")
    os.rename(f"{path}.tmp", path)
    return path


def job_of(root, **options):
    return IncrementalLoad(f"{root}/landing", f"{root}/t", f"{root}/l", f"{root}/ckpt", contract=C, **options)


def loaded(spark, job):
    return sorted((r.date.month, r.vendor_id) for r in read_target(spark, job.target_root, C).collect())


def files_below(folder):
    return sorted(f"{d[len(folder) + 1:]}/{f}".lstrip("/") for d, _, names in os.walk(folder) for f in names)


def reader_of(tmp_path, **options):
    (tmp_path / "landing").mkdir(exist_ok=True)
    return DeliveryReader({"path": f"{tmp_path}/landing", "log": f"{tmp_path}/log", **options})


def sent(reader, start, end):
    rows = [r for p in reader.partitions({"manifest": start}, {"manifest": end}) for r in reader.read(p)]
    return sorted((number, unit.rsplit("/", 1)[-1], path.rsplit("/", 1)[-1]) for number, unit, path, _, _ in rows)


def test_unit_of_is_month_unit(spark):
    paths = ["/a/yellow_tripdata_2020_01.parquet", "/a/yellow_tripdata_2020_01/p-0.parquet", "/x/other.parquet",
             "/a/yellow_tripdata_2020_01-00003.parquet", "/yellow_tripdata_2019_01/yellow_tripdata_2020_12 (1).parquet",
             "/a/yellow_tripdata_2020_13.parquet", "/a/yellow_tripdata_2020-02.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").select("path", month_unit("path").alias("u"))
    assert {r.path: r.u for r in df.collect()} == {p: unit_of(p) for p in paths}


def test_offsets_are_whole_deliveries(tmp_path):
    reader = reader_of(tmp_path)
    land = f"{tmp_path}/landing"
    assert reader.latestOffset() == {"manifest": 0} == reader.initialOffset()
    put(land, f"{MONTH(1)}-00000.parquet", 1)
    put(land, f"{MONTH(2)}/a.parquet", 2)
    assert reader.latestOffset() == {"manifest": 1}
    assert reader.latestOffset() == {"manifest": 1}
    put(land, f"{MONTH(1)}-00001.parquet", 3)
    assert reader.latestOffset() == {"manifest": 2}
    assert sent(reader, 0, 1) == [(1, MONTH(1), f"{MONTH(1)}-00000.parquet"), (1, MONTH(2), "a.parquet")]
    # the part added later brings its delivery again, whole
    assert sent(reader, 1, 2) == [(2, MONTH(1), f"{MONTH(1)}-0000{i}.parquet") for i in (0, 1)]
    # another process, as after a crash, knows what was sent
    again = pickle.loads(pickle.dumps(reader))
    assert again.latestOffset() == {"manifest": 2}
    assert sent(again, 0, 2) == sent(reader, 0, 2)
    # a file delivered anew under its name, and one that names no month
    time.sleep(0.02)
    put(land, f"{MONTH(2)}/a.parquet", 20, 21)
    put(land, "notes.parquet", 9)
    assert again.latestOffset() == {"manifest": 3}
    assert sent(again, 2, 3) == [(3, "", "notes.parquet"), (3, MONTH(2), "a.parquet")]


def test_unchanged_folders_are_not_listed_again(tmp_path, monkeypatch):
    monkeypatch.setattr(deliveries, "SETTLE_S", 0.0)
    reader = reader_of(tmp_path)
    land = f"{tmp_path}/landing"
    for m in range(1, 10):
        put(land, f"{MONTH(m)}/a.parquet", m)
    listed = []
    children = deliveries.Landing.children
    monkeypatch.setattr(deliveries.Landing, "children", lambda self, folder: listed.append(folder) or children(self, folder))
    reader.latestOffset()
    assert len(listed) == 10
    listed.clear()
    assert reader.latestOffset() == {"manifest": 1} and listed == []
    put(land, f"{MONTH(5)}/b.parquet", 50)
    assert reader.latestOffset() == {"manifest": 2}
    assert listed == [f"{land}/{MONTH(5)}"]
    # a file with an old time of its own still changes its folder
    late = put(f"{tmp_path}/else", "c.parquet", 60)
    os.utime(late, (1e9, 1e9))
    os.rename(late, f"{land}/{MONTH(6)}/c.parquet")
    assert reader.latestOffset() == {"manifest": 3}
    shutil.rmtree(f"{land}/{MONTH(7)}")
    assert reader.latestOffset() == {"manifest": 3}


def test_max_files_keeps_deliveries_whole(tmp_path):
    reader = reader_of(tmp_path, maxfiles="3")
    for m in (1, 2, 3):
        for part in range(2 if m < 3 else 5):
            put(f"{tmp_path}/landing", f"{MONTH(m)}-{part:05d}.parquet", m)
    ends = [reader.latestOffset()["manifest"] for _ in range(4)]
    assert ends == [1, 2, 3, 3]
    assert [len(sent(reader, i, i + 1)) for i in range(3)] == [2, 2, 5]


def test_archive_takes_whole_deliveries(tmp_path):
    land, away = f"{tmp_path}/landing", f"{tmp_path}/away"
    reader = reader_of(tmp_path, clean="archive", archive=away)
    put(land, f"{MONTH(1)}/a.parquet", 1)
    put(land, f"{MONTH(1)}/x/b.parquet", 1)
    put(land, f"{MONTH(2)}/a.parquet", 1)
    put(land, f"{MONTH(3)}-00000.parquet", 1)
    reader.latestOffset()
    put(land, f"{MONTH(2)}/late.parquet", 2)  # comes while the batch runs
    reader.commit({"manifest": 1})
    reader.commit({"manifest": 1})
    assert files_below(land) == [f"{MONTH(2)}/a.parquet", f"{MONTH(2)}/late.parquet"]
    assert files_below(away) == [f"batch=1/{MONTH(1)}/a.parquet", f"batch=1/{MONTH(1)}/x/b.parquet", f"batch=1/{MONTH(3)}-00000.parquet"]
    # sent again whole; the late part of month 3 comes with its archived fellow
    put(land, f"{MONTH(3)}-00001.parquet", 1)
    assert reader.latestOffset() == {"manifest": 2}
    want = [(2, MONTH(2), "a.parquet"), (2, MONTH(2), "late.parquet"), *[(2, MONTH(3), f"{MONTH(3)}-0000{i}.parquet") for i in (0, 1)]]
    assert sent(reader, 1, 2) == want
    DeliveryReader(reader.options).commit({"manifest": 2})
    assert files_below(land) == []
    # part 0 once more: a new delivery, without the archived parts
    put(land, f"{MONTH(3)}-00000.parquet", 7, 8)
    fresh = DeliveryReader(reader.options)
    assert fresh.latestOffset() == {"manifest": 3}
    assert sent(fresh, 2, 3) == [(3, MONTH(3), f"{MONTH(3)}-00000.parquet")]


def test_late_part_after_delete_fails(tmp_path):
    reader = reader_of(tmp_path, clean="delete")
    put(f"{tmp_path}/landing", f"{MONTH(1)}-00000.parquet", 1)
    reader.latestOffset()
    reader.commit({"manifest": 1})
    assert files_below(f"{tmp_path}/landing") == []
    put(f"{tmp_path}/landing", f"{MONTH(1)}-00001.parquet", 1)
    with pytest.raises(ValueError, match="deleted"):
        reader.latestOffset()
    with pytest.raises(ValueError, match="archive"):
        reader_of(tmp_path, clean="archive").latestOffset()
    with pytest.raises(ValueError, match="clean"):
        reader_of(tmp_path, clean="x").latestOffset()


def test_killed_batch_replays_the_same_set(spark, scratch, monkeypatch):
    root = scratch("killed")
    job = job_of(root)
    put(job.landing, f"{MONTH(1)}/a.parquet", 1)
    seen, whole = [], IncrementalLoad.load_batch

    def dies(self, batch, epoch):
        seen.append(sorted(r.path.rsplit("/landing/", 1)[1] for r in batch.collect()))
        raise RuntimeError("killed")

    monkeypatch.setattr(IncrementalLoad, "load_batch", dies)
    with pytest.raises(Exception, match="killed"):
        job.run_available(spark)
    put(job.landing, f"{MONTH(1)}.parquet", 5)  # another delivery comes before the restart
    put(job.landing, f"{MONTH(2)}/a.parquet", 2)

    def notes(self, batch, epoch):
        seen.append(sorted(r.path.rsplit("/landing/", 1)[1] for r in batch.collect()))
        whole(self, batch, epoch)

    monkeypatch.setattr(IncrementalLoad, "load_batch", notes)
    job.run_available(spark)
    assert seen[0] == seen[1] == [f"{MONTH(1)}/a.parquet"]
    assert seen[2] == [f"{MONTH(1)}.parquet", f"{MONTH(2)}/a.parquet"]
    assert loaded(spark, job) == [(1, 5), (2, 2)]


def test_stream_archives_deliveries_of_many_files(spark, scratch):
    root = scratch("many")
    job = job_of(root, clean_source="archive", archive_dir=f"{root}/away")
    for part in range(3):
        put(job.landing, f"{MONTH(1)}-{part:05d}.parquet", 10 + part)
        put(job.landing, f"{MONTH(2)}/p{part}.parquet", 20 + part)
    job.run_available(spark)
    want = [(m, 10 * m + p) for m in (1, 2) for p in range(3)]
    assert loaded(spark, job) == want
    assert files_below(local_path(job.landing)) == [] and len(files_below(local_path(f"{root}/away"))) == 6
    job.run_available(spark)  # nothing new
    assert loaded(spark, job) == want
    # a late part is loaded with its archived fellows, a folder that comes again replaces the month
    put(job.landing, f"{MONTH(1)}-00003.parquet", 13)
    put(job.landing, f"{MONTH(2)}/q.parquet", 99)
    job.run_available(spark)
    assert loaded(spark, job) == [*[(1, 10 + p) for p in range(4)], (2, 99)]
    assert files_below(local_path(job.landing)) == []


def test_max_files_drains_everything(spark, scratch):
    root = scratch("drain")
    job = job_of(root, clean_source="delete", max_files_per_trigger=2)
    for m in (1, 2, 3):
        for part in range(2):
            put(job.landing, f"{MONTH(m)}/p{part}.parquet", 10 * m + part)
    job.run_available(spark)
    assert loaded(spark, job) == [(m, 10 * m + p) for m in (1, 2, 3) for p in range(2)]
    assert files_below(local_path(job.landing)) == []


def test_running_stream_archives_as_it_goes(spark, scratch):
    root = scratch("running")
    job = job_of(root, clean_source="archive", archive_dir=f"{root}/away")
    put(job.landing, f"{MONTH(1)}/a.parquet", 1)
    q = job.start(spark, "1 second")
    try:
        end = time.time() + 60
        while time.time() < end and not q.lastProgress:
            time.sleep(0.5)
        put(job.landing, f"{MONTH(2)}/a.parquet", 2)
        while time.time() < end and files_below(local_path(job.landing)) != []:
            if len(files_below(local_path(f"{root}/away"))) >= 1 and loaded(spark, job) == [(1, 1), (2, 2)]:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert f"batch=1/{MONTH(1)}/a.parquet" in files_below(local_path(f"{root}/away"))
    assert loaded(spark, job) == [(1, 1), (2, 2)]
    assert read_target(spark, job.target_root, C).where("date = date'2020-01-01'").first().date == dt.date(2020, 1, 1)

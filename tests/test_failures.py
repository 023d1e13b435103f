"""Failures leave targets and ledgers as they were; nothing is lost in silence."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions.filenames import number_taken_names
from monthwise.operators import ledger
from monthwise.operators.checks import GateError
from monthwise.operators.sample import GROUP_LIMIT_ROWS, sample_per_month
from monthwise.plans import catalog
from monthwise.plans import load as load_module
from monthwise.plans.load import attach_month, detach_month, load_months, partition_path, publish_months, read_target
from monthwise.session import ensure_checkpoint_dir
from monthwise.sources import fs
from monthwise.sources.landing import list_files, month_units, scan_months, unnamed_files, write_month_files
from monthwise.streaming.incremental import IncrementalLoad

C = TRIP_CONTRACT.with_timestamp_ntz()
JAN, FEB = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "VendorID long, date date")


def conformed(spark, *pairs):
    from monthwise.functions.conform import conform

    return conform(rows(spark, *pairs), C)


def vendors(spark, target):
    return sorted((r.vendor_id, r.date) for r in read_target(spark, target, C).collect())


def fail_renames_of(monkeypatch, text):
    real = fs._renamed
    monkeypatch.setattr(fs, "_renamed", lambda f, p, q: False if text in str(p) else real(f, p, q))


def test_compaction_with_a_failed_rename_keeps_the_log(spark, scratch, monkeypatch):
    root = scratch("ledger")
    for n in (1, 2):
        ledger.ledger_replace(spark.createDataFrame([(n, JAN)], "cnt long, date date"), root)
    fail_renames_of(monkeypatch, "_compact-")
    with pytest.raises(OSError):
        ledger.compact_ledger(spark, root)
    assert [r.cnt for r in ledger.read_ledger(spark, root).collect()] == [2]
    monkeypatch.undo()
    assert ledger.compact_ledger(spark, root) == 2
    assert [r.cnt for r in ledger.read_ledger(spark, root).collect()] == [2]


def test_attach_and_detach_with_failed_renames(spark, scratch, monkeypatch):
    target, out = scratch("target"), scratch("detached")
    publish_months(conformed(spark, (1, JAN), (2, FEB)), target, fresh=True)
    publish_months(conformed(spark, (9, JAN)), out, fresh=True)
    fail_renames_of(monkeypatch, out)  # the rename in fails; the one aside has worked
    with pytest.raises(OSError):
        attach_month(spark, out, JAN, target)
    assert vendors(spark, target) == [(1, JAN), (2, FEB)]
    monkeypatch.undo()
    assert attach_month(spark, out, JAN, target) and vendors(spark, target) == [(2, FEB), (9, JAN)]
    fail_renames_of(monkeypatch, partition_path(target, FEB))
    with pytest.raises(OSError):
        detach_month(spark, target, FEB, out)
    assert vendors(spark, target) == [(2, FEB), (9, JAN)]


def test_load_gates_what_it_wrote_and_reads_once(spark, scratch):
    root = scratch("gate")
    load_months(spark, conformed(spark, (1, JAN)), f"{root}/t", f"{root}/l", contract=C)
    with pytest.raises(GateError):
        load_months(spark, conformed(spark, (5, JAN), (6, FEB)), f"{root}/t", f"{root}/l", months=[JAN], contract=C)
    assert vendors(spark, f"{root}/t") == [(1, JAN)]
    reads = spark.sparkContext.accumulator(0)

    def count(it):
        for b in it:
            reads.add(b.num_rows)
            yield b

    frame = conformed(spark, (5, JAN), (6, JAN))
    frame = frame.mapInArrow(count, frame.schema)
    load_months(spark, frame, f"{root}/t", f"{root}/l", months=[JAN], contract=C)
    assert vendors(spark, f"{root}/t") == [(5, JAN), (6, JAN)] and reads.value == 2


def test_row_limit_below_one_is_refused(spark, scratch):
    root = scratch("limit")
    load_months(spark, conformed(spark, (1, JAN)), f"{root}/t", f"{root}/l", contract=C)
    for n in (0, -1):
        with pytest.raises(ValueError):
            load_months(spark, conformed(spark, (2, JAN)), f"{root}/t", f"{root}/l", contract=C, row_limit=n)
    assert vendors(spark, f"{root}/t") == [(1, JAN)]


def test_crash_before_the_swap_leaves_the_ledger(spark, scratch, monkeypatch):
    """With a row limit too, a month is in the ledger only once it is in the table."""
    import uuid

    db = f"c_{uuid.uuid4().hex[:8]}"
    t, log = catalog.init_tables(spark, scratch("crash"), db=db, stage_db=f"{db}_s", contract=C)

    def crash(*a, **k):
        raise RuntimeError("crash")

    monkeypatch.setattr(catalog, "attach_months", crash)
    with pytest.raises(RuntimeError):
        catalog.load_months_to_table(spark, conformed(spark, (1, JAN)), t, log, contract=C, row_limit=5)
    assert spark.table(log).count() == 0 and spark.table(t).count() == 0
    monkeypatch.undo()
    catalog.load_months_to_table(spark, conformed(spark, (1, JAN)), t, log, contract=C, row_limit=5)
    assert spark.table(t).count() == 1 and [r.cnt for r in spark.table(log).collect()] == [1]


@pytest.mark.parametrize("n", [GROUP_LIMIT_ROWS, 5000])
def test_limits_of_any_size_have_no_hot_task(spark, n):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(JAN)).otherwise(F.lit(FEB)).alias("date"))
    out = sample_per_month(df, ["id"], n)
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    # either each task keeps n rows a month, or the numbering is by ranges of the month
    assert "WindowGroupLimit" in plan if n <= GROUP_LIMIT_ROWS else "Window [row_number" not in plan
    got = {r.date: (r.c, r.m) for r in out.groupBy("date").agg(F.count(F.lit(1)).alias("c"), F.max("id").alias("m")).collect()}
    assert got == {JAN: (n, 3 * (n - 1)), FEB: (n, sorted(i for i in range(20_000) if i % 3)[n - 1])}
    assert load_module.limit_per_month(df, n).groupBy("date").count().select("count").distinct().first()[0] == n


def test_nested_redelivery_folder(spark, scratch):
    """The last name in a path is the month's: the outer folder is no unit."""
    land = scratch("nested")
    outer = f"{land}/yellow_tripdata_2019_12_redelivery"
    write_month_files(spark, rows(spark, (1, JAN), (2, JAN)), land, layout="file")
    time.sleep(1.1)
    write_month_files(spark, rows(spark, (3, JAN), (4, JAN), (5, FEB)), outer, layout="file")
    units = {r.date: r for r in month_units(list_files(spark, land, recursive=True)).collect()}
    assert set(units) == {JAN, FEB} and "2019_12_redelivery/yellow_tripdata_2020_01" in units[JAN].unit
    frame = scan_months(spark, [p for r in units.values() for p in r.scans], C)
    assert sorted((r.vendor_id, r.date) for r in frame.collect()) == [(3, JAN), (4, JAN), (5, FEB)]


def test_unnamed_files_are_told(spark, scratch):
    from monthwise import jobs

    root = scratch("unnamed")
    land = f"{root}/landing"
    write_month_files(spark, rows(spark, (1, JAN)), land, layout="file")
    rows(spark, (7, JAN)).drop("date").coalesce(1).write.parquet(f"{land}/trips-jan.parquet")
    assert unnamed_files(list_files(spark, land, recursive=True)).count() == 1
    with pytest.raises(SystemExit, match="trips-jan"):
        jobs.landing_units(spark, land, None)
    job = IncrementalLoad(land, f"{root}/t", f"{root}/l", f"{root}/ckpt", contract=C)
    with pytest.raises(Exception, match="trips-jan"):
        job.run_available(spark)
    assert vendors(spark, f"{root}/t") == []
    # told again by the next run, or reported and the rest loaded
    job.unnamed, job.unnamed_root = "report", f"{root}/odd"
    job.run_available(spark)
    assert vendors(spark, f"{root}/t") == [(1, JAN)]
    assert spark.read.parquet(f"{root}/odd").count() == 1


def test_parts_of_one_delivery_in_two_batches(spark, scratch):
    root = scratch("parts")
    job = IncrementalLoad(f"{root}/landing", f"{root}/t", f"{root}/l", f"{root}/ckpt", contract=C)
    for i, v in enumerate((1, 2)):
        one = f"{root}/make{i}"
        [made] = write_month_files(spark, rows(spark, (v, JAN)), one, layout="file")
        fs.rename(spark, made, f"{job.landing}/yellow_tripdata_2020_01-0000{i}.parquet")
        job.run_available(spark)
    assert vendors(spark, job.target_root) == [(1, JAN), (2, JAN)]


def test_older_delivery_that_comes_late_is_left_out(spark, scratch):
    root = scratch("older")
    job = IncrementalLoad(f"{root}/landing", f"{root}/t", f"{root}/l", f"{root}/ckpt", contract=C)
    [new] = write_month_files(spark, rows(spark, (2, JAN)), job.landing, layout="file")
    job.run_available(spark)
    fs.delete(spark, new)  # moved away meanwhile: only the ledger knows of it
    [old] = write_month_files(spark, rows(spark, (1, JAN)), f"{job.landing}/late", layout="file")
    fs.set_modified(spark, old, int(time.time() * 1000) - 90 * 86_400_000)
    job.run_available(spark)
    assert vendors(spark, job.target_root) == [(2, JAN)]


def test_null_names_stay(spark):
    df = spark.createDataFrame([(1, "a.txt"), (2, None), (3, "a.txt"), (4, None)], "id int, name string")
    have = spark.createDataFrame([("b.txt",), (None,)], "name string")
    for existing in (None, have):
        out = {r.id: r.final_name for r in number_taken_names(df, "name", ["id"], existing=existing).collect()}
        assert out == {1: "a.txt", 2: None, 3: "a (1).txt", 4: None}


def test_no_machine_local_scratch_on_a_cluster():
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_jobs_use_utc(spark, scratch):
    from monthwise import jobs

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        land, root = scratch("tz"), scratch("tz-out")
        df = spark.createDataFrame([("2020-03-08 02:30:00", dt.date(2020, 3, 1))], "tpep_pickup_datetime string, date date")
        write_month_files(spark, df, land, layout="file")
        jobs.main(["load", "--landing", land, "--target", f"{root}/t", "--ledger", f"{root}/l"], spark)
        back = read_target(spark, f"{root}/t").select(F.date_format("tpep_pickup_datetime", "HH:mm").alias("t")).first().t
        assert back == "02:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_month_is_not_null(spark, scratch):
    """NOT NULL on the target's key; Spark keeps no such constraint for a plain
    column of a file table, so the ledger never writes a row without a month."""
    import uuid

    db = f"n_{uuid.uuid4().hex[:8]}"
    t, _ = catalog.init_tables(spark, scratch("ddl"), db=db, stage_db=f"{db}_s", contract=C)
    assert "date DATE NOT NULL" in spark.sql(f"SHOW CREATE TABLE {t}").first()[0]
    root = scratch("ledger")
    ledger.ledger_replace(spark.createDataFrame([(1, JAN), (2, None)], "cnt long, date date"), root)
    assert [(r.cnt, r.date) for r in ledger.read_ledger(spark, root).collect()] == [(1, JAN)]


def test_no_sort_before_the_month_write(spark, scratch):
    """With a few open month files Spark plans no local sort of every row."""
    import uuid

    db = f"w_{uuid.uuid4().hex[:8]}"
    t, _ = catalog.init_tables(spark, scratch("sort"), db=db, stage_db=f"{db}_s", contract=C)
    conformed(spark, (1, JAN)).createOrReplaceTempView("to_write")
    plan = lambda: spark.sql(f"EXPLAIN INSERT INTO {t} SELECT * FROM to_write").first()[0]
    assert "Sort" in plan()
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with load_module._open_writers(spark, load_module.OPEN_MONTHS):
        assert "Sort" not in plan()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before

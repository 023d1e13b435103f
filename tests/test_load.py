"""Publish / reload / retire / ledger properties (safe to repeat, others
untouched, empty reload retires, gates leave the target as it was)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions.conform import conform
from monthwise.operators.checks import GateError, decision_frame, month_counts, null_violations, range_violations
from monthwise.operators.ledger import read_ledger, reconcile
from monthwise.plans.load import load_months, read_target
from monthwise.plans.views import orders_trips_raw
from monthwise.session import local_path

from .conftest import SF_SMALL

C = TRIP_CONTRACT.with_timestamp_ntz()
M = dt.date(1998, 7, 1)


def trips(spark):
    return conform(orders_trips_raw(spark, SF_SMALL), C)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def month_files(root, month):
    d = os.path.join(local_path(root), f"date={month.isoformat()}")
    return sorted((f, os.path.getmtime(os.path.join(d, f))) for f in os.listdir(d) if f.endswith(".parquet"))


@pytest.fixture()
def loaded(spark, scratch):
    root = scratch("load")
    target, ledger = f"{root}/target", f"{root}/ledger"
    load_months(spark, trips(spark), target, ledger, contract=C, rebalance=True)
    return target, ledger


def test_load_then_read_equals_input(spark, loaded):
    target, ledger = loaded
    assert rows(read_target(spark, target, C)) == rows(trips(spark))
    counts = {r.date: r.cnt for r in month_counts(trips(spark)).collect()}
    assert {r.date: r.cnt for r in read_ledger(spark, ledger).collect()} == counts


def test_reload_is_idempotent_and_leaves_other_months(spark, loaded):
    target, ledger = loaded
    before = read_target(spark, target, C)
    before_rows = rows(before)
    other = dt.date(1996, 3, 1)
    other_files = month_files(target, other)
    month = trips(spark).where(F.col("date") == F.lit(M))
    for _ in range(2):
        load_months(spark, month, target, ledger, months=[M], contract=C)
    assert rows(read_target(spark, target, C)) == before_rows
    assert month_files(target, other) == other_files  # not rewritten
    lg = read_ledger(spark, ledger)
    assert lg.where(F.col("date") == F.lit(M)).count() == 1


def test_empty_reload_retires_month_and_counts_zero(spark, loaded):
    target, ledger = loaded
    empty = trips(spark).where(F.lit(False))
    rep = load_months(spark, empty, target, ledger, months=[M], contract=C)
    assert rep.retired == [M]
    t = read_target(spark, target, C)
    assert t.where(F.col("date") == F.lit(M)).count() == 0
    assert t.count() == trips(spark).where(F.col("date") != F.lit(M)).count()
    row = read_ledger(spark, ledger).where(F.col("date") == F.lit(M)).collect()
    assert [r.cnt for r in row] == [0]


def test_gate_failures_leave_target_unchanged(spark, loaded):
    target, ledger = loaded
    before = rows(read_target(spark, target, C))
    ledger_before = rows(read_ledger(spark, ledger))
    bad_null = trips(spark).withColumn("date", F.lit(None).cast("date"))
    with pytest.raises(GateError):
        load_months(spark, bad_null, target, ledger, contract=C, months=[M])
    out_of_range = trips(spark)  # many months, only one requested
    with pytest.raises(GateError):
        load_months(spark, out_of_range, target, ledger, contract=C, months=[M])
    null_vendor = trips(spark).where(F.col("date") == F.lit(M)).withColumn("vendor_id", F.lit(None).cast("long"))
    with pytest.raises(GateError):
        load_months(spark, null_vendor, target, ledger, contract=C, months=[M], not_null=("date", "vendor_id"))
    assert rows(read_target(spark, target, C)) == before
    assert rows(read_ledger(spark, ledger)) == ledger_before


def test_schema_gate(spark, scratch):
    root = scratch("schema")
    wrong = trips(spark).withColumn("airport_fee", F.col("airport_fee").cast("double"))
    with pytest.raises(GateError):
        load_months(spark, wrong, f"{root}/t", f"{root}/l", contract=C)


def test_row_limit_keeps_full_count_in_ledger(spark, scratch):
    root = scratch("limit")
    load_months(spark, trips(spark), f"{root}/t", f"{root}/l", contract=C, row_limit=10, rebalance=True)
    per_month = {r.date: r.cnt for r in month_counts(read_target(spark, f"{root}/t", C)).collect()}
    full = {r.date: r.cnt for r in month_counts(trips(spark)).collect()}
    assert per_month == {m: min(10, c) for m, c in full.items()}
    assert {r.date: r.cnt for r in read_ledger(spark, f"{root}/l").collect()} == full


def test_violation_frames(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 1), (None, 2), (dt.date(2020, 1, 2), None)], "date date, vendor_id long"
    )
    v = null_violations(df, ["date", "vendor_id"]).select("violation").collect()
    assert sorted(r.violation for r in v) == ["date", "vendor_id"]
    lo, hi = F.lit(dt.date(2020, 1, 1)), F.lit(dt.date(2020, 1, 2))
    assert range_violations(df, lo, hi).count() == 2  # null date and 01-02


def test_decision_and_reconcile(spark):
    months = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 2, 1),)], "date date")
    counts = spark.createDataFrame([(dt.date(2020, 1, 1), 5)], "date date, cnt long")
    d = {r.date: (r.cnt, r.action) for r in decision_frame(months, counts).collect()}
    assert d == {dt.date(2020, 1, 1): (5, "attach"), dt.date(2020, 2, 1): (0, "drop")}
    table = spark.createDataFrame([(dt.date(2020, 1, 1), 5), (dt.date(2020, 2, 1), 3)], "date date, cnt long")
    ledger = spark.createDataFrame([(5, dt.date(2020, 1, 1)), (4, dt.date(2020, 2, 1)), (1, dt.date(2020, 3, 1))],
                                   "cnt long, date date")
    st = {r.date: r.status for r in reconcile(table, ledger).collect()}
    assert st == {dt.date(2020, 1, 1): "match", dt.date(2020, 2, 1): "count_mismatch",
                  dt.date(2020, 3, 1): "missing_in_table"}


def test_persist_option_gives_same_result(spark, scratch):
    root = scratch("persist")
    rep = load_months(spark, trips(spark), f"{root}/t", f"{root}/l", contract=C, rebalance=True, persist=True)
    assert len(rep.published) == trips(spark).select("date").distinct().count()
    assert rows(read_target(spark, f"{root}/t", C)) == rows(trips(spark))
    assert not trips(spark).is_cached


def test_month_slice_time_range_same_rows_and_pushed(spark):
    from monthwise.operators.checks import month_slice

    t = trips(spark)
    plain = t.where(F.col("date") == F.lit(M))
    sliced = month_slice(t, F.lit(M), time_col="tpep_pickup_datetime")
    assert rows(sliced) == rows(plain) and len(rows(plain)) > 0
    plan = sliced._sc._jvm.PythonSQLUtils.explainString(sliced._jdf.queryExecution(), "simple")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    # without a time column it is the plain equality
    assert rows(month_slice(t, F.lit(M))) == rows(plain)


def test_hot_month_is_split_over_tasks_on_publish(spark, scratch):
    # one month holds over a third of all rows; the rebalanced publish must
    # not write it from one task (AQE splits the rebalance partition)
    t = trips(spark)
    root = scratch("hot")
    # staged as several files so the scan has several splits (map tasks):
    # AQE splits a partition along map outputs
    t.withColumn("date", F.when(F.col("pu_location_id") % 3 == 0, F.lit(M)).otherwise(F.col("date"))).repartition(
        8
    ).write.parquet(f"{root}/in")
    hot = spark.read.schema(t.schema).parquet(f"{root}/in")
    n_hot = hot.where(F.col("date") == F.lit(M)).count()
    assert n_hot * 3 > t.count()
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    spark.conf.set(key, "4k")
    try:
        load_months(spark, hot, f"{root}/t", f"{root}/l", contract=C, rebalance=True)
    finally:
        spark.conf.set(key, prev)
    assert len(month_files(f"{root}/t", M)) > 1
    got = read_target(spark, f"{root}/t", C)
    assert got.where(F.col("date") == F.lit(M)).count() == n_hot
    assert rows(got) == rows(hot)


def test_ledger_compaction_keeps_the_view(spark, scratch):
    from monthwise.operators.ledger import compact_ledger, ledger_replace, read_ledger_log
    from monthwise.sources import fs

    root = scratch("ledger")
    m2 = dt.date(1998, 8, 1)
    for cnt in (5, 6, 7):
        ledger_replace(spark.createDataFrame([(cnt, M), (cnt * 10, m2)], "cnt bigint, date date"), root)
    ledger_replace(spark.createDataFrame([(0, M)], "cnt bigint, date date"), root)
    before = rows(read_ledger(spark, root))
    assert before == [(0, M), (70, m2)]
    assert compact_ledger(spark, root) == 4
    assert [f for f in fs.list_dir(spark, root) if f.endswith(".parquet")] and rows(read_ledger(spark, root)) == before
    assert read_ledger_log(spark, root).count() == 2
    # a later run still supersedes the compacted entries
    ledger_replace(spark.createDataFrame([(9, m2)], "cnt bigint, date date"), root)
    assert rows(read_ledger(spark, root)) == [(0, M), (9, m2)]
    assert compact_ledger(spark, root) == 2 and rows(read_ledger(spark, root)) == [(0, M), (9, m2)]

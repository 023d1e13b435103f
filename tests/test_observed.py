"""Gates and lost values as metrics of the pass that writes; content digests."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions.conform import LOST, conform
from monthwise.operators import observed
from monthwise.operators.checks import GateError
from monthwise.operators.ledger import (
    compact_ledger,
    month_digests,
    read_ledger,
    read_ledger_digests,
    reconcile,
)
from monthwise.plans import load
from monthwise.plans.load import load_months, read_target
from monthwise.session import local_path

C = TRIP_CONTRACT.with_timestamp_ntz()
JAN, FEB, MAR = (dt.date(2020, m, 1) for m in (1, 2, 3))


def raw(spark, rows):
    return spark.createDataFrame(rows, "VendorID string, passenger_count string, airport_fee long, date date")


ROWS = [("1", "x", 5, JAN), ("a", "2.5", 3_000_000_000, JAN), ("b", None, None, JAN), ("7", "y", 1, FEB), (None, "1", 1, FEB)]
LOST_ROWS = [(JAN, "airport_fee", 1), (JAN, "passenger_count", 1), (JAN, "vendor_id", 2), (FEB, "passenger_count", 1)]


def tuples(rows):
    return sorted((r["date"], r["column"], r["lost"]) for r in rows)


def test_lost_values_by_grouping(spark):
    df = conform(raw(spark, ROWS), C, lost=True)
    assert df.columns == [*C.names, LOST]
    assert tuples(observed.lost_values(df, C).collect()) == LOST_ROWS
    # the other columns are as without
    assert sorted(map(str, df.drop(LOST).collect())) == sorted(map(str, conform(raw(spark, ROWS), C).collect()))


@pytest.mark.parametrize("tracked", [50_000, 2])
@pytest.mark.parametrize("limit", [None, 1])
def test_load_counts_lost_values(spark, scratch, monkeypatch, tracked, limit):
    monkeypatch.setattr(observed, "TRACKED", tracked)  # 2: too few, so counted by grouping
    root = scratch("lost")
    df = conform(raw(spark, ROWS), C, lost=True)
    report = load_months(spark, df, f"{root}/t", f"{root}/l", months=[JAN, FEB, MAR], contract=C, row_limit=limit)
    assert tuples(report.lost) == LOST_ROWS == tuples(report.lost_frame(spark).collect())
    assert [(r.date, r.cnt, r.action) for r in report.decisions] == [(JAN, 3, "attach"), (FEB, 2, "attach"), (MAR, 0, "drop")]
    out = read_target(spark, f"{root}/t", C)
    assert out.columns == C.names and out.count() == (5 if limit is None else 2)


def test_too_many_lost_values_fail_the_load(spark, scratch):
    root = scratch("many-lost")
    df = conform(raw(spark, ROWS), C, lost=True)
    for limit in (None, 5):
        with pytest.raises(GateError, match="2020-01-01 vendor_id: 2"):
            load_months(spark, df, f"{root}/t", f"{root}/l", contract=C, max_lost=1, row_limit=limit)
    assert read_target(spark, f"{root}/t", C).count() == 0
    assert read_ledger(spark, f"{root}/l").count() == 0
    assert not [f for _, _, fs in os.walk(local_path(root)) for f in fs if f.endswith(".parquet")]
    assert load_months(spark, df, f"{root}/t", f"{root}/l", contract=C, max_lost=2).published == [JAN, FEB]


def test_the_load_reads_its_rows_once(spark, scratch, monkeypatch):
    root = scratch("once")
    read = spark.sparkContext.accumulator(0)
    base = raw(spark, ROWS)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = conform(base.mapInArrow(seen, base.schema), C, lost=True)
    monkeypatch.setattr(load, "month_gates", None)  # nothing is read back
    monkeypatch.setattr(load, "read_target", None)
    report = load_months(spark, df, f"{root}/t", f"{root}/l", months=[JAN, FEB], contract=C, rebalance=True)
    assert [r.cnt for r in report.decisions] == [3, 2]
    assert read.value == len(ROWS)


@pytest.mark.parametrize("months", [None, [JAN], [JAN, FEB]])
def test_gates_fail_as_before(spark, scratch, months):
    root = scratch("gate")
    df = conform(raw(spark, [*ROWS, ("1", "1", 1, None)]), C)
    with pytest.raises(GateError, match="out_of_range"):
        load_months(spark, df, f"{root}/t", f"{root}/l", months=months, contract=C)
    with pytest.raises(GateError, match="null_vendor_id"):
        load_months(spark, conform(raw(spark, ROWS), C), f"{root}/t", f"{root}/l", contract=C, not_null=("date", "vendor_id"))
    assert read_target(spark, f"{root}/t", C).count() == 0


def test_empty_frame_and_many_months(spark, scratch):
    root = scratch("empty")
    none = conform(raw(spark, []), C, lost=True)
    report = load_months(spark, none, f"{root}/t", f"{root}/l", months=[JAN], contract=C)
    assert [(r.cnt, r.action) for r in report.decisions] == [(0, "drop")] and report.lost == []
    assert load_months(spark, none, f"{root}/t", f"{root}/l", contract=C).decisions == []
    many = spark.range(900).select(
        F.col("id").alias("VendorID"), F.add_months(F.lit(JAN), (F.col("id") % 300).cast("int")).alias("date")
    )
    report = load_months(spark, conform(many, C), f"{root}/m", f"{root}/ml", contract=C, rebalance=True)
    assert [r.cnt for r in report.decisions] == [3] * 300


def test_digest_ignores_order_and_files_not_content(spark):
    df = conform(raw(spark, ROWS), C)
    one = {r.date: r.digest for r in month_digests(df).collect()}
    assert one == {r.date: r.digest for r in month_digests(df.repartition(4).orderBy("vendor_id")).collect()}
    swapped = conform(raw(spark, [("1", "9", 5, JAN), *ROWS[1:]]), C)
    two = {r.date: r.digest for r in month_digests(swapped).collect()}
    assert two[JAN] != one[JAN] and two[FEB] == one[FEB]
    # a value in another column, and a row twice instead of two rows
    pairs = [[("1", None, None, JAN)], [(None, "1", None, JAN)], [("1", None, None, JAN)] * 2, [("2", None, None, JAN)] * 2, []]
    got = [tuple(r.digest for r in month_digests(conform(raw(spark, p), C)).collect()) for p in pairs]
    assert len(set(got)) == len(pairs)


def test_reconcile_by_content(spark, scratch):
    root = scratch("content")
    df = conform(raw(spark, ROWS), C)
    load_months(spark, df, f"{root}/t", f"{root}/l", contract=C, digest=True)
    load_months(spark, df.where(F.col("date") == FEB), f"{root}/t", f"{root}/l", months=[FEB], contract=C)

    def status():
        rows = reconcile(month_digests(read_target(spark, f"{root}/t", C)), read_ledger_digests(spark, f"{root}/l"))
        return {r.date: r.status for r in rows.collect()}

    assert status() == {JAN: "match", FEB: "unverified"}
    compact_ledger(spark, f"{root}/l")
    assert status() == {JAN: "match", FEB: "unverified"}
    other = conform(raw(spark, [("1", "x", 6, JAN), *ROWS[1:3]]), C)
    load.publish_months(other, f"{root}/t")
    assert status() == {JAN: "content_mismatch", FEB: "unverified"}
    load.publish_months(other.limit(2), f"{root}/t")
    assert status()[JAN] == "count_mismatch"

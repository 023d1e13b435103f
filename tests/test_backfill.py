"""Backfill: due months a few at a time, failures alone, resumption."""

import datetime as dt
import threading
import time

import pytest

from monthwise.contract import TRIP_CONTRACT
from monthwise.operators.ledger import read_ledger
from monthwise.plans import backfill as bf
from monthwise.plans import load
from monthwise.plans.load import read_target
from monthwise.sources.landing import write_month_files

C = TRIP_CONTRACT.with_timestamp_ntz()
START, END = dt.date(2020, 1, 1), dt.date(2020, 7, 1)


def deliver(spark, land, values):
    rows = [(v, dt.date(2020, m, 1)) for m, vs in values.items() for v in vs]
    write_month_files(spark, spark.createDataFrame(rows, "VendorID string, date date"), land)


def states(rows):
    return {r.date.month: (r.status, r.cnt) for r in rows}


def test_failed_month_is_left_due(spark, scratch):
    root = scratch("bf")
    go = lambda: bf.backfill(spark, f"{root}/in", f"{root}/t", f"{root}/l", START, END, contract=C, max_lost=0)
    deliver(spark, f"{root}/in", {1: ["1"], 2: ["2", "3"], 3: ["x", "4"], 4: ["5"], 6: ["6"]})
    done = go()
    assert states(done) == {1: ("loaded", 1), 2: ("loaded", 2), 3: ("failed", None), 4: ("loaded", 1), 5: ("no_file", None), 6: ("loaded", 1), 7: ("no_file", None)}
    assert "vendor_id" in next(r.error for r in done if r.status == "failed")
    assert [r.date.month for r in bf.due_months(spark, f"{root}/l", START, END).sort("date").collect()] == [3, 5, 7]
    deliver(spark, f"{root}/in", {3: ["4"], 5: ["8"]})
    assert states(go()) == {3: ("loaded", 1), 5: ("loaded", 1), 7: ("no_file", None)}
    assert {r.date.month: r.cnt for r in read_ledger(spark, f"{root}/l").collect()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1}
    assert read_target(spark, f"{root}/t", C).count() == 7
    assert bf.report_frame(spark, done).count() == 7


def test_at_most_so_many_at_once_in_pools(spark, scratch, monkeypatch):
    root = scratch("pools")
    deliver(spark, f"{root}/in", {m: ["1"] for m in range(1, 8)})
    lock, now, most, pools = threading.Lock(), [0], [0], set()
    whole = load.load_months

    def slow(spark, *args, **kwargs):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        time.sleep(0.3)
        try:
            return whole(spark, *args, **kwargs)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(bf, "load_months", slow)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    done = bf.backfill(spark, f"{root}/in", f"{root}/t", f"{root}/l", START, END, at_once=2, contract=C)
    assert {r.status for r in done} == {"loaded"} and most[0] == 2
    assert pools <= {"backfill-0", "backfill-1"} and pools
    assert spark.conf.get(name) == before  # put back by the last write
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(ValueError):
        bf.backfill(spark, f"{root}/in", f"{root}/t", f"{root}/l", START, END, at_once=0)

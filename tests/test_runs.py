"""Runs published at once: crashes leave all old or all new, and are finished."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions.conform import conform
from monthwise.operators.checks import GateError
from monthwise.operators.ledger import read_ledger
from monthwise.plans import catalog, runs
from monthwise.sources import fs

C = TRIP_CONTRACT.with_timestamp_ntz()
JAN, FEB, MAR = (dt.date(2020, m, 1) for m in (1, 2, 3))


def frame(spark, *rows):
    return conform(spark.createDataFrame(list(rows), "VendorID long, date date"), C)


@pytest.fixture()
def place(spark, scratch):
    root, db = scratch("runs"), f"mw_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, db)
    view = f"{db}.ny_yellow"
    runs.create_published(spark, view, f"{root}/t", C)
    runs.create_published(spark, view, f"{root}/t", C)
    return view, f"{root}/l", f"{root}/t"


def seen(spark, view):
    spark.catalog.refreshTable(view)
    return sorted((r.date.month, r.vendor_id) for r in spark.table(view).collect())


def counted(spark, ledger):
    return {r.date.month: r.cnt for r in read_ledger(spark, ledger).collect()}


def test_runs_replace_add_and_retire(spark, place):
    view, ledger, _ = place
    assert seen(spark, view) == []
    runs.load_run(spark, frame(spark, (1, JAN), (2, FEB)), view, ledger, contract=C, digest=True)
    assert seen(spark, view) == [(1, 1), (2, 2)]
    report = runs.load_run(spark, frame(spark, (20, FEB), (30, MAR), (31, MAR)), view, ledger, months=[JAN, FEB, MAR], contract=C)
    assert seen(spark, view) == [(2, 20), (3, 30), (3, 31)]
    assert (report.published, report.retired) == ([FEB, MAR], [JAN])
    assert counted(spark, ledger) == {1: 0, 2: 1, 3: 2}
    assert runs.finish_runs(spark, view, ledger, C) == []


def test_failed_gate_leaves_nothing(spark, place):
    view, ledger, root = place
    runs.load_run(spark, frame(spark, (1, JAN)), view, ledger, contract=C)
    with pytest.raises(GateError):
        runs.load_run(spark, frame(spark, (9, JAN), (9, FEB)), view, ledger, months=[JAN], contract=C)
    assert seen(spark, view) == [(1, 1)] and len(fs.list_dir(spark, f"{root}/_runs")) == 1
    with pytest.raises(ValueError):
        runs.load_run(spark, frame(spark, (9, JAN)), view, ledger, contract=C, row_limit=0)


@pytest.mark.parametrize("step", ["_record", "attach_months", "_switch", "record_counts"])
def test_a_crash_leaves_all_old_or_all_new(spark, place, monkeypatch, step):
    view, ledger, root = place
    runs.load_run(spark, frame(spark, (1, JAN), (2, FEB)), view, ledger, contract=C)
    new = frame(spark, (10, JAN), (20, FEB), (30, MAR))
    whole = getattr(runs, step)

    def crash(*args, **kwargs):
        if step == "attach_months":  # between two months
            months = dict(list(args[2].items())[:1])
            whole(args[0], args[1], months, *args[3:])
        raise RuntimeError("crash")

    monkeypatch.setattr(runs, step, crash)
    with pytest.raises(RuntimeError, match="crash"):
        runs.load_run(spark, new, view, ledger, contract=C)
    monkeypatch.setattr(runs, step, whole)
    old_rows, new_rows = [(1, 1), (2, 2)], [(1, 10), (2, 20), (3, 30)]
    assert seen(spark, view) == (new_rows if step == "record_counts" else old_rows)
    [(_, done)] = runs.finish_runs(spark, view, ledger, C)
    assert done == ("dropped" if step == "_record" else "finished")
    assert seen(spark, view) == (old_rows if step == "_record" else new_rows)
    assert counted(spark, ledger) == ({1: 1, 2: 1} if step == "_record" else {1: 1, 2: 1, 3: 1})
    assert runs.finish_runs(spark, view, ledger, C) == []


def test_the_next_run_finishes_the_last_one_first(spark, place, monkeypatch):
    view, ledger, _ = place
    switch = runs._switch
    monkeypatch.setattr(runs, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        runs.load_run(spark, frame(spark, (1, JAN), (2, FEB)), view, ledger, contract=C)
    monkeypatch.setattr(runs, "_switch", switch)
    runs.load_run(spark, frame(spark, (20, FEB)), view, ledger, contract=C)
    assert seen(spark, view) == [(1, 1), (2, 20)] and counted(spark, ledger) == {1: 1, 2: 1}


def test_vacuum_keeps_what_is_read(spark, place):
    view, ledger, root = place
    for i in range(3):
        runs.load_run(spark, frame(spark, (i, JAN)) if i else frame(spark, (0, JAN), (5, FEB)), view, ledger, contract=C)
    assert runs.vacuum_published(spark, view) == []  # too young
    removed = runs.vacuum_published(spark, view, keep=dt.timedelta(0))
    assert len(removed) == 2 and seen(spark, view) == [(1, 2), (2, 5)]
    db = view.split(".")[0]
    assert [t.name for t in spark.catalog.listTables(db) if "_run_" in t.name] == [runs.published_table(spark, view).split(".")[1]]
    assert spark.table(view).where(F.col("date") == F.lit(FEB)).count() == 1

"""The command-line jobs, run in-process on landing files made from orders."""

import datetime as dt
import json
import uuid

import pytest
from monthwise import jobs
from monthwise.plans.views import orders_trips_raw
from monthwise.sources.landing import write_month_files

from .conftest import SF_SMALL


def run(spark, capsys, *argv):
    jobs.main(list(argv), spark)
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]


def test_load_reconcile_backlog_compact(spark, scratch, capsys):
    root = scratch("jobs")
    land, target, ledger = f"{root}/landing", f"{root}/target", f"{root}/ledger"
    raw = orders_trips_raw(spark, SF_SMALL)
    write_month_files(spark, raw, land)
    n_months = raw.select("date").distinct().count()

    out = run(spark, capsys, "load", "--landing", land, "--target", target, "--ledger", ledger, "--ntz")
    assert len(out) == n_months and all(r["action"] == "attach" for r in out)
    # one month again, by the reference's run-date argument
    out = run(spark, capsys, "load", "--landing", land, "--target", target, "--ledger", ledger, "--ntz",
              "--run-date", "1998-07-01")
    assert [r["date"] for r in out] == ["1998-07-01"]
    with pytest.raises(SystemExit):
        run(spark, capsys, "load", "--landing", land, "--target", target, "--ledger", ledger, "--run-date", "2030-01-01")

    rec = run(spark, capsys, "reconcile", "--target", target, "--ledger", ledger, "--ntz")
    assert len(rec) == n_months and {r["status"] for r in rec} == {"match"}
    loaded = {r.date for r in raw.select("date").distinct().collect()}
    calendar = [dt.date(y, m, 1) for y in range(1995, 2003) for m in range(1, 13)]
    due = run(spark, capsys, "backlog", "--ledger", ledger, "--start", "1995-01-01", "--end", "2002-12-01")
    assert [dt.date.fromisoformat(r["date"]) for r in due] == [m for m in calendar if m not in loaded]
    assert run(spark, capsys, "compact-ledger", "--ledger", ledger)[0]["files_removed"] == 2


def test_init_and_load_table(spark, scratch, capsys):
    root = scratch("jobs-table")
    land = f"{root}/landing"
    write_month_files(spark, orders_trips_raw(spark, SF_SMALL), land)
    db = f"j_{uuid.uuid4().hex[:8]}"
    t = run(spark, capsys, "init", "--root", f"{root}/wh", "--db", db, "--stage-db", f"{db}_s", "--ntz")[0]
    out = run(spark, capsys, "load-table", "--landing", land, "--table", t["target"], "--ledger-table", t["ledger"],
              "--ntz", "--months", "1998-06,1998-07")
    assert [r["date"] for r in out] == ["1998-06-01", "1998-07-01"]
    got = {r.date for r in spark.sql(f"SELECT DISTINCT date FROM {t['target']}").collect()}
    assert got == {dt.date(1998, 6, 1), dt.date(1998, 7, 1)}
    rec = run(spark, capsys, "reconcile", "--table", t["target"], "--ledger-table", t["ledger"])
    assert [(r["date"], r["status"]) for r in rec] == [("1998-06-01", "match"), ("1998-07-01", "match")]
    due = run(spark, capsys, "backlog", "--ledger-table", t["ledger"], "--start", "1998-05-01", "--end", "1998-08-01")
    assert [r["date"] for r in due] == ["1998-05-01", "1998-08-01"]


def test_stage_jdbc_writes_month_tables_and_counts(spark, scratch, capsys):
    from monthwise.sources.jdbc import derby_memory, read_table

    root = scratch("jobs-jdbc")
    land = f"{root}/landing"
    raw = orders_trips_raw(spark, SF_SMALL)
    write_month_files(spark, raw, land)
    db = derby_memory(f"stage_{uuid.uuid4().hex[:8]}")
    out = run(spark, capsys, "stage-jdbc", "--landing", land, "--url", db.url, "--driver", db.driver, "--ntz",
              "--months", "1998-06,1998-07", "--ledger-table", "taxi.ny_yellow_cnt", "--row-limit", "10",
              "--parallel", "2")
    want = {r.date: r.n for r in raw.groupBy("date").count().withColumnRenamed("count", "n").collect()}
    m6, m7 = dt.date(1998, 6, 1), dt.date(1998, 7, 1)
    assert [(r["date"], r["cnt"], r["stage_table"]) for r in out] == [
        ("1998-06-01", want[m6], "stage.yellow_tripdata_1998_06"), ("1998-07-01", want[m7], "stage.yellow_tripdata_1998_07")
    ]
    assert read_table(spark, db, "stage.yellow_tripdata_1998_07").count() == 10
    ledger = {r["date"]: r["cnt"] for r in read_table(spark, db, "taxi.ny_yellow_cnt").collect()}
    assert ledger == {m6: want[m6], m7: want[m7]}


def test_stream_catches_up_once(spark, scratch, capsys):
    from monthwise.contract import TRIP_CONTRACT
    from monthwise.plans.load import read_target

    root = scratch("jobs-stream")
    land = f"{root}/landing"
    raw = orders_trips_raw(spark, SF_SMALL)
    write_month_files(spark, raw, land)
    args = ["stream", "--landing", land, "--target", f"{root}/t", "--ledger", f"{root}/l", "--checkpoint", f"{root}/c",
            "--ntz"]
    assert run(spark, capsys, *args) == [{"status": "caught_up"}]
    assert read_target(spark, f"{root}/t", TRIP_CONTRACT.with_timestamp_ntz()).count() == raw.count()
    run(spark, capsys, *args)  # nothing new: the target stays as it is
    assert read_target(spark, f"{root}/t", TRIP_CONTRACT.with_timestamp_ntz()).count() == raw.count()
    with pytest.raises(SystemExit):
        run(spark, capsys, "stream", "--landing", land, "--checkpoint", f"{root}/c2")

"""Command-line jobs: the monthly load and its companions as Spark jobs.

Run with ``spark-submit monthwise/jobs.py <command> ...`` on a cluster (the
session comes from the submit settings), or ``python -m monthwise.jobs``.
Every command prints one JSON line per month (or per result row); only such
month-sized results reach the driver.

  init            create the databases, the partitioned target and the ledger table
  load            load months from a landing folder into a target folder
  load-table      the same into a catalog table (per-month location swap)
  backlog         months due since a start month that the ledger lacks
  backfill        load the due months from a landing folder, a few at a time
  reconcile       compare the target's counts per month with the ledger
  stream          load every newly arrived landing file once
  stage-jdbc      each month to a JDBC stage table, counts to a JDBC count table
  compact-ledger  rewrite the ledger log as its latest entries
  vacuum          delete month folders that a catalog table no longer points to
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

if __package__ in (None, ""):
    # run as a script (spark-submit monthwise/jobs.py): put the package root
    # on the path; executors need nothing, every operator runs in the JVM
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions.calendar import LANDING_PREFIX, calendar
from monthwise.operators.checks import month_counts
from monthwise.operators.ledger import compact_ledger, month_digests, read_ledger, read_ledger_digests, reconcile
from monthwise.plans import catalog
from monthwise.plans.backfill import AT_ONCE, backfill
from monthwise.plans.load import load_months, read_target
from monthwise.sources.landing import list_files, month_units, scan_months, unnamed_files
from monthwise.streaming.incremental import IncrementalLoad


def _month(text: str) -> dt.date:
    """``2020-02``, ``2020_02`` or a run date ``2020-02-01`` -> first of month."""
    t = text.strip().replace("_", "-")
    d = dt.date.fromisoformat(t if len(t) > 7 else t + "-01")
    return d.replace(day=1)


def _months(args) -> list[dt.date] | None:
    if args.run_date:
        return [_month(args.run_date)]
    if args.months:
        return sorted({_month(m) for m in args.months.split(",") if m.strip()})
    return None


def _contract(args):
    return TRIP_CONTRACT.with_timestamp_ntz() if args.ntz else TRIP_CONTRACT


def _emit(rows) -> None:
    for r in rows:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        print(json.dumps({k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in d.items()}))


def landing_units(spark: SparkSession, landing: str, months, prefix: str = LANDING_PREFIX) -> list:
    """``(date, unit, scans, delivered_at)`` of the requested months (all
    months found when ``months`` is None), one row per month.  A requested
    month without a landing file is an error, not an empty month; so is a
    landing file that names no month."""
    listing = list_files(spark, landing, recursive=True)
    odd = [r["path"] for r in unnamed_files(listing, "path", prefix).select("path").limit(10).collect()]
    if odd:
        raise SystemExit(f"landing files that name no month: {', '.join(odd)}")
    units = month_units(listing, "path", prefix)
    if months is not None:
        wanted = spark.createDataFrame([(m,) for m in months], "date date")
        units = units.join(wanted, "date", "left_semi")
    delivered = F.col("modificationTime").cast("timestamp_ntz").alias("delivered_at")
    picks = sorted(units.select("date", "unit", "scans", delivered).collect())  # one row per month
    missing = sorted(set(months or []) - {r["date"] for r in picks})
    if missing:
        raise SystemExit(f"no landing file for months: {', '.join(m.isoformat() for m in missing)}")
    if not picks:
        raise SystemExit(f"no month files under {landing}")
    return picks


def landing_frame(spark: SparkSession, landing: str, months, contract, prefix: str = LANDING_PREFIX):
    """The conformed rows of the requested months, and the delivery time of
    each month they stand for."""
    picks = landing_units(spark, landing, months, prefix)
    frame = scan_months(spark, [p for r in picks for p in r["scans"]], contract, prefix, lost=True)
    return frame, {r["date"]: r["delivered_at"] for r in picks}


def cmd_init(spark, args) -> None:
    target, ledger = catalog.init_tables(
        spark, args.root, db=args.db, table=args.table, ledger_table=args.ledger_table, stage_db=args.stage_db,
        contract=_contract(args),
    )
    _emit([{"target": target, "ledger": ledger}])


def cmd_load(spark, args) -> None:
    contract = _contract(args)
    frame, delivered = landing_frame(spark, args.landing, _months(args), contract, args.prefix)
    months = list(delivered)
    opts = {"row_limit": args.row_limit, "rebalance": args.rebalance, "delivered": delivered,
            "max_lost": args.max_lost, "digest": args.digest}
    if args.command == "load-table":
        report = catalog.load_months_to_table(
            spark, frame, args.table, args.ledger_table, months=months, contract=contract, **opts
        )
    else:
        report = load_months(spark, frame, args.target, args.ledger, months=months, contract=contract, **opts)
    _emit(report.decisions)
    _emit(report.lost)


def cmd_stage_jdbc(spark, args) -> None:
    """Each month to its own JDBC stage table, its full count recorded in a
    JDBC count table: the reference's load job, one month unit per write.

    Per month: one gate job over that month's unit only (counts, null
    ``date``), then the stage write (replace; ``--truncate`` keeps the table
    definition; ``--row-limit`` stages at most N rows).  At the end the counts
    of the months replace those months' rows of the count table
    (``jdbc.replace_rows``: delete and insert in one transaction), so a rerun
    leaves one row per month.
    """
    from concurrent.futures import ThreadPoolExecutor

    from monthwise.operators.checks import month_gates
    from monthwise.plans.load import decide
    from monthwise.sources.jdbc import JdbcTarget, replace_rows, replace_table

    contract = _contract(args)
    key = contract.partition_key
    db = JdbcTarget(url=args.url, user=args.user, password=args.password, driver=args.driver)

    def stage(r):
        month = r["date"]
        frame = scan_months(spark, r["scans"], contract, args.prefix)
        [d] = decide(spark, month_gates(frame, key, (key,)), [month], key)
        rows = frame if args.row_limit is None else frame.limit(args.row_limit)
        table = args.stage_table.format(month)
        replace_table(rows, db, table, truncate=args.truncate, num_partitions=args.num_partitions)
        return {"date": month, "cnt": d["cnt"], "stage_table": table}

    # months are independent (one table each): --parallel runs that many
    # month jobs at once from driver threads
    picks = landing_units(spark, args.landing, _months(args), args.prefix)
    with ThreadPoolExecutor(max_workers=max(1, args.parallel)) as pool:
        done = list(pool.map(stage, picks))
    _emit(done)
    if args.ledger_table:
        replace_rows(spark, db, args.ledger_table, "date", ["cnt", "date"], [(r["cnt"], r["date"]) for r in done])


def _ledger(spark, args, content: bool = False):
    """The ledger view from ``--ledger`` (a folder) or ``--ledger-table`` (the log table)."""
    read = read_ledger_digests if content else read_ledger
    if getattr(args, "ledger_table", None):
        return read(spark, catalog.table_location(spark, args.ledger_table))
    if not args.ledger:
        raise SystemExit("give --ledger or --ledger-table")
    return read(spark, args.ledger)


def cmd_backlog(spark, args) -> None:
    end = _month(args.end) if args.end else (dt.date.today().replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    due = calendar(spark, _month(args.start), end).join(_ledger(spark, args), "date", "left_anti")
    _emit(due.orderBy("date").collect())


def cmd_backfill(spark, args) -> None:
    end = _month(args.end) if args.end else (dt.date.today().replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    done = backfill(
        spark, args.landing, args.target, args.ledger, _month(args.start), end, args.parallel, _contract(args),
        args.prefix, max_lost=args.max_lost,
    )
    _emit(done)


def cmd_reconcile(spark, args) -> None:
    if args.table:
        frame = spark.table(args.table)
    elif args.target:
        frame = read_target(spark, args.target, _contract(args))
    else:
        raise SystemExit("give --target or --table")
    counts = month_digests(frame) if args.content else month_counts(frame)
    _emit(reconcile(counts, _ledger(spark, args, args.content)).orderBy("date").collect())


def cmd_stream(spark, args) -> None:
    if not args.table and not (args.target and args.ledger):
        raise SystemExit("stream needs --target and --ledger, or --table and --ledger-table")
    job = IncrementalLoad(
        landing=args.landing, target_root=args.target, ledger_root=args.ledger, checkpoint=args.checkpoint,
        contract=_contract(args), prefix=args.prefix, rebalance=args.rebalance,
        table=args.table, ledger_table=args.ledger_table, max_files_per_trigger=args.max_files_per_trigger,
        clean_source=args.clean_source, archive_dir=args.archive_dir, unnamed=args.unnamed, unnamed_root=args.unnamed_root,
        max_lost=args.max_lost,
    )
    if args.every:
        job.start(spark, args.every).awaitTermination()
    else:
        job.run_available(spark)
        _emit([{"status": "caught_up"}])


def cmd_vacuum(spark, args) -> None:
    keep = dt.timedelta(hours=args.keep_hours)
    _emit({"removed": r} for r in catalog.vacuum_runs(spark, args.table, keep=keep))


def cmd_compact(spark, args) -> None:
    _emit([{"files_removed": compact_ledger(spark, args.ledger)}])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="monthwise.jobs", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp, landing=False, target=False, ledger=False):
        sp.add_argument("--ntz", action="store_true", help="timestamps as TIMESTAMP_NTZ (no session time zone)")
        if landing:
            sp.add_argument("--landing", required=True)
            sp.add_argument("--prefix", default=LANDING_PREFIX)
        if target:
            sp.add_argument("--target", required=True, help="root folder of the month-partitioned target")
        if ledger:
            sp.add_argument("--ledger", required=True, help="folder of the count ledger log")

    sp = sub.add_parser("init")
    common(sp)
    sp.add_argument("--root", required=True)
    sp.add_argument("--db", default="taxi")
    sp.add_argument("--table", default="ny_yellow")
    sp.add_argument("--ledger-table", default="ny_yellow_cnt")
    sp.add_argument("--stage-db", default="stage")
    sp.set_defaults(run=cmd_init)

    for name in ("load", "load-table"):
        sp = sub.add_parser(name)
        common(sp, landing=True, target=name == "load", ledger=name == "load")
        if name == "load-table":
            sp.add_argument("--table", required=True)
            sp.add_argument("--ledger-table", required=True)
        g = sp.add_mutually_exclusive_group()
        g.add_argument("--run-date", help="one month, e.g. 2020-02-01 (the reference's argument)")
        g.add_argument("--months", help="comma-separated months, e.g. 2020-01,2020-02")
        sp.add_argument("--row-limit", type=int, default=None, help="stage at most N rows per month")
        sp.add_argument("--rebalance", action="store_true", help="shuffle by month before the write")
        sp.add_argument("--max-lost", type=int, default=None, help="values a month's column may lose in its cast")
        sp.add_argument("--digest", action="store_true", help="record each month's content, for reconcile --content")
        sp.set_defaults(run=cmd_load)

    sp = sub.add_parser("stage-jdbc")
    common(sp, landing=True)
    g = sp.add_mutually_exclusive_group()
    g.add_argument("--run-date", help="one month, e.g. 2020-02-01")
    g.add_argument("--months", help="comma-separated months")
    sp.add_argument("--url", required=True, help="JDBC URL; the driver jar must be on spark.jars")
    sp.add_argument("--user", default=None)
    sp.add_argument("--password", default=None)
    sp.add_argument("--driver", default=None, help="JDBC driver class")
    sp.add_argument("--stage-table", default="stage.yellow_tripdata_{:%Y_%m}", help="name pattern of a month's table")
    sp.add_argument("--ledger-table", default=None, help="JDBC count table (cnt, date); a month's row is replaced")
    sp.add_argument("--row-limit", type=int, default=None)
    sp.add_argument("--truncate", action="store_true", help="replace rows but keep the table definition")
    sp.add_argument("--num-partitions", type=int, default=None, help="at most this many connections")
    sp.add_argument("--parallel", type=int, default=1, help="months staged at once")
    sp.set_defaults(run=cmd_stage_jdbc)

    sp = sub.add_parser("backlog")
    common(sp)
    sp.add_argument("--ledger", default=None, help="path form: folder of the ledger log")
    sp.add_argument("--ledger-table", default=None, help="catalog form: the ledger log table")
    sp.add_argument("--start", default="2010-01-01")
    sp.add_argument("--end", default=None, help="last month due (default: the previous month)")
    sp.set_defaults(run=cmd_backlog)

    sp = sub.add_parser("backfill")
    common(sp, landing=True, target=True, ledger=True)
    sp.add_argument("--start", required=True, help="first month, e.g. 2010-01-01")
    sp.add_argument("--end", default=None, help="last month (default: the one before this)")
    sp.add_argument("--parallel", type=int, default=AT_ONCE, help="months at a time")
    sp.add_argument("--max-lost", type=int, default=None, help="values a month's column may lose in its cast")
    sp.set_defaults(run=cmd_backfill)

    sp = sub.add_parser("reconcile")
    common(sp)
    sp.add_argument("--target", default=None, help="path form: root folder of the target")
    sp.add_argument("--ledger", default=None, help="path form: folder of the ledger log")
    sp.add_argument("--table", default=None, help="catalog form: the target table")
    sp.add_argument("--ledger-table", default=None, help="catalog form: the ledger log table")
    sp.add_argument("--content", action="store_true", help="compare each month's content, not its count alone")
    sp.set_defaults(run=cmd_reconcile)

    sp = sub.add_parser("stream")
    common(sp, landing=True)
    sp.add_argument("--target", default=None, help="path form: root folder of the target")
    sp.add_argument("--ledger", default=None, help="path form: folder of the ledger log")
    sp.add_argument("--table", default=None, help="catalog form: the target table")
    sp.add_argument("--ledger-table", default=None, help="catalog form: the ledger table")
    sp.add_argument("--checkpoint", required=True)
    sp.add_argument("--every", default=None, help="keep running with this trigger interval, e.g. '1 hour'")
    sp.add_argument("--rebalance", action="store_true")
    sp.add_argument("--max-files-per-trigger", type=int, default=None)
    sp.add_argument("--clean-source", choices=("archive", "delete"), default=None, help="after the load; one-file deliveries only")
    sp.add_argument("--archive-dir", default=None)
    sp.add_argument("--unnamed", choices=("fail", "report"), default="fail", help="files that name no month")
    sp.add_argument("--unnamed-root", default=None, help="folder of that report")
    sp.add_argument("--max-lost", type=int, default=None, help="values a month's column may lose in its cast")
    sp.set_defaults(run=cmd_stream)

    sp = sub.add_parser("vacuum")
    common(sp)
    sp.add_argument("--table", required=True)
    sp.add_argument("--keep-hours", type=float, default=24, help="leave folders of runs younger than this")
    sp.set_defaults(run=cmd_vacuum)

    sp = sub.add_parser("compact-ledger")
    common(sp, ledger=True)
    sp.set_defaults(run=cmd_compact)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        # no web UI: stage and task times come from the event log
        spark = (
            SparkSession.builder.appName(f"monthwise-{args.command}").config("spark.ui.enabled", "false").getOrCreate()
        )
    if not args.ntz:
        # the contract's timestamps are times of day without a zone, kept as
        # instants: any other session zone would move or skip some of them
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    args.run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])

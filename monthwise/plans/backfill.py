"""Backfill: the months that are due, as Spark jobs of their own, a few at a time.

The reference's scheduler starts a run per month, three at once, and goes on
with the others when one fails.  Here the due months are the calendar without
the ledger's months, so a backfill that is started again, after a crash or a
failed month, does what is left.  Each month is one ``load_months`` with its
own run folder, gates and ledger entry; a failed one changes nothing.

The months share the cluster through scheduler pools: a month's jobs run in the
pool of its slot, so with ``spark.scheduler.mode=FAIR`` a large month does not
hold up the others (under FIFO the jobs queue; the result is the same).

Many small months are better loaded as one frame (``load_months`` over
``scan_months``); this is for months that must stand or fall alone.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from queue import SimpleQueue

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.calendar import LANDING_PREFIX, calendar
from monthwise.operators.ledger import read_ledger
from monthwise.plans.load import load_months
from monthwise.sources.landing import list_files, month_units, scan_months

#: Fixed value: runs at once in the reference.
AT_ONCE = 3
POOL = "backfill-{}"


def due_months(spark: SparkSession, ledger_root: str, start: dt.date, end: dt.date) -> DataFrame:
    """The calendar's months that the ledger does not have."""
    return calendar(spark, start, end).join(read_ledger(spark, ledger_root), "date", "left_anti")


def backfill(
    spark: SparkSession,
    landing: str,
    target_root: str,
    ledger_root: str,
    start: dt.date,
    end: dt.date,
    at_once: int = AT_ONCE,
    contract: Contract = TRIP_CONTRACT,
    prefix: str = LANDING_PREFIX,
    **options,
) -> list[Row]:
    """Load every due month from its newest delivery, ``at_once`` at a time;
    ``options`` as for ``load_months``.  One row per due month: ``date, status,
    cnt, error``, the status being loaded, failed or no_file."""
    if at_once < 1:
        raise ValueError(f"at least one month at a time, not {at_once}")
    units = month_units(list_files(spark, landing, recursive=True), "path", prefix)
    delivered = F.col("modificationTime").cast("timestamp_ntz").alias("delivered_at")
    due = due_months(spark, ledger_root, start, end).join(units, "date", "left")
    due = sorted(due.select("date", "scans", delivered).collect(), key=lambda r: r["date"])  # a row a month
    slots: SimpleQueue = SimpleQueue()
    for i in range(at_once):
        slots.put(POOL.format(i))

    def load(r: Row) -> Row:
        month, cnt, status, error = r["date"], None, "no_file", None
        if r["scans"]:
            pool = slots.get()
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            try:
                frame = scan_months(spark, r["scans"], contract, prefix, lost=True)
                when = {month: r["delivered_at"]}
                report = load_months(
                    spark, frame, target_root, ledger_root, months=[month], contract=contract, delivered=when, **options
                )
                cnt, status = report.decisions[0]["cnt"], "loaded"
            except Exception as e:  # noqa: BLE001 - a failed month is reported and stays due
                status, error = "failed", f"{type(e).__name__}: {e}"[:500]
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
                slots.put(pool)
        return Row(date=month, status=status, cnt=cnt, error=error)

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        return list(threads.map(load, due))


def report_frame(spark: SparkSession, rows: list[Row]) -> DataFrame:
    return spark.createDataFrame(rows, "date date, status string, cnt bigint, error string")

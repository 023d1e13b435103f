"""A whole run published at once, and the end of runs that a crash has left.

Readers use a *view*.  It selects from the table of the last run, whose
partitions are the folders that the run has written and, for all other
months, the folders of earlier runs: making that table moves no data.  One
``ALTER VIEW`` then changes every month of the run together, so a reader sees
all of them old or all of them new, and none missing.

A run's steps are safe to repeat from its record:

1. the rows are written and gated in a fresh run folder (``write_run``);
2. the decisions are recorded in that folder -- from here on the run is to be
   finished, before that it is to be dropped;
3. the run's table is made and the view is switched to it;
4. the ledger gets the counts, and the folder is marked done.

``finish_runs`` takes every run without the mark through its missing steps, or
deletes the folder if nothing was recorded.  ``load_run`` calls it first, so an
old half-done run never undoes a newer one.  One run at a time per view, as the
reference's scheduler does for a month.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Row, SparkSession

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.conform import LOST
from monthwise.operators.checks import require_schema
from monthwise.plans.catalog import (
    _q,
    attach_months,
    attached_months,
    create_target,
    partition_location,
    table_exists,
    table_location,
    vacuum_runs,
)
from monthwise.plans.load import LoadReport, Written, partition_path, record_counts, run_folder, write_run
from monthwise.sources import fs

RECORD, DONE = "_decisions", "_done"
RECORD_SCHEMA = "date date, cnt bigint, action string, delivered_at timestamp_ntz, digest string"


def create_published(spark: SparkSession, view: str, location: str, contract: Contract = TRIP_CONTRACT) -> None:
    """The view over an empty first table at ``location``, if it is missing."""
    if table_exists(spark, view):
        return
    first = f"{view}_run_0"
    create_target(spark, first, location, contract)
    spark.sql(f"CREATE VIEW IF NOT EXISTS {_q(view)} AS SELECT * FROM {_q(first)}")


def published_table(spark: SparkSession, view: str) -> str:
    """The run's table that the view reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(view)}").where("col_name = 'View Text'").collect()
    return re.search(r"FROM (.*)$", rows[0]["data_type"])[1].replace("`", "")


def _runs(spark: SparkSession, location: str) -> list[str]:
    return sorted(d for d in fs.list_dir(spark, f"{location}/_runs") if not d.startswith(("_", ".")))


def _run_table(view: str, run: str) -> str:
    return f"{view}_run_{re.sub('[^0-9a-z]', '_', run.lower())}"


def _switch(spark: SparkSession, view: str, table: str) -> None:
    """The one change that readers see."""
    spark.sql(f"ALTER VIEW {_q(view)} AS SELECT * FROM {_q(table)}")


def _publish(spark: SparkSession, view: str, run_root: str, decisions: list[Row], contract: Contract) -> None:
    """The run's table, of its own months and the other months of the published one; then the switch."""
    key = contract.partition_key
    now = published_table(spark, view)
    table = _run_table(view, run_root.rsplit("/", 1)[1])
    if now == table:
        return
    mine = {r[key]: r["action"] for r in decisions}
    others = [r[key] for r in attached_months(spark, now, key).collect() if r[key] not in mine]  # a row a month
    months = {m: partition_location(spark, now, m, key) for m in others}
    months |= {m: partition_path(run_root, m, key) for m, action in mine.items() if action == "attach"}
    create_target(spark, table, table_location(spark, now), contract)
    attach_months(spark, table, months, key)
    spark.catalog.refreshTable(table)
    _switch(spark, view, table)


def _finish(spark: SparkSession, view: str, run_root: str, ledger_root: str, contract: Contract) -> list[Row]:
    key = contract.partition_key
    rows = spark.read.schema(RECORD_SCHEMA).parquet(f"{run_root}/{RECORD}").collect()  # a row a month
    decisions = [Row(**{key: r["date"], "cnt": r["cnt"], "action": r["action"]}) for r in sorted(rows)]
    _publish(spark, view, run_root, decisions, contract)
    delivered = {r["date"]: r["delivered_at"] for r in rows}
    record_counts(spark, decisions, ledger_root, key, delivered, {r["date"]: r["digest"] for r in rows})
    spark.createDataFrame([(view,)], "view string").coalesce(1).write.mode("overwrite").parquet(f"{run_root}/{DONE}")
    return decisions


def finish_runs(
    spark: SparkSession, view: str, ledger_root: str, contract: Contract = TRIP_CONTRACT
) -> list[tuple[str, str]]:
    """Finish or drop every run that did not end: ``(run, what was done)``, oldest first."""
    location = table_location(spark, published_table(spark, view)).rstrip("/")
    out = []
    for run in _runs(spark, location):
        root = f"{location}/_runs/{run}"
        if fs.exists(spark, f"{root}/{DONE}/_SUCCESS"):
            continue
        if fs.exists(spark, f"{root}/{RECORD}/_SUCCESS"):
            _finish(spark, view, root, ledger_root, contract)
            out.append((run, "finished"))
        else:
            fs.delete(spark, root)
            out.append((run, "dropped"))
    return out


def load_run(
    spark: SparkSession,
    df: DataFrame,
    view: str,
    ledger_root: str,
    months=None,
    contract: Contract = TRIP_CONTRACT,
    not_null=("date",),
    rebalance: bool = False,
    sort_within=(),
    row_limit: int | None = None,
    delivered: dict[dt.date, dt.datetime] | None = None,
    max_lost: int | None = None,
    digest: bool = False,
) -> LoadReport:
    """``load_months`` for a view of ``create_published``: all months of the
    run appear at once.  Parameters as there; safe to repeat."""
    key = contract.partition_key
    require_schema(df.drop(LOST), contract)
    if row_limit is not None and row_limit < 1:
        raise ValueError(f"a row limit must be at least 1, not {row_limit}")
    finish_runs(spark, view, ledger_root, contract)
    location = table_location(spark, published_table(spark, view)).rstrip("/")
    run_root = run_folder(location)
    before = {r[key] for r in attached_months(spark, published_table(spark, view), key).collect()}
    written = write_run(
        spark, df, run_root, months, contract, not_null, rebalance, sort_within, row_limit, max_lost, digest
    )
    _record(spark, run_root, written, delivered or {}, key)
    decisions = _finish(spark, view, run_root, ledger_root, contract)
    return LoadReport(
        decisions=decisions,
        published=[r[key] for r in decisions if r["action"] == "attach"],
        retired=[r[key] for r in decisions if r["action"] == "drop" and r[key] in before],
        lost=written.lost,
    )


def _record(spark: SparkSession, run_root: str, written: Written, delivered: dict, key: str) -> None:
    rows = [(r[key], r["cnt"], r["action"], delivered.get(r[key]), written.digests.get(r[key])) for r in written.decisions]
    spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{run_root}/{RECORD}")


def vacuum_published(spark: SparkSession, view: str, keep: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Drop the tables of runs older than ``keep`` that the view no longer
    reads, and the month folders that no month is read from any more."""
    now = published_table(spark, view)
    limit = f"{dt.datetime.now(dt.timezone.utc) - keep:%Y%m%dT%H%M%S}".lower()
    db, name = now.rsplit(".", 1)
    prefix = f"{view.rsplit('.', 1)[1]}_run_"
    for t in spark.catalog.listTables(db, f"{prefix}*"):
        run = t.name[len(prefix):]
        if t.name != name and (run == "0" or run.split("_")[0] <= limit):
            spark.sql(f"DROP TABLE IF EXISTS {_q(f'{db}.{t.name}')}")  # external: its folders stay
    return vacuum_runs(spark, now, keep=keep)

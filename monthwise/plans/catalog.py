"""Catalog form of the target: a database, an external Parquet table
partitioned by month, a ledger table, and partition attach / detach.

Attach is metadata only (``ADD PARTITION ... LOCATION``): a month staged in
its own folder joins the table without a copy.  Detach on an *external*
table (``DROP PARTITION``) removes the month from the table and keeps its
files, so it can be attached again; on a managed table the files would go.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.conform import LOST


def _q(name: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def database_exists(spark: SparkSession, db: str) -> bool:
    return spark.catalog.databaseExists(db)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(db)}")


def create_target(spark: SparkSession, table: str, location: str, contract: Contract = TRIP_CONTRACT) -> None:
    """External Parquet table from the contract, partitioned by its key."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_q(table)} ({contract.ddl_columns(not_null_key=True)}) "
        f"USING parquet PARTITIONED BY ({_q(contract.partition_key)}) LOCATION {_lit(location)}"
    )


def create_ledger(spark: SparkSession, table: str, location: str) -> None:
    """The ledger log table (append-only; latest entry per month wins)."""
    from monthwise.operators.ledger import LOG_SCHEMA

    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in LOG_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(table)} ({cols}) USING parquet LOCATION {_lit(location)}")


LATEST_PER_MONTH_SQL = "SELECT max_by(cnt, struct(loaded_at, run_id)) AS cnt, date FROM {log} GROUP BY date"


def create_ledger_view(spark: SparkSession, view: str, log_table: str) -> None:
    """A persistent view ``(cnt, date)`` with one row per month, the latest
    entry of the log: the shape of the reference's count table, so
    ``SELECT * FROM <view>`` answers as there."""
    spark.sql(f"CREATE VIEW IF NOT EXISTS {_q(view)} AS " + LATEST_PER_MONTH_SQL.format(log=_q(log_table)))


def ledger_view(spark: SparkSession, ledger_table: str, view: str) -> None:
    """A temp view with one ``(cnt, date)`` row per month (latest entry)."""
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {_q(view)} AS " + LATEST_PER_MONTH_SQL.format(log=_q(ledger_table)))


def create_like(spark: SparkSession, table: str, like: str, location: str | None = None) -> None:
    """An empty table with the columns of another (the stage table)."""
    loc = f" LOCATION {_lit(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(table)} LIKE {_q(like)} USING parquet{loc}")


def init_tables(
    spark: SparkSession,
    root: str,
    db: str = "taxi",
    table: str = "ny_yellow",
    ledger_table: str = "ny_yellow_cnt",
    stage_db: str = "stage",
    contract: Contract = TRIP_CONTRACT,
) -> tuple[str, str]:
    """One-time set-up: both databases, the target, the ledger log
    ``<ledger_table>_log`` and the view ``<ledger_table>`` over it (one row
    per month).  Returns the target and the log table (loads append to the
    log)."""
    create_database(spark, stage_db)
    create_database(spark, db)
    target, log = f"{db}.{table}", f"{db}.{ledger_table}_log"
    create_target(spark, target, f"{root.rstrip('/')}/{table}", contract)
    create_ledger(spark, log, f"{root.rstrip('/')}/{ledger_table}")
    create_ledger_view(spark, f"{db}.{ledger_table}", log)
    return target, log


def attach_months(spark: SparkSession, table: str, months: dict[dt.date, str], key: str = "date") -> None:
    """Attach month folders as partitions in one statement (zero copy)."""
    if not months:
        return
    specs = " ".join(
        f"PARTITION ({_q(key)} = {_lit(m.isoformat())}) LOCATION {_lit(loc)}" for m, loc in sorted(months.items())
    )
    spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS {specs}")


def detach_months(spark: SparkSession, table: str, months: Iterable[dt.date], key: str = "date") -> None:
    months = sorted(set(months))
    if not months:
        return
    specs = ", ".join(f"PARTITION ({_q(key)} = {_lit(m.isoformat())})" for m in months)
    spark.sql(f"ALTER TABLE {_q(table)} DROP IF EXISTS {specs}")


def recover_months(spark: SparkSession, table: str) -> None:
    """Register every month folder found under the table location."""
    spark.sql(f"ALTER TABLE {_q(table)} RECOVER PARTITIONS")


def attached_months(spark: SparkSession, table: str, key: str = "date") -> DataFrame:
    """Months attached to the table, from the catalog (``SHOW PARTITIONS``)."""
    parts = spark.sql(f"SHOW PARTITIONS {_q(table)}")
    return parts.select(F.to_date(F.regexp_extract("partition", f"{key}=([0-9-]+)", 1)).alias(key))


def month_counts_sql(spark: SparkSession, table: str) -> DataFrame:
    """Rows per month of the table, as the operator would ask it in SQL."""
    return spark.sql(f"SELECT date, count(*) AS cnt FROM {_q(table)} GROUP BY 1 ORDER BY 1")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {_q(table)}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def partition_location(spark: SparkSession, table: str, month: dt.date, key: str = "date") -> str:
    spec = f"PARTITION ({_q(key)} = {_lit(month.isoformat())})"
    rows = spark.sql(f"DESCRIBE FORMATTED {_q(table)} {spec}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]  # the partition's own location comes first


def load_months_to_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    ledger_table: str,
    months=None,
    contract: Contract = TRIP_CONTRACT,
    not_null=("date",),
    rebalance: bool = False,
    sort_within=(),
    row_limit: int | None = None,
    delivered: dict[dt.date, dt.datetime] | None = None,
    max_lost: int | None = None,
    digest: bool = False,
):
    """Load a conformed frame of many months into a catalog table; each
    month is swapped in by one metadata update.  Safe to repeat.

    Write first, gate what was written, then swap, then record:

    1. the rows go to a fresh run folder under the table
       (``<location>/_runs/<run>/date=...``; hidden, so neither readers nor
       ``RECOVER PARTITIONS`` see it) -- the only pass over the source;
    2. the gates are metrics observed in that pass (``write_run``).  On a
       failure the run folder is deleted and the table is unchanged;
    3. per month the catalog swaps ``ALTER TABLE ... PARTITION ... SET
       LOCATION`` -- readers see the old month or the new one, never none,
       unlike a detach followed by an attach -- or adds the partition, and
       drops the requested months that have no rows;
    4. the ledger records the counts, so it never names a month that is not
       in the table.  Superseded folders stay for scans that already run;
       ``vacuum_runs`` deletes them later.

    ``row_limit`` publishes at most N rows (1 or more) per month while the
    ledger keeps the full count; that needs the counts of the source, so with
    it the gates run over the source before the write.
    """
    from monthwise.operators.checks import require_schema
    from monthwise.plans.load import LoadReport, partition_path, record_counts, run_folder, write_run

    key = contract.partition_key
    loc = table_location(spark, table).rstrip("/")
    run_root = run_folder(loc)
    require_schema(df.drop(LOST), contract)
    if row_limit is not None and row_limit < 1:
        raise ValueError(f"a row limit must be at least 1, not {row_limit}")
    written = write_run(
        spark, df, run_root, months, contract, not_null, rebalance, sort_within, row_limit, max_lost, digest
    )
    decisions = written.decisions
    report = LoadReport(
        decisions=decisions, published=[r[key] for r in decisions if r["action"] == "attach"], lost=written.lost
    )

    attached = {r[key] for r in attached_months(spark, table, key).collect()}
    new = {}
    for m in report.published:
        if m in attached:
            spark.sql(
                f"ALTER TABLE {_q(table)} PARTITION ({_q(key)} = {_lit(m.isoformat())}) "
                f"SET LOCATION {_lit(partition_path(run_root, m, key))}"
            )
        else:
            new[m] = partition_path(run_root, m, key)
    attach_months(spark, table, new, key)
    report.retired = [r[key] for r in decisions if r["action"] == "drop" and r[key] in attached]
    detach_months(spark, table, report.retired, key)
    record_counts(spark, decisions, table_location(spark, ledger_table), key, delivered, written.digests)
    spark.catalog.refreshTable(table)
    spark.catalog.refreshTable(ledger_table)
    return report


def vacuum_runs(spark: SparkSession, table: str, key: str = "date", keep: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Delete month folders of ``load_months_to_table`` that no partition
    points to any more (superseded, retired, or of a load that failed before
    its swap), of runs that are older than ``keep``; a scan that started
    earlier than that may still read them.  Folders outside the table's runs
    are left alone.  Returns the deleted folders, relative to the runs.

    Metadata only: one catalog call per attached month, one listing of the
    runs folder and of each old run.
    """
    from monthwise.sources import fs

    runs = f"{table_location(spark, table).rstrip('/')}/_runs"
    path = lambda p: p.split(":", 1)[-1].rstrip("/").replace("//", "/")
    used = {path(partition_location(spark, table, r[key], key)) for r in attached_months(spark, table, key).collect()}
    limit = f"{dt.datetime.now(dt.timezone.utc) - keep:%Y%m%dT%H%M%S}"
    removed = []
    for run in fs.list_dir(spark, runs):
        if run.split("-")[0] > limit:
            continue
        months = [d for d in fs.list_dir(spark, f"{runs}/{run}") if d.startswith(f"{key}=")]
        unused = [d for d in months if path(f"{runs}/{run}/{d}") not in used]
        if len(unused) == len(months):
            fs.delete(spark, f"{runs}/{run}")
            removed.append(run)
            continue
        for d in unused:
            fs.delete(spark, f"{runs}/{run}/{d}")
            removed.append(f"{run}/{d}")
    return removed

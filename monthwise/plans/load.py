"""The monthly load as one Spark job over any number of months.

``load_months`` = conform (already done by the scan) -> gates -> decide ->
publish / retire -> ledger.  It is safe to repeat: publishing a month is a
dynamic partition overwrite of exactly that month, retiring deletes exactly
that month's folder, and the ledger gets a newer entry for the month that
supersedes the old one (latest entry wins).

Cost model (what runs over the data):

1. the write -- the only scan of the source, no shuffle and no sort by
   default (``publish_months``), into a hidden run folder;
2. the gates are metrics observed in that same pass (``observed.py``): rows
   per month, nulls, rows of other months, and values lost in casts, of
   exactly the rows that will be published.  Nothing is read back, unless
   ``digest`` asks for the content of each month as it lies in storage;
3. two renames per month: the old folder aside, the new one in (on an object
   store a rename is a copy: use the catalog form there, which swaps
   locations).  Between the two the month is absent for a moment; a failed
   rename puts the old folder back.

With ``row_limit`` the full counts are needed too, so the gates then run over
the source, and the write reads it a second time.

The gate totals and the decision are one job whose result is one row per
month (bounded by the calendar, not by the data); only that reaches the
driver.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.conform import LOST
from monthwise.operators.checks import GateError, gate_summary, month_gates, require_schema
from monthwise.operators.ledger import ledger_replace, month_digests
from monthwise.operators.observed import gate_metrics, gates_of, lost_of, lost_values, require_few_lost
from monthwise.operators.sample import first_per_month
from monthwise.session import held_setting
from monthwise.sources import fs

#: Month files that a write task may hold open before it sorts instead.
OPEN_MONTHS = 4


@dataclass
class LoadReport:
    decisions: list[Row] = field(default_factory=list)  # date, cnt, action
    published: list[dt.date] = field(default_factory=list)
    retired: list[dt.date] = field(default_factory=list)
    lost: list[Row] = field(default_factory=list)  # date, column, lost: values that a cast made null

    def lost_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.lost, "date date, column string, lost bigint")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.decisions, "date date, cnt bigint, action string")


def partition_path(root: str, month: dt.date, key: str = "date") -> str:
    return f"{root.rstrip('/')}/{key}={month.isoformat()}"


def limit_per_month(df: DataFrame, n: int, key: str = "date") -> DataFrame:
    """At most ``n`` (1 or more) arbitrary rows per month (the optional stage
    limit); the order is a hash of the row, so that a hot month can be cut."""
    numbered = df.withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return first_per_month(numbered, ["_h"], n, key, "_rn").drop("_rn", "_h")


@contextmanager
def _open_writers(spark: SparkSession, n: int):
    """Let a write task keep ``n`` month files open.  Without it Spark sorts
    every row by month before a partitioned write; beyond ``n`` months in one
    task it still does, for that task."""
    if not n:
        yield
        return
    with held_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(n)):
        yield


def publish_months(
    df: DataFrame,
    target_root: str,
    key: str = "date",
    rebalance: bool = False,
    sort_within: Sequence[str] = (),
    fresh: bool = False,
    seen: tuple[Observation, list[Column]] | None = None,
) -> None:
    """Replace every month present in ``df`` under ``target_root``.

    ``fresh=True``: ``target_root`` does not exist yet (a new run folder), so
    a plain write is enough -- dynamic overwrite would stage every month
    folder and rename it at commit, which on an object store is a copy.

    ``rebalance=False`` (default) writes without a shuffle: right when rows
    of a month come from that month's files, as from ``scan_months``.  Use
    ``rebalance=True`` when every input split holds rows of many months
    (month computed from a timestamp): a ``REBALANCE(date)`` hint shuffles by
    month and lets AQE split a hot month into many tasks and merge small
    ones, so each month gets a few large files instead of tasks x months
    small ones.

    ``seen``: metrics to observe on the rows as they are written.
    """
    out = df.hint("rebalance", key) if rebalance else df
    if seen is not None:
        out = out.observe(seen[0], *seen[1])
    out = out.drop(LOST)
    if sort_within:
        out = out.sortWithinPartitions(key, *sort_within)
    writer = out.write.partitionBy(key)
    writer = (
        writer.mode("errorifexists") if fresh else writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    )
    # a split of month files holds rows of one month, or of two or three where
    # small files share it
    with _open_writers(df.sparkSession, 0 if rebalance or sort_within else OPEN_MONTHS):
        writer.parquet(target_root)


def retire_months(spark: SparkSession, target_root: str, months: Iterable[dt.date], key: str = "date") -> list[dt.date]:
    """Remove the given months from the target (DROP of the month)."""
    gone = []
    for m in months:
        if fs.delete(spark, partition_path(target_root, m, key)):
            gone.append(m)
    return gone


def detach_month(spark: SparkSession, target_root: str, month: dt.date, detached_root: str, key: str = "date") -> bool:
    """Take a month out of the target but keep its files (DETACH)."""
    src = partition_path(target_root, month, key)
    if not fs.exists(spark, src):
        return False
    fs.replace(spark, src, partition_path(detached_root, month, key))
    return True


def attach_month(spark: SparkSession, detached_root: str, month: dt.date, target_root: str, key: str = "date") -> bool:
    """Put a detached (or separately staged) month folder back (ATTACH)."""
    src = partition_path(detached_root, month, key)
    if not fs.exists(spark, src):
        return False
    fs.replace(spark, src, partition_path(target_root, month, key))
    return True


def load_months(
    spark: SparkSession,
    df: DataFrame,
    target_root: str,
    ledger_root: str,
    months: DataFrame | Sequence[dt.date] | None = None,
    contract: Contract = TRIP_CONTRACT,
    not_null: Sequence[str] = ("date",),
    row_limit: int | None = None,
    rebalance: bool = False,
    sort_within: Sequence[str] = (),
    persist: bool = False,
    delivered: dict[dt.date, dt.datetime] | None = None,
    max_lost: int | None = None,
    digest: bool = False,
) -> LoadReport:
    """Load a conformed frame of many months; safe to repeat.

    ``months``: the months this run is responsible for.  A requested month
    without rows is retired (its old data removed) and gets ``cnt = 0`` in
    the ledger.  Rows of a month that was not requested fail the range gate.
    ``None``: the months present in ``df``.
    ``delivered``: the delivery time of each month, for the ledger.
    ``row_limit``: publish at most that many rows (1 or more) per month; the
    ledger keeps the full count.
    A frame conformed with ``lost=True`` has its lost values counted per month
    and column in the report; ``max_lost`` fails the load where a month's
    column lost more.  ``digest`` records the content of each month.
    """
    key = contract.partition_key
    require_schema(df.drop(LOST), contract)
    if row_limit is not None and row_limit < 1:
        raise ValueError(f"a row limit must be at least 1, not {row_limit}")
    if persist:
        # worth it only when the frame is expensive to recompute (a JDBC or
        # remote source): the gate pass and the write then read it once
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _load(
            spark, df, target_root, ledger_root, months, contract, not_null, row_limit, rebalance, sort_within, delivered,
            max_lost, digest,
        )
    finally:
        if persist:
            df.unpersist()


def _month_frame(spark: SparkSession, months, key: str) -> DataFrame | None:
    if months is None:
        return None
    if isinstance(months, DataFrame):
        return months.select(F.col(key).cast("date").alias(key)).distinct()
    return spark.createDataFrame([(m,) for m in sorted(set(months))], f"{key} date")


def decide(spark: SparkSession, gates: DataFrame, months, key: str = "date") -> list[Row]:
    """Check ``month_gates`` totals against the requested months and decide
    per month: ``attach`` when it has rows, ``drop`` when it has none.

    One row of failure totals, then one row per requested month (or, without
    a request, per month present) reaches the driver.  Raises
    ``GateError`` when rows fall outside the requested months or a required
    column is null.
    """
    months_df = _month_frame(spark, months, key)
    # one row of totals first: a broken key makes as many groups as it has
    # values, and only the months asked for may reach the driver
    gates = gates.persist()  # a row a month: both looks share one scan
    try:
        totals = gate_summary(gates, months_df, key).first()
        failures = {k: v for k, v in totals.asDict().items() if v and k != "rows_in_range"}
        if failures:
            raise GateError(f"gates failed, nothing published: {failures}")
        requested = (gates if months_df is None else months_df.join(gates, key, "left")).collect()
    finally:
        gates.unpersist()
    return [
        Row(**{key: r[key], "cnt": int(r["cnt"] or 0), "action": "attach" if (r["cnt"] or 0) > 0 else "drop"})
        for r in sorted(requested, key=lambda r: r[key])
    ]


def record_counts(
    spark: SparkSession,
    decisions: list[Row],
    ledger_root: str,
    key: str = "date",
    delivered: dict | None = None,
    digests: dict | None = None,
) -> None:
    """The ledger always records the full count, also for an empty month."""
    rows = [(r["cnt"], r[key], (delivered or {}).get(r[key]), (digests or {}).get(r[key])) for r in decisions]
    counts = spark.createDataFrame(rows, "cnt bigint, date date, delivered_at timestamp_ntz, digest string")
    ledger_replace(counts, ledger_root, "date")


@dataclass
class Written:
    """What ``write_run`` wrote, by month."""

    decisions: list[Row]  # date, cnt, action
    lost: list[Row]  # date, column, lost
    digests: dict[dt.date, str]


def write_run(
    spark, df, run_root, months, contract, not_null=("date",), rebalance=False, sort_within=(), row_limit=None,
    max_lost=None, digest=False,
) -> Written:
    """Write ``df`` to the new folder ``run_root`` by month and gate what is
    written, in one pass.  On a gate failure the folder is deleted."""
    key, counts_lost = contract.partition_key, LOST in df.columns
    asked = None if months is None else sorted(r[0] for r in _month_frame(spark, months, key).collect())
    if row_limit is not None:
        # the counts are those of the source, so the gates run over it first
        decisions = decide(spark, month_gates(df, key, not_null), months, key)
        lost = lost_values(df, contract).sort("date", "column").collect() if counts_lost else []  # a row a month and column
        require_few_lost(lost, max_lost)
        publish_months(limit_per_month(df.drop(LOST), row_limit, key), run_root, key, rebalance, sort_within, fresh=True)
    else:
        seen = Observation()
        metrics = gate_metrics(key, asked, not_null, counts_lost)
        publish_months(df, run_root, key, rebalance, sort_within, fresh=True, seen=(seen, metrics))
        try:
            counts = gates_of(seen.get, asked)
            if counts is None:  # more months than an observation can count
                decisions = decide(spark, month_gates(read_target(spark, run_root, contract), key, not_null), months, key)
            else:
                decisions = [
                    Row(**{key: m, "cnt": n, "action": "attach" if n else "drop"}) for m, n in sorted(counts.items())
                ]
            lost = lost_of(seen.get, contract) if counts_lost else []
            if lost is None:
                lost = lost_values(df, contract).sort("date", "column").collect()
            require_few_lost(lost, max_lost)
        except GateError:
            fs.delete(spark, run_root)
            raise
    digests = {}
    if digest:
        rows = month_digests(read_target(spark, run_root, contract), key).collect()  # a row a month
        digests = {r[key]: r["digest"] for r in rows}
    return Written(decisions, lost, digests)


def run_folder(root: str) -> str:
    """A new hidden folder for one run; readers of ``root`` do not see it."""
    return f"{root.rstrip('/')}/_runs/{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _load(
    spark, df, target_root, ledger_root, months, contract, not_null, row_limit, rebalance, sort_within, delivered,
    max_lost, digest,
) -> LoadReport:
    key, run_root = contract.partition_key, run_folder(target_root)
    written = write_run(
        spark, df, run_root, months, contract, not_null, rebalance, sort_within, row_limit, max_lost, digest
    )
    decisions = written.decisions
    attach = [r[key] for r in decisions if r["action"] == "attach"]
    drop = [r[key] for r in decisions if r["action"] == "drop"]
    for m in attach:
        fs.replace(spark, partition_path(run_root, m, key), partition_path(target_root, m, key))
    fs.delete(spark, run_root)
    retired = retire_months(spark, target_root, drop, key)
    record_counts(spark, decisions, ledger_root, key, delivered, written.digests)
    return LoadReport(decisions=decisions, published=attach, retired=retired, lost=written.lost)


def read_target(spark: SparkSession, target_root: str, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """The published table, columns in contract order (empty if absent)."""
    if not any(not n.startswith(("_", ".")) for n in fs.list_dir(spark, target_root)):
        return spark.createDataFrame([], contract.schema)  # absent, or no month in it
    df = spark.read.schema(contract.schema).parquet(target_root)
    return df.select(*contract.names)

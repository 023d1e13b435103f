"""The count ledger: the row count of every loaded month.

Stored append-only: each run adds one small file of ``(cnt, date,
loaded_at, run_id)`` rows, and the ledger *view* is the latest entry per
month.  "Replace the count of a month" is therefore an append -- no delete,
no overwrite of a folder that others read, nothing half-done after a crash;
repeating a run appends an identical newer entry and the view is unchanged.
The log holds one row per month per run, tiny next to the data.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.contract import LEDGER_SCHEMA
from monthwise.sources import fs

LOG_SCHEMA = T.StructType(
    [
        T.StructField("cnt", T.LongType(), True),
        T.StructField("date", T.DateType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
        T.StructField("run_id", T.StringType(), True),
        # modification time of the delivery that was loaded (null: not known)
        T.StructField("delivered_at", T.TimestampNTZType(), True),
        # content of the month as loaded (``month_digests``; null: not taken)
        T.StructField("digest", T.StringType(), True),
    ]
)


def ledger_rows(counts: DataFrame, key: str = "date") -> DataFrame:
    """``cnt bigint, date date`` from a ``key, cnt`` frame."""
    return counts.select(F.col("cnt").cast("long").alias("cnt"), F.col(key).cast("date").alias("date"))


def ledger_replace(counts: DataFrame, ledger_root: str, key: str = "date", run_id: str | None = None) -> str:
    """Record the counts of every month in ``counts`` (``key``, ``cnt`` and, if
    known, ``delivered_at`` and ``digest``); older entries of those months are superseded,
    other months keep theirs.  Returns the run id."""
    # run ids sort by creation time, so equal timestamps still order runs
    run_id = run_id or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    delivered = F.col("delivered_at") if "delivered_at" in counts.columns else F.lit(None)
    digest = F.col("digest") if "digest" in counts.columns else F.lit(None)
    rows = counts.where(F.col(key).isNotNull())
    entry = rows.select(
        F.col("cnt").cast("long").alias("cnt"),
        F.col(key).cast("date").alias("date"),
        F.lit(now).cast("timestamp_ntz").alias("loaded_at"),
        F.lit(run_id).alias("run_id"),
        delivered.cast("timestamp_ntz").alias("delivered_at"),
        digest.cast("string").alias("digest"),
    )
    # two runs that append to one folder share Spark's temporary folder in it,
    # and the first to finish deletes it: so write aside, then rename in
    root = ledger_root.rstrip("/")
    staging = f"{root}/_append-{uuid.uuid4().hex}"
    entry.coalesce(1).write.mode("errorifexists").parquet(staging)
    spark = counts.sparkSession
    for part in fs.list_dir(spark, staging):
        if part.endswith(".parquet"):
            fs.rename(spark, f"{staging}/{part}", f"{root}/{part}")
    fs.delete(spark, staging)
    return run_id


def read_ledger_log(spark: SparkSession, ledger_root: str) -> DataFrame:
    if not fs.exists(spark, ledger_root):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(ledger_root)


def read_ledger(spark: SparkSession, ledger_root: str) -> DataFrame:
    """One row ``(cnt, date)`` per month: its latest entry.

    Grouped ``max_by`` with partial aggregation: one small row per month per
    task crosses the shuffle.
    """
    log = read_ledger_log(spark, ledger_root)
    latest = F.max_by("cnt", F.struct("loaded_at", "run_id"))
    return log.groupBy("date").agg(latest.alias("cnt")).select(F.col("cnt").cast("long"), "date")


def read_ledger_digests(spark: SparkSession, ledger_root: str) -> DataFrame:
    """``cnt, date, digest`` of each month's latest entry."""
    log = read_ledger_log(spark, ledger_root)
    latest = F.max_by(F.struct("cnt", "digest"), F.struct("loaded_at", "run_id"))
    return log.groupBy("date").agg(latest.alias("_e")).select("_e.cnt", "date", "_e.digest")


def month_digests(df: DataFrame, key: str = "date") -> DataFrame:
    """``key, cnt, digest``: the content of each month, whatever the order of
    its rows and files.

    The digest of a set of rows with repeats is the sum and the xor of the
    rows' 64-bit hashes, so parts merge, and tasks send one row per month.
    Nulls are hashed as such: the hash function itself skips them.
    """
    cells = [x for c in sorted(df.columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    rows = df.select(F.col(key), F.xxhash64(*cells).alias("_h"))
    sums = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.col("_h").cast("decimal(20, 0)")).cast("decimal(38, 0)").alias("_s"),
        F.bit_xor("_h").alias("_x"),
    )
    return sums.select(key, "cnt", F.concat_ws(":", F.col("_s").cast("string"), F.hex("_x")).alias("digest"))


def last_delivery(spark: SparkSession, ledger_root: str) -> DataFrame:
    """``date, delivered_at``: the delivery time of each month's latest entry."""
    log = read_ledger_log(spark, ledger_root)
    latest = F.max_by("delivered_at", F.struct("loaded_at", "run_id"))
    return log.groupBy("date").agg(latest.alias("delivered_at"))


def compact_ledger(spark: SparkSession, ledger_root: str) -> int:
    """Rewrite the log as its latest entry per month, in one file.

    Each run appends a small file, so the log keeps growing in file count.
    Compaction keeps each month's latest entry *with* its ``loaded_at`` and
    ``run_id``, so a compacted entry equals the entry it came from:

    1. list the log's current files;
    2. write the latest entries of exactly those files to a hidden staging
       folder, then rename that file into the log;
    3. delete the listed files.

    Between 2 and 3 a reader sees every latest entry twice, identical, and
    the view (``max_by`` per month) is unchanged; a crash there leaves only
    such harmless duplicates, removed by the next compaction.  Runs that
    append while it works add new files, which are not listed and so not
    deleted.  Returns the number of files removed.
    """
    files = [f for f in fs.list_dir(spark, ledger_root) if f.endswith(".parquet")]
    if len(files) <= 1:
        return 0
    root = ledger_root.rstrip("/")
    log = spark.read.schema(LOG_SCHEMA).parquet(*[f"{root}/{f}" for f in files])
    newest = F.max_by(F.struct("cnt", "loaded_at", "run_id", "delivered_at", "digest"), F.struct("loaded_at", "run_id"))
    latest = log.groupBy("date").agg(newest.alias("_e"))
    latest = latest.select("_e.cnt", "date", "_e.loaded_at", "_e.run_id", "_e.delivered_at", "_e.digest")
    staging = f"{root}/_compact-{uuid.uuid4().hex[:8]}"
    latest.coalesce(1).write.mode("errorifexists").parquet(staging)
    for part in fs.list_dir(spark, staging):
        if part.endswith(".parquet"):
            # raises unless the new file is seen in the log: nothing is deleted then
            fs.rename(spark, f"{staging}/{part}", f"{root}/compact-{time.time_ns():020d}-{part}")
    fs.delete(spark, staging)
    for f in files:
        fs.delete(spark, f"{root}/{f}", recursive=False)
    return len(files)


def reconcile(table_counts: DataFrame, ledger: DataFrame, key: str = "date") -> DataFrame:
    """Compare per-month counts of the table with the ledger (O-34).

    Full outer join on the month, null-safe compare.  ``status`` is one of
    ``match``, ``count_mismatch``, ``missing_in_ledger`` (table has the month,
    ledger not) or ``missing_in_table``.  Both sides are one row per month,
    so the shuffle is tiny whatever the table size.

    With a ``digest`` on both sides a ``match`` needs equal digests too: equal
    counts of other rows are ``content_mismatch``, and a month that the ledger
    has no digest of is ``unverified``.
    """
    content = "digest" in table_counts.columns and "digest" in ledger.columns
    digest = F.col("digest") if content else F.lit("")
    t = table_counts.select(
        F.col(key).alias("date"), F.col("cnt").cast("long").alias("table_cnt"), digest.alias("_t")
    )
    lg = ledger.groupBy(F.col(key).alias("date")).agg(
        F.sum("cnt").cast("long").alias("ledger_cnt"), F.max(digest).alias("_l")
    )
    j = t.join(lg, "date", "full_outer")
    status = (
        F.when(F.col("ledger_cnt").isNull(), F.lit("missing_in_ledger"))
        .when(F.col("table_cnt").isNull(), F.lit("missing_in_table"))
        .when(~F.col("table_cnt").eqNullSafe(F.col("ledger_cnt")), F.lit("count_mismatch"))
        .when(F.col("_l").isNull(), F.lit("unverified"))
        .when(F.col("_t").eqNullSafe(F.col("_l")), F.lit("match"))
        .otherwise(F.lit("content_mismatch"))
    )
    return j.select("date", "table_cnt", "ledger_cnt", status.alias("status"))

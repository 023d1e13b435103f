"""Registered queries: one per operator group of the survey, each over the
driver's tables at ``sf_dir``, with the DuckDB statement of the same answer.

Every callable is ``(spark, sf_dir) -> DataFrame``.  Column names match the
oracle SQL exactly; timestamps come back as TIMESTAMP_NTZ (the contract's
``timestamp without time zone`` form) so types line up with DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.functions import calendar as cal
from monthwise.functions.conform import conform
from monthwise.operators import checks, ledger, sample
from monthwise.plans.views import (
    LINEITEM_TRIPS_SQL,
    ORDERS_TRIPS_SQL,
    lineitem_trips_raw,
    orders_trips_raw,
    table,
)

CONTRACT = TRIP_CONTRACT.with_timestamp_ntz()
# Fixed values used by the registered queries.
TEST_RUN_DATE = "2020-02-03"  # run date of the reference's own conform test
SLICE_MONTH = "1998-07-01"
REMOTE_BASE = "https://trip-data.example/trip-data/"
SAMPLE_ROWS = 100

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(lineitem_trips_raw(spark, sf_dir), CONTRACT)


def orders_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(orders_trips_raw(spark, sf_dir), CONTRACT)


def _sql_conformed(view_sql: str) -> str:
    return f"({view_sql})"


# --- conform --------------------------------------------------------------


@register("conform_trips", LINEITEM_TRIPS_SQL)
def q_conform_trips(spark, sf_dir):
    return lineitem_trips(spark, sf_dir)


_SQL_TYPES = {"bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER"}
_NULL_ROW_SQL = ",\n       ".join(
    f"CAST(NULL AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}" for f in CONTRACT.schema.fields if f.name != "date"
)


@register("conform_missing", f"SELECT {_NULL_ROW_SQL},\n       DATE '{TEST_RUN_DATE}' AS date\nFROM customer")
def q_conform_missing(spark, sf_dir):
    # a month file none of whose columns the contract knows (the reference's
    # second schema case), with rows: customer grows with the data, and every
    # column but the run date comes back as a typed null
    raw = table(spark, sf_dir, "customer").withColumn("date", cal.run_date(TEST_RUN_DATE))
    return conform(raw, CONTRACT)


_BAD = "o_orderkey % 7"


@register(
    "conform_bad_values",
    f"""
SELECT CASE WHEN {_BAD} = 0 THEN NULL ELSE o_custkey END AS vendor_id,
       CASE WHEN {_BAD} <> 1 THEN CAST(o_orderdate AS TIMESTAMP) END AS tpep_pickup_datetime,
       CAST(NULL AS TIMESTAMP) AS tpep_dropoff_datetime,
       CASE WHEN {_BAD} <> 2 THEN CAST(length(o_orderpriority) AS DOUBLE) END AS passenger_count,
       CAST(NULL AS DOUBLE) AS trip_distance, CAST(NULL AS DOUBLE) AS ratecode_id,
       CASE WHEN {_BAD} = 3 THEN NULL ELSE o_orderstatus END AS store_and_fwd_flag,
       CASE WHEN {_BAD} <> 4 THEN o_orderkey END AS pu_location_id,
       CAST(NULL AS BIGINT) AS do_location_id, CAST(NULL AS BIGINT) AS payment_type, CAST(NULL AS DOUBLE) AS fare_amount,
       CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax, CAST(NULL AS DOUBLE) AS tip_amount,
       CAST(NULL AS DOUBLE) AS tolls_amount, CAST(NULL AS DOUBLE) AS improvement_surcharge,
       CAST(NULL AS DOUBLE) AS total_amount, CAST(NULL AS DOUBLE) AS congestion_surcharge,
       CASE WHEN {_BAD} <> 5 THEN CAST(o_orderkey % 1000 AS INTEGER) END AS airport_fee,
       DATE '{TEST_RUN_DATE}' AS date
FROM orders
""",
)
def q_conform_bad_values(spark, sf_dir):
    return conform(_bad_orders_raw(spark, sf_dir, cal.run_date(TEST_RUN_DATE)), CONTRACT)


def _bad_orders_raw(spark, sf_dir, month):
    # one kind of value per remainder fails its cast (text where a number or
    # a time is due, a long that no int holds) and becomes null
    o = table(spark, sf_dir, "orders")

    def bad(r, value, good):
        return F.when(F.expr(_BAD) == r, F.lit(value)).otherwise(good.cast("string"))

    return o.select(
        bad(0, "n/a", F.col("o_custkey")).alias("VendorID"),
        bad(1, "not a time", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("tpep_pickup_datetime"),
        bad(2, "many", F.length("o_orderpriority")).alias("passenger_count"),
        F.when(F.expr(_BAD) != 3, F.col("o_orderstatus")).alias("store_and_fwd_flag"),
        bad(4, "", F.col("o_orderkey")).alias("PULocationID"),
        F.when(F.expr(_BAD) == 5, F.lit(3_000_000_000)).otherwise(F.col("o_orderkey") % 1000).alias("airport_fee"),
        month.alias("date"),
    )


@register(
    "lost_values",
    f"""
WITH lost AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
           CASE {_BAD} WHEN 0 THEN 'vendor_id' WHEN 1 THEN 'tpep_pickup_datetime' WHEN 2 THEN 'passenger_count'
                       WHEN 4 THEN 'pu_location_id' WHEN 5 THEN 'airport_fee' END AS "column"
    FROM orders
)
SELECT date, "column", count(*) AS lost FROM lost WHERE "column" IS NOT NULL GROUP BY ALL
""",
)
def q_lost_values(spark, sf_dir):
    # the same bad values, per month and column, as the load's one pass has
    # counted them; remainder 3 is null at the source and so not lost
    from monthwise.plans.load import load_months

    raw = _bad_orders_raw(spark, sf_dir, cal.month_start("o_orderdate"))
    target, ledger_root = _load_root(spark, "lost")
    frame = conform(raw, CONTRACT, lost=True)
    return load_months(spark, frame, target, ledger_root, contract=CONTRACT, rebalance=True).lost_frame(spark)


@register(
    "observed_load",
    f"""
WITH asked AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem
               UNION SELECT DISTINCT date FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t),
     found AS (SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date)
SELECT asked.date, coalesce(cnt, 0) AS cnt, CASE WHEN cnt > 0 THEN 'attach' ELSE 'drop' END AS action
FROM asked LEFT JOIN found ON found.date = asked.date
""",
)
def q_observed_load(spark, sf_dir):
    # the months of the shipments are asked for, so the last ones have no
    # orders; counts and decisions come from the write's own metrics
    from monthwise.plans.load import load_months

    shipped = table(spark, sf_dir, "lineitem").select(cal.month_start("l_shipdate").alias("date"))
    trips = orders_trips(spark, sf_dir)
    months = checks.present_months(shipped).union(checks.present_months(trips))
    target, ledger_root = _load_root(spark, "observed")
    report = load_months(spark, trips, target, ledger_root, months=months, contract=CONTRACT, rebalance=True)
    return report.frame(spark)


BAD_YEAR = "1995-01-01"


@register(
    "backfill_resume",
    f"""
WITH c AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
SELECT date, run, CASE WHEN run = 1 AND date = DATE '{BAD_YEAR}' THEN 'failed' ELSE 'loaded' END AS status,
       CASE WHEN run = 1 AND date = DATE '{BAD_YEAR}' THEN NULL ELSE n END AS cnt
FROM c CROSS JOIN (VALUES (1), (2)) r (run) WHERE run = 1 OR date = DATE '{BAD_YEAR}'
""",
)
def q_backfill_resume(spark, sf_dir):
    # a delivery a year (in its first month); one has a value that its cast
    # loses, so that month fails alone and is what the second run has to do
    from monthwise.plans.backfill import backfill, report_frame
    from monthwise.session import scratch_path
    from monthwise.sources.landing import write_month_files

    root = scratch_path(spark, "backfill")
    raw = orders_trips_raw(spark, sf_dir).withColumn("date", F.trunc("tpep_pickup_datetime", "year"))
    bad = raw.where(F.col("date") == F.lit(BAD_YEAR).cast("date"))
    first = bad.agg(F.min("PULocationID").alias("_first"))
    spoilt = F.when(F.col("PULocationID") == F.col("_first"), F.lit("n/a")).otherwise(F.col("VendorID").cast("string"))
    write_month_files(spark, raw.where(F.col("date") != F.lit(BAD_YEAR).cast("date")), f"{root}/landing")
    write_month_files(spark, bad.join(F.broadcast(first)).withColumn("VendorID", spoilt).drop("_first"), f"{root}/landing")
    start, end = raw.agg(F.min("date"), F.max("date")).first()

    def run(n):
        done = backfill(spark, f"{root}/landing", f"{root}/t", f"{root}/l", start, end, contract=CONTRACT, max_lost=0)
        return report_frame(spark, done).where("status <> 'no_file'").select("date", F.lit(n).alias("run"), "status", "cnt")

    one = run(1)
    write_month_files(spark, bad, f"{root}/landing")
    return one.unionByName(run(2))


SHORT_MONTH = "1998-06-01"


@register(
    "content_reconcile",
    f"""
SELECT date, count(*) - CASE WHEN date = DATE '{SHORT_MONTH}' THEN 1 ELSE 0 END AS table_cnt, count(*) AS ledger_cnt,
       CASE date WHEN DATE '{SLICE_MONTH}' THEN 'content_mismatch' WHEN DATE '{SHORT_MONTH}' THEN 'count_mismatch'
                 ELSE 'match' END AS status
FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date
""",
)
def q_content_reconcile(spark, sf_dir):
    # after the load one row of the slice month is swapped for another, and
    # one row of another month is lost: equal counts do not hide the swap
    from monthwise.plans.load import load_months, publish_months, read_target

    target, ledger_root = _load_root(spark, "content")
    trips = orders_trips(spark, sf_dir)
    load_months(spark, trips, target, ledger_root, contract=CONTRACT, rebalance=True, digest=True)
    hurt = trips.where(F.col("date").isin(SLICE_MONTH, SHORT_MONTH))
    first = hurt.groupBy("date").agg(F.min("pu_location_id").alias("_first"))
    hurt = hurt.join(first, "date").withColumn("_is", F.col("_first") == F.col("pu_location_id"))
    hurt = hurt.where(~F.col("_is") | (F.col("date") == cal.run_date(SLICE_MONTH)))
    fare = F.when(F.col("_is"), F.col("fare_amount") + 1).otherwise(F.col("fare_amount"))
    publish_months(hurt.withColumn("fare_amount", fare).select(*CONTRACT.names), target, rebalance=True)
    digests = ledger.month_digests(read_target(spark, target, CONTRACT))
    return ledger.reconcile(digests, ledger.read_ledger_digests(spark, ledger_root))


# --- counts ---------------------------------------------------------------


@register(
    "monthly_counts",
    f"SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY 1 ORDER BY 1",
)
def q_monthly_counts(spark, sf_dir):
    return checks.month_counts(orders_trips(spark, sf_dir)).orderBy("date")


@register("stage_count", "SELECT count(*) AS cnt FROM lineitem")
def q_stage_count(spark, sf_dir):
    return lineitem_trips(spark, sf_dir).agg(F.count(F.lit(1)).alias("cnt"))


@register(
    "month_slice",
    f"SELECT * FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t WHERE date = DATE '{SLICE_MONTH}'",
)
def q_month_slice(spark, sf_dir):
    # the month is derived from the pickup time here, so the slice also
    # bounds that time and the scan skips row groups of other months
    return checks.month_slice(orders_trips(spark, sf_dir), cal.run_date(SLICE_MONTH), time_col="tpep_pickup_datetime")


# --- calendar -------------------------------------------------------------

_ORDERS_CALENDAR_SQL = """
(SELECT CAST(g AS DATE) AS date FROM (
   SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                 date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS g
   FROM orders))
"""

# The months the feed is due for, as a schedule has them.
FEED_START, FEED_END = "1992-01-01", "1998-12-01"
_FEED_CALENDAR_SQL = f"""
(SELECT CAST(unnest(generate_series(DATE '{FEED_START}', DATE '{FEED_END}', INTERVAL 1 MONTH)) AS DATE) AS date)
"""


@register(
    "month_paths",
    f"""
SELECT date,
       'yellow_tripdata_' || strftime(date, '%Y_%m') || '.parquet' AS landing_file,
       '/landing/yellow_tripdata_' || strftime(date, '%Y_%m') || '.parquet' AS landing_path,
       'stage.yellow_tripdata_' || strftime(date, '%Y_%m') AS stage_table,
       '{REMOTE_BASE}yellow_tripdata_' || strftime(date, '%Y-%m') || '.parquet' AS remote_url,
       CAST(date + INTERVAL 1 DAY AS DATE) AS attach_until
FROM {_ORDERS_CALENDAR_SQL} c
""",
)
def q_month_paths(spark, sf_dir):
    months = cal.calendar_from(table(spark, sf_dir, "orders"), "o_orderdate")
    return months.select(
        "date",
        cal.landing_file_name("date").alias("landing_file"),
        cal.landing_path("date", "/landing").alias("landing_path"),
        cal.stage_table_name("date").alias("stage_table"),
        cal.remote_url("date", REMOTE_BASE).alias("remote_url"),
        cal.next_day("date").alias("attach_until"),
    )


def _feed_calendar(spark):
    return cal.calendar(spark, FEED_START, FEED_END)


@register(
    "load_backlog",
    f"""
SELECT c.date FROM {_FEED_CALENDAR_SQL} c
WHERE NOT EXISTS (SELECT 1 FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t WHERE t.date = c.date AND month(t.date) % 3 <> 0)
""",
)
def q_load_backlog(spark, sf_dir):
    # ledger of what was loaded: the orders months but every third; calendar:
    # the months the feed is due for; backlog: due but not loaded
    loaded = ledger.ledger_rows(checks.month_counts(orders_trips(spark, sf_dir))).where("month(date) % 3 <> 0")
    return _feed_calendar(spark).join(loaded, "date", "left_anti")


@register(
    "published_months",
    f"""
SELECT c.date FROM {_FEED_CALENDAR_SQL} c
WHERE EXISTS (SELECT 1 FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t WHERE t.date = c.date)
""",
)
def q_published_months(spark, sf_dir):
    published = checks.present_months(orders_trips(spark, sf_dir))
    return _feed_calendar(spark).join(published, "date", "left_semi")


@register(
    "reconcile_counts",
    f"""
WITH t AS (SELECT date, count(*) AS table_cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} x GROUP BY 1),
     s AS (SELECT date, count(*) AS cnt FROM {_sql_conformed(LINEITEM_TRIPS_SQL)} y GROUP BY 1),
     l AS (SELECT date, CAST(table_cnt + CASE WHEN month(date) % 4 = 1 THEN 1 ELSE 0 END AS BIGINT) AS ledger_cnt
           FROM t WHERE month(date) % 4 <> 0
           UNION ALL SELECT date, CAST(cnt AS BIGINT) FROM s WHERE date NOT IN (SELECT date FROM t))
SELECT coalesce(t.date, l.date) AS date, t.table_cnt, l.ledger_cnt,
       CASE WHEN l.ledger_cnt IS NULL THEN 'missing_in_ledger'
            WHEN t.table_cnt IS NULL THEN 'missing_in_table'
            WHEN t.table_cnt IS NOT DISTINCT FROM l.ledger_cnt THEN 'match'
            ELSE 'count_mismatch' END AS status
FROM t FULL OUTER JOIN l ON t.date = l.date
""",
)
def q_reconcile_counts(spark, sf_dir):
    # a ledger that lacks every fourth month, is off by one in others, and
    # has months (of the last shipments) that the table lacks
    table_counts = checks.month_counts(orders_trips(spark, sf_dir))
    off = F.when(F.month("date") % 4 == 1, 1).otherwise(0)
    own = table_counts.where("month(date) % 4 <> 0").select("date", (F.col("cnt") + off).alias("cnt"))
    extra = checks.month_counts(lineitem_trips(spark, sf_dir)).join(table_counts, "date", "left_anti")
    return ledger.reconcile(table_counts, ledger.ledger_rows(own.unionByName(extra)))


# --- gates ----------------------------------------------------------------

NOT_NULL_KEYS = ("date", "vendor_id", "do_location_id")
# planted errors: some rows without a month, some without a vendor
_GAPS_SQL = f"""
(SELECT t.* REPLACE (CASE WHEN pu_location_id % 97 = 0 THEN NULL ELSE date END AS date,
                     CASE WHEN pu_location_id % 89 = 0 THEN NULL ELSE vendor_id END AS vendor_id)
 FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t)
"""


def _trips_with_gaps(spark, sf_dir):
    t = orders_trips(spark, sf_dir)
    return t.withColumn("date", F.when(F.col("pu_location_id") % 97 != 0, F.col("date"))).withColumn(
        "vendor_id", F.when(F.col("pu_location_id") % 89 != 0, F.col("vendor_id"))
    )


@register(
    "null_rows",
    f"""
SELECT pu_location_id, vendor_id, date, CASE WHEN date IS NULL THEN 'date' ELSE 'vendor_id' END AS violation
FROM {_GAPS_SQL} t WHERE date IS NULL OR vendor_id IS NULL
""",
)
def q_null_rows(spark, sf_dir):
    rows = checks.null_violations(_trips_with_gaps(spark, sf_dir), ["date", "vendor_id"])
    return rows.select("pu_location_id", "vendor_id", "date", "violation")


@register(
    "null_key_violations",
    f"""
SELECT date, count(*) AS cnt,
       CAST(count(*) FILTER (WHERE date IS NULL) AS BIGINT) AS null_date,
       CAST(count(*) FILTER (WHERE vendor_id IS NULL) AS BIGINT) AS null_vendor_id,
       CAST(count(*) FILTER (WHERE do_location_id IS NULL) AS BIGINT) AS null_do_location_id
FROM {_GAPS_SQL} t GROUP BY 1
""",
)
def q_null_key_violations(spark, sf_dir):
    return checks.month_gates(_trips_with_gaps(spark, sf_dir), "date", NOT_NULL_KEYS)


@register(
    "range_violations",
    f"""
WITH t AS (SELECT pu_location_id, tpep_pickup_datetime,
                  CASE WHEN pu_location_id % 97 = 0 THEN CAST(date + INTERVAL 1 MONTH AS DATE)
                       WHEN pu_location_id % 89 = 0 THEN NULL ELSE date END AS date
           FROM {_sql_conformed(ORDERS_TRIPS_SQL)} x WHERE date = DATE '{SLICE_MONTH}')
SELECT * FROM t WHERE NOT coalesce(date >= DATE '{SLICE_MONTH}' AND date < DATE '{SLICE_MONTH}' + INTERVAL 1 DAY, false)
""",
)
def q_range_violations(spark, sf_dir):
    # the run month's rows, some with another month or none: those break the
    # attach bounds [month, month + 1 day) of the run
    run = cal.run_date(SLICE_MONTH)
    rows = checks.month_slice(orders_trips(spark, sf_dir), run, time_col="tpep_pickup_datetime")
    key = F.col("pu_location_id")
    wrong = F.when(key % 97 == 0, F.add_months("date", 1)).when(key % 89 != 0, F.col("date"))
    staged = rows.select("pu_location_id", "tpep_pickup_datetime", wrong.alias("date"))
    return checks.range_violations(staged, *checks.month_bounds(run))


@register(
    "load_decision",
    f"""
WITH c AS (SELECT count(*) AS cnt, date FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date)
SELECT m.date, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt,
       CASE WHEN coalesce(c.cnt, 0) > 0 THEN 'attach' ELSE 'drop' END AS action
FROM {_FEED_CALENDAR_SQL} m LEFT JOIN c ON m.date = c.date
""",
)
def q_load_decision(spark, sf_dir):
    counts = checks.month_counts(orders_trips(spark, sf_dir))
    return checks.decision_frame(_feed_calendar(spark), counts)


# --- samples --------------------------------------------------------------


@register(
    "sample_head",
    f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {SAMPLE_ROWS}",
)
def q_sample_head(spark, sf_dir):
    # the fixture maker: first rows by key, written as one Parquet file
    from monthwise.session import scratch_path

    out = scratch_path(spark, "sample")
    sample.write_sample(sample.sample_head(table(spark, sf_dir, "orders"), ["o_orderkey"], SAMPLE_ROWS), out)
    return spark.read.parquet(out)


@register("file_head", f"SELECT * FROM lineitem LIMIT {SAMPLE_ROWS}")
def q_file_head(spark, sf_dir):
    # the fixture maker as the reference runs it: the first rows of a file in
    # file order (lineitem has no unique key to order by), written as one file
    from monthwise.compat import minimize_parquet
    from monthwise.session import scratch_path, table_path

    out = scratch_path(spark, "file-head")
    minimize_parquet(spark, table_path(sf_dir, "lineitem"), out, SAMPLE_ROWS)
    return spark.read.parquet(out)


@register(
    "sample_per_month",
    f"""
SELECT * FROM (
  SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CAST(row_number() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderkey) AS BIGINT) AS rn
  FROM orders) s
WHERE rn <= {SAMPLE_ROWS}
""",
)
def q_sample_per_month(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("date", cal.month_start("o_orderdate"))
    out = sample.sample_per_month(o, ["o_orderkey"], SAMPLE_ROWS)
    return out.withColumn("rn", F.col("rn").cast("long"))


# --- newest file per month -----------------------------------------------


def _orders_listing(spark, sf_dir) -> DataFrame:
    """A landing listing derived from orders: every order is one arrival of
    its month's file, named with the month and the order key, arriving at the
    order time."""
    o = table(spark, sf_dir, "orders")
    path = F.concat(
        F.lit("landing/"),
        cal.landing_file_name(cal.month_start("o_orderdate"), suffix=""),
        F.lit("-"),
        F.col("o_orderkey").cast("string"),
        F.lit(".parquet"),
    )
    return o.select(path.alias("path"), F.col("o_orderdate").alias("modificationTime"), F.col("o_totalprice").cast("long").alias("length"))


@register(
    "newest_file",
    """
WITH l AS (
  SELECT 'landing/yellow_tripdata_' || strftime(o_orderdate, '%Y_%m') || '-' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS path,
         o_orderdate AS modificationTime,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS date
  FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY modificationTime DESC, path DESC) AS k,
             count(*) OVER (PARTITION BY date) AS n_files FROM l)
SELECT date, path, modificationTime, n_files FROM r WHERE k = 1
""",
)
def q_newest_file(spark, sf_dir):
    from monthwise.sources.landing import newest_file_per_month, with_month

    return newest_file_per_month(with_month(_orders_listing(spark, sf_dir)))


# --- flagship -------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips -> conform -> rows per month, ordered (answers the table's
    ``select date, count(*) ... group by 1 order by 1``)."""
    return checks.month_counts(lineitem_trips(spark, sf_dir)).orderBy("date")


@register(
    "flagship_counts",
    f"SELECT date, count(*) AS cnt FROM {_sql_conformed(LINEITEM_TRIPS_SQL)} t GROUP BY 1 ORDER BY 1",
)
def q_flagship_counts(spark, sf_dir):
    return flagship(spark, sf_dir)


# --- publish / reload / retire / ledger (write to the shared scratch folder) ---

ROW_LIMIT = 10  # fixed value: rows staged per month by the optional limit


def _load_root(spark: SparkSession, name: str) -> tuple[str, str]:
    from monthwise.session import scratch_path

    root = scratch_path(spark, name)
    return f"{root}/target", f"{root}/ledger"


def _load_all_orders(spark, sf_dir, name):
    from monthwise.plans.load import load_months

    target, ledger_root = _load_root(spark, name)
    # the month of a row comes from its timestamp, so every split holds many
    # months: rebalance by month before the partitioned write
    load_months(spark, orders_trips(spark, sf_dir), target, ledger_root, contract=CONTRACT, rebalance=True)
    return target, ledger_root


def _reload(spark, sf_dir, target, ledger_root, month: str, empty: bool = False):
    from monthwise.plans.load import load_months

    m = cal.run_date(month)
    frame = checks.month_slice(orders_trips(spark, sf_dir), m, time_col="tpep_pickup_datetime")
    if empty:
        frame = frame.where(F.lit(False))
    months = spark.range(1).select(m.alias("date"))
    return load_months(spark, frame, target, ledger_root, months=months, contract=CONTRACT)


@register("publish_month", ORDERS_TRIPS_SQL)
def q_publish_month(spark, sf_dir):
    from monthwise.plans.load import read_target

    target, _ = _load_all_orders(spark, sf_dir, "publish")
    return read_target(spark, target, CONTRACT)


HOT_STATUS = "F"  # orders of this status (a third of all rows) all fall in one month


def _hot_month_trips(spark, sf_dir):
    """Orders as trips, with every order of one status moved into the slice
    month: that month holds a third of all rows."""
    t = orders_trips(spark, sf_dir)
    hot = F.when(F.col("store_and_fwd_flag") == HOT_STATUS, cal.run_date(SLICE_MONTH)).otherwise(F.col("date"))
    return t.withColumn("date", hot)


@register(
    "hot_month_publish",
    f"""
SELECT * REPLACE (CASE WHEN store_and_fwd_flag = '{HOT_STATUS}' THEN DATE '{SLICE_MONTH}' ELSE date END AS date)
FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
""",
)
def q_hot_month_publish(spark, sf_dir):
    # publish under skew: the rebalance by month lets AQE split the hot
    # month over many write tasks instead of one
    from monthwise.plans.load import load_months, read_target

    target, ledger_root = _load_root(spark, "hot")
    load_months(spark, _hot_month_trips(spark, sf_dir), target, ledger_root, contract=CONTRACT, rebalance=True)
    return read_target(spark, target, CONTRACT)


@register("reload_month", ORDERS_TRIPS_SQL)
def q_reload_month(spark, sf_dir):
    from monthwise.plans.load import read_target

    target, ledger_root = _load_all_orders(spark, sf_dir, "reload")
    _reload(spark, sf_dir, target, ledger_root, SLICE_MONTH)
    _reload(spark, sf_dir, target, ledger_root, SLICE_MONTH)
    return read_target(spark, target, CONTRACT)


@register(
    "retire_empty_month",
    f"SELECT * FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t WHERE date <> DATE '{SLICE_MONTH}'",
)
def q_retire_empty_month(spark, sf_dir):
    from monthwise.plans.load import read_target

    target, ledger_root = _load_all_orders(spark, sf_dir, "retire")
    _reload(spark, sf_dir, target, ledger_root, SLICE_MONTH, empty=True)
    return read_target(spark, target, CONTRACT)


@register(
    "ledger_replace",
    f"""
SELECT CASE WHEN date = DATE '{SLICE_MONTH}' THEN CAST(0 AS BIGINT) ELSE count(*) END AS cnt, date
FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date
""",
)
def q_ledger_replace(spark, sf_dir):
    # full load, the slice month reloaded twice, then reloaded empty, then
    # the log compacted: still one ledger row per month, the emptied month
    # with cnt = 0
    target, ledger_root = _load_all_orders(spark, sf_dir, "ledger")
    _reload(spark, sf_dir, target, ledger_root, SLICE_MONTH)
    _reload(spark, sf_dir, target, ledger_root, SLICE_MONTH)
    _reload(spark, sf_dir, target, ledger_root, SLICE_MONTH, empty=True)
    ledger.compact_ledger(spark, ledger_root)
    return ledger.read_ledger(spark, ledger_root)


@register(
    "row_limit_load",
    f"""
SELECT date, LEAST(count(*), {ROW_LIMIT}) AS published_cnt, count(*) AS ledger_cnt
FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date
""",
)
def q_row_limit_load(spark, sf_dir):
    # which rows are staged is unspecified; how many per month is not
    from monthwise.plans.load import load_months, read_target

    target, ledger_root = _load_root(spark, "limit")
    load_months(
        spark, orders_trips(spark, sf_dir), target, ledger_root, contract=CONTRACT, row_limit=ROW_LIMIT, rebalance=True
    )
    published = checks.month_counts(read_target(spark, target, CONTRACT)).withColumnRenamed("cnt", "published_cnt")
    lg = ledger.read_ledger(spark, ledger_root).withColumnRenamed("cnt", "ledger_cnt")
    return published.join(lg, "date", "full_outer").select("date", "published_cnt", "ledger_cnt")


# --- landing files: mixed schemas, incremental arrival --------------------

SCHEMA_CHANGE_MONTH = "1998-01-01"


def _orders_month_files_raw(spark, sf_dir):
    """Orders as two generations of month files: before the change month
    ``VendorID`` is bigint, ``passenger_count`` double, ``airport_fee`` double
    and an extra column rides along; from it on ``VendorID`` is int,
    ``passenger_count`` int, ``airport_fee`` bigint, ``store_and_fwd_flag`` is
    gone."""
    return _orders_generations(spark, sf_dir, cal.month_start("o_orderdate") < cal.run_date(SCHEMA_CHANGE_MONTH))


def _orders_generations(spark, sf_dir, is_old):
    o = table(spark, sf_dir, "orders")
    month = cal.month_start("o_orderdate")
    old = o.where(is_old).select(
        F.col("o_custkey").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.length("o_orderpriority").cast("double").alias("passenger_count"),
        F.col("o_orderstatus").alias("store_and_fwd_flag"),
        F.col("o_orderkey").alias("PULocationID"),
        F.col("o_totalprice").alias("fare_amount"),
        F.col("o_totalprice").alias("airport_fee"),
        F.col("o_orderpriority").alias("priority_note"),
        month.alias("date"),
    )
    new = o.where(~is_old).select(
        F.col("o_custkey").cast("int").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.length("o_orderpriority").cast("int").alias("passenger_count"),
        F.col("o_orderkey").alias("PULocationID"),
        F.col("o_totalprice").alias("fare_amount"),
        F.col("o_totalprice").cast("long").alias("airport_fee"),
        month.alias("date"),
    )
    return old, new


_MIXED_SQL = f"""
SELECT CAST(o_custkey AS BIGINT) AS vendor_id,
       CAST(o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
       CAST(NULL AS TIMESTAMP) AS tpep_dropoff_datetime,
       CAST(length(o_orderpriority) AS DOUBLE) AS passenger_count,
       CAST(NULL AS DOUBLE) AS trip_distance,
       CAST(NULL AS DOUBLE) AS ratecode_id,
       CASE WHEN date_trunc('month', o_orderdate) < DATE '{SCHEMA_CHANGE_MONTH}' THEN o_orderstatus END AS store_and_fwd_flag,
       CAST(o_orderkey AS BIGINT) AS pu_location_id,
       CAST(NULL AS BIGINT) AS do_location_id,
       CAST(NULL AS BIGINT) AS payment_type,
       CAST(o_totalprice AS DOUBLE) AS fare_amount,
       CAST(NULL AS DOUBLE) AS extra,
       CAST(NULL AS DOUBLE) AS mta_tax,
       CAST(NULL AS DOUBLE) AS tip_amount,
       CAST(NULL AS DOUBLE) AS tolls_amount,
       CAST(NULL AS DOUBLE) AS improvement_surcharge,
       CAST(NULL AS DOUBLE) AS total_amount,
       CAST(NULL AS DOUBLE) AS congestion_surcharge,
       TRY_CAST(trunc(o_totalprice) AS INTEGER) AS airport_fee,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS date
FROM orders
"""


@register("mixed_schema_scan", _MIXED_SQL)
def q_mixed_schema_scan(spark, sf_dir):
    from monthwise.session import scratch_path
    from monthwise.sources.landing import write_month_files

    landing = scratch_path(spark, "landing")
    old, new = _orders_month_files_raw(spark, sf_dir)
    write_month_files(spark, old, landing)
    write_month_files(spark, new, landing)
    return _months_of(spark, sf_dir)(landing)


@register("incremental_load", _MIXED_SQL)
def q_incremental_load(spark, sf_dir):
    from monthwise.plans.load import read_target
    from monthwise.sources.landing import write_month_files

    job = _stream(spark, "incremental")
    old, new = _orders_month_files_raw(spark, sf_dir)
    write_month_files(spark, old, job.landing)
    job.run_available(spark)  # first arrival: the old generation
    write_month_files(spark, new, job.landing)
    job.run_available(spark)  # second arrival: only the new files load
    job.run_available(spark)  # nothing new: no batch
    return read_target(spark, job.target_root, CONTRACT)


def _months_of(spark, sf_dir):
    from monthwise.sources.footers import listing_tasks
    from monthwise.sources.landing import list_files, month_units, scan_months

    def back(landing):
        with listing_tasks(spark):
            units = month_units(list_files(spark, landing, recursive=True)).select("scans").collect()
        return scan_months(spark, [p for r in units for p in r["scans"]], CONTRACT)

    return back


PART_ROWS = 150  # rows per part file of a month that comes in parts


@register("split_month_files", ORDERS_TRIPS_SQL)
def q_split_month_files(spark, sf_dir):
    # months delivered as several part files: every part is read
    from monthwise.session import scratch_path
    from monthwise.sources.landing import write_month_files

    landing = scratch_path(spark, "split")
    write_month_files(spark, orders_trips_raw(spark, sf_dir), landing, layout="file", max_records=PART_ROWS)
    return _months_of(spark, sf_dir)(landing)


_PARITY_SQL = _MIXED_SQL.replace(
    f"date_trunc('month', o_orderdate) < DATE '{SCHEMA_CHANGE_MONTH}'", "o_orderkey % 2 = 0"
)


@register("mixed_folder_scan", _PARITY_SQL)
def q_mixed_folder_scan(spark, sf_dir):
    # month folders that hold files of both generations: each file is read by
    # its own schema, so no value turns null
    from monthwise.session import scratch_path
    from monthwise.sources import fs
    from monthwise.sources.landing import write_month_files

    root = scratch_path(spark, "mixed-folder")
    old, new = _orders_generations(spark, sf_dir, F.col("o_orderkey") % 2 == 0)
    write_month_files(spark, old, f"{root}/a")
    moves = []
    for folder in write_month_files(spark, new, f"{root}/b"):
        into = f"{root}/a/{folder.rsplit('/', 1)[-1]}"
        parts = [part for part in fs.list_dir(spark, folder) if part.endswith(".parquet")]
        moves += [(f"{folder}/{part}", f"{into}/{part}") for part in parts]
    fs.replace_all(spark, moves)
    return _months_of(spark, sf_dir)(f"{root}/a")


def _stream(spark, name, **options):
    from monthwise.session import scratch_path
    from monthwise.streaming.incremental import IncrementalLoad

    root = scratch_path(spark, name)
    return IncrementalLoad(
        landing=f"{root}/landing", target_root=f"{root}/target", ledger_root=f"{root}/ledger",
        checkpoint=f"{root}/checkpoint", contract=CONTRACT, **options,
    )


DAY_MS = 86_400_000


@register("late_month_load", _MIXED_SQL)
def q_late_month_load(spark, sf_dir):
    # the new generation comes first; the old one follows with file times
    # months older, as a copy that preserves times has them: it loads too
    import time

    from monthwise.plans.load import read_target
    from monthwise.sources import fs
    from monthwise.sources.landing import write_month_files

    job = _stream(spark, "late")
    old, new = _orders_month_files_raw(spark, sf_dir)
    write_month_files(spark, new, job.landing, layout="file")
    job.run_available(spark)
    for f in write_month_files(spark, old, job.landing, layout="file"):
        fs.set_modified(spark, f, int(time.time() * 1000) - 90 * DAY_MS)
    job.run_available(spark)
    return read_target(spark, job.target_root, CONTRACT)


@register("archived_load", _MIXED_SQL)
def q_archived_load(spark, sf_dir):
    # loaded files are moved away by the stream; what they held stays loaded
    from monthwise.plans.load import read_target
    from monthwise.sources.landing import write_month_files

    job = _stream(spark, "archived", clean_source="archive")
    job.archive_dir = job.landing.replace("/landing", "/archive")
    old, new = _orders_month_files_raw(spark, sf_dir)
    write_month_files(spark, old, job.landing, layout="file")
    job.run_available(spark)
    write_month_files(spark, new, job.landing, layout="file")
    job.run_available(spark)
    return read_target(spark, job.target_root, CONTRACT)


@register("archived_parts_load", _MIXED_SQL)
def q_archived_parts_load(spark, sf_dir):
    # deliveries of numbered parts and of folders go to the archive as a whole;
    # parts that come after their fellows went are loaded with them
    from monthwise.plans.load import read_target
    from monthwise.sources import fs
    from monthwise.sources.landing import write_month_files
    from monthwise.streaming.deliveries import unit_of

    job = _stream(spark, "parts", clean_source="archive")
    job.archive_dir = job.landing.replace("/landing", "/archive")
    old, new = _orders_month_files_raw(spark, sf_dir)
    # the last part of every old month is held back
    parts = write_month_files(spark, old, f"{job.landing}-held", layout="file", max_records=PART_ROWS)
    months: dict[str, list[str]] = {}
    for p in parts:
        months.setdefault(unit_of(p), []).append(p)
    late = {files[-1] for files in months.values() if len(files) > 1}
    for wave in ([p for p in parts if p not in late], sorted(late)):
        fs.replace_all(spark, [(p, f"{job.landing}/{p.rsplit('/', 1)[-1]}") for p in wave])
        job.run_available(spark)
    write_month_files(spark, new, job.landing)
    job.run_available(spark)
    return read_target(spark, job.target_root, CONTRACT)


@register("persisted_load", f"SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date")
def q_persisted_load(spark, sf_dir):
    # the frame kept for the count and the write; the ledger has the counts
    from monthwise.plans.load import load_months

    target, ledger_root = _load_root(spark, "persisted")
    load_months(spark, orders_trips(spark, sf_dir), target, ledger_root, contract=CONTRACT, rebalance=True, persist=True)
    return ledger.read_ledger(spark, ledger_root).select("date", "cnt")


@register("ledger_compact", f"SELECT count(*) + 1 AS cnt, date FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date")
def q_ledger_compact(spark, sf_dir):
    # three entries per month, then the log compacted: the last one is left
    from monthwise.session import scratch_path

    root = scratch_path(spark, "compact")
    counts = checks.month_counts(orders_trips(spark, sf_dir))
    for off in (5, 3, 1):
        ledger.ledger_replace(counts.select("date", (F.col("cnt") + off).alias("cnt")), root)
    ledger.compact_ledger(spark, root)
    log = ledger.read_ledger_log(spark, root)  # one entry per month is left
    return log.select("cnt", "date")


# --- file names for an ingest manifest --------------------------------------

_URL_PATH_SQL = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
def _url_schemes_sql() -> str:
    from monthwise.functions.filenames import PARAM_SCHEMES

    return ", ".join(f"'{x}'" for x in PARAM_SCHEMES)


_URL_SCHEMES_SQL = _url_schemes_sql()
_URL_LAST_SQL = f"""
(CASE WHEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) IN ({_URL_SCHEMES_SQL})
      THEN split_part(string_split({_URL_PATH_SQL}, '/')[-1], ';', 1)
      ELSE string_split({_URL_PATH_SQL}, '/')[-1] END)"""
_URL_NAME_SQL = f"""
CASE WHEN length(trim({_URL_LAST_SQL}, ' ' || chr(10) || chr(9) || '.')) > 0
     THEN {_URL_LAST_SQL} END"""


@register(
    "url_file_name",
    f"""
SELECT page_id, url, {_URL_NAME_SQL} AS url_name,
       coalesce(nullif({_URL_NAME_SQL}, ''), 'download.wget') AS file_name
FROM pages
""",
)
def q_url_file_name(spark, sf_dir):
    from monthwise.functions import filenames as fn

    p = table(spark, sf_dir, "pages").select("page_id", "url")
    name = fn.url_file_name("url")
    return p.select("page_id", "url", name.alias("url_name"), fn.pick_file_name(url_name=name).alias("file_name"))


def _doc_headers(spark, sf_dir):
    """Response header text per document, built from its source and id; the
    language picks one of several Content-Disposition shapes."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id").cast("string")
    disp = (
        F.when(F.col("lang") == "en", F.concat(F.lit('attachment; filename="'), F.col("source"), F.lit("/"), doc, F.lit('.txt"')))
        .when(F.col("lang") == "de", F.concat(F.lit("INLINE;filename="), F.col("source"), F.lit(".txt")))
        .when(F.col("lang") == "fr", F.concat(F.lit("form-data; filename="), doc, F.lit(".txt")))
        .otherwise(F.concat(F.lit("attachment; filename=a.txt; filename="), doc, F.lit(".txt")))
    )
    text = F.concat(F.lit("Content-Type: text/plain\nContent-Disposition: "), disp, F.lit("\nX-Source: "), F.col("source"))
    return d.select("doc_id", text.alias("headers"))


_HEADERS_SQL = """
SELECT doc_id,
       'Content-Type: text/plain' || chr(10) || 'Content-Disposition: ' ||
       CASE lang WHEN 'en' THEN 'attachment; filename="' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt"'
                 WHEN 'de' THEN 'INLINE;filename=' || source || '.txt'
                 WHEN 'fr' THEN 'form-data; filename=' || CAST(doc_id AS VARCHAR) || '.txt'
                 ELSE 'attachment; filename=a.txt; filename=' || CAST(doc_id AS VARCHAR) || '.txt' END
       || chr(10) || 'X-Source: ' || source AS headers
FROM documents
"""


@register(
    "header_file_name",
    f"""
WITH h AS ({_HEADERS_SQL}),
v AS (SELECT doc_id, headers,
             nullif(regexp_extract(headers, '(?ms)\\A.*^Content-Disposition:([^\\r\\n]*)', 1), '') AS disp FROM h),
p AS (SELECT *, string_split(disp, ';') AS parts FROM v),
f AS (SELECT *, list_filter(parts[2:], lambda x: starts_with(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), 'filename=')) AS fparts
      FROM p),
n AS (SELECT *, regexp_extract(trim(split_part(fparts[1], '=', 2), ' ' || chr(9) || '"'), '[^/]*$') AS nm FROM f)
SELECT doc_id, headers,
       CASE WHEN len(parts) > 1
             AND lower(regexp_replace(parts[1], '^\\s+|\\s+$', '', 'g')) IN ('inline', 'attachment')
             AND len(fparts) = 1 AND nm <> '' THEN nm END AS header_name,
       coalesce(CASE WHEN len(parts) > 1
             AND lower(regexp_replace(parts[1], '^\\s+|\\s+$', '', 'g')) IN ('inline', 'attachment')
             AND len(fparts) = 1 AND nm <> '' THEN nm END, 'download.wget') AS file_name
FROM n
""",
)
def q_header_file_name(spark, sf_dir):
    from monthwise.functions import filenames as fn

    h = _doc_headers(spark, sf_dir)
    name = fn.header_file_name("headers")
    return h.select("doc_id", "headers", name.alias("header_name"), fn.pick_file_name(header_name=name).alias("file_name"))


@register(
    "quoted_path",
    f"""
SELECT page_id, {_URL_PATH_SQL} AS path,
       array_to_string(list_transform(string_split({_URL_PATH_SQL}, '/'), lambda s: url_encode(s)), '/') AS quoted_path
FROM pages
""",
)
def q_quoted_path(spark, sf_dir):
    from monthwise.functions import filenames as fn

    p = table(spark, sf_dir, "pages").select("page_id", fn.url_path("url").alias("path"))
    return p.select("page_id", "path", fn.quote_path("path").alias("quoted_path"))


@register(
    "numbered_names",
    f"""
WITH n AS (SELECT page_id, coalesce(nullif({_URL_NAME_SQL}, ''), 'download.wget') AS name FROM pages),
s AS (SELECT *, CASE WHEN instr(name, '.') > 0 THEN regexp_extract(name, '^(.*)\\.[^.]*$', 1) ELSE name END AS stem,
             CASE WHEN instr(name, '.') > 0 THEN regexp_extract(name, '\\.([^.]*)$', 1) END AS ext,
             row_number() OVER (PARTITION BY name ORDER BY page_id) AS occ FROM n),
b AS (SELECT regexp_extract(stem, '^(.*) \\(([0-9]+)\\)$', 1) AS bstem,
             max(CAST(regexp_extract(stem, '^(.*) \\(([0-9]+)\\)$', 2) AS BIGINT)) AS base
      FROM s WHERE regexp_extract(stem, '^(.*) \\(([0-9]+)\\)$', 2) <> '' GROUP BY 1),
c AS (SELECT s.*, row_number() OVER (PARTITION BY stem ORDER BY page_id) AS k FROM s WHERE occ > 1)
SELECT page_id, name, name AS final_name FROM s WHERE occ = 1
UNION ALL
SELECT c.page_id, c.name,
       c.stem || ' (' || CAST(coalesce(b.base, 0) + c.k AS VARCHAR) || ')' || coalesce('.' || c.ext, '') AS final_name
FROM c LEFT JOIN b ON b.bstem = c.stem
""",
)
def q_numbered_names(spark, sf_dir):
    from monthwise.functions import filenames as fn

    p = table(spark, sf_dir, "pages")
    names = p.select("page_id", fn.pick_file_name(url_name=fn.url_file_name("url")).alias("name"))
    return fn.number_taken_names(names, "name", ["page_id"]).select("page_id", "name", "final_name")


@register(
    "numbered_names_existing",
    f"""
WITH u AS (SELECT page_id, coalesce(nullif({_URL_NAME_SQL}, ''), 'download.wget') AS name FROM pages),
n AS (SELECT page_id, CASE WHEN page_id % 53 = 0 THEN NULL ELSE name END AS name FROM u WHERE page_id % 11 <> 0),
e AS (SELECT DISTINCT name FROM u WHERE page_id % 11 = 0
      UNION SELECT DISTINCT regexp_replace(name, '^([^.]*)', '\\1 (3)') FROM u WHERE page_id % 11 = 0),
s AS (SELECT *, CASE WHEN instr(name, '.') > 0 THEN regexp_extract(name, '^(.*)\\.[^.]*$', 1) ELSE name END AS stem,
             CASE WHEN instr(name, '.') > 0 THEN regexp_extract(name, '\\.([^.]*)$', 1) END AS ext,
             name IS NOT NULL AND (row_number() OVER (PARTITION BY name ORDER BY page_id) > 1
                                   OR name IN (SELECT name FROM e)) AS taken FROM n),
a AS (SELECT CASE WHEN instr(name, '.') > 0 THEN regexp_extract(name, '^(.*)\\.[^.]*$', 1) ELSE name END AS stem
      FROM (SELECT name FROM n UNION ALL SELECT name FROM e) z WHERE name IS NOT NULL),
b AS (SELECT regexp_extract(stem, '^(.*) \\(([0-9]+)\\)$', 1) AS bstem,
             max(CAST(regexp_extract(stem, '^(.*) \\(([0-9]+)\\)$', 2) AS BIGINT)) AS base
      FROM a WHERE regexp_extract(stem, '^(.*) \\(([0-9]+)\\)$', 2) <> '' GROUP BY 1),
c AS (SELECT s.*, row_number() OVER (PARTITION BY stem ORDER BY page_id) AS k FROM s WHERE taken)
SELECT page_id, name, name AS final_name FROM s WHERE NOT taken
UNION ALL
SELECT c.page_id, c.name,
       c.stem || ' (' || CAST(coalesce(b.base, 0) + c.k AS VARCHAR) || ')' || coalesce('.' || c.ext, '') AS final_name
FROM c LEFT JOIN b ON b.bstem = c.stem
""",
)
def q_numbered_names_existing(spark, sf_dir):
    # some names are null and stay so; others are taken by names that exist
    # already, also with an index
    from monthwise.functions import filenames as fn

    p = table(spark, sf_dir, "pages")
    names = p.select("page_id", fn.pick_file_name(url_name=fn.url_file_name("url")).alias("name"))
    there = names.where("page_id % 11 = 0").select("name")
    existing = there.union(there.select(F.regexp_replace("name", "^([^.]*)", "$1 (3)")))
    new = names.where("page_id % 11 <> 0").withColumn("name", F.when(F.col("page_id") % 53 != 0, F.col("name")))
    return fn.number_taken_names(new, "name", ["page_id"], existing=existing).select("page_id", "name", "final_name")


@register(
    "header_forms",
    """
SELECT doc_id, CAST(doc_id AS VARCHAR) || '.txt' AS from_map, source || '.txt' AS from_list FROM documents
""",
)
def q_header_forms(spark, sf_dir):
    # headers as a map, and as a list of lines
    from monthwise.functions import filenames as fn

    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id").cast("string")
    as_map = F.create_map(F.lit("Content-Type"), F.lit("text/plain"), F.lit("Content-Disposition"), F.concat(F.lit("attachment; filename="), doc, F.lit(".txt")))
    as_list = F.array(F.lit("X-A: b"), F.concat(F.lit('Content-Disposition: inline; filename="'), F.col("source"), F.lit('.txt"')))
    return d.select("doc_id", fn.header_map_file_name(as_map).alias("from_map"), fn.header_list_file_name(as_list).alias("from_list"))


# --- JDBC sink (in-process Derby: the only database a local test may use) ----


def _derby(spark, name):
    import uuid

    from monthwise.sources.jdbc import derby_memory

    return derby_memory(f"{name}_{uuid.uuid4().hex[:8]}")


@register(
    "jdbc_replace_append",
    f"""
SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date
UNION ALL
SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date
""",
)
def q_jdbc_replace_append(spark, sf_dir):
    # the count ledger over JDBC: replace, then append the same counts again
    # (an append is not idempotent -- that is what the replace form is for)
    from monthwise.sources import jdbc

    db = _derby(spark, "ledger")
    counts = checks.month_counts(orders_trips(spark, sf_dir)).select("date", "cnt")
    jdbc.replace_table(counts, db, "ledger_cnt", num_partitions=4)
    jdbc.append_table(counts, db, "ledger_cnt", num_partitions=4)
    return jdbc.read_table(spark, db, "ledger_cnt").select(
        F.col("date").cast("date").alias("date"), F.col("cnt").cast("long").alias("cnt")
    )


@register(
    "jdbc_swap_month",
    f"""
SELECT date, count(*) AS cnt, sum(pu_location_id) AS keys
FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
WHERE date <> DATE '{SLICE_MONTH}' OR store_and_fwd_flag = '{HOT_STATUS}' GROUP BY date
""",
)
def q_jdbc_swap_month(spark, sf_dir):
    # all months into a JDBC table; then one month delivered anew takes the
    # place of its old rows in one transaction
    from monthwise.sources import jdbc

    db = _derby(spark, "swap")
    trips = orders_trips(spark, sf_dir).select("date", "pu_location_id", "store_and_fwd_flag")
    jdbc.swap_table(trips, db, "trips")
    again = trips.where((F.col("date") == cal.run_date(SLICE_MONTH)) & (F.col("store_and_fwd_flag") == HOT_STATUS))
    jdbc.swap_table(again, db, "trips", key="date")
    back = jdbc.read_table(spark, db, "trips")
    return back.groupBy("date").agg(F.count(F.lit(1)).alias("cnt"), F.sum("pu_location_id").alias("keys"))


@register("jdbc_ledger_replace", f"SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t GROUP BY date")
def q_jdbc_ledger_replace(spark, sf_dir):
    # the count table of a JDBC target, recorded by two runs: one row per month
    from monthwise.sources import jdbc

    db = _derby(spark, "counts")
    counts = [(r["cnt"], r["date"]) for r in checks.month_counts(orders_trips(spark, sf_dir)).collect()]  # a row a month
    jdbc.replace_rows(spark, db, "ny_yellow_cnt", "date", ["cnt", "date"], [(c + 7, d) for c, d in counts])
    jdbc.replace_rows(spark, db, "ny_yellow_cnt", "date", ["cnt", "date"], counts)
    return jdbc.read_table(spark, db, "ny_yellow_cnt").select(
        F.col("date").cast("date").alias("date"), F.col("cnt").cast("long").alias("cnt")
    )


@register("jdbc_stage_roundtrip", ORDERS_TRIPS_SQL)
def q_jdbc_stage_roundtrip(spark, sf_dir):
    # a month stage table written twice with replace holds the rows once;
    # truncate keeps the table definition, parallel inserts by partition
    from monthwise.sources import jdbc

    db = _derby(spark, "stage")
    trips = orders_trips(spark, sf_dir)
    jdbc.replace_table(trips, db, "stage_trips", num_partitions=8)
    jdbc.replace_table(trips, db, "stage_trips", truncate=True, num_partitions=8)
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).first()
    back = jdbc.read_table(
        spark, db, "stage_trips", partition_column="pu_location_id", lower=ends["lo"] or 0, upper=(ends["hi"] or 0) + 1,
        num_partitions=8,
    )
    return back.select(*[F.col(c).cast(t).alias(c) for c, t in ((f.name, f.dataType) for f in CONTRACT.schema.fields)])


# --- catalog form: external table, zero-copy attach, detach ----------------


@register(
    "catalog_attach_detach",
    f"""
SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
WHERE date <> DATE '{SLICE_MONTH}' GROUP BY 1 ORDER BY 1
""",
)
def q_catalog_attach_detach(spark, sf_dir):
    import datetime as dt
    import uuid

    from monthwise.plans import catalog
    from monthwise.plans.load import partition_path, publish_months
    from monthwise.session import scratch_path
    from monthwise.sources import fs

    root = scratch_path(spark, "catalog")
    db = f"mw_{uuid.uuid4().hex[:8]}"
    target, _ = catalog.init_tables(spark, root, db=db, stage_db=f"{db}_stage", contract=CONTRACT)
    # every month staged in its own folder, then attached by location
    staged = f"{root}/staged"
    publish_months(orders_trips(spark, sf_dir), staged, rebalance=True)
    months = {
        dt.date.fromisoformat(d.split("=", 1)[1]): partition_path(staged, dt.date.fromisoformat(d.split("=", 1)[1]))
        for d in fs.list_dir(spark, staged)
        if d.startswith("date=")
    }
    catalog.attach_months(spark, target, months)
    catalog.detach_months(spark, target, [dt.date.fromisoformat(SLICE_MONTH)])
    return catalog.month_counts_sql(spark, target)


@register(
    "catalog_listing",
    f"""
SELECT 'ny_yellow' AS table_name, count(*) AS cnt, count(DISTINCT date) AS months FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
UNION ALL
SELECT 'yellow_tripdata_1998_07', count(*), count(DISTINCT date) FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
WHERE date = DATE '{SLICE_MONTH}'
""",
)
def q_catalog_listing(spark, sf_dir):
    # databases and tables as the catalog lists them; the stage table is made
    # LIKE the target, and one month's folder under it is registered
    import uuid

    from monthwise.plans import catalog
    from monthwise.plans.load import publish_months
    from monthwise.session import scratch_path

    root, db = scratch_path(spark, "listing"), f"mw_{uuid.uuid4().hex[:8]}"
    target, _ = catalog.init_tables(spark, root, db=db, stage_db=f"{db}_stage", contract=CONTRACT)
    trips = orders_trips(spark, sf_dir)
    catalog.load_months_to_table(spark, trips, target, f"{db}.ny_yellow_cnt_log", contract=CONTRACT, rebalance=True)
    stage = f"{db}_stage.yellow_tripdata_1998_07"
    catalog.create_like(spark, stage, target, f"{root}/stage")
    month = checks.month_slice(trips, cal.run_date(SLICE_MONTH), time_col="tpep_pickup_datetime")
    publish_months(month, f"{root}/stage")
    catalog.recover_months(spark, stage)
    found = [t for d in (db, f"{db}_stage") if catalog.database_exists(spark, d) for t in _tables(spark, d)]
    counts = [
        spark.table(t).agg(F.lit(t.split(".")[1]).alias("table_name"), F.count(F.lit(1)).alias("cnt"), F.count_distinct("date").alias("months"))
        for t in found if "_cnt" not in t and catalog.table_exists(spark, t)
    ]
    return counts[0].unionByName(counts[1])


def _tables(spark, db):
    return sorted(f"{db}.{t.name}" for t in spark.catalog.listTables(db) if not t.isTemporary)


@register(
    "table_reload_month",
    f"""
SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
WHERE date <> DATE '{SLICE_MONTH}' OR store_and_fwd_flag = '{HOT_STATUS}'
GROUP BY 1 ORDER BY 1
""",
)
def q_table_reload_month(spark, sf_dir):
    # every month loaded into a catalog table, then the slice month
    # re-delivered with only its fulfilled orders: the catalog swaps that
    # month's location in one update and the old folder is removed
    import uuid

    from monthwise.plans import catalog
    from monthwise.session import scratch_path

    root = scratch_path(spark, "table")
    db = f"mw_{uuid.uuid4().hex[:8]}"
    target, ledger_table = catalog.init_tables(spark, root, db=db, stage_db=f"{db}_stage", contract=CONTRACT)
    trips = orders_trips(spark, sf_dir)
    catalog.load_months_to_table(spark, trips, target, ledger_table, contract=CONTRACT, rebalance=True)
    m = cal.run_date(SLICE_MONTH)
    redelivered = checks.month_slice(trips, m, time_col="tpep_pickup_datetime").where(
        F.col("store_and_fwd_flag") == HOT_STATUS
    )
    catalog.load_months_to_table(
        spark, redelivered, target, ledger_table, months=spark.range(1).select(m.alias("date")), contract=CONTRACT
    )
    return catalog.month_counts_sql(spark, target)


@register(
    "run_switch",
    f"""
SELECT date, count(*) AS cnt FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t
WHERE (date <> DATE '{SLICE_MONTH}' OR store_and_fwd_flag = '{HOT_STATUS}') AND date <> DATE '{SHORT_MONTH}'
GROUP BY 1
""",
)
def q_run_switch(spark, sf_dir):
    # all months as one run; then a run that brings one month anew and retires
    # another, both at once, by one change of the view that readers use
    import uuid

    from monthwise.plans import catalog, runs
    from monthwise.session import scratch_path

    root, db = scratch_path(spark, "runs"), f"mw_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, db)
    view = f"{db}.ny_yellow"
    runs.create_published(spark, view, f"{root}/t", CONTRACT)
    trips = orders_trips(spark, sf_dir)
    runs.load_run(spark, trips, view, f"{root}/l", contract=CONTRACT, rebalance=True)
    again = checks.month_slice(trips, cal.run_date(SLICE_MONTH), time_col="tpep_pickup_datetime")
    months = spark.range(1).select(F.explode(F.array(cal.run_date(SLICE_MONTH), cal.run_date(SHORT_MONTH))).alias("date"))
    runs.load_run(
        spark, again.where(F.col("store_and_fwd_flag") == HOT_STATUS), view, f"{root}/l", months=months, contract=CONTRACT
    )
    return checks.month_counts(spark.table(view))


@register(
    "target_month_slice",
    f"SELECT * FROM {_sql_conformed(ORDERS_TRIPS_SQL)} t WHERE date = DATE '{SLICE_MONTH}'",
)
def q_target_month_slice(spark, sf_dir):
    # one month of the published table: the equality on the partition key is
    # a PartitionFilter, only that month's folder is listed and read
    from monthwise.plans.load import read_target

    target, _ = _load_all_orders(spark, sf_dir, "slice")
    return read_target(spark, target, CONTRACT).where(F.col("date") == cal.run_date(SLICE_MONTH))

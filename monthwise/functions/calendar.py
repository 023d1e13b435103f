"""Month arithmetic as column expressions (all JVM-side, foldable).

Date-library tokens differ from Spark's: a four-digit year is ``yyyy`` in
Spark (``YYYY`` is the week-based year and is rejected), day is ``dd``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Landing-file naming of a month.
LANDING_PREFIX = "yellow_tripdata_"
LANDING_SUFFIX = ".parquet"
STAGE_SCHEMA = "stage"
LOCAL_MONTH_FORMAT = "yyyy_MM"  # local landing file and stage table
REMOTE_MONTH_FORMAT = "yyyy-MM"  # remote file name (hyphen)
RUN_DATE_FORMAT = "yyyy-MM-dd"
BACKFILL_START = "2010-01-01"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(ts) -> Column:
    """First day of the month of a date / timestamp column, as DATE."""
    return F.trunc(_c(ts).cast("date"), "month")


def run_date(value: str | dt.date) -> Column:
    """A run date literal (``yyyy-MM-dd`` text or a date) as a DATE column.

    Constant-folded by Catalyst, so it costs nothing per row.
    """
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.to_date(F.lit(value), RUN_DATE_FORMAT)


def next_day(d) -> Column:
    return F.date_add(_c(d), 1)


def landing_file_name(month, prefix: str = LANDING_PREFIX, suffix: str = LANDING_SUFFIX) -> Column:
    """``yellow_tripdata_YYYY_MM.parquet`` for a month column."""
    return F.concat(F.lit(prefix), F.date_format(_c(month), LOCAL_MONTH_FORMAT), F.lit(suffix))


def landing_path(month, folder: str, prefix: str = LANDING_PREFIX, suffix: str = LANDING_SUFFIX) -> Column:
    folder = folder.rstrip("/")
    return F.concat(F.lit(folder + "/"), landing_file_name(month, prefix, suffix))


def stage_table_name(month, schema: str = STAGE_SCHEMA, prefix: str = LANDING_PREFIX) -> Column:
    """``stage.yellow_tripdata_YYYY_MM`` for a month column."""
    return F.concat(F.lit(f"{schema}.{prefix}"), F.date_format(_c(month), LOCAL_MONTH_FORMAT))


def remote_url(month, base_url: str, prefix: str = LANDING_PREFIX, suffix: str = LANDING_SUFFIX) -> Column:
    """Remote file URL for a month: ``<base>/yellow_tripdata_YYYY-MM.parquet``."""
    base = base_url if base_url.endswith("/") else base_url + "/"
    return F.concat(F.lit(base + prefix), F.date_format(_c(month), REMOTE_MONTH_FORMAT), F.lit(suffix))


def _digits(s: Column, n: int) -> Column:
    return (F.length(s) == n) & (F.translate(s, "0123456789", "") == "")


def month_from_file_name(path, prefix: str = LANDING_PREFIX) -> Column:
    """Month named in a landing path (``<prefix>YYYY_MM`` or ``<prefix>YYYY-MM``
    in the file or folder name: the last one in the path, else the first);
    null when the path names no month.

    It runs once per *row* when the path is ``_metadata.file_path``, so it is
    plain substring arithmetic -- no regular expression: the text after the
    ``prefix``, four digits, ``_`` or ``-``, two digits, then ``make_date``.
    On a one-column scan of 600k rows (best of 7) it cost 0.42-0.48 s against
    0.51-0.55 s for two regex extractions plus a date parse, and 0.16 s for a
    constant month: cheaper, but still per-row string work.
    """
    p = _c(path)
    found = F.instr(p, prefix)

    def month_at(tail: Column) -> Column:
        y, sep, m = F.substring(tail, 1, 4), F.substring(tail, 5, 1), F.substring(tail, 6, 2)
        mi = m.try_cast("int")
        ok = (found > 0) & _digits(y, 4) & sep.isin("_", "-") & _digits(m, 2) & mi.between(1, 12)
        return F.when(ok, F.make_date(y.try_cast("int"), mi, F.lit(1)))

    # the last occurrence (the name nearest the file), else the first
    return F.coalesce(
        month_at(F.substring_index(p, prefix, -1)), month_at(F.substring(p, found + len(prefix), 7))
    )


def months_between_frame(df: DataFrame, start: Column, end: Column, name: str = "date") -> DataFrame:
    """Explode one row per month start in ``[start, end]`` for each row of ``df``."""
    return df.select(
        F.explode(F.sequence(month_start(start), month_start(end), F.expr("INTERVAL 1 MONTH"))).alias(name)
    )


def calendar_from(df: DataFrame, ts_col: str, start: str | None = None, name: str = "date") -> DataFrame:
    """Backfill calendar: the first of every month from ``start`` (or the
    earliest month of ``ts_col``) through the latest month of ``ts_col``.

    One partial + final aggregate (two values) then a one-row explode: the
    calendar is derived from the data and grows with it in time span only.
    """
    bounds = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
    lo = run_date(start) if start is not None else F.col("lo")
    return months_between_frame(bounds.where(F.col("hi").isNotNull()), lo, F.col("hi"), name)


def calendar(spark, start: str | dt.date, end: str | dt.date, name: str = "date") -> DataFrame:
    """Months from ``start`` through ``end`` (both inclusive, month starts)."""
    return months_between_frame(spark.range(1), run_date(start), run_date(end), name)

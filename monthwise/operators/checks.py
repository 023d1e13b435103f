"""Gates that run before a month is published.

All row-level checks are expressed as *violation frames* (rows that break a
rule) or folded into **one** grouped aggregate per month, so checking N
months costs one scan with partial aggregation -- never one job per month
and never a row collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.contract import Contract, schema_diff
from monthwise.functions.calendar import next_day


class GateError(RuntimeError):
    """A gate failed; nothing was published."""


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_violations(df: DataFrame, keys: Iterable[str] = ("date",)) -> DataFrame:
    """Rows where any of ``keys`` is null, with the first failing key named."""
    keys = list(keys)
    first = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    return df.where(first.isNotNull()).withColumn("violation", first)


def in_range(value, lo, hi) -> Column:
    """Half-open ``lo <= value < hi``; a null value is *not* in range."""
    v = _c(value)
    return F.coalesce((v >= _c(lo)) & (v < _c(hi)), F.lit(False))


def range_violations(df: DataFrame, lo, hi, key: str = "date") -> DataFrame:
    """Rows whose ``key`` is outside ``[lo, hi)`` (null counts as outside)."""
    return df.where(~in_range(F.col(key), lo, hi))


def month_bounds(month) -> tuple[Column, Column]:
    """The attach range of a run month: ``[month, month + 1 day)``."""
    m = _c(month)
    return m, next_day(m)


def month_slice(df: DataFrame, month, key: str = "date", time_col: str | None = None) -> DataFrame:
    """Rows of one month: ``key = month``.

    On a table partitioned by ``key`` this is a ``PartitionFilters`` entry and
    only that month's folder is listed and read.  On a raw frame whose month
    is derived from a timestamp (``key = trunc(time_col, 'month')``), pass
    ``time_col``: the same rows are also bounded by the half-open time range
    ``[month, month + 1 month)``.  Catalyst cannot invert ``trunc``, but the
    plain range on the source column reaches the Parquet scan as
    ``PushedFilters``, so row groups of other months are skipped.
    """
    m = _c(month)
    cond = F.col(key) == m
    if time_col is not None:
        t = df.schema[time_col].dataType
        lo, hi = m.cast(t), F.add_months(m, 1).cast(t)
        cond = cond & (F.col(time_col) >= lo) & (F.col(time_col) < hi)
    return df.where(cond)


def month_gates(df: DataFrame, key: str = "date", not_null: Iterable[str] = ()) -> DataFrame:
    """One aggregate pass: per month the row count and, for each column in
    ``not_null``, how many rows are null there.

    Output: ``date, cnt, null_<col>...``.  Rows with a null ``key`` form their
    own group (``date`` null), which is itself a violation.  Partial
    aggregation makes a month holding a third of all rows no hot spot: each
    task ships one small row per month to the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias("cnt")]
    aggs += [F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}") for c in not_null]
    return df.groupBy(key).agg(*aggs)


def present_months(df: DataFrame, key: str = "date") -> DataFrame:
    """The set of months that have rows: one row per month.

    A partial aggregate runs before the shuffle, so each task sends at most
    one row per month.  Use it as the build side of an EXISTS (semi) join
    instead of the raw rows: a semi join against the rows themselves would
    shuffle every row by month, and a month holding a third of the data
    would land in one task.
    """
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def month_counts(df: DataFrame, key: str = "date") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def decision_frame(months: DataFrame, counts: DataFrame, key: str = "date") -> DataFrame:
    """Publish or drop per requested month (O-30 / O-58).

    ``months``: one row per month asked for.  ``counts``: ``key, cnt``.  A
    month without rows gets ``cnt = 0`` and action ``drop``; otherwise
    ``attach``.  Requested months are few (a calendar), the join is a
    broadcast-sized build side chosen by AQE.
    """
    j = months.select(key).distinct().join(counts.select(key, "cnt"), key, "left")
    cnt = F.coalesce(F.col("cnt"), F.lit(0)).cast("long")
    return j.select(
        F.col(key),
        cnt.alias("cnt"),
        F.when(cnt > 0, F.lit("attach")).otherwise(F.lit("drop")).alias("action"),
    )


def require_schema(df: DataFrame, expected: T.StructType | Contract) -> None:
    """Name + type match (nullability ignored); raise before any write."""
    schema = expected.schema if isinstance(expected, Contract) else expected
    diff = schema_diff(df.schema, schema)
    if diff:
        raise GateError("schema does not match the target: " + "; ".join(diff))


def gate_summary(gates: DataFrame, months: DataFrame | None, key: str = "date") -> DataFrame:
    """Collapse per-month gate rows into one row of failure totals.

    ``out_of_range``: rows in months that were not requested (or null
    month).  ``null_*``: nulls in required columns over requested months.
    """
    null_cols = [c for c in gates.columns if c.startswith("null_")]
    if months is not None:
        flagged = gates.join(
            months.select(key).distinct().withColumn("_req", F.lit(True)), key, "left"
        )
        requested = F.coalesce(F.col("_req"), F.lit(False))
    else:
        flagged = gates
        requested = F.col(key).isNotNull()
    aggs = [
        F.sum(F.when(requested, F.col("cnt")).otherwise(0)).cast("long").alias("rows_in_range"),
        F.sum(F.when(~requested, F.col("cnt")).otherwise(0)).cast("long").alias("out_of_range"),
    ] + [F.coalesce(F.sum(F.col(c)), F.lit(0)).cast("long").alias(c) for c in null_cols]
    return flagged.agg(*aggs)

"""Gates in the pass that writes: counts of the very rows written, as metrics
observed on the way (``DataFrame.observe``), so nothing is read back.

An observation has no groups, so rows per month, and lost values per month and
column, are counted by ``approx_top_k``: it keeps a count per key and is exact
while there are fewer keys than it tracks.  Months are far fewer than
``TRACKED``; whether a result was exact is checked (fewer keys than tracked,
counts that add up to the rows), and if not, the caller counts by grouping.

The observed frame must be the last one before the write, after any shuffle:
there each task's metrics count once, however often the task was tried.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from monthwise.contract import Contract
from monthwise.functions.conform import LOST
from monthwise.operators.checks import GateError

#: Keys that a count by key keeps exactly.
TRACKED = 50_000


def _counts_by(key: str) -> Column:
    return F.expr(f"approx_top_k({key}, {TRACKED}, {TRACKED})")


def gate_metrics(
    key: str, months: Sequence[dt.date] | None = None, not_null: Iterable[str] = (), lost: bool = False
) -> list[Column]:
    """The metrics that ``gates_of`` and ``lost_of`` read."""
    month = F.col(f"`{key}`")
    wanted = month.isNotNull() if months is None else F.coalesce(month.isin(list(months)), F.lit(False))
    out = [F.count(F.lit(1)).alias("rows"), F.count_if(~wanted).alias("out_of_range")]
    out += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in not_null]
    out.append(_counts_by(f"`{key}`").alias("by_month"))
    if lost:
        out.append(F.count_if(F.col(LOST) != 0).alias("rows_lost"))
        place = f"concat_ws('|', cast(`{key}` as string), cast({LOST} as string))"
        out.append(_counts_by(f"CASE WHEN {LOST} <> 0 THEN {place} END").alias("by_loss"))
    return out


def _exact(items: list[Row], total: int) -> dict | None:
    found = {r["item"]: r["count"] for r in items if r["item"] is not None}
    return found if len(items) < TRACKED and sum(found.values()) == total else None


def gates_of(metrics: dict, months: Sequence[dt.date] | None) -> dict[dt.date, int] | None:
    """Rows of each month asked for (of each month found, if ``months`` is
    None).  Raises ``GateError`` for rows of other months and for nulls; None
    if the counts by month are not exact."""
    failed = {k: v for k, v in metrics.items() if v and (k == "out_of_range" or k.startswith("null_"))}
    if failed:
        raise GateError(f"gates failed, nothing published: {failed}")
    found = _exact(metrics["by_month"], metrics["rows"])
    if found is None or months is None:
        return found
    return {m: found.get(m, 0) for m in months}


def lost_of(metrics: dict, contract: Contract) -> list[Row] | None:
    """``date, column, lost`` from the metrics; None if they are not exact."""
    found = _exact(metrics["by_loss"], metrics["rows_lost"])
    if found is None:
        return None
    lost: Counter = Counter()
    for place, n in found.items():
        month, mask = place.split("|")
        for i, name in enumerate(contract.names):
            if int(mask) >> i & 1:
                lost[(dt.date.fromisoformat(month), name)] += n
    return [Row(date=m, column=c, lost=n) for (m, c), n in sorted(lost.items())]


def lost_values(df: DataFrame, contract: Contract) -> DataFrame:
    """``date, column, lost``: the values that a cast made null, per month and
    column, of a frame conformed with ``lost=True``.  One aggregate."""
    key = contract.partition_key
    bits = [F.count_if(F.col(LOST).bitwiseAND(F.lit(1 << i)) != 0).alias(f"_{i}") for i in range(len(contract.names))]
    pairs = [F.struct(F.lit(n).alias("column"), F.col(f"_{i}").cast("long").alias("lost")) for i, n in enumerate(contract.names)]
    rows = df.groupBy(F.col(key).alias("date")).agg(*bits).select("date", F.inline(F.array(*pairs)))
    return rows.where("lost > 0")


def require_few_lost(lost: Iterable[Row], most: int | None) -> None:
    """No column of a month may have lost more than ``most`` values."""
    over = [] if most is None else [f"{r['date']} {r['column']}: {r['lost']}" for r in lost if r["lost"] > most]
    if over:
        raise GateError(f"more than {most} values lost in casts, nothing published: {over[:10]}")

"""Exact ``row_number() OVER (PARTITION BY g ORDER BY o)`` without a hot task.

A plain window sends every row of a group to one task; if one group holds a
third of all rows, that task sorts a third of the data.  Here:

1. ``repartitionByRange(g, o)`` cuts the data into contiguous, evenly sized
   ranges; a big group spans many partitions.  This is the only shuffle of
   the data.
2. Each range is sorted by (g, o), so the rows of a group inside a range are
   one run in order.  ``monotonically_increasing_id`` gives every row its
   position in the range -- no second exchange, which a window over
   (partition, group) would need because Spark does not know the partition
   id follows the range partitioning.
3. Per (group, partition): the count and the first position -- at most
   groups + partitions rows.  A running sum of counts over partitions gives
   each run's offset.
4. Global number = offset + position - first position + 1.

The positioned frame is checkpointed (reliable, under ``spark.checkpoint.dir``)
so partition ids and positions stay fixed between step 3 and the join, even
if a task or executor is lost and recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.session import ensure_checkpoint_dir


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def split_row_number(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    out: str = "rn",
    partitions: int | None = None,
) -> DataFrame:
    """``df`` plus ``out`` = row number within ``group`` ordered by ``order``
    (order must be unique within a group for a deterministic result)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group, order = list(group), list(order)

    keys = _order([*group, *order])
    local = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint()
    )

    runs = local.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_pid").alias("_opid"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_off"),
    )
    # null-safe on the group keys: a null group is a group too
    cond = [local[g].eqNullSafe(offsets[f"_g{i}"]) for i, g in enumerate(group)]
    cond.append(local["_pid"] == offsets["_opid"])
    return (
        local.join(offsets, cond)
        .withColumn(out, (F.col("_off") + F.col("_pos")).cast("long"))
        .drop("_pid", "_pos", "_off", "_opid", *[f"_g{i}" for i in range(len(group))])
    )

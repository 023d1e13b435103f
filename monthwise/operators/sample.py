"""Ordered samples: the first N rows of a frame, or of each month.

Spark has no file row order, so "first N" needs an order key; with a unique
key the sample is deterministic.  Both forms are bounded per task:

* ``sample_head`` plans as ``TakeOrderedAndProject``: each task keeps its own
  top N, the driver merges ``tasks x N`` rows.
* ``first_per_month`` filters ``row_number() <= N``.  Up to
  ``GROUP_LIMIT_ROWS`` rows Catalyst inserts a partial ``WindowGroupLimit``
  *before* the shuffle, so every task ships at most N rows per month.  Spark
  does so up to that N only, so a larger N is numbered by
  ``split_row_number``, which cuts a hot month into ranges.  Either way a
  month holding a third of all rows never lands whole in one task, and the
  rows are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.operators.sequence import split_row_number
from monthwise.sources.footers import footers, parquet_reader, read_heads
from monthwise.sources.landing import union_all

DEFAULT_SAMPLE_ROWS = 100  # fixed value: sampler default
GROUP_LIMIT_ROWS = 1000  # spark.sql.optimizer.windowGroupLimitThreshold's default


def _order(keys: Sequence[str]):
    return [F.col(k).asc_nulls_first() for k in keys]


def first_per_month(
    df: DataFrame, keys: Sequence[str], n: int, month: str | Sequence[str] = "date", rank_col: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of each month by ``keys``, with their rank.
    ``n`` must be at least 1."""
    if n < 1:
        raise ValueError(f"a row limit must be at least 1, not {n}")
    if n <= GROUP_LIMIT_ROWS:
        w = Window.partitionBy(month).orderBy(*_order(keys))
        return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    return split_row_number(df, [month], keys, out=rank_col).where(F.col(rank_col) <= n)


def sample_head(df: DataFrame, keys: Sequence[str], n: int = DEFAULT_SAMPLE_ROWS) -> DataFrame:
    return df.orderBy(*_order(keys)).limit(n)


def file_head(spark, paths: Sequence[str] | str, n: int = DEFAULT_SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows of Parquet files of one schema in file order (by
    path, then row) -- the head of a file, as a fixture maker takes it -- with
    no key needed.

    Nothing is sorted or scanned whole: the first files' footers tell how many
    rows each row group holds, more footers are read only while those hold too
    few, and then only the leading row groups that hold ``n`` rows are read.
    """
    if n < 1:
        raise ValueError(f"a row limit must be at least 1, not {n}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = parquet_reader(spark).format("binaryFile").load(paths).select("path")
    looked = 16
    while True:
        first = footers(files.orderBy("path").limit(looked))
        rows = sorted(first.select("path", "n_rows", "row_groups").collect())  # `looked` rows at most
        held = sum(r["n_rows"] or 0 for r in rows)
        if held >= n or len(rows) < looked or any(r["n_rows"] is None for r in rows):
            break
        looked *= 4
    if any(r["n_rows"] is None for r in rows):  # a file system that only Spark opens
        df = spark.read.parquet(*paths)
        return df.orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index")).limit(n)
    heads, left = [], n
    for r in rows:
        if left and r["n_rows"]:
            heads.append((r["path"], min(left, r["n_rows"]), r["row_groups"]))
            left -= heads[-1][1]
    schema = parquet_reader(spark).parquet(*paths[:1]).schema
    chosen = spark.createDataFrame(heads, "path string, wanted long, row_groups array<long>")
    out = read_heads(spark, chosen, schema, "_file", "_row")
    return out.orderBy("_file", "_row").limit(n).drop("_file", "_row")


def file_head_per_month(spark, units: Sequence[str], n: int = DEFAULT_SAMPLE_ROWS, contract=None, prefix=None):
    """The first ``n`` rows of every month unit (file or folder) in file
    order, conformed: the file-order head taken per month, as a fixture
    maker run over each month file.

    Footers give the rows of every file; a running sum per month over its
    files (a footer row each) tells which files, and how many rows of each,
    are the month's first ``n``.  One read of leading row groups per schema.
    """
    from monthwise.contract import TRIP_CONTRACT
    from monthwise.functions.calendar import LANDING_PREFIX, month_from_file_name
    from monthwise.functions.conform import conform

    if n < 1:
        raise ValueError(f"a row limit must be at least 1, not {n}")
    contract = contract or TRIP_CONTRACT
    prefix = prefix or LANDING_PREFIX
    key = contract.partition_key
    files = parquet_reader(spark).format("binaryFile").load(list(units)).select("path")
    read = footers(files.withColumn("_month", month_from_file_name(F.col("path"), prefix)))
    before = Window.partitionBy("_month").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(n) - F.coalesce(F.sum("n_rows").over(before), F.lit(0))
    chosen = read.withColumn("wanted", F.least(left, F.col("n_rows"))).where("wanted > 0 OR n_rows IS NULL").persist()
    kinds = chosen.groupBy("signature").agg(F.min("path").alias("path")).collect()  # a row per schema version
    frames = []
    for signature, path in kinds:
        if signature is None:
            raise OSError(f"pyarrow does not open the file system of {path}")
        schema = spark.read.parquet(path).schema
        heads = read_heads(spark, chosen.where(F.col("signature") == signature), schema, "_file", "_row")
        month = month_from_file_name(F.col("_file"), prefix)
        frames.append(conform(heads.withColumn(key, month), contract))
    return union_all(frames) if frames else spark.createDataFrame([], contract.schema)


def sample_per_month(
    df: DataFrame, keys: Sequence[str], n: int = DEFAULT_SAMPLE_ROWS, month: str = "date", rank_col: str = "rn"
) -> DataFrame:
    return first_per_month(df, keys, n, month, rank_col)


#: A sample of at most so many rows is written as one file, by one task.
ONE_FILE_ROWS = 100_000


def write_sample(df: DataFrame, out: str, partition_by: str | None = None, rows: int = DEFAULT_SAMPLE_ROWS) -> None:
    """Write a sample of at most ``rows`` rows as Parquet: one file where it
    fits one, or files per month when partitioned."""
    w = df.coalesce(1) if partition_by is None and rows <= ONE_FILE_ROWS else df
    writer = w.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(out)

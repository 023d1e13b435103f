"""Parquet footers of many files, read by the executors.

``footers`` is one job over a listing: each task opens its share of the files
(metadata only, a few KB a file) and gives the schema and the rows of each row
group.  ``schema_groups`` aggregates them to the scans that are needed.  The
driver sees one row per delivery and schema, and single files only where a
delivery mixes schemas, as a scan must then name them.

Files are opened with pyarrow.  A file system that pyarrow does not open gives
a null signature; those files are grouped by Spark's own schema merge, which
reads footers in tasks too (``merge_groups``).
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.session import held_setting

#: Footers that a task reads at once.
READERS = 8

#: What a scan of numbered parts ends with, after the delivery's name.
PARTS = "-[0-9][0-9][0-9][0-9][0-9].parquet"

FOOTER = "signature string, n_rows long, row_groups array<long>"


def open_file_system(path: str):
    """(pyarrow file system, path in it)."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def read_footer(path: str) -> tuple[str | None, int | None, list[int] | None]:
    """(signature, rows, rows of each row group); nulls if pyarrow cannot open it."""
    import pyarrow.parquet as pq

    try:
        fsys, p = open_file_system(path)
        with fsys.open_input_file(p) as f:
            meta = pq.read_metadata(f)
        schema = meta.schema.to_arrow_schema()
    except (OSError, NotImplementedError, pa.ArrowException):
        return None, None, None
    groups = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    return json.dumps([(f.name, str(f.type)) for f in schema]), meta.num_rows, groups


@contextmanager
def at_once(path: str, n: int) -> Iterator[Callable]:
    """``map`` for calls on files like ``path``: in ``n`` threads where they
    wait for a far file system.  A local one answers sooner than threads hand
    over, and other tasks use the cores."""
    if path.startswith("file:") or "://" not in path:
        yield map
    else:
        with ThreadPoolExecutor(n) as pool:
            yield pool.map


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.int64(), pa.list_(pa.int64())]
    for batch in batches:
        paths = batch.column("path").to_pylist()
        with at_once(paths[0] if paths else "", READERS) as run:
            found = list(run(read_footer, paths))
        new = [pa.array([r[i] for r in found], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *new], names=[*batch.schema.names, "signature", "n_rows", "row_groups"]
        )


def footers(files: DataFrame) -> DataFrame:
    """``files`` (``path`` and any other columns) with ``FOOTER``'s columns."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.repartition(n, "path").mapInArrow(_read, f"{fields}, {FOOTER}")


def schema_groups(files: DataFrame) -> list[tuple[list[str], T.StructType]]:
    """The files (``path``, ``scan``) as scans: paths and their one schema.

    ``scan`` is what a scan of the file's whole delivery names (a folder, a
    pattern, the file itself).  It stands for its files where they have one
    schema; else the files are named.
    """
    spark = files.sparkSession
    read = footers(files.select("path", "scan")).persist()
    try:
        per_scan = read.groupBy("scan", "signature").agg(F.min("path").alias("one"))
        kinds = F.count(F.lit(1)).over(Window.partitionBy("scan"))
        per_scan = per_scan.withColumn("kinds", kinds).persist()  # a row per delivery and schema
        mixed = per_scan.where("kinds > 1").select("scan").distinct()
        named = read.join(mixed, "scan", "left_semi").select("signature", "path", F.col("path").alias("one"))
        whole = per_scan.where("kinds = 1").select("signature", F.col("scan").alias("path"), "one")
        with listing_tasks(spark):
            rows = whole.unionByName(named).collect()
        per_scan.unpersist()
    finally:
        read.unpersist()
    groups: dict[str | None, list[str]] = {}
    ones: dict[str | None, str] = {}
    for signature, path, one in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        groups.setdefault(signature, []).append(path)
        ones.setdefault(signature, one)
    unknown = groups.pop(None, [])
    # one footer stands for a group
    alike = [(paths, parquet_reader(spark).parquet(ones[signature]).schema) for signature, paths in groups.items()]
    return [*alike, *merge_groups(spark, unknown)]


def merge_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Paths in order, cut where Spark cannot merge their schemas: months in a
    row mostly share one, so a few merges find the few cuts."""
    if not paths:
        return []
    try:
        reader = parquet_reader(spark).format("parquet").option("mergeSchema", "true")
        return [(paths, load_scans(reader, paths).schema)]
    except (PySparkException, Py4JJavaError) as e:
        if "MERGE_SCHEMAS" not in str(e):
            raise
    if len(paths) > 1:
        half = len(paths) // 2
        return merge_groups(spark, paths[:half]) + merge_groups(spark, paths[half:])
    files = [r[0] for r in parquet_reader(spark).format("binaryFile").load(paths[0]).select("path").sort("path").collect()]
    if files == paths:
        raise ValueError(f"no schema to be read: {paths[0]}")
    return merge_groups(spark, files)  # a delivery of several schemas


def parquet_reader(spark: SparkSession):
    """Reads all Parquet files under a path, as the listing finds them."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")


def listing_tasks(spark: SparkSession):
    """While a listing (``binaryFile`` without content) is collected: its tasks
    take 2,000 small files each.  Spark counts 4 MB for opening a file, which
    makes a task of every 32, but these are not opened."""
    return held_setting(spark, "spark.sql.files.openCostInBytes", "64k")


def load_scans(reader, paths: list[str]) -> DataFrame:
    """``reader.load`` of what scans name: folders, files and patterns.

    A pattern lists its whole folder, so those of a folder's numbered parts
    are made one, and Spark looks at the files found in a few large tasks
    rather than in one task each.
    """
    spark = reader._spark
    few = str(4 * spark.sparkContext.defaultParallelism)
    with held_setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", few):
        return reader.load(join_patterns(paths))


def join_patterns(paths: list[str]) -> list[str]:
    """The patterns of numbered parts in one folder as one pattern.  A name
    that is not plain keeps its own."""
    names, out = defaultdict(list), []
    for path in paths:
        folder, _, name = path.rpartition("/")
        if folder and re.fullmatch(r"[A-Za-z0-9_.\-]+" + re.escape(PARTS), name):
            names[folder].append(name[: -len(PARTS)])
        else:
            out.append(path)
    for folder, found in names.items():
        found = sorted(set(found))
        out.append(f"{folder}/{found[0] if len(found) == 1 else '{' + ','.join(found) + '}'}{PARTS}")
    return out


def _arrow_fields(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def read_heads(spark: SparkSession, heads: DataFrame, schema: T.StructType, file_col: str, row_col: str) -> DataFrame:
    """The first rows of files of one schema.

    ``heads``: ``path``, ``wanted`` (rows, 1 or more) and the files'
    ``row_groups``.  A task opens only as many leading row groups as hold the
    rows wanted.  The result has the files' columns, and the file and row number.
    """
    out = T.StructType([*schema.fields, T.StructField(file_col, T.StringType()), T.StructField(row_col, T.LongType())])
    fields = _arrow_fields(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            for row in batch.to_pylist():
                left, at = row["wanted"], 0
                fsys, p = open_file_system(row["path"])
                with fsys.open_input_file(p) as f:
                    file = pq.ParquetFile(f)
                    groups = leading_groups(row["row_groups"], left)
                    for part in file.iter_batches(row_groups=groups, batch_size=min(left, 10_000)):
                        part = part.slice(0, left)
                        n = part.num_rows
                        columns = [part.column(fl.name).cast(fl.type, safe=False) for fl in list(fields)[:-2]]
                        place = [pa.array([row["path"]] * n, pa.string()), pa.array(range(at, at + n), pa.int64())]
                        yield pa.RecordBatch.from_arrays([*columns, *place], schema=fields)
                        at, left = at + n, left - n
                        if not left:
                            break

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return heads.select("path", "wanted", "row_groups").repartition(n, "path").mapInArrow(read, out)


def leading_groups(row_groups: list[int], wanted: int) -> list[int]:
    """The fewest leading row groups that hold ``wanted`` rows."""
    out, have = [], 0
    for i, n in enumerate(row_groups):
        if have >= wanted:
            break
        out.append(i)
        have += n
    return out

"""Landing folder: list month files, pick the newest file per month, and scan
many months whose file schemas differ in one job.

Month files do not share one schema (a column can be int in one month and
double in another, or be missing).  ``mergeSchema`` rejects such conflicts,
so files are grouped by footer schema (footers are read by the executors, see
``footers.py``), each group is read with one ``spark.read.parquet(*paths)`` and
conformed, and the conformed groups are unioned by name.  The number of groups
is the number of schema versions (a handful), not the number of files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.calendar import LANDING_PREFIX, month_from_file_name
from monthwise.functions.conform import LOST, conform
from monthwise.sources.footers import PARTS, load_scans, parquet_reader, schema_groups

LISTING_COLUMNS = ("path", "modificationTime", "length")
#: Name of rows without a month, as Spark names their folder; no listing shows it.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet", recursive: bool = False) -> DataFrame:
    """File listing of a folder as a frame ``path, modificationTime, length``.

    The ``binaryFile`` source only reads file bodies when ``content`` is
    selected; here it is not, so this is a distributed directory listing.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select(*LISTING_COLUMNS)


def with_month(listing: DataFrame, path_col: str = "path", prefix: str = LANDING_PREFIX) -> DataFrame:
    """Adds ``date``: the month named by the file (null if none)."""
    return listing.withColumn("date", month_from_file_name(F.col(path_col), prefix))


def newest_file_per_month(
    listing: DataFrame,
    month_col: str = "date",
    path_col: str = "path",
    time_col: str = "modificationTime",
) -> DataFrame:
    """Latest arrival wins: one row per month with the newest file.

    Ties on equal times go to the larger path, so the pick is deterministic.
    Partial aggregation keeps one candidate per month per task before the
    shuffle, so a month with many files is no hot spot.  Rows without a month
    are one group of their own, dropped after the aggregate: a filter before
    it would be pushed below the projection and work out the month twice.
    """
    time, path = F.col(time_col), F.col(path_col)
    return (
        listing.groupBy(month_col)
        .agg(F.max_by(path, F.struct(time, path)).alias("_p"), F.max(time).alias("_t"), F.count(F.lit(1)).alias("n_files"))
        .where(F.col(month_col).isNotNull())
        .select(F.col(month_col), F.col("_p").alias(path_col), F.col("_t").alias(time_col), F.col("n_files"))
    )


@dataclass(frozen=True)
class MonthSource:
    """A file or folder of month rows, and its month."""

    path: str
    month: object  # datetime.date, or None to take it from the file name


def scan_path(path, prefix: str = LANDING_PREFIX) -> Column:
    """What a scan of the delivery of ``path`` names: its folder, its file, or
    the pattern of its numbered parts; a file that names no month, itself."""
    p = path if isinstance(path, Column) else F.col(path)
    unit = month_unit(p, prefix)
    parts = F.concat(unit, F.lit(PARTS))
    return F.when((unit == "") | (p == unit), p).when(p.startswith(F.concat(unit, F.lit("/"))), unit).otherwise(parts)


def scan_files(
    spark: SparkSession,
    files: DataFrame,
    contract: Contract = TRIP_CONTRACT,
    prefix: str = LANDING_PREFIX,
    month=None,
    lost: bool = False,
) -> DataFrame:
    """The files of a listing (``path``; optionally ``scan``, see
    ``schema_groups``) as one conformed frame: one scan per schema version,
    found by the executors.  ``date`` is ``month``, or else the month that a
    file's path names, taken from the hidden ``_metadata.file_path`` with
    substring arithmetic and never from the data.  ``lost``: see ``conform``."""
    key = contract.partition_key
    if "scan" not in files.columns:
        files = files.select("path", F.col("path").alias("scan"))
    date = month_from_file_name(F.col("_metadata.file_path"), prefix) if month is None else F.lit(month)
    frames = []
    for paths, schema in schema_groups(files):
        raw = load_scans(parquet_reader(spark).format("parquet").schema(schema), paths)
        frames.append(conform(raw.withColumn(key, date), contract, lost))
    if not frames:
        schema = contract.schema.add(LOST, "long") if lost else contract.schema
        return spark.createDataFrame([], schema)
    return union_all(frames)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """A balanced tree of unions: each union is analysed eagerly, so a chain
    would re-analyse the growing plan once per frame."""
    while len(frames) > 1:
        frames = [frames[k].unionByName(frames[k + 1]) if k + 1 < len(frames) else frames[k]
                  for k in range(0, len(frames), 2)]
    return frames[0]


def scan_months(
    spark: SparkSession,
    sources: list[MonthSource] | list[str],
    contract: Contract = TRIP_CONTRACT,
    prefix: str = LANDING_PREFIX,
    lost: bool = False,
) -> DataFrame:
    """Read many month files of differing schemas as one conformed frame.

    A source is a file, a folder or a pattern (``month_units``'s ``scans``).
    Named units (``MonthSource.month`` None, or a plain path) are one listing
    and one scan per schema version; the month is in each file's path.  Given
    months are a listing and a scan each with the month as a literal, so no
    per-row work at all.  (A per-row lookup of the file in a literal map would
    compare against every key -- Spark searches literal maps linearly.)  They
    are built in parallel threads, so their listings overlap.
    """
    units = [s if isinstance(s, MonthSource) else MonthSource(s, None) for s in sources]
    if not units:
        raise ValueError("no month files to scan")
    named = [u.path for u in units if u.month is None]
    given: dict = {}
    for u in units:
        if u.month is not None:
            given.setdefault(u.month, []).append(u.path)

    def listed(paths: list[str], scan: Column) -> DataFrame:
        listing = load_scans(parquet_reader(spark).format("binaryFile"), paths)
        return listing.select("path").withColumn("scan", scan)

    def month_scan(item) -> DataFrame:
        month, paths = item
        return scan_files(spark, listed(paths, F.col("path")), contract, prefix, month, lost)

    frames = [scan_files(spark, listed(named, scan_path("path", prefix)), contract, prefix, lost=lost)] if named else []
    if given:
        with ThreadPoolExecutor(max_workers=min(16, len(given))) as pool:
            frames += list(pool.map(month_scan, sorted(given.items())))
    return union_all(frames)


def write_month_files(
    spark: SparkSession,
    df: DataFrame,
    landing_dir: str,
    month_col: str = "date",
    prefix: str = LANDING_PREFIX,
    layout: str = "folder",
    max_records: int | None = None,
) -> list[str]:
    """Write ``df`` as landing data named by month; ``month_col`` is not
    written (month files carry their month in the name).

    ``layout="folder"``: one folder ``<prefix>YYYY_MM/`` of part files per
    month.  A ``REBALANCE`` by month lets AQE split a hot month over several
    tasks and files, so no month is written by a single task.
    ``layout="file"``: one file ``<prefix>YYYY_MM.parquet`` per month (the
    classic landing form); each month is written by one task, so use it for
    months that fit one file.  ``max_records`` caps the rows of a file, which
    makes a month several parts (``<prefix>YYYY_MM-00000.parquet``, ...).

    Spark writes ``_name=<month name>/`` folders into a hidden staging folder;
    they, or their files, are then renamed into place (metadata only; files,
    as they may be many, by tasks).  Small parts are written there by tasks of
    ``parts.py``, as a file costs Spark's writer more than its rows.
    """
    import uuid

    from monthwise.functions.calendar import landing_file_name
    from monthwise.sources import fs
    from monthwise.sources.parts import write_small_parts, writes_small_parts

    if layout not in ("folder", "file"):
        raise ValueError("layout must be 'folder' or 'file'")
    root = landing_dir.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex[:8]}"
    named = df.withColumn("_name", landing_file_name(F.col(month_col), prefix, suffix="")).drop(month_col)
    if layout == "file":
        rows = T.StructType([f for f in named.schema.fields if f.name != "_name"])
        if max_records is not None and writes_small_parts(spark, rows, staging, max_records):
            named = named.withColumn("_name", F.coalesce("_name", F.lit(NO_MONTH)))
            months = write_small_parts(named, "_name", staging, max_records)
        else:
            _write_by_month(named.repartition("_name"), staging, max_records)
            months = _staged_files(spark, staging)
        moves = []
        for month_name, parts in months:
            for i, part in enumerate(parts):
                suffix = "" if len(parts) == 1 else f"-{i:05d}"
                moves.append((part, f"{root}/{month_name}{suffix}.parquet"))
        fs.replace_all(spark, moves)
        written = [dst for _, dst in moves]
    else:
        _write_by_month(named.hint("rebalance", "_name"), staging, max_records)
        written = []
        for d in sorted(fs.list_dir(spark, staging)):
            if d.startswith("_name="):
                written.append(f"{root}/{d[len('_name='):]}")
                fs.replace(spark, f"{staging}/{d}", written[-1])
    fs.delete(spark, staging)
    return written


def _write_by_month(named: DataFrame, staging: str, max_records: int | None) -> None:
    writer = named.write.mode("errorifexists").partitionBy("_name")
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", str(max_records))
    writer.parquet(staging)


def _staged_files(spark: SparkSession, staging: str) -> list[tuple[str, list[str]]]:
    """Month names and their files, as ``_write_by_month`` wrote them."""
    months: dict[str, list[str]] = {}
    for (part,) in list_files(spark, staging, recursive=True).select("path").collect():  # names only
        folder, _, name = part.rpartition("/")
        month_name = folder.rpartition("/_name=")[2]
        months.setdefault(month_name, []).append(f"{staging}/_name={month_name}/{name}")
    return [(month_name, sorted(files)) for month_name, files in sorted(months.items())]


def month_unit(path, prefix: str = LANDING_PREFIX) -> Column:
    """The delivery that ``path`` belongs to: up to the last part of the path
    that names a month.  For ``.../<prefix>2020_01/part-0.parquet`` that is
    the folder, for ``.../<prefix>2020_01.parquet`` the file, and for parts
    ``.../<prefix>2020_01-00000.parquet`` their common name.  Empty if none."""
    p = path if isinstance(path, Column) else F.col(path)
    named = F.regexp_extract(p, "^(.*" + prefix.replace(".", "\\.") + "[0-9]{4}[_-](?:0[1-9]|1[0-2])[^/]*)", 1)
    return F.regexp_replace(named, r"-[0-9]{5}\.parquet$", "")


def unnamed_files(listing: DataFrame, path_col: str = "path", prefix: str = LANDING_PREFIX) -> DataFrame:
    """The files of a listing whose name gives no valid month."""
    return listing.where(month_unit(F.col(path_col), prefix) == "")


def month_units(listing: DataFrame, path_col: str = "path", prefix: str = LANDING_PREFIX) -> DataFrame:
    """Newest delivery per month from a file listing: ``date, unit,
    modificationTime, n_files, scans``.

    A delivery is all its parts, and as new as its newest file; a month
    delivered again under another name replaces the old one, files added to a
    delivery belong to it.  ``scans`` is what a scan names to read it whole: a
    folder, a file or a pattern of numbered parts, so a row stays short
    however many files a month has.  Files that name no month are in
    ``unnamed_files``.
    """
    unit = month_unit(F.col(path_col), prefix)
    deliveries = (
        listing.withColumn("unit", unit)
        .withColumn("_scan", scan_path(F.col(path_col), prefix))
        .groupBy("unit")
        .agg(
            F.max("modificationTime").alias("modificationTime"),
            F.count(F.lit(1)).alias("n_files"),
            F.sort_array(F.collect_set(F.when(F.col("unit") != "", F.col("_scan")))).alias("scans"),
        )
        .where(F.col("unit") != "")
        .withColumn("date", month_from_file_name(F.col("unit"), prefix))
    )
    newest = F.max_by(F.struct("unit", "modificationTime", "n_files", "scans"), F.struct("modificationTime", "unit"))
    return deliveries.groupBy("date").agg(newest.alias("_d")).select("date", "_d.*")

"""Month files of many small parts, written by tasks with pyarrow.

A part of a few hundred rows costs what its file costs, hardly its rows.  On a
local disk Spark's writer takes some 25 ms of a core for each (Hadoop without
its native library starts a process to set the mode of every file and of the
checksums beside it), pyarrow under 1 ms.  Larger parts, other types, codecs
and file systems, and settings that change what the file holds stay with
Spark's writer (``writes_small_parts``).  Pages carry checksums, as Spark's
do; Hadoop's checksum file beside a local file is not written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from monthwise.sources import fs
from monthwise.sources.footers import at_once, open_file_system

#: Rows of a part up to which it is small.
SMALL_PART = 10_000
#: Parts that a task writes at once.
WRITERS = 8

#: Spark's codecs by their pyarrow names.
CODECS = {"none": "none", "uncompressed": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd"}
#: Settings under which Spark's writer gives the same values and types.
SETTINGS = {
    "spark.sql.parquet.writeLegacyFormat": "false",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}
PLAIN = (
    T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
    T.StringType(), T.BinaryType(), T.DateType(), T.TimestampNTZType(),
)


def writes_small_parts(spark: SparkSession, schema: T.StructType, folder: str, max_records: int) -> bool:
    """Whether ``write_small_parts`` writes such parts into ``folder``."""
    conf = spark.conf
    names = {f.name.lower() for f in schema.fields}
    if not 0 < max_records <= SMALL_PART or not names or len(names) < len(schema.fields):
        return False
    if conf.get("spark.sql.parquet.compression.codec").lower() not in CODECS:
        return False
    if any(conf.get(k).lower() != v.lower() for k, v in SETTINGS.items()):
        return False
    micros = conf.get("spark.sql.parquet.outputTimestampType").upper() == "TIMESTAMP_MICROS"
    plain = (*PLAIN, T.TimestampType()) if micros else PLAIN
    if not all(f.dataType in plain or isinstance(f.dataType, T.DecimalType) for f in schema.fields):
        return False
    try:
        open_file_system(fs.qualified(spark, folder))
    except (OSError, NotImplementedError, pa.ArrowException):
        return False
    return True


def write_small_parts(df: DataFrame, name_col: str, folder: str, max_records: int) -> list[tuple[str, list[str]]]:
    """Writes ``df`` as parts of ``max_records`` rows, the last one of a name
    fewer: (name, the paths of its parts in order), sorted by name.

    All rows of a name come to one task, sorted.  A try of a task writes to a
    folder of its own and only those of tries that ended are given back, so a
    task tried again or twice at once leaves nothing but strays in ``folder``.
    """
    spark = df.sparkSession
    codec = CODECS[spark.conf.get("spark.sql.parquet.compression.codec").lower()]
    # the key by which Spark knows the calendar of old dates
    made_by = {"org.apache.spark.version": spark.version}
    whole = fs.qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        tried = uuid.uuid4().hex
        fsys, root = open_file_system(f"{whole}/{tried}")
        fsys.create_dir(root)

        def put(part: tuple[str, int, pa.Table]) -> None:
            name, i, rows = part
            rows = rows.drop_columns([name_col]).replace_schema_metadata(made_by)
            pq.write_table(
                rows, f"{root}/{part_name(name, i)}", filesystem=fsys, compression=codec,
                store_schema=False, write_page_checksum=True, store_decimal_as_integer=True,
            )

        counts: dict[str, int] = {}
        parts = numbered(cut(batches, name_col, max_records), counts)
        with at_once(whole, WRITERS) as run:
            while some := list(islice(parts, 8 * WRITERS)):
                list(run(put, some))
        columns = [list(counts), [tried] * len(counts), list(counts.values())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)],
            names=["name", "tried", "n"],
        )

    one_task = df.repartition(name_col).sortWithinPartitions(name_col)
    out: dict[str, list[str]] = {}
    for name, tried, n in sorted(one_task.mapInArrow(write, "name string, tried string, n long").collect()):
        out.setdefault(name, []).extend(f"{folder}/{tried}/{part_name(name, i)}" for i in range(n))
    return list(out.items())


def part_name(name: str, i: int) -> str:
    return f"{name}-{i:05d}.parquet"


def cut(batches: Iterator[pa.RecordBatch], name_col: str, size: int) -> Iterator[tuple[str, pa.Table]]:
    """Batches sorted by name as (name, its next ``size`` rows, at its end the
    rest): rows short of a part wait for the next batch."""
    import pyarrow.compute as pc

    left = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if left is None else pa.concat_tables([left, table])
        names = table.column(name_col).combine_chunks()
        start = 0
        for end in pc.run_end_encode(names).run_ends.to_pylist():
            while end - start >= size or start < end < table.num_rows:
                n = min(size, end - start)
                yield names[start].as_py(), table.slice(start, n)
                start += n
        left = table.slice(start)
    if left is not None and left.num_rows:
        yield left.column(name_col)[0].as_py(), left


def numbered(parts: Iterator[tuple[str, pa.Table]], counts: dict[str, int]) -> Iterator[tuple[str, int, pa.Table]]:
    """Parts with their number within the name; ``counts`` has how many were given."""
    for name, rows in parts:
        i = counts.get(name, 0)
        counts[name] = i + 1
        yield name, i, rows

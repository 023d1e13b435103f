"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.session import scratch_path

T = TypeVar("T")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage is
    cut, the rows are fixed and a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ..., so that none clashes with a
    name used inside an operator, and the new name of each."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def named_back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``neutral`` under their own names, others dropped."""
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus`` (null id: null, so no fold)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def crc_fold(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def char_batches(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` holding about ``limit`` characters each, so
    that what a task builds for one range is bounded by the range (a longer
    single text makes a range of its own)."""
    yield from _ranges([len(t) if t else 0 for t in texts], limit)


def text_batches(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str | None]]]:
    """The ranges of ``char_batches`` with their texts, of which only one
    range at a time is made into Python strings."""
    for lo, hi in _ranges(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), limit):
        yield lo, hi, texts.slice(lo, hi - lo).to_pylist()


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; what Arrow's memory pool holds of those before goes back
    to the system, which it else keeps for the life of the Python worker."""
    pool = pa.default_memory_pool()
    pool.release_unused()
    for batch in batches:
        yield batch
        pool.release_unused()


def _ranges(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


#: What the operator at work keeps in this Python worker from task to task.
_KEPT: dict[object, object] = {}


def kept_in_worker(key: object, make: Callable[[], T]) -> T:
    """``make()``, kept in the Python worker until another key is asked for.
    Spark reuses workers in later stages: what an earlier operator left there
    would stand beside the memory of the next one."""
    if key not in _KEPT:
        forget_kept()
        _KEPT[key] = make()
    return _KEPT[key]


def forget_kept() -> None:
    """For operators that keep nothing from task to task."""
    _KEPT.clear()


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )

"""The reference's user-callable helpers under their own names, for code
that calls them; each is a thin wrapper over the Spark-native function.

``select_or_null`` -> ``conform.column_or_null``; ``set_schema`` ->
``conform.conform`` with the trip contract; ``get_create_schema`` -> the
Spark SQL that creates a database if it is missing; ``minimize_parquet`` ->
``sample.file_head`` written as one Parquet file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.conform import column_or_null, conform
from monthwise.operators.sample import DEFAULT_SAMPLE_ROWS, file_head, write_sample


def select_or_null(df: DataFrame, col_name: str) -> Column:
    """The column ``col_name`` of ``df`` (exact case), or null if absent."""
    return column_or_null(df, col_name).alias(col_name)


def set_schema(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """Conform ``df`` (which must carry ``date``) to the trip contract."""
    return conform(df, contract)


def get_create_schema(schema: str) -> str:
    """SQL that creates the database ``schema`` when it does not exist."""
    return f"CREATE DATABASE IF NOT EXISTS `{schema.replace('`', '``')}`"


def minimize_parquet(spark: SparkSession, input: str, output: str, limit: int = DEFAULT_SAMPLE_ROWS) -> None:
    """Write the first ``limit`` rows of ``input`` (file order) to ``output``."""
    write_sample(file_head(spark, input, limit), output, rows=limit)

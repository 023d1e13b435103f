"""Column contracts: the fixed, typed shape every month is conformed to.

A contract is plain data (a tuple of ``ColumnSpec``).  Everything else --
the conform projection, the table DDL, the schema gate -- is generated from
it, so one list is the single source of truth.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    """One output column.

    ``source``   column name looked up on the raw frame (exact case).
    ``target``   output column name.
    ``dtype``    Spark type the value is cast to (``try_cast``: bad -> null).
    ``required`` the column must exist on the raw frame; it is passed through
                 without a cast and an absent column is an analysis error.
    """

    source: str
    target: str
    dtype: T.DataType
    required: bool = False


@dataclass(frozen=True)
class Contract:
    columns: tuple[ColumnSpec, ...]
    partition_key: str = "date"

    @property
    def names(self) -> list[str]:
        return [c.target for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.target, c.dtype, True) for c in self.columns])

    def with_timestamp_ntz(self) -> "Contract":
        """Same contract with every TIMESTAMP column as TIMESTAMP_NTZ.

        Fits a target declared ``timestamp without time zone`` best and does
        not depend on the session time zone.
        """
        cols = tuple(
            replace(c, dtype=T.TimestampNTZType()) if isinstance(c.dtype, T.TimestampType) else c
            for c in self.columns
        )
        return replace(self, columns=cols)

    def ddl_columns(self, not_null_key: bool = True) -> str:
        parts = []
        for c in self.columns:
            nn = " NOT NULL" if (not_null_key and c.target == self.partition_key) else ""
            parts.append(f"`{c.target}` {c.dtype.simpleString()}{nn}")
        return ", ".join(parts)


# The monthly trip contract (source name, target name, type),
# in the order of the published table.
TRIP_CONTRACT = Contract(
    columns=(
        ColumnSpec("VendorID", "vendor_id", T.LongType()),
        ColumnSpec("tpep_pickup_datetime", "tpep_pickup_datetime", T.TimestampType()),
        ColumnSpec("tpep_dropoff_datetime", "tpep_dropoff_datetime", T.TimestampType()),
        ColumnSpec("passenger_count", "passenger_count", T.DoubleType()),
        ColumnSpec("trip_distance", "trip_distance", T.DoubleType()),
        ColumnSpec("RatecodeID", "ratecode_id", T.DoubleType()),
        ColumnSpec("store_and_fwd_flag", "store_and_fwd_flag", T.StringType()),
        ColumnSpec("PULocationID", "pu_location_id", T.LongType()),
        ColumnSpec("DOLocationID", "do_location_id", T.LongType()),
        ColumnSpec("payment_type", "payment_type", T.LongType()),
        ColumnSpec("fare_amount", "fare_amount", T.DoubleType()),
        ColumnSpec("extra", "extra", T.DoubleType()),
        ColumnSpec("mta_tax", "mta_tax", T.DoubleType()),
        ColumnSpec("tip_amount", "tip_amount", T.DoubleType()),
        ColumnSpec("tolls_amount", "tolls_amount", T.DoubleType()),
        ColumnSpec("improvement_surcharge", "improvement_surcharge", T.DoubleType()),
        ColumnSpec("total_amount", "total_amount", T.DoubleType()),
        ColumnSpec("congestion_surcharge", "congestion_surcharge", T.DoubleType()),
        ColumnSpec("airport_fee", "airport_fee", T.IntegerType()),
        ColumnSpec("date", "date", T.DateType(), required=True),
    ),
    partition_key="date",
)

# The count ledger: one row per loaded month.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("cnt", T.LongType(), True),
        T.StructField("date", T.DateType(), False),
    ]
)


def schema_signature(schema: T.StructType) -> list[tuple[str, str]]:
    """Name + type of every field; nullability is ignored on purpose
    (a folded literal is non-nullable under ANSI, nullable without)."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def schema_diff(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Readable differences (name/type/order) between two schemas."""
    out = []
    got, want = schema_signature(actual), schema_signature(expected)
    got_d, want_d = dict(got), dict(want)
    for name, typ in want:
        if name not in got_d:
            out.append(f"missing column {name} {typ}")
        elif got_d[name] != typ:
            out.append(f"column {name}: {got_d[name]} != {typ}")
    for name, _ in got:
        if name not in want_d:
            out.append(f"unexpected column {name}")
    if not out and [n for n, _ in got] != [n for n, _ in want]:
        out.append("column order differs")
    return out

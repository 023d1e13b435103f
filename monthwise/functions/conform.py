"""Conform a raw month frame to a contract: one projection, no shuffle.

Every output column is ``try_cast(source)`` or a typed null when the source
column is absent.  The whole thing is a single ``Project`` over the scan, so
it stays inside whole-stage codegen and Catalyst prunes every column that a
later step does not need (a ``count`` after ``conform`` reads no columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.contract import TRIP_CONTRACT, ColumnSpec, Contract


#: Column of ``conform(lost=True)``: bit i is set where the cast of the
#: contract's column i made a value null.
LOST = "_lost"


class AmbiguousColumnError(ValueError):
    """Two raw columns differ only in case and the session ignores case."""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _case_insensitive(df: DataFrame) -> bool:
    conf = df.sparkSession.conf.get("spark.sql.caseSensitive", "false")
    return str(conf).lower() != "true"


def column_or_null(df: DataFrame, name: str, dtype: T.DataType | None = None) -> Column:
    """The column ``name`` of ``df`` (exact case), or a typed null if absent.

    A column whose name differs only in case counts as absent.  When the
    exact name and a case variant are both present and the session resolves
    names without case, the lookup would be ambiguous: raise a clear error
    instead of picking one.
    """
    cols = df.columns
    if name in cols:
        if _case_insensitive(df):
            twins = [c for c in cols if c.lower() == name.lower()]
            if len(twins) > 1:
                raise AmbiguousColumnError(
                    f"columns {twins} differ only in case; set spark.sql.caseSensitive=true "
                    f"or drop one of them before conforming"
                )
        c = df[_quoted(name)]
        return c.try_cast(dtype) if dtype is not None else c
    null = F.lit(None)
    return null.cast(dtype) if dtype is not None else null


def _spec_column(df: DataFrame, spec: ColumnSpec) -> Column:
    if spec.required:
        # pass-through; an absent column must fail analysis, not become null
        return F.col(_quoted(spec.source)).alias(spec.target)
    return column_or_null(df, spec.source, spec.dtype).alias(spec.target)


def lost_mask(df: DataFrame, contract: Contract) -> Column:
    """The bits of the columns whose value is there and fails its cast."""
    mask = F.lit(0).cast("long")
    for i, spec in enumerate(contract.columns):
        if not spec.required and spec.source in df.columns:
            gone = df[_quoted(spec.source)].isNotNull() & column_or_null(df, spec.source, spec.dtype).isNull()
            mask = mask.bitwiseOR(F.when(gone, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return mask.alias(LOST)


def conform(df: DataFrame, contract: Contract = TRIP_CONTRACT, lost: bool = False) -> DataFrame:
    """Select, null-fill, cast, rename and order ``df`` to ``contract``.

    Unlisted columns are dropped.  Casts are ``try_cast`` so a bad value
    becomes null whatever ``spark.sql.ansi.enabled`` says; double -> int cuts
    the fraction and out-of-range values become null.  ``lost`` adds the
    column ``LOST``, which tells such nulls from those that were null before;
    the load counts it and does not write it.
    """
    more = [lost_mask(df, contract)] if lost else []
    return df.select(*[_spec_column(df, s) for s in contract.columns], *more)

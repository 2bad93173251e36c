"""Loading what is new: key cursors, back-fills and the idempotent load.

A cursor is a scalar subquery, so one plan serves the first run (nothing staged, sentinel cursor) and every
later one, and Spark pushes the value it finds into the source scan.  The cursor only prunes: a row that
arrives late with a smaller key would be missed by it, so give a look-back and let the anti-join decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.operators.lookups import new_rows, semi_on

_LOWEST = {T.LongType: -(2**63), T.IntegerType: -(2**31), T.StringType: ""}
_HIGHEST = {T.LongType: 2**63 - 1, T.IntegerType: 2**31 - 1}
_FIRST_DAY, _LAST_DAY = "0001-01-01 00:00:00", "9999-12-31 23:59:59"


def after_cursor(df: DataFrame, key: str, staged: DataFrame, staged_key: str | None = None, inclusive: bool = False,
                 look_back=None) -> DataFrame:
    """Rows whose key is above (or, with `inclusive`, at least) the largest staged key.

    `look_back` lowers the cursor: a number for keys, an interval column for times.  Only the key column of `staged`
    is read for the edge; a one-row table that keeps the last load's edge does as well.
    """
    cursor = _edge(staged, staged_key or key, F.max, _sentinel(df, key, _LOWEST, _FIRST_DAY), look_back)
    return df.where(F.col(key) >= cursor if inclusive else F.col(key) > cursor)


def before_cursor(df: DataFrame, key: str, staged: DataFrame, staged_key: str | None = None) -> DataFrame:
    """Rows whose key is below the smallest staged key: back-filling from the newest row down."""
    cursor = _edge(staged, staged_key or key, F.min, _sentinel(df, key, _HIGHEST, _LAST_DAY), None)
    return df.where(F.col(key) < cursor)


def idempotent_load(
    source: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    gate: tuple[DataFrame, dict[str, str]] | None = None,
    cursor_key: str | None = None,
    look_back=None,
    nullable: Sequence[str] = (),
) -> DataFrame:
    """The rows to append: gated on staged parents, above the cursor, one per key, not staged yet.

    Appending the result and running again yields nothing.
    """
    rows = source
    if gate is not None:
        rows = semi_on(rows, *gate)
    if cursor_key is not None:
        rows = after_cursor(rows, cursor_key, staged, inclusive=True, look_back=look_back)
        if cursor_key in keys:
            # Staged rows below the cursor cannot have the key of a row above it.
            staged = after_cursor(staged, cursor_key, staged, inclusive=True, look_back=look_back)
    return new_rows(rows, staged, keys, order, nullable)


def within_range(staged: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The staged rows a small batch could collide with, by the range of one of its natural key columns.

    Both bounds are pushed into the scan, which skips the files and row groups outside; a staging table that
    grows by ascending keys is then read only at its end.
    """
    low = batch.agg(F.min(key)).scalar()
    high = batch.agg(F.max(key)).scalar()
    return staged.where((F.col(key) >= low) & (F.col(key) <= high))


def _edge(staged: DataFrame, key: str, edge, sentinel: Column, look_back) -> Column:
    found = edge(F.col(key)) if look_back is None else edge(F.col(key)) - look_back
    return staged.agg(F.coalesce(found, sentinel).alias("edge")).scalar()


def _sentinel(df: DataFrame, key: str, numbers: dict, day: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.lit(day).cast(kind)
    if type(kind) not in numbers:
        raise TypeError(f"{key}: no cursor over {kind.simpleString()}")
    return F.lit(numbers[type(kind)]).cast(kind)

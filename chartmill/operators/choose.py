"""One row per key, and other group-wise reductions.

All of them reduce inside the map tasks before anything is shuffled, so a key that holds a third of the rows
reaches the reducer as one small row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by `order`, then by the remaining columns (nulls first).

    Where the original took an arbitrary row, ordering by every column makes the choice repeatable.
    """
    lead = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if not lead + rest:
        return df.distinct()
    if len(lead + rest) == 1:
        # One plain column needs no struct, so Spark can aggregate by hash instead of sorting.
        only = F.col((lead + rest)[0])
        least = F.when(F.max(only.isNull()), F.lit(None)).otherwise(F.min(only))
        return df.groupBy(*keys).agg(least.alias((lead + rest)[0])).select(*df.columns)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*lead, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest(df: DataFrame, key: str) -> DataFrame:
    """The single row with the largest key; of several, the one with the largest `id`, if there is one, and so on."""
    rest = sorted((c for c in df.columns if c != key), key=lambda c: c != "id")
    return (
        df.agg(F.max(F.struct(key, *rest)).alias("_row"))
        .where(F.col("_row").isNotNull())
        .select(*[F.col("_row")[c].alias(c) for c in df.columns])
    )


def pivot_measures(
    df: DataFrame, keys: Sequence[str], code: str, value: str, measures: Mapping[int, str], extra: Sequence[Column] = ()
) -> DataFrame:
    """Turn (key, code, value) rows into one wide row per key, with the largest value of each code."""
    wide = [F.max(F.when(F.col(code) == c, F.col(value))).alias(name) for c, name in measures.items()]
    return df.groupBy(*keys).agg(*extra, *wide)


def join_distinct(df: DataFrame, keys: Sequence[str], value: str, alias: str, separator: str = ",") -> DataFrame:
    """The distinct values of each key as one ordered text; the set is bounded by the vocabulary, not the rows."""
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(value)), separator).alias(alias))


def join_names(df: DataFrame, keys: Sequence[str], code: str, name: str, alias: str, extra: Sequence[Column] = ()):
    """The names of a key's distinct codes as one text, ordered by name; equal names of two codes both stay."""
    entries = F.sort_array(F.collect_set(F.struct(F.col(name).alias("n"), F.col(code).alias("c"))))
    text = F.array_join(F.transform(entries, lambda e: e["n"]), ",")
    return df.groupBy(*keys).agg(*extra, text.alias(alias))


def first_by_name(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """First row of every name that is present, sorted by name regardless of case."""
    chosen = pick_one(df.where(F.col(name).isNotNull()), [name], order)
    return chosen.orderBy(F.lower(name), name)


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows in an order; Spark keeps n rows per task, no full sort."""
    return df.orderBy(*order).limit(n)

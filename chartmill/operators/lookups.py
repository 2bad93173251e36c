"""Joins of facts to dimensions, to staged entities and to each other's staged state.

A side is broadcast only when a size check finds it small: `dimension` counts a bounded number of its rows, and
everywhere else Spark's own check decides (file statistics before the run, shuffle statistics during it).  A
larger side is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.operators.choose import pick_one


SMALL_ROWS = 10_000


def dimension(df: DataFrame, max_rows: int = SMALL_ROWS, bound: DataFrame | None = None) -> DataFrame:
    """Mark a table for broadcast if it has at most `max_rows` rows; leave it alone otherwise.

    Tables read over JDBC and grouped tables carry no usable size estimate, and without one Spark would shuffle
    the facts by, say, an encounter type of fifty values.  The check counts at most `max_rows` + 1 rows,
    of `df` or of `bound`: a plain table that `df` cannot have more rows than, so that no grouping runs for the check.
    """
    counted = (df if bound is None else bound).select(F.lit(1)).limit(max_rows + 1).count()
    return F.broadcast(df) if counted <= max_rows else df


def star_join(fact: DataFrame, *dims: tuple[DataFrame, Mapping[str, str]], how: str = "inner") -> DataFrame:
    """Join a fact to dimensions; each comes with {fact column: dimension column}.

    The dimension's key columns are dropped afterwards, its other columns stay.
    """
    out = fact
    for number, (dim, on) in enumerate(dims):
        renamed = dim.withColumnsRenamed({right: f"_d{number}_{right}" for right in on.values()})
        condition = _all(out[left] == renamed[f"_d{number}_{right}"] for left, right in on.items())
        out = out.join(renamed, condition, how).drop(*[f"_d{number}_{right}" for right in on.values()])
    return out


def semi_on(df: DataFrame, other: DataFrame, on: Mapping[str, str], repeated: bool = False) -> DataFrame:
    """Rows of `df` that have a partner in `other`; say so if `other` repeats its keys, and they are reduced first."""
    keys = _keys(other, on)
    return df.join(distinct_keys(keys) if repeated else keys, _match(df, on), "left_semi")


def distinct_keys(df: DataFrame) -> DataFrame:
    """Distinct rows, as the side of a join whose other side may have a hot key (see `one_per_key`)."""
    return df.withColumn("_hash", F.hash(*df.columns)).distinct().drop("_hash")


def anti_staged(df: DataFrame, staged: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """Rows whose natural key is not staged yet.

    Keys named in `nullable` also match null to null; without that, a null key would be loaded on every run.
    """
    on = {k: k for k in keys}
    return df.join(_keys(staged, on), _match(df, on, nullable), "left_anti")


def new_rows(df: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
             nullable: Sequence[str] = ()) -> DataFrame:
    """One row per natural key that is not staged: duplicates inside the batch go first, then staged keys.

    Both steps hash on the same keys, so the batch is shuffled once.
    """
    return anti_staged(pick_one(df, keys, order), staged, keys, nullable)


def lookup_first(df: DataFrame, entity: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
                 order: Sequence[str] = (), how: str = "left", unique: bool = False) -> DataFrame:
    """Join to the first entity row of each key; `take` names {entity column: new column}.

    Rows without a match stay, with nulls; `how="inner"` drops them.  Say `unique` only of an entity whose natural
    key is the lookup key; it saves reducing it.
    """
    keys = [F.col(right).alias(f"_k{i}") for i, right in enumerate(on.values())]
    payload = list(dict.fromkeys([*order, *take]))
    if unique:
        slim = entity.select(*keys, *[F.col(c).alias(alias) for c, alias in take.items()])
    else:
        slim = one_per_key(entity, keys, F.min(F.struct(*payload)).alias("_row")).select(
            *[f"_k{i}" for i in range(len(on))], *[F.col("_row")[c].alias(alias) for c, alias in take.items()])
    condition = _all(df[left] == slim[f"_k{i}"] for i, left in enumerate(on))
    return df.join(slim, condition, how).drop(*[f"_k{i}" for i in range(len(on))])


def one_per_key(df: DataFrame, keys: Sequence[Column | str], *aggregates: Column) -> DataFrame:
    """Reduce to one row per key, as the side of a join whose other side may have a hot key.

    Spark splits a hot key's partition at run time only where both sides of the join come straight from a
    shuffle.  Grouping by the key and its hash keeps the result the same but not its partitioning, so these few
    rows are shuffled once more before the join and the other side's hot partition can be split.
    """
    grouped = df.groupBy(*keys, F.hash(*keys).alias("_hash")).agg(*aggregates)
    return grouped.drop("_hash")


def _keys(other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return other.select(*[F.col(right).alias(f"_r_{left}") for left, right in on.items()])


def _match(df: DataFrame, on: Mapping[str, str], nullable: Sequence[str] = ()) -> Column:
    return _all(
        df[left].eqNullSafe(F.col(f"_r_{left}")) if left in nullable else df[left] == F.col(f"_r_{left}") for left in on
    )


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out

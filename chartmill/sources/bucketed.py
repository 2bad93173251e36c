"""Staged entities bucketed by natural key, and joins that do not move them.

Rows are written sorted in a fixed number of buckets by the hash of the key.  A fact joined on that key is shuffled into
the same buckets; the staged side is read where it lies.  A fact's hot key would then be one task, and Spark does not split it,
as the staged side comes from no shuffle: facts with such keys are joined to a broadcast of the few staged rows they ask
for instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.operators.choose import pick_one

#: A key is hot if it has over 1 / HOT_SHARE of the facts; so there are fewer hot keys than this.
HOT_SHARE = 1000


@dataclass(frozen=True)
class BucketedStage:
    """A staged entity below `path`, known to the session as table `name`; one row for each natural key."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int
    name: str

    @classmethod
    def of(cls, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> BucketedStage:
        """Opens or begins the staged entity; always with the number of buckets that it was begun with."""
        name = f"staged_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return cls(spark, path, tuple(keys), buckets, name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def new_rows(self, df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
        """One row for each key that is not staged.  Written out of one shuffle of the batch; its duplicates, and so its
        hot keys, go before it."""
        single = pick_one(df, self.keys, order)
        staged = self.rows().select(*[F.col(k).alias(f"_r_{k}") for k in self.keys]).hint("merge")
        return single.join(staged, self._match(single), "left_anti")

    def append(self, df: DataFrame, order: Sequence[str] = ()) -> None:
        """Stages what is new; a second run adds nothing."""
        self.new_rows(df, order).select(*self.rows().columns).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def lookup(self, facts: DataFrame, on: Mapping[str, str], take: Mapping[str, str], how: str = "left") -> DataFrame:
        """Facts with columns of the staged row of their key; `on` is {fact column: key}, all keys, `take` {staged column: new column}."""
        if sorted(on.values()) != sorted(self.keys):
            raise ValueError(f"a lookup that does not move {self.path} needs the keys {self.keys}")
        rows = self.rows().select(*[F.col(k).alias(f"_r_{k}") for k in self.keys], *[F.col(c).alias(alias) for c, alias in take.items()])
        named = [f"_r_{key}" for key in on.values()]  # the staged side's keys

        def match(df: DataFrame):
            out = F.lit(True)
            for left, right in on.items():
                out = out & (df[left] == F.col(f"_r_{right}"))
            return out

        # A fact without a key finds nothing; left in the join, all of these would be one task.
        keyless = F.lit(False)
        for left in on:
            keyless = keyless | F.col(left).isNull()
        unknown = facts.where(keyless).select("*", *[F.lit(None).cast(self.rows().schema[c].dataType).alias(alias) for c, alias in take.items()])
        facts = facts.where(~keyless)
        total = facts.count()
        counted = facts.groupBy(*on).agg(F.count("*").alias("_n")).where((F.col("_n") * HOT_SHARE > total) & (F.col("_n") > 1))
        hot = F.broadcast(counted.select(*[F.col(left).alias(f"_r_{right}") for left, right in on.items()]))
        asked = F.broadcast(rows.join(hot, list(named), "left_semi"))
        common = facts.join(hot, match(facts), "left_semi").join(asked, match(facts), how)
        rest = facts.join(hot, match(facts), "left_anti").join(rows.hint("merge"), match(facts), how)
        found = common.drop(*named).unionByName(rest.drop(*named))
        return found.unionByName(unknown) if how == "left" else found

    def semi(self, facts: DataFrame, on: Mapping[str, str]) -> DataFrame:
        """Facts whose key is staged."""
        return self.lookup(facts, on, {}, "inner")

    def _match(self, df: DataFrame):
        out = F.lit(True)
        for k in self.keys:
            out = out & (df[k] == F.col(f"_r_{k}"))
        return out

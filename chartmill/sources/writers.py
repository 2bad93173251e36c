"""Writing staged rows, mapping snapshots and outbox documents.

With a committer that renames at the end (the default on HDFS and POSIX folders; on object stores one made for them, or
a table format), a write is committed as a whole: a lost executor or a failed job leaves no half-written rows, and the
anti-join of the next run skips what an earlier run did commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from chartmill.functions.columns import natural_uuid
from chartmill.operators.choose import pick_one
from chartmill.operators.lookups import new_rows
from chartmill.schemas import GIVEN_UUID, STAGED_KEYS

#: The column that names a range, and how many files a range is written in.
RANGE, FILES = "key_range", 4


def with_row_id(df: DataFrame, keys: Sequence[str], alias: str = "row_id") -> DataFrame:
    """A surrogate key out of the natural key; no global counter, and the same on every retry."""
    return df.withColumn(alias, natural_uuid(*keys))


def with_stored_columns(df: DataFrame, entity: str, load_number: int) -> DataFrame:
    """Rows of a staged entity with what every stored row has: an id out of the natural key, and the number of the
    load, which orders rows by when they were staged.  Programs and enrolments get a uuid of their own as well."""
    keys = STAGED_KEYS[entity]
    if entity in GIVEN_UUID and "uuid" not in df.columns:
        df = df.withColumn("uuid", natural_uuid(F.lit(entity), *keys))
    return df.withColumns({"id": natural_uuid(*keys), "load_number": F.lit(load_number).cast("long")})


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the source's rows put in: matching keys replaced, new keys added.

    Write the result to a new folder and read from there on; never over the input.  Of a key that `source` repeats,
    the smallest row by all columns is put in.
    """
    source = pick_one(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def key_range(key: str, width: int) -> Column:
    """The range of `width` keys that a number falls in."""
    return F.floor(F.col(key) / width).cast("long")


def write_ranges(df: DataFrame, path: str, key: str, width: int) -> None:
    """A table in folders of `width` keys each, for `upsert_ranges`; readers leave out the column `key_range` that the folders name."""
    df.withColumn(RANGE, key_range(key, width)).write.mode("errorifexists").partitionBy(RANGE).parquet(path)


def upsert_ranges(path: str, schema: StructType, source: DataFrame, keys: Sequence[str], key: str, width: int, scratch: str) -> None:
    """`upsert` in place, by copying the ranges of `key` that the source touches and no others.

    The new ranges are written to `scratch` first, a folder that must not exist, and then put in place of the old ones.  A run that is killed in between is
    run again: putting the same rows in twice changes nothing.  Choose the width so that a range is some files.
    """
    spark = source.sparkSession
    target = spark.read.schema(StructType([*schema, StructField(RANGE, LongType())])).parquet(path)
    change = source.withColumn(RANGE, key_range(key, width))
    touched = [r[0] for r in change.select(RANGE).distinct().collect()]
    old = target.where(F.col(RANGE).isin(touched))
    new = upsert(old.select(*schema.names), source.select(*schema.names), keys).withColumn(RANGE, key_range(key, width))
    new.write.parquet(scratch)
    made = spark.read.schema(target.schema).parquet(scratch)
    made.repartition(RANGE, F.pmod(F.hash(*keys), F.lit(FILES))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE).parquet(path)


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write to a folder that must not exist yet and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_outbox(documents: DataFrame, path: str, entity: str) -> None:
    """Queue documents for the sender, one per row, in one folder per entity; what is queued already is left out, so a
    repeated run adds nothing.  `operators.outbox` adds numbers and attempts to this."""
    queued = documents.withColumns({"entity": F.lit(entity), "document_hash": F.sha2(F.to_json(F.struct(*documents.columns)), 256)})
    try:
        before = queued.sparkSession.read.schema(queued.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        before = queued.limit(0)
    keys = ["entity", "document_hash"]
    fresh = new_rows(queued, before.where(F.col("entity") == entity), keys)
    fresh.write.mode("append").partitionBy("entity").parquet(path)

"""Dense numbers without a global sort, and the pairing of a pool with new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def dense_position(df: DataFrame, key: str, alias: str = "position", digits: int = 3) -> DataFrame:
    """Number the rows 1..n by (hash prefix of the key, key); `key` must be unique.

    The first hex digits of the key's hash make 16^digits even buckets, however the keys themselves are spread.
    Only the bucket counts (at most 16^digits rows) pass through a single window; the rows are numbered inside
    their bucket.  The number depends on the data alone, so a retried task repeats it.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("string")), 1, digits))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(alias, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_inside", "_offset")
    )


def allocate(rows: DataFrame, row_key: str, pool: DataFrame, pool_key: str, issued: DataFrame | None = None) -> DataFrame:
    """Give every row its own identifier from the pool; rows beyond the pool's size get none.

    `issued` holds the pairs (row_key, pool_key) of earlier runs: their rows and identifiers are left out before
    anything is numbered, so that no identifier is issued twice.
    """
    if issued is not None:
        rows = rows.join(issued.select(row_key), row_key, "left_anti")
        pool = pool.join(issued.select(pool_key), pool_key, "left_anti")
    numbered = dense_position(rows, row_key, "_position")
    free = dense_position(pool.select(pool_key), pool_key, "_position")
    return numbered.join(free, "_position", "left").drop("_position")


def in_order(df: DataFrame, order: Sequence[Column | str], alias: str, folder: str, first: int = 1) -> DataFrame:
    """Numbers rows from `first` on in the given order, which must tell them apart or numbers of equal rows may swap.

    The rows are dealt into ranges, sorted there and written to `folder`, so that they are put into order once; a row's number
    is its place in its range behind the sizes of the ranges before, and only these sizes, one for each range, pass one task.
    """
    place = F.monotonically_increasing_id()
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place).write.option("compression", "zstd").parquet(folder)
    rows = df.sparkSession.read.schema(StructType([*df.schema, StructField("_place", LongType())])).parquet(folder)
    # The identifier holds the number of the range above 33 bits, and the row's place in it below.
    rows = rows.withColumns({"_range": F.shiftright("_place", 33), "_in": F.col("_place").bitwiseAND((1 << 33) - 1)})
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.join(F.broadcast(offsets), "_range").withColumn(alias, F.col("_before") + F.col("_in") + first)
    return numbered.select(*df.columns, alias)

"""What several operators need: the shared folder, written intermediate tables, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; a local one is made only for a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="llm-")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def mounted(folder: str) -> str:
    """The path of a shared folder as processes open it; memory mapping needs one that is mounted on all machines."""
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"files can only be memory-mapped in a mounted folder, not in {folder}")
    return parts.path


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read again: lineage ends here, and nothing is known of its partitioning,
    so that a join after it shuffles both sides and adaptive execution can split a hot key.

    The tables stand in the folder `llm` of the shared folder.  A result is planned over them, so they must stay until it
    is written; whoever runs the job deletes that folder then, as no operator can know when its result has been read."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Lists are walked through in pieces of this length, as adding to a list copies it.
PIECE = 128
#: Rows of keys that are broadcast where a count finds no more; some 25 MB in each executor.
BROADCAST_KEYS = 250_000


def bounded(df: DataFrame, rows: int = BROADCAST_KEYS) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it has no more than `rows`; beyond, joins shuffle both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def in_arrow(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow by a function of this package.  Python workers of a local master find the package also where the program
    was started in another folder; on a cluster it is installed or sent with the job."""
    seen = rows.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in seen.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        seen["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return rows.mapInArrow(function, schema)


def row_key(*columns: str) -> Column:
    """What names a row: 128 bits of hashes of its columns, so that two of even 10^11 different rows do not share it."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("key"), *columns).alias("b"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def before(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each value the sum, or another total, of those before it: in pieces, so that the work is linear."""
    def within(part: Column, opening: Column) -> Column:
        nothing = F.array().cast("array<int>")
        walked = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
        return F.aggregate(part, F.struct(opening.alias("at"), nothing.alias("out")), walked, lambda acc: acc["out"])

    def in_pieces(items: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / PIECE).cast("int")), lambda i: F.slice(items, i * PIECE + 1, F.lit(PIECE)))
        return let(parts, lambda p: F.flatten(F.zip_with(p, within(F.transform(p, lambda part: F.aggregate(part, zero, add)), zero), within)))

    return let(values, lambda items: F.when(F.size(items) == 0, F.array().cast("array<int>")).otherwise(in_pieces(items)))


def words_of(text: Column) -> Column:
    """How many words a text has; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def make_dir(path: str) -> str:
    os.makedirs(path, exist_ok=True)
    return path


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) for each node that occurs, component being the
    smallest node reachable.

    Every node points to its smallest neighbour or itself, pointers are followed to their ends, links are rewritten to
    those ends, and what still joins two ends goes into the next round.  The number of rounds grows with the logarithm of
    a component's size.  Grouping is by min(), which combines in the tasks; joins are between written tables.
    """
    ends = F.least("a", "b"), F.greatest("a", "b")
    links = written(edges.where("a <> b").select(ends[0].alias("a"), ends[1].alias("b")).distinct(), "links")
    whole = None
    while links.limit(1).count():
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "pointers")
        moved = 1
        while moved:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            step = written(step.join(onward, "root").select("node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")), "pointers")
            moved = step.where("moved").limit(1).count()
            step = step.select("node", "root")
        if whole is None:
            whole = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            whole = written(whole.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        at = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        to = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        left = links.join(at, "a").join(to, "b").where("x <> y")
        links = written(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if whole is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return whole.select("node", F.col("root").alias("component"))


def split_hot(rows: DataFrame, keys: list[str], item: str, limit: int) -> DataFrame:
    """Adds `part` (string) and `own` (chunk): rows of a group are compared with each other part by part.  A group of at most `limit` rows
    is one part.  A larger one is dealt into chunks by the hash of `item`, and each row goes to one part for every chunk
    pair it belongs to, so that any two rows of the group meet in some part and no part exceeds about 2 * limit rows."""
    rows = written(rows, "members")
    hot = written(rows.groupBy(*keys).agg(F.count("*").alias("members")).where(F.col("members") > limit), "hot")
    chunks = F.ceil(F.coalesce("members", F.lit(1)) / limit).cast("int")
    own = F.pmod(F.xxhash64(item, F.lit("chunk")), "chunks").cast("int")
    return (
        rows.join(hot, keys, "left").withColumn("chunks", chunks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("part", F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")))
        .drop("members", "chunks", "other")
    )

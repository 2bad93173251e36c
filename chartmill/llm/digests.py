"""Exact duplicates by a persistent digest index.

The index is a table of one row for each text seen, bucketed and sorted by the SHA-256 of the text in which A-Z are
lower-case.  A batch of documents is reduced to its different digests, these are joined to the index bucket by bucket
(sort-merge anti-join; the index is not shuffled), and the digests that are new are appended with the largest doc_id that has the text.
A text that is in the index stays with the document that brought it, so a later batch is deduplicated against all earlier ones.

Appending is one write, committed as a whole.  A batch that is added again, after a failure or by mistake, finds its own
digests, adds nothing and gets the same decisions.

Null texts count as empty.  Of rows with the same text and doc_id one stays; rows without doc_id stay only where no
row of their text has one.  Other columns are ignored.  An empty batch adds nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.llm.shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Groups that hold over 1 / HOT of all rows are broadcast: there are fewer than HOT of them.
HOT = 1000


def text_digest(text: Column) -> Column:
    """SHA-256 of a text with A-Z, and only these, in lower case."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    # Lower-casing is much faster than translating, and the same where every character is one byte.
    return F.unhex(F.sha2(F.when(F.length(plain) == F.octet_length(plain), F.lower(plain)).otherwise(F.translate(plain, UPPER, LOWER)), 256))


@dataclass(frozen=True)
class DigestIndex:
    """Rows (digest, keep_id, batch) below `folder`, known to the session as table `name`."""

    spark: SparkSession
    folder: str
    name: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, folder: str, buckets: int = 64) -> DigestIndex:
        """A new index in a folder without one.  Choose buckets so that one, of some 60 bytes a text, fits a task."""
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{folder}/settings")
        return cls.open(spark, folder)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> DigestIndex:
        """The index of a folder, also in another session than the one that made it."""
        buckets = spark.read.parquet(f"{folder}/settings").first()["buckets"]
        name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}/digests'")
        return cls(spark, folder, name, buckets)

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def fresh(self, groups: DataFrame) -> DataFrame:
        """The rows of `groups`, one a digest, whose digest is not in the index."""
        return groups.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, docs: DataFrame, batch: str, row: Column | None = None) -> DataFrame:
        """Puts the texts of a batch into the index; `batch` names it and is not used for another one.  Returns its rows
        (doc_id, digest, batch, row) for `decide`; `row` numbers them."""
        row = F.monotonically_increasing_id() if row is None else row
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"), F.lit(batch).alias("batch"), row.alias("row"))
        rows = written(rows, "batch")
        # Written before the join, lest Spark moves the anti-join below the grouping, where a text may be in many rows.
        groups = written(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "groups")
        self.fresh(groups).select("digest", "keep_id", F.lit(batch).alias("batch")).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return rows

    def compact(self, folder: str) -> DigestIndex:
        """A copy with one sorted file a bucket, for an index that many batches have been appended to."""
        other = DigestIndex.create(self.spark, folder, self.buckets)
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        self.entries().repartition(self.buckets, bucket).write.insertInto(other.name)
        self.spark.catalog.refreshTable(other.name)
        return other

    def decide(self, rows: DataFrame) -> DataFrame:
        """Each of the rows that `add` returned, of one batch or of several together: doc_id, keep_id (the document that
        the index holds for its text), group_size (rows given with this text), kept, text_sha256."""
        total = rows.count()
        per_batch = written(rows.groupBy("digest", "batch").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("last")), "last")
        known = per_batch.join(self.entries().withColumnRenamed("batch", "first_batch").hint("merge"), "digest")
        own = (F.col("batch") == F.col("first_batch")) & F.col("last.doc_id").eqNullSafe(F.col("keep_id"))
        groups = written(known.groupBy("digest").agg(
            F.any_value("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.max(F.when(own, F.struct("batch", "last.row"))).alias("stays"),
        ), "groups")
        hot = F.col("group_size") * HOT > total
        common, rest = F.broadcast(groups.where(hot)), groups.where(~hot)
        joined = rows.join(common, "digest").unionByName(rows.join(common.select("digest"), "digest", "left_anti").join(rest, "digest"))
        kept = F.coalesce(F.struct("batch", "row") == F.col("stays"), F.lit(False))
        return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def add_newest_first(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents as two batches, the upper half of the doc_ids first, so that of equal texts the index keeps the one
    with the largest doc_id; returns what `decide` takes."""
    edge = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    if edge is None:
        return index.add(docs, "all")
    newer = index.add(docs.where(F.col("doc_id") > edge), "newer")
    return newer.unionByName(index.add(docs.where((F.col("doc_id") <= edge) | F.col("doc_id").isNull()), "older"))


def buckets_for(docs: DataFrame, texts: int = 1_000_000) -> int:
    """Buckets of about `texts` rows for an index of this many documents."""
    return max(8, -(-docs.count() // texts))


def deduplicated(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """The documents of a batch, as they are, whose text neither the index nor another one of the batch has."""
    keyed = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "documents")
    rows = index.add(keyed.select("doc.doc_id", "doc.text", "row"), batch, F.col("row"))
    last = written(rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last")), "last")
    known = last.join(index.entries().hint("merge"), "digest")
    stays = known.where((F.col("batch") == batch) & F.col("last.doc_id").eqNullSafe(F.col("keep_id"))).select("last.row")
    return keyed.join(stays, "row", "left_semi").select("doc.*")

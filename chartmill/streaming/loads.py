"""The idempotent load as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from chartmill.operators.choose import pick_one
from chartmill.operators.incremental import idempotent_load, within_range
from chartmill.operators.lookups import anti_staged
from chartmill.sources.ledger import Ledger
from chartmill.sources.readers import read_staged
from chartmill.sources.writers import append_rows


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder, as they come."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stage_batch(batch: DataFrame, ledger: Ledger, transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
                may_wait: Callable[[DataFrame], DataFrame] | None = None, order: Sequence[str] = (), range_key: str | None = None) -> int:
    """One micro-batch into a ledger; returns how many rows it added.

    With `may_wait`, rows that the transform does not give yet, such as encounters of a patient who is not staged, are put
    to it again with every later batch.  `may_wait` keeps those that can still come; a voided encounter never does.  What
    waits is a snapshot that is committed together with the rows, so a row leaves it when it is staged, and a
    batch that is replayed, after a failure before or after its commit, finds the same state and leaves the same.
    """
    keys = list(ledger.keys)
    known = [k for k in keys if k in batch.columns]
    told = batch if may_wait is None else batch.unionByName(ledger.state(batch.schema))
    # The ready rows are used for the range, the load and what waits; lost parts are computed again.
    ready = transform(told).persist()
    try:
        # What waits is not staged, so the range of staged rows to look at is that of the rows that are ready now.
        staged = ledger.staged()
        if range_key is not None:
            staged = within_range(staged, ready, range_key)
        fresh = idempotent_load(ready, staged, keys, order)
        state = None if may_wait is None else pick_one(anti_staged(may_wait(told), ready, known), known)
        return ledger.append(fresh, state)
    finally:
        ready.unpersist()


def stage_stream(
    stream: DataFrame,
    staged_path: str | Ledger,
    checkpoint: str,
    keys: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    order: Sequence[str] = (),
    every: str | None = None,
    range_key: str | None = None,
    waiting_path: str | None = None,
    first_run: bool = False,
    may_wait: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Run the batch load on every micro-batch, into a plain folder of rows or, better, into a ledger (`stage_batch`).

    `range_key`, one of the keys and never null, limits the staged rows read to the batch's range of it; name a
    key that grows over time.

    For a plain folder, `waiting_path` names a second one that keeps the rows that wait, those that `may_wait` keeps or else all, as snapshots.
    With `first_run`, nothing may be staged yet.

    A micro-batch that is replayed after a failure finds its rows staged and adds none.  Without `every` (say
    '1 minute') the stream takes what is there and stops.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        if isinstance(staged_path, Ledger):
            stage_batch(batch, staged_path, transform, may_wait, order, range_key)
            return
        spark = batch.sparkSession
        told, known = batch, [k for k in keys if k in batch.columns]
        waiting = None if waiting_path is None else Ledger(spark, waiting_path, batch.schema, tuple(known))
        if waiting is not None:
            told = batch.unionByName(waiting.state(batch.schema))
        rows = transform(told).persist()
        staged = read_staged(spark, staged_path, rows.schema, first_run)
        if range_key is not None:
            staged = within_range(staged, rows, range_key)
        append_rows(idempotent_load(rows, staged, keys, order), staged_path)
        if waiting is not None:
            rest = told if may_wait is None else may_wait(told)
            waiting.append(None, pick_one(anti_staged(rest, rows, known), known))
        rows.unpersist()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()

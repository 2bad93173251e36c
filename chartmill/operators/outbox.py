"""Delivery with each document queued once: a numbered queue, and attempts as a small state machine.

A document is known by its entity and the hash of its row's key and its text, so a row that changed is a new one.  It is queued once, under a number that gives the order of
queueing and never changes, and then moves through these states, which follow from the events stored about it:

    queued -> sent -> delivered                 the receiver answered 201; it is never sent again
                   -> rejected                  another answer, under the rule that takes any answer
                   -> retry -> due -> sent      another answer, under the rule that waits for a 201
                   -> due -> sent               no answer in time

Events name a document by its queue number, which is what rounds of sending group and join by: eight bytes instead of a
hash, which no codec makes smaller.  Answers that come without a number get it from the queue.

An attempt is stored before its document goes out, so a run that is killed in between leaves it sent, and it comes due
when no answer arrives.  Answers may come twice or late; a 201 is never taken back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chartmill.functions import fixed_values as fixed
from chartmill.operators.delivery import ALWAYS, CREATED_ONLY, DELIVERED, REJECTED
from chartmill.operators.lookups import new_rows
from chartmill.operators.numbering import in_order
from chartmill.session import run_dir
from chartmill.sources.ledger import Ledger

QUEUED, SENT, RETRY, DUE = "queued", "sent", "retry", "due"
QUEUE = {"entity": "string", "key": "string", "document": "string", "document_hash": "string", "queue_number": "long"}
#: An event has the number of its document; its name stands there only if the document was not queued when its answer came.
EVENTS = {"queue_number": "long", "entity": "string", "document_hash": "string", "attempt": "int", "event": "string", "at": "timestamp_ntz", "code": "string", "uuid": "string"}
ASKED, ANSWERED = "sent", "answered"
NAME = ("entity", "document_hash")
NUMBER = "queue_number"


def _schema(columns: dict[str, str]) -> StructType:
    return StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))


def newest_events(events: DataFrame) -> DataFrame:
    """One row a document: its last attempt, the newest answer and the uuid of its newest 201."""
    sent = F.when(F.col("event") == ASKED, F.struct("attempt", "at"))
    answer = F.when(F.col("event") == ANSWERED, F.struct("attempt", "at", "code", "uuid"))
    created = F.when((F.col("event") == ANSWERED) & (F.col("code") == fixed.CREATED), F.struct("attempt", "at", "uuid"))
    return events.groupBy(NUMBER).agg(F.max(sent).alias("sent"), F.max(answer).alias("answer"), F.max(created).alias("created"))


def states(queue: DataFrame, events: DataFrame, now: Column, rule: str = CREATED_ONLY, retry_minutes: int = 5, timeout_minutes: int = 60,
           most_doublings: int = 8) -> DataFrame:
    """The queue with `state`, `attempt` (0 before the first), `due_at`, `code` and `target_uuid`.

    After the n-th attempt a refused document comes due after `retry_minutes` times 2^(n-1)."""
    if rule not in (ALWAYS, CREATED_ONLY):
        raise ValueError(f"unknown rule {rule}")
    rows = queue.join(newest_events(events), NUMBER, "left")
    attempt = F.greatest(F.coalesce("sent.attempt", F.lit(0)), F.coalesce("answer.attempt", F.lit(0)))
    answered = F.col("answer").isNotNull() & (F.col("answer.attempt") >= attempt)
    wait = F.lit(retry_minutes) * F.pow(F.lit(2), F.least(attempt - 1, F.lit(most_doublings)))
    minutes = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))
    due_at = F.when(answered, F.col("answer.at") + minutes(wait)).when(attempt > 0, F.col("sent.at") + minutes(F.lit(timeout_minutes)))
    rows = rows.withColumns({"attempt": attempt, "due_at": due_at, "_answered": answered})
    state = (
        F.when(F.col("created").isNotNull(), DELIVERED)
        .when(F.col("attempt") == 0, QUEUED)
        .when(F.col("_answered") & F.lit(rule == ALWAYS), REJECTED)
        .when(F.col("due_at") <= now, DUE)
        .when(F.col("_answered"), RETRY)
        .otherwise(SENT)
    )
    rows = rows.withColumn("state", state)
    over = F.col("state").isin(DELIVERED, REJECTED, QUEUED)
    return rows.select(
        *queue.columns, "state", "attempt", F.when(~over, F.col("due_at")).alias("due_at"),
        F.when(F.col("created").isNotNull(), F.lit(fixed.CREATED)).otherwise(F.col("answer.code")).alias("code"), F.col("created.uuid").alias("target_uuid"))


@dataclass(frozen=True)
class Outbox:
    """Queue and events below `path`."""

    spark: SparkSession
    path: str
    rule: str = CREATED_ONLY
    retry_minutes: int = 5
    timeout_minutes: int = 60

    @property
    def queue(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}/queue", _schema(QUEUE), NAME, "queue_number")

    @property
    def events(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}/events", _schema(EVENTS), (NUMBER, *NAME, "attempt", "event", "code"))

    def numbered_events(self) -> DataFrame:
        """All events, those by name with the number and without the name where their document has been queued since."""
        events = self.events.staged().select(*EVENTS)
        by_name = events.where(F.col(NUMBER).isNull())
        if by_name.isEmpty():
            return events
        return events.where(F.col(NUMBER).isNotNull()).unionByName(self.numbered(by_name.drop(NUMBER)))

    def numbered(self, events: DataFrame) -> DataFrame:
        """Events by name (`NAME` and others of `EVENTS`) with the number instead, as far as their documents are queued."""
        numbers = self.queue.staged().select(*[F.col(c).alias(f"_{c}") for c in NAME], NUMBER)
        found = events.join(numbers, (F.col("entity") == F.col("_entity")) & (F.col("document_hash") == F.col("_document_hash")), "left")
        unknown = F.col(NUMBER).isNull()
        return found.withColumns({c: F.when(unknown, F.col(c)) for c in NAME}).select(*EVENTS)

    def put(self, documents: DataFrame, entity: str, key: str) -> int:
        """Queues documents that are not queued yet, in order of `key`, behind all others; returns how many.

        Numbers go on from the last one, and those given before stay: only the new documents are ordered."""
        text = F.concat_ws("\n", F.col("key"), F.col("document"))
        # Shuffled, the hash is 32 bytes instead of 64 digits, or it is made anew.
        short = lambda digits: F.unhex(digits).alias("document_hash")
        rows = documents.select(F.lit(entity).alias("entity"), F.col(key).alias("_order"), F.col(key).cast("string").alias("key"), "document")
        queue = self.queue
        last = queue.edges().first()["high"]
        before = queue.staged().where(F.col("entity") == entity).select("entity", short(F.col("document_hash")))
        fresh = new_rows(rows.select("*", short(F.sha2(text, 256))), before, NAME, ["_order"]).drop("document_hash")
        numbered = in_order(fresh, ["_order", F.sha2(text, 256)], NUMBER, run_dir(self.spark, "queue"), 1 if last is None else last + 1)
        return queue.append(numbered.withColumn("document_hash", F.sha2(text, 256)).select(*QUEUE))

    def states(self, now: Column) -> DataFrame:
        return states(self.queue.staged().select(*QUEUE), self.numbered_events(), now, self.rule, self.retry_minutes, self.timeout_minutes)

    def send(self, now: Column) -> DataFrame:
        """Stores an attempt for each document that is queued or due, and returns what to send: the queue's columns and
        `attempt`, as stored."""
        events = self.events
        load = 1 + max((e["load_number"] for e in events.log()), default=0)
        due = self.states(now).where(F.col("state").isin(QUEUED, DUE))
        nothing = F.lit(None).cast("string")
        events.append(due.select(
            NUMBER, *[nothing.alias(c) for c in NAME], (F.col("attempt") + 1).cast("int").alias("attempt"), F.lit(ASKED).alias("event"),
            now.cast("timestamp_ntz").alias("at"), nothing.alias("code"), nothing.alias("uuid")))
        sent = events.staged().where(F.col("load_number") == load).select(NUMBER, "attempt")
        return self.queue.staged().select(*QUEUE).join(sent, NUMBER).select(*QUEUE, "attempt")

    def answer(self, answers: DataFrame) -> int:
        """Stores answers (attempt, at, code, uuid and either queue_number or entity and document_hash); the same answer to an
        attempt counts once."""
        events = self.events
        told = answers.withColumn("event", F.lit(ANSWERED))
        if NUMBER in told.columns:
            rows = told.withColumns({c: F.lit(None).cast("string") for c in NAME}).select(*EVENTS)
        else:
            rows = self.numbered(told)
        before = self.numbered_events().where(F.col("event") == ANSWERED)
        return events.append(new_rows(rows, before, events.keys, ["at"], nullable=[NUMBER, *NAME, "code"]))

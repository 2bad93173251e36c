"""Committed loads of a staged entity.

Below its path a ledger keeps `rows`, with a folder for every attempt to load, `states`, with what a load carries over to the next
one, and `log`, to which a commit appends one file.  A load writes its folders first and then commits both at once;
readers see committed folders only.  So a load that is killed halfway is invisible, and running it again is all there is
to do; what it left behind belongs to no load and may be deleted.

A log entry holds the load's number, its number of rows and the range of its cursor key, so cursors and the newest row need not read what was staged
before.  Entries are read by the driver, one for each folder that counts; `compact` joins small loads and keeps them few.
Loads of one entity follow one another: two that run at the same time would not know of each other's rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions.columns import natural_uuid
from chartmill.operators.choose import latest
from chartmill.schemas import GIVEN_UUID, STAGED_KEYS, staged_schema

LOG = "version long, base long, kind string, folder string, load_number long, n_rows long, low long, high long"
LOAD, STATE = "load", "state"


@dataclass(frozen=True)
class Ledger:
    """The loads of rows of `schema` with natural `keys` below `path`; `cursor` is a number or a time that the log keeps the
    range of."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    cursor: str | None = None
    given_uuid: str | None = None

    @classmethod
    def of(cls, spark: SparkSession, path: str, entity: str, cursor: str | None = None) -> Ledger:
        """The ledger of a staged entity; rows without a uuid of their own get one where the entity has one."""
        return cls(spark, path, staged_schema(entity), tuple(STAGED_KEYS[entity]), cursor, entity if entity in GIVEN_UUID else None)

    @property
    def stored(self) -> T.StructType:
        """The rows as they are stored: with an id out of the natural key and the number of their load."""
        given = [T.StructField("uuid", T.StringType())] if self.given_uuid and "uuid" not in self.schema.names else []
        return T.StructType([*self.schema, *given, T.StructField("id", T.StringType()), T.StructField("load_number", T.LongType())])

    def log(self) -> list[Row]:
        """The entries that count: since the last compaction, which lists anew what was there."""
        try:
            entries = self.spark.read.schema(LOG).parquet(f"{self.path}/log").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        base = max(e["base"] for e in entries)
        return sorted((e for e in entries if e["version"] >= base), key=lambda e: (e["version"], e["kind"]))

    def staged(self) -> DataFrame:
        """All committed rows; none before the first load."""
        return self._read([e["folder"] for e in self.log() if e["kind"] == LOAD])

    def state(self, schema: T.StructType) -> DataFrame:
        """What the last commit carried over; nothing before the first."""
        kept = [e["folder"] for e in self.log() if e["kind"] == STATE]
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kept[-1]}") if kept else self.spark.createDataFrame([], schema)

    def edges(self) -> DataFrame:
        """One row (low, high): the range of the cursor key over all loads, in the key's type, null before the first one.  Takes the place of the
        staged table in `after_cursor` and `before_cursor`."""
        log = [e for e in self.log() if e["kind"] == LOAD and e["high"] is not None]
        row = (min((e["low"] for e in log), default=None), max((e["high"] for e in log), default=None))
        kind = self.schema[self.cursor].dataType
        return self.spark.createDataFrame([row], "low long, high long").select(*[_value(F.col(c), kind).alias(c) for c in ("low", "high")])

    def newest(self) -> DataFrame:
        """The row with the largest id of the newest load that brought any; only this load is read."""
        loads = [e for e in self.log() if e["kind"] == LOAD and e["n_rows"]]
        if not loads:
            return self._read([])
        rows = self._read([max(loads, key=lambda e: e["load_number"])["folder"]])
        # A compacted folder holds several loads.
        return latest(rows.withColumn("_of", F.struct("load_number", "id")), "_of").drop("_of")

    def write(self, rows: DataFrame) -> Row:
        """Writes a load's rows without committing them; the entry that would."""
        log = self.log()
        number = 1 + max((e["load_number"] for e in log if e["kind"] == LOAD), default=0)
        added = {"id": natural_uuid(*self.keys), "load_number": F.lit(number).cast("long")}
        if self.given_uuid and "uuid" not in rows.columns:
            added["uuid"] = natural_uuid(F.lit(self.given_uuid), *self.keys)
        folder = f"rows/{number:08d}-{uuid.uuid4().hex}"
        # Ids and hashes are digits of 4 bits, which zstd halves and the default codec does not.
        rows.withColumns(added).select(*self.stored.names).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        return self._entry(folder, number)

    def commit(self, *entries: Row, base: int | None = None) -> None:
        log = self.log()
        version = 1 + max((e["version"] for e in log), default=0)
        base = max((e["base"] for e in log), default=0) if base is None else version
        rows = [(version, base, e["kind"], e["folder"], e["load_number"], e["n_rows"], e["low"], e["high"]) for e in entries]
        # One file, so that it is there as a whole or not at all.
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def append(self, rows: DataFrame | None, state: DataFrame | None = None) -> int:
        """Loads rows, and with them the state for the next load; returns how many rows were added.  A load that brings
        nothing is not logged."""
        entries = [] if rows is None else [self.write(rows)]
        added = sum(e["n_rows"] for e in entries)
        entries = entries if added else []
        if state is not None:
            folder = f"states/{uuid.uuid4().hex}"
            state.write.parquet(f"{self.path}/{folder}")
            entries.append(Row(kind=STATE, folder=folder, load_number=None, n_rows=None, low=None, high=None))
        if entries:
            self.commit(*entries)
        return added

    def load(self, job: Callable[[DataFrame], DataFrame]) -> int:
        """Runs a job, which is given the staged rows and returns those to add, as a load."""
        return self.append(job(self.staged()))

    def compact(self, at_most: int = 10_000_000) -> None:
        """Joins loads of at most `at_most` rows into one folder, in order of the cursor key; nothing else changes."""
        log = self.log()
        loads = [e for e in log if e["kind"] == LOAD]
        small = [e for e in loads if e["n_rows"] <= at_most]
        if len(small) < 2:
            return
        rows = self._read([e["folder"] for e in small])
        folder = f"rows/{max(e['load_number'] for e in small):08d}-{uuid.uuid4().hex}"
        (rows.repartitionByRange(self.cursor).sortWithinPartitions(self.cursor) if self.cursor else rows).write.parquet(f"{self.path}/{folder}")
        joined = self._entry(folder, max(e["load_number"] for e in small))
        self.commit(joined, *(e for e in loads if e not in small), *[e for e in log if e["kind"] == STATE][-1:], base=1)

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*(f"{self.path}/{f}" for f in folders))

    def _entry(self, folder: str, number: int) -> Row:
        edge = _number(F.col(self.cursor), self.schema[self.cursor].dataType) if self.cursor else F.lit(None).cast("long")
        found = self._read([folder]).agg(F.count("*").alias("n"), F.min(edge).alias("low"), F.max(edge).alias("high")).first()
        return Row(kind=LOAD, folder=folder, load_number=number, n_rows=found["n"], low=found["low"], high=found["high"])


def _number(key, kind: T.DataType):
    """A cursor key as the log keeps it: a number, or the microseconds of a time."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(key.cast("timestamp"))
    return key.cast("long")


def _value(number, kind: T.DataType):
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.timestamp_micros(number).cast(kind)
    return number.cast(kind)

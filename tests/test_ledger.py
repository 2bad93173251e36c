"""Committed loads: killed and replayed ones, cursors, the newest row, compaction, and batches with rows that wait."""

import datetime

import pytest
from pyspark.sql import functions as F

from chartmill.operators import incremental
from chartmill.sources.ledger import Ledger
from chartmill.streaming import loads

SCHEMA = "k long, p long, at timestamp_ntz"


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(k, k % 3, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=k)) for k in range(1, 31)], SCHEMA).cache()


@pytest.fixture
def ledger(spark, source, tmp_path):
    return Ledger(spark, f"{tmp_path}/ledger", source.schema, ("k",), "at")


def keys(df):
    return sorted(r["k"] for r in df.collect())


def test_a_killed_load_is_invisible_and_repeatable(source, ledger):
    assert ledger.staged().count() == 0 and ledger.newest().count() == 0
    assert ledger.append(source.where("k <= 10")) == 10
    ledger.write(source.where("k <= 20"))  # killed before its commit
    assert keys(ledger.staged()) == list(range(1, 11))
    for added in (10, 0, 0):
        assert ledger.append(incremental.idempotent_load(source.where("k <= 20"), ledger.staged(), ["k"])) == added
    assert keys(ledger.staged()) == list(range(1, 21))
    assert {r["load_number"]: r["n"] for r in ledger.staged().groupBy("load_number").agg(F.count("*").alias("n")).collect()} == {1: 10, 2: 10}
    assert ledger.staged().select("id").distinct().count() == 20


def test_cursors_read_the_log(spark, source, ledger):
    assert keys(incremental.after_cursor(source, "at", ledger.edges(), "high")) == list(range(1, 31))
    ledger.append(source.where("k BETWEEN 11 AND 14"))
    ledger.append(source.where("k BETWEEN 15 AND 20"))
    assert keys(incremental.after_cursor(source, "at", ledger.edges(), "high")) == list(range(21, 31))
    assert keys(incremental.before_cursor(source, "at", ledger.edges(), "low")) == list(range(1, 11))
    by_number = Ledger(spark, ledger.path + "-2", source.schema, ("k",), "k")
    by_number.append(source.where("k <= 4"))
    assert keys(incremental.after_cursor(source, "k", by_number.edges(), "high")) == list(range(5, 31))
    plan = incremental.after_cursor(source, "at", ledger.edges(), "high")._jdf.queryExecution().executedPlan().toString()
    assert "ledger/rows" not in plan


def test_newest_row_reads_one_load(source, ledger):
    ledger.append(source.where("k <= 10"))
    ledger.append(source.where("k BETWEEN 11 AND 13"))
    newest = ledger.newest()
    assert len(newest.inputFiles()) >= 1 and all("00000002" in f for f in newest.inputFiles())
    best = max((r["id"], r["k"]) for r in ledger.staged().where("load_number = 2").collect())
    assert newest.first()["k"] == best[1]
    ledger.compact()
    assert ledger.newest().first()["k"] == best[1]


def test_compaction_keeps_rows_state_and_numbers(spark, source, ledger):
    for k in (10, 20, 30):
        ledger.append(source.where(f"k > {k} - 10 AND k <= {k}"), state=source.where(f"k = {k}"))
    before = sorted(map(str, ledger.staged().collect()))
    ledger.compact()
    assert sorted(map(str, ledger.staged().collect())) == before
    assert len([e for e in ledger.log() if e["kind"] == "load"]) == 1 and keys(ledger.state(source.schema)) == [30]
    assert keys(incremental.after_cursor(source, "at", ledger.edges(), "high")) == []
    ledger.append(source.where("k = 1").withColumn("k", F.lit(99).cast("long")))
    assert ledger.staged().where("load_number = 4").first()["k"] == 99
    ledger.compact(at_most=5)  # nothing to join
    assert ledger.staged().count() == 31


def test_waiting_rows_shrink_and_replays_change_nothing(source, ledger):
    """Odd keys can never come; others wait until they are known."""
    may_wait = lambda told: told.where("k % 2 = 0")
    batches = ((1, 10, 4), (11, 20, 14), (21, 30, 30))
    for low, high, known in batches:
        batch = source.where(f"k BETWEEN {low} AND {high}")
        for _ in range(2):  # each batch is replayed once
            loads.stage_batch(batch, ledger, lambda told, known=known: told.where(f"k % 2 = 0 AND k <= {known}"), may_wait, range_key="k")
            assert keys(ledger.staged()) == [k for k in range(2, known + 1, 2) if k <= high]
            assert keys(ledger.state(source.schema)) == [k for k in range(2, high + 1, 2) if k > known]


def test_a_batch_killed_before_its_commit(source, ledger, monkeypatch):
    transform, may_wait = (lambda told: told.where("k <= 5")), (lambda told: told)
    loads.stage_batch(source.where("k <= 8"), ledger, transform, may_wait)
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            loads.stage_batch(source.where("k BETWEEN 9 AND 12"), ledger, lambda told: told.where("k <= 10"), may_wait)
    assert keys(ledger.staged()) == [1, 2, 3, 4, 5] and keys(ledger.state(source.schema)) == [6, 7, 8]
    loads.stage_batch(source.where("k BETWEEN 9 AND 12"), ledger, lambda told: told.where("k <= 10"), may_wait)
    assert keys(ledger.staged()) == list(range(1, 11)) and keys(ledger.state(source.schema)) == [11, 12]


def test_given_uuid(spark, tmp_path):
    ledger = Ledger.of(spark, f"{tmp_path}/p", "programs", "patient_program_id")
    row = spark.createDataFrame([(1, 2)], "patient_id long, program_id int")
    full = spark.createDataFrame([], ledger.schema).unionByName(row, allowMissingColumns=True)
    ledger.append(full)
    stored = ledger.staged().first()
    assert len(stored["uuid"]) == 36 and stored["uuid"] != stored["id"] and stored["load_number"] == 1

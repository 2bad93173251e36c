"""Each document is queued once and sent as its state asks, through retries, silence, replays and killed runs."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from chartmill.operators import numbering, outbox
from chartmill.operators.delivery import ALWAYS
from chartmill.sources import writers
from chartmill.sources.ledger import Ledger

START = datetime.datetime(2024, 3, 1, 12)


def at(minute):
    return F.lit(START + datetime.timedelta(minutes=minute)).cast("timestamp_ntz")


@pytest.fixture
def papers(spark):
    return spark.createDataFrame([(i, f'{{"n":{i}}}') for i in (5, 3, 9, 7)], "id long, document string")


@pytest.fixture
def box(spark, tmp_path):
    return outbox.Outbox(spark, f"{tmp_path}/box")


def state_of(box, minute):
    return {int(r["key"]): (r["state"], r["attempt"]) for r in box.states(at(minute)).collect()}


def answer(spark, box, rows):
    """Answers (key, attempt, minute, code)."""
    names = {r["key"]: r["document_hash"] for r in box.queue.staged().collect()}
    told = [("visit", names[str(k)], n, START + datetime.timedelta(minutes=m), code, "u" if code == "201" else None) for k, n, m, code in rows]
    return box.answer(spark.createDataFrame(told, "entity string, document_hash string, attempt int, at timestamp_ntz, code string, uuid string"))


def test_two_runs_queue_once_and_numbers_stay(spark, box, papers):
    assert box.put(papers, "visit", "id") == 4 and box.put(papers, "visit", "id") == 0
    first = {r["key"]: r["queue_number"] for r in box.queue.staged().collect()}
    assert first == {"3": 1, "5": 2, "7": 3, "9": 4}
    more = spark.createDataFrame([(1, "{}"), (5, '{"n":5}'), (5, '{"changed":5}'), (1, "{}")], "id long, document string")
    assert box.put(more, "visit", "id") == 2
    assert sorted((r["queue_number"], r["key"]) for r in box.queue.staged().collect()) == [(1, "3"), (2, "5"), (3, "7"), (4, "9"), (5, "1"), (6, "5")]
    assert box.put(papers, "order", "id") == 4  # the same text of another entity


def test_retries_and_silence(spark, box, papers):
    box.put(papers, "visit", "id")
    assert set(state_of(box, 0).values()) == {("queued", 0)}
    assert sorted(r["key"] for r in box.send(at(0)).collect()) == ["3", "5", "7", "9"]
    assert box.send(at(1)).count() == 0
    assert answer(spark, box, [(3, 1, 1, "201"), (5, 1, 1, "500")]) == 2
    assert answer(spark, box, [(3, 1, 1, "201")]) == 0
    assert state_of(box, 5) == {3: ("delivered", 1), 5: ("retry", 1), 7: ("sent", 1), 9: ("sent", 1)}
    assert state_of(box, 6)[5] == ("due", 1) and state_of(box, 59)[7] == ("sent", 1) and state_of(box, 60)[7] == ("due", 1)
    assert [(r["key"], r["attempt"]) for r in box.send(at(6)).collect()] == [("5", 2)]
    answer(spark, box, [(5, 2, 7, "500"), (7, 1, 200, "201"), (9, 1, 8, None)])
    assert state_of(box, 16)[5] == ("retry", 2) and state_of(box, 17)[5] == ("due", 2)
    # A late 201 counts, also after a later refusal; a delivered document is never due again.
    answer(spark, box, [(5, 1, 300, "201")])
    for minute in (17, 10_000):
        assert state_of(box, minute)[5] == ("delivered", 2) and state_of(box, minute)[3] == ("delivered", 1) and state_of(box, minute)[7] == ("delivered", 1)
    assert [r["key"] for r in box.send(at(10_000)).collect()] == ["9"]


def test_any_answer_ends_it(spark, box, papers):
    box = outbox.Outbox(spark, box.path, rule=ALWAYS)
    box.put(papers, "visit", "id")
    box.send(at(0))
    answer(spark, box, [(3, 1, 1, "201"), (5, 1, 1, "500")])
    assert state_of(box, 1000) == {3: ("delivered", 1), 5: ("rejected", 1), 7: ("due", 1), 9: ("due", 1)}


def test_killed_runs(spark, box, papers, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            box.put(papers, "visit", "id")
    assert box.put(papers, "visit", "id") == 4
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            box.send(at(0))
    assert set(state_of(box, 0).values()) == {("queued", 0)}
    box.send(at(0))  # the documents of this run are lost on their way
    assert box.send(at(59)).count() == 0 and box.send(at(60)).count() == 4


def test_empty(spark, box, papers):
    assert box.put(papers.where("false"), "visit", "id") == 0 and box.send(at(0)).count() == 0 and box.states(at(0)).count() == 0


def test_numbers_in_order(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    got = numbering.in_order(rows, ["k"], "n", f"{tmp_path}/n", 11)
    assert got.where("n <> k + 11").count() == 0 and got.count() == 5000


def test_write_outbox_once(spark, papers, tmp_path):
    for _ in range(2):
        writers.write_outbox(papers, f"{tmp_path}/o", "visit")
    writers.write_outbox(papers.where("id = 3"), f"{tmp_path}/o", "order")
    assert spark.read.parquet(f"{tmp_path}/o").groupBy("entity").count().orderBy("entity").collect() == [("order", 1), ("visit", 4)]


def test_events_go_by_number(spark, box, papers):
    """Rounds group and join by the queue number; names are stored only of documents that are not queued."""
    early = spark.createDataFrame([("visit", hashlib.sha256(b'4\n{"n":4}').hexdigest(), 1, START, "201", "u4"), ("visit", "nobody", 1, START, "201", "u")],
                                  "entity string, document_hash string, attempt int, at timestamp_ntz, code string, uuid string")
    box.put(papers, "visit", "id")
    sent = box.send(at(0))
    answers = sent.where("queue_number <= 2").select("queue_number", "attempt", at(1).alias("at"), F.lit("201").alias("code"), F.concat(F.lit("u"), "key").alias("uuid"))
    assert box.answer(answers) == 2 and box.answer(answers) == 0
    assert answer(spark, box, [(3, 1, 1, "201"), (7, 1, 1, "500")]) == 1  # the first one again, by name
    assert box.events.staged().where("document_hash is not null or queue_number is null").count() == 0
    # An answer that came before its document was queued counts from then on, once.
    assert box.answer(early) == 2 and box.answer(early) == 0
    assert box.put(spark.createDataFrame([(4, '{"n":4}')], "id long, document string"), "visit", "id") == 1
    assert box.answer(early) == 0
    assert state_of(box, 2) == {3: ("delivered", 1), 5: ("delivered", 1), 7: ("retry", 1), 9: ("sent", 1), 4: ("delivered", 1)}
    told = {r["key"]: r["target_uuid"] for r in box.states(at(2)).collect()}
    assert told == {"3": "u3", "5": "u5", "7": None, "9": None, "4": "u4"}


def test_rounds_move_no_hashes(spark, box, papers):
    """What is due, and what a round sends, is found without the hashes of documents and events."""
    box.put(papers, "visit", "id")
    sent = box.send(at(0))
    box.answer(sent.select("queue_number", "entity", "document_hash", "attempt", at(1).alias("at"), F.lit("500").alias("code"), F.lit(None).cast("string").alias("uuid")))
    for rows in (sent.select("queue_number", "key", "attempt"), box.states(at(2)).select("queue_number", "key", "state", "attempt", "code", "target_uuid")):
        assert "document_hash" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 4

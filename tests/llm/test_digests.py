"""Exact duplicates by the digest index: against a dictionary, in batches, replayed and reopened."""

import glob
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from chartmill.llm import digests
from chartmill.llm.shared import new_folder
from tests.llm.test_operators import ASCII_LOWER, odd_rows, table


def digest(text):
    return hashlib.sha256((text or "").translate(ASCII_LOWER).encode()).hexdigest()


def brute(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(digest(text), []).append(i)
    out = []
    for key, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, ids[0], len(ids), n == 0, key) for n, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.fixture
def index(spark):
    return digests.DigestIndex.create(spark, new_folder(spark, "digests"), 4)


def test_all_rows(spark, index):
    rows = odd_rows() + [(200, "One TWO", "en", "a"), (201, "ÄÖ", "de", "a"), (202, "äö", "de", "a"), (203, "Aİ", "x", "x"), (204, "aİ", "x", "x"), (205, "ai̇", "x", "x")]
    rows += [(300 + i, "the SAME text", "en", "a") for i in range(500)]
    got = index.decide(digests.add_newest_first(table(spark, rows), index))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert index.entries().count() == len({digest(t) for _, t, *_ in rows})


def test_empty_and_nameless(spark, index):
    nothing = table(spark, [(1, "a", "b", "c")]).where("false")
    assert index.decide(digests.add_newest_first(nothing, index)).count() == 0
    nameless = [(None, "x", "a", "a"), (None, "X", "a", "a"), (None, None, "a", "a")]
    got = index.decide(digests.add_newest_first(table(spark, nameless), index))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(nameless)


def test_batches_replayed_and_reopened(spark, index):
    first = [(i, f"text {i % 40}", "en", "a") for i in range(100)]
    second = [(i, f"Text {i % 60}", "en", "a") for i in range(100, 200)]
    assert sorted(r["doc_id"] for r in digests.deduplicated(table(spark, first), index, "1").collect()) == list(range(60, 100))
    files = glob.glob(f"{index.folder.removeprefix('file:')}/digests/*.parquet")
    again = digests.DigestIndex.open(spark, index.folder)
    # The second batch only brings what the first one has not; a replay decides alike and adds nothing.
    for _ in range(2):
        kept = digests.deduplicated(table(spark, second), again, "2")
        assert kept.columns == table(spark, second).columns
        assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(100, 200) if i % 60 >= 40 and i + 60 >= 200]
        assert again.entries().count() == 60
    rows = again.add(table(spark, second), "2")
    assert again.entries().where("batch = '1'").count() == 40
    decided = {r["doc_id"]: r for r in again.decide(rows).collect()}
    assert decided[121]["keep_id"] == 81 and not decided[121]["kept"] and decided[121]["group_size"] == 2
    assert set(files) <= set(glob.glob(f"{index.folder.removeprefix('file:')}/digests/*.parquet"))
    small = again.compact(new_folder(spark, "digests"))
    assert sorted(map(str, small.entries().collect())) == sorted(map(str, again.entries().collect()))
    assert len(glob.glob(f"{small.folder.removeprefix('file:')}/digests/*.parquet")) <= 4


def test_index_is_not_shuffled(spark, index):
    index.add(table(spark, [(i, f"text {i}", "en", "a") for i in range(100)]), "1")
    groups = spark.range(10).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("keep_id"))
    plan = index.fresh(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_two_indexes_are_apart(spark, index):
    other = digests.DigestIndex.create(spark, f"{new_folder(spark, 'digests')}-{uuid.uuid4().hex}", 4)
    index.add(table(spark, [(1, "a", "b", "c")]), "1")
    assert other.entries().count() == 0 and index.entries().count() == 1

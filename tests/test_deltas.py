"""Small changes: what the filter lets through, which side moves, which files are rewritten, how ranges are balanced."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from chartmill.operators import documents, membership
from chartmill.operators.lookups import new_rows
from chartmill.plans import care, changes, reports
from chartmill.sources import readers, writers
from chartmill.sources.bucketed import BucketedStage


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def staged(spark):
    return spark.range(100_000).select((F.col("id") * 3).alias("k"), (F.col("id") % 7).alias("p"), F.lit("x").alias("v")).cache()


def test_filter_lets_little_through_and_loses_nothing(spark, staged):
    batch = spark.range(1000).select((F.col("id") * 151).alias("k"), (F.col("id") % 7).alias("p"))
    kept = membership.may_be_in(staged, batch, ["k"])
    assert kept.count() < 0.02 * staged.count()
    assert kept.join(batch, "k", "left_semi").count() == staged.join(batch, "k", "left_semi").count()
    assert membership.may_be_in(staged, batch.where("false"), ["k"]).count() == 0
    plan = membership.may_be_in(staged, batch, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan


def test_delta_equals_new_rows(spark, staged):
    batch = spark.createDataFrame([(k, p, f"w{n}") for n, (k, p) in enumerate([(3, 1), (3, 1), (4, None), (6, 2), (None, 5), (None, 5), (3, 9)])], "k long, p long, v string")
    for keys, nullable in ((["k"], ()), (["k", "p"], ("p",)), (["k", "p"], ("k", "p"))):
        some = staged.unionByName(spark.createDataFrame([(None, 5, "s"), (4, None, "s")], "k long, p long, v string"))
        assert rows(membership.new_rows_of_delta(batch, some, keys, ["v"], nullable)) == rows(new_rows(batch, some, keys, ["v"], nullable))


def test_a_large_batch_has_no_filter(staged, monkeypatch):
    monkeypatch.setattr(membership, "MOST_KEYS", 10)
    assert membership.may_be_in(staged, staged, ["k"]) is staged


def test_bucketed_rows_do_not_move(spark, staged, tmp_path):
    stage = BucketedStage.of(spark, f"{tmp_path}/b", staged.schema, ["k"], 4)
    for part in ("k < 200000", "true", "true"):
        stage.append(staged.where(part))
    assert rows(stage.rows()) == rows(staged)
    facts = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 3).when(F.col("id") % 50 != 1, F.col("id")).alias("visit"))
    found = stage.lookup(facts, {"visit": "k"}, {"p": "place"})
    assert rows(found) == rows(facts.join(staged.select(F.col("k").alias("visit"), F.col("p").alias("place")), "visit", "left").select("id", "visit", "place"))
    assert rows(stage.semi(facts, {"visit": "k"})) == rows(facts.join(staged.select(F.col("k").alias("visit")), "visit", "left_semi").select("id", "visit"))
    plan = stage.new_rows(staged.limit(100))._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in right and "Exchange" not in right[right.index("Bucketed: true") - 400:]
    with pytest.raises(ValueError):
        stage.lookup(facts, {"visit": "p"}, {})
    again = BucketedStage.of(spark, f"{tmp_path}/b", staged.schema, ["k"], 4)
    assert again.new_rows(staged).count() == 0


def test_untouched_ranges_keep_their_files(spark, tmp_path):
    target = spark.range(1000).select("id", F.lit("old").alias("v"))
    writers.write_ranges(target, f"{tmp_path}/t", "id", 100)
    files = lambda: {r: set(os.listdir(f"{tmp_path}/t/key_range={r}")) for r in range(-1, 13) if os.path.isdir(f"{tmp_path}/t/key_range={r}")}
    before = files()
    source = spark.createDataFrame([(105, "new"), (105, "newer"), (250, "new"), (1205, "new"), (-3, "new")], "id long, v string")
    for run in range(2):
        writers.upsert_ranges(f"{tmp_path}/t", target.schema, source, ["id"], "id", 100, f"{tmp_path}/s{run}")
        assert rows(spark.read.schema(target.schema).parquet(f"{tmp_path}/t").drop("key_range")) == rows(writers.upsert(target, source, ["id"]))
    after = files()
    assert {r for r in after if before.get(r) != after[r]} == {-1, 1, 2, 12}


def test_balanced_ranges(spark):
    rng = random.Random(2)
    keys = spark.createDataFrame([(int(rng.expovariate(0.001) ** 2), i) for i in range(20_000)] + [(None, -1), (-5, -2)], "k long, i long")
    ranges = readers.balanced_predicates(keys, "k", 16)
    counts = [keys.where(r).count() for r in ranges]
    assert sum(counts) == keys.count() and max(counts) <= 2 * keys.count() / 16 and len(ranges) == 16
    numbered = readers.read_in_ranges(keys.unionAll(spark.createDataFrame([(10**18, -3), (-10**18, -4)], keys.schema)), ranges)
    assert numbered.where("range_number is null").count() == 0 and numbered.count() == keys.count() + 2
    assert readers.balanced_predicates(keys.where("false"), "k", 8) == ["1 = 1"]
    hot = readers.balanced_predicates(spark.createDataFrame([(1, i) for i in range(100)], keys.schema), "k", 4)
    assert sum(keys.where(r).count() for r in hot) == keys.count()
    named = readers.balanced_predicates(spark.createDataFrame([("b",), ("a",), ("c",), ("d",)], "s string").select(F.length("s").alias("s")), "s", 2)
    assert len(named) >= 1


def test_rejected_lines(spark, tmp_path):
    names = "source_parent,source_label,source_concept_uuid,source_concept_id,concept_type,ciel,target_parent,target_label,target_concept_uuid,target_concept_id"
    good = ["a,b,c,1,e,f,g,h,i,j", ',,,,,,,,,', 'a,"b, c",c,2,e,f,g,h,i,j', 'a,"say ""x""",c,3,e,f,g,h,i,j']
    bad = ["a,b", "a,b,c,1,e,f,g,h,i,j,k,l", '"a,b,c,1,e,f,g,h,i,j']
    with open(f"{tmp_path}/d.csv", "w") as f:
        f.write("\n".join([names, *good[:2], bad[0], "", good[2], *bad[1:], good[3]]) + "\n")
    kept, rejected = readers.read_concept_dictionary_or_reject(spark, f"{tmp_path}/d.csv")
    assert sorted(str(r["source_concept_id"]) for r in kept.collect()) == ["1", "2", "3", "None"]
    assert {(r["line"], r["reason"]) for r in rejected.collect()} == {(bad[0], "too few fields"), (bad[1], "too many fields"), (bad[2], "open quote")}
    assert all(r["file"].endswith("d.csv") for r in rejected.collect())


def test_rejected_answers(spark):
    bodies = ['{"uuid":"u"}', "{}", '{"uuid":', "", None, "null", "[1]", "<html/>", '{"uuid":5}', '{"results":7}', ' {"uuid":"v"}']
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    good, bad = documents.read_responses_or_reject(df)
    assert {r["id"]: r["uuid"] for r in good.collect()} == {0: "u", 1: "UUID not found", 8: "5", 10: "v"}
    assert {r["id"]: r["reason"] for r in bad.collect()} == {2: "unreadable", 3: "no answer", 4: "no answer", 5: "not an object", 6: "not an object", 7: "not an object", 9: "unreadable"}
    assert good.count() + bad.count() == len(bodies)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_in_any_order_equal_a_full_run(spark, seed, tmp_path):
    """Observations and encounters come in random batches; after each, the staged rows are those of a full run."""
    rng = random.Random(seed)
    schema = "person_id long, encounter_id long, concept_id long, obs_datetime timestamp_ntz, value_numeric double, value_coded long, location_id long, voided int"
    obs = [(e // 4, e, rng.choice([1, 2, 3, 6]), None, float(rng.randrange(90)), rng.randrange(4), 1, int(rng.random() < 0.1)) for e in range(40) for _ in range(3)]
    encounters = [(e, None, e % 2, 0) for e in range(40)]
    rng.shuffle(obs)
    rng.shuffle(encounters)
    concept = spark.createDataFrame([(i, f"c{i}") for i in (1, 2, 3)], "concept_id long, uuid string")
    names = spark.createDataFrame([(i, f"drug {i}", "en", "FULLY_SPECIFIED") for i in range(4)], "concept_id long, name string, locale string, concept_name_type string")
    vitals = {"measures": {1: "height", 2: "weight"}, "concept_uuids": ["c1", "c2"]}
    drugs = {"drug_concept": 3, "change_concepts": [6]}

    def source(n):
        at = spark.createDataFrame(encounters[: n // 3 + 1], "encounter_id long, encounter_datetime timestamp_ntz, visit_id int, voided int")
        return {"obs": spark.createDataFrame(obs[:n], schema), "encounter": at, "concept": concept, "concept_name": names}

    triage, regimens, last = care.triage(source(30), **vitals), reports.regimens(source(30), **drugs), 30
    triage, regimens = (writers.write_snapshot(df, f"{tmp_path}/{name}") for df, name in ((triage, "t"), (regimens, "r")))
    for run, n in enumerate((31, 70, 70, len(obs))):
        src, new = source(n), spark.createDataFrame(obs[last:n], schema)
        since = spark.createDataFrame(encounters[last // 3 + 1 : n // 3 + 1], "encounter_id long, encounter_datetime timestamp_ntz, visit_id int, voided int")
        triage = changes.brought_up_to_date(triage, ["person_id", "encounter_id"], lambda: changes.triage_changes(src, new, since, **vitals), lambda df: writers.write_snapshot(df, f"{tmp_path}/t{run}"))
        regimens = changes.brought_up_to_date(regimens, ["person_id"], lambda: changes.regimen_changes(src, new, since, **drugs), lambda df: writers.write_snapshot(df, f"{tmp_path}/r{run}"))
        assert rows(triage) == rows(care.triage(src, **vitals))
        assert rows(regimens) == rows(reports.regimens(src, **drugs))
        last = n




def test_regimens_with_new_reasons_only(spark, tmp_path):
    """Persons without new drugs keep their staged rows but for the reasons; the outcome is that of a full run."""
    names = spark.createDataFrame([(c, "en", "FULLY_SPECIFIED", f"drug {c}") for c in (1, 2, 3, 4)], "concept_id long, locale string, concept_name_type string, name string")
    at = spark.createDataFrame([(e, datetime.datetime(2024, 1, e), 0) for e in (10, 11, 20, 30)], "encounter_id long, encounter_datetime timestamp_ntz, voided int")
    # Person 1 takes drugs at encounters 10 and 11, person 2 at 20, person 3 at 30; concept 5 is a drug, 6 a reason.
    batches = [
        [(1, 10, 5, 1, 0), (1, 11, 5, 2, 0), (2, 20, 5, 1, 0), (3, 30, 5, 3, 0), (3, 30, 6, 4, 0)],
        [(1, 11, 6, 3, 0), (1, 11, 6, 2, 0), (2, 20, 6, 4, 1), (None, 20, 6, 1, 0)],
        [(2, 20, 6, 2, 0), (1, 10, 5, 2, 0), (3, 30, 7, 1, 0)],
    ]
    schema, settings = "person_id long, encounter_id long, concept_id long, value_coded long, voided int", {"drug_concept": 5, "change_concepts": [6]}

    def source(rows):
        return {"obs": spark.createDataFrame(rows, schema), "encounter": at, "concept_name": names}

    def made(df):
        return sorted(map(tuple, df.collect()))

    known = batches[0]
    staged = writers.write_snapshot(reports.regimens(source(known), **settings), f"{tmp_path}/first")
    for run, batch in enumerate([batches[1], batches[1], batches[2]]):
        known = known if batch[0] in known else known + batch
        src, new = source(known), spark.createDataFrame(batch, schema)
        affected, rows = changes.regimen_changes(src, new, staged=staged, **settings)
        again = {r["person_id"] for r in affected.where("again").collect()}
        assert again == ({1} if batch is batches[2] else set())
        affected.unpersist()
        staged = changes.brought_up_to_date(
            staged, ["person_id"], lambda: changes.regimen_changes(src, new, staged=staged, **settings), lambda df: writers.write_snapshot(df, f"{tmp_path}/{run}"))
        assert made(staged.fillna("")) == made(reports.regimens(src, **settings).fillna(""))

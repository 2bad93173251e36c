import random

import pytest
from pyspark.sql import functions as F

from chartmill.operators import choose, lookups, numbering
from chartmill.plans import care


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows share one key; another third are copies of one row."""
    rng = random.Random(7)
    data = [(1, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.random()) for _ in range(400)]
    data += [(2, 5, "copy", 0.5)] * 400
    data += [(rng.randrange(3, 200), rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.random()) for _ in range(400)]
    return data, spark.createDataFrame(data, "k long, a int, b string, v double").repartition(7)


def null_first(value):
    return (value is not None, value if value is not None else 0)


def test_pick_one_against_brute_force(fact):
    data, df = fact
    best = {}
    for row in data:
        order = (null_first(row[2]) if row[2] is not None else (False, ""), null_first(row[1]), row[3])
        if row[0] not in best or order < best[row[0]][0]:
            best[row[0]] = (order, row)
    assert rows(choose.pick_one(df, ["k"], ["b"])) == sorted((r for _, r in best.values()), key=repr)


def test_pick_one_with_a_single_other_column(fact):
    data, df = fact
    best = {}
    for k, a, *_ in data:
        best[k] = min(best.get(k, a), a, key=null_first) if k in best else a
    assert rows(choose.pick_one(df.select("k", "a"), ["k"])) == sorted(best.items(), key=repr)
    assert rows(choose.pick_one(df.select("k"), ["k"])) == sorted(((k,) for k in best), key=repr)


def test_pick_one_reduces_before_the_shuffle(fact):
    plan = choose.pick_one(fact[1], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_latest_of_nothing_is_nothing(fact):
    _, df = fact
    assert choose.latest(df.where("false"), "k").count() == 0
    assert choose.latest(df, "k").first()["k"] == df.agg(F.max("k")).first()[0]


def test_pivot_keeps_the_largest_value(fact):
    data, df = fact
    wide = choose.pivot_measures(df, ["k"], "a", "v", {1: "one", 2: "two", 3: "three"})
    want = {}
    for k, a, _, v in data:
        if a in (1, 2, 3):
            want[k, a] = max(want.get((k, a), v), v)
    long = {(r["k"], code): r[name] for r in wide.collect() for code, name in ((1, "one"), (2, "two"), (3, "three")) if r[name] is not None}
    assert long == want
    assert wide.count() == len({k for k, *_ in data})


def test_join_names_keeps_equal_names_of_two_codes(spark):
    df = spark.createDataFrame([(1, 10, "b"), (1, 11, "a"), (1, 12, "a"), (1, 10, "b"), (2, 9, "z")], "k int, c int, n string")
    assert rows(choose.join_names(df, ["k"], "c", "n", "t")) == [(1, "a,a,b"), (2, "z")]
    assert rows(choose.join_distinct(df, ["k"], "n", "t")) == [(1, "a,b"), (2, "z")]


def test_first_by_name_sorts_without_case(spark):
    df = spark.createDataFrame([("beta", 2), ("Alpha", 1), ("beta", 1), (None, 0), ("alpha", 3)], "name string, id int")
    assert [tuple(r) for r in choose.first_by_name(df, "name", ["id"]).collect()] == [("Alpha", 1), ("alpha", 3), ("beta", 1)]


def test_new_rows_sees_its_own_batch(spark):
    batch = spark.createDataFrame([(1, "x"), (1, "a"), (2, "b"), (3, "c"), (3, "c")], "k int, v string")
    staged = spark.createDataFrame([(2,)], "k int")
    assert rows(lookups.new_rows(batch, staged, ["k"])) == [(1, "a"), (3, "c")]


def test_null_keys_match_only_where_asked(spark):
    batch = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert rows(lookups.anti_staged(batch, batch, ["a", "b"])) == [(1, None)]
    assert rows(lookups.anti_staged(batch, batch, ["a", "b"], nullable=["b"])) == []


def test_lookup_first_takes_the_lowest_and_keeps_the_rest(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, p int")
    entity = spark.createDataFrame([(10, 2, "late"), (10, 1, "early"), (30, 1, "other")], "person int, id int, uuid string")
    got = lookups.lookup_first(fact, entity, {"p": "person"}, {"uuid": "u"}, ["id"])
    assert got.columns == ["id", "p", "u"]
    assert rows(got) == [(1, 10, "early"), (2, 20, None), (3, None, None)]
    assert rows(lookups.lookup_first(fact, entity, {"p": "person"}, {"uuid": "u"}, ["id"], how="inner")) == [(1, 10, "early")]


def test_star_join_drops_the_dimension_keys(spark):
    fact = spark.createDataFrame([(1, 7), (2, 8), (3, 9)], "id int, k int")
    dim = spark.createDataFrame([(7, "a"), (8, "b")], "k int, name string")
    assert rows(lookups.star_join(fact, (dim, {"k": "k"}))) == [(1, 7, "a"), (2, 8, "b")]
    assert rows(lookups.star_join(fact, (dim, {"k": "k"}), how="left"))[2] == (3, 9, None)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_dimension_beyond_the_limit_is_shuffled(spark):
    fact, dim = spark.range(1000), spark.range(100).select("id", F.lit("x").alias("x")).groupBy("id").agg(F.max("x").alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = fact.join(lookups.dimension(dim), "id"), fact.join(lookups.dimension(dim, max_rows=99), "id")
        assert "BroadcastHashJoin" in plan_of(small) and "SortMergeJoin" in plan_of(large)
        assert small.count() == large.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def tiny_thresholds(spark):
    """Adaptive execution takes partitions of some kilobytes for large ones, and broadcasts nothing by itself."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_lookup_key_is_split_at_run_time(spark, tiny_thresholds):
    """A third of the rows look up one key; adaptive execution must be able to split their partition."""
    n = 60_000
    hot = F.when(F.col("id") < n // 3, 1).otherwise(F.col("id"))
    fact = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("x"), hot.alias("p")).repartition(16)
    entity = spark.range(n).select(F.col("id").alias("person"), F.col("id").cast("string").alias("uuid")).repartition(5)

    def split(found):
        right = (F.col("u") == F.col("p").cast("string")) if "u" in found.columns else F.lit(True)
        got = found.agg(F.count(F.lit(1)), F.max(F.length("x")), F.sum(right.cast("int")))
        assert [tuple(r) for r in got.collect()] == [(n, 32, n)]
        return "skew=true" in plan_of(got)

    assert split(lookups.lookup_first(fact, entity, {"p": "person"}, {"uuid": "u"}))
    assert split(lookups.lookup_first(fact, entity, {"p": "person"}, {"uuid": "u"}, unique=True))
    assert split(lookups.semi_on(fact, entity.unionByName(entity), {"p": "person"}, repeated=True))
    # The straight way, a grouped side joined on its own keys, cannot be split.
    grouped = choose.pick_one(entity, ["person"]).withColumnRenamed("uuid", "u")
    assert not split(fact.join(grouped, F.col("p") == F.col("person"), "left"))


def test_a_hot_patient_is_split_in_the_encounter_job(spark, tiny_thresholds):
    n = 60_000
    hot = F.when(F.col("id") < n // 3, 1).otherwise(F.col("id"))
    encounter = spark.range(n).select(
        F.col("id").alias("encounter_id"), hot.alias("patient_id"), F.lit(14).alias("encounter_type"), F.lit(1).cast("long").alias("location_id"),
        F.lit(0).alias("voided"), F.xxhash64("id").alias("visit_id"), F.lit("2020-01-01").cast("timestamp_ntz").alias("encounter_datetime"),
    ).repartition(16)
    src = {
        "encounter": encounter, "encounter_type": spark.createDataFrame([(14, "T")], "encounter_type_id int, name string"),
        "location": spark.createDataFrame([(1, "L")], "location_id long, uuid string")}
    patients = spark.range(n).select(F.col("id").alias("person_id")).repartition(5)
    staged = encounter.where("encounter_id < 100").select("patient_id", "encounter_id")
    got = care.encounters(src, patients, ["L"], staged, look_back=None).agg(F.count(F.lit(1)), F.countDistinct("encounter_id"), F.min("target_type_id"))
    assert [tuple(r) for r in got.collect()] == [(n - 100, n - 100, 21)]
    assert "skew=true" in plan_of(got)


def test_dense_positions_are_one_to_n(spark):
    df = spark.range(0, 90_000, 17).select((F.col("id") * 1000).alias("k")).repartition(5)
    n = df.count()
    got = numbering.dense_position(df, "k")
    assert [r[0] for r in got.select("position").orderBy("position").collect()] == list(range(1, n + 1))
    # The number depends on the keys alone, not on how they are spread over partitions.
    again = numbering.dense_position(df.repartition(11), "k")
    assert got.exceptAll(again).count() == 0


def test_a_pool_gives_every_row_its_own_identifier(spark):
    people, pool = spark.range(500).withColumnRenamed("id", "p"), spark.range(1000, 1300).withColumnRenamed("id", "i")
    got = numbering.allocate(people, "p", pool, "i").collect()
    given = [r["i"] for r in got if r["i"] is not None]
    assert len(got) == 500 and sorted(given) == list(range(1000, 1300))

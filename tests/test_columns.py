import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartmill.functions import columns as c
from chartmill.functions import dictionaries, fixed_values as fixed


def values(df):
    return [row[0] for row in df.collect()]


def test_flag_text_keeps_missing_flags_missing(spark):
    df = spark.createDataFrame([(0, "0"), (1, "1"), (2, None), (3, "7")], "id int, flag string")
    assert values(df.orderBy("id").select(c.flag_text("flag"))) == ["false", "true", None, "true"]


def test_truthy_drops_null_and_zero(spark):
    df = spark.createDataFrame([(None,), (0,), (5,), (-1,)], "reason int")
    assert sorted(values(df.where(c.truthy("reason")))) == [-1, 5]


def test_first_text_prefers_the_coded_value(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (0, 7, TIMESTAMP_NTZ'2020-01-02 03:04:05', 1.5D, 'x'), (1, NULL, TIMESTAMP_NTZ'2020-01-02 03:04:05', 1.5D, 'x'),
        (2, NULL, NULL, 1.5D, 'x'), (3, NULL, NULL, NULL, 'x'), (4, NULL, NULL, NULL, NULL) AS t(id, a, b, c, d)""")
    got = values(df.orderBy("id").select(c.first_text("a", "b", "c", "d")))
    assert got == ["7", "2020-01-02 03:04:05", "1.5", "x", None]


def test_strip_only_for_the_one_type(spark):
    df = spark.createDataFrame([(0, "a-b-c", "T"), (1, "a-b-c", "U"), (2, "a-b-c", None), (3, None, "T")],
                               "id int, v string, kind string")
    assert values(df.orderBy("id").select(c.strip_for_type("v", "kind", "T"))) == ["abc", "a-b-c", "a-b-c", None]


def test_raw_or_code(spark):
    df = spark.createDataFrame([(1, "v", "k"), (2, "v", "k"), (3, "v", "k"), (3, "v", None)], "t int, v string, k string")
    assert values(df.select(c.raw_or_code("t", "v", "k"))) == ["v", "v", "k", None]


def test_natural_uuid_tells_keys_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("ab", "c"), ("a", "bc")], "x string, y string")
    ids = values(df.select(c.natural_uuid("x", "y")))
    assert len(set(ids)) == 5 and all(len(i) == 36 for i in ids)
    assert ids == values(df.select(c.natural_uuid("x", "y")))


def test_random_uuid(spark):
    ids = values(spark.range(50).select(c.random_uuid()))
    assert len(set(ids)) == 50 and all(len(i) == 36 for i in ids)


def test_whole_numbers(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "n string")
    with pytest.raises(PySparkException):
        df.select(c.whole_number("n")).collect()
    good, bad = c.split_whole_numbers(df, ["n"])
    assert sorted(values(good), key=str) == [12, None] and good.dtypes == [("n", "int")]
    assert values(bad) == ["x"]


def test_patient_type_ladder(spark):
    df = spark.createDataFrame([(0, 15, 10194), (1, 16, 10194), (2, 16, 2051), (3, None, 2051), (4, None, 10194)],
                               "id int, form int, concept int").orderBy("id")
    assert values(df.select(c.patient_type("form", "concept"))) == [164144, 164931, 164931, None, None]
    assert values(df.select(c.patient_type("form", "concept", transfer_in=True))) == [164144, 160563, 164931, None, 160563]


def test_entry_point_falls_through(spark):
    df = spark.createDataFrame([(0, 2051, 2047), (1, 2051, 99), (2, 7013, 2047), (3, 2051, None)],
                               "id int, concept int, coded int").orderBy("id")
    assert values(df.select(c.entry_point("concept", "coded"))) == [160539, 99, 2047, None]


def test_first_pair_of_a_key_wins():
    pairs = [(14, "a"), (14, "b"), (115, "c"), (115, "d"), (115, "e"), (1, "f")]
    assert dictionaries.first_wins(pairs) == [(14, "a"), (115, "c"), (1, "f")]
    assert dictionaries.dead_arms(pairs) == [(14, "b"), (115, "d"), (115, "e")]


def test_encounter_types(spark):
    rows = {r[0]: r for r in dictionaries.encounter_type_rows()}
    assert len(rows) == 130 and len({r[2] for r in rows.values()}) == 42
    assert rows[110][1] == 6 and rows[115][1] == 11 and rows[263][1] == 38
    assert rows[247][1] is None and rows[247][2].startswith("e24209cc")
    assert dictionaries.disagreeing_types() == [153, 247]
    assert dictionaries.encounter_types(spark).count() == 130


def test_small_dictionaries(spark):
    assert len(dictionaries.identifier_type_rows()) == 8
    assert len(dictionaries.program_rows()) == 20 and len({r[1] for r in dictionaries.program_rows()}) == 10
    assert dictionaries.untrimmed_keys(fixed.PROGRAMS) == [" 7843bd0e-2309-44dd-963b-1380789c372c"]
    df = spark.createDataFrame([("58a47054-1359-11df-a1f1-0026b9348838",), ("none",), (None,)], "u string")
    mapped = dictionaries.map_codes(df, dictionaries.programs(spark), "u", "program_uuid", default="")
    assert {r["u"]: r["target_program_uuid"] for r in mapped.collect()} == {
        "58a47054-1359-11df-a1f1-0026b9348838": "dfdc6d40-2f2f-463d-ba90-cc97350441a8", "none": "", None: ""}


def test_unmapped_type_is_null(spark):
    df = spark.createDataFrame([(12,), (None,), (247,)], "t int")
    mapped = dictionaries.map_codes(df, dictionaries.encounter_types(spark), "t", "encounter_type_id")
    got = {r["t"]: (r["target_type_id"], r["target_type_uuid"]) for r in mapped.collect()}
    assert got[12] == (None, None) and got[None] == (None, None) and got[247][0] is None and got[247][1]


def test_dictionary_join_is_a_broadcast(spark):
    mapped = dictionaries.map_codes(spark.range(100).select(F.col("id").cast("int").alias("t")),
                                    dictionaries.encounter_types(spark), "t", "encounter_type_id")
    assert "BroadcastHashJoin" in mapped._jdf.queryExecution().executedPlan().toString()

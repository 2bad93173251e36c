import json

import pytest
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed
from chartmill.operators import documents


def docs(df, key):
    return {r[key]: json.loads(r["document"]) for r in df.collect()}


@pytest.fixture(scope="module")
def people(spark):
    return spark.sql("""SELECT * FROM VALUES
        (1, 'U1', 'F', DATE'1980-02-03', 0, 1, 'Ann', 'Bee', CAST(NULL AS STRING), 'Road 1', 'Town', 'G1'),
        (2, 'U2', 'M', CAST(NULL AS DATE), 1, 0, 'Cy', 'Dee', 'Eff', CAST(NULL AS STRING), CAST(NULL AS STRING), 'G2')
        AS t(person_id, username, gender, birthdate, birthdate_estimated, dead, given_name, family_name, middle_name,
             address1, address4, generated_identifier)""")


def test_patient_document(spark, people):
    got = docs(documents.patient_documents(people), "person_id")
    assert got[1]["identifiers"] == [{"identifier": "G1", "identifierType": fixed.GENERATED_IDENTIFIER_TYPE,
                                      "location": fixed.DOCUMENT_LOCATION, "preferred": "true"}]
    assert got[1]["person"] == {
        "gender": "F", "birthdate": "1980-02-03", "birthdateEstimated": "false", "dead": "true",
        "names": [{"givenName": "Ann", "familyName": "Bee"}],
        "addresses": [{"address1": "Road 1", "address2": "Road 1", "address3": "Town", "address4": "Town"}]}
    assert [i["identifier"] for i in got[2]["identifiers"]] == ["G2"]
    assert "birthdate" not in got[2]["person"] and got[2]["person"]["names"][0]["middleName"] == "Eff"


def test_identifier_documents_of_a_hot_patient(spark):
    """One document per mapped identifier, however many a patient has, without a shuffle."""
    many = spark.range(3000).select(F.lit(1).alias("patient_id"), F.concat(F.lit("I"), F.col("id").cast("string")).alias("identifier"),
                                    F.lit("T").alias("target_type_uuid"))
    few = spark.createDataFrame([(1, "B-2", ""), (1, "C-3", None), (2, "X", "T2")], "patient_id int, identifier string, target_type_uuid string")
    out = documents.identifier_documents(many.unionByName(few))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert sorted((r["person_id"], r["identifier"]) for r in rows) == sorted([(1, f"I{n}") for n in range(3000)] + [(2, "X")])
    assert json.loads(next(r for r in rows if r["person_id"] == 2)["document"]) == {
        "identifier": "X", "identifierType": "T2", "location": fixed.DOCUMENT_LOCATION, "preferred": "false"}


def test_user_document_has_a_role_and_no_password(people):
    got = docs(documents.user_documents(people.withColumnRenamed("person_id", "user_id")), "user_id")
    assert got[1]["roles"] == [fixed.USER_ROLE] and "password" not in json.dumps(got).lower()
    assert got[1]["person"]["addresses"] == [{"address1": "Road 1", "address2": "Town", "address3": "Town", "address4": "Town"}]


def test_open_ended_programs_carry_no_completion_date(spark):
    df = spark.createDataFrame([(i, i, i) for i in (1, 2, 3, 9, 20, 21)], "patient_program_id int, patient_id int, program_id int")
    df = df.withColumns({"target_patient_uuid": F.lit("P"), "target_program_uuid": F.lit("Q"),
                         "date_enrolled": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"),
                         "date_completed": F.lit("2021-01-01 10:20:30").cast("timestamp_ntz")})
    got = docs(documents.program_documents(df), "patient_program_id")
    assert {k for k, d in got.items() if "dateCompleted" in d} == {2, 21}
    assert got[2] == {"patient": "P", "program": "Q", "dateEnrolled": "2020-01-01 00:00:00", "dateCompleted": "2021-01-01 10:20:30"}


def test_encounter_without_visit(spark):
    df = spark.createDataFrame([(1, None, "V1"), (2, 5, "V2"), (3, 6, None)], "encounter_id int, visit_id int, target_visit_uuid string")
    df = df.withColumns({"target_patient_uuid": F.lit("P"), "target_type_uuid": F.lit("T"),
                         "encounter_datetime": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")})
    got = docs(documents.encounter_documents(df), "encounter_id")
    assert "visit" not in got[1] and got[2]["visit"] == "V2" and "visit" not in got[3]


def test_bundle_renders_every_observation_with_one_shuffle(spark):
    encounters = spark.sql("""SELECT encounter_id, 'P' AS target_patient_uuid, 'D' AS provider_uuid,
        TIMESTAMP_NTZ'2020-01-01 00:00:00' AS encounter_datetime FROM VALUES (1), (2) AS t(encounter_id)""")
    obs = spark.range(30).select(F.lit(1).alias("encounter_id"), (F.col("id") % 3).alias("concept_id"), F.lit("P").alias("person_uuid"),
                                 F.col("id").cast("double").alias("value"))
    out = documents.encounter_bundles(encounters, obs)
    got = docs(out, "encounter_id")
    assert [(o["concept"], o["value"]) for o in got[1]["obs"]] == [(str(c), float(v)) for c in range(3) for v in range(c, 30, 3)]
    assert got[2]["obs"] == [] and got[2]["encounterProviders"][0]["provider"] == "D" and got[2]["visit"]["patient"] == "P"


def test_order_field_names_can_be_given(spark):
    df = spark.createDataFrame([(1, "P", None, "N", 2, "R", "7", None, "U")], """order_id int, target_patient_uuid string,
        target_order_uuid string, order_number string, order_type_id int, urgency string, orderer string, order_reason string, uuid string""")
    got = docs(documents.order_documents(df, "orderId", "origin"), "order_id")[1]
    assert got == {"patient": "P", "orderNumber": "N", "orderType": 2, "urgency": "R", "orderer": "7", "origin": "U", "careSettings": "OUTPATIENT"}


def test_answers(spark):
    df = spark.createDataFrame([(1, '{"uuid": "a", "person": {"uuid": "b"}, "results": [{"identifierValue": "c"}]}'), (2, "{}"),
                                (3, '{"results": []}'), (4, "not json")], "id int, body string")
    got = {r["id"]: (r["uuid"], r["person_uuid"], r["identifier_value"]) for r in documents.read_responses(df).collect()}
    none = ("UUID not found", None, None)
    assert got == {1: ("a", "b", "c"), 2: none, 3: none, 4: none}

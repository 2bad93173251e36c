"""The jobs on small clinical tables with the awkward cases in them."""

import datetime

import pytest
from pyspark.sql import functions as F

from chartmill.plans import care, reference_data, registration, reports
from chartmill.schemas import SOURCE_DDL, STAGED_DDL, source_schema, staged_schema

DAY = datetime.datetime(2020, 1, 1)


def table(spark, name, rows):
    """Rows given as dicts; missing columns are null."""
    schema = source_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def staged(spark, name, rows=()):
    schema = staged_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


@pytest.fixture(scope="module")
def src(spark):
    def t(name, *rows):
        return table(spark, name, rows)

    def enc(i, patient, kind, place, **more):
        return {"encounter_id": i, "patient_id": patient, "encounter_type": kind, "location_id": place, "voided": 0, "creator": 70,
                "encounter_datetime": DAY + datetime.timedelta(days=i), **more}

    def obs(encounter, concept, person=1, **more):
        return {"encounter_id": encounter, "concept_id": concept, "person_id": person, "voided": 0, "location_id": 1, "obs_datetime": DAY, **more}

    people = [{"person_id": i, "uuid": f"p{i}", "gender": "F", "dead": 0, "birthdate_estimated": 0, "voided": 0} for i in (1, 2, 3, 7)]
    return {
        "location": t("location", {"location_id": 1, "uuid": "L1", "name": "One"}, {"location_id": 2, "uuid": "L2", "name": "Two"},
                      {"location_id": 3, "uuid": "L3", "name": "Three", "parent_location": 1}),
        "encounter_type": t("encounter_type", *[{"encounter_type_id": k, "name": f"T{k}"} for k in (1, 3, 14, 32, 247, 12)]),
        "encounter": t("encounter", enc(10, 1, 14, 1, visit_id=100), enc(11, 1, 247, 2, visit_id=100, form_id=15), enc(12, 2, 12, 1),
                       enc(13, 3, 14, 1), enc(14, 1, 1, 1, voided=1), enc(15, 1, 1, 3), enc(16, 1, 1, 1, visit_id=101, form_id=15),
                       enc(17, 1, 3, 1, form_id=16, creator=71), enc(18, 1, 99, 1)),
        "patient": t("patient", {"patient_id": 1}, {"patient_id": 2}, {"patient_id": 3}),
        "person": t("person", *people),
        "person_name": t("person_name", *[{"person_id": i, "given_name": f"{g}{i}", "family_name": "F"} for i in (1, 2, 3, 7) for g in "ba"]),
        "person_address": t("person_address", *[{"person_id": i, "address1": f"S{n}"} for i in (1, 2, 3, 7) for n in (2, 1)]),
        "users": t("users", {"user_id": 70, "person_id": 7, "uuid": "u70", "username": "x"}, {"user_id": 71, "person_id": 7, "uuid": "u71"},
                   {"user_id": 72, "person_id": 7, "uuid": "u72"}),
        "patient_identifier": t("patient_identifier",
                                {"patient_id": 1, "identifier": "1-2-3", "identifier_type": 1, "preferred": 1, "voided": 0},
                                {"patient_id": 1, "identifier": "1-2-3", "identifier_type": 2, "preferred": 0, "voided": 0},
                                {"patient_id": 1, "identifier": "1-2-3", "identifier_type": 2, "preferred": 0, "voided": 0},
                                {"patient_id": 1, "identifier": "9", "identifier_type": 3, "preferred": 0, "voided": 0},
                                {"patient_id": 1, "identifier": "8", "identifier_type": 2, "preferred": 0, "voided": 1},
                                {"patient_id": 9, "identifier": "7", "identifier_type": 2, "preferred": 0, "voided": 0}),
        "patient_identifier_type": t("patient_identifier_type",
                                     {"patient_identifier_type_id": 1, "uuid": "f2d6ff1a-8440-4d35-a150-1d4b5a930c5e"},
                                     {"patient_identifier_type_id": 2, "uuid": "58a4732e-1359-11df-a1f1-0026b9348838"},
                                     {"patient_identifier_type_id": 3, "uuid": "nobody"}),
        "program": t("program", {"program_id": 1, "uuid": "781d85b0-1359-11df-a1f1-0026b9348838", "name": "A", "concept_id": 5},
                     {"program_id": 2, "uuid": "other", "name": "B", "concept_id": 5}, {"program_id": 3, "uuid": "x", "name": "C", "concept_id": 6}),
        "patient_program": t("patient_program", *[
            {"patient_program_id": i, "patient_id": p, "program_id": g, "location_id": 9, "date_enrolled": DAY}
            for i, p, g in ((1, 1, 2), (2, 1, 1), (3, 1, 3), (4, 2, 1), (5, 3, 1), (6, 1, 3))]),
        "visit": t("visit", {"visit_id": 100, "visit_type_id": 1, "voided": 0, "date_started": DAY}, {"visit_id": 101, "voided": 0},
                   {"visit_id": 102, "voided": 0}, {"visit_id": 103, "voided": 1}),
        "orders": t("orders", *[{"order_id": i, "uuid": f"o{i}", "patient_id": p, "encounter_id": e, "order_reason": why, "concept_id": 8,
                                 "date_created": DAY - datetime.timedelta(days=i), "orderer": 70}
                                for i, p, e, why in ((1, 1, 10, 55), (2, 9, 11, 56), (3, 1, 10, 0), (4, 1, 10, None), (1, 1, 10, 55), (9, 1, 999, 55))]),
        "concept": t("concept", {"concept_id": 5089, "uuid": "a8a660ca-1350-11df-a1f1-0026b9348838", "datatype_id": 1},
                     {"concept_id": 5090, "uuid": "a8a6619c-1350-11df-a1f1-0026b9348838", "datatype_id": 1},
                     {"concept_id": 1724, "uuid": "c", "datatype_id": 3}, {"concept_id": 966, "uuid": "d", "datatype_id": 4},
                     {"concept_id": 1342, "uuid": "not a vital", "datatype_id": 1}),
        "concept_datatype": t("concept_datatype", {"concept_datatype_id": 1, "name": "Numeric"}, {"concept_datatype_id": 3, "name": "Coded"},
                              {"concept_datatype_id": 4, "name": "N/A"}),
        "concept_name": t("concept_name", *[
            {"concept_id": i, "name": n, "locale": lang, "locale_preferred": 1, "concept_name_type": "FULLY_SPECIFIED"}
            for i, n, lang in ((1724, "Zed", "en"), (1724, "Alef", "fr"), (5089, "Weight", "en"), (5090, "Height", "en"), (966, "N", "en"),
                               (31, "3TC", "en"), (32, "AZT", "en"), (33, "Failure", "en"), (8, "Lab", "en"))]),
        "obs": t("obs",
                 obs(10, 5089, value_numeric=60.0), obs(10, 5089, value_numeric=61.0), obs(10, 5090, value_numeric=170.0),
                 obs(10, 1342, value_numeric=20.0), obs(11, 5089, value_numeric=62.0, location_id=2),
                 obs(16, 1724, value_coded=55), obs(16, 1724, value_coded=55), obs(17, 1724, value_text="t"), obs(17, 5090, value_numeric=1.5),
                 obs(16, 966, value_coded=1), obs(14, 1724, value_coded=55),
                 obs(16, 2051, value_coded=2047), obs(17, 7013, value_datetime=DAY),
                 obs(10, 1088, value_coded=32), obs(10, 1088, value_coded=31), obs(16, 1088, value_coded=31), obs(16, 1088, value_coded=33),
                 obs(14, 1088, value_coded=33), obs(16, 1252, value_coded=33), obs(16, 1088, value_coded=31, voided=1)),
        "form": t("form", {"form_id": 15}, {"form_id": 16}),
    }


@pytest.fixture(scope="module")
def patients(spark):
    return spark.createDataFrame([(1, "TP1"), (2, None)], "person_id long, target_patient_uuid string")


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame([("55", "D55"), ("1724", "D1724"), ("5090", "D5090")], "source_concept_id string, target_concept_uuid string")


def nobody(spark):
    return spark.createDataFrame([], "person_id long, target_patient_uuid string")


def test_schemas_parse():
    assert all(source_schema(n).names for n in SOURCE_DDL) and all(staged_schema(n).names for n in STAGED_DDL)


def same_schema(df, name):
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in staged_schema(name)]


def test_users(spark, src):
    got = registration.users(src, ["L1"], "X")
    same_schema(got, "users")
    assert {u: (r["given_name"], r["address1"]) for u, r in by(got, "user_id").items()} == {70: ("a7", "S1"), 71: ("a7", "S1")}
    loaded = staged(spark, "users", [{"uuid": "u70", "user_id": 70, "parent_location_uuid": "X"}])
    assert set(by(registration.users(src, ["L1"], "X", loaded), "user_id")) == {71}
    assert set(by(registration.users(src, ["L1"], "Y", loaded), "user_id")) == {70, 71}
    # An account with a smaller id that comes later is found unless a cursor is asked for.
    later = staged(spark, "users", [{"uuid": "u71", "user_id": 71, "parent_location_uuid": "X"}])
    assert set(by(registration.users(src, ["L1"], "X", later), "user_id")) == {70}
    assert registration.users(src, ["L1"], "X", later, cursor=True).count() == 0


def test_patients_from_the_newest_down(spark, src):
    got = registration.patients(src, ["L1", "L2"], "X")
    same_schema(got, "patients")
    assert {p: (r["location_id"], r["location_name"], r["given_name"]) for p, r in by(got, "person_id").items()} == {
        1: (1, "One", "a1"), 2: (1, "One", "a2"), 3: (1, "One", "a3")}
    first = got.where("person_id = 3")
    assert set(by(registration.patients(src, ["L1"], "X", first), "person_id")) == {1, 2}
    assert set(by(registration.patients(src, ["L1"], "X", got.where("person_id = 1")), "person_id")) == {2, 3}
    assert registration.patients(src, ["L1"], "X", got.where("person_id = 1"), cursor=True).count() == 0
    assert set(by(registration.patients(src, ["L1"], "X", staged(spark, "patients")), "person_id")) == {1, 2, 3}


def test_identifiers(spark, src, patients):
    got = registration.identifiers(src, patients, "X")
    assert {(r["type_uuid"][:4], r["identifier"], r["preferred"], r["target_type_uuid"][:4]) for r in got.collect()} == {
        ("f2d6", "123", "true", "05ee"), ("58a4", "1-2-3", "false", "b4d6"), ("nobo", "9", "false", "")}
    same_schema(got, "identifiers")
    assert registration.identifiers(src, patients, "X", got).count() == 0


def test_programs(spark, src, patients):
    got = care.programs(src, patients, ["L1", "L2"], "X")
    same_schema(got, "programs")
    rows = by(got, "patient_id", "program_id")
    assert {k: (r["patient_program_id"], r["target_patient_uuid"], r["location_uuid"]) for k, r in rows.items()} == {
        (1, 2): (1, "TP1", "L1"), (1, 3): (3, "TP1", "L1"), (2, 1): (4, None, "L1")}
    assert rows[2, 1]["target_program_uuid"].startswith("dfdc6d40") and rows[1, 2]["target_program_uuid"] == ""
    loaded = staged(spark, "programs", [{"patient_id": 1, "program_id": 3, "patient_program_id": 3}])
    assert set(by(care.programs(src, patients, ["L1"], "X", loaded), "patient_id", "program_id")) == {(1, 2), (2, 1)}
    assert set(by(care.programs(src, patients, ["L1"], "X", loaded, look_back=0), "patient_id", "program_id")) == {(2, 1)}
    assert care.programs(src, nobody(spark), ["L1"], "X").count() == 0


def test_encounters(spark, src, patients):
    got = care.encounters(src, patients, ["L1", "L2"])
    assert set(got.columns) == set(staged_schema("encounters").names)
    rows = by(got, "encounter_id")
    assert {k: r["target_type_id"] for k, r in rows.items()} == {10: 21, 11: None, 12: None, 16: 7, 17: 7}
    assert rows[11]["target_type_uuid"].startswith("e24209cc") and rows[12]["target_type_uuid"] is None
    part = got.where("encounter_id IN (10, 16)")
    assert set(by(care.encounters(src, patients, ["L1", "L2"], part, look_back=0), "encounter_id")) == {17}
    assert set(by(care.encounters(src, patients, ["L1", "L2"], part, look_back=5), "encounter_id")) == {12, 17}
    assert set(by(care.encounters(src, patients, ["L1", "L2"], part), "encounter_id")) == {11, 12, 17}
    assert care.encounters(src, patients, ["L1", "L2"], got, look_back=None).count() == 0
    assert care.encounters(src, nobody(spark), ["L1"]).count() == 0


def test_visits(spark, src, patients):
    got = care.visits(src, patients, ["L1", "L2"])
    same_schema(got, "visits")
    assert {k: (r["patient_id"], r["location_id"], r["target_patient_uuid"]) for k, r in by(got, "visit_id").items()} == {
        100: (1, 1, "TP1"), 101: (1, 1, "TP1")}
    assert set(by(care.visits(src, patients, ["L1", "L2"], got.where("visit_id = 100")), "visit_id")) == {101}
    assert care.visits(src, patients, ["L1", "L2"], got.where("visit_id = 101"), look_back=0).count() == 0
    assert set(by(care.visits(src, patients, ["L1", "L2"], got.where("visit_id = 101")), "visit_id")) == {100}


def test_orders(spark, src, patients, dictionary):
    got = care.orders(src, patients, dictionary)
    same_schema(got, "orders")
    rows = by(got, "uuid")
    assert set(rows) == {"o1", "o2"}
    assert (rows["o1"]["target_patient_uuid"], rows["o1"]["target_reason_uuid"], rows["o1"]["target_type_uuid"][:4]) == ("TP1", "D55", "e87a")
    assert (rows["o2"]["target_patient_uuid"], rows["o2"]["target_reason_uuid"]) == ("Not Found", "")
    assert set(by(care.orders(src, patients, dictionary, got.where("uuid = 'o2'")), "uuid")) == {"o1"}
    assert care.orders(src, patients, dictionary, got).count() == 0


def test_triage(spark, src):
    got = care.triage(src, [1, 2])
    same_schema(got, "triage")
    rows = by(got, "encounter_id")
    assert {k: (r["weight"], r["height"], r["bmi"]) for k, r in rows.items()} == {10: (61.0, 170.0, None), 11: (62.0, None, None), 17: (None, 1.5, None)}
    assert set(by(care.triage(src, [1]), "encounter_id")) == {10, 17}
    assert care.triage(src, [1, 2], person_id=9).count() == 0
    assert set(by(care.triage(src, [1, 2], got.where("encounter_id = 10")), "encounter_id")) == {11, 17}
    assert care.triage(src, [1, 2], got, look_back=None).count() == 0


def test_hiv_enrollment(spark, src, dictionary):
    got = care.hiv_enrollment(src, dictionary, [1])
    same_schema(got, "hiv_enrollment")
    rows = by(got, "encounter_id", "concept_id")
    assert {k: (r["concept_name"], r["value"], r["target_concept_uuid"], r["target_value"]) for k, r in rows.items()} == {
        (16, 1724): ("Alef", "55", "D1724", "D55"), (17, 1724): ("Alef", "t", "D1724", None), (17, 5090): ("Height", "1.5", "D5090", "1.5")}
    assert set(by(care.hiv_enrollment(src, dictionary, [1], got.where("encounter_id = 16")), "encounter_id")) == {17}
    assert care.hiv_enrollment(src, dictionary, [1], got, look_back=None).count() == 0


def test_enrollment_summary(spark):
    flat = table(spark, "flat_summary", [
        {"person_id": 1, "encounter_id": 2, "is_clinical_encounter": 1, "location_id": 2},
        {"person_id": 1, "encounter_id": 1, "is_clinical_encounter": 1, "location_id": 2},
        {"person_id": 2, "encounter_id": 3, "is_clinical_encounter": 0, "location_id": 2},
        {"person_id": 3, "encounter_id": 4, "is_clinical_encounter": 1, "location_id": 2, "next_clinical_datetime_hiv": DAY},
        {"person_id": 4, "encounter_id": 5, "is_clinical_encounter": 1, "location_id": 7}])
    got = care.enrollment_summary({"flat_summary": flat}, [2, 98])
    same_schema(got, "enrollments")
    assert {p: r["encounter_id"] for p, r in by(got, "person_id").items()} == {1: 1}
    assert care.enrollment_summary({"flat_summary": flat}, [2, 98], got).count() == 0


def test_regimens(src):
    rows = by(reports.regimens(src), "encounter_id")
    assert {k: (r["person_id"], r["regimen"], r["reason_for_change"]) for k, r in rows.items()} == {
        10: (1, "3TC,AZT", None), 16: (1, "Failure", "Failure")}
    assert reports.regimens(src, location_ids=[5]).count() == 0 and reports.regimens(src, person_id=1).count() == 2


def test_patient_types(src):
    rows = by(reports.patient_types(src, [1]), "encounter_id")
    assert {k: (r["patient_type"], r["entry_point"], r["first_care_date"]) for k, r in rows.items()} == {
        16: (164144, 160539, None), 17: (164931, None, DAY)}


def test_extracts(src, patients):
    assert sorted(r["encounter_id"] for r in reports.initial_obs(src, patients).collect()) == [14, 16, 16, 17]
    assert [r["encounter_id"] for r in reports.initial_encounters(src).collect()] == [14, 16, 17]
    assert reports.initial_encounters(src, patient_id=3).count() == 0
    assert [tuple(r) for r in reports.lab_concepts(src).collect()] == [(8, "Lab")]


def test_encounter_mapping(spark, src):
    old = staged(spark, "encounter_mapping", [{"encounter_type_id": 1, "target_type_id": 99}, {"encounter_type_id": 500, "target_type_id": 5}])
    rows = by(reference_data.encounter_mapping(src["encounter_type"], old), "encounter_type_id")
    assert {k: r["target_type_id"] for k, r in rows.items()} == {1: 7, 3: 7, 14: 21, 32: 14, 247: None, 12: None, 500: 5}


def test_locations(spark, src):
    assert [r["name"] for r in reference_data.parent_locations(src["location"]).collect()] == ["One"]
    linked = reference_data.staged_locations(src["location"])
    same_schema(linked, "locations")
    assert {k: r["parent_name"] for k, r in by(linked, "child_uuid").items()} == {"L1": "One", "L2": "Two", "L3": "One"}
    assert [r["parent_name"] for r in reference_data.location_picker(linked).collect()] == ["One", "Two"]
    assert set(by(reference_data.children_of(linked, "L1"), "child_uuid")) == {"L1", "L3"}
    old = staged(spark, "locations", [{"child_id": 3, "child_uuid": "L3", "child_name": "kept", "status": 0},
                                      {"child_id": 9, "child_uuid": "L9", "status": 0}])
    again = by(reference_data.staged_locations(src["location"], old), "child_uuid")
    assert {k: (r["child_name"], r["status"]) for k, r in again.items()} == {"L1": ("One", 1), "L2": ("Two", 1), "L3": ("kept", 1), "L9": (None, 0)}


def test_a_patient_seen_very_often_does_not_multiply_programs(spark, src, patients):
    often = src["encounter"].where("encounter_id = 10").withColumn("encounter_id", F.explode(F.sequence(F.lit(10), F.lit(509)).cast("array<long>")))
    got = care.programs({**src, "encounter": often}, patients, ["L1"], "X")
    assert sorted(r["patient_program_id"] for r in got.collect()) == [1, 3]

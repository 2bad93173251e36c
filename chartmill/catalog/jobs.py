"""The whole jobs over the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.catalog.basics import DICTIONARY_COLUMNS_SQL, dictionary_file
from chartmill.catalog.nested import (
    IDENTIFIER_TYPE_OF_PRIORITY, IDENTIFIERS_SQL, person_columns, person_columns_sql,
)
from chartmill.catalog.registry import query
from chartmill.catalog.relations import SITE_SQL
from chartmill.catalog.standins import (
    DICTIONARY_SQL, ENCOUNTER_SQL, ENCOUNTER_TYPE_SQL, OBS_SQL, PARENT, PATIENTS_SQL, PLACE_IDS, PLACE_IDS_SQL, PLACES,
    PLACES_SQL, PROGRAM_ID_OF_EVENT, PROGRAM_OF_EVENT, PROGRAMS_SQL, SIGNS_SQL, TYPES_SQL, DATATYPE_OF_PART_TYPE, Tables,
    code_of, code_of_sql, type_of_price,
)
from chartmill.functions import fixed_values as fixed
from chartmill.plans import care, reference_data, registration, reports

ENROLLMENT_TYPES_SQL = ", ".join(map(str, fixed.ENROLLMENT_ENCOUNTER_TYPES))
INITIAL_TYPES_SQL = ", ".join(map(str, fixed.INITIAL_ENCOUNTER_TYPES))


def second_run(name: str, sql: str, key: str, job) -> None:
    """Registers `<name>_again`: the rows of a third of the persons, spread over all keys, are staged, and the job runs
    over all of them with its default settings.  It must give the whole result less what is staged."""

    def again(t: Tables) -> DataFrame:
        return job(t, job(t, None).where(F.col(key) % 3 == 0))

    query(f"{name}_again", f"SELECT * FROM ({sql}) WHERE {key} % 3 <> 0")(again)


# ---- registration -------------------------------------------------------------------------------------------


def people(t: Tables, table: DataFrame, key: str, name: str, place: str, balance: str) -> dict[str, DataFrame]:
    """Person tables out of one driver table; every person has two names and two addresses."""
    rows = table.select(F.col(key).alias("person_id"), F.col(name).alias("uuid"), F.lit(0).alias("voided"),
                        *person_columns(name, place, balance))
    again = F.explode(F.array(F.lit(""), F.lit(" (2)")))
    return {
        "person": rows.select("person_id", "uuid", "voided", "gender", "birthdate", "birthdate_estimated", "dead"),
        "person_name": rows.select("person_id", F.col("given_name"), "middle_name", "family_name", again.alias("n")).select(
            "person_id", F.concat("given_name", "n").alias("given_name"), "family_name", "middle_name"),
        "person_address": rows.select("person_id", "address1", "address4", again.alias("n")).select(
            "person_id", F.concat("address1", "n").alias("address1"), F.lit(None).cast("string").alias("county_district"), "address4",
            F.lit(None).cast("string").alias("address5"), F.lit(None).cast("string").alias("address6")),
    }


USERS_SQL = f"""
    WITH who AS (SELECT s_suppkey AS user_id, s_name AS uuid, {person_columns_sql('s_name', 's_nationkey', 's_acctbal')},
                        CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS dead_flag, CASE WHEN s_nationkey = 3 THEN 1 ELSE 0 END AS estimated_flag
                 FROM supplier)
    SELECT uuid, user_id, 'SYS-' || user_id AS system_id, lower(uuid) AS username, given_name, family_name,
           CAST(NULL AS VARCHAR) AS middle_name, gender, birthdate, address1, CAST(NULL AS VARCHAR) AS county_district, address4,
           CAST(NULL AS VARCHAR) AS address5, CAST(NULL AS VARCHAR) AS address6, dead_flag AS dead,
           estimated_flag AS birthdate_estimated, '{PARENT}' AS parent_location_uuid, CAST(NULL AS VARCHAR) AS response_code
    FROM who WHERE user_id IN (
        SELECT l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ({PLACES_SQL}))"""


def users_of(t: Tables, staged: DataFrame | None) -> DataFrame:
    at = t.encounter.select("encounter_id", "location_id")
    worked = t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), F.col("l_suppkey").alias("creator")).join(at, "encounter_id")
    accounts = t.supplier.select(
        F.col("s_suppkey").alias("user_id"), F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("uuid"),
        F.concat(F.lit("SYS-"), F.col("s_suppkey").cast("string")).alias("system_id"), F.lower("s_name").alias("username"))
    src = {"encounter": worked, "location": t.location, "users": accounts,
           **people(t, t.supplier, "s_suppkey", "s_name", "s_nationkey", "s_acctbal")}
    return registration.users(src, PLACES, PARENT, staged)


@query("job_users", USERS_SQL)
def job_users(t: Tables) -> DataFrame:
    return users_of(t, None)


second_run("job_users", USERS_SQL, "user_id", users_of)


ALL_PATIENTS_SQL = f"""
    WITH who AS (SELECT c_custkey AS person_id, c_name AS uuid, c_nationkey, {person_columns_sql('c_name', 'c_nationkey', 'c_acctbal')},
                        CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS dead_flag, CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS estimated_flag
                 FROM customer)
    SELECT uuid, person_id, given_name, family_name, CAST(NULL AS VARCHAR) AS middle_name, gender, birthdate, address1,
           CAST(NULL AS VARCHAR) AS county_district, address4, CAST(NULL AS VARCHAR) AS address5, CAST(NULL AS VARCHAR) AS address6,
           dead_flag AS dead, estimated_flag AS birthdate_estimated, 0 AS voided, CAST(n_nationkey AS BIGINT) AS location_id,
           n_name AS location_name, '{PARENT}' AS parent_location_uuid, CAST(NULL AS VARCHAR) AS target_patient_uuid,
           CAST(NULL AS VARCHAR) AS response_code
    FROM who JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN ({PLACES_SQL}) AND person_id IN (SELECT o_custkey FROM orders)"""


def patients_of(t: Tables, staged: DataFrame | None) -> DataFrame:
    src = {"encounter": t.encounter.select("encounter_id", "patient_id", "location_id"), "location": t.location,
           "patient": t.customer.select(F.col("c_custkey").alias("patient_id")),
           **people(t, t.customer, "c_custkey", "c_name", "c_nationkey", "c_acctbal")}
    return registration.patients(src, PLACES, PARENT, staged)


@query("job_patients", ALL_PATIENTS_SQL + " AND person_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def job_patients(t: Tables) -> DataFrame:
    """The patients of one segment, spread over all keys, are staged already: the anti-join leaves them out."""
    return patients_of(t, t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("person_id"), F.lit(PARENT).alias("parent_location_uuid")))


second_run("job_patients", ALL_PATIENTS_SQL, "person_id", patients_of)


@query("job_identifiers", f"""
    SELECT patient_id, type_uuid, target_type_uuid,
           CASE WHEN type_uuid = '{fixed.DASH_FREE_IDENTIFIER_TYPE}' THEN replace(identifier, '-', '') ELSE identifier END AS identifier,
           preferred, CAST(patient_id % 25 AS BIGINT) AS location_id, voided, '{PARENT}' AS parent_location_uuid
    FROM ({IDENTIFIERS_SQL}) WHERE voided = 0 AND patient_id IN (SELECT person_id FROM ({PATIENTS_SQL}))""")
def job_identifiers(t: Tables) -> DataFrame:
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    given = t.orders.select(
        F.col("o_custkey").alias("patient_id"), F.concat(F.lit("ID-"), F.col("o_orderkey").cast("string")).alias("identifier"),
        number.alias("identifier_type"), (F.col("o_orderstatus") == "O").cast("int").alias("preferred"),
        (F.col("o_orderstatus") == "P").cast("int").alias("voided"), (F.col("o_custkey") % 25).alias("location_id"))
    uuid = F
    for priority, (_, type_uuid) in IDENTIFIER_TYPE_OF_PRIORITY.items():
        uuid = uuid.when(F.col("o_orderpriority") == priority, F.lit(type_uuid))
    kinds = t.orders.select(number.alias("patient_identifier_type_id"), uuid.alias("uuid")).distinct()
    src = {"patient_identifier": given, "patient_identifier_type": kinds}
    return registration.identifiers(src, t.patients, PARENT)


# ---- care data ----------------------------------------------------------------------------------------------

CONCEPT_OF_EVENT = {"view": 1, "click": 2, "purchase": 3, "signup": 1, "error": 5}


ENROLLED_SQL = f"""
    WITH seen AS (SELECT o_custkey, min(n_name) AS location_uuid FROM orders JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ({PLACES_SQL}) GROUP BY o_custkey),
         enrolled AS (SELECT event_id, user_id, event_type, ts, value, {code_of_sql('event_type', PROGRAM_OF_EVENT)} AS program_uuid,
                             {code_of_sql('event_type', PROGRAM_ID_OF_EVENT, 0)} AS program_id,
                             CAST({code_of_sql('event_type', CONCEPT_OF_EVENT, 0)} AS BIGINT) AS concept_id FROM events
                      QUALIFY row_number() OVER (PARTITION BY user_id, concept_id ORDER BY event_id) = 1)
    SELECT user_id AS patient_id, event_id AS patient_program_id, program_id, e.program_uuid, event_type AS program_name, concept_id,
           CAST(user_id % 25 AS BIGINT) AS location_id, location_uuid, ts AS date_enrolled, CASE WHEN value > 100 THEN ts END AS date_completed,
           target_patient_uuid, coalesce(d.target_program_uuid, '') AS target_program_uuid, '{PARENT}' AS parent_location_uuid, CAST(NULL AS VARCHAR) AS response_code
    FROM enrolled e JOIN seen ON user_id = o_custkey JOIN ({PATIENTS_SQL}) p ON user_id = person_id
    LEFT JOIN {PROGRAMS_SQL} ON e.program_uuid = d.program_uuid"""


def programs_of(t: Tables, staged: DataFrame | None) -> DataFrame:
    enrolments = t.events.select(
        F.col("event_id").alias("patient_program_id"), F.col("user_id").alias("patient_id"),
        code_of("event_type", PROGRAM_ID_OF_EVENT, 0).alias("program_id"), F.lit("").alias("uuid"), (F.col("user_id") % 25).alias("location_id"),
        F.col("ts").alias("date_enrolled"), F.when(F.col("value") > 100, F.col("ts")).alias("date_completed"))
    program = t.events.select("event_type").distinct().select(
        code_of("event_type", PROGRAM_ID_OF_EVENT, 0).alias("program_id"), code_of("event_type", PROGRAM_OF_EVENT).alias("uuid"),
        F.col("event_type").alias("name"), code_of("event_type", CONCEPT_OF_EVENT, 0).cast("long").alias("concept_id"))
    src = {"patient_program": enrolments, "program": program, "encounter": t.encounter, "location": t.location}
    return care.programs(src, t.patients, PLACES, PARENT, staged)


@query("job_programs", ENROLLED_SQL)
def job_programs(t: Tables) -> DataFrame:
    return programs_of(t, None)


second_run("job_programs", ENROLLED_SQL, "patient_id", programs_of)


ENCOUNTERS_SQL = f"""
    SELECT patient_id, encounter_id, e.encounter_type AS encounter_type_id, name AS encounter_name, encounter_datetime, location_id,
           visit_id, d.target_type_id, d.target_type_uuid, CAST(NULL AS VARCHAR) AS response_code
    FROM ({ENCOUNTER_SQL}) e JOIN ({ENCOUNTER_TYPE_SQL}) et ON e.encounter_type = et.encounter_type_id
    LEFT JOIN {TYPES_SQL} ON e.encounter_type = d.encounter_type_id
    WHERE voided = 0 AND location_id IN ({PLACE_IDS_SQL}) AND patient_id IN (SELECT person_id FROM ({PATIENTS_SQL}))"""


@query("job_encounters", ENCOUNTERS_SQL + " AND encounter_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')")
def job_encounters(t: Tables) -> DataFrame:
    """The encounters of the first year are staged already."""
    staged = t.orders.where("o_orderdate < TIMESTAMP_NTZ'1996-01-01 00:00:00'").select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("encounter_id"))
    return care.encounters(t.clinical, t.patients, PLACES, staged)


second_run("job_encounters", ENCOUNTERS_SQL, "patient_id", lambda t, staged: care.encounters(t.clinical, t.patients, PLACES, staged))


@query("job_encounter_mapping", f"""
    WITH fresh AS (SELECT DISTINCT p_size AS encounter_type_id FROM part),
         old AS (SELECT DISTINCT CAST(floor(o_totalprice / 1700) + 1 AS INTEGER) AS encounter_type_id FROM orders)
    SELECT encounter_type_id, target_type_id, target_type_uuid FROM fresh LEFT JOIN {TYPES_SQL} USING (encounter_type_id)
    UNION ALL SELECT encounter_type_id, CAST(0 AS INTEGER), 'old' FROM old WHERE encounter_type_id NOT IN (SELECT * FROM fresh)""")
def job_encounter_mapping(t: Tables) -> DataFrame:
    staged = t.orders.select(type_of_price().alias("encounter_type_id")).distinct().select(
        "encounter_type_id", F.lit(0).alias("target_type_id"), F.lit("old").alias("target_type_uuid"))
    return reference_data.encounter_mapping(t.encounter_type, staged)


VISITS_SQL = f"""
    WITH met AS (SELECT l_orderkey, l_suppkey, CAST(s_nationkey AS BIGINT) AS location_id,
                        CASE WHEN s_acctbal < 8000 THEN s_name END AS target_patient_uuid
                 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                 WHERE s_acctbal >= 0 AND s_nationkey IN ({PLACE_IDS_SQL})
                 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) = 1)
    SELECT o_orderkey AS visit_id, l_suppkey AS patient_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS visit_type_id,
           o_orderdate AS date_started, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS date_stopped, location_id,
           CAST(0 AS INTEGER) AS voided, target_patient_uuid, CAST(NULL AS VARCHAR) AS target_visit_uuid, CAST(NULL AS VARCHAR) AS response_code
    FROM orders JOIN met ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'"""


def visits_of(t: Tables, staged: DataFrame | None) -> DataFrame:
    """Lineitems are the encounters, their suppliers the patients."""
    staff = t.supplier.select("s_suppkey", "s_nationkey")
    met = t.lineitem.join(staff, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_linenumber").alias("encounter_id"), F.col("l_orderkey").alias("visit_id"), F.col("l_suppkey").alias("patient_id"),
        F.col("s_nationkey").cast("long").alias("location_id"))
    visit = t.orders.select(
        F.col("o_orderkey").alias("visit_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("visit_type_id"),
        F.col("o_orderdate").alias("date_started"), F.expr("CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END").alias("date_stopped"),
        (F.col("o_orderstatus") == "P").cast("int").alias("voided"))
    patients = t.supplier.where("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("person_id"), F.when(F.col("s_acctbal") < 8000, F.col("s_name")).alias("target_patient_uuid"))
    src = {"visit": visit, "encounter": met, "location": t.location}
    return care.visits(src, patients, PLACES, staged)


@query("job_visits", VISITS_SQL + " AND o_orderdate >= TIMESTAMP '1996-01-01'")
def job_visits(t: Tables) -> DataFrame:
    """The visits of the first year are staged already."""
    return visits_of(t, t.orders.where("o_orderdate < TIMESTAMP_NTZ'1996-01-01 00:00:00'").select(F.col("o_orderkey").alias("visit_id")))


second_run("job_visits", VISITS_SQL, "patient_id", visits_of)


CLINICAL_ORDER_SQL = """SELECT l_orderkey * 10 + l_linenumber AS order_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS uuid,
    l_partkey AS concept_id, l_suppkey AS patient_id, l_orderkey AS encounter_id, l_returnflag AS instructions,
    CAST(round(l_discount * 100) AS INTEGER) AS order_reason, l_shipdate AS date_created FROM lineitem"""


def clinical_orders(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]).alias("uuid"),
        F.lit(2).alias("order_type_id"), F.col("l_partkey").alias("concept_id"), F.col("l_suppkey").alias("patient_id"),
        F.col("l_suppkey").alias("orderer"), F.col("l_orderkey").alias("encounter_id"), F.col("l_returnflag").alias("instructions"),
        F.round(F.col("l_discount") * 100).cast("int").alias("order_reason"), F.lit("").alias("order_reason_non_coded"),
        F.lit("ROUTINE").alias("urgency"),
        F.concat(F.lit("N-"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("order_number"), F.lit("NEW").alias("order_action"),
        F.lit(1).alias("care_setting"), F.col("l_shipdate").alias("date_created"))


@query("job_orders", f"""
    WITH placed AS (SELECT o_orderkey, CAST(floor(o_totalprice / 10000) + 1 AS INTEGER) AS type_id FROM orders),
         single AS (SELECT c.*, type_id FROM ({CLINICAL_ORDER_SQL}) c JOIN placed ON encounter_id = o_orderkey
                    WHERE order_reason IS NOT NULL AND order_reason <> 0 AND type_id IN (SELECT p_size FROM part)
                      AND uuid NOT IN (SELECT uuid FROM ({CLINICAL_ORDER_SQL}) WHERE date_created < TIMESTAMP '1996-01-01')
                    QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY date_created, order_id, concept_id, patient_id, encounter_id,
                                               instructions, order_reason) = 1)
    SELECT order_id, uuid, CAST(2 AS INTEGER) AS order_type_id, concept_id, patient_id, encounter_id, type_id AS encounter_type_id, CAST(patient_id AS VARCHAR) AS orderer,
           instructions, 'ROUTINE' AS urgency, CAST(order_reason AS VARCHAR) AS order_reason, '' AS order_reason_non_coded, 'N-' || order_id AS order_number,
           'NEW' AS order_action, '1' AS care_setting, CAST(NULL AS VARCHAR) AS target_order_uuid, CAST(NULL AS VARCHAR) AS response_code,
           date_created, coalesce(d.target_type_uuid, '') AS target_type_uuid,
           coalesce(CASE WHEN s_acctbal >= 0 AND s_acctbal < 8000 THEN s_name END, 'Not Found') AS target_patient_uuid,
           coalesce(target_concept_uuid, '') AS target_reason_uuid
    FROM single LEFT JOIN {TYPES_SQL} ON type_id = d.encounter_type_id LEFT JOIN supplier ON patient_id = s_suppkey
    LEFT JOIN ({DICTIONARY_SQL}) ON CAST(order_reason AS VARCHAR) = source_concept_id""")
def job_orders(t: Tables) -> DataFrame:
    at = t.orders.select(F.col("o_orderkey").alias("encounter_id"), type_of_price(step=10000).alias("encounter_type"))
    patients = t.supplier.where("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("person_id"), F.when(F.col("s_acctbal") < 8000, F.col("s_name")).alias("target_patient_uuid"))
    orders = clinical_orders(t)
    staged = orders.where("date_created < TIMESTAMP_NTZ'1996-01-01 00:00:00'").select("uuid")
    src = {"orders": orders, "encounter": at, "encounter_type": t.encounter_type}
    return care.orders(src, patients, t.dictionary, staged)


VITAL_SIGNS = {1: "height", 2: "weight", 3: "pulse", 5: "temperature", 6: "spo2", 7: "rr"}
VITAL_SIGNS_SQL = ", ".join(f"max(CASE WHEN concept_id = {n} THEN value_numeric END) AS {name}" for n, name in VITAL_SIGNS.items())


TRIAGE_SQL = f"""
    WITH wide AS (SELECT person_id, encounter_id, min(location_id) AS location_id, max(obs_datetime) AS obs_datetime, {VITAL_SIGNS_SQL}
                  FROM ({SIGNS_SQL}) WHERE concept_id IN (1, 2, 3, 5, 6, 7) GROUP BY person_id, encounter_id)
    SELECT wide.*, o_orderdate AS encounter_datetime, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END AS visit_id
    FROM wide JOIN orders ON encounter_id = o_orderkey"""


def triage_source(t: Tables, lines: str = "true") -> dict[str, DataFrame]:
    """The measurements of some lines, and what they need; the sizes of the parts are the concepts."""
    at = t.orders.select(
        F.col("o_orderkey").alias("encounter_id"), F.col("o_orderdate").alias("encounter_datetime"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("visit_id"))
    concept = t.encounter_type.select(F.col("encounter_type_id").alias("concept_id"), F.col("name").alias("uuid"))
    return {"obs": t.signs.where(lines.replace("l_linenumber", "concept_id")), "encounter": at, "concept": concept}


def triage_of(t: Tables, staged: DataFrame | None) -> DataFrame:
    return care.triage(triage_source(t), None, staged, measures=VITAL_SIGNS, concept_uuids=[f"SIZE {n}" for n in VITAL_SIGNS])


@query("job_triage", TRIAGE_SQL + " WHERE o_orderdate >= TIMESTAMP '1996-01-01'")
def job_triage(t: Tables) -> DataFrame:
    """The vitals of the first year are staged already."""
    return triage_of(t, t.orders.where("o_orderdate < TIMESTAMP_NTZ'1996-01-01 00:00:00'").select(
        F.floor(F.col("o_orderkey") / 10).alias("person_id"), F.col("o_orderkey").alias("encounter_id")))


second_run("job_triage", TRIAGE_SQL, "person_id", triage_of)


HIV_SQL = f"""
    WITH told AS (SELECT person_id, encounter_id, concept_id, obs_datetime,
                         coalesce(CAST(value_coded AS VARCHAR), CAST(value_datetime AS VARCHAR), CAST(value_numeric AS VARCHAR), value_text) AS value
                  FROM ({OBS_SQL}) QUALIFY row_number() OVER (PARTITION BY person_id, encounter_id, concept_id ORDER BY obs_datetime, value) = 1)
    SELECT told.person_id, told.encounter_id, concept_id, encounter_datetime, encounter_type, et.name AS encounter_name, n_name AS location_uuid,
           least(p_name, p_brand) AS concept_name, obs_datetime, value, p_type AS value_type,
           {code_of_sql('p_type', DATATYPE_OF_PART_TYPE, 6)} AS datatype_id, CAST(1 AS BIGINT) AS provider_id, 'HIV Enrollment' AS category,
           c.target_concept_uuid, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN value ELSE v.target_concept_uuid END AS target_value,
           CAST(NULL AS VARCHAR) AS response_code
    FROM told JOIN ({ENCOUNTER_SQL}) e USING (encounter_id) JOIN ({ENCOUNTER_TYPE_SQL}) et ON encounter_type = encounter_type_id
    JOIN nation ON location_id = n_nationkey JOIN part ON concept_id = p_partkey
    LEFT JOIN ({DICTIONARY_SQL}) c ON CAST(concept_id AS VARCHAR) = c.source_concept_id
    LEFT JOIN ({DICTIONARY_SQL}) v ON value = v.source_concept_id
    WHERE encounter_type IN ({ENROLLMENT_TYPES_SQL}) AND location_id IN ({PLACE_IDS_SQL}) AND e.voided = 0 AND p_type <> 'PROMO'"""


@query("job_hiv_enrollment", HIV_SQL)
def job_hiv_enrollment(t: Tables) -> DataFrame:
    return care.hiv_enrollment(t.clinical, t.dictionary, PLACE_IDS, concepts=None)


# Where only some concepts are asked for, as in the job's own list.
ASKED = list(range(1, 2001, 3))
second_run("job_hiv_enrollment", f"{HIV_SQL} AND concept_id IN ({', '.join(map(str, ASKED))})", "person_id",
           lambda t, staged: care.hiv_enrollment(t.clinical, t.dictionary, PLACE_IDS, staged, concepts=ASKED))


@query("job_enrollment_summary", """
    SELECT user_id AS person_id, event_id AS encounter_id, ts AS enrollment_date, CASE WHEN value > 20 THEN 1 ELSE 0 END AS transfer_out,
           CAST(ts AS DATE) AS hiv_start_date, CAST(NULL AS DATE) AS death_date, CASE WHEN value > 20 THEN CAST(ts AS DATE) + 1 END AS transfer_out_date
    FROM events WHERE event_type <> 'error' AND value <= 100 AND event_type IN ('view', 'click', 'purchase')
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def job_enrollment_summary(t: Tables) -> DataFrame:
    none = F.lit(None).cast("date")
    flat = t.events.select(
        F.col("user_id").alias("person_id"), F.col("event_id").alias("encounter_id"), F.col("ts").alias("enrollment_date"),
        F.col("ts").cast("date").alias("hiv_start_date"), none.alias("death_date"), (F.col("value") > 20).cast("int").alias("transfer_out"),
        F.when(F.col("value") > 20, F.date_add(F.col("ts").cast("date"), 1)).alias("transfer_out_date"), (F.col("event_type") != "error").cast("int").alias("is_clinical_encounter"),
        F.when(F.col("value") > 100, F.col("ts")).alias("next_clinical_datetime_hiv"),
        code_of("event_type", PROGRAM_ID_OF_EVENT, 0).alias("location_id"))
    return care.enrollment_summary({"flat_summary": flat}, [1, 2, 3])


# ---- reports ------------------------------------------------------------------------------------------------


REGIMENS_SQL = f"""
    WITH signs AS ({SIGNS_SQL}),
         started AS (SELECT person_id, value_coded, min(encounter_id) AS encounter_id
                     FROM signs JOIN orders ON encounter_id = o_orderkey WHERE concept_id = 1 AND voided = 0 AND o_orderstatus <> 'P'
                     GROUP BY person_id, value_coded),
         regimen AS (SELECT encounter_id, min(person_id) AS person_id, min(value_coded) AS value_coded,
                            string_agg(p_name, ',' ORDER BY p_name) AS regimen
                     FROM started JOIN part ON value_coded = p_partkey GROUP BY encounter_id),
         reasons AS (SELECT encounter_id, min(p_name) AS reason_for_change FROM signs JOIN part ON value_coded = p_partkey
                     WHERE concept_id IN (6, 7) AND voided = 0 GROUP BY encounter_id)
    SELECT person_id, encounter_id, CAST(1 AS INTEGER) AS concept_id, value_coded, o_orderdate AS encounter_datetime, regimen, reason_for_change
    FROM regimen JOIN orders ON encounter_id = o_orderkey LEFT JOIN reasons USING (encounter_id)"""


def regimen_source(t: Tables, lines: str = "true") -> dict[str, DataFrame]:
    at = t.orders.select(F.col("o_orderkey").alias("encounter_id"), F.col("o_orderdate").alias("encounter_datetime"),
                         (F.col("o_orderstatus") == "P").cast("int").alias("voided"))
    return {"obs": t.signs.where(lines.replace("l_linenumber", "concept_id")), "encounter": at, "concept_name": t.concept_name}


@query("job_regimens", REGIMENS_SQL)
def job_regimens(t: Tables) -> DataFrame:
    return reports.regimens(regimen_source(t), drug_concept=1, change_concepts=[6, 7])


def patient_types_sql(transfer: bool) -> str:
    kind = "WHEN transferred THEN 160563 " if transfer else ""
    return f"""
    WITH obs AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN 2051 WHEN l_returnflag = 'R' THEN 7013 WHEN l_linenumber > 4 THEN 10194 ELSE 1 END AS concept_id,
                        CASE l_linenumber WHEN 1 THEN 2047 WHEN 2 THEN 2240 WHEN 3 THEN 1965 ELSE l_partkey END AS value_coded,
                        l_shipdate AS value_datetime FROM lineitem),
         told AS (SELECT l_orderkey, min(CASE WHEN concept_id = 2051 THEN value_coded END) AS entry,
                         min(CASE WHEN concept_id = 7013 THEN value_datetime END) AS first_care_date, bool_or(concept_id = 10194) AS transferred
                  FROM obs WHERE concept_id IN (2051, 7013{', 10194' if transfer else ''}) GROUP BY l_orderkey)
    SELECT patient_id, encounter_id, encounter_datetime, CASE WHEN form_id = 15 THEN 164144 {kind}ELSE 164931 END AS patient_type,
           CASE entry WHEN 2047 THEN 160539 WHEN 2240 THEN 162050 WHEN 2177 THEN 162050 WHEN 1965 THEN 160542 WHEN 1776 THEN 160536
                ELSE entry END AS entry_point, first_care_date
    FROM ({ENCOUNTER_SQL}) e JOIN told ON encounter_id = l_orderkey
    WHERE voided = 0 AND encounter_type IN ({ENROLLMENT_TYPES_SQL}) AND location_id IN ({PLACE_IDS_SQL}) AND form_id IS NOT NULL"""


def patient_types_of(t: Tables, transfer_in: bool) -> DataFrame:
    """Most encounters have several of the three observations."""
    coded = F.when(F.col("l_linenumber") == 1, 2047).when(F.col("l_linenumber") == 2, 2240).when(F.col("l_linenumber") == 3, 1965)
    concept = F.when(F.col("l_returnflag") == "A", 2051).when(F.col("l_returnflag") == "R", 7013).when(F.col("l_linenumber") > 4, 10194)
    told = t.lineitem.select(
        F.col("l_orderkey").alias("encounter_id"), concept.otherwise(1).alias("concept_id"),
        coded.otherwise(F.col("l_partkey")).alias("value_coded"), F.col("l_shipdate").alias("value_datetime"))
    forms = t.part.select(F.col("p_size").alias("form_id")).distinct()
    return reports.patient_types({"obs": told, "encounter": t.encounter, "form": forms}, PLACE_IDS, transfer_in=transfer_in)


@query("job_patient_types", patient_types_sql(False))
def job_patient_types(t: Tables) -> DataFrame:
    return patient_types_of(t, False)


@query("job_patient_types_transfer_in", patient_types_sql(True))
def job_patient_types_transfer_in(t: Tables) -> DataFrame:
    return patient_types_of(t, True)


@query("job_initial_obs", f"""
    SELECT o_custkey AS patient_id, encounter_id, concept_id, obs_datetime, value_coded,
           '{fixed.INITIAL_OBS_TARGET_UUID}' AS target_concept_uuid, '' AS target_value
    FROM ({SIGNS_SQL}) JOIN orders ON encounter_id = o_orderkey
    WHERE concept_id = 3 AND o_custkey IN (SELECT person_id FROM ({PATIENTS_SQL}))""")
def job_initial_obs(t: Tables) -> DataFrame:
    concept = t.encounter_type.select(F.col("encounter_type_id").cast("long").alias("concept_id"))
    at = t.orders.select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"))
    return reports.initial_obs({"obs": t.signs, "encounter": at, "concept": concept}, t.patients, concept=3)


@query("job_initial_encounters", f"""
    SELECT encounter_id, patient_id, encounter_type, encounter_datetime FROM ({ENCOUNTER_SQL})
    WHERE encounter_type IN ({INITIAL_TYPES_SQL}) AND encounter_id IN (SELECT l_orderkey FROM lineitem)""")
def job_initial_encounters(t: Tables) -> DataFrame:
    at = t.orders.select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"),
                         type_of_price(step=10000).alias("encounter_type"), F.col("o_orderdate").alias("encounter_datetime"))
    return reports.initial_encounters({"encounter": at, "encounter_type": t.encounter_type, "obs": t.signs})


@query("job_lab_concepts", """
    SELECT DISTINCT l_partkey AS concept_id, p_name AS name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey""")
def job_lab_concepts(t: Tables) -> DataFrame:
    at = t.orders.select(F.col("o_orderkey").alias("encounter_id"))
    return reports.lab_concepts({"orders": clinical_orders(t), "encounter": at, "concept_name": t.concept_name})


# ---- reference data -----------------------------------------------------------------------------------------

STAGED_SITE_SQL = f"""WITH site AS ({SITE_SQL}), linked AS (
    SELECT s.location_id AS child_id, s.uuid AS child_uuid, s.name AS child_name, p.location_id AS parent_id, p.uuid AS parent_uuid,
           p.name AS parent_name FROM site s LEFT JOIN site p ON coalesce(s.parent_location, s.location_id) = p.location_id)"""


@query("job_locations", STAGED_SITE_SQL + """
    SELECT child_id, child_uuid, CASE WHEN child_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
               THEN 'kept' ELSE child_name END AS child_name, parent_id, parent_uuid, parent_name, CAST(NULL AS VARCHAR) AS facility_code,
           CAST(1 AS INTEGER) AS status FROM linked""")
def job_locations(t: Tables) -> DataFrame:
    """The locations of one segment are staged under another name; they keep it and become active."""
    linked = reference_data.staged_locations(t.site)
    kept = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("child_id"))
    staged = linked.join(kept, "child_id", "left_semi").withColumns({"child_name": F.lit("kept"), "status": F.lit(0)})
    return reference_data.staged_locations(t.site, staged.select(linked.columns))


@query("job_location_picker", STAGED_SITE_SQL + """
    SELECT child_id, child_name, parent_name FROM linked WHERE parent_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY parent_name ORDER BY child_id) = 1""")
def job_location_picker(t: Tables) -> DataFrame:
    staged = reference_data.staged_locations(t.site).select("child_id", "child_name", "parent_name")
    return reference_data.location_picker(staged)


@query("job_concept_dictionary", DICTIONARY_COLUMNS_SQL + " WHERE p_type <> 'LARGE'")
def job_concept_dictionary(t: Tables) -> DataFrame:
    staged = t.full_dictionary.where("source_parent = 'LARGE'")
    return reference_data.concept_dictionary(t.spark, dictionary_file(t), staged)

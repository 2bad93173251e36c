"""Nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.catalog.registry import query
from chartmill.catalog.standins import IDENTIFIER_TYPES_SQL, PATIENTS_SQL, PROGRAMS_SQL, TYPES_SQL, Tables, type_of_price
from chartmill.catalog.state import ENROLMENT_SQL, enrolments
from chartmill.functions import dictionaries, fixed_values as fixed
from chartmill.operators import documents

# ---- the same documents in the checking SQL -----------------------------------------------------------------


def obj(*fields: tuple[str, str]) -> str:
    """JSON object text; a null value leaves its field out.  A value that starts with '@' is JSON already."""
    parts = []
    for name, value in fields:
        raw = value.startswith("@")
        quote = "" if raw else '"'
        parts.append(f"""'"{name}":{quote}' || CAST({value.removeprefix('@')} AS VARCHAR) || '{quote}'""")
    return "('{' || concat_ws(',', " + ", ".join(parts) + ") || '}')"


def arr(*items: str) -> str:
    return "('[' || " + " || ',' || ".join(items) + " || ']')"


def moment(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def person_sql(first: str, second: str, third: str, fourth: str) -> str:
    return obj(
        ("gender", "gender"), ("birthdate", "strftime(birthdate, '%Y-%m-%d')"), ("birthdateEstimated", "estimated"),
        ("dead", "dead"),
        ("names", "@" + arr(obj(("givenName", "given_name"), ("familyName", "family_name")))),
        ("addresses", "@" + arr(obj(("address1", first), ("address2", second), ("address3", third), ("address4", fourth)))),
    )


def person_columns(name: str, place: str, balance: str) -> list:
    return [
        F.when(F.col(place) < 12, "F").otherwise("M").alias("gender"),
        F.expr(f"date_add(date'1970-01-01', {place} * 100)").alias("birthdate"),
        (F.col(place) == 3).cast("int").alias("birthdate_estimated"), (F.col(balance) < 0).cast("int").alias("dead"),
        F.col(name).alias("given_name"), F.concat(F.lit("F"), F.col(place).cast("string")).alias("family_name"),
        F.lit(None).cast("string").alias("middle_name"), F.concat(F.lit("Street "), F.col(place).cast("string")).alias("address1"),
        F.when(F.col(balance) > 1000, F.lit("Town")).alias("address4"),
    ]


def person_columns_sql(name: str, place: str, balance: str) -> str:
    return f"""CASE WHEN {place} < 12 THEN 'F' ELSE 'M' END AS gender,
        DATE '1970-01-01' + CAST({place} * 100 AS INTEGER) AS birthdate,
        CASE WHEN {place} = 3 THEN 'true' ELSE 'false' END AS estimated,
        CASE WHEN {balance} < 0 THEN 'true' ELSE 'false' END AS dead,
        {name} AS given_name, 'F' || {place} AS family_name, 'Street ' || {place} AS address1,
        CASE WHEN {balance} > 1000 THEN 'Town' END AS address4"""


# ---- identifiers as the documents and the identifier job see them -------------------------------------------

IDENTIFIER_TYPE_OF_PRIORITY = {
    "1-URGENT": (1, "58a47054-1359-11df-a1f1-0026b9348838"),
    "2-HIGH": (2, "f2d6ff1a-8440-4d35-a150-1d4b5a930c5e"),
    "3-MEDIUM": (3, "cba702b9-4664-4b43-83f1-9ab473cbd64d"),
    "4-NOT SPECIFIED": (4, "ead42a8f-203e-4b11-a942-df03a460d617"),
    "5-LOW": (5, "unknown"),
}
TYPE_BY_PRIORITY_SQL = "(CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{uuid}'" for p, (_, uuid) in IDENTIFIER_TYPE_OF_PRIORITY.items()) + " END)"
IDENTIFIERS_SQL = f"""SELECT o_custkey AS patient_id, {TYPE_BY_PRIORITY_SQL} AS type_uuid,
    coalesce(target_type_uuid, '') AS target_type_uuid, 'ID-' || o_orderkey AS identifier,
    CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS preferred, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS voided
    FROM orders LEFT JOIN {IDENTIFIER_TYPES_SQL} ON {TYPE_BY_PRIORITY_SQL} = d.type_uuid"""


def type_uuid_of_priority():
    ladder = F
    for priority, (_, uuid) in IDENTIFIER_TYPE_OF_PRIORITY.items():
        ladder = ladder.when(F.col("o_orderpriority") == priority, F.lit(uuid))
    return ladder


def identifiers(t: Tables) -> DataFrame:
    typed = t.orders.select(F.col("o_custkey").alias("patient_id"), type_uuid_of_priority().alias("type_uuid"),
                            F.concat(F.lit("ID-"), F.col("o_orderkey").cast("string")).alias("identifier"))
    return dictionaries.map_codes(typed, dictionaries.identifier_types(t.spark), "type_uuid", "type_uuid", "")


def identifier_sql(value: str, kind: str, preferred: str) -> str:
    return obj(("identifier", value), ("identifierType", kind), ("location", f"'{fixed.DOCUMENT_LOCATION}'"), ("preferred", f"'{preferred}'"))


@query("doc_patient", f"""
    WITH who AS (SELECT c_custkey AS person_id, 'G-' || c_custkey AS generated, {person_columns_sql('c_name', 'c_nationkey', 'c_acctbal')} FROM customer)
    SELECT person_id, {obj(("identifiers", "@" + arr(identifier_sql('generated', f"'{fixed.GENERATED_IDENTIFIER_TYPE}'", 'true'))),
                           ("person", "@" + person_sql('address1', 'address1', 'address4', 'address4')))} AS document FROM who""")
def doc_patient(t: Tables) -> DataFrame:
    patients = t.customer.select(
        F.col("c_custkey").alias("person_id"), F.concat(F.lit("G-"), F.col("c_custkey").cast("string")).alias("generated_identifier"),
        *person_columns("c_name", "c_nationkey", "c_acctbal"))
    return documents.patient_documents(patients)


@query("doc_patient_identifier", f"""
    SELECT patient_id AS person_id, identifier, {identifier_sql('identifier', 'target_type_uuid', 'false')} AS document
    FROM ({IDENTIFIERS_SQL}) WHERE target_type_uuid <> ''""")
def doc_patient_identifier(t: Tables) -> DataFrame:
    return documents.identifier_documents(identifiers(t))


@query("doc_user", f"""
    WITH who AS (SELECT s_suppkey AS user_id, s_name AS username, {person_columns_sql('s_name', 's_nationkey', 's_acctbal')} FROM supplier)
    SELECT user_id, {obj(("username", "username"), ("person", "@" + person_sql('address1', 'address4', 'address4', 'address4')),
                         ("roles", f"@'[\"{fixed.USER_ROLE}\"]'"))} AS document FROM who""")
def doc_user(t: Tables) -> DataFrame:
    users = t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("username"),
                              *person_columns("s_name", "s_nationkey", "s_acctbal"))
    return documents.user_documents(users)


@query("doc_program", f"""
    SELECT patient_id, patient_program_id, {obj(
        ("patient", "target_patient_uuid"), ("program", "coalesce(d.target_program_uuid, '')"), ("dateEnrolled", moment("date_enrolled")),
        ("dateCompleted", f"CASE WHEN program_id NOT IN (1, 3, 9, 20) THEN {moment('date_completed')} END"))} AS document
    FROM ({ENROLMENT_SQL}) e LEFT JOIN {PROGRAMS_SQL} USING (program_uuid)
    LEFT JOIN ({PATIENTS_SQL}) p ON e.patient_id = p.person_id""")
def doc_program(t: Tables) -> DataFrame:
    return documents.program_documents(enrolments(t))


STOPPED = "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END"


@query("doc_visit", f"""
    SELECT o_orderkey AS visit_id, {obj(("patient", "'P-' || o_custkey"), ("visitType", f"'{fixed.VISIT_TYPE}'"),
        ("startDatetime", moment("o_orderdate")), ("stopDatetime", moment(STOPPED)))} AS document FROM orders""")
def doc_visit(t: Tables) -> DataFrame:
    visits = t.orders.select(
        F.col("o_orderkey").alias("visit_id"), F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("target_patient_uuid"),
        F.col("o_orderdate").alias("date_started"), F.expr(STOPPED).alias("date_stopped"))
    return documents.visit_documents(visits)


@query("doc_encounter", f"""
    SELECT o_orderkey AS encounter_id, {obj(("patient", "'P-' || o_custkey"), ("encounterType", "target_type_uuid"),
        ("location", f"'{fixed.DOCUMENT_LOCATION}'"), ("encounterDatetime", moment("o_orderdate")),
        ("visit", "CASE WHEN o_orderpriority <> '1-URGENT' THEN 'V-' || o_orderkey END"))} AS document
    FROM (SELECT *, CAST(floor(o_totalprice / 1700) + 1 AS INTEGER) AS type_id FROM orders)
    LEFT JOIN {TYPES_SQL} ON type_id = encounter_type_id""")
def doc_encounter(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_orderkey").alias("encounter_id"), F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("target_patient_uuid"),
        F.col("o_orderdate").alias("encounter_datetime"), type_of_price().alias("type_id"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("visit_id"),
        F.concat(F.lit("V-"), F.col("o_orderkey").cast("string")).alias("target_visit_uuid"))
    mapped = dictionaries.map_codes(rows, dictionaries.encounter_types(t.spark), "type_id", "encounter_type_id")
    return documents.encounter_documents(mapped)


@query("doc_order", f"""
    SELECT l_orderkey AS order_id, {obj(("patient", "'P-' || l_suppkey"), ("orderNumber", "'ORD-' || l_orderkey || '-' || l_linenumber"),
        ("orderType", "@l_linenumber"), ("urgency", "CASE WHEN l_quantity > 25 THEN 'STAT' ELSE 'ROUTINE' END"), ("orderer", "l_suppkey"),
        ("orderReason", "nullif(l_returnflag, 'N')"), ("sourceUuid", "'U-' || l_partkey"), ("careSettings", f"'{fixed.CARE_SETTING}'"))} AS document
    FROM lineitem""")
def doc_order(t: Tables) -> DataFrame:
    def text(prefix: str, *cols: str):
        return F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(c).cast("string") for c in cols]))

    rows = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), text("P-", "l_suppkey").alias("target_patient_uuid"),
        F.lit(None).cast("string").alias("target_order_uuid"), text("ORD-", "l_orderkey", "l_linenumber").alias("order_number"),
        F.col("l_linenumber").alias("order_type_id"), F.when(F.col("l_quantity") > 25, "STAT").otherwise("ROUTINE").alias("urgency"),
        F.col("l_suppkey").cast("string").alias("orderer"), F.nullif(F.col("l_returnflag"), F.lit("N")).alias("order_reason"),
        text("U-", "l_partkey").alias("uuid"))
    return documents.order_documents(rows)


@query("doc_encounter_bundle", f"""
    WITH listed AS (SELECT l_orderkey, string_agg({obj(("person", "'S-' || l_suppkey"), ("concept", "l_linenumber"), ("value", "@l_quantity"))},
                        ',' ORDER BY l_linenumber, 'S-' || l_suppkey, l_quantity) AS items FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey AS encounter_id, {obj(
        ("encounterProviders", "@" + arr(obj(("provider", "'PR-' || o_custkey"), ("encounterRole", f"'{fixed.ENCOUNTER_ROLE}'")))),
        ("patient", "'P-' || o_custkey"), ("encounterDatetime", moment("o_orderdate")), ("encounterType", f"'{fixed.BUNDLE_ENCOUNTER_TYPE}'"),
        ("form", f"'{fixed.BUNDLE_FORM}'"), ("location", f"'{fixed.DOCUMENT_LOCATION}'"),
        ("visit", "@" + obj(("patient", "'P-' || o_custkey"), ("visitType", f"'{fixed.BUNDLE_VISIT_TYPE}'"),
                            ("startDatetime", moment("o_orderdate")), ("stopDatetime", moment("o_orderdate")))),
        ("obs", "@'[' || coalesce(items, '') || ']'"))} AS document
    FROM orders LEFT JOIN listed ON o_orderkey = l_orderkey""")
def doc_encounter_bundle(t: Tables) -> DataFrame:
    encounters = t.orders.select(
        F.col("o_orderkey").alias("encounter_id"), F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("target_patient_uuid"),
        F.concat(F.lit("PR-"), F.col("o_custkey").cast("string")).alias("provider_uuid"), F.col("o_orderdate").alias("encounter_datetime"))
    obs = t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), F.col("l_linenumber").alias("concept_id"),
                            F.concat(F.lit("S-"), F.col("l_suppkey").cast("string")).alias("person_uuid"), F.col("l_quantity").alias("value"))
    return documents.encounter_bundles(encounters, obs)

"""Sources, sinks, projections, filters and code mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.catalog.registry import query
from chartmill.catalog.standins import (
    DATATYPE_OF_PART_TYPE, IDENTIFIER_TYPE_OF_SEGMENT, IDENTIFIER_TYPES_SQL, PLACES, PLACES_SQL, PROGRAM_OF_EVENT,
    PROGRAMS_SQL, TYPES_SQL, Tables, code_of, code_of_sql, type_of_price,
)
from chartmill.functions import columns as c
from chartmill.functions import dictionaries, fixed_values as fixed
from chartmill.operators import delivery, documents
from chartmill.operators.incremental import idempotent_load
from chartmill.sources import readers, writers
from chartmill.sources.ledger import Ledger

UUID_SQL = "substr({m}, 1, 8) || '-' || substr({m}, 9, 4) || '-' || substr({m}, 13, 4) || '-' || " \
           "substr({m}, 17, 4) || '-' || substr({m}, 21, 12)"


def uuid_sql(*cols: str) -> str:
    joined = " || chr(31) || ".join(f"CAST({col} AS VARCHAR)" for col in cols)
    return UUID_SQL.format(m=f"md5({joined})")


# ---- sources ------------------------------------------------------------------------------------------------


@query("scan_source", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def scan_source(t: Tables) -> DataFrame:
    return readers.read_table(t.spark, t.path("orders"), ["o_orderkey", "o_custkey", "o_orderdate"])


@query("scan_flat_summary", """
    SELECT user_id AS person_id, event_id AS encounter_id, ts AS enrollment_date FROM events
    WHERE event_type = 'purchase' AND CASE WHEN value > 100 THEN ts END IS NULL""")
def scan_flat_summary(t: Tables) -> DataFrame:
    flat = t.events.withColumn("next_seen", F.when(F.col("value") > 100, F.col("ts")))
    return flat.where((F.col("event_type") == "purchase") & F.col("next_seen").isNull()).select(
        F.col("user_id").alias("person_id"), F.col("event_id").alias("encounter_id"), F.col("ts").alias("enrollment_date"))


DICTIONARY_COLUMNS_SQL = """
    SELECT p_type AS source_parent, p_name AS source_label, p_brand AS source_concept_uuid,
           CAST(p_partkey AS VARCHAR) AS source_concept_id, 'coded' AS concept_type, CAST(p_size AS VARCHAR) AS ciel,
           lower(p_type) AS target_parent, upper(p_name) AS target_label,
           p_brand || '-' || p_partkey AS target_concept_uuid, CAST(p_size AS VARCHAR) AS target_concept_id
    FROM part"""


def dictionary_file(t: Tables) -> str:
    path = t.scratch("dictionary-csv")
    t.full_dictionary.write.option("header", True).csv(path)
    return path


@query("load_dictionary_csv", DICTIONARY_COLUMNS_SQL)
def load_dictionary_csv(t: Tables) -> DataFrame:
    return readers.read_concept_dictionary(t.spark, dictionary_file(t))


@query("scan_staging", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_staging(t: Tables) -> DataFrame:
    return readers.read_staged(t.spark, t.path("customer"), t.customer.schema)


@query("parse_response_json", """
    SELECT event_id, coalesce(CASE WHEN value <= 100 THEN 'U-' || event_id END, 'UUID not found') AS uuid,
           CASE WHEN value <= 50 THEN 'P-' || user_id END AS person_uuid,
           CASE WHEN event_type <> 'error' THEN 'ID-' || event_id END AS identifier_value,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events""")
def parse_response_json(t: Tables) -> DataFrame:
    # The answers are rendered from the events, so some lack a uuid, a person or an issued identifier.
    results = F.when(
        F.col("event_type") != "error",
        F.array(F.struct(F.concat(F.lit("ID-"), F.col("event_id").cast("string")).alias("identifierValue"))),
    ).otherwise(F.array().cast("array<struct<identifierValue:string>>"))
    body = F.struct(
        F.when(F.col("value") <= 100, F.concat(F.lit("U-"), F.col("event_id").cast("string"))).alias("uuid"),
        F.struct(F.when(F.col("value") <= 50, F.concat(F.lit("P-"), F.col("user_id").cast("string"))).alias("uuid")).alias("person"),
        results.alias("results"),
    )
    answers = t.events.select("event_id", F.to_json(body).alias("body"), F.from_json("props", "k bigint")["k"].alias("k"))
    return documents.read_responses(answers).drop("body")


# ---- sinks --------------------------------------------------------------------------------------------------


@query("append_staged", f"""
    SELECT o_custkey AS patient_id, o_orderkey AS encounter_id, o_orderdate AS encounter_datetime,
           {uuid_sql('o_custkey', 'o_orderkey')} AS row_id FROM orders""")
def append_staged(t: Tables) -> DataFrame:
    """Two overlapping loads into one staged table: the finished orders, then all of them."""
    rows = t.orders.select(F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("encounter_id"),
                           F.col("o_orderdate").alias("encounter_datetime"), "o_orderstatus")
    source, keys = rows.drop("o_orderstatus"), ("patient_id", "encounter_id")
    ledger = Ledger(t.spark, t.scratch("staged"), source.schema, keys, "encounter_datetime")
    for batch in (rows.where("o_orderstatus = 'F'"), rows):
        ledger.load(lambda staged, batch=batch: idempotent_load(batch.drop("o_orderstatus"), staged, keys))
    return ledger.staged().withColumnRenamed("id", "row_id").drop("load_number")


@query("upsert_mapping", """
    SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN upper(p_name) ELSE p_name END AS p_name
    FROM part WHERE p_size <= 30 OR p_type IN ('PROMO', 'LARGE')""")
def upsert_mapping(t: Tables) -> DataFrame:
    target = t.part.where("p_size <= 30").select("p_partkey", "p_name")
    source = t.part.where(F.col("p_type").isin("PROMO", "LARGE")).select("p_partkey", F.upper("p_name").alias("p_name"))
    return writers.write_snapshot(writers.upsert(target, source, ["p_partkey"]), t.scratch("mapping"))


@query("outbox_write", f"""
    SELECT o_orderkey AS visit_id, 'visit' AS entity, '{{"patient":"P-' || o_custkey || '","visitType":"{fixed.VISIT_TYPE}",'
        || '"startDatetime":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}}' AS document
    FROM orders WHERE o_orderpriority = '5-LOW'""")
def outbox_write(t: Tables) -> DataFrame:
    waiting = delivery.pending(with_answer(t.orders)).select(
        F.col("o_orderkey").alias("visit_id"), F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("target_patient_uuid"),
        F.col("o_orderdate").alias("date_started"), F.lit(None).cast("timestamp_ntz").alias("date_stopped"))
    path = t.scratch("outbox")
    for _ in range(2):  # a run that is repeated queues nothing again
        writers.write_outbox(documents.visit_documents(waiting), path, "visit")
    return t.spark.read.parquet(path).select("visit_id", "entity", "document")


def with_answer(orders: DataFrame) -> DataFrame:
    """Answers by priority: low ones have none yet, unspecified ones were refused."""
    code = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "400").when(F.col("o_orderpriority") != "5-LOW", "201")
    return orders.withColumn("response_code", code)


ANSWER_SQL = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '400' WHEN o_orderpriority <> '5-LOW' THEN '201' END"

LEDGER_SQL = """
    ledger AS (SELECT l_orderkey, l_shipdate,
                      CASE l_returnflag WHEN 'A' THEN '201' WHEN 'R' THEN '400' ELSE '500' END AS code,
                      CASE l_returnflag WHEN 'A' THEN 'U-' || l_partkey END AS uuid FROM lineitem),
    made AS (SELECT l_orderkey, code, uuid FROM ledger WHERE code = '201' QUALIFY row_number() OVER (
                   PARTITION BY l_orderkey ORDER BY l_shipdate DESC, uuid DESC) = 1),
    newest AS (SELECT l_orderkey, code, uuid FROM ledger QUALIFY row_number() OVER (
                   PARTITION BY l_orderkey ORDER BY l_shipdate DESC, code DESC, uuid DESC NULLS LAST) = 1)"""


def answered(t: Tables, rule: str) -> DataFrame:
    ledger = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("attempt"),
        F.when(F.col("l_returnflag") == "A", "201").when(F.col("l_returnflag") == "R", "400").otherwise("500").alias("code"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("U-"), F.col("l_partkey").cast("string"))).alias("uuid"))
    return delivery.apply_responses(t.orders.select("o_orderkey"), ledger, "o_orderkey", rule)


@query("apply_responses", f"""
    WITH {LEDGER_SQL}
    SELECT o_orderkey, code AS response_code, uuid AS target_uuid
    FROM orders LEFT JOIN made ON o_orderkey = l_orderkey""")
def apply_responses(t: Tables) -> DataFrame:
    return answered(t, delivery.CREATED_ONLY)


@query("apply_responses_always", f"""
    WITH {LEDGER_SQL}
    SELECT o_orderkey, code AS response_code, CASE WHEN code = '201' THEN uuid END AS target_uuid
    FROM orders LEFT JOIN newest ON o_orderkey = l_orderkey""")
def apply_responses_always(t: Tables) -> DataFrame:
    return answered(t, delivery.ALWAYS)


# ---- projections and filters --------------------------------------------------------------------------------


@query("project_alias", """
    SELECT o_orderkey AS encounter_id, o_custkey AS person_id, 'HIV Enrollment' AS category,
           CAST(NULL AS VARCHAR) AS target_order_uuid FROM orders""")
def project_alias(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("person_id"),
        F.lit(fixed.ENROLLMENT_CATEGORY).alias("category"), F.lit(None).cast("string").alias("target_order_uuid"))


@query("filter_in_list", f"""
    SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ({PLACES_SQL})""")
def filter_in_list(t: Tables) -> DataFrame:
    chosen = t.nation.where(F.col("n_name").isin(*PLACES))
    return t.customer.join(chosen, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("filter_not_voided", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END = 0""")
def filter_not_voided(t: Tables) -> DataFrame:
    voided = (F.col("o_orderstatus") == "P").cast("int")
    return t.orders.withColumn("voided", voided).where(F.col("voided") == 0).select("o_orderkey", "o_orderstatus")


@query("filter_not_equal", """
    SELECT c_custkey, nullif(c_mktsegment, 'FURNITURE') AS segment FROM customer
    WHERE nullif(c_mktsegment, 'FURNITURE') <> 'BUILDING'""")
def filter_not_equal(t: Tables) -> DataFrame:
    named = t.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("segment"))
    return named.where(F.col("segment") != "BUILDING")


@query("filter_null", f"""
    SELECT o_orderkey, {ANSWER_SQL} IS NULL AS is_pending FROM orders
    WHERE {ANSWER_SQL} IS NULL OR nullif(o_orderstatus, 'P') IS NOT NULL""")
def filter_null(t: Tables) -> DataFrame:
    rows = with_answer(t.orders).withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return rows.where(F.col("response_code").isNull() | F.col("status").isNotNull()).select(
        "o_orderkey", F.col("response_code").isNull().alias("is_pending"))


@query("filter_truthy", """
    SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
    WHERE nullif(l_discount, 0.05) IS NOT NULL AND nullif(l_discount, 0.05) <> 0""")
def filter_truthy(t: Tables) -> DataFrame:
    reason = F.nullif(F.col("l_discount"), F.lit(0.05))
    return t.lineitem.where(c.truthy(reason)).select("l_orderkey", "l_linenumber", "l_discount")


@query("case_code_map", f"""
    SELECT o_orderkey, CAST(floor(o_totalprice / 1700) + 1 AS INTEGER) AS type_id, target_type_id, target_type_uuid
    FROM orders LEFT JOIN {TYPES_SQL} ON CAST(floor(o_totalprice / 1700) + 1 AS INTEGER) = encounter_type_id""")
def case_code_map(t: Tables) -> DataFrame:
    typed = t.orders.select("o_orderkey", type_of_price().alias("type_id"))
    return dictionaries.map_codes(typed, dictionaries.encounter_types(t.spark), "type_id", "encounter_type_id")


@query("encounter_type_mapping", f"""
    SELECT type_id, target_type_id, target_type_uuid
    FROM (SELECT DISTINCT CAST(floor(o_totalprice / 1700) + 1 AS INTEGER) AS type_id FROM orders)
    LEFT JOIN {TYPES_SQL} ON type_id = encounter_type_id""")
def encounter_type_mapping(t: Tables) -> DataFrame:
    types = t.orders.select(type_of_price().alias("type_id")).distinct()
    return dictionaries.map_codes(types, dictionaries.encounter_types(t.spark), "type_id", "encounter_type_id")


# What the ladder's columns are read from: form, concept and coded answer of a lineitem.
CODED_ANSWERS = {1: 2047, 2: 2240, 3: 2177, 4: 1965, 5: 1776}


@query("case_mixed", """
    WITH told AS (
        SELECT l_orderkey, l_linenumber, l_shipdate, nullif(p_size, 16) AS form_id,
               CASE l_returnflag WHEN 'A' THEN 2051 WHEN 'R' THEN 7013 ELSE 10194 END AS concept_id,
               CASE l_linenumber WHEN 1 THEN 2047 WHEN 2 THEN 2240 WHEN 3 THEN 2177 WHEN 4 THEN 1965 WHEN 5 THEN 1776
                    ELSE CAST(l_partkey AS INTEGER) END AS value_coded
        FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, l_linenumber, form_id,
           CASE WHEN form_id = 15 THEN 164144 WHEN concept_id = 10194 THEN 160563
                WHEN form_id IS NOT NULL THEN 164931 END AS patient_type,
           CASE WHEN concept_id = 2051 AND value_coded = 2047 THEN 160539
                WHEN concept_id = 2051 AND value_coded = 2240 THEN 162050
                WHEN concept_id = 2051 AND value_coded = 2177 THEN 162050
                WHEN concept_id = 2051 AND value_coded = 1965 THEN 160542
                WHEN concept_id = 2051 AND value_coded = 1776 THEN 160536 ELSE value_coded END AS entry_point,
           CASE WHEN concept_id = 7013 THEN l_shipdate END AS first_care_date
    FROM told""")
def case_mixed(t: Tables) -> DataFrame:
    coded = F
    for line, answer in CODED_ANSWERS.items():
        coded = coded.when(F.col("l_linenumber") == line, F.lit(answer))
    told = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.nullif(F.col("p_size"), F.lit(16)).alias("form_id"),
        F.when(F.col("l_returnflag") == "A", 2051).when(F.col("l_returnflag") == "R", 7013).otherwise(10194).alias("concept_id"),
        coded.otherwise(F.col("l_partkey").cast("int")).alias("value_coded"))
    return told.select(
        "l_orderkey", "l_linenumber", "form_id", c.patient_type("form_id", "concept_id", transfer_in=True).alias("patient_type"),
        c.entry_point("concept_id", "value_coded").alias("entry_point"),
        c.first_care_date("concept_id", "l_shipdate").alias("first_care_date"))


@query("coalesce_typed", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           coalesce(CASE WHEN l_linenumber <= 2 THEN CAST(l_partkey AS VARCHAR) END,
                    CASE WHEN l_returnflag = 'A' THEN CAST(l_shipdate AS VARCHAR) END,
                    CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS VARCHAR) END,
                    nullif(l_returnflag, 'N')) AS value
    FROM lineitem""")
def coalesce_typed(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        c.first_text(
            F.when(F.col("l_linenumber") <= 2, F.col("l_partkey")), F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")),
            F.when(F.col("l_linestatus") == "F", F.col("l_quantity")), F.nullif(F.col("l_returnflag"), F.lit("N")),
        ).alias("value"))


@query("dict_identifier_type", f"""
    SELECT c_custkey, coalesce(target_type_uuid, '') AS target_type_uuid
    FROM customer LEFT JOIN {IDENTIFIER_TYPES_SQL}
      ON {code_of_sql('c_mktsegment', IDENTIFIER_TYPE_OF_SEGMENT)} = type_uuid""")
def dict_identifier_type(t: Tables) -> DataFrame:
    typed = t.customer.select("c_custkey", code_of("c_mktsegment", IDENTIFIER_TYPE_OF_SEGMENT).alias("type_uuid"))
    return dictionaries.map_codes(typed, dictionaries.identifier_types(t.spark), "type_uuid", "type_uuid", "").drop("type_uuid")


@query("dict_program", f"""
    SELECT event_id, coalesce(target_program_uuid, '') AS target_program_uuid
    FROM events LEFT JOIN {PROGRAMS_SQL} ON {code_of_sql('event_type', PROGRAM_OF_EVENT)} = program_uuid""")
def dict_program(t: Tables) -> DataFrame:
    typed = t.events.select("event_id", code_of("event_type", PROGRAM_OF_EVENT).alias("program_uuid"))
    return dictionaries.map_codes(typed, dictionaries.programs(t.spark), "program_uuid", "program_uuid", "").drop("program_uuid")


@query("strip_by_type", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN replace(replace(c_name, '#', '-'), '-', '')
                           ELSE replace(c_name, '#', '-') END AS identifier FROM customer""")
def strip_by_type(t: Tables) -> DataFrame:
    dashed = t.customer.select("c_custkey", F.replace(F.col("c_name"), F.lit("#"), F.lit("-")).alias("identifier"),
                               code_of("c_mktsegment", IDENTIFIER_TYPE_OF_SEGMENT).alias("type_uuid"))
    return dashed.select("c_custkey", c.strip_for_type("identifier", "type_uuid", fixed.DASH_FREE_IDENTIFIER_TYPE).alias("identifier"))


@query("flag_text", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END AS dead FROM customer")
def flag_text(t: Tables) -> DataFrame:
    flags = t.customer.select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("dead"))
    return flags.select("c_custkey", c.flag_text("dead").alias("dead"))


@query("value_or_mapped", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN {code_of_sql('p_type', DATATYPE_OF_PART_TYPE, 6)} IN (1, 2)
               THEN CAST(l_partkey AS VARCHAR) ELSE CASE WHEN p_size > 12 THEN p_brand || '-' || p_partkey END END AS target_value
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
def value_or_mapped(t: Tables) -> DataFrame:
    typed = t.lineitem.join(t.concept, F.col("l_partkey") == F.col("concept_id")).withColumn("value", F.col("l_partkey").cast("string"))
    codes = t.dictionary.select(F.col("source_concept_id").alias("value"), F.col("target_concept_uuid").alias("code"))
    return typed.join(codes, "value", "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", c.raw_or_code("datatype_id", "value", "code").alias("target_value"))


@query("lookup_default", """
    SELECT o_orderkey, coalesce(c_name, 'Client Not Migrated') AS patient
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0""")
def lookup_default(t: Tables) -> DataFrame:
    known = t.patients.select("person_id", "uuid")
    return t.orders.join(known, F.col("o_custkey") == F.col("person_id"), "left").select(
        "o_orderkey", c.or_default("uuid", fixed.PATIENT_NOT_MIGRATED).alias("patient"))


@query("cast_int", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders")
def cast_int(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", c.whole_number(F.substring("o_orderpriority", 1, 1)).alias("priority"))


@query("row_uuid", f"SELECT o_orderkey, {uuid_sql('o_custkey', 'o_orderkey')} AS row_id FROM orders")
def row_uuid(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", c.natural_uuid("o_custkey", "o_orderkey").alias("row_id"))

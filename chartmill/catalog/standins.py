"""The given test tables read as clinical tables.

The clinical schema has no public data, so every registered query runs over these stand-ins: customers are
patients, orders are encounters, visits or clinical orders, lineitems are observations, parts are concepts,
suppliers are staff, events are program enrolments and nations are locations.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.functions import dictionaries, fixed_values as fixed
from chartmill.session import run_dir

# Locations the jobs are run for, and the parent they report to.
PLACES = [f"NATION_{n}" for n in (0, 2, 3, 5, 7, 8, 11, 13, 16, 17, 19, 22)]
PLACE_IDS = [int(name.split("_")[1]) for name in PLACES]
PARENT = "REGION_EAST"

# Codes the stand-in attributes are read as.
PROGRAM_OF_EVENT = {
    "view": "781d85b0-1359-11df-a1f1-0026b9348838",
    "click": "80839137-9711-483f-a239-dfd383d020f6",
    "purchase": "fc15ac01-5381-4854-bf5e-917c907aa77f",
    "signup": "334c9e98-173f-4454-a8ce-f80b20b7fdf0",
}
PROGRAM_ID_OF_EVENT = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
IDENTIFIER_TYPE_OF_SEGMENT = {
    "BUILDING": "58a47054-1359-11df-a1f1-0026b9348838",
    "MACHINERY": "f2d6ff1a-8440-4d35-a150-1d4b5a930c5e",
    "FURNITURE": "cba702b9-4664-4b43-83f1-9ab473cbd64d",
    "HOUSEHOLD": "ead42a8f-203e-4b11-a942-df03a460d617",
}
DATATYPE_OF_PART_TYPE = {"ECONOMY": 1, "SMALL": 2, "MEDIUM": 3, "LARGE": 4, "PROMO": 5}
UNKNOWN = "unknown"


def code_of(col: str, codes: dict, otherwise=UNKNOWN) -> Column:
    ladder = F
    for value, code in codes.items():
        ladder = ladder.when(F.col(col) == value, F.lit(code))
    return ladder.otherwise(F.lit(otherwise))


def code_of_sql(col: str, codes: dict, otherwise=UNKNOWN) -> str:
    def text(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    arms = " ".join(f"WHEN {col} = '{value}' THEN {text(code)}" for value, code in codes.items())
    return f"(CASE {arms} ELSE {text(otherwise)} END)"


def type_of_price(price: str = "o_totalprice", step: int = 1700) -> Column:
    return (F.floor(F.col(price) / step) + 1).cast("int")


_SCHEMAS: dict = {}


class Tables:
    """The given tables of one scale, and the clinical tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """A given table; its schema is looked up in the file once per process, not once per query."""
        path = self.path(name)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def scratch(self, label: str) -> str:
        return run_dir(self.spark, label)

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    # ---- clinical tables ------------------------------------------------------------------------------------

    @cached_property
    def location(self) -> DataFrame:
        return self.nation.select(
            F.col("n_nationkey").cast("long").alias("location_id"), F.col("n_name").alias("uuid"),
            F.col("n_name").alias("name"), F.lit(None).cast("string").alias("description"),
            F.col("n_regionkey").cast("long").alias("parent_location"),
        )

    @cached_property
    def site(self) -> DataFrame:
        """Locations with a hierarchy of their own: customers below the customer of their nation's number."""
        parent = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("long"))
        return self.customer.select(
            F.col("c_custkey").alias("location_id"), F.col("c_name").alias("uuid"),
            F.concat_ws(" ", "c_mktsegment", "c_name").alias("name"), F.col("c_mktsegment").alias("description"),
            parent.alias("parent_location"),
        )

    @cached_property
    def patients(self) -> DataFrame:
        """Staged patients: customers in credit; some have no target uuid yet."""
        return self.customer.where("c_acctbal >= 0").select(
            F.col("c_custkey").alias("person_id"), F.col("c_name").alias("uuid"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("T-"), "c_name")).alias("target_patient_uuid"),
        )

    @cached_property
    def encounter(self) -> DataFrame:
        """Orders as encounters at their customer's nation."""
        return self.orders.join(self.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("encounter_id"), F.concat(F.lit("E-"), F.col("o_orderkey").cast("string")).alias("uuid"),
            F.col("o_custkey").alias("patient_id"), type_of_price(step=10000).alias("encounter_type"),
            F.col("o_orderdate").alias("encounter_datetime"), F.col("c_nationkey").cast("long").alias("location_id"),
            F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("visit_id"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.substring("o_orderpriority", 1, 1).cast("int") + 13).alias("form_id"),
            F.lit(1).cast("long").alias("creator"), (F.col("o_orderstatus") == "P").cast("int").alias("voided"),
        )

    @cached_property
    def encounter_type(self) -> DataFrame:
        return self.part.select(
            F.col("p_size").alias("encounter_type_id"), F.concat(F.lit("SIZE "), F.col("p_size").cast("string")).alias("name")
        ).distinct()

    @cached_property
    def obs(self) -> DataFrame:
        """Lineitems as observations whose value sits in one of four columns."""
        return self.lineitem.select(
            F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("encounter_id"),
            F.col("l_partkey").alias("concept_id"), F.col("l_shipdate").alias("obs_datetime"),
            F.when(F.col("l_linenumber") <= 2, F.col("l_partkey")).alias("value_coded"),
            F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")).alias("value_datetime"),
            F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("value_numeric"),
            F.col("l_returnflag").alias("value_text"), F.col("l_linenumber").cast("long").alias("location_id"),
            (F.col("l_tax") > 0.07).cast("int").alias("voided"),
        )

    @cached_property
    def signs(self) -> DataFrame:
        """Lineitems as measurements: the line number is the sign, ten consecutive orders are one person's."""
        return self.lineitem.select(
            F.floor(F.col("l_orderkey") / 10).alias("person_id"), F.col("l_orderkey").alias("encounter_id"),
            F.col("l_linenumber").cast("long").alias("concept_id"), F.col("l_shipdate").alias("obs_datetime"),
            F.col("l_partkey").alias("value_coded"), F.col("l_shipdate").alias("value_datetime"),
            F.col("l_quantity").alias("value_numeric"), F.col("l_returnflag").alias("value_text"),
            F.col("l_suppkey").alias("location_id"), (F.col("l_tax") > 0.07).cast("int").alias("voided"),
        )

    @cached_property
    def concept(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("concept_id"), F.col("p_brand").alias("uuid"),
            code_of("p_type", DATATYPE_OF_PART_TYPE, 6).alias("datatype_id"),
        )

    @cached_property
    def concept_datatype(self) -> DataFrame:
        kind = F.when(F.col("p_type") == "PROMO", "N/A").otherwise(F.col("p_type"))
        return self.part.select(
            code_of("p_type", DATATYPE_OF_PART_TYPE, 6).alias("concept_datatype_id"), kind.alias("name")).distinct()

    @cached_property
    def concept_name(self) -> DataFrame:
        """Two names per concept: the part's name in English, its brand in another language."""
        both = F.explode(F.array(
            F.struct(F.col("p_name").alias("name"), F.lit("en").alias("locale"), F.lit(1).alias("locale_preferred")),
            F.struct(F.col("p_brand").alias("name"), F.lit("fr").alias("locale"), F.lit(0).alias("locale_preferred")),
        ))
        return self.part.select(F.col("p_partkey").alias("concept_id"), both.alias("n")).select(
            "concept_id", "n.*", F.lit("FULLY_SPECIFIED").alias("concept_name_type"))

    @cached_property
    def dictionary(self) -> DataFrame:
        """Concept dictionary of the lookups: the parts of a quarter of the sizes have no entry."""
        return self.full_dictionary.where("CAST(ciel AS INT) > 12")

    @cached_property
    def full_dictionary(self) -> DataFrame:
        return self.part.select(
            F.col("p_type").alias("source_parent"), F.col("p_name").alias("source_label"),
            F.col("p_brand").alias("source_concept_uuid"), F.col("p_partkey").cast("string").alias("source_concept_id"),
            F.lit("coded").alias("concept_type"), F.col("p_size").cast("string").alias("ciel"),
            F.lower("p_type").alias("target_parent"), F.upper("p_name").alias("target_label"),
            F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("target_concept_uuid"),
            F.col("p_size").cast("string").alias("target_concept_id"),
        )

    @cached_property
    def clinical(self) -> dict[str, DataFrame]:
        return {
            "location": self.location, "encounter": self.encounter, "encounter_type": self.encounter_type,
            "obs": self.obs, "concept": self.concept, "concept_datatype": self.concept_datatype,
            "concept_name": self.concept_name,
        }


# ---- the same stand-ins for the checking SQL ---------------------------------------------------------------

PLACES_SQL = ", ".join(f"'{p}'" for p in PLACES)
PLACE_IDS_SQL = ", ".join(map(str, PLACE_IDS))

PATIENTS_SQL = """SELECT c_custkey AS person_id, c_name AS uuid,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'T-' || c_name END AS target_patient_uuid
    FROM customer WHERE c_acctbal >= 0"""

ENCOUNTER_SQL = """SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
    CAST(floor(o_totalprice / 10000) + 1 AS INTEGER) AS encounter_type, o_orderdate AS encounter_datetime,
    CAST(c_nationkey AS BIGINT) AS location_id,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END AS visit_id,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 13 END AS form_id,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS voided
    FROM orders JOIN customer ON o_custkey = c_custkey"""

ENCOUNTER_TYPE_SQL = "SELECT DISTINCT p_size AS encounter_type_id, 'SIZE ' || p_size AS name FROM part"

OBS_SQL = """SELECT l_suppkey AS person_id, l_orderkey AS encounter_id, l_partkey AS concept_id,
    l_shipdate AS obs_datetime, CASE WHEN l_linenumber <= 2 THEN l_partkey END AS value_coded,
    CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS value_datetime,
    CASE WHEN l_linestatus = 'F' THEN l_quantity END AS value_numeric, l_returnflag AS value_text,
    CAST(l_linenumber AS BIGINT) AS location_id, CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END AS voided FROM lineitem"""

SIGNS_SQL = """SELECT CAST(floor(l_orderkey / 10) AS BIGINT) AS person_id, l_orderkey AS encounter_id,
    CAST(l_linenumber AS BIGINT) AS concept_id, l_shipdate AS obs_datetime, l_partkey AS value_coded,
    l_shipdate AS value_datetime, l_quantity AS value_numeric, l_returnflag AS value_text, l_suppkey AS location_id,
    CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END AS voided FROM lineitem"""

DICTIONARY_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS source_concept_id,
    p_brand || '-' || p_partkey AS target_concept_uuid FROM part WHERE p_size > 12"""


def values_sql(rows, names: str) -> str:
    def text(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {names}"


TYPES_SQL = values_sql(dictionaries.encounter_type_rows(), "d(encounter_type_id, target_type_id, target_type_uuid)")
PROGRAMS_SQL = values_sql(dictionaries.program_rows(), "d(program_uuid, target_program_uuid)")
IDENTIFIER_TYPES_SQL = values_sql(dictionaries.identifier_type_rows(), "d(type_uuid, target_type_uuid)")

"""Care data: programs, encounters, visits, orders, vitals and enrolment observations.

Facts are reduced to one row per natural key before they meet another fact: a patient, encounter or visit that
holds a large share of all rows then enters the join as one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.functions import dictionaries, fixed_values as fixed
from chartmill.functions.columns import first_text, or_default, raw_or_code, truthy
from chartmill.operators.choose import pick_one, pivot_measures
from chartmill.operators.incremental import after_cursor
from chartmill.operators.lookups import anti_staged, dimension, lookup_first, new_rows, semi_on
from chartmill.plans.registration import Tables, at_locations


# Concepts and codes are a few short texts each: at most some tens of megabytes are broadcast.
DICTIONARY_ROWS = 200_000


def programs(src: Tables, patients: DataFrame, location_uuids: Sequence[str], parent_location: str,
             staged: DataFrame | None = None, look_back: int | None = None) -> DataFrame:
    """Program enrolments of staged patients seen at the chosen locations, one per (patient, program concept).

    The enrolment keeps its own location id; the location uuid is the lowest of the places the patient was seen.
    """
    spark = src["patient_program"].sparkSession
    # One row per patient, so enrolments do not multiply by encounters.
    places = src["location"].where(F.col("uuid").isin(*location_uuids)).select(
        "location_id", F.col("uuid").alias("location_uuid"))
    seen = (
        src["encounter"].select("patient_id", "location_id")
        .join(dimension(places), "location_id")
        .groupBy("patient_id").agg(F.min("location_uuid").alias("location_uuid"))
    )
    seen = lookup_first(seen, patients, {"patient_id": "person_id"}, {"target_patient_uuid": "target_patient_uuid"}, how="inner")
    enrolments = src["patient_program"].drop("uuid")
    if staged is not None and look_back is not None:
        enrolments = after_cursor(enrolments, "patient_program_id", staged, inclusive=True, look_back=look_back)
    program = src["program"].select(
        "program_id", "concept_id", F.col("uuid").alias("program_uuid"), F.col("name").alias("program_name"))
    single = pick_one(enrolments.join(dimension(program), "program_id"), ["patient_id", "concept_id"], ["patient_program_id"])
    placed = single.join(seen, "patient_id")
    mapped = dictionaries.map_codes(placed, dictionaries.programs(spark), "program_uuid", "program_uuid", default="")
    rows = mapped.select(
        "patient_id", "patient_program_id", "program_id", "program_uuid", "program_name", "concept_id", "location_id",
        "location_uuid", "date_enrolled", "date_completed", "target_patient_uuid", "target_program_uuid",
        F.lit(parent_location).alias("parent_location_uuid"), _no_response(),
    )
    return _not_staged(rows, staged, ["patient_id", "program_id"], ["patient_program_id"])


def encounters(src: Tables, patients: DataFrame, location_uuids: Sequence[str], staged: DataFrame | None = None,
               look_back: int | None = None) -> DataFrame:
    """Encounters in force of staged patients at the chosen locations, with their mapped type."""
    spark = src["encounter"].sparkSession
    rows = at_locations(src, "encounter", location_uuids).where(F.col("voided") == 0)
    rows = _recent(rows, "encounter_id", staged, look_back)
    types = src["encounter_type"].select("encounter_type_id", F.col("name").alias("encounter_name"))
    typed = rows.withColumnRenamed("encounter_type", "encounter_type_id").join(dimension(types), "encounter_type_id")
    gated = semi_on(typed, patients, {"patient_id": "person_id"})
    # Codes are added after duplicates are gone, so the shuffled rows stay narrow.
    staged_columns = gated.select(
        "patient_id", "encounter_id", "encounter_type_id", "encounter_name", "encounter_datetime", "location_id", "visit_id"
    )
    fresh = _not_staged(staged_columns, staged, ["patient_id", "encounter_id"])
    mapped = dictionaries.map_codes(fresh, dictionaries.encounter_types(spark), "encounter_type_id", "encounter_type_id")
    return mapped.withColumn("response_code", F.lit(None).cast("string"))


def encounters_that_may_come(src: Tables, location_uuids: Sequence[str]) -> DataFrame:
    """Encounters that lack at most their patient: in force, at the chosen locations, of a known type."""
    rows = at_locations(src, "encounter", location_uuids).where(F.col("voided") == 0)
    types = src["encounter_type"].select(F.col("encounter_type_id").alias("encounter_type"))
    return rows.join(dimension(types), "encounter_type", "left_semi").select(*src["encounter"].columns)


def visits(src: Tables, patients: DataFrame, location_uuids: Sequence[str], staged: DataFrame | None = None,
           look_back: int | None = None) -> DataFrame:
    """Visits in force with at least one encounter of a staged patient at the chosen locations.

    Patient and location come from the visit's lowest encounter.
    """
    met = at_locations(src, "encounter", location_uuids).where(F.col("visit_id").isNotNull())
    met = lookup_first(met.select("visit_id", "encounter_id", "patient_id", "location_id"), patients,
                       {"patient_id": "person_id"}, {"target_patient_uuid": "target_patient_uuid"}, how="inner")
    first = pick_one(met, ["visit_id"], ["encounter_id"]).drop("encounter_id")
    open_visits = _recent(src["visit"].where(F.col("voided") == 0), "visit_id", staged, look_back)
    rows = open_visits.join(first, "visit_id").select(
        "visit_id", "patient_id", "visit_type_id", "date_started", "date_stopped", "location_id", "voided",
        "target_patient_uuid", F.lit(None).cast("string").alias("target_visit_uuid"), _no_response(),
    )
    return _not_staged(rows, staged, ["visit_id"])


def orders(src: Tables, patients: DataFrame, dictionary: DataFrame, staged: DataFrame | None = None,
           look_back=None) -> DataFrame:
    """Clinical orders that give a reason, at an encounter of a known type: the oldest of each uuid.

    The mapped encounter type, the patient's target uuid and the mapped reason are separate columns.  With `look_back`
    (an interval) only orders created since the newest staged one, less that much, are read.
    """
    spark = src["orders"].sparkSession
    reasoned = src["orders"].where(truthy("order_reason")).select(
        "order_id", "uuid", "order_type_id", "concept_id", "patient_id", "encounter_id", "orderer", "instructions", "urgency",
        "order_reason", "order_reason_non_coded", "order_number", "order_action", "care_setting", "date_created")
    if staged is not None and look_back is not None:
        reasoned = after_cursor(reasoned, "date_created", staged, inclusive=True, look_back=look_back)
    types = src["encounter_type"].select("encounter_type_id")
    at = src["encounter"].select("encounter_id", F.col("encounter_type").alias("encounter_type_id"))
    placed = reasoned.join(at, "encounter_id").join(dimension(types), "encounter_type_id", "left_semi")
    # One shuffle by uuid serves the choice of a row and the anti-join.
    single = _not_staged(placed, staged, ["uuid"], ["date_created", "order_id"])
    mapped = dictionaries.map_codes(
        single, dictionaries.encounter_types(spark).drop("target_type_id"), "encounter_type_id", "encounter_type_id", "")
    known = lookup_first(mapped, patients, {"patient_id": "person_id"}, {"target_patient_uuid": "_patient"})
    coded = lookup_first(known.withColumn("_reason_key", F.col("order_reason").cast("string")), concept_codes(dictionary),
                         {"_reason_key": "source_concept_id"}, {"target_concept_uuid": "_reason"}, unique=True)
    return coded.select(
        "order_id", "uuid", "order_type_id", "concept_id", "patient_id", "encounter_id", "encounter_type_id",
        F.col("orderer").cast("string").alias("orderer"), "instructions", "urgency",
        F.col("order_reason").cast("string").alias("order_reason"), "order_reason_non_coded", "order_number",
        "order_action", F.col("care_setting").cast("string").alias("care_setting"), "date_created", "target_type_uuid",
        or_default("_patient", fixed.NOT_FOUND).alias("target_patient_uuid"),
        or_default("_reason", "").alias("target_reason_uuid"),
        F.lit(None).cast("string").alias("target_order_uuid"), _no_response(),
    )


def triage(src: Tables, location_ids: Sequence[int] | None = None, staged: DataFrame | None = None, person_id: int | None = None,
           measures: Mapping[int, str] | None = None, concept_uuids: Sequence[str] | None = None,
           look_back: int | None = None) -> DataFrame:
    """Vital signs as one wide row per (person, encounter): the largest value of each sign.

    The observations are reduced before they meet the encounters.
    """
    measures = fixed.VITALS if measures is None else measures
    concepts = src["concept"].where(F.col("uuid").isin(*(concept_uuids or fixed.VITAL_CONCEPT_UUIDS))).select("concept_id")
    signs = src["obs"]
    if location_ids is not None:
        signs = signs.where(F.col("location_id").isin(*location_ids))
    if person_id is not None:
        signs = signs.where(F.col("person_id") == person_id)
    signs = _recent(signs, "encounter_id", staged, look_back)
    wide = pivot_measures(
        signs.join(dimension(concepts), "concept_id", "left_semi"), ["person_id", "encounter_id"], "concept_id", "value_numeric",
        measures, [F.min("location_id").alias("location_id"), F.max("obs_datetime").alias("obs_datetime")],
    )
    # The staged rows go out before the encounters come in: the reduced rows are partitioned by the staged key.
    keys = ["person_id", "encounter_id"]
    fresh = wide if staged is None else anti_staged(wide, staged, keys)
    at = src["encounter"].select("encounter_id", "encounter_datetime", "visit_id")
    return fresh.join(at, "encounter_id").select(
        *keys, "encounter_datetime", "visit_id", "location_id", "obs_datetime", *measures.values())


def hiv_enrollment(
    src: Tables,
    dictionary: DataFrame,
    location_ids: Sequence[int],
    staged: DataFrame | None = None,
    encounter_types: Sequence[int] = fixed.ENROLLMENT_ENCOUNTER_TYPES,
    concepts: Sequence[int] | None = fixed.ENROLLMENT_CONCEPTS,
    raw_types: Sequence[int] = (1, 2),
    value_columns: Sequence[str | Column] = ("value_coded", "value_datetime", "value_numeric", "value_text"),
    look_back: int | None = None,
) -> DataFrame:
    """Typed observations of enrolment encounters, one per (person, encounter, concept); `concepts=None` takes all.

    What depends on the concept alone (type, name, target uuid) is joined among the dictionaries, so the
    observations are joined to it once.  They meet the encounters first: that filters them, and the shuffle by
    encounter serves the choice of one row per key as well.
    """
    kinds = src["concept_datatype"].where(F.col("name") != "N/A").select(
        F.col("concept_datatype_id").alias("datatype_id"), F.col("name").alias("value_type"))
    named = pick_one(src["concept_name"].select("concept_id", F.col("name").alias("concept_name")), ["concept_id"])
    wanted = F.lit(True) if concepts is None else F.col("concept_id").isin(*concepts)
    described = (
        src["concept"].where(wanted).select("concept_id", "datatype_id", F.col("concept_id").cast("string").alias("_concept"))
        .join(dimension(kinds), "datatype_id").join(named, "concept_id")
    )
    codes = concept_codes(dictionary)
    code = {"target_concept_uuid": "target_concept_uuid"}
    described = lookup_first(described, codes, {"_concept": "source_concept_id"}, code, unique=True).drop("_concept")
    # One row per concept at most, so the concepts bound it.
    described = dimension(described, DICTIONARY_ROWS, src["concept"])
    types = src["encounter_type"].select(F.col("encounter_type_id").alias("encounter_type"), F.col("name").alias("encounter_name"))
    places = src["location"].select("location_id", F.col("uuid").alias("location_uuid"))
    at = (
        src["encounter"].where(F.col("encounter_type").isin(*encounter_types) & F.col("location_id").isin(*location_ids))
        .where(F.col("voided") == 0)
        .select("encounter_id", "encounter_datetime", "encounter_type", "location_id", F.col("creator").alias("provider_id"))
        .join(dimension(types), "encounter_type").join(dimension(places), "location_id").drop("location_id")
    )
    observed = _recent(src["obs"].where(wanted), "encounter_id", staged, look_back).select(
        "person_id", "encounter_id", "concept_id", "obs_datetime", first_text(*value_columns).alias("value"))
    keys = ["person_id", "encounter_id", "concept_id"]
    single = _not_staged(observed.join(at, "encounter_id"), staged, keys, ["obs_datetime", "value"])
    valued = lookup_first(single.join(described, "concept_id"), codes, {"value": "source_concept_id"},
                          {"target_concept_uuid": "_value_code"}, unique=True)
    return valued.select(
        *keys, "encounter_datetime", "encounter_type", "encounter_name", "location_uuid", "concept_name", "obs_datetime",
        "value", "value_type", "datatype_id", "provider_id", F.lit(fixed.ENROLLMENT_CATEGORY).alias("category"),
        "target_concept_uuid", raw_or_code("datatype_id", "value", "_value_code", raw_types).alias("target_value"),
        _no_response(),
    )


def enrollment_summary(src: Tables, location_ids: Sequence[int], staged: DataFrame | None = None) -> DataFrame:
    """Current care status of every person: clinical rows with no later clinical row."""
    current = src["flat_summary"].where(
        (F.col("is_clinical_encounter") == 1)
        & F.col("next_clinical_datetime_hiv").isNull()
        & F.col("location_id").isin(*location_ids)
    )
    rows = current.select("person_id", "encounter_id", "enrollment_date", "hiv_start_date", "death_date", "transfer_out",
                          "transfer_out_date")
    return _not_staged(rows, staged, ["person_id"], ["encounter_id"])


def concept_codes(dictionary: DataFrame) -> DataFrame:
    """The dictionary as one code per concept, for any number of joins; broadcast if the dictionary is small enough."""
    codes = pick_one(dictionary.select("source_concept_id", "target_concept_uuid"), ["source_concept_id"])
    return dimension(codes, DICTIONARY_ROWS, dictionary)


def _recent(rows: DataFrame, key: str, staged: DataFrame | None, look_back: int | None) -> DataFrame:
    """Rows above the staged cursor lowered by `look_back`; `None` takes all and leaves it to the anti-join.

    The original compares strictly, so a `look_back` of 0 does too.
    """
    if staged is None or look_back is None:
        return rows
    return after_cursor(rows, key, staged, look_back=look_back)


def _not_staged(rows: DataFrame, staged: DataFrame | None, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    return pick_one(rows, keys, order) if staged is None else new_rows(rows, staged, keys, order)


def _no_response() -> Column:
    return F.lit(None).cast("string").alias("response_code")

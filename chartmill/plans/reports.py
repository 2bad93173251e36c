"""Clinical roll-ups and extracts over encounters and observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed
from chartmill.functions.columns import entry_point, patient_type
from chartmill.operators.choose import join_names
from chartmill.operators.lookups import dimension, one_per_key, semi_on
from chartmill.plans.registration import Tables


def full_names(src: Tables, locale: str = "en") -> DataFrame:
    """(value_coded, name): the first full name of each concept, broadcast if they are few."""
    names = src["concept_name"].where(
        (F.col("locale") == locale) & (F.col("concept_name_type") == "FULLY_SPECIFIED")
    ).select(F.col("concept_id").alias("value_coded"), "name")
    # A drug a third of the patients take is a hot key of the joins with these.
    return dimension(one_per_key(names, ["value_coded"], F.min("name").alias("name")), bound=names)


def reasons_for_change(src: Tables, names: DataFrame, change_concepts: Sequence[int]) -> DataFrame:
    """(encounter_id, reason_for_change): the first by name of each encounter."""
    changed = src["obs"].where((F.col("voided") == 0) & F.col("concept_id").isin(*change_concepts)).select("encounter_id", "value_coded")
    return changed.join(names, "value_coded").groupBy("encounter_id").agg(F.min("name").alias("reason_for_change"))


def regimens(
    src: Tables,
    location_ids: Sequence[int] | None = None,
    person_id: int | None = None,
    drug_concept: int = fixed.REGIMEN_CONCEPT,
    change_concepts: Sequence[int] = fixed.REGIMEN_CHANGE_CONCEPTS,
    locale: str = "en",
) -> DataFrame:
    """The drugs a patient took up at each encounter as one text, with the reason for a change.

    A drug counts at the patient's first encounter with it; names are listed in alphabetical order.
    """
    names = full_names(src, locale)
    in_force = src["obs"].where(F.col("voided") == 0)
    drugs = in_force.where(F.col("concept_id") == drug_concept)
    if location_ids is not None:
        drugs = drugs.where(F.col("location_id").isin(*location_ids))
    if person_id is not None:
        drugs = drugs.where(F.col("person_id") == person_id)
    at = src["encounter"].where(F.col("voided") == 0).select("encounter_id", "encounter_datetime")
    # Repeated drugs of an encounter go before the join; which encounter came first is known only after it.
    taken = drugs.select("person_id", "value_coded", "encounter_id").distinct().join(at, "encounter_id")
    started = taken.groupBy("person_id", "value_coded").agg(
        F.min(F.struct("encounter_id", "encounter_datetime")).alias("_first")
    ).select("person_id", "value_coded", "_first.*")
    regimen = join_names(started.join(names, "value_coded"), ["encounter_id"], "value_coded", "name", "regimen",
                         [F.min("person_id").alias("person_id"), F.min("value_coded").alias("value_coded"),
                          F.min("encounter_datetime").alias("encounter_datetime")])
    return regimen.join(reasons_for_change(src, names, change_concepts), "encounter_id", "left").select(
        "person_id", "encounter_id", F.lit(drug_concept).alias("concept_id"), "value_coded", "encounter_datetime",
        "regimen", "reason_for_change",
    )


def patient_types(
    src: Tables,
    location_ids: Sequence[int] | None = None,
    encounter_types: Sequence[int] = fixed.ENROLLMENT_ENCOUNTER_TYPES,
    transfer_in: bool = False,
) -> DataFrame:
    """Patient type, entry point and first-care date of each enrolment encounter that tells one of them.

    Each is taken from the observations of its own concept: the smallest value, if there are several.
    """
    concepts = [fixed.ENTRY_POINT_CONCEPT, fixed.FIRST_CARE_DATE_CONCEPT]
    if transfer_in:
        concepts.append(fixed.TRANSFER_IN_CONCEPT)
    concept = F.col("concept_id")
    single = src["obs"].where(concept.isin(*concepts)).groupBy("encounter_id").agg(
        F.min(F.when(concept == fixed.ENTRY_POINT_CONCEPT, F.col("value_coded"))).alias("_entry"),
        F.min(F.when(concept == fixed.FIRST_CARE_DATE_CONCEPT, F.col("value_datetime"))).alias("first_care_date"),
        F.max(F.when(concept == fixed.TRANSFER_IN_CONCEPT, concept)).alias("_transfer"),
    )
    at = src["encounter"].where((F.col("voided") == 0) & F.col("encounter_type").isin(*encounter_types))
    if location_ids is not None:
        at = at.where(F.col("location_id").isin(*location_ids))
    at = at.join(dimension(src["form"].select("form_id")), "form_id", "left_semi")
    return at.join(single, "encounter_id").select(
        "patient_id", "encounter_id", "encounter_datetime",
        patient_type("form_id", "_transfer", transfer_in).alias("patient_type"),
        entry_point(F.lit(fixed.ENTRY_POINT_CONCEPT), "_entry").alias("entry_point"),
        "first_care_date",
    )


def initial_obs(src: Tables, patients: DataFrame, concept: int = fixed.INITIAL_OBS_CONCEPT) -> DataFrame:
    """Observations of the initial-visit concept of staged patients, with the constant target code."""
    told = src["obs"].where(F.col("concept_id") == concept).select(
        "encounter_id", "concept_id", "obs_datetime", "value_coded")
    known = semi_on(src["encounter"].select("encounter_id", "patient_id"), patients, {"patient_id": "person_id"})
    described = src["concept"].where(F.col("concept_id") == concept).select("concept_id")
    return told.join(dimension(described), "concept_id", "left_semi").join(known, "encounter_id").select(
        "patient_id", "encounter_id", "concept_id", "obs_datetime", "value_coded",
        F.lit(fixed.INITIAL_OBS_TARGET_UUID).alias("target_concept_uuid"), F.lit("").alias("target_value"),
    )


def initial_encounters(src: Tables, patient_id: int | None = None,
                       encounter_types: Sequence[int] = fixed.INITIAL_ENCOUNTER_TYPES) -> DataFrame:
    """Encounters of the initial types that have an observation, by id; for one patient or for all."""
    at = src["encounter"].where(F.col("encounter_type").isin(*encounter_types))
    if patient_id is not None:
        at = at.where(F.col("patient_id") == patient_id)
    types = src["encounter_type"].select(F.col("encounter_type_id").alias("encounter_type"))
    observed = src["obs"].select("encounter_id").distinct()
    return at.join(dimension(types), "encounter_type", "left_semi").join(observed, "encounter_id", "left_semi").orderBy("encounter_id")


def lab_concepts(src: Tables, locale: str = "en") -> DataFrame:
    """Distinct ordered concepts with their preferred name in one language."""
    names = src["concept_name"].where((F.col("locale") == locale) & (F.col("locale_preferred") == 1))
    placed = src["orders"].join(src["encounter"].select("encounter_id"), "encounter_id", "left_semi")
    ordered = placed.select("concept_id").distinct()
    return ordered.join(names.select("concept_id", "name").distinct(), "concept_id")

"""Named finders of every staged entity, as filters.

`find` takes one set of values; `find_each` takes a whole table of wanted keys and answers all of them with one
join, where a loop would ask once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.operators.choose import latest
from chartmill.operators.delivery import pending
from chartmill.operators.lookups import distinct_keys

LOAD = "load_number"
ALL, LATEST, PENDING, DISTINCT_PARENTS = "all", "latest", "pending", "distinct parents"

# entity -> finder -> key columns, or one of the shapes above.
FINDERS: dict[str, dict[str, tuple[str, ...] | str]] = {
    "encounter_mapping": {
        "by_id": ("id",),
        "by_source_type": ("encounter_type_id",),
        "by_target_type": ("target_type_id",),
        "by_target_uuid": ("target_type_uuid",),
    },
    "encounters": {
        "by_id": ("id",),
        "by_patient_and_encounter": ("patient_id", "encounter_id"),
        "latest": LATEST,
        "pending": PENDING,
    },
    "enrollments": {"by_id": ("id",), "by_person": ("person_id",), "by_uuid": ("uuid",), "all": ALL, "latest": LATEST},
    "hiv_enrollment": {
        "by_id": ("id",),
        "by_patient_encounter_concept": ("person_id", "encounter_id", "concept_id"),
        "all": ALL,
        "latest": LATEST,
    },
    "identifiers": {
        "by_id": ("id",),
        "by_type": ("type_uuid",),
        "by_patient": ("patient_id",),
        "by_type_and_location": ("type_uuid", "parent_location_uuid"),
    },
    "concept_dictionary": {"by_id": ("id",), "by_source_concept": ("source_concept_id",)},
    "obs": {
        "by_id": ("id",),
        "by_uuid": ("uuid",),
        "by_patient_encounter_concept": ("person_id", "encounter_id", "concept_id"),
    },
    "orders": {"by_uuid": ("uuid",), "all": ALL},
    "patients": {
        "by_id": ("id",),
        "by_person": ("person_id",),
        "by_uuid": ("uuid",),
        "by_uuid_and_location": ("uuid", "parent_location_uuid"),
        "all": ALL,
        "latest": LATEST,
    },
    "programs": {
        "by_id": ("id",),
        "by_uuid": ("uuid",),
        "by_uuid_and_location": ("uuid", "parent_location_uuid"),
        "by_location": ("parent_location_uuid",),
        "by_patient_and_program": ("patient_id", "program_id"),
        "latest": LATEST,
        "pending": PENDING,
    },
    "triage": {"by_id": ("id",), "by_patient_and_encounter": ("person_id", "encounter_id"), "latest": LATEST},
    "users": {
        "by_id": ("id",),
        "by_uuid": ("uuid",),
        "by_uuid_and_location": ("uuid", "parent_location_uuid"),
        "latest": LATEST,
    },
    "visits": {"by_visit": ("visit_id",), "all": ALL, "latest": LATEST, "pending": PENDING},
    "locations": {
        "by_id": ("id",),
        "by_child_uuid": ("child_uuid",),
        "by_facility_code": ("facility_code",),
        "by_parent_and_status": ("parent_uuid", "status"),
        "all": ALL,
        "active_parents": DISTINCT_PARENTS,
    },
}


def find(df: DataFrame, entity: str, finder: str, *values, id_column: str = "id") -> DataFrame:
    """Run a named finder.  A value of None looks for nulls.

    The latest row is the one of the newest load, and of its rows the one with the largest id; tables that have no
    load number go by the id alone.
    """
    shape = FINDERS[entity][finder]
    if shape == ALL:
        return df
    if shape == LATEST:
        return latest(df, LOAD) if LOAD in df.columns else latest(df, id_column)
    if shape == PENDING:
        return pending(df)
    if shape == DISTINCT_PARENTS:
        return df.where(F.col("status") == 1).select("parent_uuid").distinct()
    if len(values) != len(shape):
        raise ValueError(f"{entity}.{finder} needs values for {', '.join(shape)}")
    return df.where(_equal([id_column if c == "id" else c for c in shape], values))


def find_each(df: DataFrame, entity: str, finder: str, wanted: DataFrame) -> DataFrame:
    """All rows that match any row of `wanted`, which holds the finder's key columns."""
    shape = FINDERS[entity][finder]
    return df.join(distinct_keys(wanted.select(*shape)), list(shape), "left_semi")


def _equal(columns: Sequence[str], values: Sequence):
    condition = F.lit(True)
    for column, value in zip(columns, values):
        condition = condition & (F.col(column).isNull() if value is None else F.col(column) == value)
    return condition

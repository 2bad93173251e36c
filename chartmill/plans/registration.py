"""Staff, patients and their identifiers.

`src` maps clinical table names (see `chartmill.schemas`) to DataFrames; `staged` is the entity loaded so far.
Every job returns the rows to append.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.functions import dictionaries, fixed_values as fixed
from chartmill.functions.columns import flag_text, strip_for_type
from chartmill.operators.choose import pick_one
from chartmill.operators.incremental import after_cursor, before_cursor
from chartmill.operators.lookups import anti_staged, dimension, new_rows
from chartmill.operators.numbering import allocate

Tables = Mapping[str, DataFrame]

PERSON_COLUMNS = ["gender", "birthdate", "dead", "birthdate_estimated"]
NAME_COLUMNS = ["given_name", "family_name", "middle_name"]
ADDRESS_COLUMNS = ["address1", "county_district", "address4", "address5", "address6"]


def at_locations(src: Tables, table: str, location_uuids: Sequence[str]) -> DataFrame:
    """Rows of a table that belong to the chosen locations."""
    chosen = src["location"].where(F.col("uuid").isin(*location_uuids)).select("location_id")
    return src[table].join(dimension(chosen), "location_id", "left_semi")


def with_person(rows: DataFrame, src: Tables, person_columns: Sequence[str], delta: bool = False) -> DataFrame:
    """Join rows that have one person each to the person, one name and one address.

    A person may have several names and addresses.  They are reduced to one before the join, so the join never
    multiplies rows.  For a `delta`, only the names and addresses of its persons are reduced.
    """
    names, addresses = src["person_name"].select("person_id", *NAME_COLUMNS), src["person_address"].select("person_id", *ADDRESS_COLUMNS)
    if delta:
        persons = rows.select("person_id").distinct()
        names, addresses = (d.join(persons, "person_id", "left_semi") for d in (names, addresses))
    names, addresses = pick_one(names, ["person_id"]), pick_one(addresses, ["person_id"])
    person = src["person"].select("person_id", *person_columns)
    return rows.join(person, "person_id").join(names, "person_id").join(addresses, "person_id")


def users(src: Tables, location_uuids: Sequence[str], parent_location: str, staged: DataFrame | None = None,
          cursor: bool = False) -> DataFrame:
    """Staff accounts that created an encounter at the chosen locations.

    The anti-join with the staged rows decides.  With `cursor`, later runs read only accounts above the largest staged
    one, and miss those below it that become active later.
    """
    creators = at_locations(src, "encounter", location_uuids).select(F.col("creator").alias("user_id")).distinct()
    accounts = src["users"]
    if staged is not None and cursor:
        accounts = after_cursor(accounts, "user_id", staged)
    accounts = accounts.join(creators, "user_id", "left_semi")
    rows = with_person(accounts, src, PERSON_COLUMNS, staged is not None).select(
        "uuid", "user_id", "system_id", "username", *NAME_COLUMNS, "gender", "birthdate", *ADDRESS_COLUMNS, "dead",
        "birthdate_estimated", F.lit(parent_location).alias("parent_location_uuid"),
        F.lit(None).cast("string").alias("response_code"),
    )
    keys = ["uuid", "parent_location_uuid"]
    return pick_one(rows, keys) if staged is None else new_rows(rows, staged, keys)


def patients(src: Tables, location_uuids: Sequence[str], parent_location: str, staged: DataFrame | None = None,
             cursor: bool = False) -> DataFrame:
    """Demographics of the patients seen at the chosen locations.

    A patient seen at several of them is stored with the lowest location id.  Every run takes everyone who is not
    staged.  With `cursor`, later runs read only below the smallest staged person, to go on with a back-fill; patients
    above it are then left to a run without.
    """
    seen = (
        at_locations(src, "encounter", location_uuids)
        .groupBy(F.col("patient_id").alias("person_id"))
        .agg(F.min("location_id").alias("location_id"))
    )
    known = src["patient"].select(F.col("patient_id").alias("person_id"))
    if staged is not None and cursor:
        known = before_cursor(known, "person_id", staged)
    seen = seen.join(known, "person_id", "left_semi")
    if staged is not None:
        seen = anti_staged(seen.withColumn("parent_location_uuid", F.lit(parent_location)), staged, ["person_id", "parent_location_uuid"])
        seen = seen.drop("parent_location_uuid")
    places = src["location"].select("location_id", F.col("name").alias("location_name"))
    rows = with_person(seen.join(dimension(places), "location_id"), src, ["uuid", "voided", *PERSON_COLUMNS], staged is not None).select(
        "uuid", "person_id", *NAME_COLUMNS, "gender", "birthdate", *ADDRESS_COLUMNS, "dead", "birthdate_estimated",
        "voided", "location_id", "location_name", F.lit(parent_location).alias("parent_location_uuid"),
        F.lit(None).cast("string").alias("target_patient_uuid"), F.lit(None).cast("string").alias("response_code"),
    )
    return rows


def issued_identifiers(patients: DataFrame, pool: DataFrame, pool_key: str, parent_location: str,
                       staged: DataFrame) -> DataFrame:
    """Identifiers from a pool for the patients that have none yet, as rows to stage.

    What was issued before is read from the staged identifiers: such a patient gets no second one, and such an
    identifier is not issued again.
    """
    issued = staged.where(F.col("type_uuid") == fixed.GENERATED_IDENTIFIER_TYPE).select(
        F.col("patient_id").alias("person_id"), F.col("identifier").alias(pool_key))
    fresh = allocate(patients.select("person_id"), "person_id", pool, pool_key, issued).where(F.col(pool_key).isNotNull())
    return fresh.select(
        F.col("person_id").alias("patient_id"), F.lit(fixed.GENERATED_IDENTIFIER_TYPE).alias("type_uuid"),
        F.lit(fixed.GENERATED_IDENTIFIER_TYPE).alias("target_type_uuid"), F.col(pool_key).cast("string").alias("identifier"),
        F.lit("true").alias("preferred"), F.lit(None).cast("long").alias("location_id"), F.lit(0).alias("voided"),
        F.lit(parent_location).alias("parent_location_uuid"))


def identifiers(src: Tables, new_patients: DataFrame, parent_location: str, staged: DataFrame | None = None) -> DataFrame:
    """Identifiers in force of the new patients, all of them in one join."""
    spark = src["patient_identifier"].sparkSession
    active = src["patient_identifier"].where(F.col("voided") == 0)
    wanted = new_patients.select(F.col("person_id").alias("patient_id"))
    types = src["patient_identifier_type"].select(
        F.col("patient_identifier_type_id").alias("identifier_type"), F.col("uuid").alias("type_uuid")
    )
    typed = active.join(wanted, "patient_id", "left_semi").join(dimension(types), "identifier_type")
    rows = dictionaries.map_codes(typed, dictionaries.identifier_types(spark), "type_uuid", "type_uuid", default="").select(
        "patient_id", "type_uuid", "target_type_uuid",
        strip_for_type("identifier", "type_uuid", fixed.DASH_FREE_IDENTIFIER_TYPE).alias("identifier"),
        flag_text("preferred").alias("preferred"), "location_id", "voided",
        F.lit(parent_location).alias("parent_location_uuid"),
    )
    keys = ["patient_id", "type_uuid", "identifier"]
    return pick_one(rows, keys) if staged is None else new_rows(rows, staged, keys)

"""Dictionaries and locations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.functions import dictionaries
from chartmill.operators.choose import first_by_name
from chartmill.operators.lookups import new_rows
from chartmill.sources.readers import read_concept_dictionary
from chartmill.sources.writers import upsert


def encounter_mapping(encounter_types: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """The type dictionary for every source encounter type, put into the staged mapping."""
    spark = encounter_types.sparkSession
    types = encounter_types.select("encounter_type_id").distinct()
    fresh = dictionaries.map_codes(types, dictionaries.encounter_types(spark), "encounter_type_id", "encounter_type_id")
    return fresh if staged is None else upsert(staged, fresh, ["encounter_type_id"])


def parent_locations(locations: DataFrame) -> DataFrame:
    """Locations some other location names as its parent, by name."""
    parents = locations.select(F.col("parent_location").alias("location_id")).where(F.col("location_id").isNotNull())
    return (
        locations.join(parents.distinct(), "location_id", "left_semi")
        .select("location_id", "name", "description", "parent_location")
        .orderBy("name", "location_id")
    )


def staged_locations(locations: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """Every location with its parent's id, uuid and name, active; a top location is its own parent.

    A location that is staged already is only set active again.
    """
    parents = locations.select(
        F.col("location_id").alias("parent_id"), F.col("uuid").alias("parent_uuid"), F.col("name").alias("parent_name"))
    children = locations.withColumn("parent_id", F.coalesce("parent_location", "location_id"))
    rows = children.join(parents, "parent_id", "left").select(
        F.col("location_id").alias("child_id"), F.col("uuid").alias("child_uuid"), F.col("name").alias("child_name"),
        "parent_id", "parent_uuid", "parent_name", F.lit(None).cast("string").alias("facility_code"),
        F.lit(1).alias("status"),
    )
    if staged is None:
        return rows
    listed = rows.select("child_uuid", F.lit(True).alias("_listed")).distinct()
    active = F.when(F.col("_listed"), F.lit(1)).otherwise(F.col("status"))
    kept = staged.join(listed, "child_uuid", "left").withColumn("status", active).drop("_listed")
    return kept.unionByName(new_rows(rows, staged, ["child_uuid"], ["child_id"]))


def location_picker(staged: DataFrame) -> DataFrame:
    """One staged location per parent name, by name regardless of case."""
    return first_by_name(staged, "parent_name", ["child_id"])


def children_of(staged: DataFrame, parent_uuid: str, status: int = 1) -> DataFrame:
    return staged.where((F.col("parent_uuid") == parent_uuid) & (F.col("status") == status))


def concept_dictionary(spark: SparkSession, path: str, staged: DataFrame | None = None,
                       header: Mapping[str, str] | None = None) -> DataFrame:
    """Load the dictionary file; lines whose source concept is staged already are skipped."""
    rows = read_concept_dictionary(spark, path, header)
    if staged is None:
        return rows
    known = staged.select("source_concept_id").distinct()
    return rows.join(known, "source_concept_id", "left_anti").select(*rows.columns)

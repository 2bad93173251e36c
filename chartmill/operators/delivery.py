"""Delivery state: what is pending, what may be sent, and what the receiving system answered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed
from chartmill.operators.lookups import lookup_first

READY, BLOCKED, REFUSED, PENDING, DELIVERED, REJECTED = (
    "ready", "blocked", "refused", "pending", "delivered", "rejected",
)

# How an answer changes a row: `always` keeps any code; `created` keeps code and uuid of a 201 only and leaves
# the row pending otherwise, so that it is sent again.
ALWAYS, CREATED_ONLY = "always", "created"


def pending(df: DataFrame, response: str = "response_code") -> DataFrame:
    return df.where(F.col(response).isNull())


def apply_responses(rows: DataFrame, ledger: DataFrame, key: str, rule: str, target: str = "target_uuid") -> DataFrame:
    """Write the newest answer of each row back on it.

    `ledger` has (key, attempt, code, uuid).  `rows` gains or keeps `response_code` and the `target` column.
    Under `created` the newest 201 counts, whatever came after it.  The ledger is reduced to one answer per key before
    the join, and map-side before the shuffle.
    """
    first = (F.col("code") == fixed.CREATED) if rule == CREATED_ONLY else F.lit(True)
    newest = (
        ledger.groupBy(F.col(key).alias("_key"))
        .agg(F.max(F.struct(F.coalesce(first, F.lit(False)).alias("first"), "attempt", "code", "uuid")).alias("_answer"))
        .select("_key", F.col("_answer.code").alias("_code"), F.col("_answer.uuid").alias("_uuid"))
    )
    old_code = F.col("response_code") if "response_code" in rows.columns else F.lit(None).cast("string")
    old_uuid = F.col(target) if target in rows.columns else F.lit(None).cast("string")
    created = F.col("_code") == fixed.CREATED
    if rule == ALWAYS:
        code = F.coalesce(F.col("_code"), old_code)
    elif rule == CREATED_ONLY:
        code = F.when(created, F.col("_code")).otherwise(old_code)
    else:
        raise ValueError(f"unknown rule {rule}")
    uuid = F.when(created, F.col("_uuid")).otherwise(old_uuid)
    joined = rows.join(newest, rows[key] == F.col("_key"), "left")
    return joined.withColumns({"response_code": code, target: uuid}).drop("_key", "_code", "_uuid")


def delivery_state(response: Column | str = "response_code") -> Column:
    code = F.col(response) if isinstance(response, str) else response
    return F.when(code.isNull(), PENDING).when(code == fixed.CREATED, DELIVERED).otherwise(REJECTED)


def gate_encounters(encounters: DataFrame, patients: DataFrame, visits: DataFrame) -> DataFrame:
    """An encounter may go when its patient is staged and its visit, if it has one, was delivered.

    Staged visits are unique by visit id; a person may be staged under several parent locations.
    """
    known = lookup_first(encounters, patients.withColumn("_staged", F.lit(True)), {"patient_id": "person_id"},
                         {"_staged": "_staged", "target_patient_uuid": "target_patient_uuid"})
    known = lookup_first(known, visits.withColumn("_visit", F.lit(True)), {"visit_id": "visit_id"},
                         {"_visit": "_visit", "response_code": "_visit_code", "target_visit_uuid": "target_visit_uuid"},
                         unique=True)
    reason = (
        F.when(F.col("_staged").isNull(), "patient not staged")
        .when(F.col("visit_id").isNull(), F.lit(None).cast("string"))
        .when(F.col("_visit").isNull(), "visit not staged")
        .when(F.col("_visit_code") == fixed.CREATED, F.lit(None).cast("string"))
        .otherwise("visit not delivered")
    )
    return (
        known.withColumn("reason", reason)
        .withColumn("state", F.when(F.col("reason").isNull(), READY).otherwise(BLOCKED))
        .drop("_staged", "_visit", "_visit_code")
    )


def gate_visits(visits: DataFrame, patients: DataFrame) -> DataFrame:
    """An undelivered visit may go when its patient has a target uuid; a staged patient without one refuses it."""
    known = lookup_first(visits.drop("target_patient_uuid"), patients.withColumn("_staged", F.lit(True)),
                         {"patient_id": "person_id"}, {"_staged": "_staged", "target_patient_uuid": "_uuid"})
    state = (
        F.when(F.col("target_visit_uuid").isNotNull(), DELIVERED)
        .when(F.col("_staged").isNull(), BLOCKED)
        .when(F.col("_uuid").isNotNull(), READY)
        .otherwise(REFUSED)
    )
    return (
        known.withColumn("state", state)
        .withColumn("target_patient_uuid",
                    F.when(F.col("state") == REFUSED, fixed.PATIENT_MISSING).otherwise(F.col("_uuid")))
        .withColumn("response_code",
                    F.when(F.col("state") == REFUSED, fixed.REJECTED).otherwise(F.col("response_code")))
        .drop("_staged", "_uuid")
    )


def gate_programs(programs: DataFrame, require: str = "any") -> DataFrame:
    """An enrolment may go when its program is mapped or its patient is known (`require='all'`: both)."""
    mapped = F.coalesce(F.col("target_program_uuid"), F.lit("")) != ""
    known = F.col("target_patient_uuid").isNotNull()
    passes = {"any": mapped | known, "all": mapped & known}[require]
    return programs.withColumn("state", F.when(passes, READY).otherwise(REFUSED)).withColumn(
        "response_code", F.when(passes, F.col("response_code")).otherwise(fixed.REJECTED)
    )

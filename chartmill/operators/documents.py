"""Nested JSON documents for the receiving system, one per row, built with struct and to_json.

`to_json` leaves out null fields, so an absent value is an absent field.  Every document is built from its own
row only; nothing carries over from the row before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed
from chartmill.functions.columns import flag_text

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def time_text(col: Column | str) -> Column:
    return F.date_format(col, TIME_FORMAT)


def date_text(col: Column | str) -> Column:
    return F.date_format(col, DATE_FORMAT)


def _names() -> Column:
    return F.array(
        F.struct(
            F.col("given_name").alias("givenName"),
            F.col("family_name").alias("familyName"),
            F.col("middle_name").alias("middleName"),
        )
    )


def _person(addresses: Sequence[str]) -> Column:
    fields = [F.col(source).alias(f"address{i}") for i, source in enumerate(addresses, start=1)]
    return F.struct(
        F.col("gender"),
        date_text("birthdate").alias("birthdate"),
        flag_text("birthdate_estimated").alias("birthdateEstimated"),
        flag_text("dead").alias("dead"),
        _names().alias("names"),
        F.array(F.struct(*fields)).alias("addresses"),
    )


def patient_documents(patients: DataFrame, generated: str = "generated_identifier") -> DataFrame:
    """(person_id, document): one registration per patient, with the generated identifier.

    All other identifiers are documents of their own (`identifier_documents`), so a document has the same shape and
    size however many a patient has.
    """
    document = F.struct(
        F.array(_identifier(F.col(generated), F.lit(fixed.GENERATED_IDENTIFIER_TYPE), "true")).alias("identifiers"),
        _person(["address1", "address1", "address4", "address4"]).alias("person"),
    )
    return patients.select("person_id", F.to_json(document).alias("document"))


def identifier_documents(identifiers: DataFrame) -> DataFrame:
    """(person_id, identifier, document): one document per staged identifier whose type is mapped."""
    mapped = identifiers.where(F.coalesce(F.col("target_type_uuid"), F.lit("")) != "")
    document = _identifier(F.col("identifier"), F.col("target_type_uuid"), "false")
    return mapped.select(F.col("patient_id").alias("person_id"), "identifier", F.to_json(document).alias("document"))


def _identifier(value: Column, kind: Column, preferred: str) -> Column:
    return F.struct(
        value.alias("identifier"),
        kind.alias("identifierType"),
        F.lit(fixed.DOCUMENT_LOCATION).alias("location"),
        F.lit(preferred).alias("preferred"),
    )


def user_documents(users: DataFrame) -> DataFrame:
    """(user_id, document); no password is written."""
    document = F.struct(
        F.col("username"),
        _person(["address1", "address4", "address4", "address4"]).alias("person"),
        F.array(F.lit(fixed.USER_ROLE)).alias("roles"),
    )
    return users.select("user_id", F.to_json(document).alias("document"))


def program_documents(programs: DataFrame) -> DataFrame:
    """(patient_id, patient_program_id, document); open-ended programs carry no completion date."""
    completed = F.when(~F.col("program_id").isin(*fixed.OPEN_ENDED_PROGRAM_IDS), time_text("date_completed"))
    document = F.struct(
        F.col("target_patient_uuid").alias("patient"),
        F.col("target_program_uuid").alias("program"),
        time_text("date_enrolled").alias("dateEnrolled"),
        completed.alias("dateCompleted"),
    )
    return programs.select("patient_id", "patient_program_id", F.to_json(document).alias("document"))


def visit_documents(visits: DataFrame) -> DataFrame:
    document = F.struct(
        F.col("target_patient_uuid").alias("patient"),
        F.lit(fixed.VISIT_TYPE).alias("visitType"),
        time_text("date_started").alias("startDatetime"),
        time_text("date_stopped").alias("stopDatetime"),
    )
    return visits.select("visit_id", F.to_json(document).alias("document"))


def encounter_documents(encounters: DataFrame) -> DataFrame:
    """(encounter_id, document); the visit is left out where the encounter has none."""
    document = F.struct(
        F.col("target_patient_uuid").alias("patient"),
        F.col("target_type_uuid").alias("encounterType"),
        F.lit(fixed.DOCUMENT_LOCATION).alias("location"),
        time_text("encounter_datetime").alias("encounterDatetime"),
        F.when(F.col("visit_id").isNotNull(), F.col("target_visit_uuid")).alias("visit"),
    )
    return encounters.select("encounter_id", F.to_json(document).alias("document"))


def order_documents(orders: DataFrame, id_field: str = "targetOrderId", uuid_field: str = "sourceUuid") -> DataFrame:
    """(order_id, document); the receiver's names of the two id fields can be given."""
    document = F.struct(
        F.col("target_patient_uuid").alias("patient"),
        F.col("target_order_uuid").alias(id_field),
        F.col("order_number").alias("orderNumber"),
        F.col("order_type_id").alias("orderType"),
        F.col("urgency"),
        F.col("orderer"),
        F.col("order_reason").alias("orderReason"),
        F.col("uuid").alias(uuid_field),
        F.lit(fixed.CARE_SETTING).alias("careSettings"),
    )
    return orders.select("order_id", F.to_json(document).alias("document"))


def encounter_bundles(encounters: DataFrame, obs: DataFrame) -> DataFrame:
    """(encounter_id, document) with provider, visit and observations nested.

    Every observation given is rendered.  The staged ones hold one per person, encounter and concept, so the array of
    an encounter is as long as what was asked in it.
    """
    listed = obs.groupBy("encounter_id").agg(
        F.sort_array(F.collect_list(F.struct("concept_id", "person_uuid", "value"))).alias("_listed")
    )
    entries = F.transform(
        F.col("_listed"),
        lambda o: F.struct(
            o["person_uuid"].alias("person"), o["concept_id"].cast("string").alias("concept"), o["value"].alias("value")
        ),
    )
    document = F.struct(
        F.array(
            F.struct(F.col("provider_uuid").alias("provider"), F.lit(fixed.ENCOUNTER_ROLE).alias("encounterRole"))
        ).alias("encounterProviders"),
        F.col("target_patient_uuid").alias("patient"),
        time_text("encounter_datetime").alias("encounterDatetime"),
        F.lit(fixed.BUNDLE_ENCOUNTER_TYPE).alias("encounterType"),
        F.lit(fixed.BUNDLE_FORM).alias("form"),
        F.lit(fixed.DOCUMENT_LOCATION).alias("location"),
        F.struct(
            F.col("target_patient_uuid").alias("patient"),
            F.lit(fixed.BUNDLE_VISIT_TYPE).alias("visitType"),
            time_text("encounter_datetime").alias("startDatetime"),
            time_text("encounter_datetime").alias("stopDatetime"),
        ).alias("visit"),
        F.coalesce(entries, F.array().cast("array<struct<person:string,concept:string,value:double>>")).alias("obs"),
    )
    return encounters.join(listed, "encounter_id", "left").select(
        "encounter_id", F.to_json(document).alias("document")
    )


def read_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """Pull the created uuid, the person's uuid and the issued identifier out of answer texts."""
    shape = "uuid string, person struct<uuid:string>, results array<struct<identifierValue:string>>"
    parsed = F.from_json(F.col(body), shape)
    return df.withColumn("_parsed", parsed).withColumns({
        "uuid": F.coalesce(F.col("_parsed.uuid"), F.lit(fixed.UUID_NOT_FOUND)),
        "person_uuid": F.col("_parsed.person.uuid"),
        "identifier_value": F.get(F.col("_parsed.results"), 0)["identifierValue"],
    }).drop("_parsed")


def read_responses_or_reject(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """What `read_responses` gives for answers that are readable, and the others as they are, with a `reason`.

    Every answer is in one of the two.  An answer that lacks a uuid is readable; a null one is not.
    """
    shape = "uuid string, person struct<uuid:string>, results array<struct<identifierValue:string>>"
    broken = F.from_json(F.col(body), f"{shape}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})["_broken"]
    text = F.trim(F.col(body))
    reason = (
        F.when(F.coalesce(text, F.lit("")) == "", "no answer")
        .when(~text.startswith("{"), "not an object")
        .when(broken.isNotNull(), "unreadable")
    )
    told = df.withColumn("reason", reason)
    return read_responses(told.where("reason is null").drop("reason"), body), told.where("reason is not null")

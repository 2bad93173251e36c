"""Column types of the clinical source tables and of the staged entities.

Measures, keys and times keep their native types; they turn into text only inside a rendered document.
Times are zone-free, so results do not depend on the session time zone.
"""

from pyspark.sql.types import StructType

SOURCE_DDL = {
    "encounter": """encounter_id long, uuid string, patient_id long, encounter_type int,
        encounter_datetime timestamp_ntz, location_id long, visit_id long, form_id int, creator long, voided int""",
    "encounter_type": "encounter_type_id int, name string",
    "obs": """person_id long, encounter_id long, concept_id long, obs_datetime timestamp_ntz, value_coded long,
        value_datetime timestamp_ntz, value_numeric double, value_text string, location_id long, voided int""",
    "concept": "concept_id long, uuid string, datatype_id int",
    "concept_name": """concept_id long, name string, locale string, locale_preferred int,
        concept_name_type string""",
    "concept_datatype": "concept_datatype_id int, name string",
    "location": "location_id long, uuid string, name string, description string, parent_location long",
    "patient": "patient_id long",
    "person": """person_id long, uuid string, gender string, birthdate date, birthdate_estimated int, dead int,
        voided int""",
    "person_name": "person_id long, given_name string, family_name string, middle_name string",
    "person_address": """person_id long, address1 string, county_district string, address4 string,
        address5 string, address6 string""",
    "patient_identifier": """patient_id long, identifier string, identifier_type int, preferred int,
        voided int, location_id long""",
    "patient_identifier_type": "patient_identifier_type_id int, uuid string",
    "users": "user_id long, person_id long, uuid string, system_id string, username string",
    "patient_program": """patient_program_id long, patient_id long, program_id int, uuid string,
        location_id long, date_enrolled timestamp_ntz, date_completed timestamp_ntz""",
    "program": "program_id int, uuid string, name string, concept_id long",
    "visit": """visit_id long, visit_type_id int, date_started timestamp_ntz, date_stopped timestamp_ntz,
        voided int""",
    "orders": """order_id long, uuid string, order_type_id int, concept_id long, patient_id long, orderer long,
        encounter_id long, instructions string, order_reason int, order_reason_non_coded string, urgency string,
        order_number string, order_action string, care_setting int, date_created timestamp_ntz""",
    "form": "form_id int",
    "flat_summary": """person_id long, encounter_id long, enrollment_date date, hiv_start_date date,
        death_date date, transfer_out int, transfer_out_date date, is_clinical_encounter int,
        next_clinical_datetime_hiv timestamp_ntz, location_id long""",
}

STAGED_DDL = {
    "users": """uuid string, user_id long, system_id string, username string, given_name string,
        family_name string, middle_name string, gender string, birthdate date, address1 string,
        county_district string, address4 string, address5 string, address6 string, dead int,
        birthdate_estimated int, parent_location_uuid string, response_code string""",
    "patients": """uuid string, person_id long, given_name string, family_name string, middle_name string,
        gender string, birthdate date, address1 string, county_district string, address4 string,
        address5 string, address6 string, dead int, birthdate_estimated int, voided int, location_id long,
        location_name string, parent_location_uuid string, target_patient_uuid string, response_code string""",
    "identifiers": """patient_id long, type_uuid string, target_type_uuid string, identifier string,
        preferred string, location_id long, voided int, parent_location_uuid string""",
    "programs": """patient_id long, patient_program_id long, program_id int, program_uuid string,
        program_name string, concept_id long, location_id long, location_uuid string,
        date_enrolled timestamp_ntz, date_completed timestamp_ntz, target_patient_uuid string,
        target_program_uuid string, parent_location_uuid string, response_code string""",
    "encounters": """patient_id long, encounter_id long, encounter_type_id int, encounter_name string,
        encounter_datetime timestamp_ntz, location_id long, visit_id long, target_type_id int,
        target_type_uuid string, response_code string""",
    "encounter_mapping": "encounter_type_id int, target_type_id int, target_type_uuid string",
    "enrollments": """person_id long, encounter_id long, enrollment_date date, hiv_start_date date,
        death_date date, transfer_out int, transfer_out_date date""",
    "hiv_enrollment": """person_id long, encounter_id long, concept_id long, encounter_datetime timestamp_ntz,
        encounter_type int, encounter_name string, location_uuid string, concept_name string,
        obs_datetime timestamp_ntz, value string, value_type string, datatype_id int, provider_id long,
        category string, target_concept_uuid string, target_value string, response_code string""",
    "visits": """visit_id long, patient_id long, visit_type_id int, date_started timestamp_ntz,
        date_stopped timestamp_ntz, location_id long, voided int, target_patient_uuid string,
        target_visit_uuid string, response_code string""",
    "orders": """order_id long, uuid string, order_type_id int, concept_id long, patient_id long,
        encounter_id long, encounter_type_id int, orderer string, instructions string, urgency string,
        order_reason string, order_reason_non_coded string, order_number string, order_action string,
        care_setting string, date_created timestamp_ntz, target_type_uuid string, target_patient_uuid string,
        target_reason_uuid string, target_order_uuid string, response_code string""",
    "triage": """person_id long, encounter_id long, encounter_datetime timestamp_ntz, visit_id long,
        location_id long, obs_datetime timestamp_ntz, height_age_zscore double, weight_height_zscore double,
        bmi_age_zscore double, bmi double, muac_mm double, systolic_bp double, diastolic_bp double, pulse double,
        temperature double, spo2 double, rr double, weight double, height double""",
    "regimen_switch": """person_id long, encounter_id long, concept_id long, obs_datetime timestamp_ntz,
        value string, value_type string, datatype_id int, response_code string""",
    "obs": """uuid string, person_id long, encounter_id long, concept_id long, encounter_datetime timestamp_ntz,
        encounter_type int, encounter_name string, obs_datetime timestamp_ntz, value string, value_type string,
        target_value string, target_concept_uuid string, target_encounter_uuid string""",
    "concept_dictionary": """source_parent string, source_label string, source_concept_uuid string,
        source_concept_id string, concept_type string, ciel string, target_parent string, target_label string,
        target_concept_uuid string, target_concept_id string""",
    "locations": """child_id long, child_uuid string, child_name string, parent_id long, parent_uuid string,
        parent_name string, facility_code string, status int""",
}

# What makes a staged row of each entity the same row again.
STAGED_KEYS = {
    "users": ["uuid", "parent_location_uuid"],
    "patients": ["person_id", "parent_location_uuid"],
    "identifiers": ["patient_id", "type_uuid", "identifier"],
    "programs": ["patient_id", "program_id"],
    "encounters": ["patient_id", "encounter_id"],
    "encounter_mapping": ["encounter_type_id"],
    "enrollments": ["person_id"],
    "hiv_enrollment": ["person_id", "encounter_id", "concept_id"],
    "visits": ["visit_id"],
    "orders": ["uuid"],
    "triage": ["person_id", "encounter_id"],
    "regimen_switch": ["person_id", "encounter_id", "concept_id"],
    "obs": ["person_id", "encounter_id", "concept_id"],
    "concept_dictionary": ["source_concept_id"],
    "locations": ["child_id"],
}
# Entities whose source has no uuid that could be kept; staging gives them one.
GIVEN_UUID = ("programs", "enrollments")


def source_schema(name: str) -> StructType:
    return StructType.fromDDL(SOURCE_DDL[name])


def staged_schema(name: str) -> StructType:
    return StructType.fromDDL(STAGED_DDL[name])


def stored_schema(name: str) -> StructType:
    """A staged entity as it is stored: with its generated id and the number of the load that brought the row."""
    given = "uuid string, " if name in GIVEN_UUID else ""
    return StructType.fromDDL(f"{STAGED_DDL[name]}, {given}id string, load_number long")

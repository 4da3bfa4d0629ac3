"""Nested resources -> flat tables. Each function takes the raw rows and returns the flat rows; lines that
did not parse give none (``split_ndjson`` keeps them)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions import dig, los_hours, parse_date, parse_instant, strip_prefix
from clinflow.operators.dedup import dedup_first, explode_entries
from clinflow.sources.ndjson import parsed

# Fixed value: marks the coding system whose observations are kept.
LOINC_SYSTEM = "loinc.org"


def flatten_patients(raw: DataFrame) -> DataFrame:
    return parsed(raw).select(
        F.col("id").alias("patient_id"),
        "gender",
        F.col("birthDate").alias("birth_date"),
        dig("name[].family").alias("name_family"),
        dig("name[].given[]").alias("name_given"),
        dig("address[].city").alias("city"),
        dig("address[].state").alias("state"),
        dig("address[].country").alias("country"),
        dig("maritalStatus.text").alias("marital_status"),
    )


def flatten_encounters(raw: DataFrame) -> DataFrame:
    """One row per encounter. Of several types the first one counts, so the array is indexed
    rather than exploded: the shuffle of the de-duplication carries one row per input line."""
    start, end = parse_instant(dig("period.start")), parse_instant(dig("period.end"))
    flat = parsed(raw).select(
        F.col("id").alias("encounter_id"),
        strip_prefix(dig("subject.reference"), "Patient").alias("patient_id"),
        "status",
        dig("class.code").alias("encounter_class"),
        dig("type[].text").alias("encounter_type"),
        dig("type[].coding[].code").alias("encounter_snomed_code"),
        dig("episodeOfCare[].reference").alias("episode_of_care_ref"),
        start.alias("admit_timestamp"),
        end.alias("discharge_timestamp"),
        los_hours(start, end).alias("los_hours"),
        dig("serviceProvider.display").alias("service_provider"),
        dig("location[].location.display").alias("location_display"),
        dig("reasonCode[].coding[].display").alias("reason_for_visit"),
    )
    return dedup_first(flat, ["encounter_id"])


def flatten_conditions(raw: DataFrame) -> DataFrame:
    """One row per condition and coding system."""
    coding = F.col("_coding")
    flat = explode_entries(parsed(raw), dig("code.coding"), "_coding").select(
        F.col("id").alias("condition_id"),
        strip_prefix(dig("subject.reference"), "Patient").alias("patient_id"),
        strip_prefix(dig("encounter.reference"), "Encounter").alias("encounter_id"),
        coding["system"].alias("coding_system"),
        coding["code"].alias("diagnosis_code"),
        coding["display"].alias("diagnosis_description"),
        dig("clinicalStatus.coding[].code").alias("clinical_status"),
        dig("verificationStatus.coding[].code").alias("verification_status"),
        dig("category[].coding[].display").alias("category"),
        parse_instant(F.col("onsetDateTime")).alias("onset_date"),
        parse_instant(F.col("abatementDateTime")).alias("abatement_date"),
        parse_date(F.col("recordedDate")).alias("recorded_date"),
        F.col("abatementDateTime").isNotNull().alias("is_resolved"),
        "_pos",
    )
    return dedup_first(flat, ["condition_id", "coding_system"], ["_pos"]).drop("_pos")


def flatten_observations(raw: DataFrame) -> DataFrame:
    """One row per observation and LOINC code. Other codings are removed inside the array, before
    it is expanded."""
    loinc = F.filter(dig("code.coding"), lambda c: c["system"].contains(LOINC_SYSTEM))
    coding = F.col("_coding")
    flat = parsed(raw).select("*", F.posexplode(loinc).alias("_pos", "_coding")).select(
        F.col("id").alias("observation_id"),
        strip_prefix(dig("subject.reference"), "Patient").alias("patient_id"),
        strip_prefix(dig("encounter.reference"), "Encounter").alias("encounter_id"),
        "status",
        coding["code"].alias("loinc_code"),
        coding["display"].alias("observation_name"),
        dig("category[].coding[].code").alias("obs_category"),
        parse_instant(F.col("effectiveDateTime")).alias("effective_datetime"),
        dig("valueQuantity.value").cast("double").alias("result_value"),
        dig("valueQuantity.unit").alias("result_unit"),
        dig("valueCodeableConcept.text").alias("result_text"),
        "_pos",
    )
    return dedup_first(flat, ["observation_id", "loinc_code"], ["_pos"]).drop("_pos")


def flatten_episodes(raw: DataFrame) -> DataFrame:
    return parsed(raw).select(
        F.col("id").alias("episode_id"),
        strip_prefix(dig("patient.reference"), "Patient").alias("patient_id"),
        F.col("status").alias("episode_status"),
        dig("type[].coding[].display").alias("episode_type"),
        parse_instant(dig("period.start")).alias("episode_start"),
        parse_instant(dig("period.end")).alias("episode_end"),
    )


# Flat table -> (resource, flattener).
FLATTENERS = {
    "dim_patients": ("Patient", flatten_patients),
    "fact_encounters": ("Encounter", flatten_encounters),
    "dim_diagnoses": ("Condition", flatten_conditions),
    "dim_observations": ("Observation", flatten_observations),
    "dim_episodes": ("EpisodeOfCare", flatten_episodes),
}

"""Declared schemas, keys and links. Reading with these avoids schema-inference jobs."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, StringType, StructField,
    StructType, TimestampType,
)

CORRUPT = "_corrupt_record"

TEXT, REAL, WHOLE, FLAG = StringType(), DoubleType(), IntegerType(), BooleanType()
INSTANT, DAY = TimestampType(), DateType()


def _struct(*texts: str, **fields: DataType) -> StructType:
    """Text fields by name, then typed fields."""
    return StructType([StructField(t, TEXT) for t in texts]
                      + [StructField(name, kind) for name, kind in fields.items()])


def _columns(*fields: tuple[str, DataType] | str) -> StructType:
    """Ordered columns; a bare name is text."""
    return StructType([
        StructField(f, TEXT) if isinstance(f, str) else StructField(*f) for f in fields])


_CODE = ArrayType(_struct("code"))
_SHOWN = ArrayType(_struct("display"))
_CODINGS = _struct(coding=ArrayType(_struct("system", "code", "display")))
_REFERENCE = _struct("reference")
_PERIOD = _struct("start", "end")

# Nested resources: only the fields that are read, so the JSON parser skips everything else.
RESOURCES = {
    "Patient": _struct(
        "id", "gender", "birthDate",
        name=ArrayType(_struct("family", given=ArrayType(TEXT))),
        address=ArrayType(_struct("city", "state", "country")),
        maritalStatus=_struct("text"),
    ),
    "Encounter": _struct(
        "id", "status", **{"class": _struct("code")},
        type=ArrayType(_struct("text", coding=_CODE)),
        subject=_REFERENCE,
        episodeOfCare=ArrayType(_REFERENCE),
        period=_PERIOD,
        serviceProvider=_struct("display"),
        location=ArrayType(_struct(location=_struct("display"))),
        reasonCode=ArrayType(_struct(coding=_SHOWN)),
    ),
    "Condition": _struct(
        "id", "onsetDateTime", "abatementDateTime", "recordedDate",
        subject=_REFERENCE, encounter=_REFERENCE, code=_CODINGS,
        clinicalStatus=_struct(coding=_CODE),
        verificationStatus=_struct(coding=_CODE),
        category=ArrayType(_struct(coding=_SHOWN)),
    ),
    "Observation": _struct(
        "id", "status", "effectiveDateTime",
        subject=_REFERENCE, encounter=_REFERENCE, code=_CODINGS,
        category=ArrayType(_struct(coding=_CODE)),
        valueQuantity=_struct(value=REAL, unit=TEXT),
        valueCodeableConcept=_struct("text"),
    ),
    "EpisodeOfCare": _struct(
        "id", "status", patient=_REFERENCE,
        type=ArrayType(_struct(coding=_SHOWN)),
        period=_PERIOD,
    ),
}

# Star schema after the load.
TABLES = {
    "dim_patients": _columns(
        "patient_id", "gender", "birth_date", "name_family", "name_given", "city", "state",
        "country", "marital_status"),
    "dim_loinc_reference": _columns(
        "loinc_code", "observation_name", "obs_category", "result_unit",
        ("normal_low", REAL), ("normal_high", REAL)),
    "dim_diagnoses": _columns(
        "condition_id", "patient_id", "encounter_id", "coding_system", "diagnosis_code",
        "diagnosis_description", "clinical_status", "verification_status", "category",
        ("onset_date", INSTANT), ("abatement_date", INSTANT), ("recorded_date", DAY),
        ("is_resolved", FLAG)),
    "dim_clinical_observations": _columns(
        "observation_id", "patient_id", "encounter_id", "status", "loinc_code",
        "observation_name", "obs_category", ("effective_datetime", INSTANT),
        ("result_value", REAL), "result_unit", "result_text", ("is_abnormal", FLAG)),
    "dim_episodes": _columns(
        "episode_id", "patient_id", "episode_status", "episode_type",
        ("episode_start", INSTANT), ("episode_end", INSTANT), ("episode_los_hours", REAL)),
    "fact_patient_encounters": _columns(
        "encounter_id", "patient_id", "status", "encounter_class", "encounter_type",
        "encounter_snomed_code", "episode_of_care_ref", ("admit_timestamp", INSTANT),
        ("discharge_timestamp", INSTANT), ("los_hours", REAL), ("los_days", REAL),
        ("admit_year", WHOLE), ("admit_month", WHOLE), ("admit_hour", WHOLE), "admit_dow",
        "service_provider", "location_display", "reason_for_visit", ("is_inpatient", FLAG),
        ("is_emergency", FLAG), ("is_readmission_30d", FLAG), ("days_since_last_enc", REAL)),
}

_DERIVED = {
    "is_abnormal", "episode_los_hours", "los_days", "admit_year", "admit_month", "admit_hour",
    "admit_dow", "is_inpatient", "is_emergency", "is_readmission_30d", "days_since_last_enc",
}


def _flat(table: str) -> StructType:
    return StructType([f for f in TABLES[table].fields if f.name not in _DERIVED])


# Flattened resources, before the load derives its columns.
FLAT = {
    "dim_patients": _flat("dim_patients"),
    "fact_encounters": _flat("fact_patient_encounters"),
    "dim_diagnoses": _flat("dim_diagnoses"),
    "dim_observations": _flat("dim_clinical_observations"),
    "dim_episodes": _flat("dim_episodes"),
}

KEYS = {
    "dim_patients": ["patient_id"],
    "dim_loinc_reference": ["loinc_code"],
    "dim_diagnoses": ["condition_id", "coding_system"],
    "dim_clinical_observations": ["observation_id", "loinc_code"],
    "dim_episodes": ["episode_id"],
    "fact_patient_encounters": ["encounter_id"],
}

# Many-to-one links (child table, parent table, shared key).
LINKS = [
    ("fact_patient_encounters", "dim_patients", "patient_id"),
    ("dim_diagnoses", "fact_patient_encounters", "encounter_id"),
    ("dim_clinical_observations", "fact_patient_encounters", "encounter_id"),
    ("analytics_readmissions", "fact_patient_encounters", "encounter_id"),
    ("analytics_throughput", "fact_patient_encounters", "encounter_id"),
]

# Tables handed to the dashboard as CSV. dim_episodes is added to the nine usual ones because
# the episode page needs it.
EXPORTS = [
    "fact_patient_encounters", "dim_patients", "dim_diagnoses", "dim_clinical_observations",
    "dim_loinc_reference", "dim_episodes", "analytics_readmissions", "analytics_throughput",
    "analytics_lab_kpis", "mart_los_kpis",
]

STAGED_COLUMNS = [
    "encounter_id", "patient_id", "status", "encounter_class", "encounter_type",
    "admit_timestamp", "discharge_timestamp", "los_hours", "los_days", "admit_year",
    "admit_month", "admit_hour", "admit_dow", "service_provider", "location_display",
    "reason_for_visit", "is_inpatient", "is_emergency", "episode_of_care_ref",
]

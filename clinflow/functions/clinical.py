"""Labels, tiers and flags."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Encounter class code -> label.
CLASS_LABELS = {
    "IMP": "Inpatient",
    "EMER": "Emergency",
    "AMB": "Ambulatory",
    "HH": "Home Health",
    "VR": "Virtual",
}
OTHER_CLASS = "Other"

# Shift label -> first and last admission hour; other hours are the night shift.
SHIFTS = {
    "Day shift (07-15)": (7, 14),
    "Evening shift (15-23)": (15, 22),
}
NIGHT_SHIFT = "Night shift (23-07)"

# Length-of-stay tier -> upper bound in hours (exclusive).
LOS_TIERS = {
    "< 4h": 4,
    "4-24h": 24,
    "1-3 days": 72,
    "3-7 days": 168,
    "1-4 weeks": 720,
}
LAST_TIER = "> 1 month"

# Weekend day names.
WEEKEND = ["Saturday", "Sunday"]

# Classes in the readmission analysis.
READMISSION_CLASSES = ("IMP", "EMER", "AMB")

DAY = 86400


def class_label(code: Column) -> Column:
    label = F.lit(OTHER_CLASS)
    for key, text in CLASS_LABELS.items():
        label = F.when(code == key, text).otherwise(label)
    return label


def admit_shift(hour: Column) -> Column:
    shift = F.lit(NIGHT_SHIFT)
    for text, (first, last) in SHIFTS.items():
        shift = F.when(hour.between(first, last), text).otherwise(shift)
    return shift


def los_tier(hours: Column) -> Column:
    tier = F.lit(LAST_TIER)
    for text, bound in reversed(LOS_TIERS.items()):
        tier = F.when(hours < bound, text).otherwise(tier)
    return tier


def is_weekend(day_name: Column) -> Column:
    return day_name.isin(WEEKEND)


def out_of_range(value: Column, low: Column, high: Column) -> Column:
    """Outside [low, high]; NULL when the value or a bound is missing."""
    known = value.isNotNull() & low.isNotNull() & high.isNotNull()
    return F.when(known, (value < low) | (value > high))


def within_days(gap: Column, days: int) -> Column:
    """Gap between 0 and ``days`` days, both included; a missing gap is FALSE."""
    return F.coalesce(gap.between(0, days * DAY), F.lit(False))


def readmission_bucket(gap: Column, days: Sequence[int]) -> Column:
    """First bucket that holds the gap. Overlapping stays (negative gap) fall in the first one."""
    bucket = F.lit("Not a readmission")
    for d in sorted(days, reverse=True):
        bucket = F.when(gap <= d * DAY, f"{d}-day readmission").otherwise(bucket)
    return F.when(gap.isNull(), "Initial admission").otherwise(bucket)

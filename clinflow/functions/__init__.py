"""Column expressions. All of them are built-in Spark functions, so they stay in codegen."""

from clinflow.functions.clinical import (
    admit_shift, class_label, is_weekend, los_tier, out_of_range, readmission_bucket, within_days,
)
from clinflow.functions.nested import dig, remove_text, strip_prefix
from clinflow.functions.numeric import percent, round_bin, safe_div
from clinflow.functions.temporal import (
    epoch, episode_hours, gap_seconds, los_hours, month_start, parse_date, parse_instant,
    wall_clock, weekday_name,
)

__all__ = [
    "admit_shift", "class_label", "dig", "epoch", "episode_hours", "gap_seconds", "is_weekend",
    "los_hours", "los_tier", "month_start", "out_of_range", "parse_date", "parse_instant",
    "percent", "readmission_bucket", "remove_text", "round_bin", "safe_div", "strip_prefix",
    "wall_clock", "weekday_name", "within_days",
]

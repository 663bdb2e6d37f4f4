"""Column-level functions (JVM-side expressions only; no Python UDFs)."""

from pulsevault.functions.keys import surrogate_key
from pulsevault.functions.decimals import (
    dec_sum_parts,
    dec_mean_from_parts,
    avg_dec,
    round_ratio,
    dec_to_int,
)
from pulsevault.functions.dates import (
    age_years,
    hours_between,
    days_between,
    parse_iso_ts,
    day_number,
    epoch_micros,
    ntz_from_epoch_micros,
    event_time,
)
from pulsevault.functions.text import json_scalar, contributing_list

__all__ = [
    "surrogate_key",
    "dec_sum_parts",
    "dec_mean_from_parts",
    "avg_dec",
    "round_ratio",
    "dec_to_int",
    "age_years",
    "hours_between",
    "days_between",
    "parse_iso_ts",
    "day_number",
    "epoch_micros",
    "ntz_from_epoch_micros",
    "event_time",
    "json_scalar",
    "contributing_list",
]

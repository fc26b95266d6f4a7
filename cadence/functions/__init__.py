"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from cadence.functions.calendar import calendar_parts, weekday_name
from cadence.functions.keys import surrogate_key
from cadence.functions.measures import minutes_2dp, round_minutes, strict_bigint
from cadence.functions.text import NA_TOKENS, WHITESPACE, na_to_null, normalise_name, strip_unicode

__all__ = [
    "NA_TOKENS", "WHITESPACE", "calendar_parts", "minutes_2dp", "na_to_null", "normalise_name",
    "round_minutes", "strict_bigint", "strip_unicode", "surrogate_key", "weekday_name",
]

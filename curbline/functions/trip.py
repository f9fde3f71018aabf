"""Trip features as Spark SQL expressions in text form."""

from __future__ import annotations

from collections.abc import Sequence

from curbline.functions.numeric import round_to

# Hour bands (inclusive); any other hour is LATE_BAND.
HOUR_BANDS = (
    ("morning_rush", 6, 9),
    ("midday", 10, 15),
    ("evening_rush", 16, 20),
    ("night", 21, 23),
)
LATE_BAND = "late_night"
# Service zones that count as airport pickups.
AIRPORT_SERVICE_ZONES = ("Airports", "EWR")


def text_list(words: Sequence[str]) -> str:
    """Words as a list of SQL literals."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def minutes_between(start: str, end: str) -> str:
    """Minutes from whole epoch seconds, as a double."""
    return f"(unix_timestamp({end}) - unix_timestamp({start})) / 60D"


def seconds_between(start: str, end: str) -> str:
    """Whole elapsed seconds; a part second does not count."""
    return f"timestampdiff(SECOND, {start}, {end})"


def miles_per_hour(distance: str, minutes: str) -> str:
    """NULL where no time passed."""
    return f"case when {minutes} > 0 then {distance} / ({minutes} / 60D) end"


def trip_hash_id(fields: Sequence[str]) -> str:
    """SHA-256 over the text of the fields, NULL fields left out."""
    return f"sha2(concat_ws('|', {', '.join(f'cast({f} as string)' for f in fields)}), 256)"


def natural_key_hash(fields: Sequence[str], ordinal: str) -> str:
    """SHA-256 over fields and ordinal; NULL as soon as one field is NULL."""
    return f"sha2(concat({', \'|\', '.join(f'cast({f} as string)' for f in (*fields, ordinal))}), 256)"


def time_of_day(hour: str) -> str:
    bands = " ".join(f"when {hour} between {low} and {high} then '{name}'" for name, low, high in HOUR_BANDS)
    return f"case {bands} else '{LATE_BAND}' end"


def tip_rate(tip: str, fare: str) -> str:
    """Tip per unit of fare; 0 where the fare is missing or not positive."""
    return f"case when {fare} > 0 then {tip} / {fare} else 0D end"


def tip_percent(tip: str, fare: str) -> str:
    """Tip as a percentage, two places; NULL where the fare is not positive."""
    return f"case when {fare} > 0 then {round_to(f'({tip} / {fare} * 100)', 2)} end"


def is_weekend_dow(dow: str) -> str:
    """Weekend from the 1 = Sunday day number."""
    return f"{dow} in (1, 7)"


def is_airport_zone(service_zone: str) -> str:
    """NULL where the zone is unknown, not false."""
    return f"{service_zone} in ({text_list(AIRPORT_SERVICE_ZONES)})"


def hour_timestamp(day: str, hour: str) -> str:
    """The start of an hour as a zone-less timestamp."""
    return f"cast(timestampadd(HOUR, {hour}, cast({day} as timestamp_ntz)) as timestamp_ntz)"

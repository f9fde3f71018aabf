"""Calendar attributes of a date column, as Spark SQL expressions in text form."""

from __future__ import annotations

# Holidays that fall on the same date each year (month, day, name).
FIXED_HOLIDAYS = (
    (1, 1, "New Year's Day"),
    (7, 4, "Independence Day"),
    (11, 11, "Veterans Day"),
    (12, 25, "Christmas Day"),
)


def iso_day_of_week(day: str) -> str:
    """1 = Monday .. 7 = Sunday."""
    return f"weekday({day}) + 1"


def is_weekend(day: str) -> str:
    return f"weekday({day}) >= 5"


def year_quarter(day: str) -> str:
    return f"concat(cast(year({day}) as string), '-Q', cast(quarter({day}) as string))"


def holiday_name(day: str) -> str:
    tests = " ".join(
        f"when month({day}) = {m} and day({day}) = {d} then \"{name}\"" for m, d, name in FIXED_HOLIDAYS
    )
    return f"case {tests} end"


def calendar_columns(day: str) -> list[str]:
    """Every calendar attribute, to select next to ``day``."""
    return [
        f"year({day}) as year",
        f"month({day}) as month",
        f"day({day}) as day_of_month",
        f"{iso_day_of_week(day)} as day_of_week",
        f"weekofyear({day}) as week_of_year",
        f"quarter({day}) as quarter",
        f"date_format({day}, 'yyyy-MM') as year_month",
        f"date_format({day}, 'EEEE') as day_name",
        f"date_format({day}, 'MMMM') as month_name",
        f"{year_quarter(day)} as year_quarter",
        f"{is_weekend(day)} as is_weekend",
        f"{holiday_name(day)} as us_holiday_name",
        f"({holiday_name(day)}) is not null as is_us_holiday",
    ]

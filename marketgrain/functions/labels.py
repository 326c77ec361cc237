"""Labels that do not depend on the locale of the machine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published names of the ISO weekdays, Monday first.
WEEKDAYS = {
    "pt": (
        "Segunda-feira",
        "Terça-feira",
        "Quarta-feira",
        "Quinta-feira",
        "Sexta-feira",
        "Sábado",
        "Domingo",
    ),
    "en": (
        "Monday",
        "Tuesday",
        "Wednesday",
        "Thursday",
        "Friday",
        "Saturday",
        "Sunday",
    ),
}


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + F.lit(1)


def weekday_name(number: Column, language: str = "pt") -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS[language])), number)


def ordinal_label(prefix: str, rank: Column, width: int = 2) -> Column:
    """A label by position, such as ``Profile 01``; it carries no identifier."""
    return F.format_string(f"{prefix} %0{width}d", rank)


def month_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")

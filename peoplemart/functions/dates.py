"""Date expressions of the calendar and of the employee dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names a calendar shows, per language.
MONTH_NAMES = {
    "es": ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
           "Septiembre", "Octubre", "Noviembre", "Diciembre"],
    "en": ["January", "February", "March", "April", "May", "June", "July", "August",
           "September", "October", "November", "December"],
}
WEEKDAY_NAMES = {
    "es": ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"],
    "en": ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"],
}


def date_key(day: Column) -> Column:
    """20230115 for 2023-01-15: integer order is date order."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def inclusive_days(first: Column, last: Column) -> Column:
    """Days from first to last, counting both."""
    return F.datediff(last, first) + 1


def calendar_years(first: Column, last: Column) -> Column:
    """Year boundaries crossed between the dates, as the seniority column counts them."""
    return F.year(last) - F.year(first)


def complete_years(first: Column, last: Column) -> Column:
    """Years completed between the dates: one less while this year's anniversary is ahead."""
    years = calendar_years(first, last)
    anniversary = F.add_months(first, years * 12)
    return years - F.when(anniversary > last, 1).otherwise(0)


def half_year(day: Column) -> Column:
    return F.when(F.month(day) <= 6, 1).otherwise(2)


def month_name(day: Column, language: str) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES[language])), F.month(day))


def weekday_name(day: Column, language: str) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAY_NAMES[language])), F.dayofweek(day))

"""The calendar dimension: one row per day of a closed range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplemart.functions.dates import date_key, half_year, month_name, weekday_name


def calendar(spark: SparkSession, start: date, end: date, language: str = "es") -> DataFrame:
    """All days from start to end."""
    span = spark.range(0, 1, 1, 1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return _days(span, language)


def calendar_over(events: DataFrame, day: str, language: str = "es") -> DataFrame:
    """All days of the years from the first to the last date in a column of events."""
    span = events.agg(
        F.trunc(F.min(day), "year").alias("start"),
        F.date_sub(F.add_months(F.trunc(F.max(day), "year"), 12), 1).alias("end"))
    return _days(span, language)


def _days(span: DataFrame, language: str) -> DataFrame:
    day = F.col("FechaCompleta")
    days = F.explode(F.sequence("start", "end", F.expr("interval 1 day")))
    return span.select(days.alias("FechaCompleta")).select(
        date_key(day).alias("FechaKey"),
        day,
        F.year(day).alias("Anio"),
        half_year(day).alias("Semestre"),
        F.quarter(day).alias("Trimestre"),
        F.month(day).alias("Mes"),
        month_name(day, language).alias("NombreMes"),
        F.dayofmonth(day).alias("Dia"),
        weekday_name(day, language).alias("NombreDiaSemana"),
    )

"""Column expressions on dates, clock texts and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the four parts of the day.
DAY_BANDS = ("Nuit", "Matin", "Après-midi", "Soir")
DEFAULT_HOUR = 14


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def whole_years(day: Column | str, as_of: Column) -> Column:
    """Completed years at ``as_of``; null for a null day."""
    return F.floor(F.datediff(as_of, _c(day)) / 365.25)


def months_since(day: Column | str, as_of: Column) -> Column:
    """Months at ``as_of`` with one decimal, on a mean month of 30.44 days."""
    return F.round(F.datediff(as_of, _c(day)) / 30.44, 1)


def date_key(day: Column | str) -> Column:
    """Integer ``yyyyMMdd``; arithmetic instead of text formatting, same value."""
    day = _c(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(day: Column | str) -> Column:
    return F.date_format(_c(day), "yyyy-MM")


def hour_of_clock(clock: Column | str) -> Column:
    """Hour of an ``HH:MM:SS`` text; null when it is not one."""
    return F.split(_c(clock), ":")[0].try_cast("int")


def day_band(hour: Column | str) -> Column:
    """Part of the day.  A null hour counts as the evening, as at training time."""
    hour = _c(hour)
    night, morning, afternoon, evening = DAY_BANDS
    return (
        F.when(hour < 6, night).when(hour < 12, morning).when(hour < 18, afternoon).otherwise(evening)
    )


def is_night(hour: Column | str) -> Column:
    hour = _c(hour)
    return F.when((hour < 6) | (hour >= 22), 1).otherwise(0)


def is_weekend(day: Column | str) -> Column:
    return F.when(F.dayofweek(_c(day)).isin(1, 7), 1).otherwise(0)


def lenient_hour(text: Column | str) -> Column:
    """``struct(hour, error)`` of a hand-typed hour: ``14``, ``14.0``, ``14:32``.

    Empty means the default hour.  Exactly one of the two fields is null.
    """
    text = F.trim(_c(text).cast("string"))
    parts = F.split(text, ":")
    on_clock = text.contains(":")
    decimal = text.try_cast("double")
    minute = F.trim(F.get(parts, F.lit(1))).try_cast("int")
    hour = F.when(on_clock, F.trim(parts[0]).try_cast("int")).when(
        F.abs(decimal) < 1e9, decimal.try_cast("int")
    )
    empty = text.isNull() | (text == "")
    error = (
        F.when(empty, None)
        .when(hour.isNull() | (on_clock & minute.isNull()), F.concat(F.lit("Heure invalide : "), text))
        .when(on_clock & ~minute.between(0, 59), F.concat(F.lit("Minutes invalides : "), text))
        .when(~hour.between(0, 23), F.concat(F.lit("Heure hors limites (0-23) : "), text))
    )
    return F.struct(
        F.when(empty, DEFAULT_HOUR).when(error.isNull(), hour).alias("hour"),
        error.alias("error"),
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end`` of the one-row frame ``bounds``."""
    return bounds.select(
        F.explode(
            F.sequence(F.col("start").cast("date"), F.col("end").cast("date"), F.expr("interval 1 day"))
        ).alias("date")
    )


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """Attributes of a day, by the names of the time dimension."""
    day = _c(day)
    return {
        "date_key": date_key(day),
        "annee": F.year(day),
        "trimestre": F.quarter(day),
        "mois": F.month(day),
        "jour": F.dayofmonth(day),
        "jour_semaine": F.dayofweek(day),
        "nom_mois": F.date_format(day, "MMMM"),
        "mois_annee": year_month(day),
        "est_weekend": is_weekend(day),
    }

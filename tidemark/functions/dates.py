"""Dates: permissive parsing, weeks that begin on Monday, months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tried in order; the first that fits counts.
FORMATS = ("MM/dd/yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy")


def parsed_date(text: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """The date of a text, null where no format fits."""
    own = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(own, F.lit(f)).cast("date") for f in formats])


def monday(day: Column) -> Column:
    """The Monday of the day's week, as a date."""
    return F.date_sub(day, F.weekday(day))


def week_label(day: Column) -> Column:
    """Monday and Sunday of the week, as start/end."""
    start = monday(day)
    return F.concat_ws("/", start.cast("string"), F.date_add(start, 6).cast("string"))


def month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")

"""Date arithmetic shared by the point-in-time operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_number(day: Column) -> Column:
    """Months since year 0; the difference of two counts month boundaries."""
    return F.year(day) * 12 + F.month(day)


def months_between_boundaries(earlier: Column, later: Column) -> Column:
    return month_number(later) - month_number(earlier)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def day_floor(moment: Column) -> Column:
    return moment.cast("date")


def day_due(moment: Column) -> Column:
    """First midnight at or after the moment: `moment <= ref` iff `day_due <= ref`."""
    day = moment.cast("date")
    return F.when(moment.cast("timestamp_ntz") > day.cast("timestamp_ntz"), F.date_add(day, 1)).otherwise(day)


def epoch_text_to_timestamp(text: Column) -> Column:
    """Epoch held as text in seconds, ms or us: the first ten digits are seconds."""
    return F.timestamp_seconds(F.substring(text, 1, 10).try_cast("bigint"))

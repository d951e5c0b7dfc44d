"""Dates and times without any session time zone: timestamps are TIMESTAMP_NTZ throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

# Other spellings of a date that are rewritten to yyyy-MM-dd before parsing.
DATE_SPELLINGS = (
    (r"^(\d{4})/(\d{2})/(\d{2})", "$1-$2-$3"),
    (r"^(\d{2})/(\d{2})/(\d{4})", "$3-$1-$2"),
)


def parse_timestamp(text: Column) -> Column:
    """ISO date or date-time, yyyy/MM/dd or MM/dd/yyyy; anything else gives null instead of an error."""
    respelled = text
    for pattern, iso in DATE_SPELLINGS:
        respelled = F.regexp_replace(respelled, pattern, iso)
    return F.when(text.contains("/"), respelled).otherwise(text).try_cast("timestamp_ntz")


def month_of(day: Column) -> Column:
    return F.trunc(F.to_date(day), "month")


def month_index(day: Column) -> Column:
    """Months since year 0, so that differences are whole calendar months."""
    return F.year(day) * 12 + F.month(day)


def whole_days(reference: Column, stamp: Column) -> Column:
    """Whole 24-hour periods from ``stamp`` to midnight of ``reference``, rounded down (may be -1)."""
    day = F.to_date(stamp)
    later = (stamp > day.cast("timestamp_ntz")).cast("int")
    return F.datediff(reference, day) - later


def epoch_micros(stamp: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the same wall clock."""
    days = F.datediff(F.to_date(stamp), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    seconds = (F.hour(stamp) * 60 + F.minute(stamp)) * 60
    fraction = (F.date_part(F.lit("SECOND"), stamp) * 1_000_000).cast("bigint")
    return (days * 86_400 + seconds) * 1_000_000 + fraction


def fill_days(daily: DataFrame, day: str, value: str) -> DataFrame:
    """One row per calendar day from the first to the last day of ``daily``, 0 where it has none.

    ``daily`` is one row per day and read once: each row also gives the empty days up to the next one. The
    unpartitioned window is as long as the calendar, whatever the data's size.
    """
    following = F.lead(day).over(Window.orderBy(day))
    spread = (
        daily.filter(F.col(day).isNotNull())
        .withColumn("_last", F.coalesce(F.date_sub(following, 1), F.col(day)))
        .select(F.explode(F.sequence(F.col(day), F.col("_last"))).alias("_day"), day, value)
    )
    kind = daily.schema[value].dataType
    return spread.select(
        F.col("_day").alias(day),
        F.when(F.col("_day") == F.col(day), F.col(value)).otherwise(F.lit(0).cast(kind)).alias(value),
    )

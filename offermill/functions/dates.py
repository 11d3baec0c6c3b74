"""Date columns. Inputs are ISO text as it stands in a report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv


def parse_instant(c: Column) -> Column:
    """Timestamp of ISO text, null when it is not a date.

    A bare date means midnight UTC. Text that is only a time of day is not a
    date, although Spark's cast would add today to it.
    """
    dated = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.concat(c, F.lit("T00:00:00Z"))).when(
        c.rlike(r"^\d{4}(-|\z)"), c
    )
    return F.try_to_timestamp(dated)


def valid_timestamp(c: Column) -> Column:
    return parse_instant(c).isNotNull()


def _local(instant: Column, tz: Column | str | None) -> Column:
    zone = F.lit(fv.DEFAULT_TIME_ZONE)
    if isinstance(tz, str):
        zone = F.lit(tz)
    elif tz is not None:
        zone = F.coalesce(F.when(tz != "", tz), zone)
    return F.convert_timezone(None, zone, instant.cast("timestamp_ntz"))


def day_in_tz(c: Column, tz: Column | str | None = None) -> Column:
    """Calendar day of an instant in an IANA zone."""
    return F.to_date(_local(parse_instant(c), tz))


def days_between(last_verified: Column, generated_at: Column, tz: Column | str | None = None) -> Column:
    return F.datediff(day_in_tz(generated_at, tz), day_in_tz(last_verified, tz))


def freshness(last_verified: Column, generated_at: Column, tz: Column | str | None = None) -> Column:
    """Label for how many calendar days ago an offer was checked."""
    days = days_between(last_verified, generated_at, tz)
    return (
        F.when(days.isNull(), fv.TEXT_UNVERIFIED)
        .when(days <= 0, fv.TEXT_TODAY)
        .when(days == 1, fv.TEXT_YESTERDAY)
        .otherwise(F.format_string(fv.TEXT_DAYS_AGO, days))
    )


def format_date(c: Column, tz: Column | str | None = None) -> Column:
    """Long Japanese date; a fixed word when there is none."""
    local = _local(parse_instant(c), tz)
    return (
        F.when(F.coalesce(c, F.lit("")) == "", fv.TEXT_UNKNOWN_DATE)
        .when(local.isNull(), "Invalid Date")
        .otherwise(F.date_format(local, fv.DATE_PATTERN))
    )

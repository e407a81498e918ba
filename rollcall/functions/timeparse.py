"""Clocks, dates and time stamps in the forms in which sources give them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_to_seconds(c: Column) -> Column:
    """'M:SS' or 'H:MM:SS' (parts may have decimals) in seconds; null for anything else."""
    p = F.split(c, ":")
    n = lambda i: F.try_element_at(p, F.lit(i)).try_cast("double")
    return F.when(F.size(p) == 3, n(1) * 3600 + n(2) * 60 + n(3)).when(F.size(p) == 2, n(1) * 60 + n(2))


def seconds_to_clock(c: Column) -> Column:
    """'H:MM:SS', cut down to whole seconds; below zero counts as zero."""
    s = F.greatest(F.floor(c), F.lit(0)).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def display_clock(c: Column) -> Column:
    """As read by people: rounded, without leading hours of zero."""
    s = F.greatest(F.round(c), F.lit(0)).cast("long")
    long_ = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return F.when(s >= 3600, long_).otherwise(F.format_string("%d:%02d", F.floor(s / 60), s % 60))


def display_duration(c: Column) -> Column:
    m = F.round(c / 60).cast("long")
    return F.when(m < 60, F.format_string("%d min", m)).otherwise(F.format_string("%dh %dm", F.floor(m / 60), m % 60))


def display_date(c: Column) -> Column:
    return F.date_format(c, "MMM d, yyyy")


# Hours from Greenwich of the zones that mail names.
MAIL_ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
MAIL_DATE = r"^(?:[A-Za-z]+,?\s+|[A-Za-z]+,)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{2}|\d{4}),?\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+([+-]\d{4}|[A-Za-z]+).*)?$"


def mail_date(c: Column) -> Column:
    """An RFC 822 date as ISO text with the offset that it names, whatever the session's zone: zones by name or
    number, years of two digits (from 69 on of the last century), with or without seconds. A date without a zone, with an unknown
    one or with -0000 has no offset. What cannot be read stays as it is, trimmed."""
    plain = F.trim(F.regexp_replace(c, r"^\s+|\s+$", ""))
    day, month, year, hour, minute, second, zone = (F.regexp_extract(plain, MAIL_DATE, k) for k in range(1, 8))
    number = year.try_cast("int")
    full = F.when(F.length(year) == 4, number).otherwise(number + F.when(number > 68, 1900).otherwise(2000))
    date = F.try_to_timestamp(F.format_string("%04d %s %s", full, F.initcap(month), F.lpad(day, 2, "0")), F.lit("yyyy MMM dd"))
    fits = (hour.try_cast("int") < 24) & (minute.try_cast("int") < 60) & (F.coalesce(second.try_cast("int"), F.lit(0)) < 60)
    hours = F.element_at(F.create_map(*[F.lit(x) for pair in MAIL_ZONES.items() for x in pair]), F.upper(zone))
    named = F.when(hours.isNotNull(), F.format_string("%s%02d:00", F.when(hours < 0, "-").otherwise("+"), F.abs(hours)))
    given = F.when(zone.rlike(r"^[+-]\d{4}$") & (zone != "-0000"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
    time = F.concat_ws(":", F.lpad(hour, 2, "0"), minute, F.coalesce(F.nullif(second, F.lit("")), F.lit("00")))
    read = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T"), time, F.coalesce(named, given, F.lit("")))
    return F.coalesce(F.when(plain.rlike(MAIL_DATE) & fits, read), plain)


def recording_time(name: Column) -> Column:
    """Time stamp in a recording's name, '_yymmdd-HHMMSS'."""
    found = F.regexp_extract(name, r"_(\d{6}-\d{6})(?:fix)?", 1)
    return F.try_to_timestamp(F.nullif(F.replace(found, F.lit("-"), F.lit("")), F.lit("")), F.lit("yyMMddHHmmss"))


def event_time(date: Column, time: Column) -> Column:
    """Date and time of day in 12- or 24-hour form; midnight if the time cannot be read."""
    day = F.substring_index(date, "T", 1)
    both = F.concat_ws(" ", day, F.trim(time))
    forms = ("yyyy-MM-dd h:mm a", "yyyy-MM-dd H:mm")
    return F.coalesce(*[F.try_to_timestamp(both, F.lit(f)) for f in forms], F.try_to_timestamp(day, F.lit("yyyy-MM-dd")))


def minutes_apart(a: Column, b: Column) -> Column:
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) / F.lit(60_000_000)


def registry_time(c: Column) -> Column:
    """ISO time stamp of the registry, UTC if it names no zone; null if it cannot be read."""
    return F.try_to_timestamp(F.replace(F.trim(c), F.lit("Z"), F.lit("+00:00")))


def iso_stamp(at: Column) -> Column:
    """A moment as ISO text in UTC without fractions of a second, as the registry's columns hold it."""
    return F.date_format(F.to_utc_timestamp(at.cast("timestamp"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")

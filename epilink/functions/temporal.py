"""Epidemiological weeks, calendar months and dates found in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import python_title

# Weeks run Sunday to Saturday and belong to the year of their pivot day. The default
# pivot is Thursday, the MMWR rule uses Wednesday. dayofweek() is 1 on Sunday.
_PIVOT = {"thursday": 5, "mmwr": 4}


def _pivot(day: Column, rule: str) -> Column:
    date = day.cast("date")
    return F.date_add(date, F.lit(_PIVOT[rule]) - F.dayofweek(date))


def epi_year(day: Column, rule: str = "thursday") -> Column:
    return F.year(_pivot(day, rule))


def epi_week(day: Column, rule: str = "thursday") -> Column:
    """Week number: the pivot day's ordinal among its weekday in that year."""
    return F.ceil(F.dayofyear(_pivot(day, rule)) / F.lit(7)).cast("int")


def format_week_key(year: Column, week: Column) -> Column:
    """``2026-W07``; null if either part is null."""
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def week_key(day: Column, rule: str = "thursday") -> Column:
    return format_week_key(epi_year(day, rule), epi_week(day, rule))


def with_epi_week_key(df: DataFrame, year_col: str = "epi_year", week_col: str = "epi_week") -> DataFrame:
    return df.withColumn("epi_week_key", format_week_key(F.col(year_col), F.col(week_col)))


def split_week_key(df: DataFrame, key_col: str = "epi_week_key") -> DataFrame:
    """Add ``epi_year`` and ``epi_week`` from a key; parts that are no numbers give null."""
    parts = F.split(F.col(key_col), "-W")
    return df.withColumns(
        {
            "epi_year": F.get(parts, F.lit(0)).try_cast("int"),
            "epi_week": F.get(parts, F.lit(1)).try_cast("int"),
        }
    )


# Fixed value: ISO date, optionally with a time and an offset.
_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(T([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
)


def iso_text_to_date(text: Column) -> Column:
    """Date part as written, in the text's own offset; anything else gives null."""
    return F.when(text.rlike(_ISO), F.left(text, F.lit(10)).try_cast("date"))


def current_week_key() -> Column:
    return week_key(F.current_date())


def long_date(ts: Column) -> Column:
    """``30 June 2026``"""
    return F.date_format(ts, "dd MMMM yyyy")


def month_label(ts: Column) -> Column:
    """``2026-06``"""
    return F.date_format(ts, "yyyy-MM")


def iso_utc(ts: Column) -> Column:
    """ISO text of a time that is in UTC, as everywhere in a session set to UTC."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def iso_utc_now() -> Column:
    """Current time as ISO text in UTC, whatever the session zone is."""
    return iso_utc(
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    )


def epoch_seconds_now() -> Column:
    return F.unix_micros(F.current_timestamp()) / F.lit(1_000_000.0)


def timex_to_week_key(value: Column) -> Column:
    """Week key of a normalised time expression.

    Week values pass through unchecked, full dates are converted; months,
    date-times, references such as ``PRESENT_REF`` and impossible dates give null.
    """
    return F.when(value.rlike(r"^\d{4}-W\d{2}$"), value).when(
        value.rlike(r"^\d{4}-\d{2}-\d{2}$"), week_key(value.try_cast("date"))
    )


# English month names and their short forms, and the written forms of a date.
_MONTHS = (
    "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|"
    "aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_MONTH_STARTS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
_ORDINAL = "(?:st|nd|rd|th)?"
_ANY_DATE = (
    r"(?i)\b(?=[\djfmasond])(?:"
    r"\d{4}-\d{2}-\d{2}(?!T?\d)|\d{4}-W\d{2}"
    rf"|\d{{1,2}}{_ORDINAL}\s+(?:of\s+)?{_MONTHS}\.?,?\s+\d{{4}}"
    rf"|{_MONTHS}\.?\s+\d{{1,2}}{_ORDINAL},?\s+\d{{4}}"
    r")\b"
)
# Parts of a text that is known to be a date.
_DAY_FIRST = r"^(\d{1,2})\p{Alpha}*\s+(?:[oO][fF]\s+)?(\p{Alpha}+)[.,]*\s+(\d{4})$"
_MONTH_FIRST = r"^(\p{Alpha}+)\.?\s+(\d{1,2})\p{Alpha}*,?\s+(\d{4})$"


def _parts(found: Column) -> Column:
    """``30 June 2026``, ``June 30, 2026`` and ``2026-06-30`` as ``[2026, JUNE or 06, 30]``."""
    reordered = F.regexp_replace(F.regexp_replace(found, _DAY_FIRST, "$3-$2-$1"), _MONTH_FIRST, "$3-$1-$2")
    return F.split(F.upper(reordered), "-")


def _day_or_week(parts: Column) -> Column:
    """Parts to a struct of the day they name, or the week key if they are a year and a week."""
    month = F.get(parts, F.lit(1))
    place = F.instr(F.lit(_MONTH_STARTS), F.left(month, F.lit(3)))
    # Text is cast to a number only where it is one; a failing cast costs an exception.
    number = F.when(place > 0, ((place + F.lit(2)) / F.lit(3)).cast("int")).otherwise(month.try_cast("int"))
    day = F.concat_ws("-", F.get(parts, F.lit(0)), number, F.get(parts, F.lit(2))).try_cast("date")
    return F.struct(
        F.when(F.size(parts) == 2, F.array_join(parts, "-")).alias("week"),
        F.when(F.size(parts) == 3, day).alias("day"),
    )


def extract_temporal_key(text: Column, fallback: Column | None = None) -> Column:
    """Key of the first date or week in the text that maps to one, else the fallback.

    The whole text is searched. Relative phrases ("last week") need a reference
    date and are not resolved. Each step maps an array of its own, because a
    lambda evaluates what it repeats.
    """
    found = F.regexp_extract_all(text, F.lit(_ANY_DATE), F.lit(0))
    named = F.transform(F.transform(found, _parts), _day_or_week)
    keys = F.transform(named, lambda n: F.coalesce(n["week"], week_key(n["day"])))
    key = F.get(F.filter(keys, lambda k: k.isNotNull()), F.lit(0))
    return key if fallback is None else F.coalesce(key, fallback)


# Weekdays from Monday on, number words from one on, and the phrases that name a day or week by another day.
_WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_NUMBERS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")
_WEEKDAY = f"(?:{'|'.join(_WEEKDAYS)})"
_RELATIVE = (
    r"(?i)\b(?=[\dtylpnaomwfse])(?:"
    r"today|yesterday|tomorrow|(?:last|past|this|next)\s+week"
    rf"|(?:(?:last|past|this|next)\s+)?{_WEEKDAY}"
    rf"|(?:\d{{1,3}}|an?|{'|'.join(_NUMBERS)})\s+(?:day|week)s?\s+ago"
    r")\b"
)


def _offset(phrase: Column, day: Column) -> Column:
    """Days from ``day`` to what a phrase, in lower case with single blanks, names; a week is named by its day."""
    head = F.substring_index(phrase, " ", 1)
    tail = F.substring_index(phrase, " ", -1)
    # One more than the place in the list; 0 if it is in none.
    weekday = F.array_position(F.array(*map(F.lit, _WEEKDAYS)), tail)
    number = F.coalesce(
        head.try_cast("int"), F.when(head.isin("a", "an"), 1), F.nullif(F.array_position(F.array(*map(F.lit, _NUMBERS)), head), F.lit(0)).cast("int")
    )
    unit = F.when(F.contains(phrase, F.lit(" week")), 7).otherwise(1)
    # Monday is 1; how far back the weekday last was, and ahead it next is, the day itself excluded.
    today = F.weekday(day) + 1
    back, ahead = F.pmod(today - weekday - 1, F.lit(7)) + 1, F.pmod(weekday - today - 1, F.lit(7)) + 1
    on_weekday = (
        F.when(head.isin("last", "past"), -back).when(head == "next", ahead).when(head == "this", weekday - today).otherwise(-F.pmod(today - weekday, F.lit(7)))
    )
    return (
        F.when(phrase == "today", 0)
        .when(phrase == "yesterday", -1)
        .when(phrase == "tomorrow", 1)
        .when(tail == "ago", -number * unit)
        .when(tail == "week", F.when(head.isin("last", "past"), -7).when(head == "next", 7).otherwise(0))
        .otherwise(on_weekday)
        .cast("int")
    )


def extract_relative_key(text: Column, day: Column, fallback: Column | None = None) -> Column:
    """Key of the first date, week or relative phrase in the text that maps to one, else the fallback.

    Relative phrases are read from ``day``, the day of the report: ``yesterday``, ``last week``, ``two days ago``,
    ``on Monday`` (the latest one up to that day), ``last Monday``, ``next Monday``, ``this Monday`` (of the same week). Without a
    day they give nothing.
    """
    either = f"{_ANY_DATE}|{_RELATIVE.removeprefix('(?i)')}"
    found = F.regexp_extract_all(text, F.lit(either), F.lit(0))

    def key(phrase: Column) -> Column:
        written = F.transform(F.transform(F.array(phrase), _parts), _day_or_week)
        absolute = F.get(F.transform(written, lambda n: F.coalesce(n["week"], week_key(n["day"]))), F.lit(0))
        spelled = F.regexp_replace(F.lower(phrase), r"\s+", " ")
        relative = F.get(F.transform(F.array(spelled), lambda x: week_key(F.date_add(day, _offset(x, day)))), F.lit(0))
        return F.when(phrase.rlike(r"\d{4}"), absolute).otherwise(relative)

    keys = F.filter(F.transform(found, key), lambda k: k.isNotNull())
    first = F.get(keys, F.lit(0))
    return first if fallback is None else F.coalesce(first, fallback)


def alert_sentence(event_type: Column, place: Column, ts: Column, severity: Column) -> Column:
    """``Flood reported in Lahore on 30 June 2026; severity moderate.``"""
    return F.format_string(
        "%s reported in %s on %s; severity %s.", python_title(event_type), place, long_date(ts), severity
    )

"""Is a string an ISO-8601 date or date-time?

Accepts the language of Python's ``datetime.fromisoformat`` (3.11 and later): calendar and week dates
in basic or extended form, any one character as separator, an optional time with a fraction, and an
optional offset below 24 hours. ``try_cast(... AS TIMESTAMP)`` alone accepts and rejects other
strings, so the shape, field ranges and leap days are put in one pattern and only the number of weeks
in a year is left to date arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PAIR = "[0-9]{2}"
_SIXTY = "[0-5][0-9]"
_DIGITS = "[0-9]+"
_HOUR = "(?:[01][0-9]|2[0-3])"
_WEEK = "W(?:0[1-9]|[1-4][0-9]|5[0-3])"


def _month_day(dash: str) -> str:
    """Month and day of a common year."""
    return (
        f"(?:(?:0[13578]|1[02]){dash}(?:0[1-9]|[12][0-9]|3[01])"
        f"|(?:0[469]|11){dash}(?:0[1-9]|[12][0-9]|30)"
        f"|02{dash}(?:0[1-9]|1[0-9]|2[0-8]))"
    )


def _date() -> str:
    leap_year = (
        "(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)"
    )
    # In a run of digits after a basic week date, the parity of the run decides whether the first
    # digit is the weekday or the separator.
    basic_weekday = (
        "(?:[1-7](?![0-9])|[1-7](?=[0-9](?:[0-9][0-9])*(?![0-9]))"
        "|(?![0-9])|(?=[0-9](?:[0-9][0-9])+(?![0-9])))"
    )
    return (
        "(?!0000|9999-W52-[67]|9999W52[67])"
        f"(?:{leap_year}(?:-02-29|0229)"
        f"|[0-9]{{4}}(?:-{_month_day('-')}|{_month_day('')}"
        f"|-{_WEEK}(?:-[1-7](?![0-9]))?|{_WEEK}{basic_weekday}))"
    )


def _after_hour(minute: str, second: str) -> str:
    """What may follow an hour: nothing, or minutes, seconds and a fraction, all with or all without colons."""
    return (
        f"(?:[.,]{_DIGITS}"
        f"|:{minute}(?:[.,]{_DIGITS}|:{second}(?:[:.,]{_DIGITS})?)?"
        f"|{minute}(?:[.,]{_DIGITS}|{second}(?:[.,]{_DIGITS}|[0-9]{{2,}})?)?)?"
    )


def _time() -> str:
    time = _HOUR + _after_hour(_SIXTY, _SIXTY)
    # Before an offset, one stray character after whole fields, or a tail after six digits of the
    # fraction, does no harm.
    stray = f"{_HOUR}(?::{_SIXTY}(?::{_SIXTY})?|{_SIXTY}(?:{_SIXTY})?)?[^+-]"
    long_fraction = (
        f"{_HOUR}(?:[.,]|:{_SIXTY}[.,]|:{_SIXTY}:{_SIXTY}[:.,]|{_SIXTY}[.,]|{_SIXTY}{_SIXTY}[.,]?)"
        "[0-9]{6}[^+-]*"
    )
    below_23h = "(?:[01][0-9]|2[0-2])" + _after_hour(_PAIR, _PAIR)
    below_2359 = "23" + _after_hour("(?:[0-4][0-9]|5[0-8])", _PAIR)
    at_2359 = "23" + _after_hour("59", _SIXTY)
    offset = f"[+-](?:{below_23h}|{below_2359}|{at_2359})"
    return f"(?:{time}(?:{offset})?|(?:{stray}|{long_fraction}){offset})"


ISO_PATTERN = f"^(?s:{_date()}(?:.{_time()})?)\\z"


def is_iso_datetime(text: Column) -> Column:
    """True when ``text`` parses once every ``Z`` is read as ``+00:00``; false (or null for null) otherwise."""
    value = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    last_week = F.weekofyear(
        F.concat(F.substring(value, 1, 4), F.lit("-12-28")).try_cast("date")
    )
    return value.rlike(ISO_PATTERN) & (
        ~F.contains(F.substring(value, 5, 4), F.lit("W53")) | (last_week == 53)
    )

"""Casts that turn dirty input into null instead of failing, dates, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what the JSON reader makes of a bare NaN where text is expected. Writers that hold
# missing cells as NaN send it; a text that reads NaN comes without the quote marks.
NAN_TEXT = '"NaN"'


def present(text: Column) -> Column:
    """The text, or null where the message had a bare NaN."""
    return F.when(text != NAN_TEXT, text)


def finite(number: Column) -> Column:
    """The number, or null where it is NaN."""
    return F.when(~F.isnan(number), number)


def to_double(value: Column) -> Column:
    return finite(value.try_cast("double"))


def to_float(value: Column) -> Column:
    return finite(value.try_cast("float"))


def to_int(value: Column) -> Column:
    """Whole number of a value that may be spelled `2019.0`."""
    return to_double(value).try_cast("int")


def to_text(value: Column) -> Column:
    return value.cast("string")


def half_scale(score: Column) -> Column:
    """10-point score to 5-point rating; dividing a float gives a double, so cast back."""
    return (to_float(score) / 2).cast("float")


def iso_date(text: Column) -> Column:
    """Date of `yyyy-MM-dd` text, null if it is none."""
    return F.try_to_date(text, "yyyy-MM-dd")


def year_start(year: Column) -> Column:
    """January 1 of a year given as `2019`, `2019.0` or a number."""
    number = to_int(year)
    return F.when(number.between(1, 9999), F.make_date(number, F.lit(1), F.lit(1)))


def reformat_date(text: Column) -> Column:
    """`3 May 2020` to `2020-05-03`; anything else comes back unchanged."""
    tidy = F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+", " ")
    parsed = F.try_to_date(tidy, "d MMMM yyyy")
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), text)


def iso_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def now_text() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def stable_id(*parts: Column) -> Column:
    """The same id for the same row every time it is computed, so that a replay overwrites.

    The parts are hashed as a JSON list, in which separators are escaped and nulls are kept, so
    other parts give another id.
    """
    return F.sha2(F.to_json(F.array(*[part.cast("string") for part in parts])), 256)


def random_id() -> Column:
    """A new id on every evaluation; only for rows that are never replayed."""
    return F.expr("uuid()")

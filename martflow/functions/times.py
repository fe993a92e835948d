"""Epoch milliseconds, date-time texts, event time and windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyyMMdd"

EVENT_TIME = "event_time"


def text_to_time(text: Column | str) -> Column:
    """Timestamp of a date-time text; null if it does not parse.

    A cast reads ISO texts several times faster than a format pattern does.  But
    it reads other shapes too, and a time alone as that of today, so the shape is
    looked at first.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.like("____-__-__ __:__:__"), text.try_cast("timestamp"))


def text_to_millis(text: Column | str) -> Column:
    """Epoch milliseconds of a date-time text; null if it does not parse."""
    return F.unix_millis(text_to_time(text))


def millis_to_text(millis: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(millis), DATE_TIME)


def millis_to_day(millis: Column | str) -> Column:
    """Calendar day as ``yyyyMMdd`` text."""
    return F.date_format(F.timestamp_millis(millis), DAY)


def text_to_day_number(text: Column | str) -> Column:
    """``yyyyMMdd`` as an int, from a date-time text."""
    return F.date_format(text_to_time(text), DAY).cast("int")


def with_event_time(
    df: DataFrame,
    delay: str = "0 seconds",
    time: Column | None = None,
    name: str = EVENT_TIME,
) -> DataFrame:
    """Add the event time, by default that of ``ts``, watermarked by ``delay``.

    The watermark does nothing on a batch DataFrame, so operators call this
    in both modes.  A DataFrame that has the column already is left alone.
    """
    if name in df.columns:
        return df
    time = F.timestamp_millis("ts") if time is None else time
    return df.withColumn(name, time).withWatermark(name, delay)


def window_bounds(window: str = "window") -> list[Column]:
    """``stt`` and ``edt`` texts of a window column."""
    return [
        F.date_format(F.col(f"{window}.start"), DATE_TIME).alias("stt"),
        F.date_format(F.col(f"{window}.end"), DATE_TIME).alias("edt"),
    ]


def age_years(birthday: Column | str, as_of: Column | date | None = None) -> Column:
    """Whole calendar years from ``birthday`` (yyyy-MM-dd text) to ``as_of``.

    Not ``months_between / 12``: that counts 29 February as reached on
    28 February.  No birthday, no age.
    """
    birthday = F.col(birthday) if isinstance(birthday, str) else birthday
    born = birthday.try_cast("date")
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, date):
        as_of = F.lit(as_of)
    not_yet = F.date_format(as_of, "MMdd") < F.date_format(born, "MMdd")
    return (F.year(as_of) - F.year(born) - not_yet.cast("int")).cast("int")

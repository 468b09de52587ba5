"""Time and number functions. Weekdays count from Monday as 0; everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_epoch(c: Column) -> Column:
    """Epoch milliseconds in a text as a timestamp without zone; anything else is null."""
    ms = c.try_cast("bigint")
    sane = ms.between(-62135596800000, 253402300799999)
    return F.when(sane, F.timestamp_millis(ms)).cast("timestamp_ntz")


def time_features(created: Column, closed: Column | None = None) -> dict[str, Column]:
    """Hour, weekday and month of creation, and hours to resolution to two places."""
    hours = F.lit(None).cast("double") if closed is None else round_half_up(hours_between(created, closed), 2)
    return {"created_hour": F.hour(created), "created_dayofweek": F.weekday(created), "created_month": F.month(created), "resolution_hours": hours}


def hours_between(start: Column, end: Column) -> Column:
    millis = lambda c: F.unix_millis(c.cast("timestamp"))
    return (millis(end) - millis(start)) / F.lit(3600000.0)


def round_half_up(c: Column, places: int) -> Column:
    """Rounded as ``floor(x * 10**places + 0.5)``, which engines agree on."""
    scale = float(10**places)
    return F.floor(c * scale + 0.5) / scale


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def in_range(c: Column, start: str | None, end: str | None) -> Column:
    """From start to the midnight after end, both included."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (c <= F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return cond


def at_least(c: Column, low: float) -> Column:
    """The larger of c and low; null stays null."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def ape(actual: Column, predicted: Column) -> Column:
    """Absolute error as a share of the actual value, taken as 1 at least; its mean is the MAPE."""
    return F.abs(actual - predicted) / F.greatest(actual.cast("double"), F.lit(1.0))


def edge(naive: Column, model: Column) -> Column:
    """How much smaller the model's error is, as a share of the naive one; 0 if that is 0."""
    return F.when(naive == 0, 0.0).otherwise((naive - model) / naive)


def to_datetime(c: Column) -> Column:
    """A text as a timestamp, each value by its own form; what is none is null."""
    forms = ("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy/MM/dd[ HH:mm[:ss]]", "dd/MM/yyyy[ HH:mm[:ss]]", "dd-MM-yyyy[ HH:mm[:ss]]")
    return F.coalesce(c.try_cast("timestamp_ntz"), *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in forms])

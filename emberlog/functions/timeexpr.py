"""Time bounds, time normalisation and time rendering."""

from __future__ import annotations

import calendar
import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bare integers are epoch seconds or milliseconds only inside these open ranges.
EPOCH_SECONDS_RANGE = (1_000_000_000, 10_000_000_000)
EPOCH_MILLIS_RANGE = (1_000_000_000_000, 10_000_000_000_000)

# Display patterns.
DISPLAY_DATETIME = "yyyy-MM-dd HH:mm:ss"
DISPLAY_CLOCK = "HH:mm:ss.SSS"
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_FIXED_UNITS = {
    "w": timedelta(weeks=1),
    "d": timedelta(days=1),
    "h": timedelta(hours=1),
    "H": timedelta(hours=1),
    "m": timedelta(minutes=1),
    "s": timedelta(seconds=1),
}
_STEP = re.compile(r"([+-])(\d*)([yMwdhHms])|/([yMwdhHms])")


def resolve_time(text: str | datetime, now: datetime | None = None) -> datetime:
    """A time bound given as text (datemath, epoch, ISO date or time) as a UTC instant."""
    if isinstance(text, datetime):
        return _utc(text)
    text = str(text)
    if text.startswith("now"):
        return _steps(_utc(now or datetime.now(timezone.utc)), text[3:], text)
    anchor, mark, tail = text.partition("||")
    if mark:
        return _steps(resolve_time(anchor, now), tail, text)
    if re.fullmatch(r"[+-]?\d+", text):
        number = int(text)
        if EPOCH_SECONDS_RANGE[0] < number < EPOCH_SECONDS_RANGE[1]:
            return datetime.fromtimestamp(number, timezone.utc)
        if EPOCH_MILLIS_RANGE[0] < number < EPOCH_MILLIS_RANGE[1]:
            return datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=number)
    iso = re.sub(r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d) [A-Z]{3,4}$", r"\1", text)
    if re.match(r"\d{4}-\d\d-\d\d($|[T ]\d\d:\d\d:\d\d)", iso):
        try:
            return _utc(datetime.fromisoformat(iso))
        except ValueError:
            pass
    raise ValueError(f"unsupported time {text!r}")


def resolve_range(frm=None, to=None, now: datetime | None = None):
    """Both ends of a time range; each may be absent, and `frm` may not follow `to`."""
    lo = resolve_time(frm, now) if frm else None
    hi = resolve_time(to, now) if to else None
    if lo and hi and lo > hi:
        raise ValueError(f"time range starts at {lo.isoformat()}, after its end {hi.isoformat()}")
    return lo, hi


def _utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def _steps(value: datetime, tail: str, text: str) -> datetime:
    if _STEP.sub("", tail):
        raise ValueError(f"unsupported datemath {text!r}")
    for sign, amount, unit, rounding in _STEP.findall(tail):
        if rounding:
            value = _round_down(value, rounding)
        else:
            value = _shift(value, int(amount or 1) * (1 if sign == "+" else -1), unit)
    return value


def _shift(value: datetime, amount: int, unit: str) -> datetime:
    if unit in _FIXED_UNITS:
        return value + amount * _FIXED_UNITS[unit]
    months = value.year * 12 + value.month - 1 + amount * (12 if unit == "y" else 1)
    year, month = divmod(months, 12)
    day = min(value.day, calendar.monthrange(year, month + 1)[1])
    return value.replace(year=year, month=month + 1, day=day)


def _round_down(value: datetime, unit: str) -> datetime:
    zeroed = {"s": {}, "m": {"second": 0}, "h": {"minute": 0, "second": 0}}
    clear = zeroed.get(unit.lower() if unit == "H" else unit, {"hour": 0, "minute": 0, "second": 0})
    value = value.replace(microsecond=0, **clear)
    if unit == "w":
        return value - timedelta(days=value.weekday())
    if unit == "M":
        return value.replace(day=1)
    if unit == "y":
        return value.replace(month=1, day=1)
    return value


def epoch_millis(value: datetime) -> int:
    return (value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)


def time_literal(value: datetime, dtype: T.DataType) -> Column:
    """`value` as a literal of the column's own type, so comparisons reach the scan."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(value.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")


def normalize_time(text: Column) -> Column:
    """Time text of mixed formats as a timestamp; null where no format fits."""
    number = F.when(text.rlike(r"^[+-]?\d{1,18}$"), text.try_cast("bigint"))
    date, clock = r"\d{4}-\d{2}-\d{2}", r"\d{2}:\d{2}:\d{2}"
    iso = (
        F.when(text.rlike(rf"^{date}T{clock}(\.\d+)?(Z|[+-]\d{{2}}:\d{{2}})$"), text)
        .when(text.rlike(rf"^{date}[T ]{clock}(\.\d+)?$"), F.concat(F.translate(text, " ", "T"), F.lit("Z")))
        .when(text.rlike(rf"^{date}$"), F.concat(text, F.lit("T00:00:00Z")))
        .when(
            text.rlike(rf"^{date} {clock} [A-Z]{{3,4}}$"),
            F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z")),
        )
    )
    return (
        F.when((number > EPOCH_SECONDS_RANGE[0]) & (number < EPOCH_SECONDS_RANGE[1]), F.timestamp_seconds(number))
        .when((number > EPOCH_MILLIS_RANGE[0]) & (number < EPOCH_MILLIS_RANGE[1]), F.timestamp_millis(number))
        .otherwise(iso.try_cast("timestamp"))
    )


def rfc3339(ts: Column) -> Column:
    """Seconds precision, sub-second part dropped."""
    return F.date_format(ts, RFC3339)


def display_datetime(ts: Column) -> Column:
    return F.date_format(ts, DISPLAY_DATETIME)


def display_clock(ts: Column) -> Column:
    return F.date_format(ts, DISPLAY_CLOCK)

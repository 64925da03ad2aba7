"""Times of batch jobs: yyyyMMdd[HH[mm]] strings, granularities, wildcards, backfills."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta
from enum import Enum

from dateutil.relativedelta import relativedelta


class Granularity(Enum):
    MINUTE = 1
    HOUR = 60
    DAY = 1440
    WEEK = 10080
    MONTH = "month"
    YEAR = "year"

    def minutes(self) -> int:
        if not isinstance(self.value, int):
            raise ValueError(f"{self.name} has no fixed length")
        return self.value

    def milliseconds(self) -> int:
        return self.minutes() * 60_000


# Formats by length, and the day's offset from UTC.
FORMATS = {12: ("%Y%m%d%H%M", Granularity.MINUTE), 10: ("%Y%m%d%H", Granularity.HOUR), 8: ("%Y%m%d", Granularity.DAY)}
DAY_OFFSET_HOURS = 8


def parse(text: str) -> datetime:
    if len(text) not in FORMATS or not text.isdigit():
        raise ValueError(f"not yyyyMMdd, yyyyMMddHH or yyyyMMddHHmm: {text!r}")
    return datetime.strptime(text, FORMATS[len(text)][0])


def granularity_of(text: str) -> Granularity:
    parse(text)
    return FORMATS[len(text)][1]


def show(moment: datetime, granularity: Granularity) -> str:
    return next(moment.strftime(f) for f, g in FORMATS.values() if g == granularity)


def is_aligned(epoch_ms: int, granularity: Granularity, offset_hours: int = DAY_OFFSET_HOURS) -> bool:
    """Whether a timestamp begins a period; days begin at the offset's midnight."""
    shift = offset_hours * 3_600_000 if granularity in (Granularity.DAY, Granularity.WEEK) else 0
    return (epoch_ms + shift) % granularity.milliseconds() == 0


def require_aligned(epoch_ms: int, granularity: Granularity, offset_hours: int = DAY_OFFSET_HOURS) -> int:
    """The timestamp, or an error where it doesn't begin a period."""
    if not is_aligned(epoch_ms, granularity, offset_hours):
        raise ValueError(f"{epoch_ms} doesn't begin a {granularity.name.lower()}")
    return epoch_ms


def to_epoch_ms(moment: datetime, offset_hours: int = 0) -> int:
    return int((moment.replace(tzinfo=UTC) - timedelta(hours=offset_hours)).timestamp() * 1000)


def back(text: str, granularity: Granularity, step: int, n: int) -> str:
    """n times `step` calendar periods earlier, in the same format."""
    unit = {"MINUTE": "minutes", "HOUR": "hours", "DAY": "days", "WEEK": "weeks", "MONTH": "months", "YEAR": "years"}[granularity.name]
    return show(parse(text) - relativedelta(**{unit: step * n}), granularity_of(text))


def backfill(text: str, periods: int) -> list[str]:
    """The instant and the periods-1 before it, newest first."""
    return [back(text, granularity_of(text), 1, i) for i in range(max(periods, 1))]


def period_days(text: str, days: int) -> str:
    return (parse(text[:8]) + timedelta(days=days)).strftime("%Y%m%d")


def cycle_of_day(text: str) -> int:
    """Hour or minute of the day; 0 for a day."""
    t = parse(text)
    return {Granularity.HOUR: t.hour, Granularity.MINUTE: t.hour * 60 + t.minute}.get(granularity_of(text), 0)


def window(epoch_ms: int, granularity: Granularity, step: int, first: int, last: int, fixed: bool) -> tuple[int, int]:
    """Half-open range of `step`-long periods from first-1 before to last after (1 if fixed)."""
    unit = granularity.milliseconds() * step
    return epoch_ms - (first - 1) * unit, epoch_ms + (1 if fixed else last) * unit


_STEP = r"(?:([+-]\d+)(MINUTE|HOUR|DAY)?)?"
# minute patterns first, then hours, then days: the longer contain the shorter
_WILDCARDS = ((re.compile("YYYYMMDDHH(?:FF|MM)" + _STEP), "%Y%m%d%H%M", "MINUTE"), (re.compile("YYYYMMDDHH" + _STEP), "%Y%m%d%H", "HOUR"), (re.compile("YYYYMMDD" + _STEP), "%Y%m%d", "DAY"))


def fill_wildcards(text: str, moment: datetime) -> str:
    """YYYYMMDD[HH[MM]] with an optional ±N[MINUTE|HOUR|DAY]."""
    for pattern, form, own in _WILDCARDS:

        def put(m: re.Match, form=form, own=own) -> str:
            unit = (m[2] or own).lower() + "s"
            return (moment + timedelta(**{unit: int(m[1] or 0)})).strftime(form)

        text = pattern.sub(put, text)
    return text


def fill_current(text: str, now: datetime) -> str:
    """{currentMinute}, {currentHour}, {currentDay}, {currentDayShort}."""
    for name, form in (("Minute", "%Y%m%d%H%M"), ("Hour", "%Y%m%d%H"), ("DayShort", "%y%m%d"), ("Day", "%Y%m%d")):
        text = text.replace(f"{{current{name}}}", now.strftime(form))
    return text


def days_between(first: str, last: str) -> list[str]:
    """All valid days from first to last, as yyyyMMdd."""
    a, b = parse(first), parse(last)
    return [(a + timedelta(days=i)).strftime("%Y%m%d") for i in range((b - a).days + 1)]

"""Instants, widths and the bucket grid, as plain numbers on the driver."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)
Instant = str | dt.date | dt.datetime

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}
_UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def to_micros(value: Instant) -> int:
    """Microseconds since the epoch; values without a zone are UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (value - EPOCH) // dt.timedelta(microseconds=1)


def from_micros(us: int) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=us)


def ts_lit(us: int, dtype: T.DataType) -> Column:
    """A literal that Catalyst folds, so that it can reach the Parquet reader."""
    text = from_micros(us).isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        text += "+00:00"
    return F.lit(text).cast(dtype)


@dataclass(frozen=True)
class Width:
    """A bucket width: a fixed length or a number of calendar months."""

    micros: int = 0
    months: int = 0

    @classmethod
    def parse(cls, value: Width | str | dt.timedelta) -> Width:
        if isinstance(value, Width):
            return value
        if isinstance(value, dt.timedelta):
            width = cls(micros=value // dt.timedelta(microseconds=1))
        else:
            parts = re.findall(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)", value.strip().lower())
            if not parts or re.sub(r"\d+\s*[a-z]+|\s", "", value.strip().lower()):
                raise ValueError(f"not a width: {value!r}")
            micros = months = 0
            for count, unit in parts:
                if unit in _UNIT_MICROS:
                    micros += int(count) * _UNIT_MICROS[unit]
                elif unit in _UNIT_MONTHS:
                    months += int(count) * _UNIT_MONTHS[unit]
                else:
                    raise ValueError(f"unknown unit {unit!r} in {value!r}")
            width = cls(micros, months)
        if bool(width.micros > 0) == bool(width.months > 0):
            raise ValueError(f"a width is either a fixed length or months: {value!r}")
        return width

    def origin(self, value: Instant | None) -> int:
        """Monday 2000-01-03 for fixed widths, 2000-01-01 for months, unless given."""
        if value is None:
            value = "2000-01-01" if self.months else "2000-01-03"
        us = to_micros(value)
        if self.months and from_micros(us) != from_micros(us).replace(
            day=1, hour=0, minute=0, second=0, microsecond=0
        ):
            raise ValueError("the origin of a month grid is the first instant of a month")
        return us

    def floor(self, us: int, origin: Instant | None = None) -> int:
        """Start of the bucket that holds ``us``."""
        start = self.origin(origin)
        if not self.months:
            return us - (us - start) % self.micros
        first, at = from_micros(start), from_micros(us)
        gap = (at.year - first.year) * 12 + at.month - first.month
        return self.add(start, gap // self.months)

    def ceil(self, us: int, origin: Instant | None = None) -> int:
        start = self.floor(us, origin)
        return us if start == us else self.add(start, 1)

    def add(self, us: int, n: int) -> int:
        """``n`` widths after the bucket edge ``us``."""
        if not self.months:
            return us + n * self.micros
        at = from_micros(us)
        month = at.year * 12 + at.month - 1 + n * self.months
        return to_micros(at.replace(year=month // 12, month=month % 12 + 1))

    def interval(self) -> Column:
        """The width as a Spark interval."""
        if self.months:
            return F.expr(f"INTERVAL '{self.months}' MONTH")
        seconds, micros = divmod(self.micros, 1_000_000)
        return F.expr(f"INTERVAL '{seconds}.{micros:06d}' SECOND")


def fixed_micros(value: Width | str | dt.timedelta) -> int:
    width = Width.parse(value)
    if width.months:
        raise ValueError(f"a fixed length is needed here, not months: {value!r}")
    return width.micros


def ago(as_of: Instant, length: Width | str | dt.timedelta) -> dt.datetime:
    """``as_of - length``; month lengths keep the day where the month has it."""
    width = Width.parse(length)
    at = from_micros(to_micros(as_of))
    if not width.months:
        return at - dt.timedelta(microseconds=width.micros)
    month = at.year * 12 + at.month - 1 - width.months
    for day in range(at.day, 0, -1):
        try:
            return at.replace(year=month // 12, month=month % 12 + 1, day=day)
        except ValueError:
            continue
    raise ValueError(f"no day in the month {length} before {as_of}")


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

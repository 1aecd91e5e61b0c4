"""Elapsed time counted in unit boundaries crossed, as the host's datediff does."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (00:00:59 -> 00:01:01 is 1)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _col(start)),
                           F.date_trunc("minute", _col(end)))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", _col(start)),
                           F.date_trunc("second", _col(end)))


def ntz_literal(t: dt.datetime) -> Column:
    """A wall-clock timestamp literal, independent of any time zone setting."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

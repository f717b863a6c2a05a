"""Time helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_of(ts) -> Column:
    """H1: truncate to the hour, keeping the zone-less timestamp type.

    ``date_trunc`` widens ``timestamp_ntz`` to ``timestamp``; with the session
    zone at UTC the cast back is exact.
    """
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def parse_iso_utc(text) -> Column:
    """ISO-8601 text with or without offset -> UTC ``timestamp_ntz``.

    Text is parsed as an instant (offsets honoured) and then rendered as the
    UTC wall clock (the session zone is UTC, see ``session.build_session``).
    Casting text straight to ``timestamp_ntz`` would drop the offset. Text that
    is no time gives null (also in ANSI mode); the readers report such rows.
    """
    return F.try_to_timestamp(_c(text)).cast("timestamp_ntz")


def ts_literal(value) -> Column:
    """A fixed 'now' (or any instant) as a ``timestamp_ntz`` literal in UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value).cast("timestamp_ntz")


def days_before(ts: Column, days: int) -> Column:
    return ts - F.make_dt_interval(F.lit(days))

"""Epoch seconds to text, text to timestamp, run-date partition parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_to_text(epoch: Column) -> Column:
    """Epoch seconds -> 'yyyy-MM-dd HH:mm:ss' in the session time zone, whole seconds."""
    return F.date_format(F.timestamp_seconds(F.floor(epoch)), TS_FORMAT)


def text_to_ts(text: Column) -> Column:
    """Parse 'yyyy-MM-dd HH:mm:ss' (null when malformed)."""
    return F.try_to_timestamp(text, F.lit(TS_FORMAT))


def run_date_parts(run_date: str) -> tuple[str, str, str]:
    """Run date -> zero-padded ('yyyy', 'MM', 'dd'); the run date is a parameter."""
    d = _dt.date.fromisoformat(str(run_date)[:10])
    return f"{d.year:04d}", f"{d.month:02d}", f"{d.day:02d}"


def hour_stamp(run_ts: str) -> str:
    """N12: 'YYYYMMDDHH' name of an hourly hand-over folder."""
    t = _dt.datetime.fromisoformat(str(run_ts))
    return t.strftime("%Y%m%d%H")

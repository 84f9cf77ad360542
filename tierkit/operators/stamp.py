"""Stamp every row with the capture date and time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from tierkit.functions.stamps import capture_date, capture_time

# Column names of the capture stamp in the raw fact table.
DATE_COL = "fecha_consulta"
TIME_COL = "hora_consulta"


def stamp_capture(
    df: DataFrame,
    capture_ts: dt.datetime | str | Column | None = None,
    date_col: str = DATE_COL,
    time_col: str = TIME_COL,
) -> DataFrame:
    """Add ``date_col`` (date) and ``time_col`` (``HH:MM:SS`` text).

    ``capture_ts`` is one instant for the whole run (the wall-clock fields are
    used as given), or a column for per-row stamps.  Unset means "now" on the
    driver, which is what a polling job does.
    """
    ts = dt.datetime.now().replace(microsecond=0) if capture_ts is None else capture_ts
    return df.withColumns({date_col: capture_date(ts), time_col: capture_time(ts)})

"""Run-date handling (DAT-1, DAT-2).

A job date arrives as ``yyyyMMdd`` text and is read leniently: a day or
month past the end rolls into the next month or year (20180732 ->
20180801, 20181301 -> 20190101), as a lenient calendar does.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def _part(text: Column, start: int, length: int) -> Column:
    return F.trim(F.substring(text, start, length)).try_cast("int")


def normalise_date_col(text: Column) -> Column:
    """``yyyyMMdd`` text -> normalised ``yyyyMMdd`` text; malformed -> null."""
    y, m, d = _part(text, 1, 4), _part(text, 5, 2), _part(text, 7, 2)
    first_of_year = F.make_date(y, F.lit(1), F.lit(1))
    return F.date_format(
        F.date_add(F.add_months(first_of_year, m - 1), d - 1), "yyyyMMdd")


def normalise_job_date(text: str) -> int:
    """Driver-side form of :func:`normalise_date_col` for a run argument."""
    y, m, d = int(text[0:4].strip()), int(text[4:6].strip()), int(text[6:8].strip())
    months = y * 12 + (m - 1)
    first = _dt.date(months // 12, months % 12 + 1, 1)
    return int((first + _dt.timedelta(days=d - 1)).strftime("%Y%m%d"))


def year_of(job_date: int) -> int:
    return int(str(job_date)[0:4])

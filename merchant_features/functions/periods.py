"""Calendar anchors and window positions, all relative to an explicit reference date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_features.functions.columns import ColumnLike, as_column

MONTHS = 12
WEEKS = 4


def _shift_months(day: date, months: int) -> date:
    """First day of the month that lies ``months`` away from ``day``'s month."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class Anchors:
    """Dates every plan is built from.

    ``lastday`` closes the last full month, ``label_start`` opens it, and
    ``firstday`` opens the 13-month scan window.
    """

    date_ref: date
    firstday: date
    label_start: date
    lastday: date

    @property
    def period(self) -> str:
        return self.label_start.strftime("%Y-%m")

    @property
    def first_period(self) -> int:
        return self.firstday.year * 100 + self.firstday.month

    @property
    def last_period(self) -> int:
        return self.lastday.year * 100 + self.lastday.month

    def trailing_start(self, months: int = MONTHS) -> date:
        return _shift_months(self.date_ref, -months)


def anchors(date_ref: date) -> Anchors:
    return Anchors(
        date_ref=date_ref,
        firstday=_shift_months(date_ref, -13),
        label_start=_shift_months(date_ref, -1),
        lastday=date_ref.replace(day=1) - timedelta(days=1),
    )


def analysis_period(date_ref: date) -> str:
    """Label of the month before ``date_ref``; producers and readers share it."""
    return anchors(date_ref).period


def period_key(day: ColumnLike) -> Column:
    """Integer yyyymm of a date."""
    day = as_column(day)
    return F.year(day) * 100 + F.month(day)


def month_position(day: ColumnLike, date_ref: date) -> Column:
    """1 for the last full month before ``date_ref``, 2 for the one before it, and so on."""
    day = as_column(day)
    return F.lit(date_ref.year * 12 + date_ref.month) - (F.year(day) * 12 + F.month(day))


def week_position(day: ColumnLike, date_ref: date) -> Column:
    """1 for the seven days ending on the last day of the last full month, 2 for the seven before."""
    age = F.datediff(F.lit(anchors(date_ref).lastday), as_column(day))
    return F.when(age >= 0, F.floor(age / 7).cast("int") + 1)


def with_period(df: DataFrame, date_ref: date) -> DataFrame:
    """Stamp the process date and the analysis-period label."""
    return df.withColumns(
        {
            "fe_proceso": F.lit(date_ref),
            "id_periodo_analisis": F.lit(analysis_period(date_ref)),
        }
    )

from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchant_features.functions import periods

REFS = [date(2021, 12, 15), date(2021, 1, 31), date(2020, 3, 1), date(2021, 3, 30), date(2024, 2, 29)]


def test_anchors_of_an_ordinary_day():
    a = periods.anchors(date(2021, 12, 15))
    assert (a.lastday, a.firstday, a.label_start) == (date(2021, 11, 30), date(2020, 11, 1), date(2021, 11, 1))
    assert a.period == "2021-11"
    assert (a.first_period, a.last_period) == (202011, 202111)


@given(st.dates(min_value=date(2000, 2, 1), max_value=date(2100, 1, 1)))
@settings(max_examples=200, deadline=None)
def test_anchor_invariants(day):
    a = periods.anchors(day)
    assert a.lastday + timedelta(days=1) == day.replace(day=1)
    assert a.firstday.day == a.label_start.day == 1
    assert (a.lastday.year - a.firstday.year) * 12 + a.lastday.month - a.firstday.month == 12
    assert a.period == a.lastday.strftime("%Y-%m")


def test_month_end_days_share_the_previous_month():
    assert periods.analysis_period(date(2021, 1, 31)) == "2020-12"
    assert periods.analysis_period(date(2021, 3, 31)) == "2021-02"


@pytest.mark.parametrize("ref", REFS)
def test_windows_tile_the_calendar(spark, ref):
    a = periods.anchors(ref)
    span = (a.lastday - a.firstday).days
    days = spark.range(-40, span + 40).select(
        F.date_add(F.lit(a.firstday), F.col("id").cast("int")).alias("day")
    )
    rows = days.select(
        "day",
        periods.month_position("day", ref).alias("m"),
        periods.week_position("day", ref).alias("w"),
        periods.period_key("day").alias("k"),
    ).collect()
    for r in rows:
        months = (ref.year - r.day.year) * 12 + ref.month - r.day.month
        assert r.m == months
        assert r.k == r.day.year * 100 + r.day.month
        age = (a.lastday - r.day).days
        assert r.w == (age // 7 + 1 if age >= 0 else None)
    for i in range(1, 13):
        inside = [r.day for r in rows if r.m == i]
        assert min(inside).day == 1 and (max(inside) + timedelta(days=1)).day == 1
        assert len(inside) == (max(inside) - min(inside)).days + 1
    for i in range(1, 5):
        assert len([r for r in rows if r.w == i]) == 7


def test_with_period(frame):
    row = periods.with_period(frame("x int", (1,)), date(2021, 1, 31)).first()
    assert row.fe_proceso == date(2021, 1, 31)
    assert row.id_periodo_analisis == "2020-12"

from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import DATE_REF, one, values
from pyspark.sql import functions as F

from merchant_features.functions.periods import anchors
from merchant_features.operators import activation as AV

A = anchors(DATE_REF)
INSTALL = date(2021, 5, 10)
DAILY = (
    "nro_terminal string, nro_establecimiento_orig long, fecha_host_entrada_autoriz date, "
    "volumen decimal(28,2), cantidad long"
)
INSTALLED = "cuit string, nro_establecimiento_contrato string, nro_terminal string, fecha_instalacion date"
INDEX = "periodo int, indice double"


def sale(terminal, days, amount, est=1):
    return (terminal, est, INSTALL + timedelta(days=days), amount, 1)


def test_interval_join_is_closed_on_both_ends(frame):
    left = frame("t string, s date", ("a", INSTALL), ("b", INSTALL))
    right = frame("t string, d date, v int", *[("a", INSTALL + timedelta(days=n), n) for n in (-1, 0, 30, 31)])
    got = AV.interval_join(left, right, "t", "s", "d")
    assert values(got, "t", "v") == sorted([("a", 0), ("a", 30), ("b", None)], key=repr)


def test_cumulative_volume_is_non_decreasing(spark):
    df = spark.range(300).select(
        (F.col("id") % 5).alias("k"), F.col("id").alias("o"), (F.col("id") % 7).cast("decimal(18,2)").alias("v")
    )
    rows = AV.cumulative_volume(df, ["k"], "o", "v").orderBy("k", "o").collect()
    for before, after in zip(rows, rows[1:], strict=False):
        if before.k == after.k:
            assert after.vol_cum == before.vol_cum + after.v >= before.vol_cum
        else:
            assert after.vol_cum == after.v


def outcomes(frame, *sales, index=((202105, 1.0),), install=INSTALL):
    installed = frame(INSTALLED, ("T1", "1", "t", install))
    installs = AV.installs_in_window(installed, A)
    return installs, AV.install_outcomes(installs, frame(DAILY, *sales), frame(INDEX, *index), A)


def test_outcomes_of_an_install(frame):
    _, got = outcomes(
        frame, sale("t", 2, 80000), sale("t", 2, 4999.99, est=2), sale("t", 5, 0.01), sale("t", 31, 9e6), sale("t", -1, 9e6)
    )
    row = one(got)
    assert (float(row.monto_30), row.indice, row.dias_1tx, row.dias_85000) == (85000.0, 1.0, 2, 5)


@pytest.mark.parametrize(
    ("index", "dias", "level"),
    [(((202105, 2.0),), None, 0), (((202105, 0.5),), 2, 1), (((202105, None),), None, 1), (((202105, 0.0),), 2, 1)],
)
def test_threshold_follows_the_index(frame, index, dias, level):
    installs, got = outcomes(frame, sale("t", 2, 85000), index=index)
    assert one(got).dias_85000 == dias
    assert one(AV.activation_levels(installs, got)).nivel_activacion == level


def test_install_month_without_index_vanishes(frame):
    installs, got = outcomes(frame, sale("t", 2, 85000), index=((202104, 1.0),))
    assert got.count() == 0
    assert AV.activation_levels(installs, got).count() == 0
    assert AV.owner_days(installs, got).count() == 0


def test_terminal_without_sales(frame):
    installs, got = outcomes(frame)
    row = one(got)
    assert (row.monto_30, row.dias_1tx, row.dias_85000) == (None, None, None)
    assert one(AV.activation_levels(installs, got)).nivel_activacion == 0
    days = one(AV.owner_days(installs, got))
    assert (days.avg_dias_1tx, days.avg_dias_85000) == (180.0, 180.0)


def test_installs_outside_the_window_are_dropped(frame):
    installed = frame(
        INSTALLED, ("T", "1", "a", A.firstday), ("T", "1", "b", A.lastday), ("T", "1", "c", A.lastday + timedelta(days=1)),
        ("T", "1", "d", A.firstday - timedelta(days=1)), ("T", "S/N", "e", A.lastday), ("T", "1", "a", A.firstday),
    )
    got = AV.installs_in_window(installed, A)
    assert values(got, "nro_terminal") == [("a",), ("b",), ("e",)]
    assert got.where("nro_establecimiento IS NULL").count() == 1


def test_level_counts_and_owner_days(frame):
    installed = frame(
        INSTALLED, ("T1", "1", "a", INSTALL), ("T1", "1", "b", INSTALL), ("T1", "2", "c", INSTALL), ("T2", "9", "z", INSTALL),
    )
    installs = AV.installs_in_window(installed, A)
    daily = frame(DAILY, sale("a", 0, 90000), sale("b", 4, 10), sale("c", 8, 85000))
    got = AV.install_outcomes(installs, daily, frame(INDEX, (202105, 1.0)), A)
    levels = AV.activation_levels(installs, got)
    counts = AV.level_counts(levels)
    assert values(counts.select("cuit", F.col("nro_establecimiento").cast("int"), "terminales_nivel_0", "terminales_nivel_1")) == [
        ("T1", 1, 1, 1), ("T1", 2, 0, 1), ("T2", 9, 1, 0),
    ]
    days = AV.owner_days(installs, got)
    assert values(days) == [("T1", 4.0, 4.0), ("T2", 180.0, 180.0)]


@pytest.mark.parametrize(
    ("amount", "expected"),
    [(84999.99, 0), (85000.0, 1), (500000000.0, 1), (500000000.01, 0), (None, 0)],
)
def test_label_bounds(frame, amount, expected):
    df = frame("a double", (amount,))
    assert one(df.select(AV.label_class(F.col("a")).alias("x"))).x == expected


@pytest.mark.parametrize("weighting", ["none", "rows"])
def test_label_adjusts_by_the_lowest_index_and_weighting(frame, weighting):
    establishments = frame(
        "cuit_establecimiento_host string, nro_establecimiento long", ("T1", 1), ("T1", 2), ("T2", 3)
    )
    installed = frame(
        INSTALLED, ("T1", "1", "a", date(2021, 5, 1)), ("T1", "1", "b", date(2021, 6, 1)), ("T9", "2", "c", date(2021, 5, 1)),
    )
    index = frame(INDEX, (202105, 1.5), (202106, 1.2))
    day = date(2021, 11, 15)
    daily = frame(
        DAILY, ("a", 1, day, 50000, 1), ("b", 1, day, 50000, 1), ("c", 2, day, 70000, 1), ("c", 2, date(2021, 10, 31), 1e6, 1)
    )
    labels = AV.establishment_label(establishments, installed, index, daily, A, weighting)
    factor = 2 if weighting == "rows" else 1
    assert values(labels) == sorted(
        [("T1", 1, 1, 100000 * 1.2 * factor), ("T1", 2, 0, 70000.0), ("T2", 3, 0, None)], key=repr
    )
    assert values(AV.owner_label(labels)) == sorted([("T1", 1, 100000 * 1.2 * factor), ("T2", 0, None)], key=repr)

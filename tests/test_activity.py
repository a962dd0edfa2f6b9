from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

import pytest
from conftest import DATE_REF, one, plan, values
from pyspark.sql import functions as F

from merchant_features.functions.periods import anchors
from merchant_features.operators import activity as AC

A = anchors(DATE_REF)
MOVEMENT = (
    "nro_establecimiento long, fecha_movimiento date, cod_tipo_operacion string, "
    "monto_movimiento decimal(18,2), monto_movimiento_origen decimal(18,2)"
)
AUTH = (
    "nro_terminal string, nro_establecimiento_orig long, fecha_host_entrada_autoriz timestamp, "
    "cod_respuesta_autorizacion int, cod_tipo_mensaje_autoriz int, nro_autorizacion string, "
    "monto_autoriz_moneda_orig decimal(18,2), programa_periferia_origen int, datos_adicionales_2 string"
)


def auth(terminal="07000001", est=1, day=datetime(2021, 11, 10, 9), code=0, amount=500, program=535000,
         tech="W", number="1"):
    return (terminal, est, day, code, 1100, number, amount, program, f"xx{tech}0000")


def test_daily_movements(frame):
    day = date(2021, 11, 30)
    df = frame(
        MOVEMENT,
        (1, day, "0005", 10.5, 1), (1, day, "0005", 1.5, 1), (1, day, "0510", 7, 3.25),
        (1, day, "0999", 100, 100), (1, day, "0005", 0, 1), (1, day + timedelta(days=1), "0005", 9, 9),
        (2, A.firstday, "0510", 4, 2),
    )
    got = values(
        AC.daily_movements(df, A.firstday, A.lastday).select(
            "nro_establecimiento", *[F.col(c).cast("double") for c in ("cant", "vol", "cant_usd", "vol_usd")]
        )
    )
    assert got == [(1, 2.0, 12.0, 1.0, 3.25), (2, 0.0, 0.0, 1.0, 2.0)]


def _edge_days():
    last = A.lastday
    return {
        "m1": [date(2021, 11, 1), last], "m2": [date(2021, 10, 31)], "m12": [date(2020, 12, 1), date(2020, 12, 31)],
        "m13": [date(2020, 11, 30)], "after": [last + timedelta(days=1)],
        "w1": [last, last - timedelta(days=6)], "w2": [last - timedelta(days=7)],
        "w4": [last - timedelta(days=21), last - timedelta(days=27)], "w5": [last - timedelta(days=28)],
    }


@pytest.mark.parametrize("name", list(_edge_days()))
def test_window_edges(frame, name):
    days = _edge_days()[name]
    df = frame("k int, d date, x int", *[(1, d, 1) for d in days], (1, date(2021, 6, 15), 0))
    row = one(AC.trailing_features(df, "k", "d", {"x": "x"}, DATE_REF))
    inside = f"x_{name}"
    if inside in row.asDict():
        assert row[inside] == len(days)
    else:
        outside = [c for c in row.asDict() if c.startswith("x_m")]
        expected = sum(1 for d in days if date(2020, 12, 1) <= d <= A.lastday)
        assert sum(row[c] for c in outside) == expected


def test_one_pass_equals_separate_windows_and_joins(spark):
    df = spark.range(4000).select(
        (F.col("id") % 13).alias("k"),
        F.date_add(F.lit(date(2020, 10, 20)), (F.col("id") * 7 % 430).cast("int")).alias("d"),
        (F.col("id") % 100).cast("decimal(18,2)").alias("x"),
    )
    got = AC.trailing_features(df, "k", "d", {"x": "x"}, DATE_REF)
    windows, end = {}, A.lastday
    for i in range(1, 13):
        windows[f"x_m{i}"] = (end.replace(day=1), end)
        end = end.replace(day=1) - timedelta(days=1)
    for i in range(1, 5):
        windows[f"x_w{i}"] = (A.lastday - timedelta(days=7 * i - 1), A.lastday - timedelta(days=7 * i - 7))
    keys = df.where(F.col("d").between(date(2020, 12, 1), A.lastday)).select("k").distinct()
    parts = [
        df.where(F.col("d").between(*bounds)).groupBy("k").agg(F.sum("x").alias(name))
        for name, bounds in windows.items()
    ]
    joined = reduce(lambda a, b: a.join(b, "k", "left"), parts, keys).fillna(0)
    columns = ["k", *windows]
    assert values(got, *columns) == values(joined, *columns)
    assert plan(got).count("Exchange hashpartitioning") <= 1


def test_trailing_months_only_and_weeks_only(frame):
    df = frame("k int, d date, x int", (1, A.lastday, 2), (1, date(2021, 10, 5), 3))
    months = one(AC.trailing_months(df, "k", "d", {"x": "x"}, DATE_REF, months=2))
    assert months.asDict() == {"k": 1, "x_m1": 2, "x_m2": 3}
    weeks = one(AC.trailing_weeks(df, "k", "d", {"x": "x"}, DATE_REF))
    assert weeks.asDict() == {"k": 1, "x_w1": 2, "x_w2": 0, "x_w3": 0, "x_w4": 0}


def test_deflated_months_equal_row_by_row_deflation(frame):
    df = frame(
        "k int, d date, n int, v decimal(18,2)",
        (1, date(2021, 11, 3), 2, 300), (1, date(2021, 11, 4), 1, 150.5), (1, date(2021, 10, 4), 1, 70),
        (1, date(2021, 9, 4), 1, 80), (2, date(2021, 11, 4), 5, 10),
    )
    index = frame("periodo int, indice double", (202111, 1.5), (202109, None), (202001, 9.0))
    got = AC.trailing_months_deflated(df, "k", "d", {"n": "n"}, {"v": "v"}, index, DATE_REF, months=3)
    rows = {r.k: r.asDict() for r in got.collect()}
    assert rows[1]["n_m1"] == 3 and rows[1]["v_m1"] == pytest.approx((300 + 150.5) / 1.5)
    assert rows[1]["v_m2"] == 70.0 and rows[1]["v_m3"] == 80.0
    assert rows[2] == {"k": 2, "n_m1": 5, "v_m1": 10 / 1.5, "n_m2": 0, "v_m2": 0.0, "n_m3": 0, "v_m3": 0.0}


def test_daily_authorisations_and_terminal_volume(frame):
    df = frame(
        AUTH,
        auth(amount=100), auth(amount=50), auth(amount=0), auth(code=100), auth(code=900, number=" "),
        auth(code=900, number="5", amount=10, est=2), auth(program=525000), auth(terminal="17010499"),
        auth(day=datetime(2021, 11, 30, 22), amount=7), auth(day=datetime(2021, 12, 1), amount=8),
    )
    daily = AC.daily_authorizations(df, A.firstday, A.lastday)
    got = values(daily.select("nro_terminal", "nro_establecimiento_orig", "fecha_host_entrada_autoriz",
                              F.col("volumen").cast("double"), "cantidad"))
    assert got == [
        ("07000001", 1, date(2021, 11, 10), 150.0, 2), ("07000001", 1, date(2021, 11, 30), 7.0, 1),
        ("07000001", 2, date(2021, 11, 10), 10.0, 1),
    ]
    volumes = AC.daily_by_terminal(daily, A.firstday, A.lastday)
    assert values(volumes.select("fecha_host_entrada_autoriz", F.col("suma_monto").cast("double"))) == [
        (date(2021, 11, 10), 160.0), (date(2021, 11, 30), 7.0),
    ]


def test_the_summary_reads_like_the_direct_operators(frame):
    rows = [
        auth(terminal=t, est=e, day=datetime(2021, 11, 1) + timedelta(days=i % 9), code=c, amount=a, program=p, tech=k)
        for i, (t, e, c, a, p, k) in enumerate(
            (t, e, c, a, p, k)
            for t in ("07000001", "99000002", "08000003", "17010499") for e in (1, 2) for c in (0, 100)
            for a in (0, 299.99, 300) for p in (535000, 525000, 19500, 1) for k in "WD"
        )
    ]
    df = frame(AUTH, *rows)
    summary = AC.summarise_authorisations(df)
    direct = AC.daily_authorizations(df, A.firstday, A.lastday)
    assert values(AC.acquiring_days(summary), *direct.columns) == values(direct)
    direct = AC.terminal_activity(df, A.lastday)
    assert values(AC.terminal_days(summary, A.lastday), *direct.columns) == values(direct)
    history = frame("nro_establecimiento long", (1,), (2,))
    direct = AC.daily_establishment_activity(df, history)
    known = AC.of_known_establishments(AC.establishment_days(summary), history)
    assert values(known, *direct.columns) == values(direct)


def test_establishment_activity_weightings(frame):
    df = frame(AUTH, auth(amount=10), auth(amount=5, day=datetime(2021, 11, 12)), auth(est=9))
    history = frame(
        "nro_establecimiento long, fecha_inicio timestamp, fecha_fin timestamp",
        (1, datetime(2021, 1, 1), datetime(2021, 11, 11)), (1, datetime(2021, 11, 1), datetime(9999, 12, 31)),
    )
    def run(weighting):
        got = AC.daily_establishment_activity(df, history, weighting=weighting)
        return values(got.select("fecha_host_entrada_autoriz", "cantidad_transacciones",
                                 F.col("volumen_transacciones").cast("double")))
    assert run("none") == [(date(2021, 11, 10), 1, 10.0), (date(2021, 11, 12), 1, 5.0)]
    assert run("rows") == [(date(2021, 11, 10), 2, 20.0), (date(2021, 11, 12), 2, 10.0)]
    assert run("valid") == [(date(2021, 11, 10), 2, 20.0), (date(2021, 11, 12), 1, 5.0)]
    with pytest.raises(ValueError):
        run("other")


def test_terminal_activity(frame):
    df = frame(
        AUTH, auth(tech="D"), auth(tech="G", day=datetime(2021, 11, 20)), auth(tech="X"), auth(amount=299.99, tech="W"),
        auth(code=100, tech="W"), auth(terminal="08000001"),
    )
    row = one(AC.terminal_activity(df, A.lastday))
    assert (row.ultima_fecha_actividad, row.dias_sin_actividad, row.rango_tecnologia) == (date(2021, 11, 20), 10, 2)
    assert (row.q_tx_wifi, row.q_tx_gsm, row.q_tx_ethernet, row.q_tx_dialup) == (0, 1, 0, 1)


def test_terminals_and_per_unit_measures(frame):
    df = frame("k int, nro_terminal string", (1, "a"), (1, "a"), (1, "b"), (2, None))
    counted = AC.terminals_per(df, "k")
    assert values(counted) == [(1, 2), (2, 0)]
    measured = counted.join(frame("k int, x int", (1, 7)), "k", "left")
    got = AC.per_unit_measures(measured, ["x"], "cant_term").select("k", F.col("x").cast("double"))
    assert values(got) == [(1, 3.5), (2, 0.0)]

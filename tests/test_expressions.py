from __future__ import annotations

from datetime import date

import duckdb
import pytest
from conftest import one, values
from pyspark.sql import functions as F

from merchant_features.functions import expressions as E
from merchant_features.functions import geo as G


def evaluate(frame, expression, schema, *row):
    return one(frame(schema, row).select(expression.alias("x"))).x


@pytest.mark.parametrize(
    ("parts", "expected"),
    [
        (("Mitre", "10", "Lanus", "BUENOS AIRES"), "Mitre, 10, Lanus, BUENOS AIRES, ARGENTINA"),
        (("", None, "Lanus", "BUENOS AIRES"), "Lanus, BUENOS AIRES, ARGENTINA"),
        ((None, "", None, ""), "ARGENTINA"),
        (("Mitre", None, "", None), "Mitre, ARGENTINA"),
    ],
)
def test_format_address(frame, parts, expected):
    got = evaluate(frame, E.format_address("a", "b", "c", "d"), "a string, b string, c string, d string", *parts)
    assert got == expected


@pytest.mark.parametrize(
    ("text", "rank"),
    [("xxW0000", 1), ("G0000", 2), ("zzzE1234", 3), ("D9999", 4), ("X0000", 9), ("", 9), (None, 9)],
)
def test_technology_rank(frame, text, rank):
    assert evaluate(frame, E.tech_rank(E.tech_code("a")), "a string", text) == rank


@pytest.mark.parametrize(
    ("rank", "prefix", "label"),
    [(1, "51", "WIFI"), (2, "07", "GSM"), (3, "07", "ETHERNET"), (4, "07", "DIAL_UP"),
     (9, "5100", "PINPAD"), (9, "A1", "SIN DATO"), (None, "51", "PINPAD"), (None, None, "SIN DATO")],
)
def test_technology_label(frame, rank, prefix, label):
    assert evaluate(frame, E.tech_label("r", "p"), "r int, p string", rank, prefix) == label


def test_terminal_number(frame):
    assert evaluate(frame, E.terminal_number("p", "s"), "p string, s string", "0799", "123") == "07123"
    assert evaluate(frame, E.terminal_number("p", "s"), "p string, s string", "0799", None) is None


def _reference_band(days: int) -> str | None:
    months = days / 30
    if months <= 1:
        return "Activo"
    for low, high, label in ((1, 2.9999, "1 a 3"), (3, 5.9999, "3 a 6"), (6, 8.9999, "6 a 9"), (9, 11.9999, "9 a 12")):
        if low <= months <= high:
            return label
    return "Mas de 12" if months >= 12 else None


def test_inactivity_bands_on_every_day(spark):
    rows = spark.range(0, 500).select(
        "id", E.inactivity_band(F.col("id") / F.lit(30.0)).alias("band")
    ).collect()
    assert {r.id: r.band for r in rows} == {d: _reference_band(d) for d in range(500)}


def test_months_inactive_tolerance(frame):
    schema = "i date, l date, d int"
    e = E.months_inactive("i", "l", "d")
    assert evaluate(frame, e, schema, date(2021, 1, 16), date(2021, 1, 1), 90) == 3.0
    assert evaluate(frame, e, schema, date(2021, 1, 17), date(2021, 1, 1), 90) is None
    assert evaluate(frame, e, schema, date(2020, 1, 1), date(2021, 1, 1), 0) == 0.0
    assert evaluate(frame, e, schema, date(2020, 1, 1), None, None) is None


def test_flags(frame):
    assert evaluate(frame, E.flag_present("a"), "a string", "x") == "SI"
    assert evaluate(frame, E.flag_present("a"), "a string", None) == "NO"
    for bank, expected in ((16, "NO"), (499, "NO"), (None, "NO"), (7, "SI")):
        assert evaluate(frame, E.accepts_settlement("b"), "b int", bank) == expected


@pytest.mark.parametrize(
    ("recommended", "current", "expected"),
    [("Cambiar Equipo", "a", "Cambiar Equipo"), ("Sin modelo", "a", "Sin Dato"), (None, "a", "Sin Dato"),
     ("b", "a", "Cambiar Soft"), ("a", "a", "Soft Correcto"), ("a", None, "Mal")],
)
def test_software_condition(frame, recommended, current, expected):
    got = evaluate(frame, E.software_condition("r", "c"), "r string, c string", recommended, current)
    assert got == expected


def test_index_arithmetic(frame):
    schema = "a decimal(18,2), i double"
    assert evaluate(frame, E.deflate("a", "i"), schema, 300, 1.5) == 200.0
    assert evaluate(frame, E.deflate("a", "i"), schema, 300, None) == 300.0
    assert evaluate(frame, E.inflate("a", "i"), schema, 300, 1.5) == 450.0
    assert evaluate(frame, E.inflate("a", "i"), schema, 300, 0.0) == 300.0
    assert evaluate(frame, E.inflate("a", "i"), schema, 300, None) == 300.0
    assert evaluate(frame, E.inflate("a", "i"), schema, None, 1.5) is None


def test_per_unit(frame):
    assert evaluate(frame, E.per_unit("a", "b"), "a int, b int", 10, 3) == 3.33
    assert evaluate(frame, E.per_unit("a", "b"), "a int, b int", 10, 0) is None


def test_per_unit_takes_ties_as_sql_does(frame):
    """Ratios whose shortest decimal text and double are on different sides of a tie."""
    for a, b in ((1136144.9, 4), (815729.625, 5), (213476.775, 5), (-213476.775, 5), (2.675, 1), (1.005, 1)):
        told = duckdb.execute("SELECT round(CAST(? AS DOUBLE) / ?, 2)", [a, b]).fetchall()[0][0]
        assert evaluate(frame, E.per_unit("a", "b"), "a double, b int", a, b) == told, (a, b)


def test_phone_and_names(frame):
    assert evaluate(frame, E.phone_number("a", "b"), "a string, b string", "011", "4444") == "011-4444"
    assert evaluate(frame, E.phone_number("a", "b"), "a string, b string", None, "4444") is None
    assert evaluate(frame, E.first_name(["a", "b", "c"]), "a string, b string, c string", None, "y", "z") == "y"


def test_sanitize_geo(frame):
    df = frame(
        "p string, desc_departamento_geo string, latitud double, longitud double",
        ("BUENOS AIRES", "Comuna 5", -34.6, -58.4),
        ("BUENOS AIRES", "Moron", -34.7, -58.5),
        ("BUENOS AIRES", None, -34.8, -58.6),
        (None, "Comuna 5", -34.9, -58.7),
        ("SALTA", "Comuna 5", -24.0, -65.0),
    )
    got = values(df.select(*[e.alias(n) for n, e in G.sanitize_geo("p").items()]))
    assert got == sorted(
        [(0.0, 0.0, None), (-34.7, -58.5, "Moron"), (-34.8, -58.6, None), (-34.9, -58.7, "Comuna 5"),
         (-24.0, -65.0, "Comuna 5")],
        key=repr,
    )


@pytest.mark.parametrize(
    ("a", "b", "km"),
    [((0, 0), (0, 180), 3.141592653589793 * 6371.01), ((0, 0), (0, 0), 0.0), ((90, 0), (-90, 50), 3.141592653589793 * 6371.01),
     ((10, 179.99), (10, -179.99), 2.19007), ((-34.6, -58.4), (-34.6, -58.3), 9.15272)],
)
def test_great_circle(frame, a, b, km):
    got = evaluate(
        frame, G.great_circle_km("a", "b", "c", "d"), "a double, b double, c double, d double",
        float(a[0]), float(a[1]), float(b[0]), float(b[1]),
    )
    assert got == pytest.approx(km, abs=1e-3)

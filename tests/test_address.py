from __future__ import annotations

from datetime import datetime

from conftest import values
from pyspark.sql import functions as F

from merchant_features.operators import address as AD

OPEN = datetime(9999, 12, 31)
SCHEMA = (
    "nro_establecimiento long, fecha_fin timestamp, calle string, numero string, codigo_postal4 string, "
    "cod_localidad int, nombre_localidad string, cod_tipo_direccion string, "
    "cod_region_geografica_host string, id_carga long"
)


def address(est, kind, street, load, number=None, region="B01", end=OPEN):
    return (est, end, street, number, "1000", 5, "Lanus", kind, region, load)


def provinces(frame):
    return frame("cod_provincia string, desc_provincia string", ("B", "BUENOS AIRES"))


def base(frame, *ids):
    return frame("nro_establecimiento long", *[(i,) for i in ids])


def test_typed_addresses(frame):
    df = frame(SCHEMA, address(1, "2", None, 1), address(1, "1", "Mitre", 2, "10", "Z9"),
               address(2, "2", "Roca", 3, end=datetime(2020, 1, 1)))
    got = AD.typed_addresses(df, provinces(frame), "2")
    assert values(got, "nro_establecimiento", "nombre_calle", "numero_calle", "cod_provincia", "direccion") == [
        (1, "", "", "B", "Lanus, BUENOS AIRES, ARGENTINA"),
        (2, "Roca", "", "B", "Roca, Lanus, BUENOS AIRES, ARGENTINA"),
    ]
    other = AD.typed_addresses(df, provinces(frame), "1")
    assert values(other, "cod_provincia", "direccion") == [(None, "Mitre, 10, Lanus, ARGENTINA")]
    assert values(AD.typed_addresses(df, provinces(frame), "2", current_only=True), "nro_establecimiento") == [(1,)]


def _naive(base_df, primary, secondary):
    a = primary.select("nro_establecimiento", *[F.col(c).alias("a_" + c) for c in AD.ADDRESS_FIELDS])
    b = secondary.select("nro_establecimiento", *[F.col(c).alias("b_" + c) for c in AD.ADDRESS_FIELDS])
    joined = base_df.join(a, "nro_establecimiento", "left").join(b, "nro_establecimiento", "left")
    unusable = F.col("a_nombre_calle").isNull() | (F.col("a_nombre_calle") == "")
    return joined.select(
        "nro_establecimiento",
        *[F.when(unusable, F.col("b_" + c)).otherwise(F.col("a_" + c)).alias(c) for c in AD.ADDRESS_FIELDS],
    ).distinct()


def test_fallback_equals_the_fanned_out_join(frame):
    rows = [
        address(1, "2", "A", 1), address(1, "2", "", 2), address(1, "1", "X", 3), address(1, "1", "Y", 4),
        address(2, "2", "", 5), address(2, "2", None, 6),
        address(3, "1", "Z", 7), address(3, "1", "Z", 8),
        address(4, "2", "B", 9), address(4, "2", "B", 10), address(4, "1", "W", 11),
        address(6, "2", "C", 12),
    ]
    df, ids = frame(SCHEMA, *rows), base(frame, 1, 2, 3, 4, 5)
    got = AD.unified_addresses(ids, df, provinces(frame))
    expected = _naive(
        ids, AD.typed_addresses(df, provinces(frame), "2"), AD.typed_addresses(df, provinces(frame), "1")
    )
    columns = ["nro_establecimiento", *AD.ADDRESS_FIELDS]
    assert values(got, *columns) == values(expected, *columns)
    assert values(got, "nro_establecimiento", "nombre_calle") == sorted(
        [(1, "A"), (1, "X"), (1, "Y"), (2, None), (3, "Z"), (4, "B"), (5, None)], key=repr
    )


def test_latest_addresses_decide_per_type(frame):
    df = frame(
        SCHEMA, address(1, "2", "old", 1), address(1, "2", "", 2), address(1, "1", "X", 3), address(1, "1", "Y", 4),
        address(2, "2", "A", 5), address(2, "1", "B", 6),
    )
    got = AD.latest_unified_addresses(base(frame, 1, 2, 3), df, provinces(frame))
    assert values(got, "nro_establecimiento", "nombre_calle") == sorted(
        [(1, "Y"), (2, "A"), (3, None)], key=repr
    )

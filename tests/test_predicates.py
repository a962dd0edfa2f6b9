from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from merchant_features.functions import predicates as P

LO, HI = date(2020, 11, 1), date(2021, 11, 30)


def test_in_range_counts_the_whole_last_day(frame):
    df = frame(
        "id int, ts timestamp, d date",
        (1, datetime(2020, 10, 31, 23, 59), date(2020, 10, 31)),
        (2, datetime(2020, 11, 1), date(2020, 11, 1)),
        (3, datetime(2021, 11, 30, 18, 30), date(2021, 11, 30)),
        (4, datetime(2021, 12, 1), date(2021, 12, 1)),
    )
    assert values(df.where(P.in_range("ts", LO, HI)), "id") == [(2,), (3,)]
    assert values(df.where(P.in_range("d", LO, HI)), "id") == [(2,), (3,)]


def test_validity_window(frame):
    df = frame(
        "id int, s timestamp, e timestamp",
        (1, datetime(2019, 1, 1), datetime(2020, 11, 1, 12)),
        (2, datetime(2019, 1, 1), datetime(2020, 11, 2)),
        (3, datetime(2021, 11, 30, 9), datetime(9999, 12, 31)),
        (4, datetime(2021, 12, 1), datetime(9999, 12, 31)),
        (5, datetime(2019, 1, 1), None),
    )
    assert values(df.where(P.valid_in_window("s", "e", LO, HI)), "id") == [(2,), (3,)]
    assert values(df.where(P.valid_in_window("s", "e", LO, HI, null_is_open=True)), "id") == [(2,), (3,), (5,)]
    assert values(df.where(P.is_current("e")), "id") == [(3,), (4,)]


@pytest.mark.parametrize(
    ("code", "number", "expected"),
    [(0, None, True), (7, "", True), (400, "x", True), (100, "123", False), (900, "123", True),
     (900, "   ", False), (900, None, False), (None, "1", False)],
)
def test_approved(frame, code, number, expected):
    df = frame("c int, n string", (code, number))
    assert (df.where(P.is_approved("c", "n")).count() == 1) is expected


def test_transaction_scopes(frame):
    schema = (
        "id int, cod_tipo_mensaje_autoriz int, programa_periferia_origen int, nro_terminal string, "
        "monto_autoriz_moneda_orig decimal(18,2)"
    )
    df = frame(
        schema,
        (1, 1100, 530000, "07000001", 1),
        (2, 1100, 549999, "07000001", 1),
        (3, 1100, 550000, "07000001", 1),
        (4, 1100, 19500, "07000001", 1),
        (5, 1200, 535000, "07000001", 1),
        (6, 1100, 535000, "17010499", 1),
        (7, 1100, 535000, "07000001", 0),
        (8, 1100, 520000, "07000001", 0),
        (9, 1100, 535000, None, 1),
    )
    assert values(df.where(P.is_acquiring_txn()), "id") == [(1,), (2,)]
    assert values(df.where(P.is_network_txn(P.ACTIVITY_PROGRAMS)), "id") == [(1,), (2,), (4,), (7,), (8,)]


def test_prefix_lists(frame):
    df = frame("t string", ("07123",), ("08123",), ("51123",), ("99123",), (None,))
    assert values(df.where(P.has_prefix("t", P.UNIVERSE_PREFIXES))) == [("07123",), ("08123",), ("51123",)]
    assert values(df.where(P.has_prefix("t", P.INSTALLED_PREFIXES))) == [("07123",), ("51123",)]
    assert len(P.UNIVERSE_PREFIXES) == 22 and len(P.INSTALLED_PREFIXES) == 21


def test_min_amount(frame):
    df = frame("a decimal(18,2)", (0,), (299.99,), (300,))
    assert df.where(P.min_amount("a", 300)).count() == 1
    assert df.where(P.min_amount("a", 0, strict=True)).count() == 2


def test_date_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.date_add(F.lit(LO), F.col("id").cast("int")).alias("d"),
        F.date_add(F.lit(LO), F.col("id").cast("int")).cast("timestamp").alias("ts"),
        "id",
    ).write.parquet(path)
    for column in ("d", "ts"):
        df = spark.read.parquet(path).where(P.in_range(column, LO, date(2020, 11, 5))).select("id")
        text = plan(df)
        assert f"GreaterThanOrEqual({column}" in text and f"LessThan({column}" in text
        assert df.count() == 5

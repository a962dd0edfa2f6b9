from __future__ import annotations

from datetime import date, datetime

from conftest import one, values

from merchant_features.operators import contracts as K

SCHEMA = "s string, b byte, i int, l long, f float, d double, n decimal(18,2), t date, ts timestamp, q boolean"
FULL = ("a", 1, 2, 3, 1.5, 2.5, 7.25, date(2021, 1, 2), datetime(2021, 1, 2), True)
EMPTY = (None,) * 10


def test_feature_types(frame):
    got = K.to_feature_types(frame(SCHEMA, FULL, EMPTY))
    assert dict(got.dtypes) == {
        "s": "string", "b": "bigint", "i": "bigint", "l": "bigint", "f": "double", "d": "double", "n": "string",
        "t": "string", "ts": "timestamp", "q": "boolean",
    }
    assert values(got) == sorted(
        [
            ("a", 1, 2, 3, 1.5, 2.5, "7.25", "2021-01-02", datetime(2021, 1, 2), True),
            (None, -1, -1, -1, None, None, None, None, None, None),
        ],
        key=repr,
    )


def test_strings_only_and_null_text(frame):
    got = K.to_feature_types(frame(SCHEMA, EMPTY), strings_only=True, null_string="None")
    assert dict(got.dtypes)["i"] == "int" and dict(got.dtypes)["f"] == "float"
    row = one(got)
    assert (row.s, row.i, row.n, row.t, row.ts, row.q) == ("None", None, "None", "None", None, None)


def test_cast_to_schema(frame):
    df = frame("a decimal(18,2), b string, c int", (12.75, "x", None))
    got = K.cast_to_schema(
        df, {"n": "int", "f": "float", "b": "string", "c": "int"}, rename={"n": "a", "f": "a"}, defaults={"c": 0}
    )
    assert got.dtypes == [("n", "int"), ("f", "float"), ("b", "string"), ("c", "int")]
    assert values(got) == [(12, 12.75, "x", 0)]


def test_text_that_is_no_number_becomes_null(frame):
    got = K.cast_to_schema(frame("a string, b string", ("7", "x7")), {"a": "int", "b": "int"}, defaults={"b": 0})
    assert values(got) == [(7, 0)]


def test_typed_nulls_and_fill(frame):
    got = K.add_nulls(frame("a int", (None,)), {"s": "string", "d": "date"})
    assert got.dtypes == [("a", "int"), ("s", "string"), ("d", "date")]
    assert values(K.fill_numeric(got)) == [(0, None, None)]

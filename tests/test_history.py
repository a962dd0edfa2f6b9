from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from merchant_features.operators import history as H
from merchant_features.operators import lookup as L

SCHEMA = "k int, v int, x string"


def test_latest_and_first_version(frame):
    df = frame(SCHEMA, (1, 5, "old"), (1, 7, "new"), (2, 1, "only"), (3, None, "null"), (3, 0, "zero"))
    latest = H.top1_per_key(df, ["k"], [F.col("v").desc_nulls_last()])
    assert values(latest) == [(1, 7, "new"), (2, 1, "only"), (3, 0, "zero")]
    first = H.top1_per_key(df, ["k"], [F.col("v").asc_nulls_first()])
    assert values(first) == [(1, 5, "old"), (2, 1, "only"), (3, None, "null")]


def test_ties_are_settled_by_the_other_columns(frame):
    df = frame(SCHEMA, (1, 5, "b"), (1, 5, "a"), (1, 5, None))
    for _ in range(3):
        assert values(H.top1_per_key(df.repartition(3), ["k"], [F.col("v").desc()])) == [(1, 5, "a")]


def test_one_row_per_key_and_a_group_limit_below_the_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    top = H.top1_per_key(df, ["k"], [F.col("v").desc()])
    text = plan(top)
    assert top.count() == 37
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sentinel_and_current(frame):
    df = frame(
        "k int, fecha_fin timestamp",
        (1, datetime(9999, 12, 31)), (2, datetime(2021, 5, 1, 10)), (3, None),
    )
    assert values(H.normalize_sentinel(df)) == sorted(
        [(1, date(1900, 1, 1)), (2, date(2021, 5, 1)), (3, None)], key=repr
    )
    assert values(H.current_versions(df), "k") == [(1,)]


def test_valid_at_join(frame):
    facts = frame("k int, d date", (1, date(2021, 3, 1)), (1, date(2021, 6, 1)), (2, date(2021, 3, 1)))
    history = frame(
        "k int, fecha_inicio timestamp, fecha_fin timestamp, v string",
        (1, datetime(2021, 1, 1), datetime(2021, 3, 1), "a"),
        (1, datetime(2021, 3, 1, 8), datetime(9999, 12, 31), "b"),
        (2, datetime(2021, 3, 2), datetime(9999, 12, 31), "c"),
    )
    got = H.valid_at_join(facts, history, "k", "d")
    assert values(got, "k", "d", "v") == [
        (1, date(2021, 3, 1), "a"), (1, date(2021, 3, 1), "b"), (1, date(2021, 6, 1), "b"),
    ]


def test_lookup_keeps_columns_and_renames(frame):
    df = frame("a int, b string, c string", (1, "x", "keep"), (2, None, "keep"), (3, "z", "keep"))
    dim = frame("code string, name string", ("x", "X"), (None, "never"))
    got = L.lookup(df, dim, {"b": "code"}, {"label": "name"})
    assert got.columns == ["a", "b", "c", "label"]
    assert values(got) == sorted([(1, "x", "keep", "X"), (2, None, "keep", None), (3, "z", "keep", None)], key=repr)


def test_existing_equals_inner_join_and_distinct(spark):
    left = spark.range(50).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    facts = spark.range(200).select((F.col("id") % 4).alias("k"))
    semi = L.existing(left, facts, "k")
    inner = left.join(facts, "k").distinct()
    assert values(semi, "k", "v") == values(inner, "k", "v")


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(0, 60, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("left", "inner"):
        salted = L.salted_join(left, right, ["k"], how, hot_rows=100)
        assert values(salted, "k", "v", "w") == values(left.join(right, ["k"], how), "k", "v", "w")


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    right = spark.range(1).select(F.lit(1).alias("k"), F.lit(5).alias("w"))
    joined = L.salted_join(left, right, ["k"], hot_rows=100)
    assert "__salt" in plan(joined) and joined.count() == 4000


def test_checked_lookup_falls_back_beyond_the_bound(spark):
    left = spark.range(500).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    right = spark.range(20).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    size = L.measured_bytes(right)
    small = L.checked_lookup(left, right, ["k"], max_bytes=size)
    large = L.checked_lookup(left, right, ["k"], max_bytes=size - 1)
    assert "BroadcastHashJoin" in plan(small)
    assert values(small, "k", "v", "w") == values(large, "k", "v", "w")


def test_bytes_and_not_rows_decide_on_a_broadcast(spark):
    """Of two tables with equally many rows the narrow one is broadcast and the wide one is not."""
    left = spark.range(500).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    narrow = spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    wide = spark.range(20).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 2000).alias("w"))
    assert L.measured_bytes(narrow) < 1000 < 40_000 < L.measured_bytes(wide)

    def hinted(dim):
        joined = L.checked_lookup(left, dim, ["k"], max_bytes=10_000)
        assert joined.count() == 500
        return "strategy=broadcast" in joined._jdf.queryExecution().logical().toString()

    assert hinted(narrow) and not hinted(wide)
    odd = spark.createDataFrame([(1, None, None, None), (2, "ab", [1, 2], None)], "a int, b string, c array<int>, d decimal(30,2)")
    assert L.measured_bytes(odd) >= 2 * 5 * 8 + 2 * 16 + 2 and L.measured_bytes(odd.limit(0)) == 0


def test_index_is_one_row_per_month_and_broadcast(frame):
    index = frame("periodo int, indice double", (202101, 1.5), (202101, 1.4), (202102, None))
    df = frame("d date, v int", (date(2021, 1, 31), 1), (date(2021, 2, 1), 2), (date(2021, 3, 1), 3))
    got = L.with_index(df, "d", index)
    assert values(got, "v", "indice") == sorted([(1, 1.4), (2, None), (3, None)], key=repr)
    assert values(L.with_index(df, "d", index, "inner"), "v", "indice") == sorted([(1, 1.4), (2, None)], key=repr)
    assert "BroadcastHashJoin" in plan(got)


RECORDS = "k long, fin date, carga long, tipo string, v string"


def valid_by_hand(days, records, kind):
    """The first to end on the day or later, of one end the newest, of those the smallest."""
    out = {}
    for k, d in set(days):
        open_records = [
            (fin or date(9999, 12, 31), carga is None, -(carga or 0), v) for rk, fin, carga, t, v in records
            if rk == k and k is not None and t == kind and d is not None and (fin or date(9999, 12, 31)) >= d
        ]
        out[k, d] = min(open_records)[3] if open_records else None
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_valid_on_days_equals_the_search_by_hand(frame, seed):
    rng = random.Random(seed)
    day = lambda: date(2020, 1, 1) + timedelta(days=rng.randrange(200))
    days = [(rng.choice((None, 1, 2, 3, 4)), rng.choice((None, day(), day(), day()))) for _ in range(150)] + [(1, date(9999, 12, 31))]
    records = [
        (rng.choice((None, 1, 2, 3)), rng.choice((None, *[day()] * 6)), rng.choice((None, 1, 2, 3)), rng.choice("abc"), f"v{n % 17}")
        for n in range(120)
    ]
    got = H.valid_on_days(
        frame("k long, d date", *days), frame(RECORDS, *records), "k", "d", "fin",
        {"one": F.col("tipo") == "a", "two": F.col("tipo") == "b"}, ["v"], "carga",
    )
    rows = got.collect()
    one, two = (valid_by_hand(days, records, kind) for kind in "ab")
    assert len(rows) == len(set(days)) and sum(v is not None for v in one.values()) > 30
    for r in rows:
        assert (r.one and r.one.v) == one[r.k, r.d], (r.k, r.d)
        assert (r.two and r.two.v) == two[r.k, r.d], (r.k, r.d)


def test_a_key_is_swept_month_by_month(spark, frame):
    """A key with very many days is not one window: windows over rows are by key and month, those by key over months."""
    days = spark.range(1000).selectExpr("1L AS k", "date_add(DATE'2000-01-01', CAST(id AS INT)) AS d")
    got = H.valid_on_days(days, frame(RECORDS, (1, date(2001, 5, 1), 1, "a", "x")), "k", "d", "fin", {"one": F.col("tipo") == "a"}, ["v"], "carga")
    windows = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window " in x]
    over_rows = [x for x in windows if re.search(r"\], \[__key#\d+L?, __month#\d+\]", x)]
    assert len(windows) == 2 and len(over_rows) == 1
    assert got.where("one IS NOT NULL").count() == 487
    assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)

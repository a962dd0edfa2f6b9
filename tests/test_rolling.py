from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import values

from merchant_features.operators import rolling as RO
from merchant_features.operators.activity import establishment_activity
from merchant_features.sources import storage

SCHEMA = (
    "fecha_movimiento date, nro_establecimiento long, cod_tipo_operacion string, monto_movimiento decimal(18,2), "
    "monto_movimiento_origen decimal(18,2)"
)


@pytest.fixture
def movements(frame):
    rng = random.Random(4)
    rows = [
        (date(2020, 6, 1) + timedelta(days=rng.randrange(700)), rng.randrange(1, 15), rng.choice(("0005", "0510", "0999")),
         rng.choice((0, 10.25, 999.99)), rng.randrange(100))
        for _ in range(1500)
    ]
    rows += [(date(2021, 11, 30), 99, "0005", 1, 1), (date(2021, 2, 28), 98, "0005", 1, 1), (date(2021, 12, 1), 97, "0005", 1, 1)]
    return frame(SCHEMA, *rows)


def test_months():
    assert RO.months_before(date(2021, 2, 3), 3) == [date(2021, 1, 1), date(2020, 12, 1), date(2020, 11, 1)]


def test_consecutive_runs_equal_full_runs(spark, movements, tmp_path):
    path = str(tmp_path / "states")
    for ref in (date(2021, 11, 15), date(2021, 12, 15), date(2022, 3, 1)):
        got, want = RO.rolling_activity(movements, ref, path), establishment_activity(movements, ref)
        assert got.select(*want.columns).dtypes == want.dtypes
        assert values(got, *want.columns) == values(want, *want.columns)


def test_a_run_reads_the_new_month_only(spark, movements, tmp_path, monkeypatch):
    path = str(tmp_path / "states")
    RO.rolling_activity(movements, date(2021, 11, 15), path)
    asked = []
    whole = RO.month_states
    monkeypatch.setattr(RO, "month_states", lambda f, k, d, m, months, w: asked.append(sorted(months)) or whole(f, k, d, m, months, w))
    newest = movements.where("fecha_movimiento >= DATE'2021-11-01'")
    got, want = RO.rolling_activity(newest, date(2021, 12, 15), path), establishment_activity(movements, date(2021, 12, 15))
    assert values(got, *want.columns) == values(want, *want.columns)
    assert asked == [[date(2021, 11, 1)]] * 2  # once for the shape, once written
    # the same run again computes nothing
    asked.clear()
    RO.rolling_activity(newest.limit(0), date(2021, 12, 15), path).count()
    assert len(asked) == 1 and len(RO.States(spark, path).versions()) == 13


def test_changed_facts_are_restated(spark, movements, tmp_path):
    path, ref = str(tmp_path / "states"), date(2021, 12, 15)
    RO.rolling_activity(movements, ref, path)
    late = movements.unionByName(movements.where("fecha_movimiento BETWEEN DATE'2021-05-01' AND DATE'2021-05-31'"))
    late = storage.materialize(late)
    got, want = RO.rolling_activity(late, ref, path, restated=[date(2021, 5, 1)]), establishment_activity(late, ref)
    assert values(got, *want.columns) == values(want, *want.columns)
    assert RO.States(spark, path).versions()["2021-05"] == 2


def test_months_without_facts(spark, frame, tmp_path):
    got = RO.rolling_activity(frame(SCHEMA), date(2021, 12, 15), str(tmp_path / "states"))
    assert got.count() == 0

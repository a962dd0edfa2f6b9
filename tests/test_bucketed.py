"""Histories in buckets by establishment: one shuffle per table and run, the writing itself."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from conftest import DATE_REF, plan, values
from pyspark.sql import functions as F

from merchant_features.operators.address import latest_unified_addresses
from merchant_features.plans.establishment import establishment_base
from merchant_features.plans.shared import by_establishment
from merchant_features.sources import storage, tables

TYPES = {"nro_establecimiento": "long", "id_carga": "long", "fecha_inicio": "date", "fecha_fin": "date", "fecha_alta": "date",
         "latitud": "double", "longitud": "double", "cod_localidad": "int"}


@pytest.fixture
def inputs(spark, frame):
    rng = random.Random(2)

    def rows(spec, n):
        day = lambda: date(2021, 1, 1) + timedelta(days=rng.randrange(300))
        make = {"long": lambda: rng.randrange(40), "int": lambda: rng.randrange(9), "date": day, "double": rng.random}
        return frame(
            ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in spec.columns),
            *[tuple(make.get(TYPES.get(c), lambda: str(rng.randrange(1, 4)))() for c in spec.columns) for _ in range(n)],
        )

    found = {s.name: rows(s, n) for s, n in ((tables.ESTABLISHMENT_HISTORY, 150), (tables.ADDRESS_HISTORY, 200), (tables.GEO_LOCATION, 60))}
    # a code table, broadcast by its size in a real run too
    return found | {"provinces": F.broadcast(frame("cod_provincia string, desc_provincia string", ("1", "uno"), ("2", "dos")))}


def exchanges(df):
    return re.findall(r"hashpartitioning\(nro_establecimiento", plan(df))


def addresses(t):
    return latest_unified_addresses(establishment_base(t["establishment_history"]), t["address_history"], t["provinces"])


def test_one_shuffle_by_establishment_per_run(spark, inputs):
    plain = tables.narrow(inputs, [s for s in (tables.ESTABLISHMENT_HISTORY, tables.ADDRESS_HISTORY) if s.name in inputs], DATE_REF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with storage.run(spark):
            dealt = by_establishment(inputs, DATE_REF, 4)
            got = addresses(dealt)
            want = addresses(plain | {"provinces": inputs["provinces"]})
            assert exchanges(want) and not exchanges(got)
            assert values(got) == values(want) and got.count() > 20
            joined = got.join(dealt["geo_location"], "nro_establecimiento", "left")
            assert not exchanges(joined) and joined.count() >= got.count()
            names = [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
            assert len(names) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]

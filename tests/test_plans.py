from __future__ import annotations

import re

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from analogues import views
from merchant_features.operators import activity as AC
from merchant_features.operators.contracts import fill_numeric
from merchant_features.plans import establishment as PE
from merchant_features.plans import model as PM
from merchant_features.plans import principal as PP
from merchant_features.plans import target as PT
from merchant_features.plans.shared import prepare_shared
from merchant_features.sources import storage
from merchant_features.sources.storage import materialize
from merchant_features.sources.tables import ESTABLISHMENT_SOURCES, PRINCIPAL_SOURCES, narrow

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return views.tables(spark, SF)


@pytest.fixture(scope="module")
def establishments(tables):
    return PE.establishment_features(tables, views.DATE_REF)


@pytest.fixture(scope="module")
def principal(tables):
    return PP.principal_features(tables, views.DATE_REF)


def test_no_python_and_no_cross_join(tables, establishments, principal):
    for df in (establishments, principal, PT.activation_target(tables, views.DATE_REF)):
        text = plan(df)
        for word in ("CartesianProduct", "BroadcastNestedLoop", "PythonUDF", "ArrowEval", "BatchEvalPython"):
            assert word not in text


def test_output_contracts(establishments, principal):
    assert len(PE.ATTRIBUTE_TYPES) == 37 and len(PE.MEASURE_TYPES) == 64
    assert dict(establishments.dtypes) == {
        **PE.ATTRIBUTE_TYPES, **PE.MEASURE_TYPES, "fe_proceso": "date", "id_periodo_analisis": "string",
    }
    assert len(PP.ATTRIBUTE_TYPES) == 22 and len(PP.MEASURE_TYPES) == 28
    assert dict(principal.dtypes) == {
        **PP.ATTRIBUTE_TYPES, **PP.MEASURE_TYPES, "fe_proceso": "date", "id_periodo_analisis": "string",
    }
    assert len(PM.model_columns()) == len(set(PM.model_columns())) == 3 + 3 * 24 + 8 + 24 + 2


def test_the_scan_window_reaches_the_facts(tables):
    narrowed = narrow(tables, PRINCIPAL_SOURCES, views.DATE_REF)
    text = plan(AC.summarise_authorisations(narrowed["authorisations"]))
    assert "GreaterThanOrEqual(l_shipdate,1999-06-01" in text and "LessThan(l_shipdate,2000-07-01" in text
    assert len(re.findall(r"\) Exchange", text)) == 1
    movements = narrow(tables, ESTABLISHMENT_SOURCES, views.DATE_REF)["movements"]
    text = plan(AC.establishment_activity(movements, views.DATE_REF))
    assert "o_orderpriority" not in text and "LessThan(o_orderdate,2000-07-01" in text
    assert len(re.findall(r"\) Exchange", text)) == 1


def steps(monkeypatch, build) -> list[str]:
    """The plans of every written step of a table, and of what remains at the end."""
    found: list[str] = []
    monkeypatch.setattr(storage, "on_write", lambda df: found.append(plan(df)))
    last = plan(build())
    return [*found, last]


def test_every_written_step(tables, monkeypatch):
    def model():
        shared = prepare_shared(tables, views.DATE_REF)
        principal = PP.principal_features(tables, views.DATE_REF, shared=shared)
        target = PT.activation_target(tables, views.DATE_REF, shared=shared)
        return PM.model_table(principal, target, PE.establishment_features(tables, views.DATE_REF))

    found = steps(monkeypatch, model)
    assert len(found) > 10
    for text in found:
        for word in ("CartesianProduct", "BroadcastNestedLoop", "PythonUDF", "ArrowEval", "BatchEvalPython"):
            assert word not in text
    # amounts of the authorisations are read by one step of the whole model run, in one scan
    reading = [text for text in found if "l_extendedprice" in text]
    assert len(reading) == 1
    assert len(re.findall(r"ReadSchema: [^\n]*l_extendedprice", reading[0])) == 1


def test_features_do_not_depend_on_partitioning(spark, tables):
    shuffled = {name: df.repartition(5) for name, df in tables.items()}
    a = PP.principal_features(tables, views.DATE_REF)
    b = PP.principal_features(shuffled, views.DATE_REF)
    assert values(a) == values(b)


def test_duplicate_input_rows_do_not_multiply_features(tables, establishments):
    doubled = dict(tables)
    for name in ("categories", "banks", "provinces", "geo_location", "address_history", "establishment_history"):
        doubled[name] = tables[name].unionByName(tables[name])
    got = PE.establishment_features(doubled, views.DATE_REF)
    assert got.count() == establishments.count()
    assert values(got.select(F.sum("cant_m1"), F.sum("vol_usd_m3"))) == values(
        establishments.select(F.sum("cant_m1"), F.sum("vol_usd_m3"))
    )


def test_weighting_by_rows_multiplies_by_the_universe_rows(tables, establishments):
    weighted = PE.establishment_features(tables, views.DATE_REF, weighting="rows")
    rows = establishments.groupBy("nro_establecimiento").agg(
        F.count(F.lit(1)).alias("n"), F.max("cant_m1").alias("once")
    )
    times = weighted.groupBy("nro_establecimiento").agg(F.max("cant_m1").alias("times"))
    assert rows.join(times, "nro_establecimiento").where("times <> n * once").count() == 0
    with pytest.raises(ValueError):
        PE.establishment_features(tables, views.DATE_REF, weighting="other")


def test_model_table(spark, tables, establishments, principal):
    base, places = materialize(principal), materialize(establishments)
    target = PT.activation_target(tables, views.DATE_REF)
    got = PM.model_table(base, target, places)
    assert got.columns == PM.model_columns()
    assert got.count() == base.count()
    means = {r[0]: r[1] for r in base.groupBy("cod_rubro").agg(F.avg("vol_txs_m1")).collect()}
    for row in got.select("cod_rubro", "vol_txs_m1_rubro").collect():
        expected = means[row.cod_rubro] if row.cod_rubro is not None else None
        assert row.vol_txs_m1_rubro == pytest.approx(expected)


def test_fill_numeric(frame):
    assert values(fill_numeric(frame("a int, b double, c string", (None, None, None)))) == [(0, 0.0, None)]

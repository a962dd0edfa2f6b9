from __future__ import annotations

import json

import pytest
from conftest import values

from analogues import views
from merchant_features import jobs
from merchant_features.operators.universe import OWNER_REF
from merchant_features.plans.model import model_columns
from merchant_features.sources import feature_store

SF = "/root/testdata/sf0.001"
DAY = views.DATE_REF.isoformat()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """All sources on disk, every table prepared and ingested twice, the model built from the store."""
    root = tmp_path_factory.mktemp("jobs")
    paths = {}
    for name, df in views.tables(spark, SF).items():
        paths[name] = str(root / "sources" / name)
        df.write.parquet(paths[name])
    (root / "paths.json").write_text(json.dumps(paths))
    out = {name: str(root / name) for name in (*jobs.PREPARE, "model")}
    for name in jobs.PREPARE:
        files = str(root / f"{name}-files")
        jobs.main(["prepare", name, "--paths", str(root / "paths.json"), "--date-ref", DAY, "--output", files])
        for epoch in ("100", "200"):
            jobs.main(["ingest", name, "--input", files, "--table", out[name], "--epoch", epoch])
    tables = [f"--{name}={out[name]}" for name in jobs.PREPARE]
    jobs.main(["model", *tables, "--date-ref", DAY, "--output", str(root / "model-files")])
    jobs.main(["ingest", "model", "--input", str(root / "model-files"), "--table", out["model"], "--epoch", "300"])
    return out


def test_the_model_table_is_stored(spark, store):
    got = feature_store.read_features(spark, store["model"], views.DATE_REF)
    assert set(got.columns) == {*model_columns(), "event_time"}
    assert {r.event_time for r in got.select("event_time").distinct().collect()} == {300.0}
    principal = feature_store.read_features(spark, store["principal"], views.DATE_REF)
    assert got.count() == principal.drop("event_time").distinct().count() > 0
    assert values(got.select(OWNER_REF).distinct()) == values(principal.select(OWNER_REF).distinct())


def test_every_ingestion_is_read(spark, store):
    for name in jobs.PREPARE:
        everything = feature_store.read_features(spark, store[name], views.DATE_REF)
        assert everything.count() == 2 * everything.drop("event_time").distinct().count() > 0


def test_stored_types(spark, store):
    types = dict(feature_store.read_features(spark, store["establishment"], views.DATE_REF).dtypes)
    assert types["cant_m1"] == "bigint" and types["vol_m1"] == "double" and types["fe_proceso"] == "string"
    types = dict(feature_store.read_features(spark, store["principal"], views.DATE_REF).dtypes)
    assert types["cant_txs_m1"] == "int" and types["vol_txs_m1"] == "float"

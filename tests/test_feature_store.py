from __future__ import annotations

import os
from datetime import date

import pytest
from conftest import plan, values
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from merchant_features.sources import feature_store as FS
from merchant_features.sources import manifests
from merchant_features.sources import storage
from merchant_features.sources import tables as TB

SCHEMA = "cuit string, n int, x float, fe_proceso date, id_periodo_analisis string"
ROWS = [
    ("a", 1, 1.5, date(2021, 12, 15), "2021-11"), ("b", None, None, date(2021, 12, 15), "2021-11"),
    (None, 3, 3.5, date(2021, 12, 15), "2021-11"),
]


@pytest.fixture
def prepared(frame, tmp_path):
    path = str(tmp_path / "prepared.snappy.parquet")
    TB.write_features(frame(SCHEMA, *ROWS), path, partitions=2)
    return path


def test_ingest_and_read_back(spark, prepared, tmp_path):
    table = str(tmp_path / "features")
    FS.ingest(spark, prepared, table, "cuit", 100.4)
    got = FS.read_features(spark, table, date(2021, 12, 15))
    assert dict(got.dtypes) == {
        "cuit": "string", "n": "bigint", "x": "double", "fe_proceso": "string", "id_periodo_analisis": "string",
        "event_time": "double",
    }
    assert values(got, "cuit", "n", "x", "fe_proceso", "event_time") == [
        ("a", 1, 1.5, "2021-12-15", 100.0), ("b", -1, None, "2021-12-15", 100.0),
    ]
    assert FS.read_features(spark, table, "2020-01").count() == 0


def test_reingesting_a_period(spark, prepared, tmp_path):
    table = str(tmp_path / "features")
    for epoch in (100, 200):
        FS.ingest(spark, prepared, table, "cuit", epoch)
    assert FS.read_features(spark, table, "2021-11").count() == 4
    by_key = FS.read_features(spark, table, "2021-11", keys=["cuit"])
    assert values(by_key, "cuit", "event_time") == [("a", 200.0), ("b", 200.0)]


def test_a_period_that_came_in_parts_is_read_whole(spark, frame, tmp_path):
    table, parts = str(tmp_path / "features"), ([ROWS[0], ROWS[1]], [("c", 5, 5.5, date(2021, 12, 15), "2021-11")])
    for epoch, rows in zip((100, 200), parts, strict=True):
        path = str(tmp_path / f"part-{epoch}")
        TB.write_features(frame(SCHEMA, *rows), path, partitions=1)
        FS.ingest(spark, path, table, "cuit", epoch)
    assert values(FS.read_features(spark, table, "2021-11"), "cuit") == [("a",), ("b",), ("c",)]
    assert values(FS.read_features(spark, table, "2021-11", keys="cuit"), "cuit") == [("a",), ("b",), ("c",)]


def test_only_the_period_partition_is_read(spark, prepared, tmp_path):
    table = str(tmp_path / "features")
    FS.ingest(spark, prepared, table, "cuit", 1)
    text = plan(FS.read_features(spark, table, "2021-11"))
    assert "PartitionFilters: [isnotnull(id_periodo_analisis" in text


def test_a_repeated_ingest_adds_nothing(spark, prepared, tmp_path):
    table = str(tmp_path / "features")
    assert FS.ingest(spark, prepared, table, "cuit", 100)
    assert not FS.ingest(spark, prepared + "/", table, "cuit", 100.2)
    assert FS.read_features(spark, table, "2021-11").count() == 2
    assert FS.ingest(spark, prepared, table, "cuit", 200) and len(FS.batches(spark, table)) == 2
    assert FS.read_features(spark, table, "2021-11").count() == 4


def test_what_a_dead_job_has_staged_is_not_read(spark, prepared, tmp_path, monkeypatch):
    table = str(tmp_path / "features")
    FS.ingest(spark, prepared, table, "cuit", 100)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(FS, "commit_batch", dies)
        with pytest.raises(RuntimeError):
            FS.ingest(spark, prepared, table, "cuit", 200)
    assert FS.read_records(spark, table).count() == 2
    # more files than the second attempt writes: none of them stay
    FS.stage_features(FS.read_records(spark, table).repartition(7), table, "cuit", "again")
    assert FS.read_records(spark, table).count() == 2
    assert FS.ingest(spark, prepared, table, "cuit", 200) and FS.ingest(spark, prepared, table, "cuit", 300, batch="again")
    assert values(FS.read_records(spark, table), "cuit", "event_time") == sorted(
        [(k, e) for k in "ab" for e in (100.0, 200.0, 300.0)], key=repr
    )
    assert manifests.content(spark, f"{table}/manifests", "again")["records"] == {"2021-11": 2}


def test_manifests(spark, tmp_path):
    folder = str(tmp_path / "manifests")
    assert manifests.committed(spark, folder) == []
    assert manifests.commit(spark, folder, "b", {"n": 1}) and manifests.commit(spark, folder, "a.2", {})
    assert not manifests.commit(spark, folder, "b", {"n": 2})
    assert manifests.committed(spark, folder) == ["a.2", "b"] and manifests.content(spark, folder, "b") == {"n": 1}
    with pytest.raises(ValueError):
        manifests.commit(spark, folder, "../b", {})


def test_sources_are_checked_and_profiled(spark, frame, tmp_path):
    df = frame(
        "a long, b decimal(18,2), c string, d date, e double", (1, 2.5, "x", date(2020, 1, 1), 0.1), (None, None, None, None, None),
        (3, -1, "", date(1999, 1, 1), -34.6),
    )
    spec = TB.SourceSpec("t", ("a", "c"))
    TB.check_source(df, spec, {"a": "entero", "b": "decimal", "e": "real"})
    with pytest.raises(TB.SourceMismatch, match="lacks: z"):
        TB.check_source(df, TB.SourceSpec("t", ("a", "z")))
    with pytest.raises(TB.SourceMismatch, match="c texto"):
        TB.check_source(df, spec, {"c": "fecha"})
    profile = {r.columna: r for r in TB.column_profile(df, "t").collect()}
    assert {c: (r.tipo, r.filas, r.conocidos) for c, r in profile.items()} == {
        "a": ("entero", 3, 2), "b": ("decimal", 3, 2), "c": ("texto", 3, 2), "d": ("fecha", 3, 2), "e": ("real", 3, 2),
    }
    again = {r.columna: r.suma for r in TB.column_profile(df.repartition(3), "t").collect()}
    assert again == {c: r.suma for c, r in profile.items()}
    changed = {r.columna: r.suma for r in TB.column_profile(df.withColumn("c", F.upper("c")), "t").collect()}
    assert changed.pop("c") != again.pop("c") and changed == again
    assert {r.suma for r in TB.column_profile(df.limit(0), "t").collect()} == {"0"}


def test_contract_is_checked(spark, frame, prepared, tmp_path):
    table = str(tmp_path / "features")
    FS.ingest(spark, prepared, table, "cuit", 1)
    other = FS.with_event_time(frame("cuit string, n string, id_periodo_analisis string", ("a", "1", "2021-11")), 2)
    with pytest.raises(FS.ContractMismatch, match="n, x|fe_proceso"):
        FS.append_features(other, table, "cuit")
    good = FS.read_records(spark, table).withColumn("id_periodo_analisis", F.lit("2021-11"))
    with pytest.raises(FS.ContractMismatch, match="keyed by"):
        FS.append_features(good, table, "fe_proceso")
    with pytest.raises(FS.ContractMismatch, match="not in the frame"):
        FS.append_features(good.drop("cuit"), table, "cuit")
    FS.append_features(good, table, "cuit")
    assert FS.read_records(spark, table).count() == 4


def test_null_ids_can_be_kept_as_text(spark, prepared, tmp_path):
    table = str(tmp_path / "features")
    FS.ingest(spark, prepared, table, "cuit", 1, drop_null_ids=False, null_string="None")
    assert values(FS.read_features(spark, table, "2021-11"), "cuit") == [("None",), ("a",), ("b",)]


def test_latest_features(frame):
    df = frame("k string, e string, event_time double, v int", ("a", "x", 1.0, 1), ("a", "x", 2.0, 2), ("a", "y", 1.0, 3))
    assert values(FS.latest_features(df, "k"), "v") == [(2,)]
    assert values(FS.latest_features(df, ["k", "e"]), "v") == [(2,), (3,)]


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        FS.read_features(spark, str(tmp_path / "nothing"), "2021-11")


def test_registry_and_scan_filter(spark, frame, tmp_path):
    path = str(tmp_path / "movements")
    frame(
        "fecha_movimiento date, nro_establecimiento long, cod_tipo_operacion string, monto_movimiento decimal(18,2), "
        "monto_movimiento_origen decimal(18,2), extra int",
        (date(2020, 10, 31), 1, "0005", 1, 1, 1), (date(2020, 11, 1), 1, "0005", 1, 1, 1), (date(2021, 12, 1), 1, "0005", 1, 1, 1),
    ).write.parquet(path)
    loaded = TB.load_all(spark, {"movements": path}, [TB.MOVEMENTS], date(2021, 12, 15))["movements"]
    assert loaded.columns == list(TB.MOVEMENTS.columns) and loaded.count() == 1
    text = plan(loaded)
    assert "GreaterThanOrEqual(fecha_movimiento" in text and "extra" not in text
    with pytest.raises(KeyError):
        TB.load_all(spark, {}, [TB.MOVEMENTS], date(2021, 12, 15))
    with pytest.raises(ValueError):
        TB.load_table(spark, path, TB.MOVEMENTS)
    assert len(TB.ESTABLISHMENT_SOURCES) == 13 and len(TB.PRINCIPAL_SOURCES) == 17


def test_path_glob(spark, frame, tmp_path):
    path = tmp_path / "mixed"
    frame("a int", (1,)).coalesce(1).write.parquet(str(path))
    (path / "notes.txt").write_text("not parquet")
    assert TB.load_table(spark, str(path), path_glob="*.snappy.parquet").count() == 1


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    for folder in ("/tmp/x", "file:///tmp/x", "tmp"):
        assert storage.shared_by_all(folder, "local[8]") and storage.shared_by_all(folder, "local-cluster[3,2,3000]")
        assert not storage.shared_by_all(folder, "yarn") and not storage.shared_by_all(folder, "spark://h:7077")
        assert storage.shared_by_all(folder, "yarn", mounted=True)
    assert storage.shared_by_all("hdfs://n/x", "yarn") and storage.shared_by_all("s3a://b/x", "k8s://h")


def test_a_mounted_folder_is_used_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    monkeypatch.setattr(storage, "_reached", set(), raising=False)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert storage.shared_dir(spark) == configured
    assert storage.materialize(spark.range(5)).count() == 5
    assert not [name for name in os.listdir(configured) if name.startswith("trial-")]


def test_a_folder_that_tasks_do_not_reach_is_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    monkeypatch.setattr(storage, "_reached", set(), raising=False)
    # tasks on other machines write to their own folder of that name: the driver's one stays empty
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **options: os.makedirs(path))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="folder of one machine"):
            storage.shared_dir(spark)


def test_files_of_a_run_go_with_it(spark):
    import os

    with storage.run(spark) as folder:
        assert storage.run_dir(spark) == folder
        os.makedirs(f"{folder}/ledger")
    assert not os.path.exists(folder) and storage.run_dir(spark) == storage.shared_dir(spark)


def test_shared_dir_is_the_configured_one(spark):
    assert storage.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    df = spark.range(5)
    copy = storage.materialize(df)
    assert copy.schema["id"].dataType == df.schema["id"].dataType and copy.count() == 5
    assert "Range" not in plan(copy)

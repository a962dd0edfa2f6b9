from __future__ import annotations

import random
import re

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from merchant_features.operators import universe as U
from merchant_features.sources import storage

GEO = "nro_establecimiento long, latitud double, longitud double, desc_departamento_geo string, desc_provincia_geo string, desc_localidad_gba_geo string"
ADDRESS = (
    "nro_establecimiento long, nombre_calle string, numero_calle string, codigo_postal string, cod_localidad int, "
    "localidad string, cod_provincia string, desc_provincia string, direccion string"
)
FIELDS = (
    "nro_establecimiento long, cuit_establecimiento_host string, cod_rubro string, desc_rubro string, "
    "nombre_fantasia string, beneficiario_host string, cod_estado_establecimiento string, "
    "desc_estado_establecimiento string, nivel_seguridad_moto_ecom string, bandera int"
)


def field(est, owner):
    return (est, owner, "R", "Rubro", "n", "b", "1", "Alta", "x", 1)


def address(est):
    return (est, "c", "1", "1000", 1, "l", "B", "BUENOS AIRES", "d")


@pytest.fixture(scope="module")
def world(frame):
    rng = random.Random(7)
    owners = {e: f"T{e % 4}" for e in range(40)}
    links = {(e, f"07{rng.randrange(25):03d}") for e in owners for _ in range(rng.randrange(0, 5))}
    links |= {(e, "07HOT") for e in range(0, 40, 2)}
    active = {e for e in owners if rng.random() < 0.6}
    fields = frame(FIELDS, *[field(e, o) for e, o in owners.items()])
    geo = frame(GEO, *[(e, 1.0 * g, 2.0, "x", "y", "z") for e in owners for g in range(e % 3)])
    located = U.located_establishments(fields, frame(ADDRESS, *[address(e) for e in owners]), geo)
    terminals = frame("nro_establecimiento long, nro_terminal string", *sorted(links))
    activity = frame("nro_establecimiento long, x int", *[(e, i) for e in sorted(active) for i in range(2)])
    return fields, located, terminals, activity


@pytest.fixture(scope="module")
def reference(world):
    fields, located, terminals, activity = world
    return U.reference_universe(
        U.principal_universe(located, terminals), U.active_universe(fields, terminals, activity)
    )


def test_terminal_universe(frame):
    df = frame("nro_establecimiento long, nro_terminal string", (1, "0812"), (1, "0812"), (1, "9912"), (2, "0712"))
    assert values(U.terminal_universe(df)) == [(1, "0812"), (2, "0712")]


def test_establishment_fields(frame):
    history = frame(
        "nro_establecimiento long, id_carga long, cuit_establecimiento_host string, cod_rubro string, nombre_fantasia string, "
        "beneficiario_host string, cod_estado_establecimiento string, nivel_seguridad_moto_ecom string, bandera int",
        (1, 1, "T1", "R", "old", "b", "1", " x ", 1), (1, 2, "T2", None, "new", "b", "9", "  ", 1),
    )
    states = frame("cd_estado_establecimiento string, ds_estado_establecimiento string", ("1", "Alta"))
    categories = frame("cod_rubro string, desc_rubro string", ("R", "Rubro"))
    got = U.establishment_fields(history, states, categories)
    assert values(got, "cuit_establecimiento_host", "nombre_fantasia", "desc_rubro", "desc_estado_establecimiento",
                  "nivel_seguridad_moto_ecom") == [("T2", "new", None, None, "")]


def test_location_keeps_one_row_per_distinct_place(frame):
    geo = frame(GEO, (1, 1.0, 2.0, "Comuna 1", "p", "l"), (1, 3.0, 4.0, "Comuna 2", "p", "l"), (1, 5.0, 6.0, "Moron", "p", "l"))
    got = U.located_establishments(frame(FIELDS, field(1, "T")), frame(ADDRESS, address(1)), geo)
    assert values(got, "latitud", "desc_departamento_geo") == sorted([(0.0, None), (5.0, "Moron")], key=repr)


def test_active_universe_is_an_existence_test(world):
    fields, _, terminals, activity = world
    got = U.active_universe(fields, terminals, activity)
    joined = fields.join(terminals, "nro_establecimiento").join(activity, "nro_establecimiento")
    columns = ["nro_establecimiento", "cuit_establecimiento_host", "nro_terminal"]
    assert values(got, *columns) == values(joined.select(*columns).distinct())


def test_row_weights_equal_the_rows_of_the_reference_universe(world, reference):
    fields, located, terminals, activity = world
    members = U.owned_terminals(U.with_active_flag(fields, activity), terminals)
    counted = reference.groupBy("nro_establecimiento").agg(F.count(F.lit(1)).alias("n_rows"))
    assert values(U.row_weights(members, located), "nro_establecimiento", "n_rows") == values(counted)


@pytest.mark.parametrize("hub_members", [1, 2, 3, 64])
def test_paired_sums_equal_sums_over_the_listed_pairs(world, reference, hub_members):
    fields, _, terminals, activity = world
    members = U.owned_terminals(U.with_active_flag(fields, activity), terminals)
    weights = fields.select(
        "nro_establecimiento", F.col("nro_establecimiento").alias("w"), F.lit(1).cast("long").alias("pairs")
    ).where("nro_establecimiento % 5 <> 0")
    got = U.paired_sums(members, weights, ["w", "pairs"], hub_members)
    pairs = U.distinct_ids(reference).select("nro_establecimiento", "nro_establecimiento_ref")
    with_terminal = members.select(F.col("nro_establecimiento").alias("nro_establecimiento_ref")).distinct()
    listed = (
        with_terminal.join(pairs, "nro_establecimiento_ref", "left")
        .withColumn("nro_establecimiento", F.coalesce("nro_establecimiento", "nro_establecimiento_ref"))
        .join(weights, "nro_establecimiento", "left")
        .groupBy("nro_establecimiento_ref")
        .agg(F.coalesce(F.sum("w"), F.lit(0)).alias("w"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
    )
    columns = ("nro_establecimiento_ref", "w", "pairs")
    assert values(got, *columns) == values(listed, *columns)


def test_a_terminal_shared_by_many_establishments_makes_no_pairs(spark):
    n = 20000
    members = spark.range(n).select(
        F.col("id").alias("nro_establecimiento"),
        F.lit("T").alias("cuit_establecimiento_host"),
        F.lit("07X").alias("nro_terminal"),
        (F.col("id") % 4 == 0).alias("active"),
    )
    weights = members.select("nro_establecimiento", F.lit(1).cast("long").alias("w"))
    row = U.paired_sums(members, weights, ["w"]).groupBy("w").count().orderBy("w").collect()
    assert [(r["w"], r["count"]) for r in row] == [(n // 4, n // 4), (n // 4 + 1, n - n // 4)]


@pytest.mark.parametrize("n", [800, 20000])
def test_different_sets_around_a_hub_make_no_pairs_at_the_hub(spark, monkeypatch, n):
    """One terminal shared by all and one more by two neighbours each: all terminal sets differ."""
    ids = spark.range(n).select(F.col("id").alias("nro_establecimiento"))
    terminals = F.array(F.lit("hub"), F.concat(F.lit("x"), F.col("nro_establecimiento")),
                        F.concat(F.lit("x"), F.col("nro_establecimiento") + 1))
    members = ids.select(
        "nro_establecimiento", F.lit("T").alias("cuit_establecimiento_host"), F.explode(terminals).alias("nro_terminal"),
        (F.col("nro_establecimiento") % 2 == 0).alias("active"),
    )
    written = []

    def counted(df):
        written.append(storage.materialize(df))
        return written[-1]

    monkeypatch.setattr(U, "materialize", counted)
    got = U.paired_sums(members, ids.withColumn("w", F.lit(1).cast("long")), ["w"])
    assert sorted(map(tuple, got.groupBy("w").count().collect())) == [(n // 2, n // 2), (n // 2 + 1, n // 2)]
    assert sum(df.count() for df in written) <= 8 * n


def hub_world(spark, n, hubs, each, seed=3):
    """``n`` establishments of one owner with ``each`` random hubs of ``hubs``."""
    rng = random.Random(seed)
    rows = [(e, "T", f"07H{h:03d}", e % 3 > 0) for e in range(n) for h in rng.sample(range(hubs), each(rng))]
    members = spark.createDataFrame(
        rows, "nro_establecimiento long, cuit_establecimiento_host string, nro_terminal string, active boolean"
    )
    return rows, members, members.select("nro_establecimiento", F.col("nro_establecimiento").alias("w")).distinct()


@pytest.mark.parametrize("listed", [False, True])
def test_random_hub_sets_equal_the_plain_sums(spark, monkeypatch, listed):
    if listed:  # long sets are paired, short ones go through the trie
        monkeypatch.setattr(U, "MOST_TUPLE_HUBS", 3)
    rows, members, weights = hub_world(spark, 220, 12, lambda rng: rng.randrange(1, 8))
    held, active = {}, {}
    for e, _, t, a in rows:
        held.setdefault(e, set()).add(t)
        active[e] = a
    want = sorted((e, e + sum(o for o in held if o != e and active[o] and held[o] & held[e])) for e in held)
    assert values(U.paired_sums(members, weights, ["w"], 8), U.REF, "w") == sorted(want, key=repr)


def test_rows_grow_with_the_establishments(spark, monkeypatch):
    """Fifty hubs, four random ones each: what is written grows linearly, no two sets are paired."""
    made = {}
    for n in (2000, 4000, 8000):
        _, members, weights = hub_world(spark, n, 50, lambda rng: 4)
        members = materialized(members)
        written = []

        def counted(df, written=written):
            written.append(storage.materialize(df))
            return written[-1]

        monkeypatch.setattr(U, "materialize", counted)
        got = U.paired_sums(members, materialized(weights), ["w"])
        text = plan(got)
        assert got.count() == n
        assert "other_listed" not in text and "Cartesian" not in text
        made[n] = sum(df.count() for df in written)
    assert made[8000] <= 2.1 * made[4000] <= 4.4 * made[2000] and made[8000] <= 32 * 8000


def materialized(df):
    return storage.materialize(df)


@pytest.mark.parametrize("most", [256, 1])
def test_paired_ids_equal_the_distinct_ids_of_the_universe(world, reference, most):
    fields, _, terminals, activity = world
    members = U.owned_terminals(U.with_active_flag(fields, activity), terminals)
    got = U.paired_ids(members, most)
    assert got.count() == got.distinct().count()
    columns = ("nro_establecimiento", "nro_establecimiento_ref", "cuit_establecimiento_host_ref")
    assert values(got, *columns) == values(U.distinct_ids(reference), *columns)


def test_pairs_are_not_reduced(world, reference):
    """No aggregate stands above the join that makes the pairs."""
    fields, _, terminals, activity = world
    members = U.owned_terminals(U.with_active_flag(fields, activity), terminals)

    def of_pairs(df):
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        keys = re.findall(r"Aggregate \[([^\]]*)\]", tree)
        return [k for k in keys if "__partner" in k or U.REF in k]

    assert of_pairs(U.distinct_ids(reference)) and not of_pairs(U.paired_ids(members))


def test_no_cartesian_product(reference):
    assert "Cartesian" not in plan(reference) and "NestedLoop" not in plan(reference)

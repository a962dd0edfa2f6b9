"""Registered queries: every operator and plan over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from analogues import views
from analogues.views import DATE_REF
from merchant_features.functions import expressions as E
from merchant_features.functions import predicates as P
from merchant_features.functions.geo import great_circle_km
from merchant_features.functions.periods import anchors, period_key
from merchant_features.operators import activation as A
from merchant_features.operators import activity as AC
from merchant_features.operators import address as AD
from merchant_features.operators import cohorts as C
from merchant_features.operators import history as H
from merchant_features.operators import neighbours as N
from merchant_features.operators import rolling as RO
from merchant_features.operators import terminals as TE
from merchant_features.operators import universe as U
from merchant_features.operators.contracts import to_feature_types
from merchant_features.operators.lookup import with_index
from merchant_features.plans import establishment as PE
from merchant_features.plans import model as PM
from merchant_features.plans import principal as PP
from merchant_features.plans import target as PT
from merchant_features.plans.session import configure
from merchant_features.plans.shared import by_establishment, prepare_shared
from merchant_features.sources import feature_store as FS
from merchant_features.sources.storage import materialize, shared_dir
from merchant_features.sources.tables import (
    PRINCIPAL_SOURCES,
    SourceSpec,
    ESTABLISHMENT_SOURCES,
    column_profile,
    load_all,
    load_table,
    narrow,
    write_features,
)

ANCHORS = anchors(DATE_REF)
EPOCH = 963619200.0
Tables = dict[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


# Integer columns that hold NULLs are returned as double: not every reader of
# the result has a nullable integer.
NULLABLE_INTEGERS = {
    "cod_localidad", "cod_banco", "banco_visa", "rango_tecnologia", "dias_1tx", "dias_85000",
    "id_terminal", "estadoterminal_id", "mes_facturacion", "primer_periodo_facturacion",
    "ult_periodo_facturado", "q_tx_wifi", "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup",
    "cod_ciclo_pago_estab", "cod_habilitacion_cuotas",
}


def tidy(df: DataFrame, places: int = 4) -> DataFrame:
    """The result in types that every reader takes the same way, for comparing rows.

    Integers are bigint, dates ISO text, decimals and floats double. Floats are
    rounded to ``places``; a nudge far below the last place makes ties fall the
    same way everywhere.
    """
    out = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if field.name in NULLABLE_INTEGERS:
            value = value.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = F.round(value.cast("double") + 1e-7, places)
        out.append(value.alias(field.name))
    return df.select(*out)


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query over the source tables, filtered and narrowed for the reference date."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        tables = views.tables(spark, sf_dir)
        specs = {s.name: s for s in (*ESTABLISHMENT_SOURCES, *PRINCIPAL_SOURCES)}
        return function(narrow(tables, specs.values(), DATE_REF))

    _QUERIES[function.__name__] = run
    return function


def whole(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query over the unfiltered source tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return function(views.tables(spark, sf_dir))

    _QUERIES[function.__name__] = run
    return function


# Sources and filters


@whole
def registry_load(t: Tables) -> DataFrame:
    """Sources written as files and read back through the registry, with its filters and columns."""
    spark = t["movements"].sparkSession
    paths = {spec.name: _new_path(spark, spec.name) for spec in ESTABLISHMENT_SOURCES}
    for name, path in paths.items():
        t[name].write.parquet(path)
    loaded = load_all(spark, paths, ESTABLISHMENT_SOURCES, DATE_REF)
    return tidy(reduce(DataFrame.unionByName, [column_profile(df, name) for name, df in loaded.items()]))


def source_window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(
        "orders",
        ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
        lambda a: P.in_range("o_orderdate", a.firstday, a.lastday) & P.min_amount("o_totalprice", 300),
    )
    df = load_table(spark, f"{sf_dir}/orders.parquet", spec, DATE_REF, path_glob="*.parquet")
    return tidy(df.withColumn("o_orderdate", F.to_date("o_orderdate")))


_QUERIES["source_window_scan"] = source_window_scan


@whole
def validity_filters(t: Tables) -> DataFrame:
    history = t["establishment_history"]
    kept = history.where(P.valid_in_window("fecha_inicio", "fecha_fin", ANCHORS.firstday, ANCHORS.lastday))
    flagged = kept.withColumn("vigente", F.when(P.is_current("fecha_fin"), 1).otherwise(0))
    return tidy(
        H.normalize_sentinel(flagged).select(
            "nro_establecimiento", "id_carga", F.to_date("fecha_inicio").alias("fecha_inicio"), "fecha_fin", "vigente"
        )
    )


@whole
def current_versions(t: Tables) -> DataFrame:
    return tidy(
        H.current_versions(t["address_history"]).select(
            "nro_establecimiento", "id_carga", "calle", "numero", "cod_localidad"
        )
    )


@whole
def open_terminals(t: Tables) -> DataFrame:
    kept = t["terminal_history"].where(
        P.valid_in_window("fecha_inicio", "fecha_fin", ANCHORS.firstday, ANCHORS.lastday, null_is_open=True)
    )
    return tidy(kept.select("nro_establecimiento", "nro_terminal", "fecha_inicio", "fecha_fin"))


@query
def approved_transactions(t: Tables) -> DataFrame:
    auth = t["authorisations"].where(P.is_approved())
    return tidy(
        auth.select(
            "nro_terminal",
            "nro_establecimiento_orig",
            F.to_date("fecha_host_entrada_autoriz").alias("fecha_host_entrada_autoriz"),
            "cod_respuesta_autorizacion",
            "monto_autoriz_moneda_orig",
            F.when(P.is_acquiring_txn(), 1).otherwise(0).alias("adquirente"),
            F.when(P.is_network_txn(P.ACTIVITY_PROGRAMS), 1).otherwise(0).alias("actividad"),
            F.when(P.has_prefix("nro_terminal", P.INSTALLED_PREFIXES), 1).otherwise(0).alias("instalada"),
            F.when(P.min_amount("monto_autoriz_moneda_orig", 300), 1).otherwise(0).alias("minimo"),
        )
    )


# Activity


@query
def daily_movements(t: Tables) -> DataFrame:
    return tidy(AC.daily_movements(t["movements"], ANCHORS.firstday, ANCHORS.lastday))


@query
def daily_authorizations(t: Tables) -> DataFrame:
    return tidy(AC.daily_authorizations(t["authorisations"], ANCHORS.firstday, ANCHORS.lastday))


@query
def daily_terminal_volume(t: Tables) -> DataFrame:
    daily = AC.daily_authorizations(t["authorisations"], ANCHORS.firstday, ANCHORS.lastday)
    return tidy(AC.daily_by_terminal(daily, ANCHORS.firstday, ANCHORS.lastday))


@query
def daily_establishment_activity(t: Tables) -> DataFrame:
    return tidy(AC.daily_establishment_activity(t["authorisations"], t["establishment_history"]))


@query
def daily_establishment_activity_rows(t: Tables) -> DataFrame:
    return tidy(
        AC.daily_establishment_activity(t["authorisations"], t["establishment_history"], weighting="rows")
    )


@query
def daily_establishment_activity_valid(t: Tables) -> DataFrame:
    return tidy(
        AC.daily_establishment_activity(t["authorisations"], t["establishment_history"], weighting="valid")
    )


@query
def authorisation_summary(t: Tables) -> DataFrame:
    return tidy(AC.summarise_authorisations(t["authorisations"]))


@query
def trailing_months(t: Tables) -> DataFrame:
    valid = AC.valid_movements(t["movements"], ANCHORS.firstday, ANCHORS.lastday)
    return tidy(
        AC.trailing_months(valid, AC.ESTABLISHMENT, "fecha_movimiento", AC.movement_measures(), DATE_REF)
    )


@query
def trailing_weeks(t: Tables) -> DataFrame:
    valid = AC.valid_movements(t["movements"], ANCHORS.firstday, ANCHORS.lastday)
    return tidy(
        AC.trailing_weeks(valid, AC.ESTABLISHMENT, "fecha_movimiento", AC.movement_measures(), DATE_REF)
    )


@query
def trailing_months_deflated(t: Tables) -> DataFrame:
    days = AC.daily_establishment_activity(t["authorisations"], t["establishment_history"])
    return tidy(
        AC.trailing_months_deflated(
            days,
            AC.ESTABLISHMENT,
            AC.AUTH_DAY,
            {"cant": "cantidad_transacciones"},
            {"vol": "volumen_transacciones"},
            t["inflation_index"],
            DATE_REF,
        )
    )


@query
def deflated_movements(t: Tables) -> DataFrame:
    indexed = with_index(t["movements"], "fecha_movimiento", t["inflation_index"], "left", ANCHORS)
    return tidy(
        indexed.select(
            "nro_establecimiento",
            F.to_date("fecha_movimiento").alias("fecha_movimiento"),
            period_key("fecha_movimiento").alias("periodo"),
            E.deflate("monto_movimiento", "indice").alias("monto_real"),
            E.inflate("monto_movimiento", "indice").alias("monto_ajustado"),
        )
    )


@query
def establishment_activity(t: Tables) -> DataFrame:
    return tidy(AC.establishment_activity(t["movements"], DATE_REF))


@query
def establishment_activity_rolled(t: Tables) -> DataFrame:
    """The run of the month before writes its monthly states; this run adds the new month alone."""
    path = _new_path(t["movements"].sparkSession, "states")
    RO.rolling_activity(t["movements"], date(2000, 6, 15), path)
    newest = t["movements"].where(F.col("fecha_movimiento") >= F.lit(date(2000, 6, 1)))
    return tidy(RO.rolling_activity(newest, DATE_REF, path))


# Establishments and addresses


@query
def establishment_base(t: Tables) -> DataFrame:
    return tidy(PE.establishment_base(t["establishment_history"]))


@query
def typed_addresses(t: Tables) -> DataFrame:
    return tidy(AD.typed_addresses(t["address_history"], t["provinces"], "1").drop("cod_tipo_direccion"))


@query
def address_unified(t: Tables) -> DataFrame:
    base = PE.establishment_base(t["establishment_history"])
    return tidy(AD.unified_addresses(base, t["address_history"], t["provinces"]))


@query
def address_latest(t: Tables) -> DataFrame:
    base = PE.establishment_base(t["establishment_history"])
    return tidy(AD.latest_unified_addresses(base, t["address_history"], t["provinces"]))


@whole
def address_latest_bucketed(t: Tables) -> DataFrame:
    """The latest addresses from histories in buckets by establishment."""
    b = by_establishment(t, DATE_REF, 8)
    base = PE.establishment_base(b["establishment_history"])
    return tidy(AD.latest_unified_addresses(base, b["address_history"], b["provinces"]))


@query
def establishment_universe(t: Tables) -> DataFrame:
    return tidy(PE.establishment_universe(t))


@query
def establishment_universe_dated(t: Tables) -> DataFrame:
    return tidy(PE.establishment_universe(t, places="dated"))


@whole
def establishment_features_dated(t: Tables) -> DataFrame:
    return tidy(PE.establishment_features(t, DATE_REF, places="dated"))


@whole
def establishment_features(t: Tables) -> DataFrame:
    return tidy(PE.establishment_features(t, DATE_REF))


@whole
def establishment_features_rows(t: Tables) -> DataFrame:
    return tidy(PE.establishment_features(t, DATE_REF, weighting="rows"))


# Universes


def _fields(t: Tables) -> DataFrame:
    return U.establishment_fields(t["establishment_history"], t["establishment_states"], t["categories"])


def _located(t: Tables, fields: DataFrame) -> DataFrame:
    addresses = AD.latest_unified_addresses(fields, t["address_history"], t["provinces"])
    return U.located_establishments(fields, addresses, t["geo_location"])


def _principal(t: Tables) -> DataFrame:
    return U.principal_universe(_located(t, _fields(t)), U.terminal_universe(t["terminal_history"]))


def _active(t: Tables) -> DataFrame:
    days = AC.daily_establishment_activity(t["authorisations"], t["establishment_history"])
    return U.active_universe(_fields(t), U.terminal_universe(t["terminal_history"]), days)


def _universe(t: Tables, weighting: str = "none") -> PP.Universe:
    summary = materialize(AC.summarise_authorisations(t["authorisations"]))
    return PP.build_universe(t, summary, weighting)


@query
def establishment_fields(t: Tables) -> DataFrame:
    return tidy(_fields(t))


@query
def terminal_universe(t: Tables) -> DataFrame:
    return tidy(U.terminal_universe(t["terminal_history"]))


@query
def principal_universe(t: Tables) -> DataFrame:
    return tidy(_principal(t))


@query
def active_universe(t: Tables) -> DataFrame:
    return tidy(_active(t))


@query
def reference_universe(t: Tables) -> DataFrame:
    return tidy(U.reference_universe(_principal(t), _active(t)))


@query
def reference_ids(t: Tables) -> DataFrame:
    return tidy(U.paired_ids(_universe(t).members))


@query
def reference_row_weights(t: Tables) -> DataFrame:
    universe = _universe(t)
    return tidy(U.row_weights(universe.members, universe.located))


@query
def reference_pair_counts(t: Tables) -> DataFrame:
    members = _universe(t).members
    ones = members.select(AC.ESTABLISHMENT).distinct().withColumn("pares", F.lit(1).cast("bigint"))
    return tidy(U.paired_sums(members, ones, ["pares"]))


@query
def terminals_per_establishment(t: Tables) -> DataFrame:
    return tidy(AC.terminals_per(U.terminal_universe(t["terminal_history"]), AC.ESTABLISHMENT))


@query
def per_terminal_activity(t: Tables) -> DataFrame:
    return tidy(PP.per_terminal_activity(_universe(t), t["inflation_index"], DATE_REF))


@query
def per_terminal_activity_rows(t: Tables) -> DataFrame:
    return tidy(PP.per_terminal_activity(_universe(t, "rows"), t["inflation_index"], DATE_REF, "rows"))


# Terminals and the installed base


@query
def first_install(t: Tables) -> DataFrame:
    return tidy(TE.first_install(t["state_log"]))


@query
def terminal_activity(t: Tables) -> DataFrame:
    return tidy(AC.terminal_activity(t["authorisations"], ANCHORS.lastday))


@query
def terminal_activity_from_summary(t: Tables) -> DataFrame:
    return tidy(AC.terminal_days(AC.summarise_authorisations(t["authorisations"]), ANCHORS.lastday))


@query
def terminal_status(t: Tables) -> DataFrame:
    activity = AC.terminal_activity(t["authorisations"], ANCHORS.lastday)
    return tidy(TE.terminal_status(t["terminals"], t["state_log"], activity))


@query
def terminal_contract(t: Tables) -> DataFrame:
    contract = TE.terminal_contract(t["terminals"], t["contracts"], t["state_log"], ANCHORS.lastday)
    return tidy(
        contract.drop(*TE.placeholder_types()).withColumnRenamed("fechacontrato", "fecha_contrato")
    )


@query
def contract_placeholders(t: Tables) -> DataFrame:
    """The columns that the output has and no source fills; integers as double, as nullable ones always."""
    contract = TE.terminal_contract(t["terminals"], t["contracts"], t["state_log"], ANCHORS.lastday)
    kept = contract.select("nro_terminal", *TE.placeholder_types())
    whole = [c for c, kind in kept.dtypes if kind in ("int", "bigint")]
    return tidy(kept.withColumns({c: F.col(c).cast("double") for c in whole}))


@query
def latest_beneficiary(t: Tables) -> DataFrame:
    return tidy(TE.latest_beneficiary(t["establishment_history"]))


@query
def latest_legal_name(t: Tables) -> DataFrame:
    return tidy(TE.latest_legal_name(t["contracts"]))


@query
def installed_base(t: Tables) -> DataFrame:
    return tidy(TE.installed_base(t, ANCHORS.lastday).drop(*TE.placeholder_types(), "localidad"))


@query
def installed_base_joined(t: Tables) -> DataFrame:
    base = TE.installed_base(t, ANCHORS.lastday, history_key=A.CONTRACT_ESTABLISHMENT)
    return tidy(base.drop(*TE.placeholder_types(), "localidad"))


# Activation


def _installs(t: Tables) -> DataFrame:
    return A.installs_in_window(TE.installed_base(t, ANCHORS.lastday), ANCHORS)


def _daily(t: Tables) -> DataFrame:
    return AC.daily_authorizations(t["authorisations"], ANCHORS.firstday, ANCHORS.lastday)


def _installed(t: Tables) -> PP.Installs:
    summary = materialize(AC.summarise_authorisations(t["authorisations"]))
    installed = TE.installed_base(t, ANCHORS.lastday, AC.terminal_days(summary, ANCHORS.lastday))
    return PP.build_installs(installed, summary, t["inflation_index"], ANCHORS)


@query
def cumulative_volume(t: Tables) -> DataFrame:
    return tidy(A.install_series(_installs(t), _daily(t), ANCHORS))


@query
def days_to_activation(t: Tables) -> DataFrame:
    return tidy(A.install_outcomes(_installs(t), _daily(t), t["inflation_index"], ANCHORS))


@query
def activation_levels(t: Tables) -> DataFrame:
    built = _installed(t)
    return tidy(A.activation_levels(built.installs, built.outcomes))


@query
def owner_days(t: Tables) -> DataFrame:
    built = _installed(t)
    return tidy(A.owner_days(built.installs, built.outcomes))


@query
def reference_levels(t: Tables) -> DataFrame:
    return tidy(PP.reference_levels(_universe(t), _installed(t)))


@query
def reference_levels_rows(t: Tables) -> DataFrame:
    return tidy(PP.reference_levels(_universe(t), _installed(t), "rows"))


@query
def reference_days(t: Tables) -> DataFrame:
    return tidy(PP.reference_days(_universe(t), _installed(t)))


@query
def month_volume(t: Tables) -> DataFrame:
    return tidy(A.month_volume(_daily(t), ANCHORS))


def _label(t: Tables, weighting: str) -> DataFrame:
    establishments = PE.establishment_base(t["establishment_history"])
    installed = TE.installed_base(t, ANCHORS.lastday)
    return A.establishment_label(
        establishments, installed, t["inflation_index"], _daily(t), ANCHORS, weighting
    )


@query
def establishment_label(t: Tables) -> DataFrame:
    return tidy(_label(t, "none"))


@query
def establishment_label_rows(t: Tables) -> DataFrame:
    return tidy(_label(t, "rows"))


@whole
def activation_target(t: Tables) -> DataFrame:
    return tidy(PT.activation_target(t, DATE_REF))


@whole
def activation_target_rows(t: Tables) -> DataFrame:
    return tidy(PT.activation_target(t, DATE_REF, weighting="rows"))


@whole
def principal_features(t: Tables) -> DataFrame:
    return tidy(PP.principal_features(t, DATE_REF))


@whole
def principal_features_rows(t: Tables) -> DataFrame:
    return tidy(PP.principal_features(t, DATE_REF, weighting="rows"))


# Cohorts and neighbours

COHORT_MEASURES = ("cant_m1", "vol_m1", "cant_m12", "vol_m12")


def _cohort_rows(t: Tables) -> DataFrame:
    """Activity of every establishment with its category, province and locality."""
    fields = _fields(t)
    addresses = AD.latest_unified_addresses(fields, t["address_history"], t["provinces"])
    activity = AC.establishment_activity(t["movements"], DATE_REF).select(
        AC.ESTABLISHMENT, *[F.col(m).cast("double").alias(m) for m in COHORT_MEASURES]
    )
    return (
        fields.select(AC.ESTABLISHMENT, "cod_rubro")
        .join(addresses.select(AC.ESTABLISHMENT, "cod_provincia", "cod_localidad"), AC.ESTABLISHMENT, "left")
        .join(activity, AC.ESTABLISHMENT, "left")
    )


def _register_cohort(name: str, cohort: str, agg: str) -> None:
    def run(t: Tables) -> DataFrame:
        return tidy(C.cohort_stats(_cohort_rows(t), C.COHORTS[cohort], COHORT_MEASURES, agg, cohort))

    run.__name__ = name
    query(run)


for _name, _cohort, _agg in (
    ("cohort_avg_category", "rubro", "avg"),
    ("cohort_avg_province", "prov", "avg"),
    ("cohort_avg_category_province", "rubro_prov", "avg"),
    ("cohort_sum_category", "rubro", "sum"),
    ("cohort_sum_province", "prov", "sum"),
    ("cohort_sum_category_province", "rubro_prov", "sum"),
    ("cohort_sum_locality_province", "loc_prov", "sum"),
):
    _register_cohort(_name, _cohort, _agg)


@query
def cohort_features(t: Tables) -> DataFrame:
    rows = _cohort_rows(t)
    return tidy(C.with_cohort_stats(rows, COHORT_MEASURES[:2], COHORT_MEASURES[2:]).drop(*COHORT_MEASURES))


@query
def great_circle(t: Tables) -> DataFrame:
    centre = {"lat": -34.6, "lon": -58.4}
    return tidy(
        t["geo_location"].select(
            "nro_establecimiento",
            great_circle_km(
                "latitud", "longitud", F.lit(centre["lat"]), F.lit(centre["lon"])
            ).alias("km"),
        )
    )


def _points(t: Tables) -> DataFrame:
    owners = PE.establishment_base(t["establishment_history"])
    return owners.join(
        t["geo_location"].select(AC.ESTABLISHMENT, N.LAT, N.LON), AC.ESTABLISHMENT
    )


@query
def radius_neighbours(t: Tables) -> DataFrame:
    """How many establishments of other owners are within five kilometres of each."""
    near = N.neighbour_counts(_points(t), U.OWNER, 5.0)
    return tidy(near.select("nro_establecimiento", F.col("n_near").alias("vecinos")))


@query
def radius_pairs(t: Tables) -> DataFrame:
    """Every two establishments of different owners within five kilometres, and their distance."""
    points = _points(t).select(AC.ESTABLISHMENT, U.OWNER, N.LAT, N.LON)
    pairs = N.radius_join(points, points, 5.0, exclude=U.OWNER)
    return tidy(
        pairs.select(
            F.col("a_nro_establecimiento").alias("nro_establecimiento"), F.col("b_nro_establecimiento").alias("nro_vecino"), "km"
        )
    )


@query
def neighbour_stats(t: Tables) -> DataFrame:
    rows = _points(t).join(
        AC.establishment_activity(t["movements"], DATE_REF).select(AC.ESTABLISHMENT, *COHORT_MEASURES),
        AC.ESTABLISHMENT,
        "left",
    )
    return tidy(N.neighbour_stats(rows, U.OWNER, COHORT_MEASURES, 5.0))


@whole
def geo_features(t: Tables) -> DataFrame:
    return tidy(PM.geo_features(PE.establishment_features(t, DATE_REF)))


# Feature store


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def feature_records(t: Tables) -> DataFrame:
    records = to_feature_types(FS.with_event_time(_fields(t), EPOCH))
    return tidy(records)


@query
def feature_strings(t: Tables) -> DataFrame:
    label = _label(t, "none").withColumn("fe_proceso", F.lit(DATE_REF))
    return tidy(to_feature_types(FS.with_event_time(label, EPOCH), strings_only=True, null_string="None"))


def _stored_target(t: Tables) -> str:
    """Ingest the prepared label table in two disjoint parts, then the whole again, then one part again."""
    spark = t["movements"].sparkSession
    table = _new_path(spark, "features")
    target = materialize(PT.activation_target(t, DATE_REF))
    active = F.coalesce(F.col("clase") == 1, F.lit(False))
    for n, rows in enumerate((target.where(~active), target.where(active), target, target.where(active))):
        files = _new_path(spark, "prepared")
        write_features(rows, files, partitions=4)
        FS.ingest(spark, files, table, U.OWNER, EPOCH + 3600 * n)
    return table


@whole
def latest_features(t: Tables) -> DataFrame:
    stored = FS.read_records(t["movements"].sparkSession, _stored_target(t))
    return tidy(FS.latest_features(stored, U.OWNER))


@whole
def read_period(t: Tables) -> DataFrame:
    return tidy(FS.read_features(t["movements"].sparkSession, _stored_target(t), DATE_REF))


@whole
def read_period_latest(t: Tables) -> DataFrame:
    return tidy(FS.read_features(t["movements"].sparkSession, _stored_target(t), DATE_REF, keys=U.OWNER))


@whole
def ingest_job(t: Tables) -> DataFrame:
    return tidy(FS.read_records(t["movements"].sparkSession, _stored_target(t)))


@whole
def ingest_repeated(t: Tables) -> DataFrame:
    """An ingest that is repeated, and one that breaks off after part of its files and is run again: each counts once."""
    spark = t["movements"].sparkSession
    table = _new_path(spark, "features")
    target = materialize(PT.activation_target(t, DATE_REF))
    active = F.coalesce(F.col("clase") == 1, F.lit(False))
    first, second = _new_path(spark, "prepared"), _new_path(spark, "prepared")
    write_features(target.where(~active), first, partitions=4)
    write_features(target.where(active), second, partitions=4)
    for _ in range(2):
        FS.ingest(spark, first, table, U.OWNER, EPOCH)
    half = to_feature_types(FS.with_event_time(load_table(spark, second), EPOCH + 3600)).where(F.crc32(U.OWNER) % 2 == 0)
    FS.stage_features(half, table, U.OWNER, "second")
    FS.ingest(spark, second, table, U.OWNER, EPOCH + 3600, batch="second")
    return tidy(FS.read_records(spark, table))


# Model


@whole
def model_table(t: Tables) -> DataFrame:
    shared = prepare_shared(t, DATE_REF)
    principal = materialize(PP.principal_features(t, DATE_REF, shared=shared))
    establishments = PE.establishment_features(t, DATE_REF)
    target = PT.activation_target(t, DATE_REF, shared=shared)
    path = _new_path(t["movements"].sparkSession, "model")
    write_features(PM.model_table(principal, target, establishments), path)
    return tidy(load_table(t["movements"].sparkSession, path), places=3)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)

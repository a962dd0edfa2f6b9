"""Terminal status, terminal contracts and the installed base."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.functions import expressions as E
from merchant_features.functions import predicates as P
from merchant_features.operators.activity import ESTABLISHMENT, TERMINAL, terminal_activity
from merchant_features.operators.contracts import add_nulls
from merchant_features.operators.history import top1_per_key
from merchant_features.operators.lookup import lookup

# Card networks with an affiliation number and date per terminal.
# Two of them are also reached through the acquirer, whose name is a parameter
# and ends their column names.
NETWORKS = ("visa", "amex", "masterfd", "master{acquirer}", "cabalpura", "cabal{acquirer}", "naranja", "naranjavisa")
DEFAULT_ACQUIRER = "acquirer"

BILLING_COLUMNS = {
    "plan": "codigo_cargo",
    "mes_facturacion": "nro_mes_cargo",
    "fecha_inicio_facturacion": "fecha_alta_terminal",
    "primer_periodo_facturacion": "periodo_inicio_cargo",
    "ult_periodo_facturado": "periodo",
}
TEMPLATE_COLUMNS = {
    "ultima_parametrizacion": "fecha_parametrizacion",
    "plantilla_origen": "plantilla_origen",
    "plantilla_destino": "plantilla_destino",
    "version_origen": "version_origen",
    "medio": "medio",
    "marca": "marca",
    "plantilla_adecuada": "plantilla_adecuada",
}


def placeholder_types(acquirer: str = DEFAULT_ACQUIRER) -> dict[str, str]:
    """Contract attributes that have no source yet, as typed NULL columns."""
    types = {}
    for network in NETWORKS:
        name = network.format(acquirer=acquirer)
        types[f"nro_establecimiento_{name}"] = "string"
        types[f"fecha_alta_estab_{name}"] = "date"
    types |= {
        "fecha_inicializacion": "date",
        "plantilla": "string",
        "clocalidad": "string",
        "vendedor": "string",
        "serv_tecnico": "string",
        "cod_postal": "string",
        "provincia": "string",
        "estado_terminal": "string",
        "superestado_id": "int",
        "superestado_terminal": "string",
        "codigo_plan": "string",
        "empresa_vendedora": "string",
    }
    return types


def first_install(state_log: DataFrame) -> DataFrame:
    """First log entry of every terminal."""
    first = top1_per_key(
        state_log.select("terminalid", "dfechalogging", "postestadoid"),
        ["terminalid"],
        [F.col("dfechalogging").asc_nulls_first()],
    )
    return first.select(
        "terminalid",
        F.col("dfechalogging").alias("fecha_instalacion"),
        F.col("postestadoid").alias("resultado_instalacion"),
    )


def registered_terminals(terminals: DataFrame) -> DataFrame:
    """Registry rows of the installed prefixes with the full terminal number."""
    return terminals.where(P.has_prefix("cprefijo", P.INSTALLED_PREFIXES)).withColumn(
        TERMINAL, E.terminal_number("cprefijo", "cnumeroterminal")
    )


def terminal_status(
    terminals: DataFrame, state_log: DataFrame, activity: DataFrame
) -> DataFrame:
    """Installed terminals with first install, last activity, idle band and technology."""
    installed = (
        registered_terminals(terminals)
        .join(first_install(state_log), F.col("id_terminal") == F.col("terminalid"))
        .join(activity, TERMINAL, "left")
    )
    idle = E.months_inactive("fecha_instalacion", "ultima_fecha_actividad", "dias_sin_actividad")
    return installed.select(
        TERMINAL,
        "fecha_instalacion",
        "resultado_instalacion",
        "ultima_fecha_actividad",
        E.inactivity_band(idle).alias("tipo_inactividad"),
        E.tech_label("rango_tecnologia", "cprefijo").alias("tipo_tecnologia"),
        "q_tx_wifi",
        "q_tx_gsm",
        "q_tx_ethernet",
        "q_tx_dialup",
    ).distinct()


def terminal_contract(
    terminals: DataFrame,
    contracts: DataFrame,
    state_log: DataFrame,
    process_date: date,
    acquirer: str = DEFAULT_ACQUIRER,
    partition_by: str = "id_terminal",
) -> DataFrame:
    """Latest qualifying install and the contract of every terminal.

    ``partition_by="terminalid"`` keeps one row per log key instead, so of all
    terminals without a qualifying log entry only one remains.
    """
    installs = state_log.where(F.col("postestadoid").isin(*P.INSTALL_STATES)).select(
        "terminalid", F.col("dfechalogging").alias("fecha_instalacion")
    )
    latest = installs.groupBy("terminalid").agg(F.max("fecha_instalacion").alias("fecha_instalacion"))
    joined = lookup(
        registered_terminals(terminals),
        contracts,
        {"contratoestablecimiento_id": "id_contratoestablecimiento"},
        {
            "ccuit": "ccuit",
            "nro_establecimiento_contrato": "cnumeroestablecimiento",
            "fechacontrato": "dfechacontrato",
            "telefono_ater": "ccontactotelefono",
            "cdomiciliocalle": "cdomiciliocalle",
        },
    ).join(latest, F.col("id_terminal") == F.col("terminalid"), "left")
    if partition_by not in ("id_terminal", "terminalid"):
        raise ValueError(f"unknown partition column {partition_by!r}")
    one = top1_per_key(
        joined.select(
            "id_terminal",
            "terminalid",
            TERMINAL,
            "fecha_instalacion",
            "ccuit",
            "nro_establecimiento_contrato",
            "fechacontrato",
            "telefono_ater",
            "cdomiciliocalle",
            "estadoterminal_id",
        ),
        [partition_by],
        [F.col("fecha_instalacion").desc_nulls_last()],
    ).drop("terminalid")
    return add_nulls(one, placeholder_types(acquirer)).withColumn(
        "fecha_proceso", F.lit(process_date.isoformat())
    )


def latest_beneficiary(history: DataFrame) -> DataFrame:
    """Beneficiary name of every owner's most recently opened establishment."""
    return top1_per_key(
        history.select("cuit_establecimiento_host", "beneficiario_host", "fecha_alta"),
        ["cuit_establecimiento_host"],
        [F.col("fecha_alta").desc_nulls_last()],
    ).drop("fecha_alta")


def latest_legal_name(contracts: DataFrame) -> DataFrame:
    """Legal name on every owner's most recent contract."""
    return top1_per_key(
        contracts.select("ccuit", "crazonsocial", "dfechacontrato"),
        ["ccuit"],
        [F.col("dfechacontrato").desc_nulls_last()],
    ).drop("dfechacontrato")


def _history_attributes(df: DataFrame, history: DataFrame, key: str | None) -> DataFrame:
    columns = {
        "cuit_establecimiento_host": "cuit_establecimiento_host",
        "fecha_alta": "fecha_alta",
        "cod_rubro": "cod_rubro",
        "denominacion": "nombre_fantasia",
        "beneficiario_estab": "beneficiario_host",
        "banco_visa": "cod_banco",
    }
    if key is None:
        types = {name: history.schema[source].dataType.simpleString() for name, source in columns.items()}
        return add_nulls(df, types)
    latest = top1_per_key(
        history.select(ESTABLISHMENT, "id_carga", *columns.values()),
        [ESTABLISHMENT],
        [F.col("id_carga").desc_nulls_last()],
    ).withColumn("__est", F.col(ESTABLISHMENT).cast("decimal(18,0)"))
    keyed = df.withColumn("__est", F.expr(f"try_cast({key} AS decimal(18,0))"))
    return lookup(keyed, latest, "__est", columns).drop("__est")


def _phone(df: DataFrame, phones: DataFrame, key: str | None) -> DataFrame:
    if key is None:
        return add_nulls(df, {"telefono_host": "string"})
    numbered = phones.select(
        F.col(ESTABLISHMENT).cast("decimal(18,0)").alias("__est"),
        E.phone_number("ddn", "numero_telefono").alias("telefono_host"),
    )
    keyed = df.withColumn("__est", F.expr(f"try_cast({key} AS decimal(18,0))"))
    return lookup(keyed, numbered, "__est", ["telefono_host"]).drop("__est")


def installed_base(
    tables: Mapping[str, DataFrame],
    lastday: date,
    activity: DataFrame | None = None,
    acquirer: str = DEFAULT_ACQUIRER,
    history_key: str | None = None,
    template_key: str = TERMINAL,
    contract_partition: str = "id_terminal",
) -> DataFrame:
    """Installed terminals with status, contract, owner names, billing and software state.

    ``history_key`` names the contract column that holds the establishment
    number. By default there is none, and all attributes that come from the
    establishment (and the phone) are typed NULLs. ``activity`` is the terminal
    activity if it is already there; else it is read from the authorisations.
    """
    if activity is None:
        activity = terminal_activity(tables["authorisations"], lastday)
    status = terminal_status(tables["terminals"], tables["state_log"], activity).drop(
        "fecha_instalacion"
    )
    contract = terminal_contract(
        tables["terminals"],
        tables["contracts"],
        tables["state_log"],
        lastday,
        acquirer,
        contract_partition,
    ).withColumnRenamed("fechacontrato", "fecha_contrato")
    base = status.join(contract, TERMINAL, "left")
    base = _history_attributes(base, tables["establishment_history"], history_key)
    base = _phone(base, tables["phones"], history_key)
    base = lookup(base, tables["vip_owners"].distinct(), {"ccuit": "nro_cuit"}, {"vip": "nro_cuit"})
    base = lookup(base, tables["billing"], TERMINAL, BILLING_COLUMNS)
    base = lookup(
        base,
        latest_beneficiary(tables["establishment_history"]),
        {"ccuit": "cuit_establecimiento_host"},
        {"beneficiario_duenio": "beneficiario_host"},
    )
    base = lookup(base, latest_legal_name(tables["contracts"]), "ccuit", ["crazonsocial"])
    base = lookup(base, tables["templates"], {template_key: "id_terminal"}, TEMPLATE_COLUMNS)
    base = lookup(base, tables["terminal_models"], {template_key: "id_terminal"}, ["modelo"])
    return base.withColumns(
        {
            "razon_social": E.first_name(
                ["beneficiario_estab", "beneficiario_duenio", "crazonsocial"]
            ),
            "cuit_vip": E.flag_present("vip"),
            "acepta_liquidacion": E.accepts_settlement("banco_visa"),
            "condicion_soft": E.software_condition("plantilla_adecuada", "plantilla_destino"),
        }
    ).select(*[F.col(source).alias(name) for name, source in installed_columns(acquirer).items()])


def installed_columns(acquirer: str = DEFAULT_ACQUIRER) -> dict[str, str]:
    """Output name -> working column of the installed base."""
    placeholders = placeholder_types(acquirer)
    affiliations = [c for c in placeholders if c.startswith(("nro_establecimiento_", "fecha_alta_estab_"))]
    names = {
        TERMINAL: TERMINAL,
        "id_terminal": "id_terminal",
        "fecha_instalacion": "fecha_instalacion",
        "fecha_contrato": "fecha_contrato",
        "resultado_instalacion": "resultado_instalacion",
        "ultima_fecha_actividad": "ultima_fecha_actividad",
        "tipo_inactividad": "tipo_inactividad",
        "cuit_establecimiento_host": "cuit_establecimiento_host",
        "fecha_alta": "fecha_alta",
        **{c: c for c in affiliations},
        "cuit": "ccuit",
        "localidad": "clocalidad",
    }
    same = (
        "cdomiciliocalle", "serv_tecnico", "nro_establecimiento_contrato", "fecha_inicializacion",
        "plantilla", "cod_rubro", "provincia", "cod_postal", "tipo_tecnologia", "q_tx_wifi",
        "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup", "vendedor", "empresa_vendedora",
        "estadoterminal_id", "estado_terminal", "superestado_id", "superestado_terminal",
        "denominacion", "razon_social", "banco_visa", "cuit_vip", "acepta_liquidacion",
        "codigo_plan", *BILLING_COLUMNS, "telefono_host", "telefono_ater",
        *TEMPLATE_COLUMNS, "modelo", "condicion_soft",
    )
    return names | {c: c for c in same}

"""One SQL statement per registered query, for an independent engine."""

from __future__ import annotations

from merchant_features.functions.expressions import TECHNOLOGIES, UNKNOWN_TECHNOLOGY_RANK
from merchant_features.operators.terminals import placeholder_types
from merchant_features.sources.tables import ESTABLISHMENT_SOURCES

from analogues.oracle_relations import (
    ADDRESS_FIELDS,
    ACQUIRING,
    ACTIVITY,
    APPROVED,
    GEO_MEASURES,
    INSTALLED,
    MEASURES,
    MONTHS,
    REF_ATTRIBUTES,
    SPANS,
    TECH,
    TXS,
    TXS_MEASURES,
    WINDOW,
    km,
    movement_sums,
    query,
)

INTEGER_COLUMNS = {
    "nro_establecimiento", "nro_establecimiento_ref", "cod_ciclo_pago_estab", "cod_habilitacion_cuotas",
    "cod_banco", "cant_maxima_cuotas", "cod_devol_iva", "cod_localidad", "cd_bandera", "bandera",
    "resultado_instalacion", "q_tx_wifi", "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup", "estadoterminal_id",
    "banco_visa", "mes_facturacion", "primer_periodo_facturacion", "ult_periodo_facturado", "id_terminal",
    "clase", "nivel_activacion", "cantidad", "cantidad_transacciones", "cant", "cant_usd", "dias_1tx",
    "dias_85000", "dias_sin_actividad", "rango_tecnologia", "terminalid", "id_carga", "pares", "n_rows",
    "cant_term",
}
FLOAT_COLUMNS = {
    "latitud", "longitud", "avg_dias_1tx", "avg_dias_85000", "avg_terminales_nivel_0", "avg_terminales_nivel_1",
}
MONEY_COLUMNS = {
    "vol", "vol_usd", "volumen", "volumen_transacciones", "suma_monto", "vol_cum", "monto_30",
}


NULLABLE_INTEGERS = {
    "cod_localidad", "cod_banco", "banco_visa", "rango_tecnologia", "dias_1tx", "dias_85000",
    "id_terminal", "estadoterminal_id", "mes_facturacion", "primer_periodo_facturacion",
    "ult_periodo_facturado", "q_tx_wifi", "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup",
    "cod_ciclo_pago_estab", "cod_habilitacion_cuotas",
}


def rounded(value: str, places: int = 4) -> str:
    """Round after a nudge far below the last place, so that ties fall the same way everywhere."""
    return f"round({value} + 1e-7, {places})"


def tidy(relation: str, columns, places: int = 4, where: str = "") -> str:
    """Select columns with the types every query returns."""
    out = []
    for c in columns:
        if c in DATE_COLUMNS:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c in NULLABLE_INTEGERS:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in INTEGER_COLUMNS or c.startswith("cant_m") or c.startswith("cant_w") or c.startswith("cant_usd_"):
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c in MONEY_COLUMNS:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in FLOAT_COLUMNS or c.startswith(("vol_", "monto_", "indice")):
            out.append(f"{rounded(f'CAST({c} AS DOUBLE)', places)} AS {c}")
        elif c.startswith("cant_txs_"):
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(c)
    return query(f"SELECT {', '.join(out)} FROM {relation} {where}")


FIELDS = (
    "nro_establecimiento", "cuit_establecimiento_host", "cod_rubro", "desc_rubro", "nombre_fantasia",
    "beneficiario_host", "cod_estado_establecimiento", "desc_estado_establecimiento",
    "nivel_seguridad_moto_ecom", "bandera",
)
UNIVERSE_COLUMNS = (
    "cuit_establecimiento_host", "nro_establecimiento", "cod_rubro", "desc_rubro", "nombre_fantasia",
    "cod_estado_establecimiento", "desc_estado_establecimiento", "cod_tipo_contrib_ganancias",
    "desc_tipo_contrib_ganancias", "cod_tipo_iva", "desc_tipo_iva", "cod_tipo_contrib_ing_brutos",
    "desc_tipo_contrib_ing_brutos", "cod_ciclo_pago_estab", "desc_ciclo_pago_estab",
    "cod_habilitacion_cuotas", "desc_habilitacion_cuotas", "cod_banco", "desc_banco", "cant_maxima_cuotas",
    "cod_devol_iva", "plataforma_alta", "nombre_calle", "numero_calle", "codigo_postal", "cod_localidad",
    "localidad", "cod_provincia", "desc_provincia", "direccion", "latitud", "longitud",
    "desc_departamento_geo", "desc_provincia_geo", "desc_localidad_gba_geo", "bandera",
    "nivel_seguridad_moto_ecom",
)
RENAMED = {
    "localidad": "nombre_localidad", "bandera": "cd_bandera",
    "nivel_seguridad_moto_ecom": "tx_nivel_seguridad_moto_ecom",
}
FEATURE_COLUMNS = [RENAMED.get(c, c) for c in UNIVERSE_COLUMNS] + MEASURES + ["fe_proceso", "id_periodo_analisis"]
PRINCIPAL_COLUMNS = [
    "cuit_establecimiento_host_ref", "nro_establecimiento_ref",
    *[c for c in REF_ATTRIBUTES if c != "desc_localidad_gba_geo"], *TXS_MEASURES, "avg_terminales_nivel_0", "avg_terminales_nivel_1", "avg_dias_1tx",
    "avg_dias_85000", "fe_proceso", "id_periodo_analisis",
]
INSTALLED_COLUMNS = (
    "nro_terminal", "id_terminal", "fecha_instalacion", "fecha_contrato", "resultado_instalacion",
    "ultima_fecha_actividad", "tipo_inactividad", "cuit_establecimiento_host", "fecha_alta", "cuit",
    "nro_establecimiento_contrato", "cdomiciliocalle", "cod_rubro", "tipo_tecnologia", "q_tx_wifi",
    "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup", "estadoterminal_id", "denominacion", "razon_social",
    "banco_visa", "cuit_vip", "acepta_liquidacion", "plan", "mes_facturacion", "fecha_inicio_facturacion",
    "primer_periodo_facturacion", "ult_periodo_facturado", "telefono_host", "telefono_ater",
    "ultima_parametrizacion", "modelo", "plantilla_origen", "plantilla_destino", "version_origen", "medio",
    "marca", "plantilla_adecuada", "condicion_soft",
)
ACTIVITY_COLUMNS = (
    "nro_terminal", "ultima_fecha_actividad", "dias_sin_actividad", "rango_tecnologia", "q_tx_wifi",
    "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup",
)
DAY_COLUMNS = (
    "fecha_host_entrada_autoriz", "nro_establecimiento", "cantidad_transacciones", "volumen_transacciones",
)
TARGET_COLUMNS = ("cuit_establecimiento_host", "clase", "monto_terminal", "fe_proceso", "id_periodo_analisis")
COHORT_MEASURES = ("cant_m1", "vol_m1", "cant_m12", "vol_m12")
COHORT_ROWS = """(
    SELECT F.nro_establecimiento, F.cod_rubro, A.cod_provincia, A.cod_localidad,
           M.cant_m1, M.vol_m1, M.cant_m12, M.vol_m12
    FROM fields AS F LEFT JOIN latest_addresses AS A ON A.nro_establecimiento = F.nro_establecimiento
    LEFT JOIN establishment_activity AS M ON M.nro_establecimiento = F.nro_establecimiento)"""
COHORTS = {
    "rubro": ("cod_rubro",), "prov": ("cod_provincia",), "rubro_prov": ("cod_rubro", "cod_provincia"),
    "loc_prov": ("cod_localidad", "cod_provincia"),
}


def flag(condition: str, name: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT) AS {name}"


def cohort_value(measure: str, agg: str, cohort: str) -> str:
    value = f"{agg}({measure})"
    return f"{rounded(f'CAST({value} AS DOUBLE)')} AS {measure}_{cohort}"


def cohort(name: str, agg: str) -> str:
    keys = ", ".join("CAST(cod_localidad AS DOUBLE) AS cod_localidad" if k == "cod_localidad" else k for k in COHORTS[name])
    values = ", ".join(cohort_value(m, agg, name) for m in COHORT_MEASURES)
    return query(f"SELECT {keys}, {values} FROM {COHORT_ROWS} AS c GROUP BY {', '.join(COHORTS[name])}")


def cohort_features() -> str:
    joins, columns = [], []
    for name, keys in COHORTS.items():
        values = [cohort_value(m, "sum", name) for m in COHORT_MEASURES[2:]]
        if name != "loc_prov":
            values += [cohort_value(m, "avg", name) for m in COHORT_MEASURES[:2]]
        columns += [f"{name}.{v.rsplit(' AS ', 1)[1]}" for v in values]
        on = " AND ".join(f"{name}.{k} = base.{k}" for k in keys)
        joins.append(
            f"LEFT JOIN (SELECT {', '.join(keys)}, {', '.join(values)} FROM {COHORT_ROWS} AS c "
            f"GROUP BY {', '.join(keys)}) AS {name} ON {on}"
        )
    return query(
        "SELECT base.nro_establecimiento, base.cod_rubro, base.cod_provincia, "
        f"CAST(base.cod_localidad AS DOUBLE) AS cod_localidad, {', '.join(columns)} "
        f"FROM {COHORT_ROWS} AS base {' '.join(joins)}"
    )


def summary() -> str:
    """Day sums of each kind of transaction; a kind that a group has none of has no sum."""
    kinds = {
        "acquired": ACQUIRING,
        "active": ACTIVITY,
        "used": f"monto_autoriz_moneda_orig >= 300 AND substr(nro_terminal, 1, 2) IN {INSTALLED}",
    }
    flags = ", ".join(f"({condition}) AS {kind}" for kind, condition in kinds.items())
    return query(f"""
        SELECT nro_terminal, nro_establecimiento_orig, fecha_host_entrada_autoriz,
               CAST(SUM(amount) FILTER (acquired) AS DOUBLE) AS volumen, COUNT(*) FILTER (acquired) AS cantidad,
               CAST(SUM(amount) FILTER (active) AS DOUBLE) AS volumen_transacciones,
               COUNT(*) FILTER (active) AS cantidad_transacciones,
               CAST(MIN(coalesce(rank, {UNKNOWN_TECHNOLOGY_RANK})) FILTER (used) AS DOUBLE) AS rango_tecnologia,
               {", ".join(f"CAST(COUNT(*) FILTER (used AND letter = '{letter}') AS DOUBLE) AS q_tx_{label.replace('_', '').lower()}"
                          for letter, _, label in TECHNOLOGIES)}
        FROM (SELECT *, monto_autoriz_moneda_orig AS amount, {flags} FROM authorisations
              WHERE {APPROVED} AND fecha_host_entrada_autoriz {WINDOW}) AS approved
        LEFT JOIN technologies ON letter = {TECH}
        WHERE acquired OR active OR used GROUP BY 1, 2, 3""")


POINTS = """(SELECT E.cuit_establecimiento_host, E.nro_establecimiento, latitud, longitud
    FROM latest_establishments AS E JOIN geo_location AS G ON G.nro_establecimiento = E.nro_establecimiento)"""
STORED_TARGET = """(SELECT cuit_establecimiento_host, CAST(clase AS BIGINT) AS clase,
    round(monto_terminal + 1e-7, 4) AS monto_terminal, CAST(fe_proceso AS VARCHAR) AS fe_proceso, id_periodo_analisis
    FROM activation_target)"""
# the parts in which the label table is ingested, an hour apart
ALL_RECORDS = " UNION ALL ".join(
    f"SELECT *, CAST({963619200 + 3600 * n} AS DOUBLE) AS event_time FROM {STORED_TARGET} AS stored WHERE {part}"
    for n, part in enumerate(("coalesce(clase, 0) <> 1", "clase = 1", "true", "clase = 1"))
)
NEWEST_RECORDS = f"""SELECT *, CAST(CASE WHEN clase = 1 THEN {963619200 + 10800} ELSE {963619200 + 7200} END AS DOUBLE)
    AS event_time FROM {STORED_TARGET} AS stored"""


def model() -> str:
    """Principal rows with what their cohorts, their neighbours and their label add.

    All cohorts are groupings of one aggregation; ``grouping`` tells them apart.
    """
    keys = ("cod_rubro", "cod_provincia", "cod_localidad")
    days = ("avg_dias_1tx", "avg_dias_85000")
    bits = {name: "".join("0" if k in by else "1" for k in keys) for name, by in COHORTS.items()}
    stats = [f"AVG(CAST({m} AS DOUBLE)) AS {m}" for m in TXS_MEASURES] + [f"SUM(CAST({m} AS DOUBLE)) AS {m}" for m in days]
    sets = ", ".join(f"({', '.join(by)})" for by in COHORTS.values())
    cohorts = (
        f"SELECT {', '.join(keys)}, GROUPING({', '.join(keys)}) AS level, {', '.join(stats)} "
        f"FROM principal_features GROUP BY GROUPING SETS ({sets})"
    )
    columns, joins = [], []
    for name, by in COHORTS.items():
        measures = days if name == "loc_prov" else (*days, *TXS_MEASURES)
        columns += [f"{rounded(f'of_{name}.{m}', 3)} AS {m}_{name}" for m in measures]
        same = " AND ".join(f"of_{name}.{k} = principal.{k}" for k in by)
        joins.append(f"LEFT JOIN cohort_levels AS of_{name} ON of_{name}.level = {int(bits[name], 2)} AND {same}")
    columns += [f"{rounded(f'near.{m}_geo', 3)} AS {m}_geo" for m in TXS_MEASURES]
    body = (
        f"SELECT cuit_establecimiento_host_ref, principal.id_periodo_analisis, principal.cod_rubro, {', '.join(columns)}, "
        f"{rounded('label.monto_terminal', 3)} AS monto_terminal, CAST(label.clase AS BIGINT) AS clase "
        f"FROM principal_features AS principal "
        "LEFT JOIN geo_features AS near ON near.cuit_establecimiento_host = cuit_establecimiento_host_ref "
        f"LEFT JOIN activation_target AS label ON label.cuit_establecimiento_host = cuit_establecimiento_host_ref {' '.join(joins)}"
    )
    return query(body.replace("cohort_levels AS", f"({cohorts}) AS"))


def profile(table: str, column: str, where: str) -> str:
    """Kind, rows, known values and checksum of a column, reals in millionths."""
    return f"""
        SELECT '{table}' AS tabla, '{column}' AS columna, max(kind) AS tipo, COUNT(*) AS filas, COUNT(shown) AS conocidos,
               CAST(coalesce(SUM(('0x' || substr(md5(shown), 1, 8))::BIGINT), 0) AS VARCHAR) AS suma
        FROM (
            SELECT kind, CASE WHEN kind = 'real'
                              THEN CAST(CAST(round(TRY_CAST(value AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR) ELSE value END AS shown
            FROM (
                SELECT CAST({column} AS VARCHAR) AS value,
                       CASE WHEN typeof({column}) IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT') THEN 'entero'
                            WHEN typeof({column}) LIKE 'DECIMAL%' THEN 'decimal'
                            WHEN typeof({column}) IN ('FLOAT', 'DOUBLE') THEN 'real'
                            WHEN typeof({column}) IN ('DATE', 'TIMESTAMP') THEN 'fecha' ELSE 'texto' END AS kind
                FROM {table} {where}) AS cells) AS texts"""


#: Typed NULL columns; dates are returned as text and integers as double.
PLACEHOLDERS = ", ".join(
    f"CAST(NULL AS {'DOUBLE' if kind in ('int', 'bigint', 'double', 'float') else 'VARCHAR'}) AS {name}"
    for name, kind in placeholder_types().items()
)

DATE_COLUMNS = {
    "desde", "fe_proceso", "fecha_alta", "fecha_contrato", "fecha_fin", "fecha_host_entrada_autoriz",
    "fecha_inicio", "fecha_inicio_facturacion", "fecha_instalacion", "fecha_movimiento", "o_orderdate",
    "ultima_fecha_actividad", "ultima_parametrizacion",
}
DATES_OF = {
    "source_window_scan": ("o_orderdate",),
    "validity_filters": ("fecha_inicio", "fecha_fin"),
    "open_terminals": ("fecha_inicio", "fecha_fin"),
    "approved_transactions": ("fecha_host_entrada_autoriz",),
    "deflated_movements": ("fecha_movimiento",),
    "authorisation_summary": ("fecha_host_entrada_autoriz",),
    "days_to_activation": ("fecha_instalacion",),
}


def dates_as_text(name: str, sql: str) -> str:
    if name not in DATES_OF:
        return sql
    columns = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATES_OF[name])
    return f"SELECT * REPLACE ({columns}) FROM ({sql}) AS dated"


def oracle_sql() -> dict[str, str]:
    return {name: dates_as_text(name, sql) for name, sql in statements().items()}


def statements() -> dict[str, str]:
    months = query(f"""
        SELECT nro_establecimiento, {movement_sums(SPANS[:12])} FROM movement_days
        WHERE fecha_movimiento BETWEEN DATE '1999-07-01' AND DATE '2000-06-30' GROUP BY nro_establecimiento""")
    weeks = query(f"""
        SELECT nro_establecimiento, {movement_sums(SPANS[12:])} FROM movement_days
        WHERE fecha_movimiento BETWEEN DATE '2000-05-01' AND DATE '2000-06-30' GROUP BY nro_establecimiento""")
    deflated = ", ".join(
        f"CAST(COALESCE(cant_m{i}, 0) AS BIGINT) AS cant_m{i}, {rounded(f'COALESCE(vol_m{i}, 0)')} AS vol_m{i}"
        for i in MONTHS
    )
    reference_columns = ("nro_establecimiento_ref", *TXS_MEASURES)
    rated = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in TXS_MEASURES)
    return {
        "source_window_scan": """
            SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
            WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-06-01' AND DATE '2000-06-30'
              AND o_totalprice >= 300""",
        "validity_filters": query("""
            SELECT nro_establecimiento, id_carga, fecha_inicio,
                   CASE WHEN fecha_fin = DATE '9999-12-31' THEN DATE '1900-01-01' ELSE fecha_fin END AS fecha_fin,
                   CAST(CASE WHEN fecha_fin = DATE '9999-12-31' THEN 1 ELSE 0 END AS BIGINT) AS vigente
            FROM establishment_history"""),
        "current_versions": query("""
            SELECT nro_establecimiento, id_carga, calle, numero, CAST(cod_localidad AS DOUBLE) AS cod_localidad
            FROM address_history WHERE fecha_fin = DATE '9999-12-31'"""),
        "open_terminals": query(
            "SELECT nro_establecimiento, nro_terminal, fecha_inicio, fecha_fin FROM terminal_history"
        ),
        "approved_transactions": query(f"""
            SELECT nro_terminal, nro_establecimiento_orig, fecha_host_entrada_autoriz,
                   CAST(cod_respuesta_autorizacion AS BIGINT) AS cod_respuesta_autorizacion,
                   CAST(monto_autoriz_moneda_orig AS DOUBLE) AS monto_autoriz_moneda_orig,
                   {flag(ACQUIRING, "adquirente")}, {flag(ACTIVITY, "actividad")},
                   {flag(f"substr(nro_terminal, 1, 2) IN {INSTALLED}", "instalada")},
                   {flag("monto_autoriz_moneda_orig >= 300", "minimo")}
            FROM authorisations WHERE {APPROVED} AND fecha_host_entrada_autoriz {WINDOW}"""),
        "daily_movements": tidy(
            "movement_days", ("fecha_movimiento", "nro_establecimiento", "vol", "vol_usd", "cant", "cant_usd")
        ),
        "daily_authorizations": tidy(
            "authorisation_days",
            ("nro_terminal", "nro_establecimiento_orig", "fecha_host_entrada_autoriz", "volumen", "cantidad"),
        ),
        "daily_terminal_volume": tidy(
            "terminal_volumes", ("nro_terminal", "fecha_host_entrada_autoriz", "suma_monto")
        ),
        "daily_establishment_activity": tidy("establishment_days", DAY_COLUMNS),
        "daily_establishment_activity_rows": tidy("establishment_days_rows", DAY_COLUMNS),
        "daily_establishment_activity_valid": tidy("establishment_days_valid", DAY_COLUMNS),
        "authorisation_summary": summary(),
        "trailing_months": months,
        "trailing_weeks": weeks,
        "trailing_months_deflated": query(f"SELECT nro_establecimiento, {deflated} FROM establishment_months"),
        "deflated_movements": query(f"""
            SELECT nro_establecimiento, fecha_movimiento,
                   CAST(year(fecha_movimiento) * 100 + month(fecha_movimiento) AS BIGINT) AS periodo,
                   {rounded("CAST(monto_movimiento AS DOUBLE) / COALESCE(indice, 1)")} AS monto_real,
                   {rounded("CAST(monto_movimiento AS DOUBLE) * CASE WHEN indice > 0 THEN indice ELSE 1 END")} AS monto_ajustado
            FROM movements LEFT JOIN inflation_index AS I
                 ON I.periodo = year(fecha_movimiento) * 100 + month(fecha_movimiento)
            WHERE fecha_movimiento {WINDOW}"""),
        "establishment_activity_rolled": tidy("establishment_activity", ("nro_establecimiento", *MEASURES)),
        "establishment_activity": tidy("establishment_activity", ("nro_establecimiento", *MEASURES)),
        "establishment_base": tidy(
            "latest_establishments", ("cuit_establecimiento_host", "nro_establecimiento")
        ),
        "typed_addresses": tidy(
            "typed_addresses", ("nro_establecimiento", *ADDRESS_FIELDS, "id_carga"),
            where="WHERE cod_tipo_direccion = '1'",
        ),
        "address_unified": tidy("unified_addresses", ("nro_establecimiento", *ADDRESS_FIELDS)),
        "address_latest": tidy("latest_addresses", ("nro_establecimiento", *ADDRESS_FIELDS)),
        "address_latest_bucketed": tidy("latest_addresses", ("nro_establecimiento", *ADDRESS_FIELDS)),
        "establishment_universe": tidy("establishment_universe", UNIVERSE_COLUMNS),
        "establishment_features": tidy("establishment_features", FEATURE_COLUMNS),
        "establishment_universe_dated": tidy("dated_universe", (*UNIVERSE_COLUMNS, "desde")),
        "establishment_features_dated": tidy("establishment_features_dated", [*FEATURE_COLUMNS, "desde"]),
        "establishment_features_rows": tidy("establishment_features_rows", FEATURE_COLUMNS),
        "establishment_fields": tidy("fields", FIELDS),
        "terminal_universe": tidy("terminal_universe", ("nro_establecimiento", "nro_terminal")),
        "principal_universe": tidy(
            "principal_universe",
            ("nro_establecimiento", "cuit_establecimiento_host", "nro_terminal", *REF_ATTRIBUTES),
        ),
        "active_universe": tidy(
            "active_universe", ("nro_establecimiento", "cuit_establecimiento_host", "nro_terminal")
        ),
        "reference_universe": tidy(
            "reference_universe",
            ("nro_establecimiento", "nro_establecimiento_ref", "cuit_establecimiento_host_ref", "nro_terminal",
             *REF_ATTRIBUTES),
        ),
        "reference_ids": tidy(
            "reference_ids", ("nro_establecimiento", "nro_establecimiento_ref", "cuit_establecimiento_host_ref")
        ),
        "reference_row_weights": query("""
            SELECT nro_establecimiento, COUNT(*) AS n_rows FROM reference_universe GROUP BY nro_establecimiento"""),
        "reference_pair_counts": query("""
            SELECT nro_establecimiento_ref, COUNT(*) AS pares FROM reference_ids GROUP BY nro_establecimiento_ref"""),
        "terminals_per_establishment": query("""
            SELECT nro_establecimiento, COUNT(DISTINCT nro_terminal) AS cant_term
            FROM terminal_universe GROUP BY nro_establecimiento"""),
        "per_terminal_activity": query(f"SELECT nro_establecimiento_ref, {rated} FROM reference_activity"),
        "per_terminal_activity_rows": query(
            f"SELECT nro_establecimiento_ref, {rated} FROM reference_activity_rows"
        ),
        "first_install": tidy("first_install", ("terminalid", "fecha_instalacion", "resultado_instalacion")),
        "terminal_activity": tidy("terminal_activity", ACTIVITY_COLUMNS),
        "terminal_activity_from_summary": tidy("terminal_activity", ACTIVITY_COLUMNS),
        "terminal_status": tidy(
            "terminal_status",
            ("nro_terminal", "fecha_instalacion", "resultado_instalacion", "ultima_fecha_actividad",
             "tipo_inactividad", "tipo_tecnologia", "q_tx_wifi", "q_tx_gsm", "q_tx_ethernet", "q_tx_dialup"),
        ),
        "terminal_contract": tidy(
            "terminal_contract",
            ("id_terminal", "ccuit", "nro_establecimiento_contrato", "nro_terminal", "fecha_instalacion",
             "fecha_contrato", "telefono_ater", "estadoterminal_id", "cdomiciliocalle", "fecha_proceso"),
        ),
        "contract_placeholders": query(f"SELECT nro_terminal, {PLACEHOLDERS} FROM terminal_contract"),
        "registry_load": query(" UNION ALL ".join(
            profile(spec.name, c, f"WHERE fecha_movimiento {WINDOW}" if spec.name == "movements" else "")
            for spec in ESTABLISHMENT_SOURCES for c in spec.columns
        )),
        "latest_beneficiary": tidy("latest_beneficiary", ("cuit_establecimiento_host", "beneficiario_host")),
        "latest_legal_name": tidy("latest_legal_name", ("ccuit", "crazonsocial")),
        "installed_base": tidy("installed_base", INSTALLED_COLUMNS),
        "installed_base_joined": tidy("installed_base_joined", INSTALLED_COLUMNS),
        "cumulative_volume": tidy(
            "first_month",
            ("nro_terminal", "fecha_instalacion", "fecha_host_entrada_autoriz", "suma_monto", "vol_cum"),
        ),
        "days_to_activation": query("""
            SELECT nro_terminal, fecha_instalacion, CAST(SUM(suma_monto) AS DOUBLE) AS monto_30,
                   round(MIN(indice) + 1e-7, 4) AS indice,
                   CAST(date_diff('day', fecha_instalacion,
                       MIN(fecha_host_entrada_autoriz) FILTER (vol_cum >= 0)) AS DOUBLE) AS dias_1tx,
                   CAST(date_diff('day', fecha_instalacion,
                       MIN(fecha_host_entrada_autoriz) FILTER (vol_cum >= 85000 * indice)) AS DOUBLE)
                       AS dias_85000
            FROM first_month JOIN inflation_index
                 ON periodo = year(fecha_instalacion) * 100 + month(fecha_instalacion)
            GROUP BY nro_terminal, fecha_instalacion"""),
        "activation_levels": query("""
            SELECT cuit, CAST(nro_establecimiento AS DOUBLE) AS nro_establecimiento, nro_terminal,
                   CAST(nivel_activacion AS BIGINT) AS nivel_activacion FROM activation_levels"""),
        "owner_days": query(
            f"SELECT cuit, {rounded('avg_dias_1tx')} AS avg_dias_1tx, {rounded('avg_dias_85000')} AS avg_dias_85000 "
            "FROM owner_days"
        ),
        "reference_levels": tidy(
            "reference_levels", ("nro_establecimiento_ref", "avg_terminales_nivel_0", "avg_terminales_nivel_1")
        ),
        "reference_levels_rows": tidy(
            "reference_levels_rows",
            ("nro_establecimiento_ref", "avg_terminales_nivel_0", "avg_terminales_nivel_1"),
        ),
        "reference_days": tidy(
            "reference_days", ("nro_establecimiento_ref", "avg_dias_1tx", "avg_dias_85000")
        ),
        "month_volume": query("""
            SELECT nro_establecimiento_orig AS nro_establecimiento, CAST(SUM(volumen) AS DOUBLE) AS suma_monto
            FROM authorisation_days
            WHERE fecha_host_entrada_autoriz BETWEEN DATE '2000-06-01' AND DATE '2000-06-30'
            GROUP BY nro_establecimiento_orig"""),
        "establishment_label": tidy(
            "establishment_label",
            ("cuit_establecimiento_host", "nro_establecimiento", "nivel_activacion", "monto_max"),
        ),
        "establishment_label_rows": tidy(
            "establishment_label_rows",
            ("cuit_establecimiento_host", "nro_establecimiento", "nivel_activacion", "monto_max"),
        ),
        "activation_target": tidy("activation_target", TARGET_COLUMNS),
        "activation_target_rows": tidy("activation_target_rows", TARGET_COLUMNS),
        "principal_features": tidy("principal_features", PRINCIPAL_COLUMNS),
        "principal_features_rows": tidy("principal_features_rows", PRINCIPAL_COLUMNS),
        "cohort_avg_category": cohort("rubro", "avg"),
        "cohort_avg_province": cohort("prov", "avg"),
        "cohort_avg_category_province": cohort("rubro_prov", "avg"),
        "cohort_sum_category": cohort("rubro", "sum"),
        "cohort_sum_province": cohort("prov", "sum"),
        "cohort_sum_category_province": cohort("rubro_prov", "sum"),
        "cohort_sum_locality_province": cohort("loc_prov", "sum"),
        "cohort_features": cohort_features(),
        "great_circle": query(f"""
            SELECT a.nro_establecimiento, {rounded(km("a", "b"))} AS km FROM geo_location AS a,
                   (SELECT CAST(-34.6 AS DOUBLE) AS latitud, CAST(-58.4 AS DOUBLE) AS longitud) AS b"""),
        "radius_neighbours": query(f"""
            SELECT a.nro_establecimiento, COUNT(*) FILTER (
                       a.cuit_establecimiento_host <> b.cuit_establecimiento_host AND {km("a", "b")} <= 5.0) AS vecinos
            FROM {POINTS} AS a JOIN {POINTS} AS b ON abs(a.latitud - b.latitud) < 0.1
            WHERE a.longitud IS NOT NULL AND a.cuit_establecimiento_host IS NOT NULL
            GROUP BY a.nro_establecimiento"""),
        "radius_pairs": query(f"""
            SELECT a.nro_establecimiento, b.nro_establecimiento AS nro_vecino, {rounded(km("a", "b"))} AS km
            FROM {POINTS} AS a JOIN {POINTS} AS b ON abs(a.latitud - b.latitud) < 0.1
                 AND a.cuit_establecimiento_host <> b.cuit_establecimiento_host
            WHERE {km("a", "b")} <= 5.0"""),
        "neighbour_stats": query(f"""
            SELECT a.cuit_establecimiento_host,
                   {", ".join(f"{rounded(f'AVG(b.{m})')} AS {m}_geo" for m in COHORT_MEASURES)}
            FROM (SELECT DISTINCT cuit_establecimiento_host, latitud, longitud FROM {POINTS} AS p) AS a
            JOIN (SELECT DISTINCT p.cuit_establecimiento_host, p.latitud, p.longitud, {", ".join(f"m.{c}" for c in COHORT_MEASURES)}
                  FROM {POINTS} AS p LEFT JOIN establishment_activity AS m
                       ON m.nro_establecimiento = p.nro_establecimiento) AS b
                 ON a.cuit_establecimiento_host <> b.cuit_establecimiento_host
                 AND abs(a.latitud - b.latitud) < 0.1
            WHERE {km("a", "b")} <= 5.0
            GROUP BY a.cuit_establecimiento_host"""),
        "geo_features": query(
            "SELECT cuit_establecimiento_host, "
            + ", ".join(f"{rounded(f'{m}_geo')} AS {m}_geo" for m in TXS_MEASURES)
            + " FROM geo_features"
        ),
        "feature_records": query("""
            SELECT COALESCE(nro_establecimiento, -1) AS nro_establecimiento, cuit_establecimiento_host, cod_rubro,
                   desc_rubro, nombre_fantasia, beneficiario_host, cod_estado_establecimiento,
                   desc_estado_establecimiento, nivel_seguridad_moto_ecom,
                   CAST(COALESCE(bandera, -1) AS BIGINT) AS bandera, CAST(963619200 AS DOUBLE) AS event_time
            FROM fields"""),
        "feature_strings": query("""
            SELECT COALESCE(cuit_establecimiento_host, 'None') AS cuit_establecimiento_host, nro_establecimiento,
                   CAST(nivel_activacion AS BIGINT) AS nivel_activacion, round(monto_max + 1e-7, 4) AS monto_max,
                   '2000-07-15' AS fe_proceso, CAST(963619200 AS DOUBLE) AS event_time
            FROM establishment_label"""),
        "latest_features": query(NEWEST_RECORDS),
        "read_period": query(ALL_RECORDS),
        "read_period_latest": query(NEWEST_RECORDS),
        "ingest_job": query(ALL_RECORDS),
        "ingest_repeated": query(" UNION ALL ".join(ALL_RECORDS.split(" UNION ALL ")[:2])),
        "model_table": model(),
    }

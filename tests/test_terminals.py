from __future__ import annotations

from datetime import date

import pytest
from conftest import DATE_REF, values

from merchant_features.functions.periods import anchors
from merchant_features.operators import terminals as TE

A = anchors(DATE_REF)


@pytest.fixture(scope="module")
def tables(frame):
    return {
        "terminals": frame(
            "id_terminal long, cprefijo string, cnumeroterminal string, contratoestablecimiento_id long, estadoterminal_id int",
            (1, "0700", "1", 10, 1), (2, "51", "2", 10, 1), (3, "0800", "3", 10, 1), (4, "0700", "4", 11, 1),
            (5, "0700", "5", None, 1), (6, "0700", "6", 10, 1),
        ),
        "state_log": frame(
            "terminalid long, dfechalogging date, postestadoid int",
            (1, date(2021, 1, 5), 9), (1, date(2021, 2, 5), 2), (1, date(2021, 3, 5), 3), (1, date(2021, 4, 5), 8),
            (2, date(2021, 1, 1), 7), (2, date(2021, 1, 1), 4),
            (4, date(2021, 9, 1), 17), (5, date(2021, 5, 1), 99),
        ),
        "contracts": frame(
            "id_contratoestablecimiento long, ccuit string, cnumeroestablecimiento string, dfechacontrato date, "
            "ccontactotelefono string, cdomiciliocalle string, crazonsocial string",
            (10, "T1", "100", date(2020, 1, 1), "1", "s", "Old SA"), (11, "T1", "x", date(2021, 1, 1), "1", "s", "New SA"),
        ),
        "vip_owners": frame("nro_cuit string", ("T1",), ("T1",)),
        "billing": frame(
            "nro_terminal string, codigo_cargo string, nro_mes_cargo int, fecha_alta_terminal date, "
            "periodo_inicio_cargo int, periodo int",
            ("071", "C", 1, date(2021, 1, 1), 202101, 202110),
        ),
        "phones": frame("nro_establecimiento long, ddn string, numero_telefono string", (100, "011", "55")),
        "templates": frame(
            "id_terminal string, fecha_parametrizacion date, plantilla_origen string, plantilla_destino string, "
            "version_origen string, medio string, marca string, plantilla_adecuada string",
            ("071", date(2021, 6, 1), "a", "b", "1", "m", "k", "b"),
        ),
        "terminal_models": frame("id_terminal string, modelo string", ("071", "M1")),
        "establishment_history": frame(
            "cuit_establecimiento_host string, nro_establecimiento long, id_carga long, cod_rubro string, "
            "nombre_fantasia string, cod_banco int, beneficiario_host string, fecha_alta date",
            ("T1", 100, 1, "R1", "Shop", 16, None, date(2020, 1, 1)), ("T1", 100, 2, "R2", "Shop2", 7, "Owner", date(2019, 1, 1)),
        ),
    }


@pytest.fixture(scope="module")
def activity(frame):
    return frame(
        "nro_terminal string, ultima_fecha_actividad date, rango_tecnologia int, q_tx_wifi long, q_tx_gsm long, "
        "q_tx_ethernet long, q_tx_dialup long, dias_sin_actividad int",
        ("071", date(2021, 8, 2), 2, 0, 3, 0, 0, 120),
    )


def test_first_install(tables):
    assert values(TE.first_install(tables["state_log"])) == [
        (1, date(2021, 1, 5), 9), (2, date(2021, 1, 1), 4), (4, date(2021, 9, 1), 17), (5, date(2021, 5, 1), 99),
    ]


def test_terminal_status(tables, activity):
    got = TE.terminal_status(tables["terminals"], tables["state_log"], activity)
    assert values(got, "nro_terminal", "fecha_instalacion", "tipo_inactividad", "tipo_tecnologia", "q_tx_gsm") == sorted(
        [
            ("071", date(2021, 1, 5), "3 a 6", "GSM", 3), ("512", date(2021, 1, 1), None, "PINPAD", None),
            ("074", date(2021, 9, 1), None, "SIN DATO", None), ("075", date(2021, 5, 1), None, "SIN DATO", None),
        ],
        key=repr,
    )


def test_terminal_contract_takes_the_latest_qualifying_install(tables):
    got = TE.terminal_contract(tables["terminals"], tables["contracts"], tables["state_log"], A.lastday)
    assert values(got, "id_terminal", "nro_terminal", "fecha_instalacion", "ccuit") == sorted(
        [
            (1, "071", date(2021, 3, 5), "T1"), (2, "512", None, "T1"), (4, "074", date(2021, 9, 1), "T1"),
            (5, "075", None, None), (6, "076", None, "T1"),
        ],
        key=repr,
    )
    assert set(TE.placeholder_types()) <= set(got.columns)
    assert {r.fecha_proceso for r in got.collect()} == {"2021-11-30"}


def test_partition_by_log_key_keeps_one_terminal_without_log(tables):
    got = TE.terminal_contract(
        tables["terminals"], tables["contracts"], tables["state_log"], A.lastday, partition_by="terminalid"
    )
    rows = values(got, "id_terminal", "fecha_instalacion")
    assert [r for r in rows if r[1] is not None] == [(1, date(2021, 3, 5)), (4, date(2021, 9, 1))]
    assert len([r for r in rows if r[1] is None]) == 1


def test_owner_names(tables):
    assert values(TE.latest_legal_name(tables["contracts"])) == [("T1", "New SA")]
    assert values(TE.latest_beneficiary(tables["establishment_history"])) == [("T1", None)]


def test_installed_base(tables, activity):
    got = TE.installed_base(tables, A.lastday, activity, acquirer="acq")
    assert got.columns == list(TE.installed_columns("acq"))
    assert "nro_establecimiento_masteracq" in got.columns and "fecha_alta_estab_cabalacq" in got.columns
    columns = ("nro_terminal", "cuit", "razon_social", "cuit_vip", "acepta_liquidacion", "cod_rubro", "plan", "modelo",
               "condicion_soft", "telefono_host")
    assert values(got, *columns) == sorted(
        [
            ("071", "T1", "New SA", "SI", "NO", None, "C", "M1", "Soft Correcto", None),
            ("512", "T1", "New SA", "SI", "NO", None, None, None, "Sin Dato", None),
            ("074", "T1", "New SA", "SI", "NO", None, None, None, "Sin Dato", None),
            ("075", None, None, "NO", "NO", None, None, None, "Sin Dato", None),
        ],
        key=repr,
    )
    types = dict(got.dtypes)
    assert types["nro_establecimiento_visa"] == "string" and types["fecha_alta_estab_visa"] == "date"
    assert types["cod_rubro"] == "string" and types["banco_visa"] == "int"


def test_installed_base_with_an_establishment_key(tables, activity):
    got = TE.installed_base(tables, A.lastday, activity, history_key="nro_establecimiento_contrato")
    columns = ("nro_terminal", "cuit_establecimiento_host", "denominacion", "razon_social", "acepta_liquidacion", "telefono_host")
    assert values(got.where("cuit IS NOT NULL"), *columns) == sorted(
        [
            ("071", "T1", "Shop2", "Owner", "SI", "011-55"), ("512", "T1", "Shop2", "Owner", "SI", "011-55"),
            ("074", None, None, "New SA", "NO", None),
        ],
        key=repr,
    )

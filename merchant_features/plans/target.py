"""Activation label table: one row per owner."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from merchant_features.functions.periods import anchors, with_period
from merchant_features.operators.activation import establishment_label, owner_label
from merchant_features.operators.activity import acquiring_days
from merchant_features.operators.universe import OWNER, latest_establishments
from merchant_features.plans.shared import Shared, prepare_shared
from merchant_features.sources.tables import TARGET_SOURCES, narrow


def activation_target(
    tables: Mapping[str, DataFrame], date_ref: date, weighting: str = "none", shared: Shared | None = None,
    **installed_options,
) -> DataFrame:
    """Activation class and adjusted amount of every owner in the last full month."""
    a = anchors(date_ref)
    tables = narrow(tables, TARGET_SOURCES, date_ref)
    establishments = latest_establishments(tables["establishment_history"], [OWNER])
    shared = shared or prepare_shared(tables, date_ref, **installed_options)
    labels = establishment_label(
        establishments,
        shared.installed,
        tables["inflation_index"],
        acquiring_days(shared.summary),
        a,
        weighting,
    )
    return with_period(owner_label(labels), date_ref)

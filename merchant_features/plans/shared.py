"""What the principal and the label table both start from, prepared once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from merchant_features.functions.periods import anchors
from merchant_features.operators.activity import ESTABLISHMENT, summarise_authorisations, terminal_days
from merchant_features.operators.terminals import installed_base
from merchant_features.sources.storage import bucketed, materialize
from merchant_features.sources.tables import ADDRESS_HISTORY, ESTABLISHMENT_HISTORY, GEO_LOCATION, PRINCIPAL_SOURCES, narrow


@dataclass(frozen=True)
class Shared:
    """The authorisations summarised by terminal, establishment and day, and the installed base."""

    summary: DataFrame
    installed: DataFrame


def prepare_shared(tables: Mapping[str, DataFrame], date_ref: date, **installed_options) -> Shared:
    """Read the authorisations once and write both relations; this is where that work runs.

    The summary has several readers in each table. The installed base joins ten
    sources and is read by installs, labels and levels.
    """
    a = anchors(date_ref)
    present = {s.name for s in PRINCIPAL_SOURCES} & set(tables)
    tables = narrow(tables, [s for s in PRINCIPAL_SOURCES if s.name in present], date_ref)
    summary = materialize(summarise_authorisations(tables["authorisations"]))
    installed = installed_base(tables, a.lastday, terminal_days(summary, a.lastday), **installed_options)
    return Shared(summary, materialize(installed))


#: Tables that the plans join and rank by establishment, several times each.
BY_ESTABLISHMENT = (ESTABLISHMENT_HISTORY, ADDRESS_HISTORY, GEO_LOCATION)


def by_establishment(tables: Mapping[str, DataFrame], date_ref: date, buckets: int) -> dict[str, DataFrame]:
    """``tables`` with the histories by establishment filtered, narrowed and written into sorted buckets.

    The latest versions and addresses, and the joins between them, then need no
    shuffle by establishment: the writing is the only one of a run. ``buckets``
    should give files of about 200 MB.
    """
    present = [s for s in BY_ESTABLISHMENT if s.name in tables]
    known = {name: df for name, df in tables.items() if name in {s.name for s in present}}
    return dict(tables) | {name: bucketed(df, ESTABLISHMENT, buckets) for name, df in narrow(known, present, date_ref).items()}

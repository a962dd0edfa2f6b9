"""Universes of establishments and terminals, and sums over paired establishments.

Two establishments of one owner are paired when a terminal appears under both
and the second one is active. The pairs themselves are the answer of
``reference_universe`` only; the feature plans need sums over them, which
``row_weights`` and ``paired_sums`` compute without listing all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_features.functions import predicates as P
from merchant_features.functions.geo import sanitize_geo
from merchant_features.operators.activity import ESTABLISHMENT, TERMINAL
from merchant_features.operators.history import top1_per_key
from merchant_features.operators.lookup import code_names, existing, lookup, salted_join
from merchant_features.sources.storage import materialize

#: No result depends on these. A terminal with more establishments of one owner is a hub (see ``paired_sums``);
#: sets of more hubs never go through the trie; establishments with more shared terminals do not list them.
HUB_MEMBERS = 64
MOST_TUPLE_HUBS = 16
MOST_TERMINALS = 256

OWNER = "cuit_establecimiento_host"
OWNER_REF = "cuit_establecimiento_host_ref"
REF = "nro_establecimiento_ref"
# Output column names.
GEO_COLUMNS = ("latitud", "longitud", "desc_departamento_geo", "desc_provincia_geo", "desc_localidad_gba_geo")
ATTRIBUTES = (
    "cod_rubro", "desc_rubro", "nombre_fantasia", "beneficiario_host",
    "cod_estado_establecimiento", "desc_estado_establecimiento", "nivel_seguridad_moto_ecom",
    "bandera", *GEO_COLUMNS, "cod_provincia", "desc_provincia", "nombre_calle", "numero_calle",
    "codigo_postal", "cod_localidad", "localidad", "direccion",
)


def latest_establishments(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest version of every establishment by load id."""
    return top1_per_key(
        history.select(ESTABLISHMENT, "id_carga", *columns),
        [ESTABLISHMENT],
        [F.col("id_carga").desc_nulls_last()],
    ).select(*columns, ESTABLISHMENT)


def establishment_fields(history: DataFrame, states: DataFrame, categories: DataFrame) -> DataFrame:
    """Latest version of every establishment with its state and category names."""
    latest = latest_establishments(
        history,
        (
            OWNER, "cod_rubro", "nombre_fantasia", "beneficiario_host",
            "cod_estado_establecimiento", "nivel_seguridad_moto_ecom", "bandera",
        ),
    )
    named = lookup(
        lookup(latest, code_names(categories, "cod_rubro", "desc_rubro"), "cod_rubro", ["desc_rubro"]),
        code_names(states, "cd_estado_establecimiento", "ds_estado_establecimiento"),
        {"cod_estado_establecimiento": "cd_estado_establecimiento"},
        {"desc_estado_establecimiento": "ds_estado_establecimiento"},
    )
    return named.withColumn("nivel_seguridad_moto_ecom", F.trim("nivel_seguridad_moto_ecom"))


def terminal_universe(terminal_history: DataFrame) -> DataFrame:
    """Distinct establishment and terminal pairs with an allowed prefix."""
    return (
        terminal_history.where(P.has_prefix(TERMINAL, P.UNIVERSE_PREFIXES))
        .select(ESTABLISHMENT, TERMINAL)
        .distinct()
    )


def with_location(df: DataFrame, addresses: DataFrame, geo: DataFrame) -> DataFrame:
    """Add the address and the sanitised geographic columns of every establishment."""
    address_columns = [c for c in addresses.columns if c != ESTABLISHMENT]
    located = lookup(lookup(df, addresses, ESTABLISHMENT, address_columns), geo, ESTABLISHMENT, GEO_COLUMNS)
    return located.withColumns(sanitize_geo("desc_provincia"))


def located_establishments(fields: DataFrame, addresses: DataFrame, geo: DataFrame) -> DataFrame:
    """Establishments with location, one row per distinct geographic record."""
    return (
        with_location(fields, addresses, geo).select(ESTABLISHMENT, OWNER, *ATTRIBUTES).distinct()
    )


def principal_universe(located: DataFrame, terminals: DataFrame) -> DataFrame:
    """Located establishments by terminal."""
    return located.join(terminals, ESTABLISHMENT).select(
        ESTABLISHMENT, OWNER, TERMINAL, *ATTRIBUTES
    )


def active_universe(fields: DataFrame, terminals: DataFrame, activity: DataFrame) -> DataFrame:
    """Terminals of the establishments that have activity."""
    return (
        existing(fields.select(ESTABLISHMENT, OWNER), activity, ESTABLISHMENT)
        .join(terminals, ESTABLISHMENT)
        .select(ESTABLISHMENT, OWNER, TERMINAL)
    )


def with_active_flag(fields: DataFrame, activity: DataFrame) -> DataFrame:
    """Establishments with a flag that tells whether they have activity."""
    active = activity.select(ESTABLISHMENT).distinct().withColumn("active", F.lit(True))
    return fields.join(active, ESTABLISHMENT, "left").withColumn(
        "active", F.coalesce("active", F.lit(False))
    )


def owned_terminals(flagged: DataFrame, terminals: DataFrame) -> DataFrame:
    """Owner, establishment, terminal and the active flag."""
    return terminals.join(flagged.select(ESTABLISHMENT, OWNER, "active"), ESTABLISHMENT)


def reference_universe(universe: DataFrame, active: DataFrame) -> DataFrame:
    """Universe rows under every active establishment of the same owner and terminal, and under their own."""
    reference = universe.select(
        F.col(ESTABLISHMENT).alias(REF),
        F.col(OWNER).alias(OWNER_REF),
        TERMINAL,
        *ATTRIBUTES,
    )
    pair_key = active.select(ESTABLISHMENT, F.col(OWNER).alias(OWNER_REF), TERMINAL)
    paired = salted_join(reference, materialize(pair_key), [OWNER_REF, TERMINAL], "inner")
    own = reference.withColumn(ESTABLISHMENT, F.col(REF))
    columns = [ESTABLISHMENT, REF, OWNER_REF, TERMINAL, *ATTRIBUTES]
    return paired.select(*columns).unionByName(own.select(*columns)).dropna(subset=[REF])


def distinct_ids(reference: DataFrame) -> DataFrame:
    return reference.select(ESTABLISHMENT, REF, OWNER_REF).distinct()


def row_weights(members: DataFrame, located: DataFrame) -> DataFrame:
    """Rows of the reference universe under every establishment, without building it.

    An establishment has its own universe rows, and for each terminal it is
    active with all universe rows of that owner and terminal. ``located`` has
    one row per location of an establishment.
    """
    places = located.groupBy(ESTABLISHMENT).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = members.join(places, ESTABLISHMENT)
    # written, so that both sides of the join are plain shuffles and a hot terminal's members can be split
    per_terminal = materialize(rows.groupBy(OWNER, TERMINAL).agg(F.sum("n_rows").alias("n_rows")))
    paired = members.where("active").join(per_terminal, [OWNER, TERMINAL])
    return (
        paired.select(ESTABLISHMENT, "n_rows")
        .unionByName(rows.select(ESTABLISHMENT, "n_rows"))
        .groupBy(ESTABLISHMENT)
        .agg(F.sum("n_rows").alias("n_rows"))
    )


def _hub_terminals(members: DataFrame, hub_members: int) -> DataFrame:
    """Number of members of every terminal shared within an owner, and whether it is a hub; written once."""
    sizes = members.groupBy(OWNER, TERMINAL).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return materialize(sizes.select(OWNER, TERMINAL, (F.col("__n") > hub_members).alias("hub")))


def _at_first_shared(a: str, b: str, terminal: str = TERMINAL) -> Column:
    """The canonical-terminal rule: of all terminals that two sorted lists share, this is the smallest."""
    return F.array_min(F.array_intersect(a, b)) == F.col(terminal)


def paired_ids(members: DataFrame, most_terminals: int = MOST_TERMINALS) -> DataFrame:
    """Every establishment with itself and with each active establishment of its owner that it shares a terminal with.

    The distinct ids of the reference universe, without building it: a pair is
    made only at the smallest terminal that both hold, so no pair is made twice
    and none are compared for being distinct. Establishments of more than
    ``most_terminals`` shared terminals do not carry the list of them along;
    their pairs, and theirs alone, are made at every shared terminal and reduced.
    """
    key = [OWNER, ESTABLISHMENT]
    shared = members.join(_hub_terminals(members, HUB_MEMBERS).drop("hub"), [OWNER, TERMINAL])
    held = materialize(
        shared.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.bool_or("active").alias("active"))
    )
    few = held.where(F.col("__n") <= most_terminals).select(*key)
    lists = shared.join(few, key).groupBy(*key).agg(F.sort_array(F.collect_set(TERMINAL)).alias("__held"))
    rows = materialize(shared.select(*key, TERMINAL, "active").distinct().join(lists, key, "left"))
    partner = rows.where("active").select(
        OWNER, TERMINAL, F.col(ESTABLISHMENT).alias("__partner"), F.col("__held").alias("__partner_held")
    )
    met = salted_join(rows.select(*key, TERMINAL, "__held"), materialize(partner), [OWNER, TERMINAL], "inner")
    met = met.where(F.col(ESTABLISHMENT) != F.col("__partner"))
    columns = [F.col("__partner").alias(ESTABLISHMENT), F.col(ESTABLISHMENT).alias(REF), F.col(OWNER).alias(OWNER_REF)]
    listed = F.col("__held").isNotNull() & F.col("__partner_held").isNotNull()
    pairs = met.where(listed & _at_first_shared("__held", "__partner_held")).select(*columns)
    if not held.where(F.col("__n") > most_terminals).isEmpty():
        pairs = pairs.unionByName(met.where(~listed).select(*columns).distinct())
    own = members.select(*key).distinct().select(
        ESTABLISHMENT, F.col(ESTABLISHMENT).alias(REF), F.col(OWNER).alias(OWNER_REF)
    )
    return own.dropna(subset=[REF]).unionByName(pairs)


def _between_hub_sets(sets: DataFrame, names: Sequence[str]) -> DataFrame:
    """For every set of hubs, the sums over all sets of its owner that share a hub with it, itself included.

    ``sets`` (owner, hubs, sums) is a written table with one row per distinct
    set. Every pair of sets counts once, whatever they share, in one of two ways:

    * A trie of ordered hub tuples: its nodes are the tuples that some set holds,
      the sum of a node is that of all sets below it, that is of all that hold
      the whole tuple. What a set shares a hub with is the signed sum of its own
      nodes, those of odd length less those of even length, so a set costs
      2 ** hubs - 1 rows and is never paired with another.
    * A set with more tuples than its owner has sets is paired with these sets
      instead, each at the smallest hub that both hold.
    """
    names = list(names)
    total = sets.groupBy(OWNER).agg(F.count(F.lit(1)).alias("__n"))
    many = (F.size("hubs") > MOST_TUPLE_HUBS) | (F.expr("shiftleft(1L, size(hubs)) - 1") > F.col("__n"))
    judged = materialize(sets.join(total, OWNER).withColumn("listed", many).drop("__n"))
    sums = [F.sum(n).alias(n) for n in names]

    in_trie = judged.where("NOT listed").drop("listed")
    chosen = F.explode(F.expr("sequence(1, shiftleft(1, size(hubs)) - 1)"))
    held = F.expr("filter(hubs, (h, i) -> (shiftright(__tuple, i) & 1) = 1)")
    tuples = materialize(in_trie.withColumn("__tuple", chosen).withColumn("__tuple", held))
    nodes = materialize(tuples.groupBy(OWNER, "__tuple").agg(*sums))
    sign = F.when(F.size("__tuple") % 2 == 1, 1).otherwise(-1)
    from_trie = tuples.select(OWNER, "hubs", "__tuple").join(nodes, [OWNER, "__tuple"]).select(
        OWNER, "hubs", *[(F.col(n) * sign).alias(n) for n in names]
    )
    if judged.where("listed").isEmpty():
        return from_trie.groupBy(OWNER, "hubs").agg(*sums)

    at_hub = materialize(judged.withColumn(TERMINAL, F.explode("hubs")))
    other = at_hub.withColumnsRenamed({"hubs": "other", "listed": "other_listed"} | {n: f"__{n}" for n in names})
    met = salted_join(at_hub.where("listed"), other, [OWNER, TERMINAL], "inner").where(_at_first_shared("hubs", "other"))
    met = materialize(met.drop("listed", TERMINAL))
    to_listed = met.select(OWNER, "hubs", *[F.col(f"__{n}").alias(n) for n in names])
    to_others = met.where("NOT other_listed").select(OWNER, F.col("other").alias("hubs"), *names)
    return from_trie.unionByName(to_listed).unionByName(to_others).groupBy(OWNER, "hubs").agg(*sums)


def paired_sums(
    members: DataFrame, weights: DataFrame, names: Sequence[str], hub_members: int = HUB_MEMBERS
) -> DataFrame:
    """Sum ``names`` over the distinct establishments paired with every reference establishment.

    ``members`` holds owner, establishment, terminal and the active flag;
    ``weights`` at most one row per establishment.

    Terminals with over ``hub_members`` establishments of an owner are hubs. Who
    an establishment meets at hubs depends on its set of hubs alone, so those
    sums are taken between the distinct sets (as sorted arrays), through a trie
    of hub tuples (``_between_hub_sets``). Establishments that meet only at
    smaller terminals are listed, at most ``hub_members`` per establishment and
    terminal, at the smallest terminal that both hold. No pair is counted twice:
    a listed pair must not share a hub.
    """
    key, names = [OWNER, ESTABLISHMENT], list(names)
    terminals = _hub_terminals(members, hub_members)
    meeting = members.join(terminals, [OWNER, TERMINAL])
    lists = meeting.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.when(F.col("hub"), F.col(TERMINAL)))).alias("hubs"),
        F.array_sort(F.collect_set(F.when(~F.col("hub"), F.col(TERMINAL)))).alias("smalls"),
    )
    none = F.array().cast("array<string>")
    valued = materialize(
        members.groupBy(*key)
        .agg(F.bool_or("active").alias("active"))
        .join(lists, key, "left")
        .join(weights, ESTABLISHMENT, "left")
        .select(
            *key, "active", F.coalesce("hubs", none).alias("hubs"), F.coalesce("smalls", none).alias("smalls"),
            *[F.coalesce(n, F.lit(0)).alias(n) for n in names],
        )
    )
    sums = [F.sum(n).alias(n) for n in names]

    # between sets of hubs
    with_hubs = valued.where(F.size("hubs") > 0)
    sets = materialize(
        with_hubs.groupBy(OWNER, "hubs").agg(
            *[F.coalesce(F.sum(F.when(F.col("active"), F.col(n))), F.lit(0)).alias(n) for n in names]
        )
    )
    of_sets = _between_hub_sets(sets, names)
    at_hubs = with_hubs.join(of_sets.withColumnsRenamed({n: f"__{n}" for n in names}), [OWNER, "hubs"]).select(
        ESTABLISHMENT,
        *[(F.col(f"__{n}") - F.when(F.col("active"), F.col(n)).otherwise(0)).alias(n) for n in names],
    )

    # between establishments that share smaller terminals only
    small = materialize(valued.select(*key, "hubs", "smalls", "active", F.explode("smalls").alias(TERMINAL), *names))
    partner = small.where("active").select(
        OWNER, TERMINAL, F.col(ESTABLISHMENT).alias("__partner"), F.col("hubs").alias("__hubs"),
        F.col("smalls").alias("__smalls"), *names,
    )
    at_small = (
        small.drop("active", *names).join(partner, [OWNER, TERMINAL])
        .where((F.col(ESTABLISHMENT) != F.col("__partner")) & ~F.arrays_overlap("hubs", "__hubs"))
        .where(_at_first_shared("smalls", "__smalls"))
        .select(ESTABLISHMENT, *names)
    )

    own = valued.select(ESTABLISHMENT, *names)
    return (
        own.unionByName(at_hubs)
        .unionByName(at_small)
        .groupBy(F.col(ESTABLISHMENT).alias(REF))
        .agg(*sums)
    )

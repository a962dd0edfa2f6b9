"""Lookups, existence tests and joins that keep hot keys apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_features.functions.periods import Anchors, period_key
from merchant_features.sources.storage import materialize

#: What is broadcast has at most so many bytes, as ``measured_bytes`` counts them.
BROADCAST_BYTES = 64 << 20
HOT_KEY_ROWS = 2_000_000


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    columns: Mapping[str, str] | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join ``dim`` on equality and add ``columns`` of it.

    ``on`` maps a column of ``df`` to one of ``dim``; ``columns`` maps a new
    name to a column of ``dim``. No hint is given: Spark broadcasts a code
    table when its measured size is below the session's threshold.
    """
    if isinstance(on, str):
        on = [on]
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    added = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    replaced = [c for c in added if c in df.columns]
    if set(replaced) & set(keys):
        raise ValueError(f"a lookup cannot replace its own key: {sorted(set(replaced) & set(keys))}")
    marks = {left: f"__key_{right}" for left, right in keys.items()}
    side = dim.select(
        *[F.col(right).alias(marks[left]) for left, right in keys.items()],
        *[F.col(source).alias(name) for name, source in added.items()],
    )
    cond = [F.col(left) == F.col(mark) for left, mark in marks.items()]
    return df.drop(*replaced).join(side, cond, how).drop(*marks.values())


def code_names(table: DataFrame, code: str, name: str) -> DataFrame:
    """A code table with one name per code."""
    return table.groupBy(code).agg(F.min(name).alias(name))


def existing(df: DataFrame, facts: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``facts``; facts are reduced to distinct keys first."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(facts.select(*keys).distinct(), keys, "left_semi")


def window_index(index: DataFrame, a: Anchors | None = None) -> DataFrame:
    """The index with one row per period, limited to the scan window if anchors are given."""
    if a is not None:
        index = index.where(F.col("periodo").between(a.first_period, a.last_period))
    return index.groupBy(F.col("periodo").cast("int").alias("periodo")).agg(
        F.min("indice").cast("double").alias("indice")
    )


def with_index(
    df: DataFrame, day: str, index: DataFrame, how: str = "left", a: Anchors | None = None
) -> DataFrame:
    """Add ``indice`` of the month of ``day``.

    The index side has one row per calendar month after grouping, so it is
    broadcast: a shuffle by month would put the facts into a dozen tasks.
    """
    side = window_index(index, a).select(
        F.col("periodo").alias("__period"), F.col("indice").alias("indice")
    )
    return df.join(F.broadcast(side), period_key(day) == F.col("__period"), how).drop("__period")


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows take in memory, measured on all of them: eight per column and the text and list contents.

    ``df`` must be cheap to read (a written table).
    """
    width = F.lit(8 * (len(df.columns) + 1)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
        elif isinstance(field.dataType, T.DecimalType) and field.dataType.precision > 18:
            width = width + 16
    return df.agg(F.sum(width)).first()[0] or 0


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with over ``hot_rows`` rows and the number of tasks to spread each over, written once."""
    splits = F.ceil(F.count(F.lit(1)) / hot_rows).cast("int")
    return materialize(df.groupBy(*on).agg(splits.alias("__n")).where("__n > 1"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_KEY_ROWS,
    hot: DataFrame | None = None,
    salt_on: Sequence[str] | None = None,
) -> DataFrame:
    """Equi join whose hot left keys are spread over several tasks.

    Keys with over ``hot_rows`` left rows are counted exactly (or given as
    ``hot``), their left rows get one of ``n`` salts and their right rows are
    repeated ``n`` times; all other keys keep salt 0. The hot-key list has at
    most rows / ``hot_rows`` entries and its bytes are measured before it is
    broadcast. The salt is a hash of ``salt_on`` (all left columns by default),
    never a random number, so a recomputed task sends every row to the place it
    went before.
    """
    keys = list(on)
    hot = hot_keys(left, keys, hot_rows) if hot is None else hot
    size = measured_bytes(hot)
    if size == 0:
        return left.join(right, keys, how)
    side = F.broadcast(hot) if size <= BROADCAST_BYTES else hot
    spread = F.coalesce(F.col("__n"), F.lit(1))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_on or left.columns]), spread)
    salted = left.join(side, keys, "left").withColumn("__salt", salt.cast("int")).drop("__n")
    copies = (
        right.join(side, keys, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), spread - 1)))
        .drop("__n")
    )
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def checked_lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join to a table with few keys, each of them possibly hot.

    ``dim`` must be cheap to read (a written table). It is broadcast when its
    rows have at most ``max_bytes`` bytes; beyond that the hot keys are salted.
    """
    if measured_bytes(dim) <= max_bytes:
        return df.join(F.broadcast(dim), list(on), "left")
    return salted_join(df, dim, on, "left")

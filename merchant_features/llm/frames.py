"""Column expressions and table helpers shared by the text operators."""

from __future__ import annotations

import dataclasses
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII text takes the quick way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def broadcast_fields(spark: SparkSession, value):
    """A dataclass instance sent as the tuple of its fields, to be made again in the tasks.

    Broadcast values are pickled by the names of their classes, which executors need not have; functions are not.
    """
    return spark.sparkContext.broadcast(tuple(getattr(value, f.name) for f in dataclasses.fields(value)))


def words_of(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def row_struct(df: DataFrame) -> Column:
    """The whole row as one struct, so that no column of the caller can clash with an operator's own."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")


def row_columns(df: DataFrame, replaced: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``df`` in order, taken out of ``row``, some replaced."""
    replaced = replaced or {}
    return [replaced.get(c, F.col("row")[c]).alias(c) for c in df.columns]

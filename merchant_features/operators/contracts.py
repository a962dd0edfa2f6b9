"""Output contracts: typed columns, defaults, placeholders and feature types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
KEPT = (T.BooleanType, T.TimestampType, T.TimestampNTZType, T.StringType)


def cast_to_schema(
    df: DataFrame,
    types: Mapping[str, str],
    rename: Mapping[str, str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Select exactly ``types`` in order: cast, then default.

    ``rename`` maps an output name to the input column it comes from,
    ``defaults`` an output name to the value that replaces NULL. Text that is
    not a number becomes NULL; a number too large for its type is an error.
    """
    rename, defaults = rename or {}, defaults or {}
    out = []
    for name, dtype in types.items():
        source = rename.get(name, name)
        value = F.col(source)
        if isinstance(df.schema[source].dataType, T.StringType):
            value = value.try_cast(dtype)
        elif dtype == "float":
            # A decimal goes to float by way of double, the rounding every engine shares.
            value = value.cast("double").cast(dtype)
        else:
            value = value.cast(dtype)
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]).cast(dtype))
        out.append(value.alias(name))
    return df.select(*out)


def add_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add typed NULL columns."""
    return df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in types.items()})


def fill_numeric(df: DataFrame, value: float = 0.0, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL in the numeric columns, or in those named."""
    return df.fillna(value, subset=None if columns is None else list(columns))


def _feature_column(field: T.StructField, strings_only: bool, null_int: int, null_string: str | None) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, INTEGERS):
        if not strings_only:
            value = F.coalesce(value.cast("bigint"), F.lit(null_int).cast("bigint"))
    elif isinstance(field.dataType, FLOATS):
        if not strings_only:
            value = value.cast("double")
    else:
        if not isinstance(field.dataType, KEPT):
            value = value.cast("string")
        if null_string is not None and not isinstance(field.dataType, KEPT[:-1]):
            value = F.coalesce(value, F.lit(null_string))
    return value.alias(field.name)


def to_feature_types(
    df: DataFrame,
    null_int: int = -1,
    strings_only: bool = False,
    null_string: str | None = None,
) -> DataFrame:
    """Text, dates and decimals to string, integers to bigint with NULL as ``null_int``, floats to double.

    ``strings_only`` leaves the numbers as they are. NULL text stays NULL
    unless ``null_string`` names a replacement.
    """
    return df.select(
        *[_feature_column(f, strings_only, null_int, null_string) for f in df.schema.fields]
    )

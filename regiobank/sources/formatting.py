"""Result formatting for clients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the timestamp text clients receive.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"


def format_balance(value: Column) -> Column:
    return value.cast("double")


def format_account_count(value: Column) -> Column:
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))


def _formatted(name: str, kind: T.DataType, counts_as_double: bool) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = F.date_format(value, TIMESTAMP_TEXT)
    elif isinstance(kind, (T.DecimalType, T.FractionalType)):
        value = value.cast("double")
    elif isinstance(kind, T.IntegralType):
        value = value.cast("double" if counts_as_double else "bigint")
    return value.alias(name.lower())


def format_result(df: DataFrame, counts_as_double: bool = True) -> DataFrame:
    """Lower-case names, timestamps as text, numbers as doubles (or whole numbers kept as bigint)."""
    return df.select(*[_formatted(f.name, f.dataType, counts_as_double) for f in df.schema.fields])


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULLs kept, for a JSON sink."""
    formatted = format_result(df)
    return formatted.select(
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in formatted.columns]), {"ignoreNullFields": "false"}).alias("value")
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    to_json_rows(df).write.mode(mode).text(path)

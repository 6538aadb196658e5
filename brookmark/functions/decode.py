"""Typed decode of change-log row images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.specs import TableSpec, spark_type


def _default(kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.lit(0)
    return F.lit(0).cast(kind)


def decode_leaf(leaf: Column, kind: T.DataType, nulls: str = "default") -> Column:
    """Stored value of one typed leaf: micros to timestamp, days to date, the rest as they are.

    ``nulls="default"`` gives the mirror's non-null columns (empty text, zero, epoch).
    """
    value = F.coalesce(leaf, _default(kind)) if nulls == "default" else leaf
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(value)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(value)
    return value


def decode_columns(image: str, spec: TableSpec, nulls: str = "default") -> list[Column]:
    """Projection of every spec column out of the struct column ``image``."""
    return [
        decode_leaf(F.col(f"{image}.{name}"), spark_type(text), nulls).alias(name)
        for name, text in spec.columns
    ]


def encode_image(spec: TableSpec, only: list[str] | None = None) -> Column:
    """Row image struct as the change log carries it; the inverse of decode_columns."""
    fields = []
    for name, text in spec.columns:
        if only is not None and name not in only:
            continue
        kind, value = spark_type(text), F.col(name)
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.DateType):
            value = F.unix_date(value)
        fields.append(value.alias(name))
    return F.struct(*fields)

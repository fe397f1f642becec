"""Typed columns and by-name alignment of nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_typed_column(df: DataFrame, name: str, ddl: str) -> DataFrame:
    """Add `name` as an all-NULL column of type `ddl` unless the frame already has it."""
    if name.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(name, F.lit(None).cast(ddl))


def _differs(source: T.DataType, target: T.DataType) -> bool:
    return source.simpleString().lower() != target.simpleString().lower()


def by_name(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """`value` rebuilt as `target`, matching struct fields by name at every depth.

    A plain cast matches struct fields by position, which silently mixes up re-ordered fields.
    Fields missing from the source become NULL, extra ones are dropped.
    """
    if not _differs(source, target):
        return value
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        known = {f.name.lower(): f for f in source.fields}
        parts = []
        for field in target.fields:
            match = known.get(field.name.lower())
            part = (
                F.lit(None).cast(field.dataType)
                if match is None
                else by_name(value.getField(match.name), match.dataType, field.dataType)
            )
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(
            value, lambda item: by_name(item, source.elementType, target.elementType)
        )
    return value.cast(target)


def column_by_name(df: DataFrame, name: str, target: T.DataType) -> Column:
    """Column `name` of `df` aligned with `target`."""
    return by_name(F.col(name), df.schema[name].dataType, target)

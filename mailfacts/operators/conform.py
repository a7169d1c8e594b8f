"""Bringing a DataFrame to a result schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(
    df: DataFrame,
    schema: T.StructType,
    absent: Iterable[str] = (),
    constants: Mapping[str, Column] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Select ``schema``'s columns by name, in its order and types.

    ``absent`` lists the columns this source does not have; they become nulls of their type.
    Any other missing column is a mistake and fails during analysis. ``constants`` are the same
    in every row and replace a column of that name. ``distinct`` removes duplicates, comparing
    only columns that vary.
    """
    absent = list(absent)
    fixed = dict.fromkeys(absent, F.lit(None)) | dict(constants or {})
    unknown = set(fixed) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    present = [name for name in absent if name in df.columns]
    if present:
        raise ValueError(f"declared absent but present: {sorted(present)}")
    types = {field.name: field.dataType for field in df.schema}
    varying = df.select(
        *(
            f.name if types.get(f.name) == f.dataType else _typed(F.col(f.name), f)
            for f in schema
            if f.name not in fixed
        )
    )
    if distinct:
        varying = varying.distinct()
    if not fixed:
        return varying
    return varying.select(
        *(_typed(fixed[f.name], f) if f.name in fixed else f.name for f in schema)
    )


def _typed(column: Column, field: T.StructField) -> Column:
    return column.cast(field.dataType).alias(field.name)

"""Costly columns, computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as the output of a one-row generator.

    A filter on a projected column is pushed below the projection as a copy of its whole
    expression, so a JSON parse or a pattern match behind such a column would run again in
    every filter that uses it. Filters on generated columns stay above the generator and
    read the value.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)).alias(*columns))

"""Whole rows carried through an operator in one struct, so that no name of theirs can clash with its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """``row``, all columns of ``df`` in one struct, and the named columns made from them; ``select("row.*")`` unpacks."""
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in columns.items()])


def replaced(df: DataFrame, name: str, by: Column) -> list[Column]:
    """The columns of the struct ``row`` of ``df``, with that called ``name`` replaced."""
    fields = df.schema["row"].dataType.names
    return [by.alias(f) if f == name else F.col("row").getField(f).alias(f) for f in fields]

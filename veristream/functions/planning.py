"""Hints to the planner, made of ordinary DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever is asked of it later.

    A filter or join on a computed column is pushed below the projection with
    the whole expression in it, which is then computed twice or more.  Long
    chains of regular expressions are too dear for that; a generator of exactly
    one row is a step that such predicates do not cross.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def explode_rows(df: DataFrame, keep: list, items: Column, name: str) -> DataFrame:
    """``explode`` for a costly array.

    The plain form makes the planner test the array's size in a filter of its
    own, which computes the array again.
    """
    rows = df.select(*keep, F.explode_outer(items).alias(name))
    return rows.filter(F.col(name).isNotNull())

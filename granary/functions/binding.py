"""Naming a value inside a Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once even where body's lambdas use it for each element of an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a costly column that is evaluated once a row. A column of a plain projection is put in place of its name by
    every filter that is pushed below the projection, once for each mention; a generated one is not."""
    return df.select("*", F.explode(F.array(value)).alias(name))

"""Records that are delivered more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_delivery(df: DataFrame, key: str, text: Column, others: dict[str, Column], at: str = "loaded_at") -> DataFrame:
    """One row (key, text, others...) per non-null key: its earliest row whose text isn't "" or null, if there is any.

    Ties in `at` go to the smaller text, then the smaller other values; null times come last. Each other column is the
    earliest non-null one of the key's rows, so that a value missing from one delivery is taken from the next. Rows
    are combined before the shuffle, so a key with very many deliveries costs its partitions one row each."""
    order = F.struct(F.col(at).isNull().alias("late"), F.col(at).alias("at"))
    row = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), text.alias("_text"), order.alias("_order"), *[c.alias(f"_o_{n}") for n, c in others.items()])
    has_text = F.coalesce(F.col("_text") != "", F.lit(False))
    text_agg = F.min(F.struct((~has_text).alias("none"), F.col("_order").alias("o"), F.col("_text").alias("t"))).getField("t")
    firsts = [F.min(F.when(F.col(f"_o_{n}").isNotNull(), F.struct(F.col("_order").alias("o"), F.col(f"_o_{n}").alias("v")))).getField("v").alias(n) for n in others]
    return row.groupBy("_key").agg(text_agg.alias("text"), *firsts).withColumnRenamed("_key", key)

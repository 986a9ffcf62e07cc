"""Picking one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ROW = "_row_in_key"


def newest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep the newest row of each key; nulls count as oldest.

    ``row_number() = 1`` lets Spark cut every key to one row before the shuffle
    (partial WindowGroupLimit), so a key that holds a large share of the rows sends
    one row per input task. The remaining scalar columns break ties, which makes the
    choice independent of input order.
    """
    rest = [c for c, kind in df.dtypes if c not in (*keys, *newest_first) and "map" not in kind]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (*newest_first, *rest)]
    by_key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_ROW, F.row_number().over(by_key)).where(F.col(_ROW) == 1).drop(_ROW)

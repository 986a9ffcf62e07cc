"""Keyed merge of a batch into stored rows, as joins and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def arriving_keys(source: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """The batch's keys under names of their own, so that joins stay clear when both sides share a source."""
    if not keys:
        raise ValueError("a merge needs at least one key column")
    return source.select(*[F.col(f"`{k}`").alias(f"_{k}") for k in keys], *more)


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small else df


def on_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality with ``arriving_keys``; Spark still plans it as a hash join."""
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_{k}`")) for k in keys])


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_than: Sequence[str] = (), small: bool = False
) -> DataFrame:
    """``target`` after updating matched and inserting unmatched ``source`` rows.

    ``source`` must hold one row per key. The batch always wins unless ``newer_than`` names
    ordering columns: then a strictly newer stored row stays. Both sides meet in one exchange by the keys. ``small``
    says that the caller counted the batch and its keys fit a broadcast: then stored rows are not exchanged.
    """
    if not small and newer_than:
        return _merge_in_one_exchange(target, source, keys, newer_than)
    if newer_than:
        source = _without_beaten(target, source, keys, newer_than, small)
    kept = target.join(broadcast_if(small, arriving_keys(source, keys)), on_keys(keys), "left_anti")
    return kept.unionByName(source)


def _merge_in_one_exchange(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_than: Sequence[str]) -> DataFrame:
    """Stored and arriving rows side by side by key, so that nothing is exchanged or read twice; nulls count as oldest."""
    if not keys:
        raise ValueError("a merge needs at least one key column")
    both = target.withColumn("_arrives", F.lit(False)).unionByName(source.withColumn("_arrives", F.lit(True)))
    by_key, order = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]), F.struct(*[F.col(f"`{c}`") for c in newer_than])
    arriving = F.max(F.when(F.col("_arrives"), order)).over(by_key)
    stored = F.max(F.when(~F.col("_arrives"), order)).over(by_key)
    # The batch's row stays unless beaten; stored rows stay where the batch has none or is beaten.
    wins = arriving.isNotNull() & ~F.coalesce(stored > arriving, F.lit(False))
    return both.withColumn("_wins", wins).where(F.col("_wins") == F.col("_arrives")).drop("_arrives", "_wins")


def _without_beaten(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_than: Sequence[str], small: bool
) -> DataFrame:
    """The batch without rows whose stored counterpart is newer; nulls count as oldest."""
    stored = target.select(*keys, F.struct(*newer_than).alias("_stored"))
    arriving = arriving_keys(source, keys, F.struct(*newer_than).alias("_arriving"))
    newer = stored.join(broadcast_if(small, arriving), on_keys(keys)).where(F.col("_stored") > F.col("_arriving"))
    return source.join(newer.select(*arriving.columns[:-1]), on_keys(keys), "left_anti")


def not_beaten(arriving: str, stored: str, newer_than: Sequence[str]) -> Column:
    """True unless the stored row is strictly newer by the ordering columns; nulls count as oldest."""
    order = lambda side: F.struct(*[F.col(f"{side}.`{c}`").alias(c) for c in newer_than])
    return F.coalesce(order(arriving) >= order(stored), F.lit(True))


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand in several rows of a batch; a merge has no defined result for them."""
    return source.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")


def merge_into_table(
    source: DataFrame,
    table_name: str,
    keys: Sequence[str],
    delete_unmatched: bool = False,
    newer_than: Sequence[str] = (),
) -> None:
    """The same merge for a catalog table whose format takes row-level changes."""
    if not keys:
        raise ValueError("a merge needs at least one key column")
    condition = reduce(
        lambda a, b: a & b, [F.col(f"source.`{k}`").eqNullSafe(F.col(f"{table_name}.`{k}`")) for k in keys]
    )
    merge = source.alias("source").mergeInto(table_name, condition)
    matched = merge.whenMatched(not_beaten("source", table_name, newer_than)) if newer_than else merge.whenMatched()
    merge = matched.updateAll().whenNotMatched().insertAll()
    if delete_unmatched:
        merge = merge.whenNotMatchedBySource().delete()
    merge.merge()

"""Keyed upserts: replace rows whose key is known, insert the rest, keep what is not mentioned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, MergeIntoWriter
from pyspark.sql import functions as F


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise ``ValueError`` if keys occur more than once, with their number and some of them."""
    repeated = duplicates(df, key)
    some = repeated.limit(10).collect()
    if some:
        raise ValueError(f"{key} is not unique: {repeated.count()} repeated keys, "
                         f"among them {sorted(str(row[0]) for row in some)}")


def merge_rows(target: DataFrame, updates: DataFrame, key: str, keep: tuple[str, ...] = (),
               newer: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``target`` with the rows of ``updates`` replaced or added, and what happened to each row in ``change``.

    One full outer join gives the rows, the columns to ``keep`` and the figures of ``change_stats``, so both sides are made
    once. Rows are replaced whole, ``created_at`` included, unless a column is listed in ``keep``: those hold on to the
    target's value. Keys are unique on both sides, so the join has no hot key. ``change`` is ``kept`` for rows that
    ``updates`` does not mention, else ``inserted``, ``modified`` or ``same`` (before columns are kept).

    ``newer`` tells, from the old and the new row as structs without the key, whether the new one replaces the old one; a row
    that it leaves as it was is ``same``.
    """
    names = [name for name in target.columns if name != key]
    old = target.select(F.col(key).alias("_old_key"), F.struct(*names).alias("_old"))
    new = updates.select(F.col(key).alias("_new_key"), F.struct(*names).alias("_new"))
    in_old, in_new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    taken = in_new if newer is None else in_new & (~in_old | F.coalesce(newer(F.col("_old"), F.col("_new")), F.lit(False)))

    def value(name: str) -> Column:
        before, after = F.col("_old")[name], F.col("_new")[name]
        return F.when(taken, F.coalesce(before, after) if name in keep else after).otherwise(before).alias(name)

    change = (
        F.when(~in_new, "kept").when(~in_old, "inserted")
        .when(~taken | F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("modified")
    )
    return old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer").select(
        *[F.coalesce("_new_key", "_old_key").alias(key) if name == key else value(name) for name in target.columns],
        change.alias("change"),
    )


def upsert(target: DataFrame, updates: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``merge_rows``."""
    return merge_rows(target, updates, key, keep).drop("change")


def change_stats(merged: DataFrame) -> DataFrame:
    """Matched, modified and inserted rows of ``merge_rows``, and the size of the table after it."""
    change = F.col("change")
    return merged.agg(
        F.count_if(change.isin("same", "modified")).alias("matched"),
        F.count_if(change == "modified").alias("modified"),
        F.count_if(change == "inserted").alias("upserted"),
        F.count("*").alias("total"),
    )


def upsert_stats(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The figures of an upsert alone."""
    return change_stats(merge_rows(target, updates, key))


def merge_into(updates: DataFrame, table: str, key: str) -> None:
    """The same upsert in place, for a catalog table whose format supports row-level changes."""
    merge_writer(updates, table, key).merge()


def merge_writer(updates: DataFrame, table: str, key: str) -> MergeIntoWriter:
    """The merge before it runs: rows of ``updates`` replace those of ``table`` with the same key, others are added."""
    return (
        updates.alias("source").mergeInto(table, F.expr(f"{table}.{key} = source.{key}"))
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
    )

"""Upserting staged rows into a master table.

A row with a null in its key matches nothing, as in SQL: staged ones are inserted, and
master ones stay. Upserts are associative, ``(m + a) + b = m + (a + b)``, so several staged
tables are merged with each other first and the master is joined only once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ferry.functions.columns import column, comparable

UPDATE = "update"
IGNORE = "ignore"

_SPREAD = "__spread"


class DuplicateKeys(ValueError):
    """Staged rows share a key and nothing says which of them is the latest."""


def _whole(keys: Sequence[str]) -> Column:
    return reduce(and_, [column(k).isNotNull() for k in keys])


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two rows share a key. Only keys are read and only their counts are shuffled."""
    again = (
        df.where(_whole(keys))
        .groupBy(*[column(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .first()
    )
    if again is not None:
        raise DuplicateKeys(f"{again['__n']} staged rows share the key {again[:-1]}")


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_by``; ties go to the greater row.

    An aggregate rather than a window: every task reduces its rows of a key to one before
    the shuffle, so a key that holds much of the table arrives as one row per task.
    """
    ties = [f.name for f in df.schema.fields if f.name not in order_by and comparable(f.dataType)]
    rank = F.struct(*[column(c).alias(c) for c in [*order_by, *ties]])
    if len(order_by) + len(ties) == len(df.columns):
        last = F.max(rank)
    else:
        last = F.max_by(F.struct(*[column(c).alias(c) for c in df.columns]), rank)
    kept = (
        df.where(_whole(keys))
        .groupBy(*[column(k).alias(f"__k{i}") for i, k in enumerate(keys)])
        .agg(last.alias("__row"))
        .select("__row.*")
        .select(*[column(c) for c in df.columns])
    )
    return kept.unionByName(df.where(~_whole(keys)))


def _spread_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a join column that hashes the key, or the whole row where the key has a null.

    Rows with null keys match nothing, yet a join on the key alone would shuffle all of them
    to one task. The hash sends each of them elsewhere.
    """
    key = [column(k) for k in keys]
    row = [column(f.name) for f in df.schema.fields if comparable(f.dataType)]
    return df.withColumn(_SPREAD, F.when(_whole(keys), F.xxhash64(*key)).otherwise(F.xxhash64(*row)))


def _keys_of(df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    # Not a literal: Catalyst would fold it, and with it the hash, out of the join keys.
    key = [column(k) for k in keys]
    return df.where(_whole(keys)).select(*key, F.xxhash64(*key).alias(_SPREAD), *more)


def _without(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among those of ``keyed``, which ``_keys_of`` made."""
    left = _spread_nulls(df, keys).join(keyed, [*keys, _SPREAD], "left_anti")
    return left.select(*[column(c) for c in df.columns])


def _unmatched(staging: DataFrame, master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows that are new to the master.

    The master's keys are first reduced to those that are staged. When staging is small enough
    to broadcast, that costs one scan of the master's key columns and no shuffle of them.
    """
    staged = _keys_of(staging, keys)
    known = _keys_of(master, keys).join(staged, [*keys, _SPREAD], "left_semi")
    # Made distinct by key alone, which takes a shuffle: only then may adaptive execution split
    # the join above for a key that holds much of the master.
    once = known.select(*[column(k) for k in keys]).distinct()
    return _without(staging, _keys_of(once, keys), keys)


def upsert(
    master: DataFrame | None,
    staging: DataFrame,
    keys: Sequence[str],
    *,
    on_match: str = UPDATE,
    set_columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """The master after staged rows are merged into it, as a lazy DataFrame.

    ``on_match`` is ``update`` (staged rows replace master rows of the same key) or ``ignore``
    (master rows stay). ``set_columns`` limits an update to these columns. Staged rows with
    new keys are inserted either way. An absent master (``None``) is an empty one.

    Staged rows must have unique keys, which a job of its own checks at once, or ``order_by`` must
    say which of them is the latest. They take the types of the master's columns.
    """
    if on_match not in (UPDATE, IGNORE):
        raise ValueError(f"on_match must be {UPDATE} or {IGNORE}")
    if order_by:
        staging = latest(staging, keys, order_by)
    elif check_unique:
        require_unique(staging, keys)
    if master is None:
        return staging
    # Equal keys hash alike only if their types are equal, too.
    staging = staging.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in master.schema])
    if on_match == IGNORE:
        return master.unionByName(_unmatched(staging, master, keys))
    if set_columns is None:
        return _without(master, _keys_of(staging, keys), keys).unionByName(staging)
    return _set(master, staging, keys, set_columns).unionByName(
        _unmatched(staging, master, keys)
    )


def _set(
    master: DataFrame, staging: DataFrame, keys: Sequence[str], names: Sequence[str]
) -> DataFrame:
    unknown = [n for n in names if n not in master.columns]
    if unknown:
        raise ValueError(f"the master has no columns {unknown}")
    # The new values travel as one struct, which is null exactly where nothing matched.
    new = _keys_of(staging, keys, F.struct(*[column(n).alias(n) for n in names]).alias("__new"))
    joined = _spread_nulls(master, keys).join(new, [*keys, _SPREAD], "left")
    matched = F.col("__new").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col("__new")[c]).otherwise(column(c)).alias(c)
            if c in names
            else column(c)
            for c in master.columns
        ]
    )


def upsert_all(
    master: DataFrame | None, staged: Sequence[DataFrame], keys: Sequence[str], **options
) -> DataFrame:
    """Merge several staged tables, oldest first, joining the master only once.

    The tables are stacked and each key is reduced to one row by an aggregate that combines before
    the shuffle, so the plan grows by as much with every table.
    """
    types = staged[0].schema
    ready = [
        upsert(None, df.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in types]), keys, **options)
        for df in staged
    ]
    merged, unkeyed = (ready[0], None) if len(ready) == 1 else _stacked(ready, keys, options)
    result = upsert(master, merged, keys, **(options | {"check_unique": False, "order_by": None}))
    if unkeyed is None:
        return result
    # Added last, so that the join is not done for every staged table by itself.
    return result.unionByName(unkeyed.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in result.schema]))


def _stacked(
    staged: Sequence[DataFrame], keys: Sequence[str], options: dict
) -> tuple[DataFrame, DataFrame]:
    """One row per key of staged tables with unique keys, oldest first, and the rows with a null key."""
    names, set_columns = staged[0].columns, options.get("set_columns")
    row = F.struct(*[column(c).alias(c) for c in names]).alias("__row")
    stacked = reduce(DataFrame.unionByName, [df.withColumn("__at", F.lit(i)) for i, df in enumerate(staged)])
    first, last = F.min_by(row, "__at").alias("__first"), F.max_by(row, "__at").alias("__last")
    by_key = stacked.where(_whole(keys)).groupBy(*[column(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    ignore = options.get("on_match", UPDATE) == IGNORE

    def kept(name: str) -> Column:
        newer = not ignore and (set_columns is None or name in set_columns)
        return F.col("__last" if newer else "__first")[name].alias(name)

    one = by_key.agg(first, last).select(*[kept(c) for c in names])
    return one, stacked.where(~_whole(keys)).select(*[column(c) for c in names])

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import Entity


def newest_first(newest_by: str, tie_break: Sequence[str]) -> list[Column]:
    """Order of the versions of a record: the newest first, NULL as oldest, then by the tie-break columns."""
    return [F.col(newest_by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]


def version_order(entity: Entity) -> list[Column]:
    """The order in which `dedup_entity` prefers versions; a total order of different rows."""
    rest = [c for c in entity.columns if c not in (entity.key, entity.newest_by, *entity.tie_break)]
    return newest_first(entity.newest_by, [*entity.tie_break, *rest])


def newest_per_key(
    df: DataFrame, keys: Sequence[str], newest_by: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one with the newest `newest_by`; NULL counts as oldest.

    `tie_break` columns decide between equal versions, ascending. By default all
    remaining columns do, so the result does not depend on arrival order.

    Spark turns `rank = 1` into a group limit on both sides of the shuffle: every map
    task sends at most one row per key, so a key that holds a large part of all rows
    does not make a large task.

    The key's hash leads the window's partitioning because record ids share long prefixes:
    sorting compares the hash first and rarely has to look at the strings.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != newest_by]
    order = newest_first(newest_by, tie_break)
    rank = F.row_number().over(Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order))
    return df.withColumn("rank_in_key", rank).where("rank_in_key = 1").drop("rank_in_key")


def key_parts(df: DataFrame, keys: Sequence[str], parts: int) -> list[DataFrame]:
    """The rows in so many parts, all rows of a key in one of them; `df` is read once for each."""
    # A hash other than the one that rows are dealt to tasks by.
    return [df] if parts == 1 else [df.where(F.pmod(F.hash(*keys), F.lit(parts)) == n) for n in range(parts)]


def dedup_entity(df: DataFrame, entity: Entity) -> DataFrame:
    """Newest version of every record, with exactly the entity's columns."""
    df = df.select(*entity.columns)
    rest = [c for c in entity.columns if c not in (entity.key, entity.newest_by, *entity.tie_break)]
    return newest_per_key(df, [entity.key], entity.newest_by, [*entity.tie_break, *rest])

"""Sharding by sampled splitters.

Every record has a key that orders by text hash, then id: equal texts lie side by side, yet no text is one
indivisible key. Keys are drawn with a chance in proportion to their size; quantiles of the drawn keys cut
the key space into ranges of about equal size. The ranges are then measured over all records, ranges far
above their share are cut again at quantiles of keys drawn inside them, and exact running sizes place each record:
shard boundaries lie at exact byte shares, so a shard differs from the mean by less than the records on its
two edges, and shards, ranges and slots all follow the order of keys.

Only DataFrame functions. What reaches the driver are the drawn keys and the sizes of ranges: at most
`most_ranges` ranges, or what the shards need, and `drawn_per_range` keys for each, however many records there are.

Cases: a null text has size 1 and the checksum of an empty text; repeated rows (same id and text) are
placed one by one; null ids are allowed; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from clientlens.llm.common import staged

SPAN = float(2**63)


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def _chance(value: Column, seed: str) -> Column:
    """A number from 0 to 1, fixed by the value."""
    return F.abs(F.xxhash64(value, F.lit(seed)).cast("double")) / SPAN


def _quantiles(keys: list[str], parts: int) -> list[str]:
    """Different keys that cut a sorted list into `parts` parts of about equal length."""
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _below(key: Column, splitters: list[str]) -> Column:
    """How many of the sorted splitters are at or below the key, found in two steps of about the square root."""
    step = isqrt(len(splitters)) + 1
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    coarse = F.size(F.filter(F.lit([b[0] for b in blocks]), lambda x: x <= key))
    fine = F.array(*[F.lit(b) for b in blocks])
    within = F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda x: x <= key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + within)


def shard_records(
    records: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 8,
    ranges_per_shard: int = 128,
    rows_per_range: int = 1_000_000,
    drawn_per_range: int = 16,
    overfull: float = 3.0,
    most_ranges: int = 8192,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every record; shards have nearly equal sizes.

    slot counts from 0 in each shard, in key order. There are shards x ranges_per_shard ranges, or more, up to
    `most_ranges`, where the records are so many that a range would hold over rows_per_range of them. Ranges
    are sorted by a task each; records beyond memory are sorted on disk.
    """
    keys = records.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text_col).alias("h"),
        F.monotonically_increasing_id().alias("uid"),
    ).select(
        "id", "size", "text_crc32", "uid",
        F.concat(_hex(F.col("h")), _hex(F.xxhash64("id")), _hex(F.xxhash64("uid"))).alias("key"),
    )
    keys = staged(keys, "shard-keys")
    total, count = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()

    ranges = max(shards * ranges_per_shard, min(ceil(count / rows_per_range), most_ranges))
    share = max(total / ranges, 1.0)
    chance = _chance(F.col("key"), "draw")
    drawn = keys.where(chance * share < F.col("size") * drawn_per_range).select("key")
    splitters = _quantiles(sorted(r[0] for r in drawn.collect()), ranges) or [""]

    # Ranges above their share are cut again, at keys drawn inside them. Together they hold no more than all
    # records do, so there are at most as many cuts as ranges, and ranges by rows likewise.
    most = count / ranges
    sizes = keys.groupBy(_below(F.col("key"), splitters).alias("range")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    cuts = F.ceil(F.greatest(F.col("bytes") / F.lit(share), F.col("n") / F.lit(most or 1)))
    full = sizes.where((F.col("bytes") > overfull * share) | (F.col("n") > overfull * most)).select("range", "bytes", "n", cuts.alias("cuts"))
    full = {r["range"]: r for r in full.collect()}
    if full:
        inside = keys.withColumn("range", _below(F.col("key"), splitters)).where(F.col("range").isin(list(full)))
        of = lambda field: F.element_at(F.create_map(*[F.lit(x) for k, r in full.items() for x in (k, r[field])]), F.col("range"))
        # By bytes or by rows, whichever there is more of.
        weight = F.greatest(F.col("size") / of("bytes"), 1 / of("n"))
        drawn = inside.where(_chance(F.col("key"), "cut") < weight * of("cuts") * drawn_per_range).select("range", "key")
        of_range: dict[int, list[str]] = {}
        for name, key in sorted(tuple(r) for r in drawn.collect()):
            of_range.setdefault(name, []).append(key)
        for name, found in of_range.items():
            splitters += _quantiles(found, full[name]["cuts"])
        splitters = sorted(set(splitters))
    keys = staged(keys.withColumn("range", _below(F.col("key"), splitters)), "shard-ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range").orderBy("key")
    placed = keys.join(offsets, "range").select(
        "id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(inside) - F.col("size")).alias("at"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("rank"),
    )
    middle = (2 * F.col("at") + F.col("size")) * shards
    placed = placed.withColumn("shard", F.floor(middle / F.lit(2 * max(total, 1))).cast("int"))
    placed = staged(placed.withColumn("shard", F.least("shard", F.lit(shards - 1))), "shard-placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(first, "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )

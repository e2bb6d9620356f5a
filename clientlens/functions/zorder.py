"""One order for several columns: interleaved bits of their ranks, so that near places are near in each of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Values looked at for each column and splitter.
DRAWN = 16


def splitters(df: DataFrame, column: str, bits: int) -> list:
    """Up to 2^bits - 1 values that cut the different values of a column evenly; the smallest cuts nothing.

    From a bounded number of values with the smallest hashes, so how often a value occurs does not count.
    """
    most = 1 << bits
    drawn = df.select(F.col(column).alias("v")).dropna().distinct().orderBy(F.xxhash64("v")).limit(most * DRAWN).collect()
    values = sorted(r.v for r in drawn)
    parts = min(most, len(values))
    return sorted({values[len(values) * i // parts] for i in range(1, parts)})


def rank(column: str, cuts: list, bits: int) -> Column:
    """How many of the splitters a value reaches, a null value none, spread over the numbers of `bits` bits."""
    reached = sum([(F.col(column) >= F.lit(c)).cast("long") for c in cuts], F.lit(0).cast("long"))
    return F.coalesce(F.floor(reached * (1 << bits) / (len(cuts) + 1)), F.lit(0).cast("long"))


def place(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """The place of a row in the common order of `columns`."""
    ranks = [rank(c, splitters(df, c, bits), bits) for c in columns]
    found = F.lit(0).cast("long")
    for bit in range(bits):
        for n, r in enumerate(ranks):
            taken = F.shiftright(r, bit).bitwiseAND(F.lit(1))
            found = found.bitwiseOR(F.shiftleft(taken, bit * len(ranks) + len(ranks) - 1 - n))
    return found

"""Helpers that several operators share: staged tables, Arrow batches, bounded caches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.workspace import scratch_path

# Rows and bytes of a bin of blocks, on average.
BIN_ROWS, BIN_BYTES = 4096, 32_000_000


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written to the shared folder and read again.

    Cuts lineage with files that outlive any executor, and fixes values (row ids, sampled bounds) that a
    second evaluation could give anew.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    rows.staged_path = path
    return rows


def release(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing will read any more."""
    place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_bound(most: int, have: int) -> int:
    """Hashes of 63 bits up to this are about `most` of `have`, however many there are."""
    return min((most << 63) // max(have, 1), (1 << 63) - 1)


def drawn(rows: DataFrame, column: str, most: int) -> DataFrame:
    """Distinct rows with about `most` different values of a column at the most, chosen by their hash.

    Values are counted, not rows, so copies of one value take one place and cannot crowd out the others. None
    of a table with values is an error, not an empty sample.
    """
    have = rows.agg(F.approx_count_distinct(column)).first()[0]
    if not have:
        return rows.limit(0)
    mark = F.shiftrightunsigned(F.xxhash64(column, F.lit("drawn")), 1)
    chosen = staged(rows.where(mark <= F.lit(hash_bound(most, have))).distinct(), "drawn")
    if not chosen.limit(1).count():
        raise ValueError(f"no row was drawn from about {have} values of {column}")
    return chosen


def binned(df: DataFrame, keys: list[str], rows: int, bytes_each: float) -> DataFrame:
    """A bin for each block, by its keys: many small blocks share a call of the function.

    There are as many bins as the rows need, so what a task holds at a time does not grow with them. A block's
    rows are bounded by the size of its chunks.
    """
    bins = max(1, -(-rows // BIN_ROWS), int(rows * bytes_each / BIN_BYTES))
    return df.withColumn("bin", F.pmod(F.xxhash64(*keys), F.lit(bins)))


_kept: dict = {}


def kept(key: object, make: Callable):
    """What `make` gives, kept in this Python worker from task to task until another operator keeps something.

    A worker that serves several operators in turn so holds the memory of one of them at a time.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Memo(dict):
    """Values of a function by its argument, a text; forgotten all at once when more than `most` are held or their
    arguments have over `letters` letters. Values of arguments of over `long` letters are not held."""

    def __init__(self, make: Callable, most: int, letters: int = 16_000_000, long: int = 200) -> None:
        super().__init__()
        self.make, self.most, self.letters, self.long, self.held = make, most, letters, long, 0

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.long:
            if len(self) >= self.most or self.held >= self.letters:
                self.clear()
                self.held = 0
            self[key] = value
            self.held += len(key)
        return value


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of each hold about `most` bytes at the most (one text may be longer)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)

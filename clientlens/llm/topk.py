"""Exact top-k search by inner product, by distributed selection on score histograms.

Vectors become whole numbers, floor(scale * x), so scores are exact and do not depend on the order of additions.
Every query is scored against every other row, in cells of a chunk of candidates and a block of queries. The
first pass cuts the possible scores of a query into bins; the counts of all cells are added, and the bin that
holds the k-th best score becomes the next interval. This repeats until a query has at most `enough` rows at or
above its bin or the bin is one score. A last pass keeps the rows at or above that edge, and orders them by score,
then id. A cell reports only what its own k best rows reach, above which no global k-th score can lie below:
counts from the top until k rows, and k rows in the last pass. So a score that a third of all rows share
costs k rows a cell.

Cases: vectors that are null or hold null or non-finite components take no part, nor do those with a norm of
2^30 or more after scaling, so that a score fits 64 bits; vectors of different lengths do not meet; a repeated
row is a row of its own: it is a query and a candidate of the others; rows with a null id are candidates, after
all ids where scores tie; a query without candidates has no rows; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clientlens.llm.common import staged

# Norms below this keep every score, and every sum on the way, within 64 bits.
NORM = 2.0**30
# Components that a cell holds of either side, and scores that it makes at a time.
COMPONENTS, SCORES = 1 << 22, 1 << 21


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float, is_query: Column) -> DataFrame:
    """(row, id, ints, size, norm, is_query) of the rows that take part; `row` tells repeated rows apart."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    scaled = lambda x: F.floor(x.cast("double") * scale).cast("double")
    square = lambda total, x: total + scaled(x) * scaled(x)
    v = F.col(vector_col)
    rows = vectors.where(v.isNotNull() & F.forall(v, finite)).select(
        F.col(id_col).alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("ints"),
        F.size(v).alias("size"),
        F.sqrt(F.aggregate(v, F.lit(0.0), square)).alias("norm"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    return rows.where(F.col("norm") < NORM).withColumn("row", F.monotonically_increasing_id())


def _matrix(table: pa.Table) -> np.ndarray:
    ints = table.column("ints").combine_chunks()
    return ints.flatten().to_numpy(zero_copy_only=False).reshape(len(ints), -1)


def scores(candidates: np.ndarray, queries: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Inner products of some queries at a time with all candidates, as 64-bit numbers.

    By Cauchy's inequality no partial sum exceeds the product of the norms, so floating point is exact while
    that product has few enough bits; beyond that, whole numbers are multiplied.
    """
    norm = lambda m: float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
    most = norm(candidates) * norm(queries)
    kind = np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64
    right = np.ascontiguousarray(candidates.astype(kind).T)
    step = max(1, SCORES // max(len(candidates), 1))
    for i in range(0, len(queries), step):
        part = slice(i, i + step)
        yield part, (queries[part].astype(kind) @ right).astype(np.int64)


def _cells(rows: DataFrame, wanted: DataFrame, counts: tuple[int, int], per_side: int) -> tuple[DataFrame, DataFrame]:
    """Candidates and queries, each repeated for every cell that it belongs to."""
    chunks, blocks = (max(1, -(-n // per_side)) for n in counts)
    spread = lambda salt, n: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("row", "id", "ints", "size", spread("chunk", chunks).alias("chunk"), every(blocks).alias("block"))
    right = wanted.withColumn("block", spread("block", blocks)).withColumn("chunk", every(chunks))
    # New names for the columns: both sides come from one table, and grouping them together needs to tell them apart.
    return left, right.toDF(*right.columns)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: float = 256.0,
    bins: int = 512,
    enough: int = 64,
) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates of each row that `is_query` holds for."""
    rows = staged(whole_vectors(vectors, id_col, vector_col, scale, is_query), "whole-vectors")
    count, asked, norm, size = rows.agg(
        F.count("*"), F.count_if("is_query"), F.coalesce(F.max("norm"), F.lit(0.0)), F.coalesce(F.max("size"), F.lit(0))
    ).first()
    per_side = max(16, min(8192, COMPONENTS // max(size, 1)))
    keys = ["size", "chunk", "block"]
    queries = rows.where("is_query").select("row", "ints", "size", "norm")

    reach = F.ceil(F.col("norm") * norm * (1 + 1e-9)) + 1
    open_ = staged(
        queries.select("row", (-reach).alias("low"), (reach + 1).alias("high"), F.lit(0).cast("long").alias("above")), "bounds"
    )
    edges = open_.select("row", F.col("low").alias("edge")).limit(0)
    left_open = asked

    def count_bins(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros((3, 0), dtype=np.int64)]
        if left.num_rows and right.num_rows:
            column = dict(zip(left.column("row").to_pylist(), range(left.num_rows)))
            names = right.column("row").to_numpy()
            low, high = right.column("low").to_numpy()[:, None], right.column("high").to_numpy()[:, None]
            for part, s in scores(_matrix(left), _matrix(right)):
                inside = (s >= low[part]) & (s < high[part])
                for q, row in enumerate(names[part].tolist()):
                    if row in column:
                        inside[q, column[row]] = False
                place = (s - low[part]) // ((high[part] - low[part] - 1) // bins + 1)
                place += np.arange(len(s))[:, None] * bins
                n = np.bincount(place[inside], minlength=len(s) * bins).reshape(len(s), bins)
                better = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n
                q, at = np.nonzero((n > 0) & (better < k))
                found.append(np.stack([names[part][q], at, n[q, at]]))
        columns = np.concatenate(found, axis=1)
        return pa.table([pa.array(c) for c in columns], names=["row", "bin", "n"])

    while left_open:
        left, right = _cells(rows, queries.drop("norm").join(open_, "row"), (count, left_open), per_side)
        counted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(count_bins, "row long, bin long, n long")
        counted = counted.groupBy("row", "bin").agg(F.sum("n").alias("n"))
        better = Window.partitionBy("row").orderBy(F.col("bin").desc())
        kth = counted.join(open_, "row").withColumn("reached", F.col("above") + F.sum("n").over(better)).where(F.col("reached") >= k)
        kth = kth.groupBy("row").agg(*(F.max_by(c, "bin").alias(c) for c in ("reached", "n")), F.max("bin").alias("bin"))
        width = F.expr(f"(high - low - 1) div {bins} + 1")
        # Fewer than k candidates: all of them are answers.
        step = open_.join(kth, "row", "left").select(
            "row",
            F.coalesce(F.col("low") + F.col("bin") * width, "low").alias("edge"),
            F.least(F.col("low") + (F.col("bin") + 1) * width, "high").alias("high"),
            (F.col("reached") - F.col("n")).alias("above"),
            F.coalesce((width == 1) | (F.col("reached") <= enough), F.lit(True)).alias("done"),
        )
        step = staged(step, "bounds")
        edges = edges.union(step.where("done").select("row", "edge"))
        open_ = step.where("not done").select("row", F.col("edge").alias("low"), "high", "above")
        left_open = open_.count()

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros((3, 0), dtype=np.int64)]
        if left.num_rows and right.num_rows:
            left = left.sort_by([("id", "ascending"), ("row", "ascending")])
            column = dict(zip(left.column("row").to_pylist(), range(left.num_rows)))
            others, names, edge = left.column("row").to_numpy(), right.column("row").to_numpy(), right.column("edge").to_numpy()
            for part, s in scores(_matrix(left), _matrix(right)):
                for q, row in enumerate(names[part].tolist()):
                    at = np.flatnonzero(s[q] >= edge[part][q])
                    at = at[at != column.get(row, -1)]
                    # Candidates stand in the order of their ids, which a stable sort keeps among equal scores.
                    at = at[np.argsort(-s[q, at], kind="stable")[:k]]
                    found.append(np.stack([np.full(len(at), row), others[at], s[q, at]]))
        return pa.table([pa.array(c) for c in np.concatenate(found, axis=1)], names=["row", "other", "score"])

    left, right = _cells(rows, queries.drop("norm").join(edges, "row"), (count, asked), per_side)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "row long, other long, score long")
    names = rows.select("row", "id")
    found = found.join(names.withColumnsRenamed({"row": "other", "id": "other_id"}), "other")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last(), "other"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k).join(names, "row")
    return found.select(F.col("id").alias("query_id"), "rank", F.col("other_id").alias(id_col), "score")

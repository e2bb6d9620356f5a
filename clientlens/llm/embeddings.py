"""Near-duplicate vectors by collision-counting projections.

Vectors are projected on many random directions. Two vectors collide in a projection if one lies in the window
of half-width w around the other; a pair that collides in at least `least` of them is verified by its cosine.
Window and count are calibrated from the wanted recall: for a pair exactly at the threshold the projected
difference is normal with a known deviation, so its collisions are binomial.

To meet without comparing all pairs, vectors are grouped by label and by the cell that several further
projections, cut into steps, give in each of a few tables. Within a cell values are sorted in each projection
and each vector's window is looked up in the sorted order. A pair is counted in the first table that it shares. Cells with
many vectors are cut into chunks that meet pairwise in tasks of their own. Equal vectors are one vector with
a number of copies. Links are counted and joined inside the tasks, so no row is made for a pair.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, and so do
rows whose label is null; vectors of different lengths do not link; a repeated id is a vector of its own for
links and its component is that of the smallest id; a row with a null id links like any other, and is kept if
nothing that it reaches has an id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clientlens.llm.common import binned, staged
from clientlens.llm.graph import connected_components

SEED = 20240817


def calibrate(threshold: float, projections: int, recall: float, spread: float = 2.0) -> tuple[float, int]:
    """Half-width of the window and least number of collisions, so that a pair at the threshold passes with
    probability `recall`. Directions are normal, so the difference of such a pair is normal, too."""
    deviation = sqrt(max(2 - 2 * threshold, 1e-12))
    chance = erf(spread / sqrt(2))
    for least in range(projections, 0, -1):
        passed = sum(comb(projections, i) * chance**i * (1 - chance) ** (projections - i) for i in range(least, projections + 1))
        if passed >= recall:
            return spread * deviation, least
    return spread * deviation, 1


def _directions(size: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([SEED, seed, size]).standard_normal((size, count))


def collisions(left: np.ndarray, right: np.ndarray, window: float) -> np.ndarray:
    """Number of projections in which each pair collides, by windows in the sorted order."""
    counts = np.zeros((len(left), len(right)), dtype=np.uint8)
    rows = np.arange(len(left))
    for j in range(left.shape[1]):
        order = np.argsort(right[:, j], kind="stable")
        ranked = right[order, j]
        # A window is a run of the sorted values: +1 where it begins, -1 behind its end, summed along the row.
        steps = np.zeros((len(left), len(right) + 1), dtype=np.int8)
        steps[rows, np.searchsorted(ranked, left[:, j] - window, "left")] += 1
        steps[rows, np.searchsorted(ranked, left[:, j] + window, "right")] -= 1
        counts[:, order] += np.cumsum(steps[:, :-1], axis=1, dtype=np.int8).view(np.uint8)
    return counts


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    projections: int = 32,
    recall: float = 0.9999,
    tables: int = 14,
    cell_projections: int = 7,
    cell_steps: float = 7.0,
    chunk: int = 512,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector; the id is a whole number.

    A cell is `cell_steps` deviations of a pair at the threshold wide. Such a pair shares a cell in one projection
    with probability 1 - 0.8 / cell_steps, so 14 tables of 7 projections of 7 steps miss it with about 4e-4 and
    closer pairs less often.
    """
    deviation = sqrt(max(2 - 2 * threshold, 1e-12))
    window, least = calibrate(threshold, projections, recall)

    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(kind).alias("v")
    )
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    good = "label is not null and v is not null"
    valid = rows.where(good).where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    distinct = valid.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    # Numbers instead of hashes: no two vectors share one.
    distinct = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector with its cells in all tables."""
        for batch in batches:
            found = []
            for v in batch.column("v").to_pylist():
                x = np.array(v, dtype=np.float64)
                x = x / np.abs(x).max()  # keeps the squares of very large and very small components finite
                x = x / np.linalg.norm(x)
                marks = x @ _memo(len(x), tables * cell_projections, 1) / (deviation * cell_steps)
                marks = np.floor(marks + _memo(1, tables * cell_projections, 2)[0]).astype(np.int64)
                found.append([hash((t, len(x), *row)) for t, row in enumerate(marks.reshape(tables, -1).tolist())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "v", "copies", "label")), pa.array(found, pa.list_(pa.int64()))],
                ["node", "v", "copies", "label", "cells"],
            )

    known: dict[tuple[int, int, int], np.ndarray] = {}

    def _memo(size: int, count: int, seed: int) -> np.ndarray:
        if (size, count, seed) not in known:
            known.clear() if len(known) > 16 else None
            known[size, count, seed] = _directions(size, count, seed)
        return known[size, count, seed]

    label = distinct.schema["label"].dataType.simpleString()
    marked = distinct.select("node", "v", "copies", "label").mapInArrow(
        cells, f"node long, v {kind}, copies long, label {label}, cells array<long>"
    )
    marked = staged(marked, "vector-cells")
    # Cells with one vector go before the vectors travel; large ones are cut into chunks that meet pairwise.
    members = marked.select("node", "label", F.posexplode("cells").alias("t", "cell"))
    sizes = staged(members.groupBy("label", "t", "cell").agg(F.count("*").alias("n")).where("n > 1"), "cell-sizes")
    chunks = F.ceil(F.col("n") / chunk)
    spots = members.join(sizes, ["label", "t", "cell"]).select("node", "t", "cell", chunks.cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("node", "t"), F.col("chunks")).cast("int")
    meets = F.sequence(F.lit(0), F.col("chunks") - 1)
    spots = spots.withColumn("mine", mine).withColumn("other", F.explode(meets)).select(
        "node", "t", "cell", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).alias("second"),
    )
    placed = sizes.agg(F.sum(F.col("n") * chunks)).first()[0] or 0
    wide = marked.agg(F.avg(F.size("v"))).first()[0] or 0
    keys = ["label", "t", "cell", "low", "high"]
    work = binned(spots.join(marked, "node"), keys, placed, 8 * (wide + projections + tables))

    def compare(table: pa.Table) -> pa.Table:
        nodes, t = table.column("node").to_numpy(), table.column("t").to_numpy()
        second = table.column("second").to_numpy(zero_copy_only=False)
        copies, marks = table.column("copies").to_numpy(), np.array(table.column("cells").to_pylist())
        values = table.column("v").combine_chunks()
        flat, cut = values.values.to_numpy(), values.offsets.to_numpy()
        label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        keys = [label, t, *(table.column(c).to_numpy() for c in ("cell", "low", "high"))]
        order = np.lexsort(keys[::-1])
        starts = np.flatnonzero(np.r_[True, np.any([np.diff(k[order]) != 0 for k in keys], axis=0)])
        links: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for group in np.split(order, starts[1:]):
            if len(group) < 2:
                continue
            x = np.stack([flat[cut[i] : cut[i + 1]] for i in group]).astype(np.float64)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            same = keys[3][group[0]] == keys[4][group[0]]
            left = np.arange(len(group)) if same else np.flatnonzero(~second[group])
            right = left if same else np.flatnonzero(second[group])
            values_of = x @ _memo(x.shape[1], projections, 3)
            hits = collisions(values_of[left], values_of[right], window) >= least
            earlier = np.zeros(hits.shape, dtype=bool)
            for table_no in range(t[group[0]]):
                earlier |= marks[group[left], table_no][:, None] == marks[group[right], table_no][None, :]
            hits &= ~earlier
            if same:
                hits &= np.tri(len(left), dtype=bool).T & ~np.eye(len(left), dtype=bool)
            a, b = np.nonzero(hits)
            a, b = left[a], right[b]
            linked = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
            a, b = group[a[linked]], group[b[linked]]
            for i, n in zip([*a, *b], [*copies[b], *copies[a]]):
                links[int(nodes[i])] = links.get(int(nodes[i]), 0) + int(n)
            edges += spanning(nodes[a], nodes[b])
        found = [(i, n, None) for i, n in links.items()] + [(a, 0, b) for a, b in edges]
        columns = list(zip(*found)) if found else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["node", "n", "to"])

    found = staged(work.groupBy("bin").applyInArrow(compare, "node long, n long, to long"), "vector-links")
    names = connected_components(found.where("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    named = staged(names.join(distinct.select("node", "id"), "node"), "vector-names")
    classes = named.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = named.join(classes, "component").select("node", "component_id")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    answers = (
        distinct.join(counts, "node", "left")
        .join(classes, "node", "left")
        .select(
            F.col("label").alias("rep_label"), F.col("v").alias("rep_v"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    joined = rows.join(answers, (F.col("label") == F.col("rep_label")) & (F.col("v") == F.col("rep_v")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the same nodes as the pairs (a, b), at most one for each node."""
    name: dict[int, int] = {}

    def root(i: int) -> int:
        while name.setdefault(i, i) != i:
            name[i] = name[name[i]]
            i = name[i]
        return i

    for i, j in zip(a.tolist(), b.tolist()):
        i, j = root(i), root(j)
        if i != j:
            name[max(i, j)] = min(i, j)
    return [(i, root(i)) for i in name if root(i) != i]

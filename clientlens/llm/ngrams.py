"""Similarity join of documents by the Jaccard index of their word n-grams, with Bayesian candidate pruning.

A document's set holds a hash of every run of five words (runs of letters and digits, lower-cased); a shorter text
is one run. Each set has MinHash values; documents that agree in all values of a band are candidates. The values
of a candidate pair are compared a few at a time: with a uniform prior, m matches in n values give the
posterior probability that the index reaches the threshold, and a pair falls out once that is below the
tolerance. What is left is verified exactly on the sets.

Documents with the same set are one set with a number of copies. Pairs are compared and counted inside tasks: a band's
bucket, and later a group of surviving candidates, is cut into chunks that meet pairwise in tasks of their
own. A row is made for a document or for a link of a spanning forest, never for every pair.

Cases: a null text is an empty one; texts without words link with nothing, one another included; so do rows
with a null id; rows with the same id are documents of their own whose class is that of the id; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from clientlens.llm.common import Memo, binned, slices, staged
from clientlens.llm.embeddings import spanning
from clientlens.llm.graph import connected_components

WORDS = re.compile(r"[^\W_]+")
# Odd multipliers of the hashes of runs (fixed values, any others would do).
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def word_hasher(most: int = 400_000) -> Callable[[str], np.ndarray]:
    """Text -> 64-bit hashes of its words, in order."""
    chunks = Memo(lambda c: b"".join([xxhash.xxh64_digest(w)[::-1] for w in WORDS.findall(c.lower())]), most)
    return lambda text: np.frombuffer(b"".join(map(chunks.__getitem__, text.split())), dtype="<u8")


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; of the whole if it is shorter; none of no words."""
    count = len(words) - width + 1
    if not len(words):
        return words
    runs = np.zeros(max(count, 1), dtype=np.uint64)
    for i in range(min(width, len(words))):
        runs = runs * STEP + words[i : i + len(runs)]
    runs += np.uint64(min(width, len(words)))
    for shift, factor in zip((30, 27), MIX):
        runs = (runs ^ (runs >> np.uint64(shift))) * factor
    return np.unique(runs ^ (runs >> np.uint64(31)))


class MinHash:
    """MinHash values of sets of 64-bit hashes."""

    def __init__(self, size: int, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        self.factor = random.integers(1, 2**32, size, dtype=np.uint32)[:, None] | np.uint32(1)
        self.shift = random.integers(0, 2**32, size, dtype=np.uint32)[:, None]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        words = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        best = np.full(len(self.factor), 2**32 - 1, dtype=np.uint32)
        for i in range(0, len(words), 2048):
            values = words[None, i : i + 2048] * self.factor
            values += self.shift
            np.minimum(best, values.min(axis=1), out=best)
        return best


def least_matches(threshold: float, values: int, step: int, tolerance: float) -> list[tuple[int, int]]:
    """(n, m): after n values, fewer than m matches make it less than `tolerance` likely that the index reaches
    the threshold. The posterior after m of n under a uniform prior is Beta(m + 1, n - m + 1)."""
    found = []
    for n in range(step, values + 1, step):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        found.append((n, m))
    return found


def prune(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, limits: list) -> tuple:
    """The pairs (a, b) of rows that are not ruled out by their MinHash values."""
    matches = np.zeros(len(a), dtype=np.int64)
    begun = 0
    for n, least in limits:
        matches += (left[a, begun:n] == right[b, begun:n]).sum(axis=1)
        keep = matches >= least
        a, b, matches, begun = a[keep], b[keep], matches[keep], n
    return a, b


def pairs_in_block(first: np.ndarray, second: np.ndarray, bands: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that agree in all values of at least one band."""
    hits = np.zeros((len(first), len(second)), dtype=bool)
    x, y = first.reshape(len(first), bands, -1), second.reshape(len(second), bands, -1)
    for band in range(bands):
        equal = x[:, None, band, 0] == y[None, :, band, 0]
        for value in range(1, x.shape[2]):
            equal &= x[:, None, band, value] == y[None, :, band, value]
        hits |= equal
    if same:
        hits &= np.tri(len(first), k=-1, dtype=bool).T
    return np.nonzero(hits)


def common_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, wide: int = 16_384) -> np.ndarray:
    """Size of the intersection of each pair of sets: one by one where pairs are few, else by products of the
    sets' membership matrix, a bounded number of columns at a time."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], dtype=np.int64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows, column = rows[times[column] > 1], column[times[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for begun in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        at = slice(*np.searchsorted(column, [begun, begun + wide]))
        member = np.zeros((len(sets), wide), dtype=np.float32)
        member[rows[at], column[at] - begun] = 1
        total += member @ member.T
    return total[a, b].astype(np.int64)


def _blocks(members: DataFrame, group: str, sizes: DataFrame, chunk: int) -> DataFrame:
    """Members (node, group) of groups of known size, dealt to blocks: one for each pair of chunks of a group."""
    spots = members.join(sizes, group).select("node", F.col(group).alias("of"), F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    spots = spots.withColumn("mine", F.pmod(F.xxhash64("node", "of"), F.col("chunks")).cast("int"))
    spots = spots.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return spots.select(
        "node", "of", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).alias("second"),
    )


def _each_block(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows of the two sides of each block of a bin; of one that is a chunk with itself, the same rows twice."""
    keys = [table.column(c).to_numpy() for c in ("of", "low", "high")]
    second = table.column("second").to_numpy(zero_copy_only=False)
    order = np.lexsort(keys[::-1])
    begins = np.any([np.diff(k[order]) != 0 for k in keys], axis=0)
    for group in np.split(order, np.flatnonzero(begins) + 1):
        if not len(group):
            continue
        if keys[1][group[0]] == keys[2][group[0]]:
            yield group, group, True
        else:
            yield group[~second[group]], group[second[group]], False


def _signatures(table: pa.Table) -> np.ndarray:
    joined = b"".join(table.column("sig").to_pylist())
    return np.frombuffer(joined, dtype="<u4").reshape(table.num_rows, -1)


def similar_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    bands: int = 20,
    band_rows: int = 4,
    tolerance: float = 1e-6,
    chunk: int = 256,
    broadcast_ids: int = 1_000_000,
) -> DataFrame:
    """(id, n_links, class_id) of every document; the id is a whole number.

    n_links counts the other documents whose index with this one reaches the threshold; class_id is the smallest
    id reachable over such links. With 20 bands of 4 values a pair of index 0.8 is missed with
    probability (1 - 0.8^4)^20 = 3e-5, one of 0.9 with 2e-9. Up to `broadcast_ids` ids of surviving
    candidates (8 bytes each) are sent to the scan that fetches their texts; more are joined by shuffle.
    """
    values = bands * band_rows
    limits = least_matches(threshold, values, 16, tolerance)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, minhash = word_hasher(), MinHash(values)
        for batch in slices(batches, "text"):
            marks, signatures = [], []
            for text in batch.column("text").to_pylist():
                hashes = shingles(words(text or ""), width)
                marks.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                signatures.append(minhash(hashes).astype("<u4").tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(marks, pa.binary()), pa.array(signatures, pa.binary())], ["id", "mark", "sig"]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = staged(texts.mapInArrow(describe, "id long, mark binary, sig binary"), "ngram-signatures")
    usable = described.where("id is not null and mark is not null")
    sets = usable.groupBy("mark").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
    # Numbers instead of hashes: no two sets share one.
    sets = staged(sets.withColumn("node", F.monotonically_increasing_id()), "ngram-sets")

    # Buckets of bands: pairs that survive the comparison of values, as links of a spanning forest.
    width_of = 4 * band_rows
    bucket = F.array(*[F.xxhash64(F.lit(t), F.substring("sig", 1 + t * width_of, width_of)) for t in range(bands)])
    members = sets.select("node", F.explode(bucket).alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    spots = _blocks(members, "bucket", crowded, 2 * chunk)

    def survive(table: pa.Table) -> pa.Table:
        nodes, signatures = table.column("node").to_numpy(), _signatures(table)
        found: list[tuple[int, int]] = []
        for left, right, same in _each_block(table):
            first, second = signatures[left], signatures[right]
            a, b = np.nonzero(np.tri(len(left), k=-1, dtype=bool).T) if same else np.nonzero(np.ones((len(left), len(right)), bool))
            a, b = prune(a, b, first, second, limits)
            found += spanning(nodes[left[a]], nodes[right[b]])
        a, b = zip(*set(found)) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keys = ["of", "low", "high"]
    chunks = F.ceil(F.col("n") / (2 * chunk))
    rows = crowded.agg(F.sum(F.col("n") * chunks)).first()[0] or 0
    work = binned(spots.join(sets.select("node", "sig"), "node"), keys, rows, 4 * values)
    groups = connected_components(work.groupBy("bin").applyInArrow(survive, "a long, b long"))

    # Exact sets of what is left, compared within the groups.
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_hasher()
        for batch in slices(batches, "text"):
            runs = [shingles(words(text or ""), width).tobytes() for text in batch.column("text").to_pylist()]
            marks = [xxhash.xxh3_128_digest(r) for r in runs]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(runs, pa.binary())], ["mark", "runs"])

    groups = staged(groups.join(sets, "node"), "ngram-groups")
    # A repeated id can have several texts; the mark of the set tells which of them is meant.
    ids = groups.select("id").distinct()
    if groups.count() <= broadcast_ids:
        ids = F.broadcast(ids)  # else both sides are shuffled
    wanted = texts.join(ids, "id").select("text")
    exact = wanted.mapInArrow(gather, "mark binary, runs binary").dropDuplicates(["mark"])
    exact = staged(exact.join(groups, "mark").select("node", "copies", "sig", "runs"), "ngram-exact")
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    spots = _blocks(groups.select("node", "component"), "component", sizes, chunk)

    def verify(table: pa.Table) -> pa.Table:
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        signatures = _signatures(table)
        runs = [np.frombuffer(r, dtype="<u8") for r in table.column("runs").to_pylist()]
        size = np.array([len(r) for r in runs])
        links: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for left, right, same in _each_block(table):
            a, b = pairs_in_block(signatures[left], signatures[right], bands, same)
            a, b = prune(a, b, signatures[left], signatures[right], limits)
            if not len(a):
                continue
            rows = left if same else np.concatenate([left, right])
            common = common_counts([runs[i] for i in rows], a, b if same else b + len(left))
            a, b = left[a], right[b]
            linked = common / (size[a] + size[b] - common) >= threshold
            a, b = a[linked], b[linked]
            for side, other in ((a, b), (b, a)):
                for i, n in zip(*_sums(nodes[side], copies[other])):
                    links[i] = links.get(i, 0) + n
            edges += spanning(nodes[a], nodes[b])
        found = [(i, n, None) for i, n in links.items()] + [(a, 0, b) for a, b in edges]
        columns = list(zip(*found)) if found else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["node", "n", "to"])

    rows = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / chunk))).first()[0] or 0
    each = exact.agg(F.avg(F.length("runs") + F.length("sig"))).first()[0] or 0.0
    work = binned(spots.join(exact, "node"), keys, rows, each)
    found = staged(work.groupBy("bin").applyInArrow(verify, "node long, n long, to long"), "ngram-links")
    names = connected_components(found.where("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    named = staged(names.join(sets.select("node", "id"), "node"), "ngram-names")
    classes = named.groupBy("component").agg(F.min("id").alias("class_id"))
    classes = named.join(classes, "component").select("node", "class_id")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    answers = (
        sets.select("node", "id", "mark", "copies")
        .join(counts, "node", "left")
        .join(classes, "node", "left")
        .select(
            F.col("mark").alias("set_mark"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("class_id", "id").alias("class_id"),
        )
    )
    return (
        described.select("id", "mark")
        .join(answers, (F.col("mark") == F.col("set_mark")) & F.col("id").isNotNull(), "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("class_id", "id").alias("class_id"),
        )
    )


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[int]]:
    names, at = np.unique(keys, return_inverse=True)
    return names.tolist(), np.bincount(at, weights=values, minlength=len(names)).astype(np.int64).tolist()

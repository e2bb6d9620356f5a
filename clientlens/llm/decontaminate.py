"""Benchmark decontamination by latent semantic retrieval.

Passages (overlapping windows of words) and benchmark items are TF-IDF vectors over the benchmark's terms. A
randomised singular value decomposition, whose products run as Spark jobs, gives a latent space; a passage
whose cosine with an item is high enough is a candidate. A candidate is confirmed on the words around it: the
longest common subsequence with the item must cover most of the item, or a good part of it together with
most of the item's answer (its own column, else its last sentence), which catches paraphrases.

Document frequencies count all documents, the directions of the latent spaces come from all passages and items, and
every passage is searched; nothing is sampled. The benchmark is the stated query set.
The corpus is numbered and searched once for every group of about `group` items; a group has a latent space for
each `block` of its items, so what a task holds does not grow with the benchmark.

Cases: a null or empty text has no passages and leaks nothing; items without a word are not looked for; null
ids are answered under a null id; a repeated id is answered once for each item, by its best match; an empty table
or benchmark gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from clientlens.llm.common import release, slices, staged

# What a word is. Between words of a column stand these characters beyond ASCII, and what the table of bytes turns into blanks.
WORDS, NO_WORD = re.compile(r"[^\W_]+"), r"[^\pL\pN\x00-\x7f]+"
BLANKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SENTENCE_END = re.compile(r"[.!?]\s+|\n+")
# Rows of the terms' directions that are added up at a time.
SLAB = 64
# Bytes of texts and of term numbers that a task works on at a time (one text may be longer).
TEXT_BYTES, TERM_BYTES = 2_000_000, 100_000
# Windows of texts that meet all items of a block at a time.
WINDOWS = 4096
# Marks of which terms are near which candidates, at a time.
MARKS = 4_000_000


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def split_words(texts: pa.Array) -> pa.Array:
    """The words of each text, with empty ones among them.

    Splitting by a pattern costs a search for each word. Here a pattern only looks for what stands between words beyond
    ASCII, and the bytes of the column are translated at once.
    """
    texts = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), NO_WORD, " ")
    _, ends, text = texts.buffers()
    text = pa.py_buffer((text.to_pybytes() if text else b"").translate(BLANKS))
    return pc.split_pattern(pa.Array.from_buffers(texts.type, len(texts), [None, ends, text], offset=texts.offset), " ")


@dataclass
class Item:
    """A benchmark item as term numbers, with its bit masks for the subsequence search."""

    key: object
    terms: list[int]
    answer: list[int]
    masks: dict[int, int] = field(default_factory=dict)
    answer_masks: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for terms, masks in ((self.terms, self.masks), (self.answer, self.answer_masks)):
            for place, term in enumerate(terms):
                masks[term] = masks.get(term, 0) | 1 << place


def common_subsequence(masks: dict[int, int], size: int, terms: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel: one step for each term that occurs at all."""
    full = (1 << size) - 1
    state = full
    for term in terms:
        mask = masks.get(term)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def read_items(rows: list[tuple], vocabulary: dict[str, int]) -> list[Item]:
    """Items of (key, text, answer or None); their terms are added to the vocabulary, numbered from 1."""
    items = []
    for key, text, answer in rows:
        number = lambda words: [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        terms = number(words_of(text or ""))
        sentences = [s for s in map(words_of, SENTENCE_END.split(text or "")) if s]
        said = words_of(answer) if answer else (sentences[-1] if sentences else [])
        if terms:
            items.append(Item(key, terms, number(said)))
    return items


def windows(length: int, span: int) -> list[tuple[int, int]]:
    """Overlapping windows of `span` words, half a span apart, that cover the whole text."""
    half = span // 2
    return [(i, min(i + span, length)) for i in range(0, max(length - half, 1), half)]


def term_sums(terms: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (row, term, value) of the TF-IDF matrix of some passages; rows have length one."""
    row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    wide = len(idf)
    keys, times = np.unique(row * wide + np.concatenate([*terms, np.zeros(0, np.int64)]).astype(np.int64), return_counts=True)
    row, term = np.divmod(keys, wide)
    value = times * idf[term]
    row, term, value = row[value > 0], term[value > 0], value[value > 0]
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=len(terms)))
    return row, term, value / norm[row]


def gram_times(terms: list[np.ndarray], idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A X for the TF-IDF matrix A of some passages."""
    row, term, value = term_sums(terms, idf)
    product = np.zeros((len(terms), basis.shape[1]), dtype=np.float32)
    np.add.at(product, row, basis[term] * value[:, None].astype(np.float32))
    out = np.zeros(basis.shape, dtype=np.float32)
    np.add.at(out, term, product[row] * value[:, None].astype(np.float32))
    return out


def halves_of(documents: list[np.ndarray], idf: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The passages of some documents as halves of windows: half and term of each informative word, factors, windows.

    A window is a half and the one behind it, and its factor, one over the length of its TF-IDF row, stands at the
    first. The last half of a document begins no window; its factor is 0.
    """
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    first = np.r_[0, np.cumsum(lengths)]
    half = span // 2
    counts = np.maximum(-(-(lengths - half) // half), 1)  # windows, as `windows` gives them
    slot = np.r_[0, np.cumsum(counts + 1)]
    terms = np.concatenate([*documents, np.zeros(0, np.uint32)]).astype(np.int64)
    at = np.flatnonzero(idf[terms] > 0)
    owner = np.searchsorted(first, at, side="right") - 1
    place = (at - first[owner]) // half
    halves, terms = slot[owner] + place, terms[at]
    # A word is in the window of its half, if there is one, and in that before.
    begins, follows = place < counts[owner], place > 0
    wide = len(idf)
    keys = np.r_[halves[begins] * wide + terms[begins], (halves[follows] - 1) * wide + terms[follows]]
    keys, times = np.unique(keys, return_counts=True)
    row, term = np.divmod(keys, wide)
    squares = np.bincount(row, weights=(times * idf[term]) ** 2, minlength=int(slot[-1]))
    factors = np.divide(1, np.sqrt(squares), out=np.zeros(len(squares)), where=squares > 0)
    return halves, terms, factors, int(counts.sum())


def row_sums(rows: np.ndarray, index: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows[index] over the runs that begin at `first`, longest run first, and the order of the runs.

    All runs take a step at a time, which for short runs of wide rows is several times as fast as np.add.reduceat.
    """
    sizes = np.diff(np.r_[first, len(index)])
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = first[order], sizes[order]
    sums = rows[index[starts]]
    for step in range(1, int(sizes[0])):
        left = int(np.searchsorted(-sizes, -step))
        sums[:left] += rows[index[starts[:left] + step]]
    return sums, order


def add_gram(total: np.ndarray, weighted: np.ndarray, halves: np.ndarray, terms: np.ndarray, factors: np.ndarray) -> None:
    """Add A'A X to `total`, before its rows are weighted, for passages as `halves_of` gives them; `weighted` is X by the terms' weights."""
    if not len(terms):
        return
    sums = np.zeros((len(factors) + 1, total.shape[1]), dtype=np.float32)
    first = np.flatnonzero(np.r_[True, halves[1:] != halves[:-1]])
    found, runs = row_sums(weighted, terms, first)
    sums[halves[first[runs]]] = found
    product = (sums[:-1] + sums[1:]) * (factors.astype(np.float32) ** 2)[:, None]
    product[1:] += product[:-1].copy()
    order = np.argsort(terms, kind="stable")
    term = terms[order]
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    found, runs = row_sums(product, halves[order], first)
    total[term[first[runs]]] += found


def latent_space(numbered: DataFrame, items: list[Item], idf: np.ndarray, *, span: int, rank: int, rounds: int = 2) -> np.ndarray:
    """Term directions [term, rank] of the passages of all documents and the items together.

    Items weigh as much as all passages. `numbered` has the column terms (packed numbers).
    """
    rank = min(rank, len(idf))
    queries = [np.array(i.terms) for i in items]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "terms", TERM_BYTES):
            halves, terms, factors, count = halves_of([np.frombuffer(p, dtype="<u4") for p in batch.column("terms").to_pylist()], idf, span)
            packed = [halves.astype("<u4"), terms.astype("<u4"), factors.astype("<f4")]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([p.tobytes()], pa.binary()) for p in packed], pa.array([count], pa.int64())], ["halves", "terms", "factors", "passages"]
            )

    passages = staged(numbered.select("terms").mapInArrow(split, "halves binary, terms binary, factors binary, passages long"), "passages")
    count = passages.agg(F.sum("passages")).first()[0] or 0

    def gram(basis: np.ndarray) -> np.ndarray:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weighted = np.zeros(basis.shape, dtype=np.float32), (basis * idf[:, None]).astype(np.float32)
            for batch in batches:
                for halves, terms, factors in zip(*(batch.column(c) for c in ("halves", "terms", "factors"))):
                    halves, terms = (np.frombuffer(c.as_buffer(), dtype="<u4").astype(np.int64) for c in (halves, terms))
                    add_gram(total, weighted, halves, terms, np.frombuffer(factors.as_buffer(), dtype="<f4"))
            total *= idf[:, None].astype(np.float32)
            for i in range(0, len(total), SLAB):
                part = total[i : i + SLAB]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i // SLAB], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["slab", "part"])

        def add(table: pa.Table) -> pa.Table:
            whole = np.zeros(0, dtype=np.float32)
            for part in table.column("part"):
                part = np.frombuffer(part.as_buffer(), dtype=np.float32)
                whole = whole + part if len(whole) else part
            return pa.table([table.column("slab")[:1], pa.array([whole.tobytes()], pa.binary())], names=["slab", "part"])

        schema = "slab long, part binary"
        slabs = passages.select("halves", "terms", "factors").mapInArrow(partial, schema).groupBy("slab").applyInArrow(add, schema).collect()
        out = np.zeros(basis.shape, dtype=np.float32)
        for slab, part in slabs:
            out[slab * SLAB : (slab + 1) * SLAB] = np.frombuffer(part, dtype=np.float32).reshape(-1, basis.shape[1])
        return out + gram_times(queries, idf, basis) * np.float32(max(count, 1) / len(queries))

    size = min(rank + 16, len(idf))
    basis = np.random.default_rng(3).standard_normal((len(idf), size)).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(gram(basis))[0].astype(np.float32)
    small = basis.T @ gram(basis)
    release(passages)
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, ::-1][:, :rank].astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def spread(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range and place of all places of the ranges that begin at `first`."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) + (first - np.cumsum(sizes) + sizes)[owner]


def searcher(items: list[Item], idf: np.ndarray, space: np.ndarray, span: int, least_cosine: float, least_share: float) -> Callable:
    """Function from the term numbers of some documents to their candidates (document, window start, item, cosine).

    Windows whose surroundings hold under `least_share` of an item's terms, in any order, are no candidates for it:
    no common subsequence is longer than that.
    """
    weighted = (space * idf[:, None]).astype(np.float32)
    informative = idf > 0
    queries = _unit(np.stack([weighted[i.terms].sum(axis=0) for i in items]))
    sizes = np.array([len(i.terms) for i in items])
    asked, begins = np.concatenate([i.terms for i in items]), np.cumsum(sizes) - sizes
    half = span // 2

    def held(flat: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Share of each item's terms that are in flat[begin:end]."""
        marks = np.zeros((len(item), len(idf)), dtype=bool)
        owner, place = spread(begin, end - begin)
        marks[owner, flat[place]] = True
        owner, place = spread(begins[item], sizes[item])
        return np.bincount(owner, weights=marks[owner, asked[place]], minlength=len(item)) / sizes[item]

    def search(documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        flat = np.concatenate([*documents, np.zeros(0, np.uint32)])
        edges = np.cumsum([0, *map(len, documents)])
        places = np.flatnonzero(informative[flat])
        if not len(places):
            return
        # Halves of all documents in one row, with an empty one behind each document.
        slot = np.r_[0, np.cumsum(-(-np.diff(edges) // half) + 1)]
        owner = np.searchsorted(edges, places, side="right") - 1
        block = slot[owner] + (places - edges[owner]) // half
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        present = block[first]
        halves = np.empty((len(first), weighted.shape[1]), dtype=np.float32)
        sums, order = row_sums(weighted, flat[places], first)
        halves[order] = sums
        # A window is a half and the one behind it; windows without a term are no candidates.
        before = present - (present > slot[owner[first]])
        spots = np.union1d(present, before)
        for part in np.array_split(spots, -(-len(spots) // WINDOWS)):
            passages = np.zeros((len(part), weighted.shape[1]), dtype=np.float32)
            for wanted in (part, part + 1):
                at = np.minimum(np.searchsorted(present, wanted), len(present) - 1)
                there = present[at] == wanted
                passages[there] += halves[at[there]]
            cosines = _unit(passages) @ queries.T
            window, item = np.nonzero(cosines >= least_cosine)
            doc = np.searchsorted(slot, part[window], side="right") - 1
            start = (part[window] - slot[doc]) * half
            begin = edges[doc] + np.maximum(start - sizes[item], 0)
            end = np.minimum(edges[doc] + start + span + sizes[item], edges[doc + 1])
            most = max(1, MARKS // len(idf))
            for i in range(0, len(item), most):
                some = np.arange(i, min(i + most, len(item)))
                some = some[held(flat, begin[some], end[some], item[some]) >= least_share]
                yield from zip(*(c[some].tolist() for c in (doc, start, item)), cosines[window[some], item[some]].tolist())

    return search


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    span: int = 64,
    rank: int = 128,
    least_cosine: float = 0.5,
    copied: float = 0.8,
    paraphrased: float = 0.55,
    answered: float = 0.6,
    common_share: float = 0.1,
    block: int = 250,
    group: int = 2000,
) -> DataFrame:
    """(id, item, cosine, lcs_share, answer_share) of every document and item it holds.

    Leaked is what covers `copied` of the item's words in order, or `paraphrased` of them and `answered` of the
    answer's. Terms in over `common_share` of all documents carry no weight in the search, unless an item
    has fewer than three others; the confirmation takes every word.
    """
    spark = docs.sparkSession
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    asked = staged(
        benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"), answer.alias("answer")).distinct(),
        "benchmark",
    )
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = {"id": docs.schema[id_col].dataType, "item": benchmark.schema[item_col].dataType}
    schema = T.StructType([T.StructField(c, k) for c, k in kinds.items()])
    for c in ("cosine", "lcs_share", "answer_share"):
        schema.add(c, T.DoubleType())
    found = spark.createDataFrame([], schema)
    count = docs.count()
    groups = max(1, ceil(asked.count() / group))
    for g in range(groups):
        part = F.pmod(F.xxhash64("item", "text", "answer"), F.lit(groups)) == g
        vocabulary: dict[str, int] = {}
        items = read_items([tuple(r) for r in asked.where(part).sort("item", "text", "answer").collect()], vocabulary)
        if items:
            leaks = _group_leaks(
                source, items, vocabulary, count, schema, span=span, rank=rank, least_cosine=least_cosine, copied=copied,
                paraphrased=paraphrased, answered=answered, common_share=common_share, block=block,
            )
            found = found.unionByName(leaks)
    best = F.max(F.struct("lcs_share", "answer_share", "cosine")).alias("best")
    return found.groupBy("id", "item").agg(best).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.round("best.cosine", 4).alias("cosine"),
        F.round("best.lcs_share", 4).alias("lcs_share"), F.round("best.answer_share", 4).alias("answer_share"),
    )


def _group_leaks(
    source: DataFrame, items: list[Item], vocabulary: dict[str, int], count: int, schema: T.StructType, *, span: int, rank: int,
    least_cosine: float, copied: float, paraphrased: float, answered: float, common_share: float, block: int,
) -> DataFrame:
    kind = source.schema["id"].dataType.simpleString()
    words = pa.array(list(vocabulary), pa.string())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Term numbers of each document's words, 0 for a word that is in no item."""
        for batch in slices(batches, "text", TEXT_BYTES):
            lists = split_words(batch.column("text"))
            flat, owner = lists.flatten(), pc.list_parent_indices(lists)
            full = pc.greater(pc.binary_length(flat), 0)
            places = pc.index_in(flat.filter(full), value_set=words)
            numbers = pc.fill_null(pc.add(places, 1), 0).to_numpy().astype("<u4")
            owner = owner.filter(full).to_numpy()
            ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
            buffers = [None, pa.py_buffer(np.r_[0, 4 * ends].astype(np.int32)), pa.py_buffer(numbers)]
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            held = np.bincount(owner[numbers > 0], minlength=batch.num_rows) > 0
            out = pa.RecordBatch.from_arrays([batch.column("id"), packed], ["id", "terms"])
            yield out.filter(pa.array(held))

    numbered = staged(source.mapInArrow(number, f"id {kind}, terms binary"), "term-numbers")
    wide = len(vocabulary) + 1

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(wide, dtype=np.int64)
        for batch in slices(batches, "terms"):
            for packed in batch.column("terms").to_pylist():
                seen[np.unique(np.frombuffer(packed, dtype="<u4"))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(wide)), pa.array(seen)], ["term", "docs"])

    counted = numbered.mapInArrow(frequencies, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    seen = np.zeros(wide)
    for term, n in counted.collect():
        seen[term] = n
    idf = np.log((1.0 + count) / (1.0 + seen)) + 1e-6
    needed = np.zeros(wide, dtype=bool)
    for item in items:
        if len({t for t in item.terms if seen[t] <= common_share * count}) < 3:
            needed[item.terms] = True
    idf[(seen > common_share * count) & ~needed] = 0
    idf[0] = 0

    blocks = []
    for i in range(0, len(items), block):
        # Terms of other blocks carry no weight in the space of this one.
        own = np.zeros(wide, dtype=bool)
        own[np.concatenate([item.terms for item in items[i : i + block]])] = True
        weights = np.where(own, idf, 0)
        blocks.append((items[i : i + block], weights, latent_space(numbered, items[i : i + block], weights, span=span, rank=rank)))
    out_types = [to_arrow_type(f.dataType) for f in schema.fields]

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = min(paraphrased, copied)
        searches = [(some, searcher(some, weights, space, span, least_cosine, least)) for some, weights, space in blocks]
        for batch in slices(batches, "terms", TERM_BYTES):
            rows = []
            documents = [np.frombuffer(p, dtype="<u4") for p in batch.column("terms").to_pylist()]
            for doc, start, item, cosine in (
                (doc, start, some[q], cosine) for some, search in searches for doc, start, q, cosine in search(documents)
            ):
                reach = documents[doc][max(0, start - len(item.terms)) : start + span + len(item.terms)]
                near = reach[reach > 0].tolist()
                share = common_subsequence(item.masks, len(item.terms), near) / len(item.terms)
                if share < least:
                    continue
                said = common_subsequence(item.answer_masks, len(item.answer), near) / len(item.answer) if item.answer else 0.0
                if share >= copied or said >= answered:
                    rows.append((batch.column("id")[doc].as_py(), item.key, cosine, share, said))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, out_types)], names=["id", "item", "cosine", "lcs_share", "answer_share"]
            )

    return staged(numbered.mapInArrow(confirm, schema), "leaks")

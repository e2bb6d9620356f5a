"""Periodic runs of words: stretches of a text that repeat a period, found by seeds and extension on diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that has at least
`least` words and `repeats` periods, and that no neighbouring word extends. On its diagonal, words i against
words i + q, it agrees over at least max(least - q, (repeats - 1) * q) words, so two occurrences of one k-gram
with lag q lie in it for every k up to that number. Grams of 2, 4, 8 ... words are numbered from the numbers of
their halves; words whose gram occurs once in the document are left out from there on. Grams of the shortest
guaranteed overlap look for lags up to their own length, and each doubling for the lags up to its length.

Of the occurrences of a gram only each one and the next are paired, at most one pair for each word. That loses
nothing: a gram at least as long as q cannot occur inside a run at a smaller distance than q, and a pair of
neighbouring occurrences has the smallest period of its stretch as its lag. For each lag a table holds how far
the diagonal has been covered, and seeds inside that are not extended again.

Cases: a null text has no words, as an empty one; a word is what stands between blanks, tabs, line ends, vertical
tabs and form feeds; null ids and repeated rows are answered like any other; an empty table gives no rows; other
columns are not looked at. The text of one document is held by one task, with about 80 bytes for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from clientlens.llm.common import slices

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and the text that each stands in."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, owner = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full), owner.filter(full).to_numpy()


def _repeated(at: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram occurs more than once, with their grams numbered from 0."""
    code, _ = pd.factorize(gram)
    often = np.bincount(code)[code] > 1 if len(code) else np.zeros(0, dtype=bool)
    return at[often], pd.factorize(code[often])[0]


def _agreeing(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on, forwards or backwards, equal those `lag` behind them."""
    n, size, count = 0, 32, len(words)
    while True:
        low, high = (at + n, min(at + n + size, count - lag)) if step > 0 else (max(at - n - size + 1, 0), at - n + 1)
        if low >= high:
            return n
        differ = np.flatnonzero(words[low:high] != words[low + lag : high + lag])
        if len(differ):
            return n + int(differ[0] if step > 0 else high - low - 1 - differ[-1])
        n, size = n + high - low, 2 * size


def _stretches(words: np.ndarray, at: np.ndarray, lag: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, lag) of the stretches that seeds of `size` equal words lie in."""
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    covered: dict[int, int] = {}
    # Of seeds in adjoining places on one diagonal the first covers the others.
    first = np.flatnonzero(np.r_[True, (np.diff(lag) != 0) | (np.diff(at) != 1)])[: len(at)]
    for i, d in zip(at[first].tolist(), lag[first].tolist()):
        if i >= covered.get(d, 0):
            begin = i - _agreeing(words, i - 1, d, -1)
            covered[d] = i + size + _agreeing(words, i + size, d, 1)
            yield begin, covered[d] + d - begin, d


def runs_of(words: np.ndarray, least: int, repeats: int) -> np.ndarray:
    """(start, length, period) of all runs by start, then period; words as numbers.

    Several documents can stand one behind the other, if none has a number that another has.
    """
    shortest = min(max(least - q, (repeats - 1) * q) for q in range(1, least + 1))
    base = 1 << (shortest.bit_length() - 1)
    at, gram = _repeated(np.arange(len(words)), words)
    following = np.full(len(words), -1, dtype=np.int64)
    found: list[tuple[int, int, int]] = []
    size = 1
    while len(at):
        if size >= base:
            order = np.argsort(gram, kind="stable")
            lag = np.diff(at[order])
            seed = (np.diff(gram[order]) == 0) & (lag <= size) & ((lag > size // 2) | (size == base))
            runs = _stretches(words, at[order][:-1][seed], lag[seed], size)
            found += [r for r in runs if r[1] >= max(least, repeats * r[2])]
        following[at] = gram
        inside = at[at + size < len(words)]
        after, before = following[inside + size], following[inside]
        following[at] = -1
        known = after >= 0
        at, gram = _repeated(inside[known], before[known] * np.int64(len(words)) + after[known])
        size *= 2
    return np.array(sorted((s, p, n) for s, n, p in found), dtype=np.int64).reshape(-1, 3)[:, [0, 2, 1]]


def find_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 24, repeats: int = 3
) -> DataFrame:
    """(id, n_words, runs, collapsed) of every document.

    runs: start, length and period in words, by start, then period. collapsed: the words outside of runs and those
    of the first period of each, joined by one space; a word that one run keeps and another drops is dropped.
    """
    if repeats < 3 or least < 2:
        raise ValueError("a run needs at least 3 repeats and 2 words")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8_000_000):
            words, owner = split_words(batch.column("text"))
            counts = np.bincount(owner, minlength=batch.num_rows)
            begins = np.r_[0, np.cumsum(counts)]
            coded = words.dictionary_encode()
            # One number for each word of each document, so that nothing agrees across documents.
            ids, _ = pd.factorize(owner.astype(np.int64) * max(len(coded.dictionary), 1) + coded.indices.to_numpy())
            runs = runs_of(ids, least, repeats)
            start, length, period = runs.T
            steps = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, start + length, -1)
            kept = np.cumsum(steps[:-1]) == 0
            holder = np.searchsorted(begins, start, "right") - 1
            places = np.r_[0, np.cumsum(np.bincount(holder, minlength=batch.num_rows))]
            listed = pa.StructArray.from_arrays([pa.array(x) for x in (start - begins[holder], length, period)], fields=list(RUN))
            rest = np.r_[0, np.cumsum(np.bincount(owner[kept], minlength=batch.num_rows))]
            texts = pa.ListArray.from_arrays(pa.array(rest, pa.int32()), words.filter(pa.array(kept)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(places, pa.int32()), listed),
                    pc.binary_join(texts, " "),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    run = "struct<start: bigint, length: bigint, period: bigint>"
    found = source.mapInArrow(search, f"id {kind}, n_words long, runs array<{run}>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def periodic(text, seed):
    """A text whose words from a place on repeat those of a period; place and period follow from the number `seed`."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(w):
        n = F.size(w).cast("long")
        a = F.pmod(seed, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(seed, F.lit(8))))
        period = F.slice(w, (a + 1).cast("int"), p.cast("int"))
        tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
        whole = F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(whole, " ")).otherwise(F.lit(""))

    # A lambda's variable is evaluated once, whereas each mention of an expression would split the text anew.
    return F.get(F.transform(F.array(words), repeat), F.lit(0))

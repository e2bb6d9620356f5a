"""Spelling variants: words one inserted, deleted or replaced letter apart, by a dictionary of trie-node pairs.

The words' prefixes are the nodes of a trie, their suffixes those of the trie of the reversed words; each node has
a number. A word with the letter at place i left out is the pair (node before i, node behind i), and a word cut
at place i is the pair (node up to i, node from i on). Words that share a pair by leaving out a letter differ by
that letter; a pair that one word has by leaving out and the other by cutting is an insertion. Of equal letters
in a row only the first is left out for insertions, so two words meet in one pair only. Hence neighbours are
counted, and the best is found, from each pair's numbers, and no row is made for two words; a pair holds
at most one word for each letter of the alphabet, and one that is cut.

Numbering needs no common counter: words are dealt to buckets by sampled splitters and sorted, and a node is
numbered where its first word stands in the bucket. A node with words in several buckets is the prefix of a
splitter and has its number from the splitters. Nodes with one word are left out, as no other word can share them.
A word's own number is its bucket and place, so numbers are ordered as words are, and rows carry no text.

Cases: null and empty words and null texts take no part; a word given twice is one word with both counts; a
document with a null id is counted without changes; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clientlens.llm.common import slices, staged

# Letters of a splitter, splitters for each partition, and sampled words for each splitter.
SPLITTER, BUCKETS, DRAWN = 32, 4, 8
# Bits of a number below the bucket's.
PLACE = 40


def _pieces(text: str, gap: re.Pattern, size: int = 1_000_000) -> Iterator[str]:
    """A text in parts that end between words."""
    at = 0
    while at < len(text):
        cut = gap.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def count_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: str = "A-Za-zÀ-ÿ",
    least_letters: int = 5,
    alter: Callable[[object], Callable[[str], str]] | None = None,
    held_bytes: int = 64_000_000,
) -> DataFrame:
    """(word, n) of all runs of letters, with A-Z lower-cased. `alter(id)` gives a document's change of a run."""
    run, gap = re.compile(f"[{letters}]+"), re.compile(f"[^{letters}]")

    def rows(totals: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, held = Counter(), 0
        for batch in slices(batches, "text"):
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                change = alter(name) if alter and name is not None else None
                # bytes.lower changes A-Z only.
                for piece in _pieces((text or "").encode().lower().decode(), gap):
                    for word, n in Counter(run.findall(piece)).items():
                        word = change(word) if change else word
                        if len(word) >= least_letters:
                            totals[word] += n
            held += batch.nbytes
            if held > held_bytes:
                yield rows(totals)
                totals, held = Counter(), 0
        yield rows(totals)

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def spanning_nodes(splitters: list[str]) -> dict[str, int]:
    """Numbers, below 0, of all nodes that can have words in several buckets."""
    nodes = sorted({s[:i] for s in splitters for i in range(len(s) + 1)} | {""})
    return {node: -1 - n for n, node in enumerate(nodes)}


def numbered(words: DataFrame, key: str, splitters: list[str], nodes: str, place: str) -> DataFrame:
    """The rows with the numbers of the nodes of `key`, by depth, and the row's place in the order of `key`.

    The list ends with the deepest node that another word shares. `key` is not null and never repeats.
    """
    known = spanning_nodes(splitters)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = [bisect_right(splitters, w) for w in batch.column(key).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket, pa.int64())], [*batch.schema.names, "bucket"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, before, path, shared, spot, serial = -1, "", [], 0, -1, 0
        last = None

        def out(rows: pa.RecordBatch, paths: list, places: list) -> pa.RecordBatch:
            added = [pa.array(paths, pa.list_(pa.int64())), pa.array(places, pa.int64())]
            return pa.RecordBatch.from_arrays([*rows.columns[:-1], *added], [*rows.schema.names[:-1], nodes, place])

        for batch in (part.slice(i, 2000) for part in batches for i in range(0, part.num_rows, 2000)):
            paths, places = [], []
            for b, word in zip(batch.column("bucket").to_pylist(), batch.column(key).to_pylist()):
                same = b == bucket
                depth = _common(before, word) if same else 0
                if spot >= 0:
                    paths.append(path[: max(shared, depth) + 1])
                    places.append((bucket << PLACE) + spot)
                if not same:
                    bucket, path, spot, serial = b, [], -1, 0
                over = 0
                while over < len(word) and word[: over + 1] in known:
                    over += 1
                new = len(word) - max(over, depth)
                path = [known[word[:d]] for d in range(over + 1)] + path[over + 1 : depth + 1]
                path += range((b << PLACE) + serial, (b << PLACE) + serial + new)
                serial, spot, shared, before = serial + new, spot + 1, max(over, depth), word
            # The last row waits for the next one's common letters.
            rows = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            last = rows.slice(rows.num_rows - 1)
            yield out(rows.slice(0, rows.num_rows - 1), paths, places)
        if last is not None:
            yield out(last, [path[: shared + 1]], [(bucket << PLACE) + spot])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    dealt = words.mapInArrow(deal, f"{ddl}, bucket long")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", key)
    return ordered.mapInArrow(number, f"{ddl}, `{nodes}` array<long>, `{place}` long")


def _splitters(words: list[str], buckets: int) -> list[str]:
    words = sorted(w[:SPLITTER] for w in words)
    return sorted({words[len(words) * i // buckets] for i in range(1, buckets)}) if words else []


# How a word has a pair.
CUT, LEFT_OUT, FIRST_LEFT_OUT = 0, 1, 2


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, s, word, n, how) of every shared pair of nodes of the words, which come reversed."""
    for batch in batches:
        before, behind, how, counts = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("reversed", "prefixes", "suffixes"))
        for backwards, p, s in zip(*columns):
            word, size, found = backwards[::-1], len(backwards), len(how)
            low, high = max(0, size - len(s)), min(size, len(p))
            if low < high:
                before += p[low:high]
                behind += s[size - high : size - low][::-1]
                how += [FIRST_LEFT_OUT if i == 0 or word[i - 1] != word[i] else LEFT_OUT for i in range(low, high)]
            low, high = max(0, size + 1 - len(s)), min(size + 1, len(p))
            if low < high:
                before += p[low:high]
                behind += s[size + 1 - high : size + 1 - low][::-1]
                how += [CUT] * (high - low)
            counts.append(len(how) - found)
        rows = pa.array(np.repeat(np.arange(len(counts)), counts))
        arrays = [pa.array(before, pa.int64()), pa.array(behind, pa.int64()), pa.array(how, pa.int8())]
        yield pa.RecordBatch.from_arrays(
            [*arrays, batch.column("word_no").take(rows), batch.column("n").take(rows)], ["p", "s", "how", "word_no", "n"]
        )


def neighbours(pairs: DataFrame) -> DataFrame:
    """(word_no, near, best): the number of near words, and (-n, word_no) of the one with the largest n."""
    pair = Window.partitionBy("p", "s")
    left_out, rank = F.col("how") > CUT, F.struct((-F.col("n")).alias("m"), F.col("word_no").alias("no"))
    ordered = pair.orderBy(left_out.desc(), F.col("n").desc(), "word_no")
    of = lambda how: F.min(F.when(F.col("how") == how, rank)).over(pair)
    met = pairs.select(
        "word_no", "how",
        F.row_number().over(ordered).alias("at"),
        F.first(rank).over(ordered).alias("first"),
        F.lead(rank).over(ordered).alias("next"),
        F.count_if(left_out).over(pair).alias("replaced"),
        F.count_if(F.col("how") == FIRST_LEFT_OUT).over(pair).alias("inserted"),
        of(FIRST_LEFT_OUT).alias("longer"),
        of(CUT).alias("shorter"),
    )
    shorter = F.when(F.col("how") == FIRST_LEFT_OUT, F.col("shorter"))
    other = F.when(F.col("replaced") > 1, F.when(F.col("at") == 1, F.col("next")).otherwise(F.col("first")))
    met = met.select(
        "word_no",
        F.when(F.col("how") == CUT, F.col("inserted")).otherwise(
            F.col("replaced") - 1 + shorter.isNotNull().cast("long")
        ).alias("near"),
        F.when(F.col("how") == CUT, F.col("longer")).otherwise(F.least(other, shorter)).alias("best"),
    )
    return met.where("near > 0").groupBy("word_no").agg(F.sum("near").alias("near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word_no, root) where each step of (word_no, form) is followed to the end; steps lead to larger counts.

    Every round doubles the steps that have been followed.
    """
    roots = staged(forms.select("word_no", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word_no").alias("root"), F.col("root").alias("further"))
        step = roots.join(further, "root", "left")
        step = staged(step.select("word_no", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = step.drop("moved")
        if not step.where("moved").limit(1).count():
            return roots


def group_variants(words: DataFrame, *, word_col: str = "word", count_col: str = "n", ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    form: the near word with the largest n (ties: the smallest word), if that is at least `ratio` (over 1) times the
    word's own. root: where the forms lead to, the word itself if it has none.
    """
    if ratio <= 1:
        raise ValueError("forms lead to larger counts only")
    spark = words.sparkSession
    counts = words.select(F.col(word_col).alias("word"), F.col(count_col).cast("long").alias("n")).where("word <> ''")
    counts = staged(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    draw = F.xxhash64("word")
    start, end = F.substring("word", 1, SPLITTER), F.substring(F.reverse("word"), 1, SPLITTER)
    drawn = counts.orderBy(draw).limit(DRAWN * buckets).select(start, end).collect()
    starts, ends = (_splitters([r[i] for r in drawn], buckets) for i in (0, 1))

    forward = staged(numbered(counts, "word", starts, "prefixes", "word_no"), "prefixes")
    both = forward.select("word_no", F.reverse("word").alias("reversed"), "n", "prefixes")
    both = numbered(both, "reversed", ends, "suffixes", "place")
    pairs = both.drop("place").mapInArrow(_pairs, "p long, s long, how byte, word_no long, n long")
    near = staged(neighbours(pairs), "near-words")
    forms = forward.select("word_no", "n").join(near, "word_no")
    forms = forms.where(-F.col("best.m") >= ratio * F.col("n"))
    forms = staged(forms.select("word_no", F.col("best.no").alias("form"), (-F.col("best.m")).alias("form_n")), "forms")
    named = lambda c: forward.select(F.col("word_no").alias(c), F.col("word").alias(f"{c}_word"))
    found = forms.join(_roots(forms), "word_no").join(named("form"), "form").join(named("root"), "root")
    found = found.select("word_no", "form_word", "root_word", "form_n")
    whole = forward.select("word_no", "word", "n").join(near.select("word_no", "near"), "word_no", "left").join(found, "word_no", "left")
    return whole.select(
        F.col("word").alias(word_col),
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        F.col("n").alias(count_col),
        F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )

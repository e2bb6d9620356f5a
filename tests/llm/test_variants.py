"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from clientlens.llm import queries, variants


def edits(word, letters):
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]
        yield from (word[:i] + c + word[i + 1 :] for c in letters)
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)


def brute(counts):
    """Rows of all words, by trying every edit."""
    letters = sorted({c for w in counts for c in w})
    near = {w: {e for e in edits(w, letters) if e in counts and e != w} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def brute_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{doc_id}:{run}".encode())
            if mark % 97 == 0 and doc_id is not None:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("letters", ["ab", "abcdé中\U0001f600"])
def test_random_words(spark, letters):
    draw = random.Random(len(letters))
    counts = {"".join(draw.choices(letters, k=draw.choice([1, 2, 3, 4, 5, 9]))): draw.randrange(1, 50) for _ in range(700)}
    got = rows(variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute(counts)


def test_words_in_few_and_many_buckets(spark, monkeypatch):
    draw = random.Random(9)
    counts = {"same" * 3 + "".join(draw.choices("abc", k=4)): draw.randrange(1, 9) for _ in range(60)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    for buckets in (0, 1, 30):
        monkeypatch.setattr(variants, "BUCKETS", buckets)
        monkeypatch.setattr(variants, "DRAWN", 1 if buckets == 1 else 8)
        assert rows(variants.group_variants(frame)) == brute(counts)


def test_odd_words(spark, none, odd):
    schema = "word string, n long, p long, how long"
    given = [(None, 5, 1, 1), ("", 5, 1, 1), ("abcde", 2, 1, 1), ("abcde", 2, 1, 1), ("abcd", 8, 1, 1), ("b" * 60_000, 1, 1, 1), ("b" * 60_001, 2, 1, 1)]
    got = rows(variants.group_variants(spark.createDataFrame(given, schema)))
    assert got == brute({"abcde": 4, "abcd": 8}) + [("b" * 60_000, "b" * 60_001, "b" * 60_001, 1, 1, 2), ("b" * 60_001, None, "b" * 60_001, 2, 1, None)]
    assert rows(variants.group_variants(spark.createDataFrame([], schema))) == []
    assert variants.count_words(none).collect() == []
    counted = {r.word: r.n for r in variants.count_words(odd, least_letters=3).collect()}
    assert counted == {"one": 2, "word": 30_000, "x" * 200_000: 1}


def test_long_texts_are_cut_between_words(docs_of):
    text = "Überall ÀÉ×÷ straße. " * 200_000
    got = {r.word: r.n for r in variants.count_words(docs_of([(1, text)]), least_letters=1).collect()}
    assert got == {"Überall": 200_000, "ÀÉ×÷": 200_000, "straße": 200_000}


def test_query_against_brute_force(spark, tiny):
    docs = pq.read_table(f"{tiny}/documents.parquet", columns=["doc_id", "text"])
    counts = brute_counts(zip(*(c.to_pylist() for c in docs.columns)))
    got = rows(queries.op11_spelling_variants(spark, tiny))
    assert len(got) > 500 and got == brute(counts)


def test_query_on_odd_rows(spark, tmp_path, docs_of):
    text = "Which which WHICH whicch while white Straße straßen strasse xÿÀyz"
    given = [(n, t) for n in (*range(150), None) for t in (text, None, "")]
    docs_of(given).write.parquet(str(tmp_path / "documents.parquet"))
    assert rows(queries.op11_spelling_variants(spark, str(tmp_path))) == brute(brute_counts(given))

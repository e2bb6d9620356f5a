"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from clientlens.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, repeats=3):
    found = []
    for q in range(1, len(words) // repeats + 1):
        begin = 0
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                continue
            length = i - begin + q
            whole = words[begin : begin + length]
            if length >= max(least, repeats * q) and all(whole[r:] != whole[: length - r] for r in range(1, q)):
                found.append((begin, length, q))
            begin = i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    mark, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and mark % 10 == 0 and n:
        g = mark // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{n},{q}\n" for s, n, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


@pytest.mark.parametrize("least,repeats", [(24, 3), (6, 3), (4, 3), (10, 4), (2, 3)])
def test_runs_of_random_words(least, repeats):
    draw = random.Random(least)
    for _ in range(300):
        words = []
        for _ in range(draw.randrange(5)):
            root = [draw.randrange(draw.choice([1, 2, 3, 8])) for _ in range(draw.choice([1, 2, 3, 5, 9, 17, 20]))]
            # Roots with repeats of their own hold grams that occur several times in one period.
            root = draw.choice([root, root * 2 + root[:2] + root])
            words += root * draw.choice([1, 2, 3, 4, 8])
        got = runs.runs_of(np.array(words, dtype=np.int64), least, repeats)
        assert [tuple(r) for r in got.tolist()] == brute_runs(words, least, repeats)


def test_period_whose_grams_all_repeat_inside_it():
    a, b = list(range(40)), list(range(40, 80))
    root = [w for block in (a, a, a, b, a, b, b, b) for w in block]
    words = root * 3 + root[:7]
    assert (0, len(words), len(root)) in [tuple(r) for r in runs.runs_of(np.array(words), 24, 3).tolist()]


def test_long_runs_take_no_quadratic_time():
    for words in (np.zeros(300_000, dtype=np.int64), np.arange(300_000) % 50_000):
        assert len(runs.runs_of(words, 24, 3)) == 1


def test_query_against_brute_force(spark, tiny):
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, tiny).collect()}
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len(WORD.findall(d.text or "")) <= 400]
    assert len(got) == len(docs) and len(short) > 100
    for d in short:
        assert got[d.doc_id] == brute_row(d.doc_id, d.text)
    assert sum(r[1] for r in got.values()) > 5


def test_odd_cases(spark, tmp_path, odd, none, docs_of):
    found = runs.find_runs(odd).collect()
    assert len(found) == odd.count() and runs.find_runs(none).collect() == []
    long = next(r for r in found if r.doc_id == 6)
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    assert {r.n_words for r in found if r.doc_id in (1, 2, 3)} == {0}
    # Words end at ASCII white space only; both rows of an id are answered.
    text = "\x1cx y\x0b" * 30
    rows = runs.find_runs(docs_of([(1, text), (1, text), (None, " a\tb \n" * 12)])).collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows] == [
        (1, 30, [(0, 30, 1)], "\x1cx y")
    ] * 2 + [(None, 24, [(0, 24, 2)], "a b")]


def test_query_on_odd_rows(spark, tmp_path, docs_of):
    rows = [(n, t) for n in (*range(60), None) for t in ("a b c d e f g h " * 9, None, "", " x ", "p q r " * 10)]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((brute_row(*r) for r in rows), key=repr)

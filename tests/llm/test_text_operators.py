"""Packing, personal data, language, sharding, licences against brute force, round trips and odd cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clientlens.llm import langid, licenses, packing, pii, queries, sharding
from clientlens.llm.common import drawn, hash_bound

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def check_packing(rows, docs, capacity=2048):
    """Every token in one piece with the right checksum; sequences gapless and within capacity."""
    own = Tokenizer.from_file(WORDS)
    want = defaultdict(list)
    for key, text in docs:
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        want[key].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for key, texts in want.items():
        assert sum(r.length for r in pieces[key]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for r in sorted(pieces[key], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(texts[0])
                assert r.ids_crc32 == zlib.crc32(np.array(texts[0][at : at + r.length], "<u4").tobytes())
                at += r.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_round_trip_and_padding(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = queries.op4_packing(spark, tiny).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    tokens = sum(r.length for r in rows)
    assert used == -(-tokens // 2048)  # one partition: only the last sequence is not full


def test_packing_of_many_partitions_merges_leftovers(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(7)
    rows = packing.pack_documents(docs, tokenizer_path=WORDS).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert used * 2048 <= 1.01 * sum(r.length for r in rows) + 2048


def test_packing_odd_cases(odd, none):
    rows = packing.pack_documents(odd, tokenizer_path=WORDS).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack_documents(none, tokenizer_path=WORDS).collect() == []


def test_packing_with_a_vocabulary_that_keeps_spaces(docs_of):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, encode = Tokenizer.from_file(path), packing.encoder(path)
    texts = ["", " a  b\n", "Don't stop, naïve ÀÉ 中文 x1y22", "x" * 5000, "word " * 3000]
    for t in texts:
        assert encode(t).tolist() == own.encode(t, add_special_tokens=False).ids
    rows = packing.pack_documents(docs_of(list(enumerate(texts))), tokenizer_path=path, capacity=512, end_id=50256).collect()
    for n, t in enumerate(texts):
        ids = [*own.encode(t, add_special_tokens=False).ids, 50256]
        pieces = sorted((r for r in rows if r.doc_id == n), key=lambda r: r.start)
        assert [p.ids_crc32 for p in pieces] == [zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes()) for p in pieces]
        assert sum(p.length for p in pieces) == len(ids)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aZß'sé9 \n\x1c.!<|endoftext|>é½Σİ"), max_size=60))
def test_words_encode_as_the_tokenizer_does(text):
    own = Tokenizer.from_file(WORDS)
    assert list(packing.encoder(WORDS)(text)) == own.encode(text, add_special_tokens=False).ids


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    values = [int(d) for d in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("0123456789123.@+-() ab_%é"), max_size=70))
def test_base_spans_are_those_of_the_patterns(text):
    found = [s for s in pii.find_spans(text, pii._automaton()) if s[0] in pii.BASE]
    assert found == base_spans(text)


def test_base_spans_of_the_given_documents(spark, small):
    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        spans = base_spans(r.text)
        want[r.doc_id] = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest(), len(spans)
    rows = queries.op3_pii(spark, small).collect()
    assert {r.doc_id: (r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in rows} == want
    assert sum(n for _, n in want.values()) > 20


def test_further_kinds_and_masking(docs_of, odd, none):
    text = (
        "Write to ann.b@mail.example.com or 12 Long Street, account: GB82 WEST 1234 5698 7654 32 now, "
        "ftp://joe:secret1@host/x token = \"04dbebab91ab85687d33\" rue de la Paix 14 call +1 (555) 010-0200."
    )
    spans = [(s.kind, text[s.start : s.end]) for s in pii.find_pii(docs_of([(1, text)])).first().spans]
    assert ("account", "GB82 WEST 1234 5698 7654 32") in spans and ("account", "04dbebab91ab85687d33") in spans
    assert ("address", "12 Long Street") in spans and ("address", "rue de la Paix 14") in spans
    assert ("login", "joe:secret1") in spans
    out = pii.mask_pii(docs_of([(1, text), (2, None)])).orderBy("doc_id").collect()
    assert "example.com" not in out[0].text and "010-0200" not in out[0].text and "<EMAIL>" in out[0].text
    assert out[1].text is None
    assert pii.find_pii(odd).count() == odd.count() and pii.mask_pii(none).collect() == []


def test_plain_text_has_no_spans(docs_of):
    text = "The broad street is wide. A secret road to the lane, 3 cats and 12 dogs; see http://example.com/a?b=1."
    assert pii.find_pii(docs_of([(1, text)])).first().spans == []


def test_forward_sums_all_segmentations():
    numbers = ["▁", "a", "b", "ab", "▁a", "▁ab", "bab"]
    pieces = dict(zip(numbers, range(1, 8)))
    weights = np.random.default_rng(1).random(len(pieces) + 1)

    def brute(word):
        if not word:
            return 1.0
        ways = [(word[:n], pieces.get(word[:n], 0 if n == 1 else None)) for n in range(1, len(word) + 1)]
        return sum(weights[p] * brute(word[len(w) :]) for w, p in ways if p is not None)

    words = ["▁abab", "▁bab", "▁c", "▁"]
    lattice = langid.Lattice.of(words, langid.Pieces(numbers))
    scaled = lattice.scaled(weights[lattice.piece])
    alpha, beta = lattice.forward(scaled), lattice.backward(scaled)
    whole = alpha[np.arange(len(words)), lattice.length]
    assert np.allclose(whole / langid.SCALE**lattice.length, [brute(w) for w in words]) and np.allclose(beta[:, 0], whole)


def test_language_of_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = queries.op1_language_id(spark, small).join(docs, "doc_id")
    share = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert found.count() == docs.count() and share >= 0.98


def test_language_odd_cases(docs_of, odd, none):
    model = langid.fit(none, vocabulary_path=PIECES)
    assert {r.lang_pred for r in langid.identify(odd, model).collect()} == {"und"}
    lines = [(i, "the cat and the dog " * 3, "en") for i in range(9)] + [(i, "der hund und die katze " * 3, "de") for i in range(9)]
    model = langid.fit(docs_of([*lines, (99, "der der", None), (98, None, "fr")]), vocabulary_path=PIECES)
    assert model.languages == ["de", "en"]
    said = langid.identify(odd, model).collect()
    assert len(said) == odd.count() and all(0 <= r.score <= 1 for r in said)
    assert {r.lang_pred for r in said if r.doc_id in (1, 2, 3, 5)} == {"und"}
    assert langid.identify(none, model).collect() == []
    assert langid.identify(docs_of([(1, "und der hund")]), model).first().lang_pred == "de"


def test_language_scorer_forgets_and_keeps_results(docs_of):
    model = langid.fit(docs_of([(1, "ab cd", "x"), (2, "ef gh", "y")]), vocabulary_path=PIECES)
    scorer = langid.Scorer(model, most=3, letters=9, long=4)
    for n in range(20):
        draw = random.Random(n)
        texts = pa.array([" ".join(draw.choices("ab cd ef gh abc, def-gh abcdefgh 12".split(), k=draw.randrange(9))) for _ in range(5)])
        assert np.allclose(scorer.sums(texts), langid.Scorer(model).sums(texts), atol=1e-4)
        assert len(scorer.younger) <= 3 and len(scorer.older) <= 3


def test_language_of_long_runs_of_rare_letters(docs_of):
    lines = [(i, "the cat and the dog " * 3, "en") for i in range(9)] + [(i, "der hund und die katze ѫѫ " * 3, "zz") for i in range(9)]
    model = langid.fit(docs_of(lines), vocabulary_path=PIECES)
    long = langid.identify(docs_of([(1, "ѫ" * 40), (2, "ѫ" * 400), (3, "ж" * 39 + " cat")]), model).collect()
    sums = langid.Scorer(model).sums(pa.array(["ѫ" * 40, "q" * 41]))
    assert {r.lang_pred for r in long if r.doc_id < 3} == {"zz"} and np.isfinite(sums).all() and (sums[:, 0] != sums[:, 1]).all()


def test_samples_do_not_run_empty(spark):
    assert hash_bound(3000, 10**10) > 2**40 and hash_bound(200, 10**15) > 0 and hash_bound(5, 5) == hash_bound(9, 2) == 2**63 - 1
    rows = spark.range(20_000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end as text")
    found = [r.text for r in drawn(rows, "text", 500).collect()]
    assert 300 < len(found) == len(set(found)) < 700
    assert drawn(rows.where("false"), "text", 5).count() == 0 and drawn(rows, "text", 10**6).count() == 13_334


def test_shards_are_even_and_slots_gapless(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = queries.op7_sharding(spark, small).collect()
    sizes = {r.doc_id: len((r.text or "").encode()) + 1 for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == sizes
    shards, total, most = defaultdict(list), sum(sizes.values()), max(sizes.values())
    for r in rows:
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(8))
    for members in shards.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r.size for r in members) - total / 8) <= most
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)


@pytest.mark.parametrize("options", [{}, {"ranges_per_shard": 2, "overfull": 1.2, "drawn_per_range": 4}])
def test_shards_follow_the_order_of_keys(spark, docs_of, options):
    """Against placing records one after the other in the order of text hash and id."""
    draw = random.Random(3)
    rows = [(n, draw.choice(["hot text", None, "x" * draw.randrange(3000), f"text {n}"])) for n in range(3000)]
    docs = docs_of(rows)
    got = {r.doc_id: r for r in sharding.shard_records(docs, shards=5, **options).collect()}
    keyed = docs.select("doc_id", F.hex(F.xxhash64("text")).alias("h"), F.hex(F.xxhash64(F.col("doc_id"))).alias("i")).collect()
    order = sorted(keyed, key=lambda r: (r.h.zfill(16), r.i.zfill(16)))
    total, at, slots = sum(len(t or "") + 1 for _, t in rows), 0, defaultdict(int)
    for r in order:
        size = got[r.doc_id].size
        shard = min((2 * at + size) * 5 // (2 * total), 4)
        assert (got[r.doc_id].shard, got[r.doc_id].slot) == (shard, slots[shard])
        at, slots[shard] = at + size, slots[shard] + 1


def test_sharding_of_one_repeated_text_and_odd_cases(docs_of, odd, none):
    copies = docs_of([(i % 3, "same text") for i in range(800)])
    counts = sharding.shard_records(copies).groupBy("shard").count().collect()
    assert [r["count"] for r in sorted(counts)] == [100] * 8
    rows = sharding.shard_records(odd).collect()
    assert len(rows) == odd.count() and {r.size for r in rows if r.doc_id in (1, 2)} == {1}
    assert {r.text_crc32 for r in rows if r.doc_id == 1} == {0}
    assert sharding.shard_records(none).collect() == []


@pytest.fixture(scope="module")
def classifier(spark, tiny):
    return licenses.train(spark.read.parquet(f"{tiny}/documents.parquet"))


def test_licence_parts_hold_whole_texts(docs_of):
    text = "One two.\nthree four\n \t\n\nfive. Six\nseven!  Eight\n\n\n" + " ".join(f"w{n}" for n in range(200))
    got = [(r.paragraph, r.sentence, " ".join(r.words)) for r in licenses.parts(docs_of([(1, text)]), "doc_id", "text").collect()]
    long = [" ".join(f"w{n}" for n in range(i, min(i + 80, 200))) for i in (0, 60, 120)]
    assert got == [
        (0, 0, "one two"), (0, 1, "three four"), (1, 0, "five"), (1, 1, "six seven"), (1, 2, "eight"), *((2, 0, w) for w in long),
    ]


def test_licence_scan_against_brute_force(spark, tiny, docs_of, classifier, odd):
    """Every part scored from the model's numbers, none passed over."""
    given = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    given += [(n, text) for n, (_, text, _) in enumerate(licenses.notices(), start=10_000) if n % 7 == 0]
    single, _, double, _, regression = classifier.model.stages
    terms = {t: n for n, t in enumerate([*single.vocabulary, *double.vocabulary])}
    weights, intercepts = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    want = []
    for key, text in given:
        for paragraph, lines in enumerate(re.split(r"\n[ \t\r]*\n\s*", text or "")):
            for sentence, body in enumerate(re.split(r"(?<=[.!?])\s+", lines.replace("\n", " "))):
                found = [w for w in re.split(r"[^\w]|_", body.lower()) if w]
                for i in range(0, max(len(found) - 80 + 59, 0) // 60 * 60 + 1, 60) if found else ():
                    part = found[i : i + 80]
                    at = {terms[t] for t in [*part, *map(" ".join, zip(part, part[1:]))] if t in terms}
                    scores = np.exp(intercepts + weights[:, sorted(at)].sum(axis=1))
                    predicted = classifier.families[scores.argmax()]
                    if predicted != "none":
                        want.append((key, paragraph, sentence, predicted, round(scores.max() / scores.sum(), 3)))
    got = [(r.doc_id, r.paragraph, r.sentence, r.predicted, round(r.probability, 3)) for r in licenses.scan(docs_of(given), classifier).collect()]
    assert len(want) > 200 and sorted(r[:4] for r in got) == sorted(r[:4] for r in want)
    assert all(abs(a[4] - b[4]) < 2e-3 for a, b in zip(sorted(got), sorted(want)))


def test_licences_in_sentences_of_other_makes(spark, small, docs_of, classifier):
    """Precision and recall on carriers and made-up names that training has not seen, among ordinary sentences."""
    carriers = (
        "The tool is made available under {}.", "Unless stated otherwise everything in this folder falls under {}.",
        "Our code is licensed under {} since last year.", "Alle Dateien stehen unter {}.", "you can copy it under the terms of {}",
    )
    made_up = ("the Larch Public License", "the terms of the owner", "the Harbour Licence 3", "a license of our own")
    rows, want = [], {}
    for family, names in licenses.NAMES.items():
        for name in names if family != "unknown" else made_up:
            for carrier in carriers:
                want[len(rows)] = family
                rows.append((len(rows), "It was late.\n\n" + carrier.format(name) + "\n\nNothing else."))
    ordinary = ["She got her licence in May.", "The MIT is in Cambridge.", "Apache tribes lived there.", "A general public meeting.", "No warranty on used cars."]
    for text in ordinary * 4:
        want[len(rows)] = "none"
        rows.append((len(rows), text))
    said = {r.doc_id: r.licence for r in licenses.scan(docs_of(rows), classifier).where("confirmed").collect()}
    families = [n for n, f in want.items() if f not in ("unknown", "none")]
    right = sum(said.get(n) == want[n] for n in families)
    assert right / len(families) >= 0.9, [(rows[n][1], said.get(n)) for n in families if said.get(n) != want[n]]
    assert right / len(said) >= 0.97, [(rows[n][1], f) for n, f in said.items() if f != want[n]]
    # In the corpus, whatever is confirmed is one of its notices.
    found = licenses.scan(spark.read.parquet(f"{small}/documents.parquet"), classifier).where("confirmed")
    assert found.where(~F.lower("body").rlike("licen[cs]e")).count() == 0 and found.count() > 20


def test_wrapped_licence_text(docs_of, classifier):
    text = (
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
        "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\n"
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software.\n\nTHE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."
    )
    said = {r.paragraph: (r.licence, r.confirmed) for r in licenses.scan(docs_of([(1, text)]), classifier).collect()}
    assert said[1] == ("MIT", True) and said.get(2, ("unknown", False)) == ("unknown", False)


def test_licences(docs_of, classifier, odd, none):
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore text."),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "LICENSED UNDER CC BY-NC 4.0."),
        (5, "words here\nAll rights reserved."),
        (6, "Nothing of this kind, in two lines.\nAt all."),
        (7, "It is licensed under the Foobar Mutual Sharing Pact of 1987, nothing else."),
        (8, "word " * 300 + ". Released under the MIT License. " + "word " * 300),
    ]
    said = {r.doc_id: r.licence for r in licenses.scan(docs_of(rows), classifier).collect()}
    assert said.pop(7, "unknown") == "unknown"
    assert said == {1: "MIT", 2: "Apache-2.0", 3: "GPL-3.0", 4: "CC-BY-NC", 5: "unknown", 8: "MIT"}
    assert licenses.scan(odd, classifier).collect() == [] and licenses.scan(none, classifier).collect() == []

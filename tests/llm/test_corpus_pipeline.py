"""Each stage of the pipeline on its own input, against brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from test_text_operators import base_spans, check_packing

from clientlens.llm import decontaminate


def test_stages(spark, small, tmp_path):
    docs, seen = spark.read.parquet(f"{small}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{n}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{n}")
        seen.append((name, [r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()]))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert sorted(docs.columns) == sorted(corpus_pipeline.COLUMNS)
    stages = {name: (before, after) for name, before, after in seen}

    before, after = stages["language_id"]
    assert {r["doc_id"] for r in before if re.search(r"[^\W\d_]{3}", r["text"])} == {r["doc_id"] for r in after}

    before, after = stages["ngram_join"]
    sets = {}
    for r in before:
        w = re.findall(r"[^\W_]+", r["text"].lower())
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    near = lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= 0.8
    name = {i: i for i in sets}
    ids = sorted(sets)
    pairs = [(i, j) for i in ids for j in ids if i < j and near(sets[i], sets[j])]
    for _ in range(20):
        for i, j in pairs:
            name[i] = name[j] = min(name[i], name[j])
    assert {r["doc_id"] for r in after} == {i for i in ids if name[i] == i}

    before, after = stages["decontamination"]
    squash = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    items = [squash(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in before if not any(i in squash(r["text"]) for i in items)}
    assert {r["doc_id"] for r in after} <= clean and len(after) >= len(clean) - 1

    before, after = stages["pii"]
    assert [r["doc_id"] for r in sorted(before, key=lambda r: r["doc_id"])] == sorted(r["doc_id"] for r in after)
    assert not any(base_spans(r["text"]) for r in after)
    clean = {r["doc_id"]: r["text"] for r in before if not re.search(r"[0-9@]", r["text"])}
    assert all(r["text"] == clean[r["doc_id"]] for r in after if r["doc_id"] in clean)
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = stages["packing"]
    rows = spark.read.parquet(f"{tmp_path}/4").collect()
    check_packing(rows, [(r["doc_id"], r["text"]) for r in before])
    whole = corpus_pipeline.run(spark, small).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in rows)
    assert {(r.doc_id, r.doc_tokens) for r in whole} == {(r.doc_id, r.doc_tokens) for r in rows}


def test_stages_of_an_empty_table(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert docs.count() == 0


def test_rows_are_told_apart_not_ids(spark, small, docs_of):
    stages = dict(corpus_pipeline.STAGES)
    text = lambda seed: " ".join(f"w{seed}x{i % 37}y{i}" for i in range(60))
    rows = [(1, text(1)), (1, text(1)), (2, text(1)), (None, text(2)), (None, text(2)), (None, text(3)), (4, text(3)), (5, text(4)), (5, text(5)), (6, None), (6, None)]
    kept = stages["ngram_join"](spark, docs_of(rows), small)
    assert kept.columns == corpus_pipeline.COLUMNS
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    # Rows without words are no copies of each other.
    assert got == sorted([(1, text(1)), (None, text(2)), (4, text(3)), (5, text(4)), (5, text(5)), (6, None), (6, None)], key=repr)

    item = spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, item), (None, text(1)), (7, f"{text(2)} {item} {text(3)}"), (7, text(4)), (8, None), (9, text(4)), (9, text(4))]
    kept = stages["decontamination"](spark, docs_of(rows), small)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(None, text(1)), (7, text(4)), (8, None), (9, text(4)), (9, text(4))], key=repr)

"""Joins, near-duplicates, leaks, URL rules and WARC records against brute force, SQL and odd cases."""

from __future__ import annotations

import base64
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference, duckdb_rows, spark_rows
from pyspark.sql import functions as F, types as T

from clientlens.llm import decontaminate, embeddings, graph, ngrams, queries, urls, warc


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_against_sql(spark, small, name):
    con = connect(small)
    assert difference(spark_rows(queries.all_queries()[name](spark, small)), duckdb_rows(con, queries.all_oracles()[name])) is None


def words(seed, count):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefgh", k=5)) for _ in range(count)]


def brute_links(texts, threshold=0.8):
    sets = []
    for t in texts:
        w = ngrams.WORDS.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    hit = lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= threshold
    return [[j for j in range(len(texts)) if j != i and hit(sets[i], sets[j])] for i in range(len(texts))]


def components(links):
    name = list(range(len(links)))
    for _ in links:
        name = [min([name[i], *(name[j] for j in near)]) for i, near in enumerate(links)]
    return name


def edited(base, seed, edits):
    draw, out = random.Random(seed), list(base)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"w{draw.randrange(10**6)}"
    return " ".join(out)


def test_join_of_a_large_group_in_chunks(docs_of):
    base = words(1, 150)
    texts = [edited(base, n, n % 5) for n in range(90)] + [" ".join(words(n, 40)) for n in range(100, 140)] + [" ".join(base)] * 30
    links = brute_links(texts)
    rows = ngrams.similar_documents(docs_of(list(enumerate(texts))), chunk=16).collect()
    assert {r.doc_id: (r.n_links, r.class_id) for r in rows} == {
        i: (len(near), c) for i, (near, c) in enumerate(zip(links, components(links)))
    }


def test_join_odd_cases(odd, none, docs_of):
    rows = ngrams.similar_documents(odd).collect()
    assert len(rows) == odd.count()
    assert [(r.n_links, r.class_id) for r in rows if r.doc_id == 4] == [(1, 4), (1, 4)]
    assert all(r.n_links == 0 for r in rows if r.doc_id != 4)
    assert ngrams.similar_documents(none).collect() == []
    # The same id with different texts: each is a document of its own.
    twice = docs_of([(1, "a b c d e f"), (1, "g h i j k l"), (2, "a b c d e f"), (3, "G h, i j k l!")])
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in ngrams.similar_documents(twice).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_pruning_drops_only_hopeless_pairs():
    limits = ngrams.least_matches(0.8, 80, 16, 1e-6)
    assert all(m <= 0.8 * n for n, m in limits) and limits[-1][1] > 40
    draw = np.random.default_rng(2)
    left = draw.integers(0, 2**32, (1000, 80), dtype=np.uint32)
    right = np.where(draw.random((1000, 80)) < 0.8, left, left + 1)
    at = np.arange(1000)
    assert len(ngrams.prune(at, at, left, right, limits)[0]) == 1000
    assert len(ngrams.prune(at, at, left, left + 1, limits)[0]) == 0


@pytest.mark.parametrize("many", [False, True])
def test_common_counts(many):
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 400, 100).astype(np.uint64)) for _ in range(20)]
    a, b = np.triu_indices(20, 1) if many else (np.array([0, 3]), np.array([5, 9]))
    got = ngrams.common_counts(sets, a, b, wide=64)
    assert got.tolist() == [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in zip(a, b)]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(1000, 1200)]
    got = graph.connected_components(spark.createDataFrame([*path, *star, (5, 5)], "a long, b long")).collect()
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(1000, 1200)]}
    assert {r.node: r.component for r in got} == want


VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType())]
)


def test_vectors_against_brute_force(spark):
    draw = np.random.default_rng(5)
    centre = draw.standard_normal(32)
    x = [centre + 0.12 * draw.standard_normal(32) for _ in range(150)] + [draw.standard_normal(32) for _ in range(150)] + [centre] * 20
    x = np.array(x, dtype=np.float32)
    labels = [0] * 280 + [1] * 40
    rows = [(i, v.tolist(), k, "x") for i, (v, k) in enumerate(zip(x, labels))]
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = (y @ y.T >= 0.98) & np.equal.outer(labels, labels) & ~np.eye(len(y), dtype=bool)
    links = [np.flatnonzero(r).tolist() for r in near]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS), chunk=32).collect()
    total = sum(map(len, links))
    assert total > 2000 and sum(r.n_links for r in got) >= 0.99 * total
    assert all(r.n_links <= len(links[r.vec_id]) for r in got)
    assert {r.vec_id: r.component_id for r in got} == dict(enumerate(components(links)))


def test_vectors_odd_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1e-30, 0.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (None, [0.0, 1.0], 2), (12, [1.0] * 20_000, 1),
        (13, [1.0] * 20_000, 1),
    ]
    got = embeddings.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], VECTORS)).collect()
    assert len(got) == len(rows)
    # Label and vector decide who links; a null id is no reason not to.
    linked = {(1, 4, 1, True), (2, 4, 1, False), (10, 4, 1, False), (None, 4, 1, False), (12, 1, 12, True), (13, 1, 12, False)}
    assert {tuple(r) for r in got if r.n_links} == linked and sum(r.vec_id == 2 for r in got) == 2
    assert all(r.component_id == r.vec_id and r.kept for r in got if not r.n_links)
    assert sum(r.vec_id is None for r in got if not r.n_links) == 2
    assert embeddings.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_calibration_keeps_the_wanted_recall():
    window, least = embeddings.calibrate(0.98, 32, 0.9999)
    draw = np.random.default_rng(6)
    hits = (np.abs(0.2 * draw.standard_normal((20_000, 32))) <= window).sum(axis=1) >= least
    assert hits.mean() >= 0.999 and least > 16


def test_collisions_by_windows():
    draw = np.random.default_rng(7)
    a, b = draw.standard_normal((30, 9)), draw.standard_normal((40, 9))
    assert (embeddings.collisions(a, b, 0.5) == (np.abs(a[:, None] - b[None]) <= 0.5).sum(axis=2)).all()


BENCHMARK = "item_id long, text string, doc_id string"


def test_leaks_copied_and_paraphrased(spark, docs_of):
    item = words(11, 30)
    items = [(1, " ".join(item) + ". The answer is " + " ".join(words(12, 5)), "x"), (2, " ".join(words(13, 25)), "x"), (3, "", "x"), (4, None, "x")]
    other = lambda n: " ".join(words(n, 120))
    near = [w if i % 4 else "changed" for i, w in enumerate(item)]
    docs = [
        (1, f"{other(20)} {items[0][1].upper()} {other(21)}"),
        (2, f"{other(22)} {' '.join(near)}. The answer is {' '.join(words(12, 5))} {other(23)}"),
        (3, f"{other(24)} {items[1][1]}"),
        (4, other(25)),
        (5, " ".join(item[:8])),
        (None, items[1][1]),
    ]
    got = decontaminate.find_leaks(docs_of(docs), spark.createDataFrame(items, BENCHMARK)).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert pairs == {(1, 1), (2, 1), (3, 2), (None, 2)}


def test_leaks_are_those_of_a_plain_search(spark, small):
    squash = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    docs = [(r.doc_id, squash(r.text)) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, squash(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, s in items if s in t}
    got = {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, small).collect()}
    assert want <= got and len(got) <= len(want) + 1


def test_leaks_odd_cases_and_blocks(spark, odd, none, docs_of):
    items = spark.createDataFrame([(n, " ".join(words(n, 20)), "x") for n in range(12)], BENCHMARK)
    empty = spark.createDataFrame([], BENCHMARK)
    assert decontaminate.find_leaks(odd, items).collect() == []
    assert decontaminate.find_leaks(none, items).collect() == [] and decontaminate.find_leaks(odd, empty).collect() == []
    docs = docs_of([(n, " ".join(words(n, 20))) for n in range(12)])
    for cut in ({"block": 5}, {"block": 5, "group": 7}):
        got = decontaminate.find_leaks(docs, items, **cut).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(n, n) for n in range(12)]


def test_paraphrases_of_several_strengths_are_found(spark, docs_of, monkeypatch):
    """Items with a tenth to a third of their words replaced, dropped or moved, the answer kept, inside other text."""
    monkeypatch.setattr(decontaminate, "WINDOWS", 3)
    common = words(500, 60)
    draw = random.Random(8)
    some = lambda n, count: [w if draw.random() < 0.6 else draw.choice(common) for w in words(n, count)]
    items = [(n, " ".join(some(n, 40)) + ". So it is " + " ".join(words(900 + n, 6)), "x") for n in range(200)]

    def reworded(text, share):
        body, answer = text.split(". ")
        out = []
        for w in body.split():
            kind = draw.random()
            out += [w] if kind > share else ["other" + w] if kind > share / 2 else [] if kind > share / 4 else [w, draw.choice(common)]
        return " ".join(out) + ". " + answer

    docs = [
        (n, " ".join([*some(2000 + n, draw.randrange(400)), reworded(text, (0.1, 0.2, 0.3, 0.35)[n % 4]), *some(4000 + n, draw.randrange(300))]))
        for n, text, _ in items
    ]
    clean = [(1000 + n, " ".join(some(6000 + n, 300))) for n in range(200)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs_of(docs + clean), spark.createDataFrame(items, BENCHMARK)).collect()}
    for strength in range(4):
        assert sum((n, n) in got for n in range(strength, 200, 4)) >= 45, strength
    assert got <= {(n, n) for n in range(200)}


def test_directions_come_from_the_passages_of_all_documents(spark, docs_of, monkeypatch):
    fitted, plain = [], decontaminate.latent_space

    def watched(numbered, *rest, **more):
        fitted.append(numbered.count())
        return plain(numbered, *rest, **more)

    monkeypatch.setattr(decontaminate, "latent_space", watched)
    docs = docs_of([(n, f"red house {n} green tree {n * 7}") for n in range(3000)])
    decontaminate.find_leaks(docs, spark.createDataFrame([(1, "the green house by the tree 14")], "item_id long, text string"))
    assert fitted == [3000]


def test_halves_add_up_to_the_gram_matrix_of_all_windows():
    draw = np.random.default_rng(5)
    documents = [draw.integers(0, 40, n).astype("<u4") for n in (1, 7, 8, 9, 31, 200)]
    idf = np.where(np.arange(40) % 4, 1.0 + np.arange(40) / 10, 0)
    basis = draw.standard_normal((40, 6)).astype(np.float32)
    passages = [d[a:b] for d in documents for a, b in decontaminate.windows(len(d), 16)]
    halves, terms, factors, count = decontaminate.halves_of(documents, idf, 16)
    total = np.zeros(basis.shape, dtype=np.float32)
    decontaminate.add_gram(total, (basis * idf[:, None]).astype(np.float32), halves, terms, factors)
    assert count == len(passages)
    assert np.allclose(total * idf[:, None], decontaminate.gram_times(passages, idf, basis), atol=1e-3)


def test_words_of_a_column_are_those_of_its_texts():
    texts = ["x", None, "", "  ", "Don't a_b__c, 3.14!", "naïve—CAFÉ…x² ½", "日本語、テスト。", "\x00a\tb\nc\x7fd\u00a0e\u2028f", "😀x😀é", "é"]
    want = [decontaminate.words_of(t or "") for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        for some, words_there in ((column, want), (column.slice(4, 3), want[4:7]), (column.slice(1, 2), want[1:3])):
            assert [[w for w in ws if w] for ws in decontaminate.split_words(some).to_pylist()] == words_there


def test_candidates_of_many_documents_are_those_of_each_window(monkeypatch):
    """Documents searched together, in small parts, against each window alone; no product is made for each document."""
    draw = np.random.default_rng(6)
    items = [decontaminate.Item(q, draw.integers(1, 40, n).tolist(), []) for q, n in enumerate((1, 3, 9, 20))]
    idf = np.where(np.arange(40) % 3, 1.0 + np.arange(40) / 10, 0)
    space = draw.standard_normal((40, 6)).astype(np.float32)
    documents = [draw.integers(0, 40, n).astype("<u4") for n in (3, 0, 8, 1, 17, 60, 5)]
    documents += [np.zeros(20, "<u4"), np.r_[documents[4], np.zeros(30), items[3].terms].astype("<u4")]
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    vector = lambda terms: unit((space * idf[:, None])[np.asarray(terms, dtype=int)].sum(axis=0))
    want = {}
    for d, terms in enumerate(documents):
        for start in range(0, len(terms), 4):
            if not idf[terms[start : start + 8]].any():
                continue
            for q, item in enumerate(items):
                reach = set(terms[max(0, start - len(item.terms)) : start + 8 + len(item.terms)].tolist())
                cosine = vector(terms[start : start + 8]) @ vector(item.terms)
                if cosine >= 0.3 and sum(t in reach for t in item.terms) / len(item.terms) >= 0.5:
                    want[d, start, q] = cosine
    made, plain = [], decontaminate._unit
    monkeypatch.setattr(decontaminate, "_unit", lambda rows: made.append(len(rows)) or plain(rows))
    for windows, marks in ((4096, 4_000_000), (3, 100)):
        monkeypatch.setattr(decontaminate, "WINDOWS", windows)
        monkeypatch.setattr(decontaminate, "MARKS", marks)
        search = decontaminate.searcher(items, idf, space, 8, 0.3, 0.5)
        made.clear()
        got = {(d, start, q): cosine for d, start, q, cosine in search(documents)}
        assert got.keys() == want.keys() and len(want) > 10 and all(abs(got[k] - want[k]) < 1e-4 for k in want)
        assert len(made) == -(-sum(made) // windows)
        assert list(search([])) == [] and list(search([np.zeros(5, "<u4")])) == []


def test_common_subsequence():
    draw = random.Random(8)
    for _ in range(50):
        a, b = ([draw.randrange(1, 6) for _ in range(draw.randrange(1, 15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(decontaminate.Item(0, a, []).masks, len(a), b) == table[-1][-1]


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("a.b", "", "block"), ("b", "/x", "allow")], "host string, path string, action string"
    )
    cases = {
        "http://Sub.EXAMPLE.org/es/1": ("sub.example.org", "/es/1", "Example.org/es/".lower(), "block"),
        "https://example.org/esx?q#f": ("example.org", "/esx", "org/", "allow"),
        "http://notexample.org?x": ("notexample.org", "", None, "allow"),
        "http://a.b/xyz": ("a.b", "/xyz", "a.b", "block"),
        "http://c.b/xyz": ("c.b", "/xyz", "b/x", "allow"),
        "no scheme": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "x", "y")], "page_id long, url string, host string, rule string")
    got = sorted(tuple(r) for r in urls.filter_urls(pages, rules).collect())
    want = [(i, *v) for i, v in enumerate(cases.values())]
    assert sorted(got, key=str) == sorted([*want, want[0]], key=str)
    assert {r.verdict for r in urls.filter_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert urls.filter_urls(pages.limit(0), rules).collect() == []


def test_warc_records(spark):
    html = '<html lang="en"><head><title>A &amp; B</title><style>p{}</style></head><body><p>One<br>two &lt;3</p><!-- no --><a href="/x">link</a> é</body></html>'
    pages = spark.createDataFrame([(1, "http://a/b", html, "z"), (2, None, None, "z")], "page_id long, url string, html string, block string")
    rows = {(r.page_id, r.record_type): r for r in warc.build_derivatives(pages).collect()}
    sha = lambda t: "sha1:" + base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    response, text, meta = (rows[1, k] for k in ("response", "conversion", "metadata"))
    assert text.block == "A & B\nOne\ntwo <3\nlink é"
    assert "title: A &amp; B\r\n" in meta.block and "outlink: /x\r\n" in meta.block and "language: en\r\n" in meta.block
    assert response.payload_digest == text.source_digest == sha(html) and text.block_digest == sha(text.block)
    assert text.refers_to == meta.refers_to == response.record_id and response.refers_to is None
    assert len({r.record_id for r in rows.values()}) == 6
    assert all(r.content_length == len(r.block.encode()) for r in rows.values())
    assert f"WARC-Refers-To: {response.record_id}\r\n" in text.headers and "WARC-Target-URI" not in rows[2, "response"].headers
    assert rows[2, "conversion"].block == ""
    assert warc.build_derivatives(pages.limit(0)).collect() == []


def test_warc_files_can_be_cut_by_their_lengths(spark, tiny, tmp_path):
    records = warc.build_derivatives(spark.read.parquet(f"{tiny}/pages.parquet"))
    warc.write_warc(records, str(tmp_path / "w"))
    seen = 0
    for file in (tmp_path / "w").glob("part-*"):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(head.rpartition(b"Content-Length: ")[2])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            data, seen = rest[size + 4 :], seen + 1
    assert seen == records.count() == 3 * spark.read.parquet(f"{tiny}/pages.parquet").count()


def test_warc_time_is_in_proportion_to_the_page(spark):
    size = 1_000_000
    openings = ("<!-- ", "<a ", "<script ", "<script>", "<style>x", "<p ", "<title", "<title>", "<html ", '<a href="', '<a href="x" ', "&", "< ", " \n")
    pages = [(n, "http://a/", o * (size // len(o))) for n, o in enumerate(openings)]
    begun = time.monotonic()
    rows = warc.build_derivatives(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(rows) == 3 * len(pages) and time.monotonic() - begun < 60
    # What is not closed hides the rest of the page.
    assert {r.block for r in rows if r.record_type == "conversion" and r.page_id in (0, 2, 3, 4)} == {""}


def test_warc_references_headers_and_repeated_rows(spark):
    html = (
        '<HTML lang="e\nn"><title>T</title><script>if (a<b) "<!--"</script>seen &#233;&eacute;&#xE9; &mdash; &lt;b&gt; &amp;lt; &#xD800;'
        '<style>s</style ><!-- <script> -->after<a class=x href="/y\r\nWARC-Type: z">l</a><a name="n">m</a><script>never'
    )
    pages = spark.createDataFrame([(1, "http://a/\r\nWARC-Type: forged\tx", html)] * 2, "page_id long, url string, html string")
    rows = warc.build_derivatives(pages).collect()
    assert len({r.record_id for r in rows}) == 6
    texts = {r.block for r in rows if r.record_type == "conversion"}
    assert texts == {"T\nseen ééé — <b> &lt; \ufffd afterlm"}
    for r in rows:
        assert r.headers.count("\r\nWARC-Type") == 1
        assert all(": " in line or line == "WARC/1.1" for line in r.headers.removesuffix("\r\n").split("\r\n"))
        derivative = r.record_type != "response"
        assert ("WARC-Refers-To-Target-URI: http://a/%0D%0AWARC-Type: forged%09x\r\n" in r.headers) == derivative
        assert ("WARC-Refers-To-Date: " in r.headers) == ("X-Source-Payload-Digest: sha1:" in r.headers) == derivative
    meta = next(r.block for r in rows if r.record_type == "metadata")
    assert meta == "title: T\r\nlanguage: e%0An\r\noutlink: /y%0D%0AWARC-Type: z\r\n"


def test_urls_with_very_many_labels_and_many_rules(spark):
    long = "a." * 500_000 + "example.org"
    rows = [(1, f"http://{long}/es/1"), (1, f"http://{long}/es/1"), (2, "http://" + "b" * 1_000_000 + "/x"), (None, "https://example.org/"), (3, f"http://x/{'p' * 1_000_000}")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("www.example.org", "", "block"), ("x", "/" + "p" * 50, "block")]
    begun = time.monotonic()
    for few in (10_000, 1):  # the second way, with rules in several copies
        found = urls.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"), few_rules=few)
        got = sorted(((r.page_id, r.rule and r.rule[:20], r.verdict) for r in found.collect()), key=repr)
        block = (1, "example.org/es/", "block")
        assert got == sorted([block, block, (2, None, "allow"), (None, "org/", "allow"), (3, "x/" + "p" * 18, "block")], key=repr)
    assert time.monotonic() - begun < 60

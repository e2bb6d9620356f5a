"""Registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.llm import (
    decontaminate, embeddings, langid, licenses, ngrams, packing, pii, runs, sharding, topk, urls, variants,
    warc,
)
from clientlens.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

# Rules of the URL filter: host, path, action.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def held_out(doc_id):
    """One id in five; a null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))), vocabulary_path=PIECES)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of_kind = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.BASE),
        F.sha2(listed(of_kind(*pii.BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path=WORDS)


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, action)")
    return urls.filter_urls(table(spark, sf_dir, "pages"), rules)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_records(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build_derivatives(table(spark, sf_dir, "pages"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similar_documents(table(spark, sf_dir, "documents"))


def misspelt(doc_id: int) -> Callable[[str], str]:
    """Takes a letter out of some runs of a document; id and run decide which."""
    begun = zlib.crc32(f"{doc_id}:".encode())

    def change(run: str) -> str:
        mark = zlib.crc32(run.encode(), begun)
        at = mark % len(run)
        return run if mark % 97 else run[:at] + run[at + 1 :]

    return change


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least 5 letters and 3 occurrences, each with the form that it is a variant of."""
    counts = variants.count_words(table(spark, sf_dir, "documents"), least_letters=5, alter=misspelt)
    return variants.group_variants(counts.where("n >= 3"), ratio=2)


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, after one text in ten has been made periodic."""
    docs = table(spark, sf_dir, "documents")
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(mark % 10 == 0, runs.periodic(F.col("text"), F.floor(mark / 10))).otherwise(F.col("text"))
    found = runs.find_runs(docs.select("doc_id", text.alias("text")))
    # The largest exponent, compared as whole numbers; runs come by start and period, so the first one stays.
    better = lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r
    ).otherwise(best)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = found.withColumn("best", F.aggregate("runs", F.get("runs", F.lit(0)), better))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(F.expr("best.length * 1000 div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_language_id,
            op2_decontamination,
            op3_pii,
            op4_packing,
            op5_licence_scan,
            op6_url_filter,
            op7_sharding,
            op8_embedding_duplicates,
            op9_warc,
            op10_ngram_join,
            op11_spelling_variants,
            op12_top_k,
            op13_periodic_runs,
        )
    }


URL_SQL = f"""
WITH parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), rules(rule_host, rule_path, action) AS (
    VALUES {", ".join(str(r) for r in URL_RULES)}
), answers AS (
    SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.action,
           row_number() OVER (PARTITION BY p.page_id
                              ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS place
    FROM parts p LEFT JOIN rules r
      ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM answers WHERE place = 1
"""


EMBEDDING_SQL = """
WITH RECURSIVE rows AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), good AS (
    SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM rows
    WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), reach(start, node) AS (
    SELECT vec_id, vec_id FROM rows
    UNION
    SELECT r.start, l.b FROM reach r JOIN links l ON l.a = r.node
), named AS (
    SELECT start AS vec_id, min(node) AS component_id FROM reach GROUP BY start
), counted AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT n.vec_id, coalesce(c.n, 0) AS n_links, n.component_id, n.vec_id = n.component_id AS kept
FROM named n LEFT JOIN counted c USING (vec_id)
"""


NGRAM_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
), runs AS (
    SELECT doc_id, unnest(list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS run
    FROM words WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM runs a JOIN runs b USING (run)
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE c / (x.n + y.n - c) >= 0.8
), reach(start, node) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.start, l.b FROM reach r JOIN links l ON l.a = r.node
), named AS (
    SELECT start AS doc_id, min(node) AS class_id FROM reach GROUP BY start
), counted AS (
    SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a
)
SELECT n.doc_id, coalesce(c.n, 0) AS n_links, n.class_id FROM named n LEFT JOIN counted c USING (doc_id)
"""


TOP_K_SQL = """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
    FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


def all_oracles() -> dict[str, str]:
    return {
        "op6_url_filter": URL_SQL,
        "op8_embedding_duplicates": EMBEDDING_SQL,
        "op10_ngram_join": NGRAM_SQL,
        "op12_top_k": TOP_K_SQL,
    }

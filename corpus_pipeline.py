"""A corpus pipeline of five stages: language, near-duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents; the last returns packed pieces.

Cases: null and empty texts, and texts without a letter, go in the first stage; of equal rows one stays; null ids
and ids that several rows have are ids like any other; an empty table passes as one; columns that documents does
not have are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.llm import decontaminate, langid, ngrams, packing, pii
from clientlens.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps rows whose language is recognised: not `und`, and with a score of at least LEAST_SCORE."""
    model = langid.fit(docs, vocabulary_path=public_tokenizers.path("piece_bpe_32k.model"))
    found = langid.identify(docs, model, keep=("lang", "source", "n_chars", "text"))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: that with the smallest id, a null id being the largest.

    Rows are numbered first, so one of several equal rows stays, and rows that share an id are told apart.
    """
    rows = staged(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    classes = ngrams.similar_documents(rows.select("row", "text"), id_col="row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = classes.join(rows.select("row", "doc_id"), "row").groupBy("class_id").agg(first).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text holds a benchmark item. They are found by their text, so neither a null id nor one
    that another row has as well takes a clean row along."""
    mark = F.sha2(F.col("text"), 256)
    found = decontaminate.find_leaks(docs.select(mark.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias("mark")).distinct()
    return docs.join(found, mark == F.col("mark"), "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars becomes the length of the new text."""
    masked = pii.mask_pii(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language),
    ("ngram_join", near_duplicates),
    ("decontamination", leaks),
    ("pii", personal_data),
    ("packing", pack),
]

# The stages learn a model, search and tokenise, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

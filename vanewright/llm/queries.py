"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.llm import (
    jaccard, langid, linededup, packing, periodic, quality, sentencepiece, tokenfiles, toxicity, urlfilter,
    vectorcodes, vectors, winnowing,
)
from vanewright.llm.common import bounded_batches, held_out, read
from vanewright.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Where this machine keeps the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules of op1.
URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge_urls(read(spark, folder, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded, and decoded again from its ids alone."""
    return sentencepiece.encode(
        read(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"), digests=True
    ).withColumn("score", F.round("score", 3))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = langid.fit_languages(docs.select("doc_id", "text", "lang"))
    found = langid.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.*")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack(read(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = linededup.without_shared_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, folder, "documents"), words=4, similar=85)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, read(spark, folder, "labels"))
    score = F.col("measures.score")
    return toxicity.with_measures(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"), F.col("measures.matched").alias("matched"),
    )


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(read(spark, folder, "embeddings"))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.edit_likeness(read(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, read(spark, folder, "labels"))
    score = F.col("quality.score")
    return quality.with_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.7).cast("int").alias("predicted"),
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic.with_planted_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    best, runs = F.col("periodic.strongest"), F.col("periodic.runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return periodic.with_runs(docs).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"),
        best.period.alias("period"), F.expr("1000 * periodic.strongest.length div periodic.strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"),
    )


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded into files, and what is read back from them."""
    docs, files = read(spark, folder, "documents"), scratch_folder(spark, "token-files")
    tokenfiles.write_tokens(docs, files, tokenizer_path("word_bpe_49k.json"), end=1)
    return tokenfiles.read_documents(spark, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes, codebooks = vectorcodes.vector_codes(read(spark, folder, "embeddings"), carry=["label"])
    return vectorcodes.with_label_errors(codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codebooks.sha256()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_language_id": op3_language_id,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_toxicity": op7_toxicity,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_quality": op10_quality,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_vector_codes": op13_vector_codes,
}

"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.llm.bpe import bpe_encode_decode
from crossfoot.llm.byte_bpe import rank_encode_decode
from crossfoot.llm.exact_dedup import mark_exact_duplicates
from crossfoot.llm.grams import held_out
from crossfoot.llm.hard_negatives import mine_hard_negatives
from crossfoot.llm.language import identify_languages, train_language_model
from crossfoot.llm.line_dedup import dedup_lines
from crossfoot.llm.mixing import mix_sources
from crossfoot.llm.ngram_join import near_duplicates
from crossfoot.llm.quality import judge_quality
from crossfoot.llm.token_files import new_token_folder, read_token_files, write_token_files
from crossfoot.llm.toxicity import score_toxicity, train_toxicity
from crossfoot.llm.url_filter import judge_urls
from crossfoot.llm.whitening import whiten

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_exact_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_toxicity(docs, labels, ~held_out(labels["doc_id"]))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(scored["doc_id"]).alias("held_out"), "score", (scored["score"] >= 0.5).cast("int").alias("predicted"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), with_ids=False)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_language_model(docs, ~held_out(docs["doc_id"]))
    found, name = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(found["doc_id"]).alias("held_out"), F.col(name)["lang_pred"].alias("lang_pred"), F.col(name)["score"].alias("score"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned, removed = dedup_lines(docs.select("doc_id", "text"))
    return cleaned.select("doc_id", F.size(removed).cast("long").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_token_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return read_token_files(spark, path, with_ids=False)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=False)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_mixing": op4_mixing,
    "op5_ngram_join": op5_ngram_join,
    "op6_language_id": op6_language_id,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_files": op8_token_files,
    "op9_quality": op9_quality,
    "op10_url_filter": op10_url_filter,
    "op11_whitening": op11_whitening,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

"""Cleaning pipeline over documents: five stages, each written as Parquet and read again by the next.

Every stage works on all its predecessor kept. Further columns of the documents are passed through; rows with NULL in any
column take part as the operators define it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crossfoot.llm.bpe import bpe_encode_decode
from crossfoot.llm.grams import held_out
from crossfoot.llm.language import UNDETERMINED, identify_languages, train_language_model
from crossfoot.llm.line_dedup import dedup_lines
from crossfoot.llm.mixing import mix_sources
from crossfoot.llm.ngram_join import near_duplicates
from crossfoot.llm.storage import shared_folder

#: A document goes if no language has at least this share of it.
LEAST_SHARE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a main language; those without letters and even mixtures go."""
    model = train_language_model(docs, ~held_out(docs["doc_id"]))
    found, name = identify_languages(docs, model)
    return found.filter((F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["score"] >= LEAST_SHARE)).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out lines that an earlier line makes superfluous, short ones too; documents of which nothing is left go."""
    cleaned, removed = dedup_lines(docs)
    kept = cleaned.filter((F.size(removed) == 0) | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")))
    changed = {"n_chars": F.when(F.size(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return kept.withColumns(changed).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest id stays, and one row of rows with the same id."""
    dropped = near_duplicates(docs).filter("component_id <> doc_id").select(F.col("doc_id").alias("dropped_id")).distinct()
    kept = docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")
    place = "place"
    while place in docs.columns:
        place += "_"
    rows = kept.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last())))
    return rows.filter((F.col(place) == 1) | F.col("doc_id").isNull()).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents drawn for the target weights."""
    drawn = mix_sources(docs).filter("NOT kept").select(F.col("doc_id").alias("undrawn_id")).distinct()
    return docs.join(drawn, docs["doc_id"].eqNullSafe(drawn["undrawn_id"]), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document."""
    return bpe_encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]

#: Expectation-maximisation, raking and BPE have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/crossfoot-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

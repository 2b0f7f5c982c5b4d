"""Exact duplicates by a tree-merge of sorted digest runs.

Every scan partition is a run of digests. In each round, runs whose number differs only in the last bits are exchanged
and merged: ``fan_in`` sorted runs become one, and of equal digests only the entry with the best row survives, with the
number of rows it stands for. After the last round one entry per digest is left, still spread over all partitions by its
digest. The winners then travel back down the same tree, so a text that makes up a third of the table meets at most one
partition's rows in any task.

A digest counts as equal only together with the byte length and a second, independent hash of the normalised text; that
verification is part of the key at every level.

Defined results: NULL text counts as empty, and all empty texts are equal. Ties go to the smallest id; NULL ids come
last. A repeated row (same id and text) gets a result row of its own, and one of them is kept. Further columns of the
input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.runtime import materialize

# Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"
ENTRY = ("sha", "n_bytes", "check")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digest_runs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per document: run, place in the table, digest with its verification, rank of the row among equals."""
    text = docs.select(docs[id_column].alias("doc_id"), F.length(docs[text_column]).alias("size"), normalised(docs[text_column]).alias("text"))
    return text.select(
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2("text", 256)).alias("sha"),
        F.octet_length("text").alias("n_bytes"),
        F.xxhash64("text").alias("check"),
        F.struct(
            (-F.coalesce("size", F.lit(0))).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), "doc_id", F.monotonically_increasing_id().alias("place")
        ).alias("row"),
    )


def merge_round(runs: DataFrame, fan_in: int) -> DataFrame:
    """Merge ``fan_in`` neighbouring runs; of each digest the best row stays."""
    merged = F.floor(F.col("run") / fan_in).cast("int").alias("run")
    return runs.groupBy(merged, *ENTRY).agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))


def mark_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fan_in: int = 16) -> DataFrame:
    """One row per document with the row that stays of its group, the group's size and the text's SHA-256.

    ``fan_in`` runs are merged per round: 100,000 partitions take five rounds. The digests are checkpointed once because
    the number of a run must not change when a lost partition is computed again.
    """
    digests = materialize(digest_runs(docs, id_column, text_column))
    last_run = digests.agg(F.max("run")).first()[0] or 0  # one number
    levels = [digests.groupBy("run", *ENTRY).agg(F.min("row").alias("best"), F.count("*").alias("rows"))]
    while last_run > 0:
        levels.append(merge_round(levels[-1], fan_in))
        last_run //= fan_in
    winners = levels.pop()
    while levels:
        below = levels.pop().select("run", *ENTRY, F.floor(F.col("run") / fan_in).cast("int").alias("above"))
        above = winners.withColumnRenamed("run", "above")
        winners = below.join(above, ["above", *ENTRY]).drop("above")
    marked = digests.join(winners, ["run", *ENTRY])
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        (F.col("row.place") == F.col("best.place")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

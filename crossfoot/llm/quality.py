"""Quality rules: counts of a text, and a log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials over the buckets are counted, one over
all documents and one over the trusted ones; a document's score is the mean logarithm of their ratio over its n-grams,
and every document is judged by the same fixed threshold. Everything is a column expression or an aggregate.

The raw counts cover all documents. The trusted text comes from at most ``max_trusted`` rows with the trusted label,
those first in order of a hash of their id, so that their ids can be broadcast.

Defined results: NULL text counts as empty, has no words and fails the base rules. Without trusted rows the ratio is 0
for all and only the base rules decide. Repeated rows stay repeated, further columns are ignored. Texts are judged whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 16384
WINDOW = 5
# Characters counted as symbols, and white space as a character class.
SYMBOLS = "#*$%&|<>"
SPACE, SPACE_CLASS = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]"


def with_words(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text, its words, and the hash of every word."""
    text = docs.select(docs[id_column].alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    cut = text.withColumn("words", F.filter(F.split("text", SPACE_CLASS + "+"), lambda w: w != ""))
    return cut.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def places(size: Column, last: int) -> Column:
    """0 to size - last, or nothing."""
    return F.when(size >= last, F.sequence(F.lit(0), size - last)).otherwise(F.array().cast("array<int>"))


def grams(hashes: Column) -> Column:
    """Buckets of all words and word pairs."""
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    double = F.transform(places(F.size(hashes), 2), lambda i: F.pmod(F.xxhash64(hashes[i], hashes[i + 1]), F.lit(BUCKETS)).cast("int"))
    return F.concat(single, double)


def repeated_words(windows: Column) -> Column:
    """Words covered by 5-word windows that occur at least twice. Windows are sorted with their places to find equals."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twins(sorted_windows: Column) -> Column:
        twin = F.filter(
            sorted_windows,
            lambda w, k: (F.get(sorted_windows, k - 1)["h"] == w["h"]) | (F.get(sorted_windows, k + 1)["h"] == w["h"]),
        )
        return F.sort_array(F.transform(twin, lambda w: w["i"]))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("until"))
    covered = F.aggregate(
        F.get(F.transform(F.array(ordered), twins), F.lit(0)),
        start,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i + WINDOW - acc["until"])).alias("n"), (i + WINDOW).alias("until")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered).otherwise(F.lit(0))


def base_counts(words: DataFrame) -> DataFrame:
    """Adds word_chars, n_symbols, n_dup_lines, n_repeat_words and n_words."""
    hashes = F.col("hashes")
    windows = F.transform(places(F.size(hashes), WINDOW), lambda i: F.xxhash64(*[hashes[i + k] for k in range(WINDOW)]))
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    gathered = words.withColumns({"windows": windows, "lines": lines})
    return gathered.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.translate("text", SPACE, "")).cast("long"),
            "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("windows")).cast("long"),
        }
    )


def trusted_ids(labels: DataFrame, max_trusted: int, id_column: str, label_column: str) -> DataFrame:
    rows = labels.filter((labels[label_column] == 1) & labels[id_column].isNotNull()).select(labels[id_column].alias("trusted_id"))
    return rows.groupBy("trusted_id").agg(F.first("trusted_id").alias("id")).orderBy(F.xxhash64("id"), "id").limit(max_trusted).select("trusted_id")


def log_ratios(words: DataFrame, trusted: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """One row with the array of log-likelihood ratios per bucket. ``trusted`` is broadcast: its size is bounded."""
    marked = words.join(F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
    rows = marked.select(F.col("trusted_id").isNotNull().cast("long").alias("good"), F.explode(grams(F.col("hashes"))).alias("bucket"))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    every = words.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"))
    gathered = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("rows"), F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    # Trusted counts are smoothed towards the raw shares, so a bucket as frequent in both has the ratio 0 at any size.
    pseudo = smoothing * BUCKETS

    def log_ratio(row: Column) -> Column:
        share = row["raw"] / F.col("all_raw")
        return F.when(row["raw"] > 0, F.log((row["good"] + pseudo * share) / ((F.col("all_good") + pseudo) * share))).otherwise(F.lit(0.0))

    ratio = F.transform("rows", log_ratio)
    return gathered.select(ratio.alias("ratio"))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = -0.2,
    max_trusted: int = 20_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """One row per document: counts, whether the base rules fail, the mean log ratio and the verdict."""
    words = with_words(docs, id_column, text_column)
    ratios = log_ratios(words, trusted_ids(labels, max_trusted, id_column, label_column))
    counted = base_counts(words).withColumns({"grams": grams(F.col("hashes")), "ratio": ratios.scalar()})
    total = F.aggregate("grams", F.lit(0.0), lambda acc, b: acc + F.get(F.col("ratio"), b))
    scored = counted.withColumn("log_ratio", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio", failed.alias("base_failed"), (~failed & (F.col("log_ratio") >= threshold)).alias("kept")
    )

"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of (source, language, topic) with their tokens. The sampling probabilities of the cells
are raked: in turn for each dimension, the cells of every value are scaled until their expected tokens match the target.
Cells that are rarer than their target asks for get a weight above 1: their documents count more than once, since no
other sample of the same size meets the targets. ``copies`` is drawn by comparing a hash of the id with the fraction of the
cell's weight, so the same table always gives the same sample; ``kept`` tells documents with at least one copy.

Raking goes on until all dimensions meet their targets within ``TOLERANCE``; ``mixing_residuals`` returns what is met by
weights and what by keeping each document once, where no probability exceeds 1 and rare values stay short.

Only the table of cells takes part in the fitting, as DataFrames: it has a row per combination that occurs, and may grow
with the number of sources. Tokens are words between white space.

Defined results: NULL source and language count as the empty text, a NULL text has no tokens and the topic ``other``.
Values without a target get probability 0; targets without documents are left out and the others share their part.
Repeated rows are kept or dropped alike. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.llm.storage import stored
from crossfoot.runtime import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Raking ends when the expected tokens of every value are this close to the target, as a share of it,
#: after MOST_ROUNDS, or when further rounds bring them no closer because no weights meet all targets.
TOLERANCE = 1e-3
MOST_ROUNDS = 100
#: Rounds between two looks at what is still apart.
LOOK = 3
#: A table of cells beyond this many rows is joined by a shuffle instead of a broadcast.
BROADCAST_CELLS = 20_000
# Topics and the pattern that tells them, the first that fits counts.
TOPICS = (
    ("legal", r"(?i)licen[cs]ed? |all rights reserved|copyright"),
    ("contact", r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z]"),
    ("table", r"\w+ \| \w+ \| \w+ \|"),
    ("prose", r"[.!?]"),
)


def topic_of(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    found = F.lit("other")
    for name, pattern in reversed(topics):
        found = F.when(F.rlike(text, F.lit(pattern)), F.lit(name)).otherwise(found)
    return found


def described(docs: DataFrame, id_column: str, text_column: str, source_column: str, lang_column: str, topics: tuple[tuple[str, str], ...]) -> DataFrame:
    """doc_id, source, lang, topic and n_tokens of every document."""
    text = docs[text_column]
    return docs.select(
        docs[id_column].alias("doc_id"),
        F.coalesce(docs[source_column].cast("string"), F.lit("")).alias("source"),
        F.coalesce(docs[lang_column].cast("string"), F.lit("")).alias("lang"),
        topic_of(text, topics).alias("topic"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"),
    )


def tempered_shares(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share): the shares that occur, raised to ``power`` and scaled to 1."""
    raised = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens")).select("value", F.pow("tokens", F.lit(power)).alias("share"))
    return scaled_shares(raised)


def scaled_shares(shares: DataFrame) -> DataFrame:
    total = F.when(F.col("total") > 0, F.col("share") / F.col("total")).otherwise(F.lit(0.0))
    return shares.withColumn("total", shares.agg(F.sum("share")).scalar()).select("value", total.alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rate: float, rounds: int, cut: bool = True) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with the probability column ``p``.

    With ``cut`` no probability exceeds 1 and ``rounds`` are made; else there are more until the targets are met. A step
    uses the cells twice, so every step is written; otherwise the plan would double with each. Files tell their own size,
    where a checkpoint would keep the estimate of its plan, which is squared with each step.
    """
    fitted = cells.withColumns({"p": F.lit(float(rate)), "aim": cells.agg(F.sum("tokens")).scalar() * rate})
    last = float("inf")
    for done in range(rounds if cut else max(rounds, MOST_ROUNDS)):
        if not cut and done >= rounds and (done - rounds) % LOOK == 0:
            apart = largest_residual(fitted, targets, rate)
            if apart <= TOLERANCE or apart > 0.9 * last:
                break
            last = apart
        for dimension, shares in targets.items():
            sums = fitted.groupBy(F.col(dimension).alias("value")).agg(F.sum(F.col("p") * F.col("tokens")).alias("now"))
            factors = sums.join(shares, "value", "left").select(F.col("value").alias(dimension), "now", F.coalesce("share", F.lit(0.0)).alias("share"))
            factor = F.when(F.col("now") > 0, F.col("share") * F.col("aim") / F.col("now")).otherwise(F.lit(1.0))
            p = F.col("p") * factor
            fitted = stored(fitted.join(factors, dimension).select(*DIMENSIONS, "tokens", "aim", (F.least(F.lit(1.0), p) if cut else p).alias("p")))
    return fitted.drop("aim")


def residuals(cells: DataFrame, targets: Mapping[str, DataFrame], rate: float) -> DataFrame:
    """(dimension, value, target, expected, expected_once) in tokens: by the weights ``p``, and with each document at most once."""
    aim = cells.agg(F.sum("tokens")).scalar() * rate
    tables = []
    for dimension, shares in targets.items():
        sums = cells.groupBy(F.col(dimension).alias("value")).agg(
            F.sum(F.col("p") * F.col("tokens")).alias("expected"), F.sum(F.least(F.lit(1.0), F.col("p")) * F.col("tokens")).alias("expected_once")
        )
        target = (F.coalesce("share", F.lit(0.0)) * aim).alias("target")
        tables.append(sums.join(shares, "value", "left").select(F.lit(dimension).alias("dimension"), "value", target, "expected", "expected_once"))
    return reduce(DataFrame.unionByName, tables)


def largest_residual(cells: DataFrame, targets: Mapping[str, DataFrame], rate: float) -> float:
    """The largest distance of a value's expected tokens from its target, as a share of the target."""
    apart = F.abs(F.col("expected") - F.col("target")) / F.col("target")
    return residuals(cells, targets, rate).agg(F.max(F.when(F.col("target") > 0, apart))).first()[0] or 0.0


def cells_and_shares(documents: DataFrame, targets: Mapping[str, Mapping[str, float]] | None, power: float) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The table of cells and the target shares. Dimensions without a target get their own shares raised to ``power``."""
    cells = materialize(documents.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")))
    shares = {}
    for dimension in DIMENSIONS:
        if targets and dimension in targets:
            listed = documents.sparkSession.createDataFrame([(str(k), float(v)) for k, v in targets[dimension].items()], "value string, share double")
            present = cells.select(F.col(dimension).alias("value")).distinct()
            shares[dimension] = materialize(scaled_shares(listed.join(present, "value")))
        else:
            shares[dimension] = materialize(tempered_shares(cells, dimension, power))
    return cells, shares


def mixing_probabilities(
    documents: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, rate: float = 0.8, power: float = 0.8, rounds: int = 6, cut: bool = True
) -> DataFrame:
    """The table of cells with probabilities, or with weights that meet the targets if they are not ``cut`` at 1."""
    cells, shares = cells_and_shares(documents, targets, power)
    return rake(cells, shares, rate, rounds, cut)


def mixing_residuals(documents: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, rate: float = 0.8, power: float = 0.8, rounds: int = 6) -> DataFrame:
    """Target and expected tokens of every value of every dimension, as ``residuals`` gives them, for uncut weights."""
    cells, shares = cells_and_shares(documents, targets, power)
    return residuals(rake(cells, shares, rate, rounds, cut=False), shares, rate)


def with_probability(documents: DataFrame, cells: DataFrame) -> DataFrame:
    """Adds the probability ``p`` of a document's cell; the cells are broadcast only while they are few."""
    probabilities = cells.select(*DIMENSIONS, "p")
    few = cells.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    return documents.join(F.broadcast(probabilities) if few else probabilities, list(DIMENSIONS))


def drawn(id_column: Column, seed: int) -> Column:
    """A number from 0 to below 1 that depends on the id and the seed only."""
    return F.pmod(F.xxhash64(id_column, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mix_sources(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    rate: float = 0.8,
    power: float = 0.8,
    rounds: int = 6,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    lang_column: str = "lang",
    topics: tuple[tuple[str, str], ...] = TOPICS,
) -> DataFrame:
    """One row per document: its cell, tokens, weight, copies and whether it is drawn. ``rate`` is the share of tokens aimed at."""
    documents = stored(described(docs, id_column, text_column, source_column, lang_column, topics))  # texts are read once
    cells = mixing_probabilities(documents, targets, rate, power, rounds, cut=False)
    whole = F.floor("p")
    copies = whole + (drawn(F.col("doc_id"), seed) < F.col("p") - whole).cast("long")
    return with_probability(documents, cells).select("doc_id", *DIMENSIONS, "n_tokens", "p", copies.alias("copies"), (copies > 0).alias("kept"))

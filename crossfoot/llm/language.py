"""Language identification by a mixture of languages.

Every language has an n-gram distribution, counted over all training rows. A document is a mixture of languages whose
shares are found by expectation-maximisation from its n-gram likelihoods. Starting from all languages, the one with the
smallest share is taken out as long as that lowers the penalised likelihood (BIC), so that a document in one language
gets one language, and a mixed one gets its set with shares.

Defined results: a text that is NULL, empty or without a letter is ``und`` with score 0 and no shares. Ties go to the
language first in order of name. With no training row at all every document is ``und``. Repeated rows stay repeated,
all further columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.llm.grams import append_column, gram_buckets

SIZES, BITS = (3,), 15
UNDETERMINED = "und"
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))),
    ]
)
ARROW_RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))])


@dataclass(frozen=True)
class LanguageModel:
    """Names in order, and the probability of each n-gram bucket (rows) in each language (columns)."""

    names: tuple[str, ...]
    probability: np.ndarray


def train_language_model(docs: DataFrame, trains: Column, text_column: str = "text", lang_column: str = "lang", smoothing: float = 0.5) -> LanguageModel:
    """Count n-grams over all rows where ``trains`` holds. What reaches the driver is bounded by languages x buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                sums = totals.setdefault(lang.as_py(), np.zeros(1 << BITS, np.int64))
                sums += np.bincount(gram_buckets(text.as_py(), SIZES, BITS), minlength=1 << BITS)
        for lang, sums in totals.items():
            seen = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int64()), pa.array(sums[seen])], names=["lang", "bucket", "n"])

    text, lang = docs[text_column], docs[lang_column]
    rows = docs.filter(trains & text.isNotNull() & lang.isNotNull()).select(text.alias("text"), lang.alias("lang"))
    counted = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = tuple(sorted(set(counted["lang"].to_pylist())))
    counts = np.zeros((1 << BITS, len(names)))
    if names:
        counts[counted["bucket"].to_numpy(), np.searchsorted(names, counted["lang"].to_pylist())] = counted["n"].to_numpy()
    smooth = counts + smoothing
    return LanguageModel(names, smooth / smooth.sum(axis=0, keepdims=True))


def fit_shares(likelihood: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Shares of the languages (columns of ``likelihood``) by expectation-maximisation, and the log-likelihood."""
    shares = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    total = counts.sum()
    for _ in range(rounds if len(shares) > 1 else 0):
        shares = shares * (likelihood.T @ (counts / (likelihood @ shares))) / total
    return shares, float(counts @ np.log(likelihood @ shares))


def language_mixture(text: str | None, model: LanguageModel, rounds: int = 15, least_share: float = 0.02) -> tuple[str, float, list[dict]]:
    """Main language, its share, and all languages of the set with their shares."""
    if not text or not model.names or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0, []
    counts = np.bincount(gram_buckets(text, SIZES, BITS), minlength=1 << BITS)
    seen = np.flatnonzero(counts)
    likelihood, counts = model.probability[seen], counts[seen].astype(float)
    shares, _ = fit_shares(likelihood, counts, rounds)
    kept = np.flatnonzero(shares >= min(least_share, shares.max()))
    shares, fit = fit_shares(likelihood[:, kept], counts, rounds)
    price = np.log(counts.sum()) / 2
    while len(kept) > 1:
        fewer = np.delete(kept, np.argmin(shares))
        fewer_shares, fewer_fit = fit_shares(likelihood[:, fewer], counts, rounds)
        if fewer_fit < fit - price:
            break
        kept, shares, fit = fewer, fewer_shares, fewer_fit
    order = np.argsort(-shares, kind="stable")
    found = [{"lang": model.names[kept[i]], "share": float(shares[i])} for i in order]
    return found[0]["lang"], min(1.0, found[0]["share"]), found


def identify_languages(docs: DataFrame, model: LanguageModel, text_column: str = "text", wanted: str = "language") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (lang_pred, score, languages), and the name of that column. No shuffle."""

    def judge(batch: pa.RecordBatch) -> pa.Array:
        found = (language_mixture(text.as_py(), model) for text in batch.column(0))
        return pa.array([{"lang_pred": lang, "score": score, "languages": shares} for lang, score, shares in found], ARROW_RESULT)

    return append_column(docs, [text_column], judge, RESULT, wanted)

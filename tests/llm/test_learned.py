import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.llm.grams import append_column, gram_buckets, held_out
from crossfoot.llm.language import identify_languages, language_mixture, train_language_model
from crossfoot.llm.quality import judge_quality
from crossfoot.llm.toxicity import score_toxicity, train_toxicity
from crossfoot.llm.url_filter import judge_urls, train

ALPHABET = {"aa": "bcdfgaeio", "bb": "mnprstuoy", "cc": "kqvwxzæøå"}


def prose(rng, lang, words):
    return " ".join("".join(rng.choices(ALPHABET[lang], k=rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    return [(i, prose(rng, lang, 40), lang, "s") for i in range(150) for lang in [("aa", "bb", "cc")[i % 3]]]


def test_gram_buckets():
    assert len(gram_buckets("", (3,), 10)) == 0 and len(gram_buckets("ab", (3,), 10)) == 2
    assert gram_buckets("AbC", (2, 3), 12).tolist() == gram_buckets("abc", (2, 3), 12).tolist()


def test_held_out(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_languages(spark, documents, corpus):
    rng = random.Random(4)
    docs = documents(corpus)
    model = train_language_model(docs, ~held_out(docs["doc_id"]))
    assert model.names == ("aa", "bb", "cc")
    mixed = prose(rng, "aa", 200) + " " + prose(rng, "bb", 100)
    lang, score, shares = language_mixture(mixed, model)
    assert lang == "aa" and {s["lang"] for s in shares} == {"aa", "bb"} and 0.5 < score < 0.8
    for text in (None, "", "12 34 !!", "\n\t"):
        assert language_mixture(text, model) == ("und", 0.0, [])
    extra = documents([*corpus, (900, None), (901, "7"), (902, prose(rng, "cc", 30_000), None, None), (902, prose(rng, "cc", 3))], "1 AS language")
    found, name = identify_languages(extra, model)
    assert name != "language" and found.columns[:-1] == extra.columns
    rows = found.selectExpr("doc_id", "lang", f"{name}.lang_pred AS p", f"{name}.score AS s").collect()
    assert len(rows) == len(corpus) + 4
    assert sum(r.p == r.lang for r in rows if r.doc_id < 900) >= len(corpus) - 1
    assert {(r.doc_id, r.p) for r in rows if r.doc_id >= 900} == {(900, "und"), (901, "und"), (902, "cc")}
    assert all(0 <= r.s <= 1 for r in rows)


def test_languages_without_training(documents):
    docs = documents([(1, "abc", None, None)])
    model = train_language_model(docs, F.lit(True))
    assert language_mixture("abc", model) == ("und", 0.0, [])
    assert identify_languages(docs.limit(0), model)[0].count() == 0


def test_toxicity(spark, documents):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(300):
        text = prose(rng, "aa", 60)
        if i % 4 == 0:
            text += rng.choice([" grumpfhead ", " snarlwort "]) + prose(rng, "aa", 30)
        rows.append((i, text))
        labels.append((i, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (1002, "grumpfhead " + prose(rng, "aa", 30_000)), (1003, "x"), (1003, "x")]
    docs = documents(rows, "1 AS score")
    table = spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    model = train_toxicity(docs, table, ~held_out(table["doc_id"]), max_labelled=200)
    scores = score_toxicity(docs, model).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    judged = {r.doc_id: r.score >= 0.5 for r in scores}
    assert sum(judged[i] == bool(t) for i, t in labels) >= 295
    again = train_toxicity(docs, table, ~held_out(table["doc_id"]), max_labelled=200)
    assert again.bias == model.bias and (again.weights == model.weights).all()


def test_toxicity_with_one_label_or_none(spark, documents):
    docs = documents([(1, "a b"), (2, "c")])
    for labels, expected in (([(1, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.0)):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert [round(r.score, 9) for r in score_toxicity(docs, train_toxicity(docs, table, F.lit(True))).collect()] == [expected, expected]


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_ratio(spark, documents):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice(["one two three four five six", "a b", "", " \t", "x y z # $", "é ü"]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "w " * 20_000), (103, "same same"), (103, "same same"), (104, " ".join(f"w{i}" for i in range(3000)))]
    docs = documents(rows, "1 AS words")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, 1)], "doc_id long, quality int")
    out = judge_quality(docs, labels).collect()
    expected = sorted((d, *brute_counts(t)) for d, t in rows)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == expected
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.log_ratio >= -0.2)
    none = judge_quality(docs, labels.limit(0)).collect()
    assert all(abs(r.log_ratio) < 1e-12 for r in none)
    assert judge_quality(docs.limit(0), labels).count() == 0


def test_quality_tells_junk(spark, documents):
    rng = random.Random(6)
    words = [prose(rng, "aa", 1) for _ in range(12)]
    good = [(i, " ".join(rng.choices(words, k=60))) for i in range(200)]
    junk = [(i, " ".join(w + "$$%" for w in rng.choices(words, k=60))) for i in range(200, 240)]
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    kept = {r.doc_id for r in judge_quality(documents(good + junk), labels).collect() if r.kept}
    assert kept == set(range(200))


def test_urls(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?y#z"), (2, "https://example.com/de/1"), (3, "https://sub.example.com/de"), (4, "ftp://x.org/fr/"), (5, "http://net/"),
        (6, "http://net"), (7, None), (8, "no scheme"), (9, ""), (10, "http://casino-bonus.example.com/slots"), (11, "http://notexample.net/en/"), (11, "http://notexample.net/en/"),
        (None, "x://y.org/de?://net/"), (12, "http://h.org/" + "a" * 50_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS verdict")
    out = judge_urls(pages).collect()
    assert len(out) == len(rows)
    found = {r.page_id: (r.host, r.path[:9], r.rule, r.verdict) for r in out}
    assert found[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[2] == ("example.com", "/de/1", "example.com/de/", "block")
    assert found[3] == ("sub.example.com", "/de", None, "allow")
    assert found[4] == ("x.org", "/fr/", "org/fr/", "allow")
    assert found[5] == ("net", "/", "net/", "block") and found[6][:3] == ("net", "", None)
    assert found[7][:3] == found[8][:3] == found[9][:3] == ("", "", None)
    assert found[10][3] == "block" and found[11][2:] == ("net/", "block") and found[None][:2] == ("y.org", "/de")
    bias = train().bias
    assert {r.model_score for r in out if r.page_id in (7, 8, 9)} == {bias}


def test_added_columns_are_made_in_small_batches(spark):
    """A task holds the texts and results of few rows at once, whatever Arrow batches it is sent."""
    docs = spark.range(1800).selectExpr("id AS doc_id", "string(id) AS text").repartition(1)
    out, name = append_column(docs, ["text"], lambda batch: pa.array([f"{t}/{batch.num_rows}" for t in batch.column(0).to_pylist()]), T.StringType(), "made")
    rows = [(r.doc_id, *map(int, r[name].split("/"))) for r in out.collect()]
    assert sorted(r[0] for r in rows) == list(range(1800)) and all(r[0] == r[1] for r in rows)
    assert max(r[2] for r in rows) <= 500

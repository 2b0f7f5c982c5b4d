import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from crossfoot.llm.mixing import DIMENSIONS, TOLERANCE, described, mix_sources, mixing_probabilities, mixing_residuals
from crossfoot.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op5_ngram_join", "op7_line_dedup", "op10_url_filter", "op13_hard_negatives"])
def test_query_equals_sql(spark, checkpoint_folder, duck, sf_dir, name):
    assert compare(spark, duck, sf_dir, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} | {"pipeline"} == {q if q == "pipeline" else q.split("_")[0] + "_" for q in QUERIES}
    assert set(QUERIES) <= set(entry.queries())


def rows_for_mixing():
    rng = random.Random(1)
    texts = ["a short sentence.", "All rights reserved. more words here", "mail me@example.org now", "x | y | z | w |", "no end", None, "word " * 5000]
    return [(i, rng.choice(texts), rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", None])) for i in range(400)]


def brute_rake(cells, shares, rate, rounds):
    p = {c: rate for c in cells}
    aim = rate * sum(cells.values())
    for _ in range(rounds):
        for k in range(3):
            for value, share in shares[k].items():
                own = [c for c in cells if c[k] == value]
                now = sum(p[c] * cells[c] for c in own)
                for c in own:
                    p[c] = min(1.0, p[c] * (share * aim / now if now else 1.0))
    return p


def test_mixing_equals_brute_force(documents):
    docs = documents(rows_for_mixing(), "1 AS topic")
    documents_ = described(docs, "doc_id", "text", "source", "lang", corpus_pipeline.mix_sources.__globals__["TOPICS"])
    cells = {tuple(r[d] for d in DIMENSIONS): r.t for r in documents_.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("t")).collect()}
    shares = []
    for k in range(3):
        sums = {}
        for c, t in cells.items():
            sums[c[k]] = sums.get(c[k], 0) + t
        raised = {v: t**0.8 for v, t in sums.items()}
        shares.append({v: t / sum(raised.values()) for v, t in raised.items()})
    expected = brute_rake(cells, shares, 0.5, 6)
    found = {tuple(r[d] for d in DIMENSIONS): r.p for r in mixing_probabilities(documents_, rate=0.5).collect()}
    assert found.keys() == expected.keys()
    np.testing.assert_allclose([found[c] for c in expected], list(expected.values()), rtol=1e-9)
    assert all(0 <= p <= 1 for p in found.values())


def test_mixing_follows_targets(documents):
    rows = [(i, "one two three four.", "en" if i % 2 else "de", "s1" if i % 4 else "s2") for i in range(4000)]
    out = mix_sources(documents(rows), targets={"source": {"s1": 0.5, "s2": 0.5, "s3": 0.7}}, rate=0.3)
    kept = {r.source: r.n for r in out.filter("kept").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert abs(kept["s1"] / (kept["s1"] + kept["s2"]) - 0.5) < 0.05 and set(kept) == {"s1", "s2"}
    assert mix_sources(documents(rows), targets={"lang": {"en": 1.0}}, rate=0.3).filter("kept AND lang = 'de'").count() == 0
    assert mix_sources(documents(rows).limit(0)).count() == 0


def test_mixing_meets_targets_at_production_parameters(documents):
    docs = documents(rows_for_mixing())
    described_ = described(docs, "doc_id", "text", "source", "lang", corpus_pipeline.mix_sources.__globals__["TOPICS"])
    total = described_.agg(F.sum("n_tokens")).first()[0]
    told = mixing_residuals(described_).collect()
    assert {r.dimension for r in told} == set(DIMENSIONS)
    assert all(abs(r.expected - r.target) <= 1.01 * TOLERANCE * r.target and r.expected_once <= r.expected * (1 + 1e-9) for r in told)
    out = mix_sources(docs)
    assert out.filter("kept <> (copies > 0) OR copies < floor(p) OR copies > ceil(p)").count() == 0
    for dimension in DIMENSIONS:
        expected = {r.value: r.t for r in out.groupBy(F.col(dimension).alias("value")).agg(F.sum(F.col("p") * F.col("n_tokens")).alias("t")).collect()}
        raised = {r.value: r.t**0.8 for r in described_.groupBy(F.col(dimension).alias("value")).agg(F.sum("n_tokens").alias("t")).collect()}
        for value, part in raised.items():
            assert abs(expected[value] / (0.8 * total * part / sum(raised.values())) - 1) <= 1.01 * TOLERANCE


def test_stages(spark, documents, sf_dir):
    rng = random.Random(7)

    def prose(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n))

    base = prose("abcde", 80)
    rows = [(i, prose("abcde" if i % 2 else "xyzuv", 60), "aa" if i % 2 else "bb", f"s{i % 3}") for i in range(60)]
    rows += [(100, base, "aa", "s0"), (101, base + " more", "aa", "s0"), (101, base + " more", "aa", "s0"), (102, None, None, None), (103, "77 88", "aa", None), (None, prose("abcde", 50), "aa", "s1")]
    docs = documents(rows, "length(text) AS n_chars").selectExpr("*", "1 AS component_id", "2 AS place", "3 AS language", "true AS kept")
    one = corpus_pipeline.identify(spark, docs, sf_dir)
    assert one.columns == docs.columns and {r[0] for r in rows} - {r.doc_id for r in one.collect()} == {102, 103}
    two = corpus_pipeline.drop_lines(spark, one, sf_dir)
    assert two.schema == docs.schema and 101 not in {r.doc_id for r in two.collect()}
    three = corpus_pipeline.drop_near_duplicates(spark, one, sf_dir)
    ids = [r.doc_id for r in three.collect()]
    assert three.columns == docs.columns and 101 not in ids and 100 in ids and None in ids and len(ids) == len(set(ids)) == 62
    four = corpus_pipeline.mix(spark, three, sf_dir)
    kept = {r.doc_id for r in mix_sources(three).filter("kept").collect()}
    assert four.columns == docs.columns and {r.doc_id for r in four.collect()} == kept
    five = corpus_pipeline.encode(spark, four, sf_dir)
    assert five.count() == len(kept)


def test_run(spark, checkpoint_folder, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert 0 < out.count() < documents and out.select("doc_id").distinct().count() == out.count()
    assert "corpus_pipeline" in sys.modules


def test_lines_stage_drops_short_copies(spark, documents, sf_dir):
    docs = documents([(1, "Licensed freely.\nfirst"), (2, "second\nlicensed FREELY."), (3, "first")])
    out = corpus_pipeline.drop_lines(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "Licensed freely.\nfirst"), (2, "second")]

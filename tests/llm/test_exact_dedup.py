import hashlib
import re

from crossfoot.llm.exact_dedup import mark_exact_duplicates


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, (_, t) in enumerate(rows)}
    found = []
    for i, (doc_id, text) in enumerate(rows):
        same = [k for k in norm if norm[k] == norm[i]]
        best = min(same, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0, k))
        found.append((doc_id, rows[best][0], len(same), hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(found, key=repr)


def test_equal_to_brute_force_over_many_runs(spark, documents):
    texts = ["a b", "ab", " a\tb\n", "x" * 5000, "x" * 5000 + " ", None, "", "é", "é", " "]
    rows = [(i, texts[i % len(texts)]) for i in range(120)] + [(None, "ab"), (3, "ab")]
    for parts, fan_in in ((1, 16), (9, 2), (40, 3)):
        docs = documents(rows).repartition(parts, "doc_id")
        out = mark_exact_duplicates(docs, fan_in=fan_in).collect()
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out], key=repr) == brute(rows)
        kept = [r for r in out if r.kept]
        assert len(kept) == len({r.text_sha256 for r in out})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_repeated_rows_keep_one(documents):
    out = mark_exact_duplicates(documents([(1, "a"), (1, "a"), (1, "a")])).collect()
    assert [r.group_size for r in out] == [3, 3, 3] and sum(r.kept for r in out) == 1


def test_empty_table_and_clashing_columns(spark, documents):
    assert mark_exact_duplicates(documents([(1, "a")]).limit(0)).count() == 0
    docs = documents([(1, "a"), (2, "a")], "7 AS keep_id").selectExpr("*", "1 AS run", "2 AS sha", "3 AS best", "4 AS kept")
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in mark_exact_duplicates(docs).collect()) == [(1, 1, True), (2, 1, False)]

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from crossfoot.llm.components import connected_components
from crossfoot.llm.line_dedup import PART_LINES, candidates, dedup_lines, duplicate_lines, line_table, meeting_rows, token_counts
from crossfoot.llm.ngram_join import band_keys, largest_difference, near_duplicates
from crossfoot.llm.words import shingle_sets


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(s), find(d)) for d, s in sets)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(rng.choices(words, k=60))
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([1, 3, 5, 6, 9, 20, 63, 64, 65, 150]))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 18))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy += rng.choices(words, k=len(base) // 9)
            rows.append(" ".join(copy))
    rows += [f"{passage} {' '.join(rng.choices(words, k=rng.randint(8, 40)))}" for _ in range(30)]
    rows += ["Same Text here", "same text HERE", "same\ttext\nhere", "", None, " \n", "É x", "é x"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_shingle_sets(corpus):
    assert [len(s) for s in shingle_sets(t or "" for _, t in corpus)] == [len(shingles(t)) for _, t in corpus]


def test_near_duplicates_equal_brute_force(documents, corpus):
    out = near_duplicates(documents(corpus, "1 AS key").repartition(7))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == brute_components(corpus)


def test_near_duplicates_of_chains_and_copies(documents):
    words = [f"v{i}" for i in range(140)]
    chain = [(100 - k, " ".join(words[2 * k : 2 * k + 60])) for k in range(30)]  # neighbours are similar, ends are not
    copies = [(1000 + k, " ".join([*words[:50], f"x{k % 40}"])) for k in range(300)]
    rows = chain + copies + [(5000, "u " * 30_000), (5001, "u " * 20_000)]
    out = near_duplicates(documents(rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == brute_components(rows)


def test_near_duplicates_edge_cases(documents):
    assert near_duplicates(documents([(1, "a")]).limit(0)).count() == 0
    out = near_duplicates(documents([(None, "a b c"), (2, "a b c"), (2, "a b c"), (1, "a b c")])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == [("1", 1, "1"), ("2", 1, "1"), ("2", 1, "1"), ("None", 1, "None")]


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(0)
    for size in (1, 2, 3, 7, 31, 32, 33, 90, 400):
        for _ in range(40):
            union = rng.integers(0, 1 << 63, size + max(1, size // 3), np.uint64)
            both = union[: -(-len(union) * 3 // 4)]
            rest = union[len(both) :]
            cut = rng.integers(0, len(rest) + 1)
            a, b = np.unique(np.r_[both, rest[:cut]]), np.unique(np.r_[both, rest[cut:]])
            bands = [{(len(s) - 1).bit_length(), (len(s) - 1).bit_length() + (len(s) * 4 // 3 > 1 << (len(s) - 1).bit_length())} for s in (a, b)]
            counts = [np.where(s % np.uint64(3) == 0, 50, 0) for s in (a, b)]
            for ca, cb in ((None, None), counts):
                assert any(np.intersect1d(band_keys(a, ca, k), band_keys(b, cb, k)).size for k in bands[0] & bands[1])
    assert largest_difference(3, 4) == 1


def test_components(spark, checkpoint_folder):
    links = [(i, i + 1) for i in range(0, 60)] + [(200, 100), (100, 150), (7, 7)]
    out = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in out) == [(i, 0) for i in range(61)] + [(100, 100), (150, 100), (200, 100)]
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows, threshold, least=1):
    lines = [(d, i, x, set(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x)))) for d, t in rows if t is not None for i, x in enumerate(t.split("\n"))]
    lines.sort(key=lambda x: x[:2])
    gone = {(d, i) for k, (d, i, _, s) in enumerate(lines) if len(s) >= least and any(len(s & t) >= threshold * len(s | t) for _, _, _, t in lines[:k] if len(t) >= least)}
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}


def test_line_dedup_equals_brute_force(documents):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "The"] * 8
    pool = [rng.choices(words, k=rng.randint(3, 25)) for _ in range(25)]

    def line():
        copy = list(rng.choice(pool))
        if rng.random() < 0.5:
            copy[rng.randrange(len(copy))] = rng.choice(words)
        return rng.choice([" ", "  "]).join(copy)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 8)))) for i in range(60)] + [(100, None), (101, ""), (102, "\n\n"), (103, " ".join(f"z{i}" for i in range(9000)))]
    for threshold in (Fraction(4, 5), Fraction(1, 2), Fraction(1)):
        out, name = dedup_lines(documents(rows, "1 AS removed_lines").repartition(5), threshold=threshold)
        assert name == "removed_lines_" and out.columns.count("text") == 1
        assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows, threshold)


def test_line_dedup_edge_cases(documents):
    text = "one two three four five six seven eight nine"
    out, name = dedup_lines(documents([(None, text), (2, text), (2, text), (3, f"{text}\nshort line\n{text.upper()} ten"), (4, "short line")]))
    assert sorted((str(r.doc_id), r.text, r[name]) for r in out.collect()) == [("2", text, []), ("2", text, []), ("3", "short line", [0, 2]), ("4", "", [0]), ("None", text, [])]
    assert dedup_lines(documents([(1, "a")]).limit(0))[0].count() == 0


def test_line_dedup_finds_a_changed_word_in_the_middle(documents):
    text = "one two three four five six seven eight nine ten eleven"
    out, _ = dedup_lines(documents([(1, text), (2, text.replace("six", "other"))]))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, text), (2, "")]


def test_line_dedup_of_short_lines(documents):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(6)]
    rows = [(i, "\n".join(" ".join(rng.choices(words, k=rng.randint(0, 7))) for _ in range(6))) for i in range(20)]
    out, _ = dedup_lines(documents(rows).repartition(3))
    assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows, Fraction(4, 5))


def test_line_dedup_of_frequent_tokens_in_parts(documents):
    """Tokens dealt to squares of parts: every two lines still meet once."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(9)]
    rows = [(i, "\n".join(" ".join(rng.sample(words, k=rng.randint(3, 7))) for _ in range(5))) for i in range(40)]
    for part_lines in (1, 7, 50):
        gone = duplicate_lines(documents(rows).repartition(3), part_lines=part_lines).distinct().collect()
        texts = brute_lines(rows, Fraction(4, 5))
        assert len(gone) == sum(t.count("\n") + 1 for _, t in rows) - sum(t.count("\n") + 1 if t else 0 for t in texts.values())


def test_line_dedup_of_long_lines_around_the_limits_of_parities(documents):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(700)]
    rows = []
    for size in (80, 95, 96, 110, 170, 191, 192, 230, 400):
        base = rng.sample(words, size)
        for changed in (0, size // 10, size // 9, size // 8):
            rows.append((len(rows), " ".join(rng.sample(base, size - changed) + [f"x{rng.randrange(9)}" for _ in range(changed)])))
            rows.append((len(rows), " ".join(base[: size - 2 * changed])))
    out, _ = dedup_lines(documents(rows).repartition(3))
    assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows, Fraction(4, 5))


def test_long_lines_of_common_words_are_no_candidates(documents):
    """Lines that share rare words but little else: pairs of them, which grow with the square of a word's lines, need no texts."""
    rng = random.Random(9)
    common, rare = [f"w{i}" for i in range(900)], [f"r{i}" for i in range(20)]
    for size in (150, 250, 300):
        texts = documents([(i, " ".join(rng.sample(common, size) + rare)) for i in range(30)]).select("doc_id", "text")
        counts = token_counts(texts)
        meetings = meeting_rows(line_table(texts, counts, Fraction(4, 5)), counts, PART_LINES)
        assert candidates(meetings, Fraction(4, 5), every=True).count() == 0


def thue_morse(bits, a, b):
    word = a
    other = b
    for _ in range(bits):
        word, other = word + other, other + word
    return word, other


def test_long_words_of_regular_build_stay_apart(documents):
    """Words that polynomials modulo a power of two cannot tell apart."""
    pairs = [thue_morse(bits, a, b) for bits in (10, 12) for a, b in ("ab", "cd", "ef", "gh")]
    one, two = (" ".join(p[k] for p in pairs) for k in (0, 1))
    out, name = dedup_lines(documents([(1, one), (2, two), (3, one)]))
    assert sorted((r.doc_id, r.text, r[name]) for r in out.collect()) == [(1, one, []), (2, two, []), (3, "", [0])]
    linked = near_duplicates(documents([(1, one), (2, two), (3, one)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in linked) == [(1, 1), (2, 2), (3, 1)]

import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa

from crossfoot.llm.bpe import bpe_encode_decode
from crossfoot.llm.line_dedup import PART_LINES, VISIT, line_table, meeting_rows, token_counts
from crossfoot.llm.words import BASE, BYTE_CODE, document_words, mix


def test_word_hashes_are_polynomials_of_their_bytes():
    rng = random.Random(3)
    group = ["".join(rng.choices("aZé \t\n\x0b\u0085", k=n)).encode() for n in range(40)]
    hashes, ends = document_words(group)
    words = [g.lower().split() for g in group]
    assert ends.tolist() == np.cumsum([len(w) for w in words]).tolist()
    codes = [sum(int(BYTE_CODE[b]) * pow(BASE, k, 1 << 64) for k, b in enumerate(word)) % (1 << 64) for w in words for word in w]
    assert hashes.tolist() == mix(np.array(codes, np.uint64)).tolist()


def test_visits_travel_in_blocks(documents):
    """One row per part of the keys and batch of lines, not one per line and token."""
    rng = random.Random(4)
    texts = documents([(i, " ".join(rng.sample([f"w{k}" for k in range(400)], 60))) for i in range(200)]).select("doc_id", "text").coalesce(1)
    counts = token_counts(texts)
    blocks = meeting_rows(line_table(texts, counts, Fraction(4, 5)), counts, PART_LINES).collect()
    assert sum(len(np.frombuffer(b.visits, VISIT)) for b in blocks) == 200 * 13
    assert len(blocks) == 1


def test_copies_of_a_common_line_do_not_meet(documents):
    texts = documents([(i, "Always the same line\nalways the same line") for i in range(50)]).select("doc_id", "text").coalesce(1)
    lines = line_table(texts, token_counts(texts), Fraction(4, 5)).collect()
    assert len(lines) == 100 and len({bytes(x.digest) for x in lines}) == 100
    assert [(x.doc_id, x.line) for x in lines if not x.copy] == [(0, 0)]
    assert all(not x.tokens for x in lines if x.copy)


def test_repeated_rows_are_no_copies_of_each_other(documents):
    texts = documents([(7, "one line\nanother one")] * 3).select("doc_id", "text").coalesce(1)
    assert not any(x.copy for x in line_table(texts, token_counts(texts), Fraction(4, 5)).collect())


def test_encoded_rows_are_handed_back_in_small_batches(documents, monkeypatch):
    docs = documents([(1, "a")])
    taken = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, make, schema: taken.append(make))
    bpe_encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    rows = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array([f"text {i}" for i in range(1200)])], names=["doc_id", "text"])
    made = list(taken[0](iter([rows])))
    assert [b.num_rows for b in made] == [500, 500, 200]
    assert pa.Table.from_batches(made).column("decoded").to_pylist() == rows.column("text").to_pylist()

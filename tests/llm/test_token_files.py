import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from crossfoot.llm.token_files import STEP, Codebook, code_lengths, new_token_folder, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def huffman_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n in (2, 3, 17, 300):
        counts = rng.zipf(1.3, n).clip(1, 10**6)
        free = code_lengths(counts, 40)
        assert int((free * counts).sum()) == huffman_cost(counts.tolist())
        limit = int(n - 1).bit_length() + 1
        tight = code_lengths(counts, limit)
        assert tight.max() <= limit and sum(2.0 ** -float(x) for x in tight) == 1.0
    assert code_lengths(np.array([5]), 8).tolist() == [1]


@pytest.mark.parametrize("sizes", [[1], [STEP], [STEP + 1, 3, 5 * STEP, 1], [700] * 9])
def test_codebook_round_trip(sizes):
    rng = np.random.default_rng(2)
    ids = rng.zipf(1.2, sum(sizes)) % 5000
    values, counts = np.unique(ids, return_counts=True)
    book = Codebook(values, code_lengths(counts, 16))
    payload, n_bytes, at = book.encode(ids, np.array(sizes))
    firsts = np.cumsum(sizes) - sizes
    marks = np.concatenate([at[f : f + s : STEP] for f, s in zip(firsts, sizes, strict=True)])
    assert book.decode(payload, marks, np.array(sizes)).tolist() == ids.tolist() and n_bytes.sum() == len(payload)


def test_files(spark, documents):
    library = Library.from_file(PATH)
    rows = [(i, f"text {i} " * (i % 7) * 50) for i in range(40, 0, -1)] + [(100, None), (101, ""), (102, "word " * 60_000), (7, "again")]
    path = new_token_folder(spark)
    write_token_files(documents(rows, "1 AS start").repartition(5), path, PATH)
    out = read_token_files(spark, path).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    start = 0
    for r in sorted(out, key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4")
        texts = [t or "" for d, t in rows if d == r.doc_id]
        assert ids.tolist() in [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(r.ids))
        start += len(ids)
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == sorted(r[0] for r in rows)


def test_empty_table(spark, documents):
    path = new_token_folder(spark)
    write_token_files(documents([(1, "a")]).limit(0), path, PATH)
    assert read_token_files(spark, path).count() == 0

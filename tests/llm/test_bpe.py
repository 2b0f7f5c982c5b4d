import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from crossfoot.llm.bpe import Tokenizer, bpe_encode_decode, read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(read_tokenizer(PATH)[0])


def check(library, tokenizer, texts):
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == np.array(expected, "<u4").tobytes(), text[:60]
        assert tokenizer.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_odd_texts(library, tokenizer):
    check(library, tokenizer, [
        "", " ", "\n", "a\n", "\na", "a  b", "a \n b", "  x", " \n\n x  ", "don't we'll I'M she'd've", "x\ty\r\nz", "\0 a\0", "a" * 5000,
        "ab" * 3000 + " é́", "日本語 テキスト 123٣4", "😀😀 fin‍", "<|endoftext|> a<|endoftext|><|endoftext|>b ", "a<|endoftext|", "a\u0085b 　 c",
        "\0special\0<|endoftext|>", "thething. thething, (thething)", "word" + "!" * 40, "é" * 31 + "a", "x" * 33,
    ])


def test_random_texts(library, tokenizer):
    random.seed(5)
    letters = ["a", "b", " ", " ", "'s", "l", "é", "\n", "\t", "1", "٣", ",", ".", "!", "日", "<|endoftext|>", "\0", "　", "the", "ing"]
    check(library, tokenizer, ["".join(random.choices(letters, k=random.randint(0, 30))) for _ in range(4000)])


def test_long_and_short_trees_agree(tokenizer):
    for word in ("retitioning", " thorreou", "aaaaaaaaaaaaaaaa", "ABCabcABCabc"):
        raw = word.encode()
        row = np.zeros((1, 16), np.uint8)
        row[0, : len(raw)] = list(raw)
        ids, counts = tokenizer.merge_many(row, np.array([len(raw)]))
        assert ids.tolist() == tokenizer.merge(raw) and counts.tolist() == [len(ids)]


def test_operator(documents, library):
    rows = [(1, "The cat sat."), (2, None), (3, ""), (3, ""), (None, "x " * 40_000)]
    out = bpe_encode_decode(documents(rows, "1 AS n_tokens"), PATH).collect()
    assert len(out) == 5
    for r, (_, text) in zip(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0)), rows, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.decoded == (text or "")
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe_encode_decode(documents(rows).limit(0), PATH).count() == 0

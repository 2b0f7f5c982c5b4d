import base64
import codecs
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from crossfoot.llm import byte_bpe
from crossfoot.llm.byte_bpe import CharacterStream, Merger, RankTokenizer, Transducer, parse_ranks, rank_encode_decode, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH) as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    content, hidden, _ = read_ranks(PATH)
    return RankTokenizer(parse_ranks(content), hidden, public_tokenizers.PATTERN)


def check(library, tokenizer, texts):
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:60]
        assert tokenizer.decode(ids) == text


def test_odd_texts(library, tokenizer):
    check(library, tokenizer, [
        "", " ", "\n", "a\n", "a  b", " \n\n x  ", "don't we'll I'M", "x\ty\r\nz", "\0 a\0", "a" * 30_000, "ab" * 3000 + " é́",
        "日本語 テキスト 123٣4", "😀😀 fin‍", "<|endoftext|> a<|endoftext|>", "a\u0085b 　 c", "\0special\0<|endoftext|>", "word" + "!" * 400,
    ])


def test_random_texts(library, tokenizer):
    random.seed(6)
    letters = ["a", "b", " ", " ", "'s", "l", "é", "\n", "\t", "1", "٣", ",", ".", "!", "日", "<|endoftext|>", "\0", "　", "the", "ing", "--", "=="]
    check(library, tokenizer, ["".join(random.choices(letters, k=random.randint(0, 30))) for _ in range(3000)])
    check(library, tokenizer, ["".join(random.choices("etaoinshrdlu", k=20_000))])


def test_other_pattern(library):
    content, hidden, _ = read_ranks(PATH)
    ranks = {t: i for i, t in enumerate(parse_ranks(content))}
    other = tiktoken.Encoding("other", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    check(other, RankTokenizer(parse_ranks(content), hidden, r"\S+|\s+"), ["one two,three  'tis", "x" * 500 + " y", ""])


def small_vocabulary(merged):
    return [bytes([b]) for b in range(256)] + merged


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=5).map(str.encode), max_size=25, unique=True), st.lists(st.text("abc", max_size=12).map(str.encode), max_size=8))
def test_any_ranks_equal_plain_merging(merged, pieces):
    """Ranks in any order, tokens that merging never reaches included."""
    tokens = small_vocabulary(merged)
    merger = Merger({t: i for i, t in enumerate(tokens)})
    hidden = frozenset(i for i, t in enumerate(tokens) if len(merger.merge(t)) > 1)
    transducer = Transducer(tokens, hidden)
    for piece in pieces:
        expected = [tokens.index(piece)] if piece in tokens else [tokens.index(t) for t in merger.merge(piece)]
        assert transducer.encode(piece) == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=5).map(str.encode), max_size=25, unique=True), st.lists(st.text("abc", max_size=40), max_size=30, unique=True), st.sampled_from([20, 1000]))
def test_pieces_in_step_equal_plain_merging(merged, pieces, most):
    """Empty and long pieces, tokens that merging never reaches and tables that are dropped included."""
    tokens = small_vocabulary(merged)
    merger = Merger({t: i for i, t in enumerate(tokens)})
    hidden = frozenset(i for i, t in enumerate(tokens) if len(merger.merge(t)) > 1)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(byte_bpe, "MOST_STATES", most)
        patch.setattr(byte_bpe, "IN_STEP", 12)
        ids, starts, counts = RankTokenizer(tokens, hidden, public_tokenizers.PATTERN).merge_distinct(pa.array(pieces, pa.large_string()))
    for piece, start, count in zip(map(str.encode, pieces), starts, counts, strict=True):
        expected = [tokens.index(piece)] if piece in tokens else [tokens.index(t) for t in merger.merge(piece)]
        assert ids[start : start + count].tolist() == expected


def test_moves_are_shared_by_many_words(library, monkeypatch):
    """A move is far dearer than a byte that follows a known one, so words of the same parts have to share them."""
    monkeypatch.setattr(byte_bpe, "MOST_STATES", 5_000)
    content, hidden, _ = read_ranks(PATH)
    fresh = RankTokenizer(parse_ranks(content), hidden, public_tokenizers.PATTERN)
    made, single, move, encode = [], [], Transducer.move, Transducer.encode
    monkeypatch.setattr(Transducer, "move", lambda self, state, byte: made.append(byte) or move(self, state, byte))
    monkeypatch.setattr(Transducer, "encode", lambda self, piece: single.append(piece) or encode(self, piece))
    random.seed(8)
    parts = "th he an in er on re nd at ou ea ti is or ha es".split()
    words = [" " + "".join(random.choices(parts, k=random.randint(2, 7))) for _ in range(8_000)]
    check(library, fresh, ["".join(words)])
    assert len(made) < 30_000  # 34,030 while subsets carried the tokens they owed
    assert not single


def test_tables_are_dropped_and_made_again(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_STATES", 50)
    monkeypatch.setattr(byte_bpe, "MOST_PAIRS", 50)
    content, hidden, _ = read_ranks(PATH)
    fresh = RankTokenizer(parse_ranks(content), hidden, public_tokenizers.PATTERN)
    random.seed(7)
    check(library, fresh, ["".join(random.choices("abcdefgh ing", k=3000)), "q" * 2000, "".join(random.choices("xyz", k=4000))])
    assert len(fresh.transducer.subsets) <= 102


def test_a_vocabulary_lacks_no_byte():
    with pytest.raises(ValueError, match="every byte"):
        Transducer([b"a", b"b"], frozenset())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=30), st.text(max_size=12).map(str.encode)), st.lists(st.integers(0, 30), max_size=6))
def test_characters_arrive_as_soon_as_they_are_whole(data, cuts):
    stream, standard = CharacterStream(), codecs.getincrementaldecoder("utf-8")("replace")
    bounds = sorted({0, len(data), *(min(c, len(data)) for c in cuts)})
    for a, b in zip(bounds, bounds[1:], strict=False):
        assert stream.feed(data[a:b]) == standard.decode(data[a:b])
    assert stream.close() == standard.decode(b"", True)


def test_operator(documents, library):
    rows = [(1, "The cat sat."), (2, None), (3, ""), (3, ""), (None, "x " * 40_000), (5, "日" * 70_000)]
    out = rank_encode_decode(documents(rows, "1 AS n_tokens"), PATH, public_tokenizers.PATTERN).collect()
    assert len(out) == 6
    for r, (_, text) in zip(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        ids = library.encode_ordinary(text or "")
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, text or "")
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert rank_encode_decode(documents(rows).limit(0), PATH, public_tokenizers.PATTERN).count() == 0

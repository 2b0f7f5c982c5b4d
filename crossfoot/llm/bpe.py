"""Byte-level BPE encoding and decoding with a segment tree over the ranks of neighbouring pairs.

Texts are cut into pieces by the tokenizer's pattern, and each distinct piece of a group of texts is merged once: the
leaves of a segment tree hold (rank, place) of every neighbouring pair, the root is the leftmost pair of lowest rank,
and a merge touches three leaves, each a logarithmic update, until no pair can be merged. The trees of short pieces are
worked on in step, as columns of one array; a long piece has a tree of its own.

The tokenizer file is read once on the driver and travels with the tasks, which bounds what is sent by the size of a
vocabulary; executors need no copy of the file.

Defined results: NULL and empty texts have no ids and decode to the empty text. Strings of special tokens in a text
become their own id, as the file says. Repeated rows stay repeated, further columns are not used, an empty table gives
an empty result. Texts are handled whole; ``GROUP_CHARS`` only says after how many characters a group of texts ends.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crossfoot.llm.grams import BATCH_ROWS

NONE = 1 << 62
WIDEST, BLOCK = 32, 8192
GROUP_CHARS = 4_000_000
SPECIAL = "\0special\0"
# Fixed value: the pattern that byte-level tokenizers of this kind cut texts with.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in a byte-level vocabulary: visible Latin-1 as is, the others from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """Tables of one tokenizer file, with the pieces merged so far."""

    def __init__(self, content: str) -> None:
        data = json.loads(content)
        letters = byte_letters()
        vocabulary = data["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        size = max([*vocabulary.values(), *self.specials.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.specials.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = [0] * 256
        for letter, b in letters.items():
            self.byte_id[b] = vocabulary[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.rank = {(vocabulary[a] << 32) | vocabulary[b]: r for r, (a, b) in enumerate(merges)}
        self.merged = [vocabulary[a + b] for a, b in merges]
        self.pair_keys = np.array(sorted(self.rank), np.int64)
        self.pair_ranks = np.array([self.rank[k] for k in self.pair_keys.tolist()], np.int64)
        self.merged_ids, self.byte_ids = np.array(self.merged, np.int64), np.array(self.byte_id, np.int64)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length."""
        ids = [self.byte_id[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        rank, merged = self.rank, self.merged
        width = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NONE] * (2 * width)
        for i in range(n - 1):
            r = rank.get((ids[i] << 32) | ids[i + 1])
            if r is not None:
                tree[width + i] = (r << 32) | i
        for i in range(width - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left < right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != NONE:
            at = root & 0xFFFFFFFF
            gone = after[at]
            ids[at] = symbol = merged[root >> 32]
            ids[gone] = -1
            follower, previous = after[gone], before[at]
            after[at] = follower
            r = None
            if follower < n:
                before[follower] = at
                r = rank.get((symbol << 32) | ids[follower])
            changes = [(at, NONE if r is None else (r << 32) | at)]
            if gone < n - 1:
                changes.append((gone, NONE))
            if previous >= 0:
                r = rank.get((ids[previous] << 32) | symbol)
                changes.append((previous, NONE if r is None else (r << 32) | previous))
            for leaf, key in changes:
                node = width + leaf
                if tree[node] == key:
                    continue
                tree[node] = key
                while node > 1:
                    other = tree[node ^ 1]
                    node >>= 1
                    least = key if key < other else other
                    if tree[node] == least:
                        break
                    tree[node] = key = least
        return [i for i in ids if i >= 0]

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it cannot be merged or one side is -1."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def merge_many(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces, one after the other, and their number per piece: one segment tree each, in step.

        ``raw`` holds a piece per row, padded to a power of two. Arrays are laid out node by node; row ``width`` of
        ``ids``, ``after`` and ``before`` stands for "no symbol".
        """
        count, width = raw.shape
        levels = width.bit_length() - 1
        places = np.arange(width)[:, None]
        ids = np.full((width + 1, count), -1, np.int64)
        ids[:width] = np.where(places < sizes, self.byte_ids[raw.T], -1)
        after = np.repeat(np.arange(1, width + 2), count)
        before = np.repeat(np.r_[width, np.arange(width)], count)
        tree = np.full((2 * width, count), NONE, np.int64)
        rank = self.pair_rank(ids[:width], ids[1:])
        tree[width:] = np.where(rank == NONE, NONE, (rank << levels) | places)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])
        ids, tree = ids.ravel(), tree.ravel()
        live = np.flatnonzero(tree[count : 2 * count] != NONE)
        while len(live):
            root = tree[count + live]
            at, symbol = root & (width - 1), self.merged_ids[root >> levels]
            gone = after[at * count + live]
            follower, previous = after[gone * count + live], before[at * count + live]
            ids[at * count + live] = symbol
            ids[gone * count + live] = -1
            after[at * count + live] = follower
            before[follower * count + live] = at
            own, prior = self.pair_rank(symbol, ids[follower * count + live]), self.pair_rank(ids[previous * count + live], symbol)
            columns = np.tile(live, 3)
            nodes = width + np.concatenate([at, gone, np.where(previous < width, previous, gone)])
            nothing = np.full(len(live), NONE)
            keys = np.where(own == NONE, NONE, (own << levels) | at), nothing, np.where(prior == NONE, NONE, (prior << levels) | previous)
            tree[nodes * count + columns] = np.concatenate(keys)
            for _ in range(levels):
                nodes >>= 1
                below = 2 * nodes * count + columns
                tree[nodes * count + columns] = np.minimum(tree[below], tree[below + count])
            live = live[tree[count + live] != NONE]
        ids = ids.reshape(width + 1, count).T
        kept = ids >= 0
        return ids[kept], kept.sum(axis=1)

    def merge_distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces as (all ids, where each piece starts, how many it has)."""
        data, begins, sizes = ragged(pieces)
        counts, starts, parts, total = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [], 0
        # A piece of one byte takes part as one of two: its tree has a single, empty leaf.
        widths = np.where(sizes > WIDEST, 0, 2 ** np.ceil(np.log2(np.clip(sizes, 2, None))).astype(np.int64))
        for width in np.unique(widths).tolist():
            chosen = np.flatnonzero(widths == width)
            for some in np.split(chosen, range(BLOCK, len(chosen), BLOCK)):
                if width:
                    raw = data[np.minimum(begins[some][:, None] + np.arange(width), len(data) - 1)] if len(data) else np.zeros((len(some), width), np.uint8)
                    ids, counts[some] = self.merge_many(raw, sizes[some])
                else:
                    merged = [self.merge(data[begins[i] : begins[i] + sizes[i]].tobytes()) for i in some.tolist()]
                    ids, counts[some] = np.array([i for m in merged for i in m], np.int64), [len(m) for m in merged]
                starts[some] = total + np.cumsum(counts[some]) - counts[some]
                total += len(ids)
                parts.append(ids)
        return np.concatenate([np.zeros(0, np.int64), *parts]), starts, counts

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, group: list[str]) -> Iterator[bytes]:
        even = [spaced_evenly(t) and not (self.special_cut and self.special_cut.search(t)) for t in group]
        marked = pa.array([t.replace(" ", "\0 ").replace("\n", "\0\n\0") for t, e in zip(group, even, strict=True) if e], pa.large_string())
        split = pc.split_pattern(marked, "\0")
        odd: list[list[str]] = [self.cut(t) for t, e in zip(group, even, strict=True) if not e]
        odd_words = [w for words in odd for w in words]
        words = pa.concat_arrays([split.flatten().cast(pa.large_string()), pa.array(odd_words, pa.large_string())]).dictionary_encode()
        ids, starts, counts = self.encode_distinct(words.dictionary)
        at = words.indices.to_numpy()
        ids, word_ends = take_rows(ids, starts, counts, at)
        packed, ends = ids.astype("<u4"), np.r_[0, word_ends]
        lengths = np.zeros(len(group), np.int64)
        order = np.array(even, bool)
        lengths[order], lengths[~order] = pc.list_value_length(split).to_numpy(zero_copy_only=False), [len(w) for w in odd]
        place = np.zeros(len(group), np.int64)
        place[order] = np.cumsum(lengths[order]) - lengths[order]
        place[~order] = lengths[order].sum() + np.cumsum(lengths[~order]) - lengths[~order]
        for first, last in zip(ends[place].tolist(), ends[place + lengths].tolist(), strict=True):
            yield packed[first:last].tobytes()

    def cut(self, text: str) -> list[str]:
        """Pieces of a text; a special token stays whole."""
        parts = self.special_cut.split(text) if self.special_cut else [text]
        return [w for i, p in enumerate(parts) for w in ([SPECIAL + p] if i % 2 else PATTERN.findall(p))]

    def encode_distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words as (all ids, where each word starts, how many it has)."""
        # Most words are an optional space, letters, and marks: two pieces that need no pattern.
        head = pc.utf8_rtrim(words, characters=MARKS)
        letters = pc.utf8_ltrim(head, characters=" ")
        spaces = pc.subtract(pc.binary_length(head), pc.binary_length(letters))
        plain = pc.and_(pc.utf8_is_alpha(letters), pc.less_equal(spaces, 1)).to_numpy(zero_copy_only=False)
        data, begins, sizes = ragged(words)
        used = pc.binary_length(head).to_numpy()[plain]
        head, tail = head.filter(pa.array(plain)), text_array(data, begins[plain] + used, sizes[plain] - used)
        others = words.filter(pa.array(~plain)).to_pylist()
        cuts = [[w] if w.startswith(SPECIAL) else PATTERN.findall(w) for w in others]
        pieces = pa.concat_arrays([head, tail, pa.array([p for cut in cuts for p in cut], pa.large_string())]).dictionary_encode()
        ids, starts, counts = self.merge_distinct(pieces.dictionary)
        for token, i in self.specials.items():
            place = pc.index(pieces.dictionary, pa.scalar(SPECIAL + token, pa.large_string())).as_py()
            if place >= 0:
                ids, starts[place], counts[place] = np.r_[ids, i], len(ids), 1
        at, n = pieces.indices.to_numpy(), len(head)
        pairs = np.stack([at[:n], at[n : 2 * n]], axis=1).ravel()
        ids, ends = take_rows(ids, starts, counts, np.r_[pairs, at[2 * n :]])
        sizes = np.zeros(len(words), np.int64)
        sizes[plain], sizes[~plain] = 2, [len(c) for c in cuts]
        last = np.zeros(len(words), np.int64)
        last[plain], last[~plain] = np.cumsum(sizes[plain]), sizes[plain].sum() + np.cumsum(sizes[~plain])
        ends = np.r_[0, ends]
        return ids, ends[last - sizes], ends[last] - ends[last - sizes]

    def decode(self, ids: bytes) -> str:
        token_bytes = self.token_bytes
        return b"".join([token_bytes[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def ragged(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of an array of large strings, where each begins and how many bytes it has."""
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(strings.buffers()[2] or b"", np.uint8), bounds[:-1], np.diff(bounds)


def text_array(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings cut out of a buffer."""
    cut, ends = take_rows(data, begins, sizes, np.arange(len(begins)))
    return pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(cut)))


def take_rows(values: np.ndarray, starts: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows of a ragged table, one after the other, and where each row ends."""
    sizes = counts[rows]
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[rows] - ends + sizes, sizes)], ends


def spaced_evenly(text: str) -> bool:
    """Whether spaces and line ends stand alone between other characters, so that every one begins a piece."""
    if not text or text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return False
    return text.replace("\n", "").isprintable()


_LOADED: dict[str, Tokenizer] = {}


def tokenizer_of(content: str, key: str) -> Tokenizer:
    """The tokenizer of a file's content, built once per worker."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(content)
    return _LOADED[key]


@lru_cache(maxsize=2)
def read_tokenizer(path: str) -> tuple[str, str]:
    """Content of a tokenizer file on the driver, without what encoding does not need, and its digest."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model = data["model"]
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or data.get("normalizer"):
        raise ValueError("a plain byte-level BPE file is expected")
    content = json.dumps({"added_tokens": data.get("added_tokens", []), "model": {"vocab": model["vocab"], "merges": model["merges"]}})
    return content, hashlib.sha256(content.encode()).hexdigest()


def bpe_encode_decode(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: ids, their number, digests of the ids and of the text decoded from them.

    No shuffle: every text is encoded where it is read. ``with_ids=False`` leaves out the ids and the decoded text.
    """
    content, key = read_tokenizer(tokenizer_path)
    id_type = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema = schema.add("ids", T.BinaryType()).add("decoded", T.StringType())

    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string())[: 5 if with_ids else 3]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(content, key)
        for batch in batches:
            found = tokenizer.encode(value.as_py() or "" for value in batch.column(1))
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows = [row(tokenizer, ids) for ids in islice(found, BATCH_ROWS)]
                arrays = [batch.column(0).slice(at, BATCH_ROWS), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    def row(tokenizer: Tokenizer, ids: bytes) -> tuple:
        decoded = tokenizer.decode(ids)
        return (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded)[: len(kinds)]

    return docs.select(docs[id_column], docs[text_column]).mapInArrow(encode, schema)

"""Byte-level BPE over rank files: a lazily determinised transducer, and a decoder that works on streams.

A sequence of tokens is what merging by ranks gives for its bytes exactly if every two neighbours, merged alone, stay two
tokens: until the first merge across a border, the sides of a border evolve as they do alone. So merging is a regular
relation. The transducer that guesses token borders has states (last token, place in the trie of tokens); after any
prefix one state stands at each possible border, because the merged prefix has one last token. Determinising keeps the
set of these states, and a move says which token ends the merged prefix there; read backwards from the end of a piece,
these are its tokens, since each begins where the one before it ends. So subsets owe nothing and many pieces share them.
Short pieces take their moves in step, from one sorted table. Subsets and their moves are made when a text first needs
them and dropped together when they become many.

Decoding takes ids in any pieces and returns whole characters as soon as their last byte is known.

Defined results: NULL and empty texts have no ids and decode to nothing. There are no special tokens: their strings are
ordinary text. Repeated rows stay repeated, NULL ids stay, further columns are not used, an empty table gives an empty
result. Texts are handled whole, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crossfoot.llm.bpe import BLOCK, NONE, PATTERN, Tokenizer, ragged

ROOT = 0
MOST_STATES = 150_000
MOST_PAIRS = 500_000
STREAM_IDS = 65_536
#: Bytes of the longest pieces that are worked on in step.
IN_STEP = 256


class Merger:
    """Plain merging by ranks, for short byte strings: what the transducer is compiled from."""

    def __init__(self, rank_of: dict[bytes, int]) -> None:
        self.rank_of = rank_of

    def merge(self, data: bytes, history: list[tuple[int, bytes, bytes]] | None = None) -> list[bytes]:
        """Tokens of ``data``; ``history`` gets the rank of each merge, and what then is the first part and the last."""
        rank_of = self.rank_of
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank_of.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            least, at = None, -1
            for i, rank in enumerate(pairs):
                if rank is not None and (least is None or rank < least):
                    least, at = rank, i
            if least is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank_of.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = rank_of.get(parts[at - 1] + parts[at])
            if history is not None:
                history.append((least, parts[0], parts[-1]))


class Transducer:
    """Bytes in, token ids out. States are numbers of subsets; both they and their moves are made on demand.

    A subset is a tuple of ``last token << 32 | node``, with -1 for the token before the first. A move is the number of
    the next subset and the token that ends the merged prefix there. Pieces worked on in step look moves up in sorted
    arrays, as ``number << 32 | token``, a single piece in a dictionary; at most twice ``MOST_STATES`` subsets are kept.
    """

    def __init__(self, token_bytes: list[bytes], hidden: frozenset[int]) -> None:
        self.token_bytes, self.token_sizes = token_bytes, np.array([len(token) for token in token_bytes], np.int64)
        self.rank_of = {token: i for i, token in enumerate(token_bytes) if token}
        if any(bytes([b]) not in self.rank_of for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for every byte")
        self.merger = Merger(self.rank_of)
        #: Whole pieces that are tokens are taken as such, as rank encoders do, even if merging would not reach them.
        self.whole = {token_bytes[i]: i for i in hidden}
        self.edge: dict[int, int] = {}
        self.token_at, self.inner = [-1], bytearray(1)
        for token, i in self.rank_of.items():
            if i not in hidden:
                node = ROOT
                for b in token:
                    key = node << 8 | b
                    node = self.edge.get(key, -1)
                    if node < 0:
                        node = self.edge[key] = len(self.token_at)
                        self.token_at.append(-1)
                        self.inner.append(0)
                        self.inner[key >> 8] = 1
                self.token_at[node] = i
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, list[tuple[int, bytes, bytes]]] = {}
        self.moves: dict[int, tuple[int, int]] = {}
        self.forget()

    def forget(self) -> None:
        start = (-1 << 32 | ROOT,)
        self.number = {start: 0}
        self.subsets: list[tuple[int, ...]] = [start]
        self.moves.clear()
        # The last key is larger than any other, so that each search ends inside.
        self.keys, self.ends = np.array([NONE]), np.zeros(1, np.int64)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens, merged alone, stay the two tokens they are."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = not self.merge_across(left, right)
        return known

    def merge_across(self, left: int, right: int) -> bool:
        """Whether merging two tokens' bytes crosses their border: the merges of each side in order of rank, until one does."""
        rank_of = self.rank_of
        left_steps, right_steps = self.history(left), self.history(right)
        end, begin = self.token_bytes[left][-1:], self.token_bytes[right][:1]
        i = j = 0
        while True:
            here, there, across = left_steps[i][0], right_steps[j][0], rank_of.get(end + begin, NONE)
            if across < here and across <= there:  # of equal ranks the leftmost merges first
                return True
            if here <= there:
                if here == NONE:
                    return False
                end = left_steps[i][2]
                i += 1
            else:
                begin = right_steps[j][1]
                j += 1

    def history(self, token: int) -> list[tuple[int, bytes, bytes]]:
        """The merges that make a token, and an end that no rank reaches."""
        steps = self.histories.get(token)
        if steps is None:
            steps = self.histories[token] = []
            self.merger.merge(self.token_bytes[token], steps)
            steps.append((NONE, b"", b""))
        return steps

    def move(self, state: int, byte: int) -> tuple[int, int]:
        """Make the move of a subset on a byte."""
        edge, token_at, inner, pairs = self.edge, self.token_at, self.inner, self.pairs
        items, closed = [], -1
        for item in self.subsets[state]:
            node = edge.get((item & 0xFFFFFFFF) << 8 | byte)
            if node is None:
                continue
            last = item >> 32
            if inner[node]:
                items.append(last << 32 | node)
            if closed < 0:
                token = token_at[node]
                if token >= 0 and (last < 0 or (pairs.get(last << 32 | token) or self.stay_apart(last, token))):
                    closed = token
        items.append(closed << 32 | ROOT)
        return self.number_of(tuple(items)), closed

    def number_of(self, subset: tuple[int, ...]) -> int:
        number = self.number.get(subset)
        if number is None:
            number = self.number[subset] = len(self.subsets)
            self.subsets.append(subset)
        return number

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length."""
        if piece in self.whole:
            return [self.whole[piece]]
        known, state, closed = self.moves.get, 0, array("i")
        note = closed.append
        for byte in piece:
            step = known(state << 8 | byte)
            if step is None:
                step = self.moves[state << 8 | byte] = self.move(state, byte)
                if len(self.subsets) > 2 * MOST_STATES:
                    subset = self.subsets[step[0]]
                    self.forget()
                    step = (self.number_of(subset), step[1])
            state, token = step
            note(token)
        ids, end = [], len(piece)
        while end:
            ids.append(closed[end - 1])
            end -= len(self.token_bytes[ids[-1]])
        return ids[::-1]

    def encode_many(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces, one after the other, and their number per piece. Sizes fall, and a piece is in no ``whole``."""
        count, width = len(sizes), int(sizes.max(initial=0))
        closed, states = np.zeros((width, count), np.int32), np.zeros(count, np.int64)
        made: dict[int, int] = {}
        for place, live in enumerate(np.searchsorted(-sizes, -np.arange(width)).tolist()):
            if len(self.subsets) + live > 2 * MOST_STATES:
                reached, which = np.unique(states[:live], return_inverse=True)
                subsets = [self.subsets[state] for state in reached.tolist()]
                self.forget()
                made.clear()
                states[:live] = np.array([self.number_of(subset) for subset in subsets])[which]
            keys = states[:live] << 8 | data[begins[:live] + place]
            at = np.searchsorted(self.keys, keys)
            steps = self.ends[at]
            new = np.flatnonzero(self.keys[at] != keys)
            if len(new):
                needed, which = np.unique(keys[new], return_inverse=True)
                needed = needed.tolist()
                for key in needed:
                    if key not in made:
                        state, token = self.move(key >> 8, key & 255)
                        made[key] = state << 32 | token
                steps[new] = np.array([made[key] for key in needed])[which]
            states[:live], closed[place, :live] = steps >> 32, steps & 0xFFFFFFFF
        if made:
            needed = sorted(made)
            at = np.searchsorted(self.keys, needed)
            self.keys, self.ends = np.insert(self.keys, at, needed), np.insert(self.ends, at, [made[key] for key in needed])
        kept, ends, live = np.zeros((width, count), bool), sizes.copy(), np.flatnonzero(sizes)
        while len(live):
            last = ends[live] - 1
            kept[last, live] = True
            ends[live] -= self.token_sizes[closed[last, live]]
            live = live[ends[live] > 0]
        return closed.T[kept.T].astype(np.int64), kept.sum(axis=0)


class CharacterStream:
    """UTF-8 decoding in steps. The state is the bytes of an unfinished character, three at most.

    ``feed`` returns the characters that are certain; wrong bytes become U+FFFD as in decoding at once.
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end may begin a character that later bytes complete."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead < 0x80:
                return 0
            if lead >= 0xC0:
                needed = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
                if back >= needed:
                    return 0
                if back > 1:  # the second byte decides about overlong forms, surrogates and what lies beyond Unicode
                    low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
                    high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
                    if not low <= data[1 - back] <= high:
                        return 0
                return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = self.unfinished(data)
        self.held = data[len(data) - n :]
        return data[: len(data) - n].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class RankTokenizer(Tokenizer):
    """Texts to ids and back. Cutting texts into pieces is shared with the merge-list tokenizer, merging is not."""

    def __init__(self, token_bytes: list[bytes], hidden: frozenset[int], pattern: str) -> None:
        self.specials, self.special_cut = {}, None
        self.token_bytes, self.decimal = token_bytes, [str(i) for i in range(len(token_bytes))]
        self.transducer = Transducer(token_bytes, hidden)
        self.pattern = regex.compile(pattern)
        self.usual = pattern == PATTERN.pattern

    def merge_distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, begins, sizes = ragged(pieces)
        raw, transducer = data.tobytes(), self.transducer
        alone = sizes > IN_STEP
        if transducer.whole:
            alone |= np.array([raw[b : b + n] in transducer.whole for b, n in zip(begins.tolist(), sizes.tolist(), strict=True)], bool)
        order = np.argsort(-sizes, kind="stable")
        short, others = order[~alone[order]], np.flatnonzero(alone)
        block = min(BLOCK, MOST_STATES)
        found = [transducer.encode_many(data, begins[some], sizes[some]) for some in np.split(short, range(block, len(short), block))]
        for i in others.tolist():
            merged = transducer.encode(raw[begins[i] : begins[i] + sizes[i]])
            found.append((np.array(merged, np.int64), np.array([len(merged)])))
        order, numbers = np.r_[short, others], np.concatenate([n for _, n in found])
        counts, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        counts[order], starts[order] = numbers, np.cumsum(numbers) - numbers
        return np.concatenate([ids for ids, _ in found]), starts, counts

    def _encode(self, group: list[str]) -> Iterator[bytes]:
        if self.usual:
            yield from super()._encode(group)
            return
        for text in group:
            yield np.array([i for piece in self.pattern.findall(text) for i in self.transducer.encode(piece.encode())], "<u4").tobytes()

    def decode_stream(self, ids: bytes) -> Iterator[bytes]:
        """Bytes of the ids, a bounded number of ids at a time."""
        token_bytes = self.token_bytes
        numbers = np.frombuffer(ids, "<u4")
        for start in range(0, len(numbers), STREAM_IDS):
            yield b"".join([token_bytes[i] for i in numbers[start : start + STREAM_IDS].tolist()])

    def decode(self, ids: bytes) -> str:
        stream = CharacterStream()
        return "".join([*(stream.feed(part) for part in self.decode_stream(ids)), stream.close()])


@lru_cache(maxsize=2)
def read_ranks(path: str) -> tuple[str, frozenset[int], str]:
    """Content of a rank file on the driver, the tokens that merging never reaches, and a digest."""
    with open(path, encoding="ascii") as file:
        content = file.read()
    token_bytes = parse_ranks(content)
    merger = Merger({token: i for i, token in enumerate(token_bytes) if token})
    hidden = frozenset(i for i, token in enumerate(token_bytes) if token and len(merger.merge(token)) > 1)
    return content, hidden, hashlib.sha256(content.encode()).hexdigest()


def parse_ranks(content: str) -> list[bytes]:
    """Token bytes by id; ids that the file leaves out have none."""
    pairs = [line.split() for line in content.splitlines() if line.strip()]
    token_bytes = [b""] * (max((int(i) for _, i in pairs), default=-1) + 1)
    for token, i in pairs:
        token_bytes[int(i)] = base64.b64decode(token)
    return token_bytes


_LOADED: dict[tuple[str, str], RankTokenizer] = {}


def rank_tokenizer(content: str, hidden: frozenset[int], key: str, pattern: str) -> RankTokenizer:
    """The tokenizer of a rank file, built once per worker."""
    if (key, pattern) not in _LOADED:
        _LOADED.clear()
        _LOADED[key, pattern] = RankTokenizer(parse_ranks(content), hidden, pattern)
    return _LOADED[key, pattern]


def rank_encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: number of ids, digests of the ids (decimal, joined by spaces) and of the decoded bytes.

    No shuffle: every text is encoded where it is read. The rank file is read once on the driver and travels with the
    tasks, so what is sent is bounded by a vocabulary. ``with_ids=False`` leaves out the ids and the decoded text.
    """
    content, hidden, key = read_ranks(ranks_path)
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = rank_tokenizer(content, hidden, key, pattern)
        decimal = tokenizer.decimal
        for batch in batches:
            columns: list[list] = [[] for _ in range(5 if with_ids else 3)]
            for ids in tokenizer.encode(value.as_py() or "" for value in batch.column(1)):
                numbers = np.frombuffer(ids, "<u4")
                digest = hashlib.sha256()
                for part in tokenizer.decode_stream(ids):
                    digest.update(part)
                row = [len(numbers), hashlib.sha256(" ".join([decimal[i] for i in numbers.tolist()]).encode()).hexdigest(), digest.hexdigest()]
                if with_ids:
                    row += [numbers.astype(np.int32), tokenizer.decode(ids)]
                for column, cell in zip(columns, row, strict=True):
                    column.append(cell)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return docs.select(docs[id_column], docs[text_column]).mapInArrow(encode, schema)

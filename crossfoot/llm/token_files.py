"""Token ids in a binary file format: canonical length-limited Huffman codes in independent blocks.

A folder holds two Parquet tables. ``codes`` has the code length of every id that occurs; canonical codes follow from the
lengths. ``blocks`` has one row per block, in ascending order of document id over (part, block):

- ``payload``: the code words of the documents, highest bit first, each document from a byte boundary
- ``checkpoints``: bit offset within the block of every ``STEP``-th id of a document, its first included (int64, little-endian)
- ``doc_ids``, ``n_tokens``: the documents of the block and their numbers of ids
- ``first``: number of ids in earlier blocks of the same part

A block is decoded from its own row and the codes alone. All checkpoints of a block are starting points of independent
table look-ups, which go on in step.

Defined results: NULL and empty texts hold the end id only. Rows with the same document id stand in order of their
stored ids; a NULL id comes first. Further columns are ignored. An empty table gives no blocks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.llm.bpe import read_tokenizer, tokenizer_of
from crossfoot.llm.storage import discard, shared_folder, stored

STEP = 256
BLOCK_BYTES = 400_000
BLOCK_SCHEMA = "part int, block int, first long, n_ids long, doc_ids array<{}>, n_tokens array<long>, payload binary, checkpoints binary"


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code length per symbol, none above ``limit`` (package-merge). All counts must be positive."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    choices, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        by_weight = np.argsort(merged, kind="stable")
        choices.append(by_weight < n)
        merged = merged[by_weight]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(choices):
        used = int(is_leaf[:taken].sum())
        lengths[:used] += 1
        taken = 2 * (taken - used)
    found = np.zeros(n, np.int64)
    found[order] = lengths
    return found


class Codebook:
    """Canonical codes from code lengths, with the look-up table for decoding."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((ids, lengths))
        self.ids, sizes = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.widest = int(sizes.max()) if len(sizes) else 1
        spans = 1 << (self.widest - sizes)
        starts = np.cumsum(spans) - spans
        self.code_of, self.size_of = np.zeros(int(self.ids.max(initial=0)) + 1, np.uint64), np.zeros(int(self.ids.max(initial=0)) + 1, np.int64)
        self.code_of[self.ids], self.size_of[self.ids] = starts >> (self.widest - sizes), sizes
        self.table_id, self.table_size = np.zeros(1 << self.widest, np.uint32), np.zeros(1 << self.widest, np.int64)
        self.table_id[: spans.sum()], self.table_size[: spans.sum()] = np.repeat(self.ids, spans), np.repeat(sizes, spans)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Code words of several documents, each from a byte boundary; bytes per document; bit offset of every id."""
        sizes = self.size_of[ids]
        ends = np.r_[0, np.cumsum(sizes)]
        last = np.cumsum(counts)
        n_bytes = (ends[last] - ends[last - counts] + 7) // 8
        begins = np.cumsum(n_bytes) - n_bytes
        at = ends[:-1] + np.repeat(begins * 8 - ends[last - counts], counts)
        word, shift = at >> 5, (64 - (at & 31) - sizes).astype(np.uint64)
        value = self.code_of[ids] << shift
        total = int(n_bytes.sum())
        words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), total // 4 + 3) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), total // 4 + 3)
        return words.astype(">u4").tobytes()[:total], n_bytes, at

    def decode(self, payload: bytes, checkpoints: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of the documents of a block, one after the other."""
        padded = np.frombuffer(payload + bytes(STEP * self.widest // 8 + 8), np.uint8).astype(np.uint32)
        window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        at = checkpoints.astype(np.int64)
        found = np.empty((STEP, len(at)), np.uint32)
        drop = np.uint32(32 - self.widest)
        for i in range(STEP):
            look = (window[np.minimum(at >> 3, len(window) - 1)] << (at & 7).astype(np.uint32)) >> drop
            found[i] = self.table_id[look]
            at = at + self.table_size[look]
        lanes = (counts + STEP - 1) // STEP
        used = np.full(len(checkpoints), STEP)
        used[np.cumsum(lanes)[lanes > 0] - 1] -= (lanes * STEP - counts)[lanes > 0]
        return found.T[np.arange(STEP) < used[:, None]]


def id_type(vocabulary_size: int) -> str:
    """Two bytes for every id where the vocabulary allows it, else four."""
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int, id_column: str, text_column: str) -> tuple[DataFrame, str]:
    """doc_id and the ids of the text with the end id; per task one more row with the number of times it has seen each id.

    Also returns the type the ids are stored as.
    """
    content, key = read_tokenizer(tokenizer_path)
    kind = id_type(max(len(tokenizer_of(content, key).token_bytes), end_id + 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(content, key)
        total = np.zeros(max(len(tokenizer.token_bytes), end_id + 1), np.int64)
        id_kind = pa.int64()
        for batch in batches:
            id_kind, texts = batch.schema.field(0).type, (value.as_py() or "" for value in batch.column(1))
            ids = [np.append(np.frombuffer(i, "<u4"), np.uint32(end_id)) for i in tokenizer.encode(texts)]
            if ids:
                total += np.bincount(np.concatenate(ids), minlength=len(total))
            nothing = [None] * len(ids)
            columns = [batch.column(0), pa.array([i.astype(kind).tobytes() for i in ids], pa.binary()), pa.array(nothing, pa.list_(pa.int32())), pa.array(nothing, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
        seen = np.flatnonzero(total)
        columns = [pa.array([None], id_kind), pa.array([None], pa.binary()), pa.array([seen], pa.list_(pa.int32())), pa.array([total[seen]], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("ids", T.BinaryType())])
    schema = schema.add("seen", T.ArrayType(T.IntegerType())).add("times", T.ArrayType(T.LongType()))
    return docs.select(docs[id_column], docs[text_column]).mapInArrow(encode, schema), kind


def read_codes(spark: SparkSession, path: str) -> Codebook:
    """The codes of a folder; their number is bounded by the vocabulary."""
    rows = spark.read.parquet(f"{path}/codes").toArrow()
    return Codebook(rows["id"].to_numpy(), rows["length"].to_numpy())


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode all texts and write the two tables. Codes come from the counts over all documents."""
    spark = docs.sparkSession
    table, kind = token_table(docs, tokenizer_path, end_id, id_column, text_column)
    tokens = stored(table)
    listed = tokens.filter("seen IS NOT NULL").select(F.explode(F.arrays_zip("seen", "times")).alias("x"))
    counts = listed.groupBy(F.col("x.seen").alias("id")).agg(F.sum("x.times").alias("n")).toArrow()
    ids, n = counts["id"].to_numpy().astype(np.int64), counts["n"].to_numpy()
    lengths = code_lengths(n, max(16, int(len(n)).bit_length() + 2))
    spark.createDataFrame(pa.table({"id": ids, "length": lengths})).coalesce(1).write.parquet(f"{path}/codes")
    book = Codebook(ids, lengths)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                each = [np.frombuffer(cell.as_py(), kind) for cell in some.column(1)]
                sizes = np.array([len(e) for e in each], np.int64)
                packed, n_bytes, at = book.encode(np.concatenate(each).astype(np.int64), sizes)
                ends = np.cumsum(n_bytes)
                firsts = np.cumsum(sizes) - sizes
                marks = [(at[f : f + s : STEP] - 8 * (e - b)).tobytes() for f, s, e, b in zip(firsts, sizes, ends, n_bytes, strict=True)]
                streams = [packed[e - b : e] for e, b in zip(ends.tolist(), n_bytes.tolist(), strict=True)]
                columns = [some.column(0), pa.array(sizes), pa.array(streams, pa.binary()), pa.array(marks, pa.binary()), some.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "stream", "marks", "part"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pack_blocks(code(batches))

    ordered = tokens.filter("ids IS NOT NULL").select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    blocks = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(pack, BLOCK_SCHEMA.format(tokens.schema["doc_id"].dataType.simpleString()))
    blocks.write.parquet(f"{path}/blocks")
    discard(tokens)


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gather coded documents, in their order, into blocks of about ``BLOCK_BYTES``; a document is never split."""
    number, first, held, size = 0, 0, [], 0
    part, id_kind = 0, pa.int64()

    def block() -> pa.RecordBatch:
        counts = [n for _, n, _, _ in held]
        begins = np.cumsum([0, *(len(s) for _, _, s, _ in held)])
        marks = b"".join((np.frombuffer(m, "<i8") + 8 * b).tobytes() for (_, _, _, m), b in zip(held, begins.tolist(), strict=False))
        columns = [[part], [number], [first], [sum(counts)], [[d for d, _, _, _ in held]], [counts], [b"".join(s for _, _, s, _ in held)], [marks]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_kind), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        names = ["part", "block", "first", "n_ids", "doc_ids", "n_tokens", "payload", "checkpoints"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        id_kind = batch.schema.field("doc_id").type
        for doc_id, n, stream, marks, part_ in zip(*(batch.column(i) for i in range(5)), strict=True):
            part = part_.as_py()
            held.append((doc_id.as_py(), n.as_py(), stream.as_py(), marks.as_py()))
            size += len(held[-1][2])
            if size >= BLOCK_BYTES:
                yield block()
                number, first, held, size = number + 1, first + sum(n for _, n, _, _ in held), [], 0
    if held:
        yield block()


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a folder: id, number of ids before it in the whole folder, number and CRC-32 of its ids, the ids."""
    book = read_codes(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per written partition
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = blocks.join(before, "part").select((F.col("before") + F.col("first")).alias("start"), "doc_ids", "n_tokens", "payload", "checkpoints")
    doc_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", doc_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.BinaryType())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, doc_ids = batch.column(0)[i].as_py(), batch.column(1)[i].values
                counts = batch.column(2)[i].values.to_numpy()
                ids = book.decode(batch.column(3)[i].as_py(), np.frombuffer(batch.column(4)[i].as_py(), "<i8"), counts)
                ends = np.cumsum(counts)
                each = [ids[e - c : e].astype("<u4").tobytes() for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                arrays = [doc_ids, pa.array(start + ends - counts), pa.array(counts), pa.array([zlib.crc32(b) for b in each], pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(each, pa.binary())] if with_ids else [])], names=schema.fieldNames())

    return placed.mapInArrow(decode, schema)


def new_token_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/crossfoot-tokens-{uuid.uuid4().hex}"

"""Near duplicates by Jaccard similarity of word shingles: a parity-sketch join.

Every shingle flips one position of a wide bit sketch. Two sketches differ in at most as many positions as the sets
differ in shingles, so a pair with Jaccard similarity of at least 3/4 differs in at most (a + b) / 7 positions, where a
and b are the sizes of its sets. The sketch is cut into blocks; a differing position spoils one block. Hence all but
(a + b) / 7 blocks of a linked pair are equal, and by the pigeonhole principle any (a + b) / 7 + 1 of the filled blocks
of one document hold one that the other has too. Documents send that many blocks, the rarest first, as join keys; rarity
comes from counts over all documents, so blocks of a passage that many documents share come last.

The number of blocks depends on the size band (sizes up to the next power of two). A document whose partners can lie in
the next band also sends keys in that band. A document with too few filled blocks sends a key for its empty ones.

Documents with equal sets, by a cryptographic digest, take part as one. Within the documents of a key, each is first
compared with the first of them. What is verified is linked, and only where documents of a key are still in different
components are the other pairs looked at, so a large group of copies costs as many comparisons as it has members. Pairs are thrown out by size and by the Hamming distance of whole sketches; the
Jaccard similarity of the rest is computed from their texts.

Defined results: NULL and empty texts have no shingles and are linked with nothing. Ids are whole numbers; rows with
the same id are one node, and rows without an id are linked with nothing and have no component. Repeated rows stay
repeated, further columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossfoot.llm.components import connected_components
from crossfoot.llm.storage import discard, stored
from crossfoot.llm.words import mix, shingle_sets

LEAST_WIDTH = 2048
#: Blocks of a band, as a share of its largest size. At least 2/7 of that size must be filled to be keys; with 0.4, up to
#: 0.37 are, with one to three shingles each, so that a single shared passage rarely makes a whole block equal.
BLOCKS_PER_SHINGLE, FEWEST_BLOCKS = 0.4, 64
#: Shingles of all documents are counted in a table of this fixed size, by hash. It only orders the keys.
COUNT_BITS = 17
FILTER_WORDS = 1 << 17
PROFILE = "doc_id long, n_shingles long, sketch array<long>, digest binary, buckets array<int>, counts array<long>"


def largest_difference(size: int, other: int) -> int:
    """Most shingles in which sets of these sizes can differ and still be linked."""
    return (size + other) // 7


def bucket(shingles: np.ndarray) -> np.ndarray:
    # Bits that neither sketches (the lowest) nor blocks (the highest) are taken from.
    return ((shingles >> np.uint64(24)) & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)


def profile(docs: DataFrame) -> DataFrame:
    """Per document its number of shingles, sketch and digest of the set; per task one row with its counts of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            ids, sizes, sketches, digests = [], [], [], []
            for doc_id, shingles in zip(batch.column(0), shingle_sets(t.as_py() or "" for t in batch.column(1)), strict=True):
                width = max(LEAST_WIDTH, 1 << (4 * len(shingles)).bit_length())
                odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
                ids.append(doc_id.as_py())
                sizes.append(len(shingles))
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                digests.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                np.add.at(total, bucket(shingles), 1)
            yield rows(ids, sizes, sketches, digests, None, None)
        seen = np.flatnonzero(total)
        yield rows([None], [None], [None], [None], [seen], [total[seen]])

    def rows(ids: list, sizes: list, sketches: list, digests: list, buckets: list | None, counts: list | None) -> pa.RecordBatch:
        blank = [None] * len(ids)
        columns = (ids, pa.int64()), (sizes, pa.int64()), (sketches, pa.list_(pa.int64())), (digests, pa.binary()), (buckets or blank, pa.list_(pa.int32())), (counts or blank, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=["doc_id", "n_shingles", "sketch", "digest", "buckets", "counts"])

    return docs.mapInArrow(run, PROFILE)


def shingle_counts(profiles: DataFrame) -> np.ndarray:
    """Documents per bucket of shingles. The table orders the join keys and never excludes one."""
    listed = profiles.filter("buckets IS NOT NULL").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    rows = listed.groupBy(F.col("x.buckets").alias("bucket")).agg(F.sum("x.counts").alias("n")).toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def band_keys(shingles: np.ndarray, counts: np.ndarray | None, band: int) -> np.ndarray:
    """Join keys of a document in a band: its rarest filled blocks, as many as the pigeonhole principle asks for."""
    size, largest = len(shingles), 1 << band
    needed = largest_difference(size, min(size * 4 // 3, largest)) + 1
    blocks = np.uint64(max(FEWEST_BLOCKS, int(BLOCKS_PER_SHINGLE * largest)))
    block = ((shingles >> np.uint64(32)) * blocks) >> np.uint64(32)  # ascends with the sorted shingles
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    content = np.bitwise_xor.reduceat(mix(shingles), starts)
    keys = mix(content ^ mix(block[starts] + np.uint64(band << 48)))[content != 0]
    if len(keys) < needed:
        return np.r_[keys, mix(np.full(1, band, np.uint64))]
    if counts is not None:
        least = np.minimum.reduceat(counts, starts)[content != 0]
        return keys[np.lexsort((keys, least))[:needed]]
    return np.partition(keys, needed - 1)[:needed]


def join_keys(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(key, doc_id, size) rows of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, sizes, held = [], [], [], 0
            for doc_id, shingles in zip(batch.column(0), shingle_sets(t.as_py() or "" for t in batch.column(1)), strict=True):
                size = len(shingles)
                if size:
                    band = (size - 1).bit_length()
                    for b in (band, band + 1) if size * 4 // 3 > 1 << band else (band,):
                        keys.append(band_keys(shingles, counts[bucket(shingles)], b))
                        ids.append(doc_id.as_py())
                        sizes.append(size)
                        held += len(keys[-1])
                if held > 100_000:
                    yield rows(ids, keys, sizes)
                    ids, keys, sizes, held = [], [], [], 0
            if held:
                yield rows(ids, keys, sizes)

    def rows(ids: list[int], keys: list[np.ndarray], sizes: list[int]) -> pa.RecordBatch:
        n = [len(k) for k in keys]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(ids, n)), pa.array(np.repeat(np.array(sizes, np.int32), n))], names=["key", "doc_id", "size"])

    return docs.filter("doc_id IS NOT NULL").mapInArrow(run, "key long, doc_id long, size int")


def near_enough(size: str, sketch: str, other_size: str, other_sketch: str) -> Column:
    """Whether sizes and folded sketches leave a link possible.

    A sketch has at least four times as many bits as the set has shingles. The halves of a parity sketch laid over each
    other are the sketch of half the width, so the wider of two is folded first; sizes within 4/3 differ by one fold.
    """
    a, b = F.col(size), F.col(other_size)
    narrow = F.least(F.size(sketch), F.size(other_sketch))

    def folded(column: str) -> Column:
        bits = F.col(column)
        halves = F.zip_with(F.slice(bits, F.lit(1), narrow), F.slice(bits, narrow + 1, narrow), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) == narrow, bits).otherwise(halves)

    flips = F.aggregate(F.zip_with(folded(sketch), folded(other_sketch), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, n: acc + n)
    return (F.least(a, b) * 4 >= F.greatest(a, b) * 3) & (flips * 7 <= a + b)


def possible_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the size and Hamming filters."""
    left = sketches.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("size_a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("size_b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(left, "a").join(right, "b").filter(near_enough("size_a", "sketch_a", "size_b", "sketch_b")).select("a", "b")


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit set of fixed size with one bit per id, by hash. It spares the shuffle of texts that no pair needs."""
    placed = ids.select(F.pmod(F.xxhash64("id"), F.lit(FILTER_WORDS * 64)).alias("at"))
    words = placed.selectExpr("int(at div 64) AS word", "shiftleft(1L, int(at % 64)) AS bit")
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(FILTER_WORDS, np.int64)
    found[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return found


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose whole shingle sets (64-bit hashes, from the texts again) are similar enough."""
    wanted = id_filter(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            yield batch.filter(pa.array((wanted[at >> 6] >> (at & 63)) & 1 == 1)).drop_columns(["at"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                texts = {}
                for ids, column in ((some.column(0).to_pylist(), some.column(2)), (some.column(1).to_pylist(), some.column(3))):
                    texts.update((i, t) for i, t in zip(ids, column, strict=True) if i not in texts)
                sets = dict(zip(texts, shingle_sets(t.as_py() or "" for t in texts.values()), strict=True))
                linked = []
                for a, b in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    linked.append(100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common) > 0)
                yield some.filter(pa.array(linked, pa.bool_())).select([0, 1])

    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS * 64))
    texts = docs.filter("doc_id IS NOT NULL").withColumn("at", place).mapInArrow(keep, "doc_id long, text string")
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def narrow_words(column: str) -> list[Column]:
    """The words of a sketch folded to the least width: places that agree modulo it are laid over each other."""
    words = LEAST_WIDTH // 64

    def word(j: int) -> Column:
        return F.aggregate(F.filter(column, lambda _, i: i % words == j), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(x))

    return [F.coalesce(F.when(F.size(column) == words, F.get(column, F.lit(j))).otherwise(word(j)), F.lit(0).cast("long")) for j in range(words)]


def contested_pairs(groups: DataFrame, components: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs within a key, other than with its first document, that the links found so far leave in different components.

    Sizes and narrow sketches rule out most pairs while documents of a key meet, so what is written are pairs that may
    well be similar, not the square of a key. Only documents of contested keys carry their sketch to them.
    """
    labels = components.withColumnRenamed("node", "doc_id")
    known = groups.filter("members > 2").join(labels, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    whole = Window.partitionBy("key")
    mixed = known.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole)}).filter("low <> high AND doc_id <> first_id")
    mixed = stored(mixed.select("key", "doc_id", "size", "component"))
    # One column per word: an array of them makes the condition too long a method for the JVM to compile.
    words = narrow_words("sketch")
    narrow = sketches.select("doc_id", *[word.alias(f"narrow_{j}") for j, word in enumerate(words)])
    with_words = mixed.join(narrow, "doc_id")

    def side(s: str) -> DataFrame:
        columns = [F.col(f"narrow_{j}").alias(f"narrow_{j}_{s}") for j in range(len(words))]
        return with_words.select("key", F.col("doc_id").alias(s), F.col("size").alias(f"size_{s}"), F.col("component").alias(f"of_{s}"), *columns)

    one, two = side("a"), side("b")
    flips = " + ".join(f"bit_count(narrow_{j}_a ^ narrow_{j}_b)" for j in range(len(words)))
    near = F.expr(f"a < b AND of_a <> of_b AND least(size_a, size_b) * 4 >= greatest(size_a, size_b) * 3 AND ({flips}) * 7 <= size_a + size_b")
    found = stored(one.join(two, "key").filter(near).select("a", "b").distinct())
    discard(mixed)
    return found


def near_duplicate_links(docs: DataFrame, sketches: DataFrame, counts: np.ndarray) -> DataFrame:
    """Links (a, b) that connect all documents which similar pairs connect."""
    whole = Window.partitionBy("key")
    keys = join_keys(docs, counts)
    groups = stored(keys.withColumns({"first_id": F.min("doc_id").over(whole), "members": F.count("*").over(whole)}).filter("members > 1"))
    starred = groups.filter("doc_id <> first_id").select(F.col("first_id").alias("a"), F.col("doc_id").alias("b")).distinct()
    first = stored(possible_pairs(starred, sketches))
    links = stored(verified(first, docs))
    contested = contested_pairs(groups, connected_components(links), sketches)
    rest = stored(possible_pairs(contested, sketches))
    discard(first, groups, contested)
    more = stored(verified(rest, docs))
    discard(rest)
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, number of shingles, and the smallest id that links reach from it."""
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    profiles = stored(profile(texts))
    named = profiles.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # Documents with equal sets are one node: the one with the smallest id takes part for all of them.
    several = named.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    same = named.select("doc_id", "digest").join(several, "digest").filter("doc_id <> first_id").select("doc_id", "first_id").distinct()
    # An id with several texts stands for more than the one that is a copy: it stays, with a link.
    mixed = named.groupBy("doc_id").agg((F.min("digest") != F.max("digest")).alias("mixed")).filter("mixed").select("doc_id")
    copies = stored(same.join(mixed, "doc_id", "left_anti"))
    linked = same.join(mixed, "doc_id", "left_semi").select(F.col("first_id").alias("a"), F.col("doc_id").alias("b"))
    sketches = stored(named.select("doc_id", "n_shingles", "sketch").dropDuplicates(["doc_id"]).join(copies, "doc_id", "left_anti"))
    links = near_duplicate_links(texts.join(copies, "doc_id", "left_anti"), sketches, shingle_counts(profiles))
    discard(sketches)
    components = connected_components(links.unionByName(linked))
    sizes = profiles.filter("buckets IS NULL").select("doc_id", "n_shingles").join(copies, "doc_id", "left").withColumn("node", F.coalesce("first_id", "doc_id"))
    return sizes.join(components, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))

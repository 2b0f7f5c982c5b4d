"""Line duplicates across a corpus: an exact set-similarity join of the lines' word sets.

The tokens of a line are its different words (A-Z lower-cased), ordered by rarity. The rarer tokens of every line form its
prefix, long enough that two lines with Jaccard similarity of at least ``threshold`` share a prefix token. Lines meet on
prefix tokens; pairs that lengths, the positions of the shared token or the parity of their tokens rule out are dropped,
the rest are verified on the words themselves. A line goes if any earlier line is similar enough; earlier means a smaller
(id, line number).

Lines of equal text (A-Z lower-cased) are found first, by a cryptographic digest; only the earliest of them takes part in
the join. There, every line is first verified against the earliest line of each token that the filters leave; only lines
which thereby find no partner meet all others. So a line repeated thousands of times, with small changes or without, costs
a number of comparisons that grows with its copies.

Rarity comes from counts of all tokens of all lines, in a table of fixed size by hash. It orders tokens, never drops one.
Tokens that the table shows to be very frequent are dealt to a square of parts: a line asks in one row of the square and is
a partner in one column, so a part holds a bounded share of the token's lines and any two of them meet in one part.

Defined results: lines without words stay. NULL text stays NULL, with no lines. Ids are whole numbers; rows with the same
id are treated alike, and lines of rows without an id stay. An empty table gives an empty result. Other columns are passed
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossfoot.llm.grams import BATCH_ROWS
from crossfoot.llm.storage import discard, stored
from crossfoot.llm.words import document_words, grouped, mix

RARITY_BITS = 18
FILTER_WORDS = 1 << 18
#: A token that its count shows in more lines than this is dealt to as many parts.
PART_LINES = 200_000
THRESHOLD = Fraction(4, 5)
#: The parity of a line's tokens: one word of bits, for lines from these sizes on two or four; the others are 0.
PARITY = ("parity", "parity_1", "parity_2", "parity_3")
TWO_WORDS, FOUR_WORDS = 96, 192
PARITY_FIELDS = ", ".join(f"{name} long" for name in PARITY)
LINE = f"digest binary, doc_id long, line int, size int, {PARITY_FIELDS}, tokens array<long>, copy boolean"
#: A line's visit to a key. Visits travel in blocks, one per batch of lines and part of the keys.
VISIT = np.dtype([("key", "<u8"), ("doc_id", "<i8"), ("line", "<i4"), ("size", "<i4"), ("position", "<i4"), ("asker", "?"), ("partner", "?"), ("", "V2"), ("parity", "<u8", 4)])
BLOCK = "part long, visits binary"
#: Keys are dealt to so many parts that one holds the visits of about as many words of text.
PART_WORDS = 500_000
CANDIDATE = "a_doc_id long, a_line int, b_doc_id long, b_line int, more boolean"


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def token_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences per bucket of token hashes, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for group in grouped(t.as_py() or "" for t in batch.column(0)):
                total += np.bincount(bucket(document_words(group)[0]), minlength=1 << RARITY_BITS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def token_order(hashes: np.ndarray, rank: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Order by line, rank of the bucket and hash. Buckets are a hash's first bits, so both fit into one number."""
    order = np.argsort(rank[bucket(hashes)] << np.uint64(64 - RARITY_BITS) | hashes & np.uint64((1 << 64 - RARITY_BITS) - 1))
    few = not len(line) or line[-1] < 1 << 16  # numpy sorts 16 bits by counting
    return order[np.argsort(line[order].astype(np.uint16 if few else np.int64), kind="stable")]


def copied(digests: list[bytes], ids: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Whether an earlier line of the same rows has the same digest."""
    halves = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2).T
    order = np.lexsort((number, ids, *halves))
    fresh = np.r_[True, (halves[:, order[1:]] != halves[:, order[:-1]]).any(axis=0)][: len(order)]
    first = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    copies = np.zeros(len(order), bool)
    copies[order] = (ids[order] != ids[first]) | (number[order] != number[first])
    return copies


def parity_words(hashes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Parity of each line's tokens in 64, 128 or 256 bits, by its size; halves of a longer one give the shorter one by XOR."""
    if not len(hashes):
        return [np.zeros(0, np.uint64)] * len(PARITY)
    bits, word = np.uint64(1) << (hashes & np.uint64(63)), (hashes >> np.uint64(6)) & np.uint64(3)
    w = [np.bitwise_xor.reduceat(np.where(word == k, bits, np.uint64(0)), begins) for k in range(4)]
    one, four, none = sizes < TWO_WORDS, sizes >= FOUR_WORDS, np.zeros(len(sizes), np.uint64)
    even, odd = w[0] ^ w[2], w[1] ^ w[3]
    return [np.where(four, w[0], np.where(one, even ^ odd, even)), np.where(four, w[1], np.where(one, none, odd)), np.where(four, w[2], none), np.where(four, w[3], none)]


def parity_differences(words: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Bits that differ, from the XOR of two lines' words, in as many bits as the smaller line has."""
    even, odd = words[0] ^ words[2], words[1] ^ words[3]
    one, two = np.bitwise_count(even ^ odd), np.bitwise_count(even) + np.bitwise_count(odd)
    four = np.bitwise_count(words).sum(axis=0)
    return np.where(smaller < TWO_WORDS, one, np.where(smaller < FOUR_WORDS, two, four)).astype(np.int64)


def line_table(texts: DataFrame, counts: np.ndarray, threshold: Fraction) -> DataFrame:
    """Every line with words: digest of its text, number of different words, their parity, and its prefix tokens.

    A line with an equal earlier one among the texts worked on with it is a copy; it has no tokens, and a digest of its own,
    so that the copies of a very common line do not meet.
    """
    top, bottom = threshold.numerator, threshold.denominator
    rank = np.empty(len(counts), np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group in grouped(t.as_py() or "" for t in batch.column(1)):
                yield rows(np.array(batch.column(0)[done : done + len(group)].to_pylist(), np.int64), [g.lower() for g in group])
                done += len(group)

    def rows(ids: np.ndarray, group: list[bytes]) -> pa.RecordBatch:
        lines = [part for g in group for part in g.split(b"\n")]
        per_document = np.array([g.count(b"\n") + 1 for g in group])
        hashes, ends = document_words(lines, lower=False)
        line = np.repeat(np.arange(len(lines)), np.diff(ends, prepend=0))
        order = token_order(hashes, rank, line)
        hashes, line = hashes[order], line[order]
        fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])][: len(hashes)]
        hashes, line = hashes[fresh], line[fresh]
        sizes = np.bincount(line, minlength=len(lines))
        some = np.flatnonzero(sizes)
        parity = parity_words(hashes, (np.cumsum(sizes) - sizes)[some], sizes[some])
        position = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owner = ids[np.repeat(np.arange(len(group)), per_document)][some]
        number = (np.arange(len(lines)) - np.repeat(np.cumsum(per_document) - per_document, per_document))[some]
        digests = [blake2b(lines[i], digest_size=16).digest() for i in some.tolist()]
        copies = copied(digests, owner, number)
        for i in np.flatnonzero(copies).tolist():
            digests[i] = blake2b(digests[i], digest_size=16, key=b"%d %d" % (owner[i], number[i])).digest()
        needed = sizes - -(-sizes * top // bottom)
        needed[some[copies]] = -1
        kept = position <= needed[line]
        bounds = np.r_[0, np.cumsum(np.bincount(line[kept], minlength=len(lines))[some])].astype(np.int32)
        columns = [
            pa.array(digests, pa.binary()),
            pa.array(owner),
            pa.array(number, pa.int32()),
            pa.array(sizes[some], pa.int32()),
            *[pa.array(word.view(np.int64)) for word in parity],
            pa.ListArray.from_arrays(bounds, pa.array(hashes[kept].view(np.int64))),
            pa.array(copies),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["digest", "doc_id", "line", "size", *PARITY, "tokens", "copy"])

    return texts.filter("doc_id IS NOT NULL").mapInArrow(run, LINE)


def visits(batch: pa.RecordBatch, counts: np.ndarray, part_lines: int, asks: np.ndarray | None = None) -> np.ndarray:
    """One visit per line and prefix token; for frequent tokens one per part that the line visits. ``asks`` names lines that ask."""
    tokens = batch.column("tokens")
    each = tokens.value_lengths().to_numpy()
    hashes = tokens.flatten().to_numpy().view(np.uint64)
    row = np.repeat(np.arange(batch.num_rows), each)
    position = np.arange(len(hashes)) - np.repeat(np.cumsum(each) - each, each)
    doc_id, line, size, *parity = (batch.column(name).to_numpy() for name in ("doc_id", "line", "size", *PARITY))
    lines = np.zeros(batch.num_rows, VISIT)
    lines["doc_id"], lines["line"], lines["size"], lines["parity"] = doc_id, line, size, np.stack(parity, axis=1).view(np.uint64)
    lines["asker"] = True if asks is None else asks
    lines["partner"] = True
    side = 1 + counts[bucket(hashes)] // part_lines
    found = lines[row]
    found["key"], found["position"] = hashes, position
    frequent = np.flatnonzero(side > 1)
    if not len(frequent):
        return found
    times = np.where(side > 1, 2 * side - 1, 1)
    place = np.repeat(np.arange(len(hashes)), times)
    found, side = found[place], side[place]
    visit = np.arange(len(place)) - (np.cumsum(times) - times)[place]
    own = (found["doc_id"] + found["line"].astype(np.int64) * 7) % side
    asker = visit < side
    other = np.where(asker, visit, visit - side + (visit - side >= own))
    part = np.where(asker, own * side + other, other * side + own)
    found["key"] += part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    found["asker"] &= asker
    found["partner"] = ~asker | (other == own)
    return found


def meeting_rows(lines: DataFrame, counts: np.ndarray, part_lines: int, wanted: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """The visits of all lines, in blocks by part of the keys.

    ``wanted`` holds bit sets of the keys to deal and of the lines that ask there.
    """
    parts = 1 << (int(counts.sum()) // PART_WORDS).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if wanted is None:
                found = visits(batch, counts, part_lines)
            else:
                keys, askers = wanted
                found = visits(batch, counts, part_lines, has_bit(askers, line_place(batch.column("doc_id").to_numpy(), batch.column("line").to_numpy())))
                found = found[(found["asker"] | found["partner"]) & has_bit(keys, key_place(found["key"].view(np.int64)))]
            if not len(found):
                continue
            part = mix(found["key"]) & np.uint64(parts - 1)
            order = np.argsort(part, kind="stable")
            found, part = found[order], part[order].astype(np.int64)
            begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            bounds = (np.r_[begins, len(found)] * VISIT.itemsize).astype(np.int32)
            blocks = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(found.view(np.uint8))])
            yield pa.RecordBatch.from_arrays([pa.array(part[begins]), blocks], names=["part", "visits"])

    return lines.select("doc_id", "line", "size", *PARITY, "tokens").mapInArrow(run, BLOCK)


def asked_keys(lines: DataFrame, counts: np.ndarray, part_lines: int) -> DataFrame:
    """Keys at which lines ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = visits(batch, counts, part_lines)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(found["key"][found["asker"]]).view(np.int64))], names=["key"])

    return lines.select("doc_id", "line", "size", *PARITY, "tokens").mapInArrow(run, "key long")


def candidates(meetings: DataFrame, threshold: Fraction, every: bool) -> DataFrame:
    """Pairs of lines with a shared prefix token that order, lengths, positions and parity leave possible.

    Without ``every``, only the earliest partner per line and token, and whether there are more.
    """
    top, bottom = threshold.numerator, threshold.denominator

    def within(rows: np.ndarray) -> pa.RecordBatch:
        """Visits of whole keys: each is compared with the d-th larger line of its key, for growing d."""
        rows = rows[np.lexsort((rows["line"], rows["doc_id"]))]  # a row's place is its line's place in time
        time = np.lexsort((rows["size"], rows["key"]))
        key, size = rows["key"][time], rows["size"][time].astype(np.int64)
        rest = size - rows["position"][time]
        words = rows["parity"][time].T.copy()
        parity = np.bitwise_xor.reduce(words)
        asker, partner = rows["asker"][time], rows["partner"][time]
        # The shared token and those after it bound the overlap; top / (top + bottom) of all tokens are needed.
        largest = (rest * (top + bottom) - size * top) // top
        first, number = np.full(len(key), len(key)), np.zeros(len(key), np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        live, d = np.arange(len(key)), 1
        while len(live):
            live = live[: np.searchsorted(live, len(key) - d)]
            live = live[(key[live + d] == key[live]) & (size[live + d] <= largest[live])]
            # Every token in only one of two lines flips one bit at most.
            a = live[np.bitwise_count(parity[live] ^ parity[live + d]) * (top + bottom) <= (size[live] + size[live + d]) * (bottom - top)]
            sizes = size[a] + size[a + d]
            fit = rest[a + d] * (top + bottom) >= sizes * top
            fit &= parity_differences(words[:, a] ^ words[:, a + d], size[a]) * (top + bottom) <= sizes * (bottom - top)
            a = a[fit]
            turned = time[a] > time[a + d]
            for early, late in ((a[~turned], a[~turned] + d), (a[turned] + d, a[turned])):
                meet = asker[late] & partner[early]
                early, late = early[meet], late[meet]
                if every:
                    pairs.append((time[early], time[late]))
                else:
                    first[late] = np.minimum(first[late], time[early])
                    number[late] += 1
            d += 1
        if every:
            a, b = (np.concatenate([np.zeros(0, np.int64), *(pair[i] for pair in pairs)]) for i in (0, 1))
            more = np.ones(len(b), bool)
        else:
            late = np.flatnonzero(number)
            a, b, more = first[late], time[late], number[late] > 1
        columns = [rows["doc_id"][a], rows["line"][a], rows["doc_id"][b], rows["line"][b], more]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a_doc_id", "a_line", "b_doc_id", "b_line", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        last = None
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and part != last:
                    yield within(np.frombuffer(b"".join(held), VISIT))
                    held = []
                held.append(block.as_py())
                last = part
        if held:
            yield within(np.frombuffer(b"".join(held), VISIT))

    return meetings.repartition("part").sortWithinPartitions("part").mapInArrow(run, CANDIDATE)


def line_place(doc_id: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The bit of a line in the filter; the same as ``PLACE`` in SQL."""
    return (doc_id % 2147483647 * 1000003 + line.astype(np.int64) * 7919) % (FILTER_WORDS * 64)


PLACE = f"pmod(pmod(doc_id, 2147483647) * 1000003L + line * 7919L, {FILTER_WORDS * 64})"


def has_bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def key_place(key: np.ndarray) -> np.ndarray:
    """The bit of a key in the filter; the same as ``KEY_PLACE`` in SQL."""
    return key & (FILTER_WORDS * 64 - 1)


KEY_PLACE = f"(key & {FILTER_WORDS * 64 - 1}L)"


def bit_filter(rows: DataFrame, place: str) -> np.ndarray:
    """A bit set of fixed size with one bit per row, by hash, so that few other rows pass."""
    words = rows.selectExpr(f"int({place} div 64) AS word", f"shiftleft(1L, int({place} % 64)) AS bit")
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(FILTER_WORDS, np.int64)
    found[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return found


def line_contents(texts: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The lines whose bit is set, cut out of the texts; one per (doc_id, line)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                lines = pc.split_pattern(batch.column(1), "\n")
                each = lines.value_lengths().to_numpy()
                owners = np.repeat(batch.column(0).to_numpy(), each)
                numbers = np.arange(len(owners)) - np.repeat(np.cumsum(each) - each, each)
                chosen = np.flatnonzero(has_bit(wanted, line_place(owners, numbers)))
                contents = lines.flatten().take(pa.array(chosen))
                yield pa.RecordBatch.from_arrays([pa.array(owners[chosen]), pa.array(numbers[chosen], pa.int32()), contents.cast(pa.string())], names=["doc_id", "line", "content"])

    return texts.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(cut, "doc_id long, line int, content string").dropDuplicates(["doc_id", "line"])


def similar_lines(pairs: DataFrame, lines: DataFrame, threshold: Fraction) -> DataFrame:
    """(doc_id, line) of the later lines of all pairs that are similar enough."""
    top, bottom = threshold.numerator, threshold.denominator

    def tokens(content: str) -> set[bytes]:
        return set(content.encode().lower().split())  # of bytes: A-Z only, and the white space of ASCII

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                one, two = tokens(a.as_py()), tokens(b.as_py())
                common = len(one & two)
                linked.append(common * bottom >= (len(one) + len(two) - common) * top)
            yield batch.filter(pa.array(linked, pa.bool_())).select([0, 1])

    left, right = (lines.select(F.col("doc_id").alias(f"{s}_doc_id"), F.col("line").alias(f"{s}_line"), F.col("content").alias(f"{s}_content")) for s in ("a", "b"))
    both = pairs.join(left, ["a_doc_id", "a_line"]).join(right, ["b_doc_id", "b_line"])
    found = both.select("b_doc_id", "b_line", "a_content", "b_content").mapInArrow(compare, "b_doc_id long, b_line int")
    return found.select(F.col("b_doc_id").alias("doc_id"), F.col("b_line").alias("line")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, threshold: Fraction) -> DataFrame:
    """(doc_id, line) of the later lines of stored pairs that are similar enough."""
    sides = [pairs.select(F.col(f"{s}_doc_id").alias("doc_id"), F.col(f"{s}_line").alias("line")) for s in ("a", "b")]
    return stored(similar_lines(pairs, line_contents(texts, bit_filter(sides[0].union(sides[1]), PLACE)), threshold))


def duplicate_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: Fraction = THRESHOLD, part_lines: int = PART_LINES) -> DataFrame:
    """(doc_id, line) of every line that an earlier line makes superfluous; lines count from 0."""
    if not Fraction(1, 2) <= threshold <= 1:
        raise ValueError("threshold must lie between 1/2 and 1")
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    counts = token_counts(texts)
    # Of equal lines the earliest is single; rows of the same line, by a repeated id, are no copies of each other.
    equal = Window.partitionBy("digest").orderBy("doc_id", "line")
    placed = line_table(texts, counts, threshold).withColumns({"place": F.row_number().over(equal), "earlier": F.rank().over(equal)})
    lines = stored(placed.select("doc_id", "line", "size", *PARITY, "tokens", (F.col("copy") | (F.col("earlier") > 1)).alias("copy"), (~F.col("copy") & (F.col("place") == 1)).alias("single")))
    copies = stored(lines.filter("copy").select("doc_id", "line"))
    single = lines.filter("single")
    meetings = meeting_rows(single, counts, part_lines)
    earliest = stored(candidates(meetings, threshold, every=False).groupBy("a_doc_id", "a_line", "b_doc_id", "b_line").agg(F.max("more").alias("more")))
    found = verified(earliest.drop("more"), texts, threshold)
    unsettled = earliest.filter("more").select(F.col("b_doc_id").alias("doc_id"), F.col("b_line").alias("line")).distinct()
    waiting = stored(unsettled.join(found, ["doc_id", "line"], "left_anti"))
    discard(earliest)
    # Only lines that wait ask again, and only the keys they visit are dealt; a few others, by hash, change no result.
    keys = asked_keys(single.join(waiting, ["doc_id", "line"], "left_semi"), counts, part_lines)
    visited = meeting_rows(single, counts, part_lines, (bit_filter(keys, KEY_PLACE), bit_filter(waiting, PLACE)))
    others = stored(candidates(visited, threshold, every=True).drop("more").distinct())
    more = verified(others, texts, threshold)
    discard(lines, waiting, others)
    return copies.unionByName(found).unionByName(more)


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: Fraction = THRESHOLD) -> tuple[DataFrame, str]:
    """``docs`` with the duplicate lines cut out of the text, and the name of an added column that lists their numbers."""
    name = "removed_lines"
    while any(name in c for c in docs.columns):
        name += "_"
    removed = duplicate_lines(docs, id_column, text_column, threshold).groupBy(F.col("doc_id").alias(f"{name}_id")).agg(F.sort_array(F.collect_set("line")).alias(name))
    joined = docs.join(removed, docs[id_column].cast("long") == removed[f"{name}_id"], "left").drop(f"{name}_id")
    apart = joined.withColumn(f"{name}_all", F.when(F.col(name).isNotNull(), F.split(text_column, "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(f"{name}_all") - 1), F.col(name))
    cleaned = F.when(F.col(name).isNull(), F.col(text_column)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(f"{name}_all", i)), "\n"))
    return apart.withColumns({text_column: cleaned, name: F.coalesce(name, F.array().cast("array<int>"))}).drop(f"{name}_all"), name

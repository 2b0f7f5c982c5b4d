"""Hard negatives: for an anchor and each of its best rows of the same label, the best rows of other labels whose score
lies in a window below that of the positive.

Scores are exact inner products of whole numbers. Rows lie in tiles of bounded size, one per task; anchors are dealt to
the tiles and stream past them, multiplied in blocks. A first pass over tiles of one label sends the best rows of the
anchor's label in each tile, which fix the windows; a second pass over all tiles sends for every window the best rows
inside it. What is sent does not depend on how large a label, or how common a vector is, and nothing that could be among
the results is left out.

Every score sent is packed into a key of (anchor, falling score, positives first, id), whose bytes sort in that order. A
secondary sort, dealt by anchor and sorted by key inside partitions, lets one stream see each anchor from its best row
downwards: positives open windows, rows of other labels fill the windows they fall into, and nothing of an anchor is held
but its few open windows.

Defined results: rows without an id or a label, and rows whose vector is NULL, of another length than most vectors, or
holds NULL, NaN or infinite entries, take no part. Of rows with the same id the one with the smallest label, then vector,
counts. Rows of equal score come by smaller id. Anchors without a positive, and windows without a row, give no result. A
positive with a negative score has an empty window. Further columns are ignored, an empty table gives an empty result.
Ids and labels are whole numbers. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossfoot.llm.storage import stored
from crossfoot.llm.vectors import common_length, scaled_floor, usable

#: Most rows of a tile: what one task holds while anchors pass.
TILE_ROWS = 524_288
#: Anchors and rows that are multiplied at once.
ANCHOR_BLOCK, ROW_BLOCK = 256, 4096
CANDIDATE = "anchor_id long, score long, other_id long, key binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
KEY = np.dtype([("anchor", ">u8"), ("fall", ">u8"), ("kind", "u1"), ("id", ">u8")])
FLIP = np.uint64(1 << 63)


def packed_keys(anchors: np.ndarray, scores: np.ndarray, kind: int, ids: np.ndarray) -> pa.Array:
    """Keys whose bytes sort by anchor, falling score, positives (kind 0) first, and id."""
    keys = np.empty(len(ids), KEY)
    keys["anchor"], keys["id"] = anchors.astype(np.int64).view(np.uint64) ^ FLIP, ids.astype(np.int64).view(np.uint64) ^ FLIP
    keys["fall"], keys["kind"] = ~(scores.view(np.uint64) ^ FLIP), kind
    bounds = np.arange(len(ids) + 1, dtype=np.int32) * KEY.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(bounds), pa.py_buffer(keys.tobytes())])


def unpacked_keys(column: pa.Array) -> tuple[list[int], list[int], list[int], list[int]]:
    """Anchors, scores, kinds and ids of packed keys."""
    keys = np.frombuffer(b"".join(column.to_pylist()), KEY)
    anchors, ids, scores = ((part.astype(np.uint64) ^ FLIP).view(np.int64).tolist() for part in (keys["anchor"], keys["id"], ~keys["fall"].astype(np.uint64)))
    return anchors, scores, keys["kind"].tolist(), ids


class Tile:
    """Rows of one tile in ascending order of id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors, self.most = ids, labels, vectors, int(np.abs(vectors).max(initial=0))

    def score_blocks(self, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Scores of some anchors with all rows, a block of rows at a time, in a type that holds them exactly."""
        bound = self.most * int(np.abs(anchors).max(initial=0)) * anchors.shape[1]
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object
        left = anchors.astype(kind)
        for start in range(0, len(self.ids), ROW_BLOCK):
            yield start, left @ self.vectors[start : start + ROW_BLOCK].astype(kind).T


def no_score(scores: np.ndarray) -> float | int:
    """Less than any score of the array's type."""
    return -(1 << 200) if scores.dtype == object else -np.inf


def best(scores: np.ndarray, start: int, n: int, held: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """The n best columns per row, with those held from earlier columns: scores and places; the earlier of equals first.

    Overwrites ``scores``.
    """
    lines, low = np.arange(len(scores)), no_score(scores)
    found, places = ([held[0]], [held[1]]) if held else ([], [])
    for _ in range(min(n, scores.shape[1])):
        at = scores.argmax(axis=1)
        found.append(scores[lines, at][:, None])
        places.append((at + start)[:, None])
        scores[lines, at] = low
    top, where = np.concatenate(found, axis=1), np.concatenate(places, axis=1)
    order = np.argsort(-top, axis=1, kind="stable")[:, :n]
    return np.take_along_axis(top, order, axis=1), np.take_along_axis(where, order, axis=1)


def pair_batch(anchors: np.ndarray, kind: int, tile: Tile, lines: np.ndarray, places: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    names, others = anchors[lines], tile.ids[places]
    whole = np.array(scores.tolist(), np.int64) if scores.dtype == object else scores.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(whole), pa.array(others), packed_keys(names, whole, kind, others)], names=["anchor_id", "score", "other_id", "key"])


def nearest_positives(tile: Tile, batch: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    """Up to n best rows of the tile with the anchor's label, the anchor itself left out."""
    held = None
    for start, scores in tile.score_blocks(batch["x"]):
        part = slice(start, start + ROW_BLOCK)
        scores[(batch["label"][:, None] != tile.labels[part]) | (batch["vec_id"][:, None] == tile.ids[part])] = no_score(scores)
        held = best(scores, start, n, held)
    lines, columns = np.nonzero(held[0] > no_score(held[0]))
    return pair_batch(batch["vec_id"], 0, tile, lines, held[1][lines, columns], held[0][lines, columns])


def rows_in_windows(tile: Tile, batch: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    """For every window of an anchor, up to n best rows of the tile with another label; rows of several windows once."""
    low, high = batch["low"], batch["high"]
    held: list = [None] * low.shape[1]
    for start, scores in tile.score_blocks(batch["x"]):
        nothing = no_score(scores)
        scores[batch["label"][:, None] == tile.labels[start : start + ROW_BLOCK]] = nothing
        for k in range(low.shape[1]):
            inside = np.where((scores >= low[:, k, None].astype(scores.dtype)) & (scores <= high[:, k, None].astype(scores.dtype)), scores, nothing)
            if held[k] is None or (inside > nothing).any():
                held[k] = best(inside, start, n, held[k])
    score, place = np.concatenate([h[0] for h in held], axis=1), np.concatenate([h[1] for h in held], axis=1)
    lines, columns = np.nonzero(score > no_score(score))
    places, scores = place[lines, columns], score[lines, columns]
    _, once = np.unique(lines * len(tile.ids) + places, return_index=True)
    return pair_batch(batch["vec_id"], 1, tile, lines[once], places[once], scores[once])


def meet(rows: DataFrame, anchors: DataFrame, partitions: int, n_windows: int, work: Callable[[Tile, dict[str, np.ndarray]], pa.RecordBatch]) -> DataFrame:
    """Let anchors stream past the rows of their tile: one shuffle that sorts rows of a tile before its anchors."""

    def columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("tile", "is_anchor", "vec_id", "label")}
        for name in ("x", "low", "high"):
            out[name] = batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0), np.int64)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, tile = None, [], None
        for batch in batches:
            plain = columns(batch)
            changes = np.flatnonzero((np.diff(plain["tile"]) != 0) | (np.diff(plain["is_anchor"].astype(np.int8)) != 0)) + 1
            for first, last in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows], strict=True):
                if first == last:
                    continue
                if at != plain["tile"][first]:
                    at, held, tile = plain["tile"][first], [], None
                if not plain["is_anchor"][first]:
                    held.append([plain[c][first:last] for c in ("vec_id", "label", "x")])
                    continue
                if held:
                    tile, held = Tile(*(np.concatenate(part) for part in zip(*held, strict=True))), []
                for start in range(first, last if tile else first, ANCHOR_BLOCK):
                    block = slice(start, min(start + ANCHOR_BLOCK, last))
                    yield work(tile, {name: values[block] for name, values in plain.items()})

    blank = F.array_repeat(F.lit(0).cast("long"), n_windows)
    sides = rows.select("tile", F.lit(False).alias("is_anchor"), "vec_id", "label", "x", blank.alias("low"), blank.alias("high"))
    bounds = [c if c in anchors.columns else blank.alias(c) for c in ("low", "high")]
    passing = anchors.select("tile", F.lit(True).alias("is_anchor"), "vec_id", "label", "x", *bounds)
    both = sides.unionByName(passing).repartition(partitions, "tile").sortWithinPartitions("tile", "is_anchor", "vec_id")
    return both.mapInArrow(run, CANDIDATE)


def opened_windows(candidates: DataFrame, n_positives: int, n_negatives: int, low_percent: int, high_percent: int) -> DataFrame:
    """The secondary sort: anchors in partitions, keys in order, and one stream that opens and fills windows."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for batch in batches:
            out = []
            for name, score, kind, other in zip(*unpacked_keys(batch.column(0)), strict=True):
                if name != anchor:
                    anchor, windows = name, []
                if kind == 0:
                    if len(windows) < n_positives:
                        windows.append([other, score, 0])
                    continue
                for window in windows:
                    positive = window[1]
                    if window[2] < n_negatives and low_percent * positive <= 100 * score <= high_percent * positive:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], other, positive, score))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in out], k) for i, k in enumerate(kinds)], names=names)

    return candidates.repartition("anchor_id").sortWithinPartitions("key").select("key").mapInArrow(stream, RESULT)


def mine_hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on ids
    named ``vec_id``.

    Rows are shuffled once per pass, anchors once per tile. Tiles grow with the table up to ``tile_rows``, so on small
    tables all cores have one.
    """
    spark = embeddings.sparkSession
    length = common_length(embeddings, vector_column)
    vector = embeddings[vector_column]
    usable_rows = embeddings.filter(embeddings[id_column].isNotNull() & embeddings[label_column].isNotNull() & usable(vector, length) & F.lit(length > 0))
    named = usable_rows.select(embeddings[id_column].cast("long").alias("vec_id"), embeddings[label_column].cast("long").alias("label"), scaled_floor(vector, scale).alias("x"))
    # One row per id: sides of the products below must agree on it.
    rows = stored(named.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row")).select("vec_id", "row.label", "row.x"))
    anchors = rows.filter(is_anchor)
    cores = spark.sparkContext.defaultParallelism
    total = rows.count()
    most = max(1, min(tile_rows, -(-total // cores)))

    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    of_label = rows.join(sizes, "label").withColumn("tile", F.xxhash64("label", part))
    own = anchors.join(sizes, "label").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("tile", F.xxhash64("label", "part"))
    spread = max(cores, -(-total // most))
    near = meet(of_label, own, spread, n_positives, lambda tile, batch: nearest_positives(tile, batch, n_positives))
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")))
    positives = stored(ranked.filter(F.col("place") <= n_positives).drop("place"))

    tiles = max(1, -(-total // most))
    # Wide enough that whole percentages of 64-bit scores fit.
    wide = "CAST(score AS DECIMAL(20,0))"
    low, high = F.expr(f"({wide} * {low_percent} + 99) div 100"), F.expr(f"{wide} * {high_percent} div 100")
    padded = [F.expr(f"concat({c}, array_repeat(CAST({v} AS BIGINT), {n_positives} - size({c})))").alias(c) for c, v in (("low", 1), ("high", 0))]
    windows = positives.filter("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(low).alias("low"), F.collect_list(high).alias("high")).select("vec_id", *padded)
    asking = anchors.join(windows, "vec_id").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    everyone = rows.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("long"))
    fitting = meet(everyone, asking, spread, n_positives, lambda tile, batch: rows_in_windows(tile, batch, n_negatives))
    return opened_windows(positives.unionByName(fitting), n_positives, n_negatives, low_percent, high_percent)

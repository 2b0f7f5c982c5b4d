"""Hashed character n-grams of texts, and columns appended to a table by Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that are worked on and handed back at once; a whole Arrow batch of texts and results would be held twice.
BATCH_ROWS = 500


def gram_buckets(text: str, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Bucket of every byte n-gram of the lower-cased text with a space on either side, in all the sizes."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    found, code = [], np.zeros(len(data), np.uint32)
    for n in range(1, max(sizes) + 1):
        if len(data) < n:
            break
        code = code[: len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1 :]
        if n in sizes:
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            found.append(mixed >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def held_out(id_column: Column) -> Column:
    """Rows that no model may learn labels from; a missing id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 5 == 0


def append_column(docs: DataFrame, inputs: list[str], make: Callable[[pa.RecordBatch], pa.Array], kind: T.DataType, wanted: str) -> tuple[DataFrame, str]:
    """``docs`` with one more column, computed per Arrow batch from ``inputs``; returns its name, changed if taken."""
    name = wanted
    while name in docs.columns:
        name += "_"
    places = [docs.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                made = make(pa.RecordBatch.from_arrays([batch.column(i) for i in places], names=inputs))
                yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)])), name

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfoot.llm import hard_negatives
from crossfoot.llm.hard_negatives import Tile, mine_hard_negatives, nearest_positives, packed_keys, rows_in_windows, unpacked_keys

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_force(rows, every=50, n_positives=5, n_negatives=3):
    """All scores of every anchor, sorted, in whole numbers."""
    found = []
    for name, vector, label in rows:
        if name % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=True)), i, other) for i, v, other in rows if i != name)
        positives = [(i, -s) for s, i, other in scored if other == label][:n_positives]
        for positive, p in positives:
            fit = [(i, -s) for s, i, other in scored if other != label and 50 * p <= -100 * s <= 95 * p][:n_negatives]
            found += [(name, positive, k + 1, i, p, s) for k, (i, s) in enumerate(fit)]
    return sorted(found)


def whole(rows, scale=256):
    return [(i, [int(np.floor(float(np.float32(c)) * scale)) for c in v], label) for i, v, label in rows]


def result(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def made(n, d, labels, seed, values=None):
    random.seed(seed)
    centres = [[random.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = min(random.randrange(labels), random.randrange(labels))
        entries = [random.choice(values) if values else 0.6 * c + random.gauss(0.3, 0.5) for c in centres[label]]
        rows.append((i - 7, entries, label))
    return rows


@pytest.mark.parametrize(("seed", "values"), [(1, None), (2, [0.0, 0.25, -0.25, 0.5]), (3, [0.0, 0.0, 1.0])])
def test_against_brute_force(spark, checkpoint_folder, seed, values):
    """Many ties in the second and third tables; tiles smaller than the tables."""
    rows = made(230, 6, 4, seed, values)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"score": F.lit(1), "x": F.lit("x"), "tile": F.lit(0)})
    expected = brute_force(whole(rows), every=5)
    assert len(expected) > 100
    assert result(mine_hard_negatives(frame, F.col("vec_id") % 5 == 0, tile_rows=40)) == expected
    assert result(mine_hard_negatives(frame, F.col("vec_id") % 5 == 0)) == expected


def test_odd_rows(spark, checkpoint_folder):
    rows = [(0, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [0.5, 0.5], 2), (5, [0.5, 0.5], 2), (6, [0.25, 0.5], 3), (50, [-1.0, 0.0], 7), (100, [0.0, 0.0], 9), (101, [0.0, 0.0], 9)]
    odd = [(None, [1.0, 1.0], 1), (200, None, 1), (201, [1.0, None], 1), (202, [1.0, float("nan")], 1), (203, [float("-inf"), 1.0], 1), (204, [1.0, 1.0], None), (205, [1.0], 1), (206, [], 1), (3, [9.0, 9.0], 4)]
    frame = spark.createDataFrame(rows + odd + [rows[2]], SCHEMA)
    out = result(mine_hard_negatives(frame, F.col("vec_id") % 50 == 0))
    assert out == brute_force(whole(rows))
    assert {r[0] for r in out} == {0, 100}  # anchor 50 has no positive


def test_large_scores_stay_exact(spark, checkpoint_folder):
    """Scores of more than 53 bits; beyond 64 bits they are an error, not a wrong row."""
    rows = [(i, [random.Random(i).randrange(1 << 22) + 0.5, float(i % 3)], i % 2) for i in range(120)]
    exact = [(i, [int(c * 256) for c in v], label) for i, v, label in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = result(mine_hard_negatives(frame, F.col("vec_id") % 50 == 0))
    assert out == brute_force(exact) and max(r[4] for r in out) > 1 << 56
    with pytest.raises(Exception, match="overflow|too large|out of bounds"):
        mine_hard_negatives(frame.withColumn("embedding", F.transform("embedding", lambda c: c * 64)), F.col("vec_id") % 50 == 0).collect()


def test_nothing(spark, checkpoint_folder):
    assert mine_hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert mine_hard_negatives(spark.createDataFrame([(50, [1.0], 1)], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_blocks_of_a_tile(monkeypatch):
    """The best rows are the same in whichever blocks a tile is multiplied, in every type of score."""
    rows = whole(made(100, 4, 3, 9, [0.0, 0.5, 1.0]))
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    for factor in (1, 1 << 10, 1 << 22):
        vectors = np.array([r[1] for r in rows]) * factor
        tile = Tile(ids, labels, vectors)
        batch = {"vec_id": ids[::9], "label": labels[::9], "x": vectors[::9]}
        batch |= {"low": np.tile(np.array([[100, 1, 3000]]) * factor**2, (len(batch["x"]), 1)), "high": np.tile(np.array([[90_000, 0, 100_000]]) * factor**2, (len(batch["x"]), 1))}
        found = []
        for block in (4096, 16, 1):
            monkeypatch.setattr(hard_negatives, "ROW_BLOCK", block)
            found.append((nearest_positives(tile, batch, 5).to_pydict(), rows_in_windows(tile, batch, 3).to_pydict()))
        assert found[0] == found[1] == found[2] and len(found[0][1]["key"]) > 30


def test_keys_sort_as_their_parts():
    random.seed(4)
    parts = [(random.choice([-5, 3, 1 << 62]), random.choice([-(1 << 63), -1, 0, 7, (1 << 63) - 1]), random.randint(0, 1), random.choice([-2, 0, 9])) for _ in range(300)]
    keys = [packed_keys(np.array([a]), np.array([s]), k, np.array([i]))[0].as_py() for a, s, k, i in parts]
    assert [p for _, p in sorted(zip(keys, parts, strict=True))] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
    packed = packed_keys(np.array([p[0] for p in parts]), np.array([p[1] for p in parts]), 1, np.array([p[3] for p in parts]))
    assert list(zip(*unpacked_keys(packed), strict=True)) == [(a, s, 1, i) for a, s, _, i in parts]

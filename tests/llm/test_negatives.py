"""Hard negatives against brute force in whole numbers, and what the bounds promise."""

import math

import numpy as np
import pytest

from tidalfed.llm import negatives

SCHEMA = ("vec_id long, embedding array<double>, label int, norm string, cell string, "
          "angles string, row string, score string")
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_force(rows):
    known = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(
                x is None or not math.isfinite(x) for x in vector):
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label,
               [max(-2**63, min(2**63 - 1, math.floor(256 * x))) for x in vector])
        known[vec_id] = min(known.get(vec_id, row), row)
    out = []
    for a, (label, vector) in known.items():
        if a % 50:
            continue
        scored = sorted(
            (-max(-2**63 + 2, min(2**63 - 1, sum(x * y for x, y in zip(vector, v)))), i, k)
            for i, (k, v) in known.items() if i != a and len(v) == len(vector))
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(n, j) for n, j, k in scored
                    if k != label and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "n", "c", "a", "r", "s") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(frame, **options).select(
        *RESULT).collect())


def cloud(n, seed, centres=12, spread=0.4, dims=16):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    at = rng.integers(0, centres, n)
    values = (middle[at] + spread * rng.normal(size=(n, dims))) * rng.choice([0.1, 1, 3], n)[:, None]
    return [(i, v.tolist(), int(c) % 4) for i, (v, c) in enumerate(zip(values, at))]


@pytest.mark.parametrize("chunk_bytes", [2_000, negatives.CHUNK_BYTES])
def test_against_brute_force(spark, chunk_bytes):
    rows = cloud(1500, 1)
    rows += [(2000 + i, rows[50][1], 1) for i in range(400)]  # ties beyond every list
    rows += [(2500 + i, rows[51][1], 2) for i in range(400)]
    assert mined(spark, rows, chunk_bytes=chunk_bytes) == brute_force(rows)


def test_odd_rows(spark):
    line = [(i, [1.0 + i / 100, -0.5, 0.25], i % 3) for i in range(120)]
    odd = [(None, [1.0, 1.0, 1.0], 1), (201, None, 1), (202, [1.0, None, 1.0], 1),
           (203, [1.0, float("nan"), 1.0], 1), (204, [1.0, float("inf"), 1.0], 1),
           (205, [1.0, 1.0, 1.0], None), (206, [], 0), (250, [], 0), (207, [], 1),
           (300, [0.0, 0.0, 0.0], 1), (208, [0.0, 0.0, 0.0], 2), (350, [1.0, 2.0], 1),
           (209, [1.0, 2.0], 1), (210, [0.9, 1.0], 2), (100, [9.0, 9.0, 9.0], 2),
           (100, [9.0, 9.0, 9.0], 2), (-50, [0.3, 0.3, 0.3], 1), (-7, [0.2, 0.2, 0.2], 1)]
    assert mined(spark, line + odd) == brute_force(line + odd)


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (v * 10 ** (4 + i % 3 * 5)).tolist(), i % 2)
            for i, v in enumerate(rng.uniform(0.5, 1, (160, 4)))]
    rows.append((400, [1e300, -1e300, 3.0, 1e18], 1))
    assert mined(spark, rows) == brute_force(rows)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(50, [1.0, 2.0], 1)]) == []


def test_bounds_hold_and_skip():
    """No score lies outside a block's bounds, and far blocks are passed over."""
    rows = cloud(2000, 5, spread=0.05)
    vectors = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    norms = negatives.norms_of(vectors)
    directions = vectors[:16] / norms[:16, None]

    def part(at):
        out = object.__new__(negatives.Vectors)
        out.ids, out.labels = np.array(at), np.array([rows[i][2] for i in at])
        out.vectors, out.norms = vectors[at], norms[at]
        out.angles = negatives.angles_to(vectors[at], norms[at], directions)
        return out

    anchors, skipped = part(list(range(0, 2000, 50))), 0
    for label in range(4):
        mine = part([i for i, r in enumerate(rows) if r[2] == label][:300])
        mine = mine.take(np.argsort(mine.angles.argmin(axis=1), kind="stable"))
        for at in range(0, 300, 50):
            block = mine.take(slice(at, at + 50))
            low, high = negatives.bounds(anchors, block)
            found = negatives.scores(anchors.vectors, block.vectors, 1.0)
            assert (found >= low[:, None]).all() and (found <= high[:, None]).all()
            skipped += (high < 0.5 * anchors.norms * block.norms.max()).sum()
    assert skipped > 100

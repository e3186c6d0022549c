"""Hard negatives against plain inner products over all pairs."""

import math
import random

import numpy as np
import pytest

from quotemill.llm import hardneg


def brute(rows, positives=5, negatives=10):
    use = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        use.append((vec_id, [math.floor(256 * x) for x in vector], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, (a, v, label) in enumerate(use):
        if a % 100:
            continue
        scored = [(-dot(v, w), b, j, other) for j, (b, w, other) in enumerate(use) if j != i]
        for ps, p, _, _ in sorted(x for x in scored if x[3] == label)[:positives]:
            inside = sorted(x[:2] for x in scored if x[3] != label and -30 * ps <= -100 * x[0] <= -90 * ps)
            out += [(a, p, k + 1, n, -ps, -s) for k, (s, n) in enumerate(inside[:negatives])]
    return sorted(out)


def vectors(n, dims, labels, seed=3, spread=0.4):
    rnd = random.Random(seed)
    centre = {c: [rnd.uniform(-1, 1) for _ in range(dims)] for c in range(labels)}
    rows = []
    for i in range(n):
        label = 0 if rnd.random() < 0.34 else rnd.randrange(labels)
        rows.append((i, [float(np.float32(0.4 * c + rnd.gauss(0, spread))) for c in centre[label]], label))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("chunk", "block"), [(4096, 16 << 20), (17, 1)])
def test_equal_to_all_pairs(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(hardneg, "CHUNK", chunk)
    monkeypatch.setattr(hardneg, "BLOCK_BYTES", block)
    monkeypatch.setattr(hardneg, "TILE", 3)
    rows = vectors(900, 19, 6)
    rows = [(i - 200 if i % 5 else 100 * (i - 450), v, c) for i, v, c in rows]
    got = hardneg.mine(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_ties_repeats_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "CHUNK", 16)
    rows = vectors(150, 4, 3, seed=8)
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 3) for i in range(90)]  # many equal vectors
    rows += [(300, [0.5, 0.5, 0.5, 0.5], 0), (300, [0.5, 0.5, 0.5, 0.5], 0)]  # a repeated anchor
    rows += [(400, [], 1), (500, [0.3, 0.2], 1), (600, [3.0, -3.5, 0.1, 2.0, 0.7], 1), (-100, [0.0] * 4, 2)]
    rows += [(700, None, 1), (800, [0.1, None], 1), (900, [float("nan")], 1), (1100, [float("inf")], 1), (None, [0.1], 1), (1200, [0.1], None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", row string, block int").repartition(4)
    assert sorted(map(tuple, hardneg.mine(frame).collect())) == brute(rows)


def test_empty_tables(spark):
    frame = spark.createDataFrame(vectors(30, 3, 2), SCHEMA)
    assert hardneg.mine(frame.limit(0)).count() == 0
    assert hardneg.mine(frame.filter("vec_id > 0")).count() == 0  # rows, but no anchor
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA)
    assert hardneg.mine(alone).count() == 0  # no positive


def test_scores_that_could_overflow_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        hardneg.mine(spark.createDataFrame([(0, [1e30], 1), (1, [-1e30], 1)], SCHEMA))


def test_tables_and_planes():
    rng = np.random.default_rng(1)
    for top, dims in ((1, 8), (300, 16), (2**20, 24)):
        a, c = (rng.integers(-top, top, (n, dims)) for n in (9, 33))
        planes = hardneg.bit_planes(c, int(top).bit_length() + 1)
        assert (hardneg.from_planes(planes) == c).all()
        assert (hardneg.scores(hardneg.subset_sums(a, np.int64), planes) == c @ a.T).all()

"""Hard negatives against plain loops in whole numbers."""

import math

import pytest
from llm_data import DATA
from pyspark.sql import functions as F

from gneiss.llm import hard_negatives


def plain_mine(rows, modulus, positives=5, negatives=3):
    """rows: (id, label, vector) that take part."""
    held = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    out = []
    for i, y, v in held:
        if i % modulus:
            continue
        score = lambda w: max(-(2**63) + 2, min(2**63 - 2, sum(a * b for a, b in zip(v, w, strict=True))))  # noqa: B023, E731
        others = [(-score(w), j, z) for j, z, w in held if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in others if x[2] == y)[:positives]:
            window = sorted(x for x in others if x[2] != y and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(window)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


@pytest.mark.parametrize("block_rows", [1 << 14, 3])
def test_against_loops(vectors, block_rows):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in vectors.collect()]
    found = hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == plain_mine(rows, 50)


def test_small_tiles(vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_CELLS", 64)
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in vectors.collect()]
    assert sorted(map(tuple, hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0).collect())) == plain_mine(rows, 50)


def test_odd_rows(spark):
    """Nulls, infinities, ties, repeated rows, two dimensions, huge components, clashing columns."""
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 3, [float((i * k) % 5) / 3 + 0.2 for k in range(1, 5)]) for i in range(60)]
    good += [(100 + i, 1, [1.0, 0.5, 0.25, 0.125]) for i in range(8)] + [(200 + i, i % 2, [0.5, i / 8]) for i in range(12)]
    good += [(300, 1, [1e30, 1.0, 0.0, 0.0]), (301, 2, [1e30, -1.0, 0.0, 0.0]), (302, 1, [1e9, 2.0, 0.0, 0.0]), (303, 2, [1e9, 0.0, 0.0, 3.0])]
    bad = [(400, None, [1.0] * 4), (401, 1, None), (402, 1, [1.0, None, 1.0, 1.0]), (410, 1, [1.0, nan, 1.0, 1.0]), (405, 1, [inf, 1.0, 1.0, 1.0]), (None, 1, [1.0] * 4)]
    df = spark.createDataFrame([(*r, 1.0, "k") for r in good + bad], "vec_id long, label int, embedding array<double>, score double, key string")
    clipped = [(i, y, [min(x, 2.0**54) for x in v]) for i, y, v in good]
    found = hard_negatives.mine(df, F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == plain_mine(clipped, 5)
    twice = hard_negatives.mine(df.where("vec_id = 0").union(df.where("vec_id between 1 and 20")).union(df.where("vec_id = 6")), F.col("vec_id") == 0)
    rows = [r for r in good if r[0] <= 20]
    assert sorted(map(tuple, twice.collect())) == plain_mine(rows + [good[6]], 1000)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_lists_merge_in_any_order():
    import numpy as np

    rng = np.random.default_rng(0)
    scores, ids = rng.integers(0, 5, (1, 40)), rng.permutation(40)
    expected = sorted((-s, i) for s, i in zip(scores[0], ids, strict=True))[:4]
    for order in (np.arange(40), np.arange(40)[::-1]):
        best = hard_negatives.Best(1, 4)
        for lo in range(0, 40, 7):
            at = order[lo : lo + 7]
            best.add(np.array([0]), scores[:, at], ids[None, at], np.ones((1, len(at)), bool))
        assert [(-s, i) for s, i in zip(best.scores[0], best.ids[0], strict=True)] == expected

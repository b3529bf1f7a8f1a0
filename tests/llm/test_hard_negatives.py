import math
import random

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from perennia.llm import hard_negatives
from perennia.llm.hard_negatives import Window, inner_products, mine_hard_negatives
from perennia.llm.oracles import ORACLES
from perennia.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, scores int"


def plain(rows, window=Window(), step=10):
    """Every pair by loops."""
    usable = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        one = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        usable[vec_id] = min(usable.get(vec_id, one), one)
    out = []
    for anchor, (label, vector) in usable.items():
        if anchor % step:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, v)), i, l) for i, (l, v) in usable.items() if i != anchor and len(v) == len(vector)
        )
        for p_score, positive, _ in [x for x in scored if x[2] == label][: window.positives]:
            inside = [
                (i, -s) for s, i, l in scored if l != label and window.low * -p_score <= 100 * -s <= window.high * -p_score
            ]
            out += [(anchor, positive, r, i, -p_score, s) for r, (i, s) in enumerate(inside[: window.negatives], 1)]
    return sorted(out)


def mined(spark, rows, window=Window(), step=10):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, mine_hard_negatives(frame, F.col("vec_id") % step == 0, window=window).collect()))


@pytest.mark.parametrize("block, share", [(1024, 1_000_000), (3, 50)])
def test_equals_all_pairs(spark, monkeypatch, block, share):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "SHARE", share)
    rng = random.Random(block)
    # Few different numbers, so that scores tie often.
    rows = [(i, [rng.choice([0.0, 0.25, 0.5, -0.1]) for _ in range(6)], rng.randrange(3)) for i in range(300)]
    want = plain(rows)
    assert len(want) > 300
    assert mined(spark, rows) == want
    narrow = Window(positives=3, negatives=2, low=90, high=99)
    assert mined(spark, rows, narrow) == plain(rows, narrow)


def test_one_common_vector_and_one_common_label(spark):
    rows = [(i, [0.5, 0.5], 1 if i % 3 else 2) for i in range(200)] + [(i, [0.25, -0.7], 1) for i in range(200, 260)]
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.5], 1), (1, [0.5, 0.4], 1), (2, [0.5, 0.39], 2), (3, None, 2), (4, [0.5, None], 2), (5, [nan, 0.5], 2),
        (6, [inf, 0.5], 2), (7, [0.5, 0.5], None), (None, [0.5, 0.45], 2), (8, [0.5], 2), (9, [], 2), (10, [], 1),
        (11, [], 1), (20, [-0.5, 0.0], 1), (21, [0.5, 0.0], 1), (30, [0.0, 0.0], 3), (31, [0.0, 0.0], 3), (2, [0.5, 0.39], 2),
        (12, [0.5, 0.45], 2), (12, [0.5, 0.2], 1),
    ]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows[:0]) == []
    assert mined(spark, [r for r in rows if r[0] and r[0] % 10]) == []


def test_products_are_exact():
    rng = random.Random(1)
    for size in (3, 100, 1 << 20, 1 << 30):
        a = np.array([[rng.randint(-size, size) for _ in range(8)] for _ in range(4)])
        b = np.array([[rng.randint(-size, size) for _ in range(8)] for _ in range(5)])
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert inner_products(a, b).tolist() == want
    far = np.full((1, 4), 1 << 62)
    assert inner_products(far, far).tolist() == [[(1 << 63) - 1]]
    assert inner_products(far, -far).tolist() == [[-(1 << 63)]]


def test_window_must_not_reach_above_the_positive(spark):
    with pytest.raises(ValueError):
        mine_hard_negatives(spark.createDataFrame([], SCHEMA), F.lit(True), window=Window(high=101))


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.1"
    assert compare(spark, connect(folder), op13_hard_negatives, ORACLES["op13_hard_negatives"], folder) is None

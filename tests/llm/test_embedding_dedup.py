import math
import random

import numpy as np

from perennia.llm import embedding_dedup
from perennia.llm.embedding_dedup import near_vectors
from perennia.llm.queries import op1_embedding_dedup


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.9):
    parent = {i: i for i, _ in rows}
    links = {i: 0 for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [(i, np.array(v, float)) for i, v in rows if usable(v)]
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (links[i], root(i), root(i) == i) for i, _ in rows}


def got(frame):
    return {r[0]: (r["n_links"], r["component_id"], r["kept"]) for r in frame.collect()}


def vectors(rng, n, dims, groups):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres) if rng.random() < 0.6 else [rng.gauss(0, 1) for _ in range(dims)]
        spread = rng.choice([0.0, 0.1, 0.2, 0.33])
        rows.append((i * 7 + 3, [x + rng.gauss(0, spread) if spread else x for x in centre]))
    rng.shuffle(rows)
    return rows


def test_equal_to_brute_force_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 40)
    monkeypatch.setattr(embedding_dedup, "STRIP", 16)
    rng = random.Random(3)
    rows = vectors(rng, 400, 24, 12)
    rows += [(-1, None), (-2, []), (-3, [0.0] * 24), (-4, [None] + [1.0] * 23), (-5, [math.nan] + [1.0] * 23), (-6, [math.inf] * 24)]
    rows += [(-7, [1.0, 2.0]), (-8, [2.0, 4.0]), (-9, [1e200] * 24), (-10, [1e-200] * 24), (-11, [3.0]), (-12, [-3.0]), (-13, [4.0])]
    table = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    small = [(i, [x / 1e200 if abs(x) > 1e100 else x * 1e200 if v and abs(x) < 1e-100 and x else x for x in v] if usable(v) else v) for i, v in rows]
    assert got(near_vectors(table)) == brute(small)


def test_repeats_and_empty_table(spark):
    rows = [(4, [1.0, 0.0]), (4, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (9, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = sorted(map(tuple, near_vectors(table).collect()), key=str)
    assert out == sorted([(4, 2, 2, False), (4, 2, 2, False), (2, 2, 2, True), (None, 0, None, True), (9, 0, 9, True)], key=str)
    assert near_vectors(table.where("false")).count() == 0


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(op1_embedding_dedup(spark, folder)) == brute(rows)

import itertools
import random
import zlib

import numpy as np

from perennia.llm import toxicity
from perennia.llm.queries import op7_toxicity
from perennia.llm.toxicity import forward_backward, learn_toxicity, score_toxicity, toxic_spans, train, word_marginals


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    emissions, transitions = rng.normal(size=(4, 6)), rng.normal(size=(2, 2))
    lengths = np.array([6, 4, 1, 5])
    marginals, expected = forward_backward(emissions, lengths, transitions)
    moves = np.zeros((2, 2))
    for row, length in enumerate(lengths):
        weights = {
            s: np.exp(sum(emissions[row, t] * x for t, x in enumerate(s)) + sum(transitions[a, b] for a, b in zip(s, s[1:])))
            for s in itertools.product((0, 1), repeat=int(length))
        }
        total = sum(weights.values())
        for t in range(length):
            assert abs(marginals[row, t] - sum(w for s, w in weights.items() if s[t]) / total) < 1e-9
        for s, w in weights.items():
            for a, b in zip(s, s[1:]):
                moves[a, b] += w / total
    assert np.allclose(moves, expected)


def test_slope_of_the_likelihood():
    """Expected minus marked transitions is the numerical slope."""
    rng = np.random.default_rng(3)
    emissions, transitions, lengths = rng.normal(size=(1, 5)), rng.normal(size=(2, 2)), np.array([5])

    def log_total(moves):
        return np.log(sum(
            np.exp(sum(emissions[0, t] * x for t, x in enumerate(s)) + sum(moves[a, b] for a, b in zip(s, s[1:])))
            for s in itertools.product((0, 1), repeat=5)
        ))

    _, expected = forward_backward(emissions, lengths, transitions)
    for a, b in itertools.product((0, 1), repeat=2):
        moved = transitions.copy()
        moved[a, b] += 1e-6
        assert abs((log_total(moved) - log_total(transitions)) / 1e-6 - expected[a, b]) < 1e-4


def test_long_texts_are_tagged_whole():
    scores = np.full(1000, -3.0)
    scores[[0, 400, 999]] = 9.0
    marginals, _ = word_marginals(scores, [0, 1000, 0], np.zeros((2, 2)))
    assert (marginals > 0.5).nonzero()[0].tolist() == [0, 400, 999]


def corpus(rng, n):
    stems, plain = ["grobli", "fuxt"], [f"wort{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice("abcdefghij") + rng.choice("klmnop"))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_documents_and_spans(spark):
    rows = corpus(random.Random(2), 600)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in score_toxicity(docs, learn_toxicity(docs, labels)).collect()}
    assert len(out) == 600
    for i, text, toxic in rows:
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        if out[i]["held_out"]:
            assert out[i]["predicted"] == toxic
            found = [text[s["start"] : s["end"]].split() for s in out[i]["spans"]]
            assert [w for ws in found for w in ws] == [w for w in text.split() if w.startswith(("grobli", "fuxt"))]


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = corpus(random.Random(5), 120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")

    def scores(flip):
        labels = spark.createDataFrame(
            [(i, 1 - x if flip and zlib.crc32(str(i).encode()) % 4 == 2 else x) for i, _, x in rows], "doc_id long, toxic int"
        )
        return {r["doc_id"]: r["score"] for r in score_toxicity(docs, learn_toxicity(docs, labels)).collect()}

    assert scores(False) == scores(True)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (2, "  "), (None, "a b"), (3, "x " * 50_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = learn_toxicity(docs, none)
    out = score_toxicity(docs, model).collect()
    assert len(out) == 5 and all(0 <= r["score"] < 0.3 and r["predicted"] == 0 and r["spans"] == [] for r in out)
    assert score_toxicity(docs.where("false"), model).count() == 0
    one_kind = spark.createDataFrame([(3, 1), (3, None), (None, 0), (3, 1)], "doc_id long, toxic int")
    assert score_toxicity(docs, learn_toxicity(docs, one_kind)).count() == 5
    assert toxic_spans("a bb  cc d", np.array([0.9, 0.8, 0.1, 0.7])) == [(0, 4), (9, 10)]
    assert train([], []).logistic[0] < 0 and toxicity.chains([]) [0].tolist() == []


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op7_toxicity(spark, folder).collect()
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == x for p, x in tested) >= 0.97 * len(tested)
    assert all(p == 1 for p, x in tested if x) or sum(1 for p, x in tested if x and not p) <= 1


def test_short_words_can_be_toxic():
    rng = random.Random(8)
    words = [f"wort{i}" for i in range(50)] + ["ein", "du", "ab"]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(200)]
    toxic = [i % 2 == 1 for i in range(200)]
    slurs = ["zog", "xi", "q"]
    texts = [t + " " + " ".join(rng.choices(slurs, k=3)) if bad else t for t, bad in zip(texts, toxic)]
    labels = toxicity._token_labels([t.split() for t in texts], toxic)
    for text, bad, marked in zip(texts, toxic, labels):
        assert [w for w, m in zip(text.split(), marked) if m] == [w for w in text.split() if w in slurs]

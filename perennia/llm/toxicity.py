"""Toxic spans by a linear-chain conditional random field, and scores of documents from its marginals.

The labels are of documents. Tokens are labelled from them: in documents marked toxic a word is toxic if
it, or its beginning, is far more frequent there than elsewhere. A field of two states is trained on
these tokens by gradient ascent; its emission weights belong to hashed forms of the word (whole,
beginnings, ending), its transitions to the chain. Every document is then tagged whole, in chains
of `CHAIN` words; forward-backward gives the marginal of each word, and their sum and maximum, by a
logistic fit on the training documents, the score.

The model is fitted on a bounded sample of labelled rows, `SAMPLE_TOXIC` and `SAMPLE_CLEAN` documents
of at most `SAMPLE_CHARS` characters each; the scores cover all rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import filled
from perennia.llm.tokens import kept, slices

SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1000, 1500, 20_000
CHAIN = 256
BUCKETS = 1 << 18
ROUNDS, RATE, DECAY = 40, 0.3, 1e-4
#: A form marks toxic words if its odds are so many times those elsewhere, in so many documents.
ODDS, LEAST_DOCUMENTS = 60.0, 3
REMEMBERED = 300_000
EDGES = ".,;:!?\"'()[]{}<>…«»“”„"


class ToxicityModel(NamedTuple):
    weights: np.ndarray  # by hashed form
    transitions: np.ndarray  # scores from state to state
    logistic: tuple[float, float, float]  # constant, log(1 + expected toxic words), largest marginal


def forms(word: str) -> list[str]:
    """What the emission weights of a word belong to."""
    word = word.strip(EDGES).lower()
    return ["", f"={word}", *[f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) >= n], f"${word[-3:]}"]


def _bucket(form: str) -> int:
    return zlib.crc32(form.encode("utf-8", "replace")) % BUCKETS


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 of each chain (a row, `lengths` words long), and expected transitions over all.

    `emissions` are the scores of state 1; those of state 0 are zero.
    """
    n, width = emissions.shape
    move = np.exp(transitions)
    weight = np.exp(np.clip(emissions, -30, 30))
    ahead = np.empty((width, 2, n))
    behind = np.ones((width, 2, n))
    for t in range(width):
        if t:
            ahead[t, 0] = ahead[t - 1, 0] * move[0, 0] + ahead[t - 1, 1] * move[1, 0]
            ahead[t, 1] = (ahead[t - 1, 0] * move[0, 1] + ahead[t - 1, 1] * move[1, 1]) * weight[:, t]
        else:
            ahead[0, 0], ahead[0, 1] = 1.0, weight[:, 0]
        ahead[t] /= ahead[t].sum(axis=0)
    for t in range(width - 2, -1, -1):
        inside = lengths > t + 1
        later = behind[t + 1, 1] * weight[:, t + 1]
        zero = behind[t + 1, 0] * move[0, 0] + later * move[0, 1]
        one = behind[t + 1, 0] * move[1, 0] + later * move[1, 1]
        scale = zero + one
        behind[t, 0], behind[t, 1] = np.where(inside, zero / scale, 0.5), np.where(inside, one / scale, 0.5)
    both = ahead * behind
    marginals = (both[:, 1] / both.sum(axis=1)).T
    expected = np.zeros((2, 2))
    if width > 1:
        pairs = np.empty((2, 2, width - 1, n))
        for a in (0, 1):
            for b in (0, 1):
                pairs[a, b] = ahead[:-1, a] * move[a, b] * behind[1:, b] * (weight.T[1:] if b else 1.0)
        inside = np.arange(1, width)[:, None] < lengths
        expected = (pairs / pairs.sum(axis=(0, 1)) * inside).sum(axis=(2, 3))
    return marginals, expected


def chains(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where in the words of all documents each chain begins, and how long it is."""
    starts, lengths, at = [], [], 0
    for size in sizes:
        for begin in range(0, size, CHAIN):
            starts.append(at + begin)
            lengths.append(min(CHAIN, size - begin))
        at += size
    return np.array(starts, np.int64), np.array(lengths, np.int64)


def word_marginals(scores: np.ndarray, sizes: list[int], transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all words, and expected transitions; `scores` are the emissions, document after document."""
    starts, lengths = chains(sizes)
    out, expected = np.zeros(len(scores)), np.zeros((2, 2))
    # Chains of like length go together, so that little is padded.
    order = np.argsort(lengths, kind="stable")
    for group in np.array_split(order, max(1, len(order) // 2000)):
        if not len(group):
            continue
        width = int(lengths[group].max())
        places = starts[group][:, None] + np.arange(width)
        inside = np.arange(width) < lengths[group][:, None]
        emissions = np.where(inside, scores[np.minimum(places, len(scores) - 1)], 0.0)
        marginals, moves = forward_backward(emissions, lengths[group], transitions)
        out[places[inside]] = marginals[inside]
        expected += moves
    return out, expected


def _token_labels(documents: list[list[str]], toxic: list[bool]) -> list[np.ndarray]:
    """For each document which words are toxic, from the labels of the documents."""
    # Near copies of one document are one witness: mostly they share their smallest shingle.
    families: dict[tuple[bool, int], set[str]] = {}
    for words, label in zip(documents, toxic):
        shingles = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
        key = min((zlib.crc32(" ".join(s).encode("utf-8", "replace")) for s in shingles), default=0)
        families.setdefault((label, key), set()).update(words)
    seen, number = (Counter(), Counter()), Counter(label for label, _ in families)
    for (label, _), words in families.items():
        seen[label].update({form for word in words for form in forms(word)[1:-1]})

    @lru_cache(maxsize=None)
    def odds(word: str) -> float:
        best = 0.0
        for form in forms(word)[1:-1]:
            yes, no = seen[1][form], seen[0][form]
            # A beginning of three letters says too little; a whole word may be as short as it likes.
            if yes >= LEAST_DOCUMENTS and (form[0] == "=" or len(form) > 4):
                best = max(best, (yes + 0.5) / (number[True] + 1) / ((no + 0.5) / (number[False] + 1)))
        return best

    out = []
    for words, label in zip(documents, toxic):
        values = np.array([odds(w) if label else 0.0 for w in words])
        marked = values >= ODDS
        if label and len(words) and not marked.any() and values.max() > 1:
            marked = values == values.max()
        out.append(marked)
    return out


def train(texts: list[str], toxic: list[bool]) -> ToxicityModel:
    """The field and the logistic fit, from labelled texts."""
    documents = [t.split() for t in texts]
    words = sorted({w for d in documents for w in d})
    number = {w: i for i, w in enumerate(words)}
    tokens = np.array([number[w] for d in documents for w in d], np.int64)
    sizes = [len(d) for d in documents]
    buckets = [[_bucket(f) for f in forms(w)] for w in words]
    owner = np.repeat(np.arange(len(words)), [len(b) for b in buckets])
    bucket = np.array([b for own in buckets for b in own], np.int64)
    marked = np.concatenate([np.zeros(0), *_token_labels(documents, toxic)])
    weights, transitions = np.zeros(BUCKETS), np.zeros((2, 2))
    weights[_bucket("")] = -4.0
    if len(tokens):
        first, lengths = chains(sizes)
        pairs = np.zeros((2, 2))
        inside = np.ones(len(tokens), bool)
        inside[first] = False
        np.add.at(pairs, (marked[:-1][inside[1:]].astype(int), marked[1:][inside[1:]].astype(int)), 1)
        squares, moved = np.full(BUCKETS, 1e-8), np.full((2, 2), 1e-8)
        scale = 1.0 / max(1.0, marked.sum())
        for _ in range(ROUNDS):
            scores = np.bincount(owner, weights[bucket], len(words))[tokens]
            marginals, expected = word_marginals(scores, sizes, transitions)
            by_word = np.bincount(tokens, marked - marginals, len(words))
            slope = np.bincount(bucket, by_word[owner], BUCKETS) * scale - DECAY * weights
            squares += slope * slope
            weights += RATE * slope / np.sqrt(squares)
            turn = (pairs - expected) * scale - DECAY * transitions
            moved += turn * turn
            transitions += RATE * turn / np.sqrt(moved)
    scores = np.bincount(owner, weights[bucket], len(words))[tokens] if len(tokens) else np.zeros(0)
    marginals, _ = word_marginals(scores, sizes, transitions)
    return ToxicityModel(weights, transitions, _logistic(document_features(marginals, sizes), np.array(toxic, float)))


def document_features(marginals: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Constant, log(1 + expected toxic words), largest marginal; by document."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # Marginals of a few thousandths are what any word has; they must not add up in long texts.
    counted = np.bincount(owner, np.where(marginals > 0.05, marginals, 0.0), len(sizes))
    largest = np.zeros(len(sizes))
    np.maximum.at(largest, owner, marginals)
    return np.stack([np.ones(len(sizes)), np.log1p(counted), largest], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, decay: float = 1.0) -> tuple[float, float, float]:
    """Newton's method with a small penalty; without documents of both kinds the share of toxic ones decides."""
    if len(y) == 0 or y.min() == y.max():
        return (4.0 if len(y) and y.max() else -4.0, 0.0, 0.0)
    beta = np.zeros(3)
    penalty = decay * np.diag([1e-3, 1.0, 1.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - penalty @ beta
        beta += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, slope)
    return tuple(float(b) for b in beta)


def held_out(doc_id: Column) -> Column:
    """Documents that no label may be learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Train on a sample of the labelled rows that are not held out, the first by a hash of the identifier.

    `labels` is (id, toxic 0/1); null labels do not count, and a document labelled both ways is toxic.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col(id_col)))
    by_id = usable.groupBy(F.col(id_col).alias("labelled")).agg((F.max("toxic") > 0).alias("is_toxic"))

    def first(of: Column, most: int) -> DataFrame:
        return by_id.where(of).orderBy(F.xxhash64("labelled"), "labelled").limit(most)

    # At most SAMPLE_TOXIC + SAMPLE_CLEAN identifiers.
    chosen = first(F.col("is_toxic"), SAMPLE_TOXIC).unionAll(first(~F.col("is_toxic"), SAMPLE_CLEAN))
    rows = (
        docs.select(F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"))
        .join(F.broadcast(chosen), F.col("id") == F.col("labelled"))
        .where(F.char_length("text") <= SAMPLE_CHARS)
        .select("text", "is_toxic")
        .dropDuplicates(["text"])
        .orderBy("text")
        .limit(SAMPLE_TOXIC + SAMPLE_CLEAN)
        .collect()
    )
    return train([r["text"] for r in rows], [r["is_toxic"] for r in rows])


class Tagger:
    """Scores texts in one task; the emission of a word is worked out once."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.known: dict[str, float] = {}

    def _emissions(self, words: list[str]) -> np.ndarray:
        wanted = set(words)
        new = wanted.difference(self.known)
        full = len(self.known) + len(new) > REMEMBERED
        weights = self.model.weights
        for word in new:
            self.known[word] = float(sum(weights[_bucket(f)] for f in forms(word)))
        out = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        if full:
            for word in new:
                del self.known[word]
        return out

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The score of each text, and the marginals of its words."""
        documents = [t.split() for t in texts]
        sizes = [len(d) for d in documents]
        marginals, _ = word_marginals(self._emissions([w for d in documents for w in d]), sizes, self.model.transitions)
        z = document_features(marginals, sizes) @ np.array(self.model.logistic)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), np.split(marginals, np.cumsum(sizes)[:-1]) if sizes else []


def toxic_spans(text: str, marginals: np.ndarray, least: float = 0.5) -> list[tuple[int, int]]:
    """(start, end) in code points of each run of words whose marginal is at least `least`."""
    spans: list[tuple[int, int]] = []
    last = -2
    if len(marginals) and marginals.max() >= least:
        for k, m in enumerate(re.finditer(r"\S+", text)):
            if marginals[k] >= least:
                spans[-1:] = [(spans[-1][0], m.end())] if last == k - 1 else [*spans[-1:], m.span()]
                last = k
    return spans


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, held_out, score, predicted (1 if score >= threshold), spans of toxic words.

    The score is a function of the text alone. Null and empty texts have no words and get the lowest
    score. Other columns are not looked at; an empty table stays empty. The model is sent to the tasks;
    its size is fixed by BUCKETS.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        tagger = kept(("toxicity", zlib.crc32(model.weights.tobytes()), model.logistic), lambda: Tagger(model))
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                scores, marginals = tagger.tag(texts)
                spans = [[{"start": a, "end": b} for a, b in toxic_spans(t, m)] for t, m in zip(texts, marginals)]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(spans, kind)], ["id", "score", "spans"])

    kind = rows.schema["id"].dataType.simpleString()
    tagged = rows.mapInArrow(scored, f"id {kind}, score double, spans array<struct<start:bigint,end:bigint>>")
    return tagged.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "spans",
    )

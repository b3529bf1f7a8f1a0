"""Hard negatives by a secondary-sort shuffle.

Anchors meet all rows in cells: a block of anchors and a share of the rows. Rows stream through a cell, which keeps
of each anchor only what can still matter, so what is shuffled by anchor is small, however many rows there are.
That happens twice: first for the positives, then, with their scores known, for the rows inside their windows.

The scored pairs get the key (anchor, descending score, id), are dealt by anchor and sorted within the partitions
(the DataFrame form of repartitionAndSortWithinPartitions). A streaming iterator reads them in that order: a positive
opens a window, each negative is emitted for the windows that are open and not yet full, and a window closes
when the scores fall below it. It holds the open windows of one anchor, never an anchor's rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import cut, partitions
from perennia.session import work_folder

#: Anchors of one cell.
BLOCK = 1024
#: Rows a cell reads, about.
SHARE = 1_000_000
#: Below this all sums of products are exact in double precision.
EXACT = 2.0**53
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Window(NamedTuple):
    """A negative may score from `low` to `high` percent of the positive."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def quantised(vector: Column, scale: int = 256) -> Column:
    """Each component as floor(scale * component), the component in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def takes_part(vector: Column, label: Column, vec_id: Column) -> Column:
    """Whether a row has an id, a label and a vector of finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec_id.isNotNull() & label.isNotNull() & vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def inner_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products, one line per anchor; sums beyond 64 bits end at the limits of 64 bits."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    bound = float(np.abs(anchors.astype(float)).max()) * float(np.abs(rows.astype(float)).max()) * anchors.shape[1]
    if bound < EXACT:
        return (anchors.astype(float) @ rows.astype(float).T).astype(np.int64)
    exact = anchors.astype(object) @ rows.astype(object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def first_by_score(scores: np.ndarray, ids: np.ndarray, among: np.ndarray, most: int) -> np.ndarray:
    """Those of the indices `among` with the `most` highest scores; ties by smaller id."""
    if len(among) > most:
        found = scores[among]
        least = np.partition(found, len(found) - most)[len(found) - most]
        among = among[found >= least]
    # Complements descend without the overflow that a minus has at the least number.
    return among[np.lexsort((ids[among], ~scores[among]))][:most]


class _Best:
    """(score, id) of the best rows of one anchor so far."""

    def __init__(self, most: int):
        self.most, self.scores, self.ids = most, np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray, among: np.ndarray) -> None:
        if len(self.scores) == self.most:
            among = among[scores[among] >= self.scores[-1]]
        if not len(among):
            return
        among = first_by_score(scores, ids, among, self.most)
        self.scores, self.ids = np.concatenate([self.scores, scores[among]]), np.concatenate([self.ids, ids[among]])
        order = first_by_score(self.scores, self.ids, np.arange(len(self.ids)), self.most)
        self.scores, self.ids = self.scores[order], self.ids[order]


def in_window(scores: np.ndarray, positive: int, window: Window) -> np.ndarray:
    """Whether low * positive <= 100 * score <= high * positive, without overflow."""
    low, high = -(-window.low * positive // 100), window.high * positive // 100
    return (scores >= max(low, LEAST)) & (scores <= min(high, MOST))


def _cells(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Rows (cell, kind, id, label, vector, scores) sorted by cell: first its anchors (kind 0), then its share of the rows.

    A block of anchors goes to every share and every row to every block: the shuffle is rows times blocks of anchors
    plus anchors times shares, and no cell gets more than its block and its share, whatever labels there are.
    """
    spark = rows.sparkSession
    blocks = math.ceil(anchors.count() / BLOCK) or 1
    shares = max(math.ceil(rows.count() / SHARE), math.ceil(partitions(spark) / blocks))
    numbered = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    left = numbered.select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), "block", F.lit(0).alias("kind"), "id", "label", "vector", "scores"
    )
    right = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int").alias("share"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.lit(1).alias("kind"),
        "id",
        "label",
        "vector",
        F.array().cast("array<bigint>").alias("scores"),
    )
    cell = (F.col("block") * shares + F.col("share")).alias("cell")
    dealt = left.unionByName(right).select(cell, "kind", "id", "label", "vector", "scores")
    return dealt.repartition(min(blocks * shares, 10_000), "cell").sortWithinPartitions("cell", "kind")


def _scored(cells: DataFrame, window: Window) -> DataFrame:
    """Rows (anchor, score, id, positive) of each cell that can still matter to an anchor.

    Without scores of positives those are the best rows of the anchor's label; with them, the best rows of other
    labels inside the window of each.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, best = None, [], []

        def passed_on() -> Iterator[pa.RecordBatch]:
            found = {}
            for (anchor, _, _, _), kept in zip(anchors, best):
                for one in kept:
                    found.update(((anchor, int(s), int(i), one is kept[0] and not has_scores), None) for s, i in zip(one.scores, one.ids))
            columns = list(zip(*found)) or [()] * 4
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "score", "id", "positive"])

        has_scores = False
        matrices: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            of_cell = batch.column(0).to_numpy()
            for at in np.flatnonzero(np.r_[True, of_cell[1:] != of_cell[:-1]]).tolist() if len(of_cell) else ():
                part = batch.slice(at, int(np.searchsorted(of_cell[at:], of_cell[at], "right")))
                if of_cell[at] != cell:
                    yield from passed_on()
                    cell, anchors, best, matrices = of_cell[at], [], [], {}
                kinds = part.column(1).to_numpy()
                n = int((kinds == 0).sum())
                for row in part.slice(0, n).to_pylist():
                    anchors.append((row["id"], row["label"], row["vector"], row["scores"]))
                    has_scores = row["scores"] is not None
                    best.append([_Best(window.negatives if has_scores else window.positives) for _ in row["scores"] or [0]])
                    matrices = {}
                if n < len(part) and anchors:
                    if not matrices:
                        by_size: dict[int, list[int]] = {}
                        for i, anchor in enumerate(anchors):
                            by_size.setdefault(len(anchor[2]), []).append(i)
                        matrices = {
                            size: (np.array(of), np.array([anchors[i][2] for i in of], np.int64).reshape(len(of), size))
                            for size, of in by_size.items()
                        }
                    _meet(part.slice(n), anchors, best, matrices, window, has_scores)
        yield from passed_on()

    return cells.mapInArrow(stream, "anchor long, score long, id long, positive boolean")


def _meet(part, anchors, best, matrices, window, has_scores) -> None:
    """All rows of a part against all anchors of its cell."""
    vectors = part.column(4)
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, start = vectors.flatten().to_numpy(), np.cumsum(sizes) - sizes
    ids, labels = part.column(2).to_numpy(), part.column(3).to_numpy()
    for size, (of, matrix) in matrices.items():
        # Vectors of another length are not compared.
        these = np.flatnonzero(sizes == size)
        if not len(these):
            continue
        rows = flat[start[these][:, None] + np.arange(size)].reshape(len(these), size)
        own_ids, own_labels = ids[these], labels[these]
        for i, scores in zip(of.tolist(), inner_products(matrix, rows)):
            anchor, label, _, positives = anchors[i]
            if not has_scores:
                best[i][0].offer(scores, own_ids, np.flatnonzero((own_labels == label) & (own_ids != anchor)))
            else:
                other = own_labels != label
                for one, positive in zip(best[i], positives):
                    one.offer(scores, own_ids, np.flatnonzero(other & in_window(scores, positive, window)))


def _keyed(pairs: DataFrame) -> DataFrame:
    """Dealt by anchor and sorted by (anchor, descending score, id) within the partitions.

    At equal scores positives come first: they open the windows that the negatives of that score are in.
    """
    parts = partitions(pairs.sparkSession)
    order = ["anchor", F.desc("score"), F.desc("positive"), "id"]
    return pairs.repartition(parts, "anchor").sortWithinPartitions(*order)


def _first_positives(pairs: DataFrame, most: int) -> DataFrame:
    """(anchor, score, id, positive) of the first `most` rows of each anchor in that order."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen = None, 0
        for batch in batches:
            keep = []
            for row, of in enumerate(batch.column(0).to_pylist()):
                anchor, seen = (anchor, seen + 1) if of == anchor else (of, 1)
                if seen <= most:
                    keep.append(row)
            yield batch.take(pa.array(keep, pa.int64()))

    return _keyed(pairs).mapInArrow(stream, pairs.schema)


def _mined(pairs: DataFrame, window: Window) -> DataFrame:
    """The negatives of every open window, by one pass over the sorted pairs."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = None
        open_: list[list[int]] = []  # [id, score, negatives so far]
        for batch in batches:
            out: list[tuple] = []
            for of, score, row, positive in zip(*(c.to_pylist() for c in batch.columns)):
                if of != anchor:
                    anchor, open_ = of, []
                if positive:
                    open_.append([row, score, 0])
                    continue
                # Below its lower end, or full, a window is closed.
                open_ = [w for w in open_ if w[2] < window.negatives and 100 * score >= window.low * w[1]]
                for w in open_:
                    if 100 * score <= window.high * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], row, w[1], score))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return _keyed(pairs).mapInArrow(stream, schema)


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    window: Window = Window(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all anchors of all rows.

    The positives of an anchor are the first `window.positives` other rows of its label, the negatives of a positive the
    first `window.negatives` rows of other labels whose score lies in its window; by descending score of the quantised
    vectors, ties by smaller id. An anchor without positives, or a positive without negatives, has no rows. A window
    may not reach above 100 percent, so a positive below zero has none (its window would end below its beginning).

    Rows whose id, label or vector is null, or whose vector holds a null or a number that is not finite, take no part.
    Vectors of other lengths are not compared with each other; empty ones score 0. An id names one vector: of
    rows that share it the one with the smallest label, then the smallest vector, counts. Ids and labels are
    whole numbers; other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    if not 0 <= window.low <= window.high <= 100:
        raise ValueError("0 <= low <= high <= 100 must hold")
    spark = rows.sparkSession
    wanted = takes_part(F.col(vector_col), F.col(label_col), F.col(id_col))
    plain = rows.where(wanted).select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(label_col) if label is None else label).cast("long").alias("label"),
        quantised(F.col(vector_col), scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    folder = work_folder(spark, "hard-negatives")
    plain.write.parquet(folder)
    plain = spark.read.parquet(folder)
    if not plain.groupBy("id").count().where("count > 1").isEmpty():
        first = plain.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("first"))
        plain = cut(first.select("id", "first.*"))
    anchors = plain.where("anchor").select("id", "label", "vector")
    none = F.lit(None).cast("array<bigint>").alias("scores")
    near = _scored(_cells(plain, anchors.select("*", none)), window)
    positives = cut(_first_positives(near, window.positives))
    # Below zero a window is empty.
    scores = positives.where("score >= 0").groupBy("anchor").agg(F.collect_list("score").alias("scores"))
    known = cut(anchors.join(scores.withColumnRenamed("anchor", "id"), "id"))
    negatives = _scored(_cells(plain, known), window).distinct()
    return _mined(positives.where("score >= 0").unionByName(negatives), window)

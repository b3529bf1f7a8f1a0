"""Near-duplicate vectors: every pair compared, by tiles in the order of principal components.

Equal vectors are one class. A rotation, fitted on a bounded sample, puts the directions of most
variance first; any rotation keeps cosines, so the sample only decides how soon a comparison stops.

* Unit vectors with cosine >= t are at most sqrt(2 - 2t) apart, in each coordinate too. Classes fall
  into cells of that width by their first `CELL_DIMS` coordinates, and only the same and adjacent cells
  can hold a link. Cells are cut by hash into tiles of about `TILE` vectors, however full they are.
* A pair of tiles is one task's group. Its products are accumulated over the leading dimensions
  first; a pair goes on only while product plus the product of the suffix norms can reach t.

Only counts and links that join something leave a task, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import cut
from perennia.llm.graph import components

CELL_DIMS = 2
TILE = 4096
#: Rows of a tile that are compared at once.
STRIP = 1024
#: Vectors that the rotation is fitted on: so many at most, and so many numbers at most.
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000
#: More than what float32 products of unit vectors may be off.
SLACK = 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; scaled by their largest component first."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotation(sample: np.ndarray) -> np.ndarray:
    """Columns are the principal directions, most variance first."""
    centred = sample - sample.mean(axis=0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    return np.ascontiguousarray(directions[:, ::-1])


def linked_pairs(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (rows of a, rows of b) of cosine >= threshold, a strip of rows of `a` at a time."""
    dims = a.shape[1]
    steps = sorted({min(d, dims) for d in (16, 32, dims)})
    x, y = (a @ turn).astype(np.float32), (b @ turn).astype(np.float32)
    norms = [[np.sqrt((z[:, d:].astype(np.float64) ** 2).sum(axis=1)) for d in steps] for z in (x, y)]
    for top in range(0, len(a), STRIP):
        rows = slice(top, top + STRIP)
        products = x[rows, : steps[0]] @ y[:, : steps[0]].T
        bound = products + np.outer(norms[0][0][rows], norms[1][0]).astype(np.float32)
        i, j = np.nonzero(bound >= threshold - SLACK)
        partial = products[i, j]
        for k in range(1, len(steps)):
            for_step = slice(steps[k - 1], steps[k])
            kept_i, kept_j, kept = [], [], []
            for at in range(0, len(i), 1 << 18):
                p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
                so_far = partial[at : at + (1 << 18)] + np.einsum("nd,nd->n", x[p + top, for_step], y[q, for_step])
                live = so_far + norms[0][k][p + top] * norms[1][k][q] >= threshold - SLACK
                kept_i.append(p[live])
                kept_j.append(q[live])
                kept.append(so_far[live])
            i, j, partial = (np.concatenate(z) if z else np.empty(0, t) for z, t in ((kept_i, int), (kept_j, int), (kept, np.float32)))
        found_i, found_j = [], []
        for at in range(0, len(i), 1 << 18):  # what is left is decided in double precision
            p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            live = np.einsum("nd,nd->n", a[p + top], b[q]) >= threshold
            found_i.append(p[live] + top)
            found_j.append(q[live])
        if found_i:
            yield np.concatenate(found_i), np.concatenate(found_j)


def _joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`labels` with the smaller label at both ends of each pair, until nothing changes."""
    while True:
        apart = labels[i] != labels[j]
        i, j = i[apart], j[apart]
        if not len(i):
            return labels
        low = np.minimum(labels[i], labels[j])
        np.minimum.at(labels, labels[i], low)
        np.minimum.at(labels, labels[j], low)
        while (labels[labels] != labels).any():
            labels = labels[labels]


def compare_tiles(table: pa.Table, turn: np.ndarray, threshold: float) -> pa.Table:
    """For each class of the group with links: their number (copies counted), and a class it is joined to."""
    low, high, tile = (table.column(k).to_numpy() for k in ("low", "high", "tile"))
    ids, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, copies, tile = ids[order], copies[order], tile[order]
    vectors = unit(_matrix(table.column("vector"), turn.shape[0])[order])
    one = low[0] == high[0]
    left = np.flatnonzero(tile == low[0])
    right = left if one else np.flatnonzero(tile == high[0])
    links, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for i, j in linked_pairs(vectors[left], vectors[right], turn, threshold):
        i, j = left[i], right[j]
        if one:
            i, j = i[i < j], j[i < j]
        links += np.bincount(i, copies[j], len(ids)).astype(np.int64) + np.bincount(j, copies[i], len(ids)).astype(np.int64)
        labels = _joined(labels, i, j)
    found = np.flatnonzero(links)
    return pa.table({"class": ids[found], "links": links[found], "joined": ids[labels[found]]})


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    data = b"".join(memoryview(x.as_buffer()) for x in column)
    return np.frombuffer(data, np.float64).reshape(len(column), dims)


def _prepared(rows: DataFrame) -> DataFrame:
    """(id, dims, vector as bytes, digest): null vector and digest where it can link with nothing."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims, digests = [], [], []
            for v in batch.column(1):
                v = np.array([] if v.as_py() is None else v.as_py(), object)
                v = np.array([np.nan if x is None else x for x in v], np.float64) + 0.0  # no negative zeros
                good = len(v) and np.isfinite(v).all() and v.any()
                vectors.append(v.tobytes() if good else None)
                dims.append(len(v) if good else None)
                digests.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary()), pa.array(digests, pa.binary())],
                ["id", "dims", "vector", "digest"],
            )

    return rows.mapInArrow(prepare, "id long, dims int, vector binary, digest binary")


def _with_cells(classes: DataFrame, turn: np.ndarray, width: float) -> DataFrame:
    """`classes` with `cell`, the number of its cell."""
    span = int(2 / width) + 3

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = unit(_matrix(pa.chunked_array([batch.column(2)]), turn.shape[0]))
            leading = np.floor((vectors @ turn[:, :CELL_DIMS] + 1) / width).astype(np.int64) + 1
            cells = np.zeros(len(vectors), np.int64)
            for k in range(leading.shape[1]):
                cells = cells * span + leading[:, k]
            yield batch.append_column("cell", pa.array(cells))

    return classes.mapInArrow(place, "class long, copies long, vector binary, cell long")


def _dimension(classes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(class, links, joined) among the classes of one dimension."""
    rows = min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // dims))
    # The share is taken by a hash, so each task passes on its part of the sample and no more.
    share = min(1_000_000, 1 + 1_000_000 * rows // max(1, classes.count()))
    drawn = classes.where(F.pmod(F.xxhash64("class"), F.lit(1_000_000)) < share)
    sample = drawn.select("vector").limit(rows).collect()
    if not sample:
        sample = classes.select("vector").limit(1).collect()
    turn = rotation(unit(np.frombuffer(b"".join(r[0] for r in sample), np.float64).reshape(-1, dims)))
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) * (1 + 1e-6) + 1e-9
    span = int(2 / width) + 3
    placed = cut(_with_cells(classes.select("class", "copies", "vector"), turn, width))
    # There are at most span ** CELL_DIMS cells.
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    tiles = {cell: n // TILE + 1 for cell, n in sizes.items()}
    if not tiles:
        return placed.selectExpr("class", "copies AS links", "class AS joined")
    used = min(CELL_DIMS, dims)
    steps = [sum(d * span ** (used - 1 - k) for k, d in enumerate(s)) for s in itertools.product((-1, 0, 1), repeat=used)]
    known = F.create_map(*[F.lit(x) for pair in sorted(tiles.items()) for x in pair])
    at = F.col("cell")

    def code(cell, number):
        return F.shiftleft(cell, 32) + number

    mine = code(at, F.pmod(F.xxhash64("class"), F.try_element_at(known, at)))

    def tiles_at(step):
        number = F.try_element_at(known, at + step)
        numbers = F.when(number > 0, F.sequence(F.lit(0), number - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda n: code(at + step, n))

    others = [tiles_at(step) for step in steps]
    met = placed.withColumn("tile", mine).withColumn("other", F.explode(F.concat(*others)))
    grouped = met.select(
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "class", "copies", "vector"
    ).groupBy("low", "high")
    return grouped.applyInArrow(
        lambda table: compare_tiles(table, turn, threshold), "class long, links long, joined long"
    )


def near_vectors(rows: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of `rows`: id, n_links, component_id, kept.

    Vectors of cosine >= threshold are linked; n_links counts the other vectors linked directly, and
    component_id is the smallest id reachable. A vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing, and vectors of different length do not link. Equal
    vectors, repeated rows too, link with each other; a null id takes no part and is kept. Other columns
    are not looked at; an empty table stays empty. Ids are integers.
    """
    prepared = cut(_prepared(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))))
    classes = cut(
        prepared.where("digest is not null and id is not null")
        .groupBy("dims", "digest")
        .agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    )
    found = None
    for row in classes.select("dims").distinct().orderBy("dims").collect():
        own = _dimension(classes.where(F.col("dims") == row["dims"]), row["dims"], threshold)
        found = own if found is None else found.unionAll(own)
    out = (F.col("id").alias(id_col), "n_links", "component_id", "kept")
    if found is None:
        alone = prepared.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("id"), "kept": F.lit(True)})
        return alone.select(*out)
    found = cut(found)
    reached = components(found.select(F.col("class").alias("a"), F.col("joined").alias("b")))
    links = found.groupBy(F.col("class").alias("node")).agg(F.sum("links").alias("links"))
    of_class = (
        classes.select("digest", F.col("class").alias("node"), "copies")
        .join(links, "node", "left")
        .join(reached, "node", "left")
        .select(
            "digest",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    linked = F.when(F.col("id").isNotNull(), F.col("links"))
    return prepared.select("id", "digest").join(of_class, "digest", "left").withColumns(
        {
            "n_links": F.coalesce(linked, F.lit(0).cast("long")),
            "component_id": component,
            "kept": F.col("id").eqNullSafe(component),
        }
    ).select(*out)

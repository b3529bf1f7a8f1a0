"""Vector best-fit packing of tokenised documents into sequences.

Documents become ids and are cut where they are read; only the sizes of the pieces move. Pieces are
dealt by hash into groups of about `GROUP`, each small enough for one task and large enough that the
waste at its end does not count, and each group is packed by best fit, largest first: of the
sequences with room for tokens, documents and attention cost, the piece goes to the one whose
residual capacities would have the least weighted norm (or the greatest weighted dot product with
the piece).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import cut, filled, unused
from perennia.llm.tokens import TextIds, kept, slices

GROUP = 32_768


class Capacity(NamedTuple):
    """Of one sequence: tokens, documents, and attention cost, the sum of squared piece lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


def piece_lengths(total: int, most: int) -> list[int]:
    """Only what is longer than `most` is cut; all pieces but the first are then of full length."""
    first = (total - 1) % most + 1
    return [first] + [most] * ((total - first) // most)


def pack_group(
    lengths: np.ndarray,
    capacity: Capacity = Capacity(),
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    by: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; pieces must fit an empty sequence. Ties go to the oldest sequence."""
    n = len(lengths)
    limits = np.array(capacity, np.float64)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room = np.empty((3, 1024))
    names = np.empty(1024, np.int64)
    used = made = 0
    w = np.array(weights)[:, None]
    order = np.argsort(-lengths, kind="stable")
    least = float(lengths.min()) if n else 0.0
    for step, i in enumerate(order.tolist()):
        length = float(lengths[i])
        need = np.array([length, 1.0, length * length])
        if (need > limits).any():
            raise ValueError(f"a piece of {int(length)} tokens fits no sequence")
        if step % 256 == 255:  # sequences that can take nothing more are put aside
            open_ = (room[0, :used] >= least) & (room[1, :used] >= 1) & (room[2, :used] >= least * least)
            kept = int(open_.sum())
            room[:, :kept], names[:kept] = room[:, :used][:, open_], names[:used][open_]
            used = kept
        fits = np.flatnonzero(
            (room[0, :used] >= need[0]) & (room[1, :used] >= need[1]) & (room[2, :used] >= need[2])
        )
        if len(fits):
            left = room[:, fits]
            if by == "norm":
                at = fits[np.argmin((w * ((left - need[:, None]) / limits[:, None]) ** 2).sum(axis=0))]
            else:
                at = fits[np.argmax((w * left * (need / limits**2)[:, None]).sum(axis=0))]
        else:
            if used == room.shape[1]:
                room = np.concatenate([room, np.empty_like(room)], axis=1)
                names = np.concatenate([names, np.empty_like(names)])
            at, room[:, used], names[used] = used, limits, made
            used, made = used + 1, made + 1
        bins[i], offsets[i] = names[at], capacity.tokens - int(room[0, at])
        room[:, at] -= need
    return bins, offsets


def document_pieces(
    docs: DataFrame,
    vocabulary_path: str,
    most: int = 2048,
    end: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: id, piece, start, length, ids_crc32, and `ids` if asked for.

    A document is the ids of its text, special tokens in it included, then the id `end`; a null text
    is an empty one.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"))
    columns = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = vocabulary.value
        encode = kept(("packing", zlib.crc32(text.encode())), lambda: TextIds(text))
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                out = [[] for _ in columns]
                for row, words in enumerate(part.column(1).to_pylist()):
                    data = memoryview(encode(words).tobytes() + last)
                    start = 0
                    for piece, length in enumerate(piece_lengths(len(data) // 4, most)):
                        ids = data[4 * start : 4 * (start + length)]
                        for values_of, x in zip(out, (row, piece, start, length, zlib.crc32(ids))):
                            values_of.append(x)
                        if with_ids:
                            out[5].append(np.frombuffer(ids, "<u4").astype(np.int32))
                        start += length
                arrays = [part.column(0).take(pa.array(out[0], pa.int32())), pa.array(out[1], pa.int32())]
                arrays += [pa.array(x, pa.int64()) for x in out[2:5]]
                arrays += [pa.array(x, pa.list_(pa.int32())) for x in out[5:]]
                yield pa.RecordBatch.from_arrays(arrays, columns)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(cut_up, schema).withColumnRenamed("id", id_col)


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), id_col: str = "doc_id", by: str = "norm") -> DataFrame:
    """`pieces` (id, piece, length and whatever else is small) with sequence_id and offset.

    Rows repeated are packed as often as they occur. Every row is placed once; an empty table stays
    empty. Columns of these two names are replaced, all others stay, whatever their names. The pieces
    are stored below the shared checkpoint folder first: their number is needed.
    """
    pieces = cut(pieces.drop("sequence_id", "offset"))
    dealt_to = unused("group", pieces)
    groups = pieces.count() // GROUP + 1
    # By the place in the stored pieces, which is fixed: rows that share an id are spread as well.
    dealt = pieces.withColumn(dealt_to, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def placed(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets = pack_group(lengths, capacity, by=by)
        group = table.column(dealt_to).to_numpy()
        table = table.append_column("sequence_id", pa.array((group << 32) + bins, pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64())).drop_columns([dealt_to])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy(dealt_to).applyInArrow(placed, f"{fields}, sequence_id long, offset long")

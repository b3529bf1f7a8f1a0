"""Vector bin packing of training examples by the dot-product heuristic, under three limits at once.

A sequence may hold so many tokens, so many segments (pieces of examples) and so many tokens that bear
loss. Into the open sequence goes, again and again, the piece that fits and whose needs, weighted, have
the greatest dot product with the room that is left. Examples may be cut: when nothing whole fits any
more, the longest piece is cut to fill the sequence, and a sequence that cannot be filled is cut back to a
power of two, so that it needs no padding.

Examples become ids where they are read and are packed there, in groups of a bounded number of
tokens. Nothing is shuffled, no key gathers anywhere, and a task that is lost is run again by itself.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import filled
from perennia.llm.tokens import TextIds, kept, slices

#: A group is packed once it holds so many tokens; its memory is a small multiple of that.
GROUP_TOKENS = 4_000_000


class Limits(NamedTuple):
    """Of one sequence: tokens, segments, and tokens that bear loss."""

    tokens: int = 4096
    segments: int = 64
    loss: int = 4096


class Placed(NamedTuple):
    """Tokens [start, start + length) of an example lie at `offset` in a sequence."""

    example: int
    start: int
    length: int
    sequence: int
    offset: int


def loss_tokens(start: int, length: int, prompt: int) -> int:
    """How many tokens of [start, start + length) lie behind the prompt."""
    return max(0, start + length - max(start, prompt))


def longest_cut(start: int, most: int, loss: int, prompt: int) -> int:
    """How many tokens from `start` on, `most` at most, bear at most `loss` tokens of loss."""
    return min(most, max(0, prompt - start) + loss)


class _Pool:
    """The pieces still to place, by need (tokens, loss); the needs are arrays, for the dot products."""

    def __init__(self, limits: Limits, weights: tuple[float, float, float]):
        scale = np.array([weights[0] / limits.tokens**2, weights[1] / limits.segments**2, weights[2] / max(limits.loss, 1) ** 2])
        self.scale, self.pieces = scale, defaultdict(list)
        self.needs, self.of, self.count = np.zeros((3, 0)), {}, np.zeros(0, np.int64)

    def add(self, pieces: list[tuple[int, int, int, int]]) -> None:
        """Pieces (example, start, length, loss)."""
        fresh = []
        for piece in pieces:
            need = piece[2:]
            if need not in self.of:
                self.of[need] = self.needs.shape[1] + len(fresh)
                fresh.append((need[0], 1, need[1]))
        if fresh:
            self.needs = np.concatenate([self.needs, np.array(fresh, float).T], axis=1)
            self.count = np.concatenate([self.count, np.zeros(len(fresh), np.int64)])
        for piece in pieces:
            at = self.of[piece[2:]]
            self.pieces[at].append(piece)
            self.count[at] += 1

    def compact(self) -> None:
        """Forget the needs of which no piece is left."""
        live = np.flatnonzero(self.count)
        if len(live) * 2 < len(self.count):
            self.pieces = defaultdict(list, {i: self.pieces[j] for i, j in enumerate(live.tolist())})
            self.needs, self.count = self.needs[:, live], self.count[live]
            self.of = {(int(t), int(w)): i for i, (t, w) in enumerate(zip(self.needs[0], self.needs[2]))}

    def best(self, room: np.ndarray) -> int | None:
        """The need that fits and has the greatest dot product with the room; the first of equal ones."""
        if not len(self.count):
            return None
        fits = (self.count > 0) & (self.needs <= room[:, None]).all(axis=0)
        if not fits.any():
            return None
        return int(np.argmax(np.where(fits, (self.scale * room) @ self.needs, -1.0)))

    def longest(self) -> int | None:
        if not self.count.any():
            return None
        return int(np.argmax(np.where(self.count > 0, self.needs[0], -1.0)))

    def take(self, at: int) -> tuple[int, int, int, int]:
        self.count[at] -= 1
        return self.pieces[at].pop()


def pack_examples(
    lengths: list[int],
    prompts: list[int],
    limits: Limits = Limits(),
    weights: tuple[float, float, float] = (1.0, 0.1, 1.0),
) -> list[Placed]:
    """Place every token of every example once.

    `prompts` has the number of tokens at the beginning of each example that bear no loss. Each sequence is
    exactly `limits.tokens` long or a power of two; every limit holds for every sequence. No length is
    lost: what is longer than a sequence is cut, examples of no tokens have no pieces.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("every limit must be at least one")
    pool = _Pool(limits, weights)

    def piece(example: int, start: int, length: int) -> tuple[int, int, int, int]:
        return example, start, length, loss_tokens(start, length, prompts[example])

    def cut_up(example: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Pieces that fit an empty sequence; the last one is what is left over."""
        while length:
            fit = longest_cut(start, min(length, limits.tokens), limits.loss, prompts[example])
            yield piece(example, start, fit)
            start, length = start + fit, length - fit

    pool.add([p for example, length in enumerate(lengths) for p in cut_up(example, 0, length)])
    out: list[Placed] = []
    made = 0
    while pool.count.any():
        room = np.array(limits, float)
        inside: list[tuple[int, int, int, int]] = []
        while room[0] and room[1]:
            at = pool.best(room)
            if at is not None:
                taken = pool.take(at)
            else:
                # Nothing whole fits: the head of the longest piece fills what is left, the rest goes back.
                at = pool.longest()
                if at is None:
                    break
                example, start, length, _ = pool.pieces[at][-1]
                head = longest_cut(start, min(length, int(room[0])), int(room[2]), prompts[example])
                if not head:
                    break
                pool.take(at)
                taken = piece(example, start, head)
                pool.add([piece(example, start + head, length - head)])
            inside.append(taken)
            room -= (taken[2], 1, taken[3])
        used = sum(p[2] for p in inside)
        if used != limits.tokens:
            # Cut back to a power of two; what is behind it goes back.
            end = 1 << (used.bit_length() - 1)
            while used > end:
                example, start, length, _ = inside.pop()
                stays = max(0, length - (used - end))
                used -= length - stays
                if stays:
                    inside.append(piece(example, start, stays))
                pool.add([piece(example, start + stays, length - stays)])
        offset = 0
        for example, start, length, _ in inside:
            out.append(Placed(example, start, length, made, offset))
            offset += length
        made += 1
        if made % 64 == 0:
            pool.compact()
    return out


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    limits: Limits = Limits(),
    end: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt: Column | None = None,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every example: id, start, length, ids_crc32, loss, doc_tokens, sequence_id, offset, and `ids` if asked for.

    An example is the ids of its text, special tokens in it included, then the id `end`. `prompt` is the
    number of characters at its beginning that bear no loss, such as the instruction of an instruction
    and its answer; they are tokenised by themselves, so that no token is half prompt. Without it only the first
    token, which nothing predicts, bears none.

    A null text is an empty one, with the one token `end`; a null, negative or too great `prompt` is cut to
    the text. Null and repeated ids are rows like any other: each row has its own pieces. Other columns are
    ignored, whatever their names; an empty table gives an empty result. Of a row, tokens and pieces are
    held by one task, however long the text is. Sequences of a task begin with its partition's number.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col(id_col).alias("id"),
        filled(F.col(text_col)).alias("text"),
        (F.lit(-1) if prompt is None else F.greatest(F.coalesce(prompt, F.lit(0)), F.lit(0))).cast("int").alias("prompt"),
    )
    columns = ["id", "start", "length", "ids_crc32", "loss", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = vocabulary.value
        encode = kept(("vector packing", zlib.crc32(text.encode())), lambda: TextIds(text))
        last = np.array([end], np.uint32)
        first_sequence = TaskContext.get().partitionId() << 40
        names: list[pa.Array] = []
        ids: list[np.ndarray] = []
        prompts: list[int] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first_sequence, held
            found = pack_examples([len(x) for x in ids], prompts, limits)
            known = pa.chunked_array(names) if len(names) > 1 else names[0]
            known = known.combine_chunks() if isinstance(known, pa.ChunkedArray) else known
            for at in range(0, len(found), 20_000):
                part = found[at : at + 20_000]
                tokens = [np.ascontiguousarray(ids[p.example][p.start : p.start + p.length], "<u4") for p in part]
                arrays = [known.take(pa.array([p.example for p in part], pa.int64()))]
                numbers = (
                    [p.start for p in part],
                    [p.length for p in part],
                    [zlib.crc32(x) for x in tokens],
                    [loss_tokens(p.start, p.length, prompts[p.example]) for p in part],
                    [len(ids[p.example]) for p in part],
                    [first_sequence + p.sequence for p in part],
                    [p.offset for p in part],
                )
                arrays += [pa.array(x, pa.int64()) for x in numbers]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in tokens], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, columns)
            first_sequence += 1 + max((p.sequence for p in found), default=-1)
            names.clear(), ids.clear(), prompts.clear()
            held = 0

        for batch in batches:
            for part in slices(batch):
                names.append(part.column(0))
                for words, split in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    if split < 0:
                        tokens, free = encode(words), 1
                    else:
                        head = encode(words[:split])
                        tokens, free = np.concatenate([head, encode(words[split:])]), len(head)
                    ids.append(np.concatenate([tokens, last]).astype(np.uint32, copy=False))
                    prompts.append(free)
                    held += len(ids[-1])
                if held >= group_tokens:
                    yield from flush()
        if names:
            yield from flush()

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in columns[1:8]) + ", ids array<int>" * with_ids
    return rows.mapInArrow(packed, schema).withColumnRenamed("id", id_col)

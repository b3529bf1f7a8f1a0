"""Prefix trie of conversations by range minima over sorted common prefixes.

Conversations become keys, one digest per turn, and are sorted by key. The lengths of the prefixes that neighbours
share (LCPs, in turns) then hold the whole trie: the members of a prefix of d turns are the stretch around any of
them in which no LCP falls below d. A sparse table gives the least LCP of any stretch at once, so each candidate
prefix finds its left and its right end by binary search, independently of all others, without a stack.

The sorted rows lie in blocks. A block has the table of its own LCPs, and all blocks share one table of block
minima, a few numbers per block, in which a prefix that leaves its block finds the block where it ends. What it
has in common with that block, its step, is joined to it by (block, depth). Everything a node reports follows
from sums and minima over its stretch, so no node is ever collected: copies of one conversation, or a first turn that
a third of all share, are just long stretches.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import cut, filled, partitions

#: Bytes of a turn's digest; 15 bytes are 20 letters in base 64, without a remainder.
DIGEST = 15
#: What a block holds at most, about.
BLOCK_ROWS, BLOCK_TURNS = 200_000, 500_000
#: Nodes that reach over the end of a block are broadcast up to so many, else joined by shuffle.
BROADCAST_NODES = 200_000
SALTS = 16
NOTHING = hashlib.sha256(b"").hexdigest()


class RangeMinimum:
    """Least value of any stretch of an array, by the least values of stretches whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))
            step *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of values[first..last], both included."""
        out = np.empty(len(first), self.levels[0].dtype)
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << k) + 1])
        return out

    def left_end(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The smallest l with values[l + 1..at] all at least `depth`."""
        end = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            first = end - (1 << k) + 1
            may = np.flatnonzero(first >= 1)
            end[may] -= (self.levels[k][first[may]] >= depth[may]) << k
        return end

    def right_end(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The largest r with values[at + 1..r] all at least `depth`."""
        end, size = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            may = np.flatnonzero(end + (1 << k) < size)
            end[may] += (self.levels[k][end[may] + 1] >= depth[may]) << k
        return end


def common_turns(one: np.ndarray, other: np.ndarray) -> int:
    """How many turns two keys share at their beginnings."""
    n = min(len(one), len(other))
    differ = np.flatnonzero((one[:n] != other[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


class Block:
    """The rows of one partition: ids, numbers of turns, digests and words of all turns, LCPs with the row before."""

    def __init__(self, batches: list[pa.RecordBatch], before: int = -1):
        table = pa.Table.from_batches(batches).combine_chunks()
        keys, words = table.column("key").combine_chunks(), table.column("words").combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
        self.ids = table.column("conv_id").to_numpy()
        offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.digests = data.reshape(-1, DIGEST)
        self.start = (offsets - offsets[0]) // DIGEST
        self.turns = np.diff(self.start)
        #: Words of the turns before each, so that a stretch of turns is a difference.
        self.words = np.concatenate([[0], np.cumsum(words.flatten().to_numpy())]).astype(np.int64)
        self.lcp = np.concatenate([[before], self._lcps()]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.ids)

    def _lcps(self) -> np.ndarray:
        shorter = np.minimum(self.turns[1:], self.turns[:-1])
        out = shorter.copy()
        some = np.flatnonzero(shorter)
        if len(some):
            sizes = shorter[some]
            first = np.cumsum(sizes) - sizes
            turn = np.arange(sizes.sum()) - np.repeat(first, sizes)
            here = np.repeat(self.start[some + 1], sizes) + turn
            there = np.repeat(self.start[some], sizes) + turn
            differ = (self.digests[here] != self.digests[there]).any(axis=1)
            out[some] = np.minimum.reduceat(np.where(differ, turn, np.repeat(sizes, sizes)), first)
        return out

    def key(self, row: int) -> np.ndarray:
        return self.digests[self.start[row] : self.start[row + 1]]

    def words_before(self, row: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Words of the first `turns` turns of rows; a negative number of turns has none."""
        return self.words[self.start[row] + np.maximum(turns, 0)] - self.words[self.start[row]]

    def sums(self, after: int) -> np.ndarray:
        """For each row its words, those behind its LCP, and whether it is a leaf: no longer row follows that begins with it."""
        rows = np.arange(len(self))
        total = self.words_before(rows, self.turns)
        leaf = np.append(self.lcp[1:], after) < self.turns
        return np.stack([total, total - self.words_before(rows, self.lcp), leaf.astype(np.int64)])


class Blocks(NamedTuple):
    """The blocks that have rows, in order: partition, LCP with the block before, rows, least LCP, how many rows with that
    LCP begin a node, least id, sums of `Block.sums`."""

    partition: np.ndarray
    before: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    begin: np.ndarray
    conv: np.ndarray
    sums: np.ndarray

    def after(self, at: int) -> int:
        return int(self.before[at + 1]) if at + 1 < len(self.before) else -1


def keyed_conversations(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, key, words) of every rebuilt conversation.

    A rebuilt conversation c is the first h turns of conversation c - c % family, then its own turns after its
    first h, h being the unsigned crc32 of its decimal id modulo `heads`. Turns are ordered by number, null first,
    those of one number by their digest; null roles and texts are empty; rows without a conv_id belong to none.
    """
    role, text = filled(F.col("role").cast("string")), filled(F.col("text"))
    # The length keeps role and text apart.
    said = F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "UTF-8")
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.col("turn").alias("turn"),
            F.base64(F.substring(F.unhex(F.sha2(said, 256)), 1, DIGEST)).alias("digest"),
            words.alias("words"),
        ).alias("said"),
    )
    own = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    base = F.col("conv_id") - F.col("conv_id") % family
    heads_of = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.withColumns({"base": base, "h": h}).join(heads_of, "base", "left")
    empty = F.slice("turns", 1, 0)
    rebuilt = F.concat(
        F.coalesce(F.slice("head", F.lit(1), F.col("h")), empty),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))),
    )
    return both.select("conv_id", rebuilt.alias("turns")).select(
        "conv_id",
        F.unbase64(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def _whole(batches: Iterator[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return [b for b in batches if len(b)]


def _block_ends(ordered: DataFrame) -> dict[int, int]:
    """For each partition that has rows, in order, the LCP of its first row with the last row before it."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _whole(batches)
        if rows:
            at = pa.array([TaskContext.get().partitionId()], pa.int32())
            first, last = (b.column("key")[i].as_py() for b, i in ((rows[0], 0), (rows[-1], -1)))
            yield pa.RecordBatch.from_arrays([at, pa.array([first]), pa.array([last])], ["block", "first", "last"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                first = np.frombuffer(row["first"], np.uint8).reshape(-1, DIGEST)
                found.append(-1 if last is None else common_turns(last, first))
                last = np.frombuffer(row["last"], np.uint8).reshape(-1, DIGEST)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], ["block", "before"])

    keys = ordered.mapInArrow(ends, "block int, first binary, last binary")
    # One row per block.
    compared = keys.repartition(1).sortWithinPartitions("block").mapInArrow(compare, "block int, before int")
    return {r["block"]: r["before"] for r in compared.orderBy("block").collect()}


def _summaries(ordered: DataFrame, before: dict[int, int]) -> Blocks:
    """The table of blocks: nine numbers of each."""
    at = list(before)
    after = dict(zip(at, [*list(before.values())[1:], -1]))
    names = ["block", "rows", "least", "begin", "conv", "words", "fresh", "leaves"]

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _whole(batches)
        if rows:
            part = TaskContext.get().partitionId()
            block = Block(rows, before[part])
            least = int(block.lcp.min())
            begin = int(((block.lcp == least) & (block.turns > least)).sum())
            numbers = [part, len(block), least, begin, int(block.ids.min()), *block.sums(after[part]).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in numbers], names)

    rows = ordered.mapInArrow(summary, ", ".join(f"{n} long" for n in names)).orderBy("block").collect()
    columns = np.array([list(r) for r in rows], np.int64).reshape(len(rows), len(names)).T
    return Blocks(columns[0], np.array(list(before.values()), np.int64), *columns[1:5], columns[5:])


_NUMBERS = (
    "block", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "words", "fresh", "base", "step", "part", "parent_conv_id", "parent_block",
)
_ROW = ", ".join(["kind string", *[f"{n} long" for n in _NUMBERS], "ends_sha256 string", "ids string"])


def _rows(kind: str, n: int, sha: list | None = None, ids: list | None = None, **columns) -> pa.RecordBatch:
    arrays = [pa.array([kind] * n, pa.string())]
    for name in _NUMBERS:
        values = columns.get(name)
        arrays.append(pa.nulls(n, pa.int64()) if values is None else pa.array(values, pa.int64()))
    arrays += [pa.array(sha or [None] * n, pa.string()), pa.array(ids or [None] * n, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["kind", *_NUMBERS, "ends_sha256", "ids"])


def _none_where(values: np.ndarray, without: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=without)


def block_rows(block: Block, at: int, blocks: Blocks) -> Iterator[pa.RecordBatch]:
    """What one block knows: its nodes ("node"), those that reach over its end ("open", with all blocks in between added),
    what it has of prefixes that end in it ("step"), and ids of conversations whose copies reach over an end ("ids")."""
    n, lcp, turns = len(block), block.lcp, block.turns
    after = blocks.after(at)
    table, ids = RangeMinimum(lcp), RangeMinimum(block.ids)
    between, minima = RangeMinimum(blocks.least), RangeMinimum(blocks.conv)
    sums = block.sums(after)
    upto = np.concatenate([np.zeros((3, 1), np.int64), sums.cumsum(axis=1)], axis=1)
    upto_blocks = np.concatenate([np.zeros((4, 1), np.int64), np.vstack([blocks.rows, blocks.sums]).cumsum(axis=1)], axis=1)

    # A candidate is a prefix that its row is the first to have: deeper than the row's LCP.
    many = turns - lcp
    first = np.cumsum(many) - many
    row = np.repeat(np.arange(n), many)
    depth = np.arange(len(row)) - np.repeat(first, many) + lcp[row] + 1
    left, right = table.left_end(row, depth), table.right_end(row, depth)
    open_ = (right == n - 1) & (after >= depth)

    up = depth - 1
    parent_left, parent_right = table.left_end(row, up), table.right_end(row, up)
    from_before = (parent_left == 0) & (lcp[0] >= up)
    far = from_before | ((parent_right == n - 1) & (after >= up))
    owner = np.full(len(row), at)
    earlier = np.flatnonzero(from_before & (up >= 0))
    owner[earlier] = between.left_end(np.full(len(earlier), at - 1), up[earlier])
    parent = ids.least(parent_left, parent_right)

    # A row's topmost candidate is a child of the prefix it shares with the row before; the others follow each other.
    children = (turns[row] > depth).astype(np.int64)
    new = np.flatnonzero(many)
    top = first[new]
    inside = top[~from_before[top] & (up[top] >= 0)]
    np.add.at(children, first[parent_left[inside]] + up[inside] - lcp[parent_left[inside]] - 1, 1)

    here = upto[:, right + 1] - upto[:, left]
    base = block.words_before(row, up)
    conv, count = ids.least(left, right), right - left + 1

    # Conversations that are equal stand together, in the order of their ids.
    begins = np.flatnonzero((lcp != turns) | (np.arange(n) == 0))
    stop = np.append(begins[1:], n)
    sha, texts = [NOTHING] * len(row), {}
    for b, e in zip(begins.tolist(), stop.tolist()):
        text = ",".join(map(str, block.ids[b:e].tolist()))
        last = int(first[b] + many[b] - 1)
        if e == n and after >= turns[b]:
            texts[b] = text  # copies may follow in the next block
        elif b or lcp[0] != turns[0]:
            sha[last] = hashlib.sha256(text.encode()).hexdigest()
        if b == 0 and lcp[0] == turns[0]:
            texts[b] = text  # copies of the last row before
    for b, text in texts.items():
        whose = at if lcp[b] != turns[b] else int(between.left_end(np.array([at - 1]), turns[b : b + 1])[0])
        yield _rows("ids", 1, block=[whose], depth=[int(turns[b])], part=[at], ids=[text])
        if whose == at:
            sha[int(first[b] + many[b] - 1)] = None

    saved = here[0] - count * base - (here[1] - sums[1][row]) - (sums[0][row] - base)
    parents = {"parent_conv_id": _none_where(parent, far | (up < 0)), "parent_block": _none_where(owner, ~far | (up < 0))}
    done = np.flatnonzero(~open_)
    yield _rows(
        "node", len(done), [sha[i] for i in done.tolist()], depth=depth[done], conv_id=conv[done], n_convs=count[done],
        n_children=children[done], n_leaves=here[2][done], saved_tokens=saved[done],
        **{name: values.take(pa.array(done)) for name, values in parents.items()},
    )

    over = np.flatnonzero(open_)
    if len(over):
        d = depth[over]
        end = between.right_end(np.full(len(over), at), d)
        middle = upto_blocks[:, end + 1] - upto_blocks[:, at + 1][:, None]
        some = np.flatnonzero(end > at)
        conv[over[some]] = np.minimum(conv[over[some]], minima.least(np.full(len(some), at + 1), end[some]))
        for i in some.tolist():
            stretch = slice(at + 1, end[i] + 1)
            children[over[i]] += int(blocks.begin[stretch][blocks.least[stretch] == d[i]].sum())
        step = np.minimum(end + 1, len(blocks.before) - 1)
        ends_there = (end + 1 < len(blocks.before)) & (blocks.before[step] >= d)
        yield _rows(
            "open", len(over), [sha[i] for i in over.tolist()], block=np.full(len(over), at), depth=d, conv_id=conv[over],
            n_convs=count[over] + middle[0], n_children=children[over], n_leaves=here[2][over] + middle[3],
            # What `saved` takes off: words of all members behind the parent, less those of distinct turns.
            words=here[0][over] + middle[1] - sums[0][row[over]] + base[over],
            fresh=here[1][over] + middle[2] - sums[1][row[over]], base=base[over], step=_none_where(step, ~ends_there),
            **{name: values.take(pa.array(over)) for name, values in parents.items()},
        )

    inner = int(lcp[1:].min()) if n > 1 else int(lcp[0])
    d = np.arange(max(inner + 1, 0), lcp[0] + 1)
    if len(d):
        last = table.right_end(np.zeros(len(d), np.int64), d)
        of_row = (lcp <= lcp[0]) & (turns > lcp)
        counts = [int(of_row[: e + 1][lcp[: e + 1] == x].sum()) for x, e in zip(d.tolist(), last.tolist())]
        part = upto[:, last + 1]
        yield _rows(
            "step", len(d), block=np.full(len(d), at), depth=d, conv_id=ids.least(np.zeros(len(d), np.int64), last), n_convs=last + 1,
            n_children=counts, n_leaves=part[2], words=part[0], fresh=part[1],
        )


def _digests(pieces: DataFrame) -> DataFrame:
    """(block, depth, sha) of the ids of each (block, depth), read in the order of the blocks they stand in."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, out = None, None, []

        def passed_on() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 3
            kinds = (pa.int64(), pa.int64(), pa.string())
            found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "depth", "sha"])
            out.clear()
            return found

        for batch in batches:
            for block, depth, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (block, depth) != key:
                    if key:
                        out.append((*key, running.hexdigest()))
                    key, running = (block, depth), hashlib.sha256()
                else:
                    running.update(b",")
                running.update(text.encode())
            yield passed_on()
        if key:
            out.append((*key, running.hexdigest()))
        yield passed_on()

    dealt = pieces.select("block", "depth", "part", "ids").repartition("block", "depth")
    return dealt.sortWithinPartitions("block", "depth", "part").mapInArrow(stream, "block long, depth long, sha string")


def prefix_trie(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    `turns` has conv_id, turn, role and text; other columns are ignored. Equal rows are turns of their own. A
    conversation is one value and a copy one id in the text that is hashed, in order, for its node; all else is sums.
    An empty table, or one without any conv_id, gives no rows.
    """
    spark = turns.sparkSession
    keyed = cut(keyed_conversations(turns, family, heads))
    size = keyed.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("words")).alias("turns")).first()
    count = max(partitions(spark), math.ceil(size["rows"] / BLOCK_ROWS), math.ceil((size["turns"] or 0) / BLOCK_TURNS))
    # Stored, so that blocks stay what they are.
    ordered = cut(keyed.repartitionByRange(count, "key", "conv_id").sortWithinPartitions("key", "conv_id"))
    before = _block_ends(ordered)
    blocks = _summaries(ordered, before)
    place = {int(p): i for i, p in enumerate(blocks.partition)}

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _whole(batches)
        if rows:
            at = place[TaskContext.get().partitionId()]
            yield from block_rows(Block(rows, int(blocks.before[at])), at, blocks)

    found = cut(ordered.mapInArrow(describe, _ROW))
    steps = found.where("kind = 'step'").select(
        F.col("block").alias("step"), "depth", F.struct("conv_id", "n_convs", "n_children", "n_leaves", "words", "fresh").alias("s")
    )
    shas = _digests(found.where("kind = 'ids'"))
    opened = found.where("kind = 'open'").drop("kind", "ids", "part", "saved_tokens").join(steps, ["step", "depth"], "left")
    opened = opened.join(shas, ["block", "depth"], "left")

    def plus(name: str):
        return F.col(name) + F.coalesce(F.col(f"s.{name}"), F.lit(0))

    more = F.coalesce(F.col("s.n_convs"), F.lit(0))
    far = cut(
        opened.select(
            "block",
            "depth",
            F.least("conv_id", F.col("s.conv_id")).alias("conv_id"),
            plus("n_convs").alias("n_convs"),
            plus("n_children").alias("n_children"),
            plus("n_leaves").alias("n_leaves"),
            (plus("words") - (F.col("n_convs") + more) * F.col("base") - plus("fresh")).alias("saved_tokens"),
            F.coalesce("ends_sha256", "sha").alias("ends_sha256"),
            "parent_conv_id",
            "parent_block",
        )
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = found.where("kind = 'node'").select(*columns, "parent_block").unionByName(far.select(*columns, "parent_block"))
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")
    waiting = nodes.where("parent_block is not null").drop("parent_conv_id").withColumn("salt", salt)
    parents = far.select(F.col("block").alias("parent_block"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    if far.count() <= BROADCAST_NODES:
        joined = waiting.join(F.broadcast(parents), ["parent_block", "depth"])
    else:
        salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = waiting.join(salted, ["parent_block", "depth", "salt"])
    return nodes.where("parent_block is null").select(*columns).unionByName(joined.select(*columns))

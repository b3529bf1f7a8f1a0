"""Near-duplicates by min-max hashing: each permutation gives its minimum and its maximum.

A document is the set of its five-word shingles. `PERMUTATIONS` multiplications by odd numbers give
twice as many signature values, in bands of as many rows as `percent` allows (`band_rows`): a pair of
that similarity shares no band with a probability of at most `MISSED`. At 85 these are 25 bands of
5 and 4e-7, at 80 they are 32 bands of 4 and 5e-8. What shares a band is confirmed on the full sets, as follows.

* Documents with equal sets are one class from the start, so copies cost nothing further.
* Of each bucket all members are compared with its smallest. Most groups are one component then.
* Buckets whose other members still belong to several components are compared whole, in blocks of
  at most `BLOCK` members on either side; pairs that are connected by then are skipped, and only
  links that connect something leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import cut, filled
from perennia.llm.graph import components
from perennia.llm.tokens import kept, slices

SHINGLE = 5
PERMUTATIONS = 64
MISSED = 1e-6
MOST_ROWS = 8
BLOCK = 512
#: Pairs whose signatures agree in so many standard deviations less than pairs at `percent` do are not compared.
DEVIATIONS = 7
#: Words whose hashes a task remembers, and hashes mixed at once.
REMEMBERED, AT_ONCE = 300_000, 4096

_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_MULTIPLIERS = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 2**63, (1, MOST_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SALT = _RANDOM.integers(0, 2**63, 2 * PERMUTATIONS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Texts to sorted distinct 64-bit hashes of their shingles."""

    def __init__(self):
        self.hashes: dict[bytes, int] = {}

    def words(self, text: str) -> np.ndarray:
        # Both methods of bytes know ASCII only: A-Z, and space with \x09 to \x0D.
        words = text.encode().lower().split()
        if len(self.hashes) > REMEMBERED:
            self.hashes = {}
        known = self.hashes
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str) -> np.ndarray:
        words = self.words(text)
        width = min(SHINGLE, len(words))
        if not width:
            return words
        mixed = words[: len(words) - width + 1].copy()
        for k in range(1, width):
            mixed *= _STEP
            mixed += words[k : len(words) - width + 1 + k]
        mixed += np.uint64(width)  # a short sequence is no part of a longer one
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the shingles under each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), AT_ONCE):
        values = np.multiply.outer(_MULTIPLIERS, shingles[at : at + AT_ONCE])
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_rows(percent: int) -> int:
    """The most rows of a band with which at most MISSED of the pairs at `percent` share no band; one if none do."""
    def missed(rows: int) -> float:
        return (1 - (percent / 100) ** rows) ** (2 * PERMUTATIONS // rows)

    return max([rows for rows in range(1, MOST_ROWS + 1) if missed(rows) <= MISSED], default=1)


def band_keys(values: np.ndarray, width: int) -> np.ndarray:
    """One number for each band of `width` rows; bands differ in their salt."""
    bands = 2 * PERMUTATIONS // width
    rows = values[: bands * width].reshape(bands, width)
    keys = ((rows ^ (rows >> np.uint64(32))) * _BAND[:, :width]).sum(axis=1, dtype=np.uint64) + _BAND_SALT[:bands]
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def sign(docs: DataFrame, percent: int) -> DataFrame:
    """(id, n_shingles, digest of the set, band keys) of (id, text)."""
    width = band_rows(percent)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = kept(("shingles",), Shingler)
        for batch in batches:
            for part in slices(batch):
                sizes, digests, bands = [], [], []
                for text in part.column(1).to_pylist():
                    shingles = shingler.shingles(text)
                    sizes.append(len(shingles))
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                    bands.append(band_keys(signature(shingles), width) if len(shingles) else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "digest", "bands"],
                )

    return docs.mapInArrow(signed, "id long, n_shingles long, digest binary, bands array<long>")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, for sorted distinct hashes."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    with_texts = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, last = kept(("shingles",), Shingler), (None, None)
        for batch in batches:
            alike = []
            for row, (text_a, text_b) in enumerate(zip(batch.column(2), batch.column(3))):
                text_a, text_b = text_a.as_py(), text_b.as_py()
                if last[0] != text_a:
                    last = (text_a, shingler.shingles(text_a))
                if similar(last[1], shingler.shingles(text_b), percent):
                    alike.append(row)
            yield batch.select([0, 1]).take(pa.array(alike, pa.int32()))

    return with_texts.select("a", "b", "text_a", "text_b").mapInArrow(compared, "a long, b long")


def _root(parents: dict[int, int], x: int) -> int:
    while parents.setdefault(x, x) != x:
        parents[x] = x = parents[parents[x]]
    return x


def least_agreeing(percent: int) -> int:
    """Of 128 places a pair at 85 agrees in 109 on average, with a standard deviation of 4; 80 is the least then."""
    share = percent / 100
    spread = (2 * PERMUTATIONS * share * (1 - share)) ** 0.5
    return max(0, int(2 * PERMUTATIONS * share - DEVIATIONS * spread))


def linked_block(ids: list[int], groups: list[int], sides: list[int], texts: list[str], percent: int) -> list[tuple[int, int]]:
    """Links that connect different groups, among members of one side or from side 0 to side 1.

    A block of one side holds side 0 only. The pairs that agree most are compared first.
    """
    shingler = kept(("shingles",), Shingler)
    sets = [shingler.shingles(t) for t in texts]
    values = np.stack([signature(s) for s in sets])
    rows = np.flatnonzero(np.array(sides) == 0)
    columns = np.flatnonzero(np.array(sides) == 1)
    whole = not len(columns)
    columns = rows if whole else columns
    label = np.array(groups)
    found, least = [], least_agreeing(percent)
    for i in rows:
        others = columns[columns > i] if whole else columns
        others = others[label[others] != label[i]]
        agreeing = (values[others] == values[i]).sum(axis=1)
        found += [(-int(n), int(i), int(j)) for n, j in zip(agreeing, others) if n >= least]
    parents: dict[int, int] = {}
    links = []
    for _, i, j in sorted(found):
        a, b = _root(parents, groups[i]), _root(parents, groups[j])
        if a != b and similar(sets[i], sets[j], percent):
            parents[a] = b
            links.append((ids[i], ids[j]))
    return links


def link_buckets(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside buckets, from `members` (key, id, component, n members of the bucket)."""
    chunks = F.ceil(F.col("n") / BLOCK)
    mine = F.pmod(F.xxhash64("id"), chunks)
    # Each member meets every chunk of its bucket: once its own, else as the lower or the higher side.
    blocks = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    sided = blocks.select(
        "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "id", "component",
    ).join(texts, "id")
    # A task takes whole blocks, one after the other.
    dealt = sided.select("key", "low", "high", "side", "id", "component", "text").repartition("key", "low", "high")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(block: list[tuple]) -> pa.RecordBatch:
            links = linked_block(*[[r[k] for r in block] for k in (4, 5, 3, 6)], percent) if len(block) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        block: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(7)]):
                if block and block[0][:3] != row[:3]:
                    yield result(block)
                    block = []
                block.append(row)
        yield result(block)

    return dealt.sortWithinPartitions("key", "low", "high").mapInArrow(linked, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    Texts are A-Z lower-cased and cut into words at space and \\x09-\\x0D; with fewer than five words the
    whole sequence is the one shingle. Documents are linked when 100 * intersection >= percent *
    union; component_id is the smallest id reachable, and kept says whether it is the row's own.
    Without words (null, empty) a document is linked with nothing. Rows that repeat an id are one
    document, linked to what any of them is; a null id is linked with nothing and kept. Other
    columns are not looked at; an empty table stays empty. Ids are integers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(F.col(text_col)).alias("text"))
    signed = cut(sign(rows, percent))
    classes = (
        signed.where("digest is not null and id is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("class"), F.first("bands").alias("bands"))
    )
    buckets = classes.select(F.col("class").alias("id"), F.explode("bands").alias("key"))
    pivots = buckets.groupBy("key").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(buckets.join(pivots, "key").where("id <> pivot").select("key", "id", "pivot", "n"))
    pairs = cut(members.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct())
    wanted = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    texts = cut(rows.join(wanted, "id", "left_semi"))
    links = cut(confirmed(pairs, texts, percent))
    found = components(links)
    labelled = members.join(found, F.col("id") == F.col("node"), "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    several = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first <> last")
        .select("key", "n")
    )
    more = cut(link_buckets(labelled.join(several, "key"), texts, percent))
    if not more.isEmpty():
        found = components(links.unionAll(more))
    of_class = classes.select("digest", "class").join(found, F.col("class") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "class").alias("component")
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return signed.select("id", "n_shingles", "digest").join(of_class, "digest", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )

"""Byte-level BPE by a minimal acyclic transducer of frequent words, and exact merging of the rest.

The corpus gives the lexicon: words are counted over all documents, and the most frequent ones are
compiled into an automaton that shares prefixes and suffixes. Its arcs carry numbers; their sum along a
word is the word's place in the table of ids. The automaton is one file of plain arrays, which
Spark hands to each executor and its tasks map into memory. Words that it lacks are merged by the
vocabulary's ranks, so the ids never depend on the lexicon.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import mmap
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.llm.common import cut, filled
from perennia.llm.tokens import Tokens, WordEncoder, WordIds, byte_letters, kept, merges_in_order, slices
from perennia.session import work_folder

#: Words longer than this are never put into the lexicon.
LONGEST = 64
#: What is counted for the lexicon: words, numbers and signs, with the space before them.
COUNTED = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"


#: Ranks after every merge.
_NONE = (1 << 40, -1)


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file of the `tokenizers` library."""

    def __init__(self, text: str):
        parsed = json.loads(text)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        ids = parsed["model"]["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.id_of_byte = [ids[letter] for letter in byte_letters()]
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(parsed["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.quick = None
        if merges_in_order(parsed["model"]):
            ranks = {data: i for i, data in self.bytes_of.items() if i not in self.special.values()}
            # The byte 0 parts words.
            self.quick = tiktoken.Encoding("words", pat_str=r"[^\x00]+", mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        self.lengths[list(self.bytes_of)] = list(map(len, self.bytes_of.values()))

    def merge_all(self, words: list[bytes]) -> WordIds:
        """The ids of these pre-tokenized words."""
        sizes = np.zeros(len(words), np.int64)
        single = [i for i, word in enumerate(words) if self.quick is None or 0 in word]
        merged = [self.merge(words[i]) for i in single]
        together = np.setdiff1d(np.arange(len(words)), single)
        ids = np.zeros(0, np.uint32)
        if len(together):
            ids = self.quick.encode_to_numpy(b"\0".join([words[i] for i in together]).decode(), disallowed_special=())
            # No token reaches over the end of a word, so lengths in bytes tell whose an id is.
            ends = np.cumsum([len(words[i]) for i in together])
            sizes[together] = np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="right"), prepend=0)
        sizes[single] = list(map(len, merged))
        order = np.concatenate([together, single]).astype(np.int64)
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return WordIds(np.concatenate([ids, np.array([i for part in merged for i in part], np.uint32)]), starts, sizes)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-tokenized word: the pair of lowest rank is merged first, from the left."""
        ids = [self.id_of_byte[b] for b in word]
        if len(ids) > 100:
            return self._merge_long(ids)
        find = self.merges.get
        found = [find(pair, _NONE) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is _NONE:
                break
            at = found.index(best)
            ids[at : at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = find((ids[at - 1], ids[at]), _NONE)
            if at < len(found):
                found[at] = find((ids[at], ids[at + 1]), _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for long words."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*f, i) for i in range(n - 1) if (f := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, new, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or self.merges.get((ids[i], ids[j])) != (rank, new):
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (f := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (*f, left))
        return [i for i in ids if i >= 0]


class Transducer(NamedTuple):
    """Arcs sorted by `256 * state + byte`; state 0 starts. A word's place is the sum of its arcs' outputs."""

    arcs: np.ndarray
    targets: np.ndarray
    outputs: np.ndarray
    final: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table of ids, -1 where the lexicon lacks it; all words walk in step."""
        if not words or not len(self.arcs):
            return np.full(len(words), -1)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        letters = np.frombuffer(b"".join(words), np.uint8)
        state, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        state[lengths > LONGEST] = -1
        for step in range(min(int(lengths.max()), LONGEST)):
            live = np.flatnonzero((state >= 0) & (lengths > step))
            keys = state[live] * 256 + letters[ends[live] - lengths[live] + step]
            arc = np.minimum(np.searchsorted(self.arcs, keys), len(self.arcs) - 1)
            known = self.arcs[arc] == keys
            state[live] = np.where(known, self.targets[arc], -1)
            place[live] += np.where(known, self.outputs[arc], 0)
        return np.where((state >= 0) & self.final[np.maximum(state, 0)].astype(bool), place, -1)


def compile_words(entries: list[tuple[bytes, list[int]]]) -> Transducer:
    """The minimal automaton of the words, which must be sorted and distinct."""
    # A state is [final, {byte: state}, words below]; equal states are kept once, found by their content.
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs_of: list[dict[int, int]] = []
    below: list[int] = []
    path: list[tuple[int, list]] = [(0, [False, {}])]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            byte, (final, arcs) = path.pop()
            key = (final, tuple(arcs.items()))
            if key not in register:
                register[key] = len(finals)
                finals.append(final)
                arcs_of.append(arcs)
                below.append(final + sum(below[t] for t in arcs.values()))
            path[-1][1][1][byte] = register[key]

    last = b""
    for word, _ in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for byte in word[common:]:
            path.append((byte, [False, {}]))
        path[-1][1][0] = True
        last = word
    close(0)
    start_final, start_arcs = path[0][1]
    finals, arcs_of, below = [start_final, *finals], [start_arcs, *arcs_of], [0, *below]
    keys, targets, outputs = [], [], []
    for state, arcs in enumerate(arcs_of):
        passed = int(finals[state])
        for byte, target in arcs.items():
            keys.append(256 * state + byte)
            targets.append(target + 1)
            outputs.append(passed)
            passed += below[target + 1]
    sizes = [len(ids) for _, ids in entries]
    return Transducer(
        np.array(keys, np.int64),
        np.array(targets, np.int64),
        np.array(outputs, np.int64),
        np.array(finals, np.uint8),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        np.array([i for _, ids in entries for i in ids], np.uint32),
    )


def packed(transducer: Transducer) -> bytes:
    """One file: a line of JSON with the arrays' types and lengths, then the arrays, each at a multiple of 8."""
    head = json.dumps([[a.dtype.str, len(a)] for a in transducer]).encode()
    out = io.BytesIO()
    out.write(head + b" " * (-(len(head) + 1) % 8) + b"\n")
    for a in transducer:
        out.write(a.tobytes())
        out.write(b"\0" * (-out.tell() % 8))
    return out.getvalue()


def mapped(path: str) -> Transducer:
    """The arrays of such a file, mapped into memory and shared by all processes that read it."""
    with open(path, "rb") as file:
        memory = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    at = memory.find(b"\n") + 1
    arrays = []
    for kind, length in json.loads(memory[:at]):
        a = np.frombuffer(memory, np.dtype(kind), length, at)
        arrays.append(a)
        at += a.nbytes + (-(at + a.nbytes) % 8)
    return Transducer(*arrays)


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents: pre-tokenized words of at most LONGEST bytes, as binary."""
    words = docs.select(F.explode(F.regexp_extract_all(filled(F.col(text_col)), F.lit(COUNTED), F.lit(0))).alias("word"))
    counted = words.where(F.octet_length("word") <= LONGEST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.encode("word", "UTF-8").alias("word"), "n")


def build_lexicon(docs: DataFrame, vocabulary: str, size: int = 200_000, text_col: str = "text") -> str:
    """Compile the most frequent words of `docs`, `size` at most; returns the name of the file that tasks map.

    `vocabulary` is the text of the vocabulary file. The least count is chosen from a histogram of counts,
    so that no more than `size` words of LONGEST bytes ever reach the driver.
    """
    # What occurs once is not frequent, and makes up most of the words.
    counted = cut(count_words(docs, text_col).where("n > 1"))
    level = F.floor(F.log2("n") * 8).cast("int")
    found, least = 0, None
    for row in counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        found += row["count"]
        if found > size:
            break
        least = row["level"]
    frequent = counted.where(level >= least).select("word").collect() if least is not None else []
    words = sorted(bytes(r["word"]) for r in frequent)
    ids, starts, sizes = Vocabulary(vocabulary).merge_all(words)
    entries = [(word, ids[at : at + n].tolist()) for word, at, n in zip(words, starts, sizes)]
    return share(docs.sparkSession, packed(compile_words(entries)))


def share(spark: SparkSession, content: bytes) -> str:
    """Store a file below the shared folder and have Spark hand it to every executor; returns its name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{work_folder(spark, 'lexicon')}/{name}")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(content))
    out.close()
    context.addFile(path.toString())
    return name


class BpeEncoder:
    """Encodes and decodes texts in one task, with the mapped lexicon."""

    def __init__(self, vocabulary: str, lexicon: Transducer):
        self.vocabulary, self.lexicon = Vocabulary(vocabulary), lexicon
        self.special = {token.encode(): i for token, i in self.vocabulary.special.items()}
        self.encoder = WordEncoder(self._encode_words, self.vocabulary.special)
        bytes_of = self.vocabulary.bytes_of
        # By id: the id in print, and the bytes it stands for.
        self.names = pa.array([b"%d," % i for i in range(max(bytes_of) + 1)], pa.large_binary())
        self.spellings = pa.array([bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)], pa.large_binary())

    def _encode_words(self, words: list[bytes]) -> WordIds:
        offsets, table = self.lexicon.offsets, self.lexicon.ids
        place = self.lexicon.places(words)
        # Special tokens go by their own ids, even if the lexicon has a word of those letters.
        special = [i for i, word in enumerate(words) if word in self.special]
        place[special] = -1
        known = place >= 0
        starts, sizes = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        starts[known] = offsets[place[known]]
        sizes[known] = offsets[place[known] + 1] - starts[known]
        known[special] = True
        rest = np.flatnonzero(~known)
        merged, after, sizes[rest] = self.vocabulary.merge_all([words[i] for i in rest])
        starts[rest] = len(table) + after
        starts[special] = len(table) + len(merged) + np.arange(len(special))
        named = np.array([self.special[words[i]] for i in special], np.uint32)
        return WordIds(np.concatenate([table, merged, named]), starts, sizes)

    def tokens(self, texts: list[str]) -> Tokens:
        """The ids of the texts. Special tokens written out in a text are those tokens."""
        return self.encoder.encode(texts)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        ids, starts = self.tokens(texts)
        return [part.tolist() for part in np.split(ids, starts[1:-1])] if texts else []

    def printed(self, tokens: Tokens) -> list[memoryview]:
        """The ids of each text in print, joined by commas."""
        return [text[:-1] for text in _joined(self.names, tokens)]

    def decoded(self, tokens: Tokens) -> list[str]:
        """What the ids of each text stand for. Bytes are decoded together: a character may be spread over tokens."""
        return [str(text, "utf-8", "replace") for text in _joined(self.spellings, tokens)]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _joined(values: pa.Array, tokens: Tokens) -> list[memoryview]:
    """For each text the values of its ids, one after the other."""
    _, offsets, data = values.take(pa.array(tokens.ids)).buffers()
    if not len(tokens.ids):
        return [memoryview(b"")] * (len(tokens.starts) - 1)
    places, whole = np.frombuffer(offsets, np.int64)[tokens.starts].tolist(), memoryview(data)
    return [whole[a:b] for a, b in zip(places, places[1:])]


def _task_encoder(vocabulary: str, lexicon: str) -> BpeEncoder:
    """Lexicons have names of their own."""
    return kept(("bpe", lexicon, zlib.crc32(vocabulary.encode())), lambda: BpeEncoder(vocabulary, mapped(SparkFiles.get(lexicon))))


def encode_documents(
    docs: DataFrame, vocabulary_path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, ids (array of int), decoded (the text those ids stand for).

    Null texts count as empty, and empty texts have no ids. `lexicon` is what build_lexicon returned;
    the vocabulary is read by the driver and sent to the tasks (its size is that of the file).
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _task_encoder(vocabulary.value, lexicon)
        for batch in batches:
            for part in slices(batch):
                tokens = encoder.tokens(part.column(1).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(tokens.starts, pa.int32()), pa.array(tokens.ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), ids, pa.array(encoder.decoded(tokens), pa.string())], ["id", "ids", "decoded"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digest_documents(docs: DataFrame, vocabulary_path: str, lexicon: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), made where the ids are, which then need not move."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _task_encoder(vocabulary.value, lexicon)
        for batch in batches:
            for part in slices(batch):
                tokens = encoder.tokens(part.column(1).to_pylist())
                counts = np.diff(tokens.starts)
                shas = [hashlib.sha256(ids).hexdigest() for ids in encoder.printed(tokens)]
                decoded = [hashlib.sha256(text.encode()).hexdigest() for text in encoder.decoded(tokens)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select("doc_id", filled(F.col("text")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Texts to token ids: whole texts by `TextIds`, or by way of words by `WordEncoder`.

`TextIds` gives the ids of the `tokenizers` library for a BPE file. Where the ids of the file follow the
order of its merges, ranks and merges say the same and the quicker `tiktoken` merges; what it could
cut or spell otherwise is left to the library itself.

`WordEncoder` cuts texts by the pre-tokenizer's pattern and encodes each distinct word of a slice once. Words and
ids of a slice are arrays throughout: nothing but the cutting is done word by word in Python.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken

PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What `make` gives, kept for the next task of this worker with the same key.

    Only the last one is: when a worker turns to another operator, the memory of the one before goes.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


# How the two kinds of files cut a text into the words that are merged one by one.
PLAIN = {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FOLDED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_END = "</w>"
# White space as the library has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def ranges(kind: str) -> str:
    """The characters up to U+FFFF whose class begins with `kind`, as ranges of a pattern."""
    found: list[list[int]] = []
    for code in range(0x10000):
        if unicodedata.category(chr(code))[0] == kind:
            if found and found[-1][1] == code - 1:
                found[-1][1] = code
            else:
                found.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in found)


def split_pattern() -> re.Pattern:
    """SPLIT for characters up to U+FFFF: so stated, the built-in module is quicker than one that knows classes by name."""
    letter, number = ranges("L"), ranges("N")
    return re.compile(f"[{letter}]+|'(?:[stmd]|re|ve|ll)|[{number}]|[^{SPACE}{letter}{number}]+")


_WORDS = split_pattern()


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def merges_in_order(model: dict) -> bool:
    """Whether the ids of the merged tokens grow with the merges, so that an id is a rank."""
    ids = model["vocab"]
    made = [ids["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in model["merges"]]
    return all(a < b for a, b in zip(made, made[1:])) and model.get("dropout") is None and not model.get("ignore_merges")


@cache
def settled(letter: str) -> bool:
    """Whether a character is so old that all libraries agree on its class, case and composition, and not above U+FFFF."""
    return letter < "\U00010000" and unicodedata.ucd_3_2_0.category(letter) != "Cn"


class TextIds:
    """The ids of whole texts as the `tokenizers` library gives them without special tokens added, truncation or padding.

    `vocabulary` is the text of a file of that library. Special tokens written out in a text are those tokens.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        parsed = json.loads(vocabulary)
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        model, cutter = parsed["model"], parsed.get("pre_tokenizer") or {}
        self.quick = None
        if model["type"] != "BPE" or not merges_in_order(model):
            return
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        suffix = model.get("end_of_word_suffix")
        ids = {token: i for token, i in model["vocab"].items() if token not in self.special}
        if not suffix and not parsed.get("normalizer") and all(cutter.get(k) == v for k, v in PLAIN.items()):
            ranks = {bytes(byte_of[c] for c in token): i for token, i in ids.items()}
            self.encoding = tiktoken.Encoding("plain", pat_str=PATTERN.pattern, mergeable_ranks=ranks, special_tokens=self.special)
            self.quick = self._plain
        elif suffix == WORD_END and (parsed.get("normalizer") or {}).get("normalizers") == FOLDED and self._splits(cutter):
            # The end of a word is written as the byte 0, which joins the last letter before all other merges.
            ranks = {
                bytes(byte_of[c] for c in token.removesuffix(WORD_END)) + b"\0" * token.endswith(WORD_END): i
                for token, i in ids.items()
            }
            self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
            self.quick = self._words

    @staticmethod
    def _splits(cutter: dict) -> bool:
        first, *rest = cutter.get("pretokenizers") or [{}]
        return first.get("pattern") == {"Regex": SPLIT} and [r.get("use_regex") for r in rest] == [False]

    def _plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def _words(self, text: str) -> np.ndarray:
        if "\0" in text or any(token in text for token in self.special):
            return self._by_library(text)
        if not text.isascii():
            # A sigma that ends a word is written like any other.
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        words = _WORDS.findall(text.lower())
        words.append("")
        return self.encoding.encode_to_numpy("\0".join(words), disallowed_special=())

    def _by_library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def __call__(self, text: str) -> np.ndarray:
        """The ids of one text, as unsigned 32-bit numbers."""
        if self.quick is None or not (text.isascii() or all(map(settled, set(text)))):
            return self._by_library(text)
        try:
            return self.quick(text)
        except ValueError:  # a run of white space too long for its pattern
            return self._by_library(text)


class Tokens(NamedTuple):
    """The ids of several texts one after the other, and where those of each text begin; the last place is the end."""

    ids: np.ndarray
    starts: np.ndarray


class WordIds(NamedTuple):
    """Ids, where in them those of each word begin, and how many they are."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray


class WordEncoder:
    """Encodes texts; `encode_words` gives the ids of distinct words, as UTF-8.

    `special` are tokens that stand for themselves wherever they are written out; they are given to `encode_words`
    too, which no other word can be taken for. About `limit` words (or those of one text) are held at once.
    """

    def __init__(self, encode_words: Callable[[list[bytes]], WordIds], special: Iterable[str], limit: int = 1_000_000):
        self.encode_words, self.limit = encode_words, limit
        self.special = sorted(special, key=lambda x: -len(x))

    def encode(self, texts: Iterable[str]) -> Tokens:
        """The ids of the texts."""
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for words, ends in self._blocks(texts):
            found, before = self._encode_block(words)
            ids.append(found)
            sizes.append(np.diff(before[ends], prepend=0))
        return Tokens(np.concatenate(ids), np.cumsum(np.concatenate(sizes)))

    def _blocks(self, texts: Iterable[str]) -> Iterator[tuple[list[str], list[int]]]:
        """The words of some texts, and where those of each text end."""
        words: list[str] = []
        ends: list[int] = []
        for text in texts:
            for i, part in enumerate(self._parted(text)):
                words.extend([part] if i % 2 else PATTERN.findall(part))
            ends.append(len(words))
            if len(words) >= self.limit:
                yield words, ends
                words, ends = [], []
        if ends:
            yield words, ends

    def _encode_block(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words, and how many stand before each word and after the last."""
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        table, starts, sizes = self.encode_words(coded.dictionary.cast(pa.large_binary()).to_pylist())
        place = coded.indices.to_numpy()
        before = np.concatenate([[0], np.cumsum(sizes[place])])
        # What is to be added to an id's place here to have its place in the table.
        shift = np.repeat(starts[place] - before[:-1], sizes[place])
        return table[np.arange(before[-1]) + shift].astype(np.int32), before

    def _parted(self, text: str) -> list[str]:
        """Plain text and special tokens in turn."""
        parts = [text]
        for token in self.special:
            if token in text:
                parts = [
                    x
                    for i, part in enumerate(parts)
                    for x in ([part] if i % 2 else [y for s in part.split(token) for y in (token, s)][1:])
                ]
        return parts


def slices(batch: pa.RecordBatch, column: int = 1, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `most` bytes of text (or one row), so that a task's memory stays bounded."""
    start = size = 0
    for row, length in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if row > start and size + length > most:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    yield batch.slice(start)

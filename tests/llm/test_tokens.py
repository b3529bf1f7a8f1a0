import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from perennia.llm.tokens import TextIds

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    path = public_tokenizers.path(request.param)
    with open(path, encoding="utf-8") as file:
        return TextIds(file.read()), Tokenizer.from_file(path)


def same(both, texts):
    quick, library = both
    assert quick.quick is not None
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, w in zip(texts, want) if quick(t).tolist() != w] == []


def test_mixed_texts(both):
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "\t", "\r\n", "\x85", "\x1c", "\x00", "cat", "It's", "'LL", "'ll", "1234", "é", "é", "ß", "İ",
             "ΣΑΣ", "ς", "中文", "\U0001f600", "‍", "᠎", "...", "!?", "<|endoftext|>", "<|startoftext|>", "<|end", "|>", "ſ", "Ⅷ", "²"]
    texts = ["", " ", "\n", "a", " a", "a ", "Σ", "ΑΣ", "́"]
    same(both, texts + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(4000)])


def test_every_character(both):
    same(both, [f"a{chr(c)}B {chr(c)}\n{chr(c)}{chr(c)}1" for c in [*range(0xD800), *range(0xE000, 0x10000), *range(0x1F300, 0x1F700)]])


def test_long_texts(both):
    rng = random.Random(6)
    letters = "".join(rng.choices("abcdefgh", k=200_000))
    same(both, [" " * 1_000_000, "ab" * 100_000, letters, "!?" * 50_000, "\n" * 200_000 + "a", "word " * 50_000])


def test_other_files_go_to_the_library():
    with open(public_tokenizers.path(NAMES[0]), encoding="utf-8") as file:
        text = file.read().replace('"use_regex":true', '"use_regex":false').replace('"use_regex": true', '"use_regex": false')
    quick = TextIds(text)
    assert quick.quick is None
    assert quick("a cat's").tolist() == Tokenizer.from_str(text).encode("a cat's", add_special_tokens=False).ids

import hashlib
import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from perennia.llm import bpe
from perennia.llm.queries import op9_bpe
from perennia.llm.tokens import PATTERN

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


WORDS = [b"", b" the", b" there", b" here", b"the", b"\xc3\xa9", b" \xc3\xa9t\xc3\xa9", b"!", b"!!"]


def test_transducer_holds_just_its_words():
    words = sorted(WORDS)
    automaton = bpe.compile_words([(w, [i]) for i, w in enumerate(words)])
    asked = words + [b" th", b"there", b"x", b" thee", b"\xc3", b"a" * 500]
    assert automaton.places(asked).tolist() == [*range(len(words)), *[-1] * 6]
    # "ere" is shared by two words.
    assert len(automaton.final) < sum(map(len, words)) + 1
    assert bpe.compile_words([]).places([b"a"]).tolist() == [-1]


def test_file_maps_back(tmp_path):
    automaton = bpe.compile_words([(w, [i, i]) for i, w in enumerate(sorted(WORDS))])
    (tmp_path / "a.bin").write_bytes(bpe.packed(automaton))
    for a, b in zip(automaton, bpe.mapped(str(tmp_path / "a.bin"))):
        assert a.tolist() == b.tolist()


def test_ids_equal_library(library, vocabulary):
    rng = random.Random(3)
    merge = bpe.Vocabulary(vocabulary).merge
    known = sorted({p.encode() for p in PATTERN.findall("the cat sat on the mat, it's here")})
    encoder = bpe.BpeEncoder(vocabulary, bpe.compile_words([(w, merge(w)) for w in known]))
    parts = ["the", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x85", "\x1c", "cat", "it's", "'ll", "1234", "é", "ß", "中文", "\U0001f600",
             "é", "...", "<|endoftext|>", "<|end", "|>", "\x00", "ſ", "Ⅷ", "²"]
    texts = ["", " ", "\n", "a", " a", "a ", "a\n\nb", "a \n b", "a\t \tb"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    texts += ["a" * 3000, "the" * 5000, " ".join(["word"] * 20000), "é" * 2500]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text[:60])
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)
    some = [rng.randrange(50257) for _ in range(4000)]
    assert encoder.decode(some) == library.decode(some, skip_special_tokens=False)


def test_memory_that_starts_anew(library, vocabulary):
    encoder = bpe.BpeEncoder(vocabulary, bpe.compile_words([]))
    encoder.encoder.limit = 5
    for k in range(20):
        texts = [f"the word{k} of {i}\n\nan  other{i}" for i in range(k, k + 7)]
        assert encoder.encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("quick", [True, False])
def test_many_words_are_merged_at_once(vocabulary, quick):
    words = [b" the", b"\0", b"!\0!", b"", b" unseenword", b"\xc3\xa9" * 70, b"\n\n", b"'s", b"\0" * 150, b" the", b"x"]
    known = bpe.Vocabulary(vocabulary)
    if not quick:
        known.quick = None
    for some in (words, words[:1], words[1:2], []):
        ids, starts, sizes = known.merge_all(some)
        got = [ids[at : at + n].tolist() for at, n in zip(starts, sizes)]
        assert got == [known.merge(w) for w in some]
        assert sizes.sum() == len(ids)


def test_special_tokens_stand_for_themselves(vocabulary):
    encoder = bpe.BpeEncoder(vocabulary, bpe.compile_words([(b"<|endoftext|>", [1, 2]), (b"a", [64])]))
    end = encoder.vocabulary.special["<|endoftext|>"]
    assert encoder.encode(["a<|endoftext|>a", "", "<|endoftext|>"]) == [[64, end, 64], [], [end]]
    assert encoder.encode([]) == []


def seconds(work):
    begun = time.process_time()
    work()
    return time.process_time() - begun


def test_encoding_takes_few_times_what_cutting_takes(vocabulary):
    """Not much more is done for a word than to cut it out, even where many words are new."""
    rng = random.Random(7)
    parts = ["the", "of", "in", "er", "an", "tion", "sh", "ble", "ou", "ing", "nt", "at", "re", "ha", "st", "ed"]
    frequent = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(400)]

    def word():
        return rng.choice(frequent) if rng.random() < 0.5 else "".join(rng.choices(parts, k=5))

    texts = [" ".join(word() for _ in range(500)) + "." for _ in range(1000)]
    merge = bpe.Vocabulary(vocabulary).merge
    lexicon = bpe.compile_words([(w, merge(w)) for w in sorted({f" {w}".encode() for w in frequent})])
    # Each encoder begins with no word remembered.
    encoders = [bpe.BpeEncoder(vocabulary, lexicon) for _ in range(3)]
    encoding = min(seconds(lambda e=e: e.encoder.encode(texts)) for e in encoders)
    assert encoding < 7 * min(seconds(lambda: [PATTERN.findall(t) for t in texts]) for _ in range(3))


def test_every_character_is_cut_like_the_library(library, vocabulary):
    encoder = bpe.BpeEncoder(vocabulary, bpe.compile_words([]))
    texts = [f"a{chr(c)}b {chr(c)}\n{chr(c)}{chr(c)}1" for c in [*range(0x3000), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F700)]]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bad = [hex(ord(t[1])) for t, ids, w in zip(texts, encoder.encode(texts), want) if ids != w]
    assert bad == []


def test_encode_documents(spark, library, vocabulary):
    rows = [(1, "the cat", 1), (2, None, 2), (3, "", 3), (3, "the cat", 4), (None, "x<|endoftext|>y", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    lexicon = bpe.build_lexicon(docs, vocabulary, size=3)
    got = sorted(bpe.encode_documents(docs, PATH, lexicon).collect(), key=str)
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in rows]
    assert sorted([(r["doc_id"], r["ids"], r["decoded"]) for r in got], key=str) == sorted(want, key=str)
    none = docs.where("false")
    assert bpe.encode_documents(none, PATH, bpe.build_lexicon(none, vocabulary)).count() == 0


def test_query_equals_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op9_bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        got = rows[doc_id]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

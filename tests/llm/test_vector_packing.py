import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perennia.llm.queries import op12_vector_packing
from perennia.llm.vector_packing import Limits, loss_tokens, pack_documents, pack_examples

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(rows, lengths, prompts, limits):
    """Each token lies in one piece, sequences have no gaps and keep every limit, and none needs padding."""
    by_example, by_sequence = {}, {}
    for p in rows:
        by_example.setdefault(p.example, []).append(p)
        by_sequence.setdefault(p.sequence, []).append(p)
    for example, length in enumerate(lengths):
        at = 0
        for p in sorted(by_example.get(example, []), key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == length
    for inside in by_sequence.values():
        at = 0
        for p in sorted(inside, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == limits.tokens or at & (at - 1) == 0
        assert at <= limits.tokens and len(inside) <= limits.segments
        assert sum(loss_tokens(p.start, p.length, prompts[p.example]) for p in inside) <= limits.loss
    return by_sequence


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 64), Limits(100, 7, 30), Limits(16, 1, 1), Limits(1, 1, 1)])
def test_every_limit_holds(limits):
    rng = random.Random(limits.segments)
    lengths = [rng.choice([0, 1, 2, 3, rng.randint(1, 90), rng.randint(1, 700)]) for _ in range(300)]
    prompts = [rng.choice([0, 1, rng.randint(0, 700)]) for _ in lengths]
    check_places(pack_examples(lengths, prompts, limits), lengths, prompts, limits)


def plain_choice(pieces, room, limits, weights):
    """The piece that fits and has the greatest dot product, by a loop."""
    best = None
    for length, loss in pieces:
        need = (length, 1, loss)
        if all(n <= r for n, r in zip(need, room)):
            dot = sum(w * n / c * r / c for w, n, r, c in zip(weights, need, room, limits))
            if best is None or dot > best[0] + 1e-12:
                best = (dot, (length, loss))
    return best and best[1]


def test_whole_pieces_are_chosen_by_the_dot_product():
    """Needs of two kinds: much loss or little; the plain loop makes the same first sequence."""
    rng = random.Random(4)
    lengths = [rng.randint(1, 40) for _ in range(60)]
    prompts = [rng.randint(0, n) for n in lengths]
    limits = Limits(200, 9, 90)
    first = [p for p in pack_examples(lengths, prompts, limits) if p.sequence == 0]
    left = [(n, n - p) for n, p in zip(lengths, prompts)]
    room = list(limits)
    for p in first:
        want = plain_choice(left, room, limits, (1.0, 0.1, 1.0))
        if want is None:
            break  # from here on pieces are cut
        assert (p.length, loss_tokens(p.start, p.length, prompts[p.example])) == want
        left.remove(want)
        room = [r - n for r, n in zip(room, (want[0], 1, want[1]))]


def test_whole_examples_stay_whole_where_they_can():
    lengths = [1000] * 40
    rows = pack_examples(lengths, [1] * 40)
    by_example = [sum(p.example == i for p in rows) for i in range(40)]
    assert len({p.sequence for p in rows}) <= 40_000 // 4096 + 12
    assert sum(n > 1 for n in by_example) <= 24
    assert pack_examples([], []) == []
    with pytest.raises(ValueError):
        pack_examples([1], [0], Limits(0, 1, 1))


def pieces_of(rows):
    return sorted(rows, key=lambda r: (str(r["doc_id"]), r["doc_tokens"], r["sequence_id"], r["offset"]))


def test_odd_rows(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(1, "Word it's " * 9000, 0), (2, None, 0), (3, "", 0), (4, "A<|endoftext|> b\n\nc", 0), (4, "A<|endoftext|> b\n\nc", 0), (None, "é\tü\0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id long").repartition(2)
    got = pack_documents(docs, PATH, with_ids=True).collect()
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        mine = [r for r in got if r["doc_id"] == doc_id]
        assert {r["doc_tokens"] for r in mine} == {len(ids)}
        times = sum(r[0] == doc_id for r in rows)
        assert sorted(i for r in mine for i in r["ids"]) == sorted(ids * times)
        if times == 1:
            assert [i for r in sorted(mine, key=lambda r: r["start"]) for i in r["ids"]] == ids
    assert pack_documents(docs.where("false"), PATH).count() == 0


def test_instructions_and_answers(spark):
    rows = [(i, "question " * (i % 9), "answer " * (i % 5)) for i in range(200)] + [(900, None, "x"), (901, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, ask string, reply string").coalesce(1)
    both = docs.select("doc_id", F.concat(F.coalesce("ask", F.lit("")), F.coalesce("reply", F.lit(""))).alias("text"), F.length("ask").alias("asked"))
    limits = Limits(64, 5, 20)
    got = pack_documents(both, PATH, limits, prompt=F.col("asked"), with_ids=True, group_tokens=500).collect()
    loss = {r["doc_id"]: 0 for r in got}
    by_sequence = {}
    for r in got:
        loss[r["doc_id"]] += r["loss"]
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, ask, reply in rows[:200]:
        assert loss[i] == i % 5 + 1  # the answer and the end
    for inside in by_sequence.values():
        assert sum(r["loss"] for r in inside) <= 20 and len(inside) <= 5 and sum(r["length"] for r in inside) <= 64


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = op12_vector_packing(spark, folder).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for inside in by_sequence.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at == 4096 or (at < 4096 and at & (at - 1) == 0)

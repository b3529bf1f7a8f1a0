import re
import zlib

import numpy as np
import public_tokenizers
from test_minhash import brute as near_brute
from test_pii import base
from tokenizers import Tokenizer

import corpus_pipeline
from perennia.llm.pii import learn_spans, annotate
from perennia.llm.toxicity import learn_toxicity, score_toxicity

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_stages_equal_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "personal data", "packing"]
    texts = {i: r["text"] for i, r in rows.items()}
    model = learn_toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    toxic = {r["doc_id"] for r in score_toxicity(docs, model).where("predicted = 1").collect()}
    want = [{i: t for i, t in texts.items() if i not in toxic}]
    largest = {lower(t or ""): i for i, t in sorted(want[-1].items())}
    want.append({i: t for i, t in want[-1].items() if largest[lower(t or "")] == i})
    kept = near_brute(list(want[-1].items()), percent=80)
    want.append({i: t for i, t in want[-1].items() if kept[i][2]})
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        got = docs.collect()
        assert {r["doc_id"]: r["text"] for r in got} == want[k], name
        assert all(r == rows[r["doc_id"]] for r in got)
    clean = {r["doc_id"]: r for r in corpus_pipeline.redact_personal_data(spark, docs, FOLDER).collect()}
    spans = {r["doc_id"]: r["spans"] for r in annotate(docs, learn_spans(docs)).collect()}
    assert clean.keys() == want[2].keys()
    for i, r in clean.items():
        if not spans[i]:
            assert r["text"] == want[2][i] and r["n_chars"] == rows[i]["n_chars"]
            continue
        assert r["n_chars"] == len(r["text"])
        for kind, start, end in base(want[2][i]):
            assert want[2][i][start:end] not in r["text"]


def test_run_packs_what_is_left(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, FOLDER)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        ids = np.array(library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [0], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())


def test_empty_and_odd_tables(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    odd = [(None, None, None, None, None), (None, "a", None, None, None), (1, "", "x", "y", 0), (1, "", "x", "y", 0), (2, None, None, None, None)]
    for rows, left in (([], set()), (odd, {None, 1, 2})):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
        assert {r["doc_id"] for r in docs.collect()} <= left


def test_stages_decide_by_row(spark, folder):
    """Repeated rows leave one survivor, and a null id protects nothing."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = [f"wort{i}" for i in range(40)]
    rows = [(i, " ".join(words[(i * 7 + k) % 40] for k in range(12)) + (" groblixx" if i % 2 else f" rest{i}"), "x", "y", i) for i in range(60)]
    spark.createDataFrame([(i, 0, i % 2) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    clean, toxic = "wort1 wort9 wort3 wort7", "wort1 groblixx wort5 groblixx"
    odd = [(None, toxic), (None, clean), (900, clean + " rest"), (900, toxic)]
    docs = spark.createDataFrame(rows + [(i, t, None, None, None) for i, t in odd], schema)
    left = corpus_pipeline.drop_toxic(spark, docs, folder).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left if r["lang"] is None and r["doc_id"]) == [(900, clean + " rest")]
    assert [r["text"] for r in left if r["doc_id"] is None] == [clean]
    assert sorted(r["doc_id"] for r in left if r["lang"]) == list(range(0, 60, 2))

    copies = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (3, "B"), (None, "a"), (None, "n"), (None, "N"), (None, "c")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in copies], schema)
    left = [(r["doc_id"], r["text"].lower()) for r in corpus_pipeline.drop_exact_copies(spark, docs, folder).collect()]
    assert sorted(left, key=str) == sorted([(1, "a"), (2, "c"), (3, "b"), (None, "n")], key=str)

    near = [" ".join(f"{p}{i}" for i in range(100)) for p in "pqr"]
    more = [t + " end" for t in near]
    docs = [(5, near[0]), (5, more[0]), (5, near[1]), (2, more[1]), (None, near[1] + " null"), (None, near[2]), (None, more[2])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], schema)
    left = [(r["doc_id"], r["text"][0]) for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()]
    assert sorted(left, key=str) == sorted([(5, "p"), (2, "q"), (None, "r")], key=str)

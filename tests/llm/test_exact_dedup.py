import hashlib
import random
import re

from perennia.llm import exact_dedup as module
from perennia.llm.exact_dedup import exact_dedup


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    best = max if keep == "max" else min
    return sorted(
        (i, best(groups[lower(t)]), len(groups[lower(t)]), i == best(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t in rows
    )


def test_equal_to_brute_force_with_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(module, "LEAST_FREQUENT", 5)
    rng = random.Random(1)
    words = ["Éa", "éa", "ABC", "abc", "", None, "ß", "ẞ", "İx", "x" * 200_000, "X" * 200_000, "same beginning " * 4 + "a", "same beginning " * 4 + "b"]
    rows = [(i, rng.choice(words) if i % 2 else f"Text {i % 37}") for i in range(400)] + [(i, "Hot TEXT" if i % 3 else "hot text") for i in range(400, 900)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    for keep in ("max", "min"):
        assert sorted(map(tuple, exact_dedup(docs, keep=keep).collect())) == brute(rows, keep)


def test_repeats_nulls_and_empty_tables(spark):
    rows = [(5, "a"), (5, "A"), (3, "a"), (None, "a"), (None, "alone"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = exact_dedup(docs, keep="max").collect()
    assert len(out) == 7 and sorted(str(r["doc_id"]) for r in out if r["kept"]) == ["5", "8", "None"]
    assert {r["group_size"] for r in out if r["text_sha256"] == hashlib.sha256(b"a").hexdigest()} == {4}
    assert exact_dedup(docs.where("false")).count() == 0

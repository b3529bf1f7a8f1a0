import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from compare import compare, connect

from perennia.llm import prefix_trie as trie
from perennia.llm.oracles import ORACLES
from perennia.llm.prefix_trie import RangeMinimum, prefix_trie
from perennia.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, block string, key int"


def plain(rows):
    """The trie by dictionaries."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, said in own.items():
        digest = lambda t: hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()[:15]
        # The library sorts ties by the digest in print.
        own[c] = [t[2:] for t in sorted(said, key=lambda t: (*t[:2], __import__("base64").b64encode(digest(t))))]
    rebuilt = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h]) + tuple(said[h:])
    members = {}
    for c, said in rebuilt.items():
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        childless = [p for p in below if not any(q[:-1] == p and q for q in below)]
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(prefix))))
        out.append(
            (
                min(convs),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(convs),
                sum(len(p) == len(prefix) + 1 for p in below),
                len(childless),
                sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def built(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, prefix_trie(frame).collect()), key=str)


def test_range_minimum_and_ends():
    rng = random.Random(2)
    for n in (1, 2, 3, 7, 64, 100):
        values = np.array([rng.randrange(6) for _ in range(n)])
        table = RangeMinimum(values)
        pairs = [(a, b) for a in range(n) for b in range(a, n)]
        first, last = map(np.array, zip(*pairs))
        assert table.least(first, last).tolist() == [values[a : b + 1].min() for a, b in pairs]
        for depth in range(7):
            at = np.arange(n)
            deep = np.full(n, depth)
            left, right = table.left_end(at, deep).tolist(), table.right_end(at, deep).tolist()
            for i in range(n):
                assert left[i] == min(x for x in range(i + 1) if (values[x + 1 : i + 1] >= depth).all())
                assert right[i] == max(x for x in range(i, n) if (values[i + 1 : x + 1] >= depth).all())


def random_rows(seed, convs, alphabet, longest, step=1):
    rng = random.Random(seed)
    rows = []
    for c in range(0, convs * step, step):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(alphabet)))
    return rows


@pytest.mark.parametrize("block", [200_000, 7, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_dictionaries(spark, monkeypatch, block, seed):
    """In one block a partition, in many, and with a block for every conversation."""
    monkeypatch.setattr(trie, "BLOCK_ROWS", block)
    monkeypatch.setattr(trie, "BROADCAST_NODES", 0 if seed == 1 else 1000)
    rows = random_rows(seed, 60, ["yes", "no  way", ""], 6)
    assert built(spark, rows) == plain(rows)


def test_copies_and_one_common_first_turn(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_ROWS", 9)
    # Multiples of 20 are their own base, so that copies stay copies.
    rows = [(20 * c, t, "user", text) for c in range(60) for t, text in enumerate(("hello there", "same words", "end"))]
    rows += [(20 * c, t, "user", text) for c in range(60, 90) for t, text in enumerate(("hello there", f"own {c}"))]
    rows += [(20 * c, 0, "user", "hello there") for c in range(90, 100)]
    assert built(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "a b"), (0, 1, "user", "a b"), (0, 1, "assistant", "c"), (1, None, "user", "x\x0b y\xa0z"),
        (None, 1, "user", "lost"), (2, 5, "user", "late"), (2, -5, "user", "early"), (-3, 1, "user", "below"), (19, 0, "", ""),
        (40, 0, "us", "er"), (60, 0, "user", ""), (41, 0, "u", "v"),
    ]
    got, want = built(spark, [r for r in rows if r[0] != -3]), plain([r for r in rows if r[0] != -3])
    assert got == want
    assert built(spark, [(-3, 1, "user", "below")])[0][0] == -3
    assert built(spark, []) == [] and built(spark, [(None, 1, "user", "x")]) == []


def test_conversations_without_turns(spark):
    """One turn each, cut off with the first h: only the root is left, which is its own leaf."""
    alone = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4][:5]
    rows = [(c, 0, "user", "gone") for c in alone]
    assert built(spark, rows) == plain(rows)
    assert built(spark, rows)[0][3:6] == (5, 0, 1)


def test_very_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_ROWS", 1)
    rows = [(c, t, "user", f"turn {t}" if t != 1500 or c else "other") for c in (0, 20, 40) for t in range(2000)]
    found = built(spark, rows)
    assert len(found) == 1 + 1500 + 2 * 500
    root = next(r for r in found if r[1] == 0)
    assert root[3:7] == (3, 1, 2, 1500 * 2 * 2 + 500 * 2)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.1"
    assert compare(spark, connect(folder), op11_prefix_trie, ORACLES["op11_prefix_trie"], folder) is None

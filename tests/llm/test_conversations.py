import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pulsefeed.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, d int, owner string, ref string, n_convs string, part string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c", "e") for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(t, key=lambda x: x[0])] for c, t in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = (own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, d == len(turns)))
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words(p)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c, e in sorted(m) if e)
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in m), len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def test_products_are_a_monoid():
    rng = np.random.default_rng(1)
    turns = [rng.integers(0, conversations.PRIME, 9) for _ in conversations.LANES]

    def product(a, b):
        parts = [t[a:b] for t in turns]
        weights = conversations.powers(conversations.BASES, np.arange(b - a))
        return [int((p * w % conversations.PRIME).sum() % conversations.PRIME) for p, w in zip(parts, weights)]

    for cut in range(10):
        right = conversations.shifted([np.array([s]) for s in product(cut, 9)], np.array([cut]))
        assert [(a + int(b[0])) % conversations.PRIME for a, b in zip(product(0, cut), right)] == product(0, 9)
        back = conversations.shifted(right, np.array([-cut]))
        assert [int(x[0]) for x in back] == product(cut, 9)


def conversation(conv, n, rng, vocabulary=2):
    return [(conv, k, rng.choice(["user", None, ""]), f"t{rng.randrange(vocabulary)}  words here"[: rng.choice([2, 30])]) for k in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_operator(spark, seed, monkeypatch):
    """Few different turns, so that paths meet, end and part everywhere; slices of two depths."""
    monkeypatch.setattr(conversations, "_DEPTH_SLICE", 2)
    monkeypatch.setattr(conversations, "_CHUNK_IDS", 3)
    rng = random.Random(seed)
    rows = [r for c in rng.sample(range(200), 90) for r in conversation(c, rng.randint(1, 7), rng)]
    rng.shuffle(rows)
    assert got(conversations.prefix_trie(table(spark, rows).repartition(5))) == brute(rows)


def test_awkward_rows(spark):
    rows = [
        (1, None, "user", "null turn comes first"), (1, 0, None, None), (1, 5, "a", "gap"), (None, 0, "user", "of no conversation"),
        (2, 1, "user", "same"), (2, 1, "user", "same"), (2, 1, "user", "same"), (0, 0, "user", "x" * 100_000), (0, 1, "", ""),
        (21, 0, "user", "its base is missing"), (23, 3, None, "alone"), (45, 0, "u", "a"), (45, 1, "u", "a"), (45, 2, "u", "a"), (46, 9, "u", "a"),
    ]
    assert got(conversations.prefix_trie(table(spark, rows))) == brute(rows)


def test_one_conversation_and_one_path_hold_a_third(spark):
    rng = random.Random(9)
    rows = [(40, k, "user", f"turn {k}") for k in range(900)]
    rows += [(c, k, "user", f"common {k}") for c in range(1000, 3000, 20) for k in range(9)]
    rows += [r for c in range(100, 400) for r in conversation(c, 3, rng, 500)]
    assert got(conversations.prefix_trie(table(spark, rows).repartition(6))) == brute(rows)


def test_unlike_turns_of_one_fingerprint_are_an_error(spark):
    made = spark.createDataFrame([(1, 5, 6, "user", "a"), (2, 5, 6, "user", "b")], "ref long, h1 long, h2 long, role string, text string")
    lanes = {s: 1 for s in conversations.LANES}
    rows = spark.createDataFrame([{"d": 1, "ref": 1, **lanes}, {"d": 1, "ref": 2, **lanes}])
    group = {"d": 1, "n_convs": 2, "h1": 5, "h1_max": 5, "h2": 6, "h2_max": 6, "ref": 1, "ref_max": 2, **lanes}
    with pytest.raises(ValueError, match="fingerprints"):
        conversations.verify(spark.createDataFrame([group]), rows, made)
    conversations.verify(spark.createDataFrame([group]), rows, made.withColumn("text", made.role))


def test_no_conversations(spark):
    assert conversations.prefix_trie(table(spark, [])).collect() == []
    assert conversations.prefix_trie(table(spark, [(None, 1, "user", "x")])).collect() == []

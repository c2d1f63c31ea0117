import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulsefeed.llm import collocations
from pulsefeed.llm.transducer import Grams, Transducer, places, union

SCHEMA = "doc_id long, text string, lang string, rank int, phrase string, size long, data string, range int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", 2, "y", 3) for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, max_words=5, min_count=100, top=2000, percent=100):
    counts, totals = {}, Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            lang = "und" if lang is None else lang
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        for p, a in candidates.items():
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def texts(n, seed, vocabulary=12, length=(1, 40)):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["The", "of", "ÉTÉ", "x\x01y"]
    joins = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "; ", "\x0b"]
    return ["".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randint(*length))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(40))
def test_transducers(seed):
    rng = random.Random(seed)
    depth = rng.randint(1, 5)
    words = [bytes(rng.choices(b"abc\x00z", k=rng.randint(1, 3))) for _ in range(8)]
    parts = [Counter(tuple(rng.choices(words, k=rng.randint(1, depth))) for _ in range(rng.randint(0, 40))) for _ in range(3)]
    want = sum(parts, Counter())
    all_ = union([Grams.of([list(k) for k in c], list(c.values()), depth) for c in parts], depth)
    assert [tuple(g) for g in all_.texts()] == sorted(want)
    back = Transducer.from_bytes(Transducer.build(all_).to_bytes())
    assert [tuple(g) for g in back.grams().texts()] == sorted(want) and back.grams().counts.tolist() == [want[k] for k in sorted(want)]
    asked = sorted({tuple(rng.choices([*words, b"q"], k=rng.randint(1, depth))) for _ in range(30)})
    assert back.compose(Grams.of([list(k) for k in asked], [1] * len(asked), depth)).tolist() == [want.get(k, 0) for k in asked]
    if want:
        bounds = all_.take(np.unique(np.array([rng.randrange(len(all_)) for _ in range(3)])))
        below = [tuple(b) for b in bounds.texts()]
        assert places(all_, bounds).tolist() == [sum(b <= k for b in below) for k in sorted(want)]


def test_equal_states_are_stored_once():
    grams = [[a, b, c] for a in (b"a", b"b", b"c") for b in (b"x", b"y") for c in (b"p", b"q")]
    made = Transducer.build(Grams.of(grams, [5] * len(grams), 3))
    # One state each for the start, after the first and after the second word, besides the one without arcs.
    assert len(made.starts) - 1 == 4 and len(made.arcs) == 3 + 2 + 2


def test_slices_end_with_pieces():
    rng = random.Random(2)
    rows = texts(50, 1) + ["no separator here " * 40, "", "".join(rng.choices("ab .", k=5000))]
    raws = list(collocations.slices(pa.array([t.encode() for t in rows], pa.large_binary()), 64))
    assert b"\n".join(t.encode().translate(collocations._TABLE) for t in rows).replace(b"\n", b"") == b"".join(raws).replace(b"\n", b"")
    whole = Counter(w for t in rows for w in t.encode().translate(collocations._TABLE).split(b"\n"))
    cut = Counter(w for raw in raws for w in raw.split(b"\n"))
    whole.pop(b""), cut.pop(b"")
    assert whole == cut


@pytest.mark.parametrize(("max_words", "min_count", "filter_bits"), [(5, 20, 1 << 16), (3, 5, 64), (2, 10, 1 << 16), (5, 60, 8)])
def test_operator(spark, max_words, min_count, filter_bits):
    """Also with ranges and shards of a few n-grams, and with a bitmap that excludes next to nothing."""
    rows = [(t, lang) for lang, seed in (("en", 1), (None, 2), ("und", 3), ("de", 4)) for t in texts(60, seed)]
    rows += [(None, "en"), ("", "fr"), (" .\n", None), ("one two three. one two", "once")] + [("Hot phrase, hot phrase indeed " * 50, "en")] * 5
    made = collocations.collocations(table(spark, rows).repartition(6), max_words, min_count, filter_bits=filter_bits, shard_grams=50, range_grams=40)
    want = brute(rows, max_words, min_count)
    assert want and got(made) == want


def test_defaults_top_and_cover(spark):
    rows = [(t, "en") for t in texts(300, 5)]
    assert got(collocations.collocations(table(spark, rows), top=7)) == brute(rows, top=7)
    assert got(collocations.collocations(table(spark, rows), min_count=20, percent=60)) == brute(rows, min_count=20, percent=60)


def test_one_phrase_holds_a_third_and_texts_are_long(spark):
    rows = [("very common words " * 4000, "en")] + [(t, "en") for t in texts(100, 6)] + [("very common words " * 30, "en")] * 60
    assert got(collocations.collocations(table(spark, rows).repartition(9), range_grams=30)) == brute(rows)


def test_exact_scores_beyond_64_bits():
    big = 3 * 10**12
    grams = Grams.of([[b"a"], [b"b"], [b"a", b"b"]], [big, big + 7, big - 1], 2)
    known, n = Transducer.build(grams), 10**13
    (_, head, tail), = collocations._parts(grams.take(np.array([1])))
    left, right = known.compose(head).tolist()[0], known.compose(tail).tolist()[0]
    assert 1000 * (big - 1) * n // (left * right) == 1000 * (big - 1) * n // (big * (big + 7))


def test_nothing_to_find(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [("a b c", "en"), (None, None)])).count() == 0

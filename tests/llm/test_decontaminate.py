import random
import re

import pytest
from corpus import awkward, docs

from pulsefeed.llm import decontaminate as de


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        w = words_of(item)
        if not w:
            continue
        n = min(len(w), window)
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


def case(seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Été", "B2"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.randint(0, 3 * window))) for i in range(12)] + [(90, None), (91, ""), (92, items_text := say(2 * window)), (93, items_text)]
    rows = [(i, say(rng.randint(0, 80))) for i in range(40)]
    for i in range(20):
        passage = rng.choice([t for _, t in items if t])
        rows.append((100 + i, f"{say(rng.randint(0, 20))}. {passage.upper()}, {say(rng.randint(0, 20))}"))
    return items, rows


@pytest.mark.parametrize(("seed", "window", "block"), [(1, 4, 10**6), (2, 3, 10**6), (3, 10, 10**6), (4, 4, 20), (5, 2, 40)])
def test_against_brute_force(spark, seed, window, block):
    items, rows = case(seed, window)
    rows = rows + awkward()[:7]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = de.contamination(docs(spark, rows), bench, window, block).collect()
    want = [(r[0], *brute(r[1], items, window)) for r in rows]
    key = lambda r: (r[0] or -1, r[1], r[2])
    assert sorted(((r.doc_id, r.n_words, r.n_hit, sorted(set(r["items"]))) for r in got), key=key) == sorted(want, key=key)


def test_spans_go_and_the_rest_stays(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    own = " ".join(f"own{i}" for i in range(40))
    rows = [(1, f"{own}, {passage.title()}! {own}"), (2, own), (3, passage), (4, None), (5, ""), (6, own + " alpha beta gamma")]
    table = docs(spark, rows)
    out = de.decontaminate(table, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == table.columns
    assert set(got) == {1, 2, 4, 5, 6}  # 3 is nothing else
    assert got[1].text == f"{own}, ! {own}" and got[1].n_chars == len(got[1].text)
    assert got[2].text == own and got[4].text is None and got[4].n_chars is None and got[6].text == rows[5][1]


def test_empty_benchmark_and_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert de.decontaminate(docs(spark, awkward()), none).count() == len(awkward())
    assert de.contamination(docs(spark, []), none).collect() == []


def test_a_very_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    text = "filler " * 200_000 + passage + " filler" * 10
    got = de.contamination(docs(spark, [(1, text)]), spark.createDataFrame([(7, passage)], "item_id long, text string")).first()
    assert (got.n_words, got.n_hit, got["items"]) == (200_022, 12, ["7"])


def test_one_word_repeated_takes_time_in_proportion():
    """Suffix links walked, not seconds: a run of one word is walked once."""
    walked = []
    for n in (2_000, 8_000):
        automaton = de.Automaton([(1, [b"a"] * n), (2, [b"a"] * 3)], 10)
        steps = 0

        class Counted(list):
            def __getitem__(self, i):
                nonlocal steps
                steps += 1
                return list.__getitem__(self, i)

        automaton.link = Counted(automaton.link)
        hit, found = automaton.match([b"b", *[b"a"] * n, b"b"])
        assert hit.sum() == n and found == {1, 2}
        walked.append(steps)
    assert walked[1] < 5 * walked[0]


def test_large_benchmark_in_bounded_passes(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choices([f"w{i}" for i in range(9)], k=n))
    items = [(i, say(rng.randint(0, 12))) for i in range(10)] + [(50, say(300)), (51, say(41))]
    rows = [(i % 7 or None, say(rng.randint(0, 60))) for i in range(20)] + [(200, items[-2][1]), (201, items[-2][1][120:400])] + awkward()[:7]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    sizes = [r.n_words for r in de.blocks(bench, 4, 40).select("n_words").collect()]
    assert max(sizes) <= 40 and len(sizes) > 8  # the long items too
    found = de.contamination(docs(spark, rows), bench, 4, 40)
    # Each block was a pass of its own: no task of what is returned holds an automaton.
    assert "EvalPython" not in found._jdf.queryExecution().executedPlan().toString()
    key = lambda r: (r[0] or -1, r[1], r[2], r[3])
    want = [(r[0], *brute(r[1], items, 4)) for r in rows]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=key) == sorted(want, key=key)


def test_pieces_hold_each_window_once():
    for n in range(30):
        for window, size in ((3, 6), (3, 8), (1, 2)):
            words = [b"%d" % i for i in range(n)]
            got = [tuple(p[i : i + window]) for p in de.pieces(words, window, size) for i in range(max(0, len(p) - window) + 1)]
            assert got == ([tuple(words[i : i + window]) for i in range(max(0, n - window) + 1)] if n else [])

import hashlib
import re

import pytest
from corpus import awkward, docs, texts
from pyspark.sql import functions as F

from pulsefeed.llm import spotsigs


def chains(text, chain=spotsigs.CHAIN):
    """Chains by walking the words."""
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]
    common = [w in spotsigs.COMMON_WORDS for w in words]
    opens = [i == 0 or common[i - 1] or not any(common[max(0, i - spotsigs.STRETCH) : i]) for i in range(len(words))]
    content = [(w, opens[i]) for i, w in enumerate(words) if not common[i]]
    got = {tuple(w for w, _ in content[i : i + chain]) for i, (_, opens) in enumerate(content) if opens}
    return got or ({(text.lower(),)} if text else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_of(rows):
    """(doc_id, text, edited, next) in descending order; ties in the order of Spark's hash are not used here."""
    ordered = sorted(rows, key=lambda r: -r[0])
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        yield doc_id, text, text[: len(text) - half] + following[:half], following


def rows_without_ties():
    seen, out = set(), []
    for r in awkward():
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append((r[0], r[1]))
    return out + [(1000 + 3 * i, t) for i, t in enumerate(texts(120, seed=6))] + [(5000, "The same text of a sort"), (5001, "The same text of a sort")]


@pytest.mark.parametrize("bucket", [1_000, 7])
def test_edits_against_brute_force(spark, monkeypatch, bucket):
    rows = rows_without_ties()
    monkeypatch.setattr(spotsigs.with_next, "__defaults__", (bucket,))
    got = {r.doc_id: r for r in spotsigs.edits(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, edited, following in edited_of(rows):
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(chains(text), chains(edited)))
        assert r.near_next == pytest.approx(jaccard(chains(text), chains(following)))
        assert len(r.fingerprint.split()) == len(chains(text))
    assert got[5000].fingerprint == got[5001].fingerprint and got[5001].near_next == 1.0


def test_text_without_anchors_is_fingerprinted_whole(spark):
    alike = "zeta eta theta " + " ".join(f"x{i}" for i in range(500))
    other = "zeta eta theta " + " ".join(f"y{i}" for i in range(500))
    got = {r.doc_id: r for r in spotsigs.edits(docs(spark, [(1, alike), (2, other), (3, "  " + alike + " !")])).collect()}
    assert got[2].near_next < 0.01 and got[1].near_edited < 0.7 and got[1].fingerprint != got[2].fingerprint
    assert got[1].fingerprint == got[3].fingerprint


def test_an_id_with_a_third_of_the_rows_is_cut(spark, monkeypatch):
    """Equal ids, null ids and wholly equal rows: every row once, no bucket far beyond its size."""
    monkeypatch.setattr(spotsigs.with_next, "__defaults__", (20,))
    for same in (7, None):
        rows = [(same, "the same row again")] * 400 + [(same, f"the row {i} of them") for i in range(100)] + [(1000 + i, t) for i, t in enumerate(texts(700, seed=3))]
        table = docs(spark, rows).repartition(5)
        spread, _ = spotsigs.with_next(table, 20)
        sizes = [r["count"] for r in spread.groupBy("bucket").count().collect()]
        assert max(sizes) <= 130 and sum(sizes) >= len(rows)
        got = spotsigs.edits(table).collect()
        assert len(got) == len(rows)
        unique = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id >= 1000}
        ordered = sorted(unique, reverse=True)
        text = {1000 + i: t for i, t in enumerate(texts(700, seed=3))}
        for a, b in zip(ordered, ordered[1:]):
            half = len(text[a]) // 2
            assert unique[a].edited_sha256 == hashlib.sha256((text[a][: len(text[a]) - half] + text[b][:half]).encode()).hexdigest()


def test_ties_nulls_and_one_document(spark):
    assert spotsigs.edits(docs(spark, awkward())).count() == len(awkward())
    alone = spotsigs.edits(docs(spark, [(4, "the first half and the second")])).first()
    assert alone.near_next == 1.0
    assert spotsigs.edits(docs(spark, [])).collect() == []


def test_only_native_functions(spark):
    plan = spotsigs.edits(docs(spark, rows_without_ties()))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_similar_pairs_against_all_pairs(spark):
    base = [" the ".join(t.split()) for t in texts(40, seed=9, length=(60, 120), vocabulary=400)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, " ".join(t.split()[: -(4 + 4 * (i % 9))])) for i, t in enumerate(base)] + [(200, base[0]), (201, None), (202, "")]
    members = spotsigs.classes(docs(spark, rows))
    found = {(r.a, r.b): r.likeness for r in spotsigs.similar(members, 0.8).collect()}
    classes = {r.doc_id: r.class_id for r in members.collect()}
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(classes[doc_id], chains(text))
    want = {(a, b): jaccard(sets[a], sets[b]) for a in sets for b in sets if a < b and sets[a] and jaccard(sets[a], sets[b]) >= 0.8}
    assert found == pytest.approx(want) and len(want) > 10
    assert classes[200] == 0 and classes[202] == 201


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_similar_keeps_classes_of_repeated_and_null_ids(spark, least):
    """Every class counts, whatever its ids; also where most texts share their signatures, and one text is a third of all rows."""
    base = [" the ".join(t.split()) for t in texts(12, seed=4, length=(30, 50), vocabulary=300)]
    shared = " the " + " the ".join(f"common{i}" for i in range(20))
    cut = lambda t, n: " ".join(t.split()[:-n])
    rows = [(7, t) for t in base] + [(7, cut(t, 4)) for t in base] + [(None, cut(t, 8)) for t in base]
    rows += [(20 + i, t + shared) for i, t in enumerate(base)] + [(None, base[0])] * 40 + [(3, None), (None, "")]
    members = spotsigs.classes(docs(spark, rows).repartition(4)).collect()
    assert len(members) == len(rows)
    key_of = {}
    for r in members:
        key_of.setdefault(tuple(r.own), set()).add(r.class_key)
    assert all(len(k) == 1 for k in key_of.values())
    ids = {}
    for r in members:
        ids.setdefault(r.class_key, []).append(r.doc_id)
    assert all(r.class_id == min((i for i in ids[r.class_key] if i is not None), default=None) for r in members)
    sets = {r.class_key: set(r.own) for r in members if r.own}
    assert len(sets) == len({frozenset(chains(t)) for _, t in rows if t})
    want = {(a, b): jaccard(sets[a], sets[b]) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= least}
    found = spotsigs.similar(spotsigs.classes(docs(spark, rows)), least).collect()
    assert len(found) == len(want) > 20
    assert {tuple(sorted((r.a_key, r.b_key))): r.likeness for r in found} == pytest.approx(want)


def test_likeness_of_empty_sets(spark):
    df = spark.sql("SELECT array() AS a, array(1) AS b")
    assert df.select(spotsigs.likeness("a", "a").alias("x"), spotsigs.likeness("a", "b").alias("y")).first() == (1.0, 0.0)
    assert isinstance(F.lit(1), type(spotsigs.shown("a")))

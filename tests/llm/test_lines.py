import re

from corpus import awkward, docs

from pulsefeed.llm import lines


def brute(rows, least):
    sites = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if line.strip(" ") and len(r) > 2 and r[2] is not None:
                sites.setdefault(line, set()).add(r[2])
    gone = {x for x, s in sites.items() if len(s) >= least}
    return sorted("\n".join(x for x in (r[1] or "").split("\n") if x not in gone) for r in rows)


def corpus_rows():
    rows = list(awkward())
    for i in range(200):
        body = [f"own line {i}", f"shared by {i % 40}", "on every site", "" if i % 3 else "  ", f"in two {i % 2}"]
        rows.append((100 + i, "\n".join(body), f"site{i % 20}" if i % 11 else None))
    return rows


def test_against_brute_force(spark):
    rows = corpus_rows()
    out = lines.without_boilerplate(docs(spark, rows), "source", 5)
    got = out.select("row.doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(r.text for r in got) == brute(rows, 5)
    assert len(got) == len(rows) and sum(r.n_removed for r in got) > 200


def test_band_and_sketch_agree_with_counts(spark):
    rows = [(i * 100 + s, f"line {i}", f"site{s}") for i in range(0, 60, 4) for s in range(i)]
    for least in (5, 20):
        assert lines.spread_lines(docs(spark, rows), "source", least, lg_k=6).count() == sum(i >= least for i in range(0, 60, 4))


def test_native_and_empty(spark):
    out = lines.without_boilerplate(docs(spark, corpus_rows()))
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
    assert lines.without_boilerplate(docs(spark, [])).collect() == []

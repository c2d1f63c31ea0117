from corpus import docs

from pulsefeed.llm.common import held_out
from pulsefeed.llm.labelled import labelled_sample


def test_repeated_ids_keep_the_bound(spark):
    ids = [r.id for r in spark.range(40).filter(~held_out("id")).collect()]
    hot = ids[3]
    rows = [(i, f"text {i}") for i in ids] + [(hot, f"other {k % 3}") for k in range(60)] + [(hot, None), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(hot, hot % 2)] * 30 + [(None, 1)], "doc_id long, toxic int")
    table = docs(spark, rows).repartition(5)
    got = labelled_sample(table, labels, "toxic", 100).collect()
    assert sorted((r.doc_id, r.label) for r in got) == [(i, i % 2) for i in ids]
    assert {r.doc_id: r.text for r in got if r.doc_id != hot} == {i: f"text {i}" for i in ids if i != hot}
    text = next(r.text for r in got if r.doc_id == hot)
    assert text in {f"text {hot}", "other 0", "other 1", "other 2"}
    again = labelled_sample(table.repartition(2), labels, "toxic", 100).collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r) for r in got)
    assert labelled_sample(table, labels, "toxic", 5).count() == 5

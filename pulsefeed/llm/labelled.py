"""The bounded sample of labelled documents that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import held_out, keep


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents outside the held-out fifth.

    The sample is the label rows of least id hash, so it is the same in every run. It is
    broadcast: ``max_rows`` bounds its size. Documents that share an id, and equal
    label rows, count once: the text of least hash is taken, a null one only if there is
    no other, so however often an id stands in the table, the sample keeps its bound
    and no document outweighs the others. Null ids and labels teach nothing.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = known.distinct().orderBy(F.xxhash64("doc_id"), "label").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Aggregated before the exchange too: an id sends one text from each task.
    least = F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text")))
    return keep(rows.groupBy("doc_id", "label").agg(least.alias("text")).select("doc_id", "text", "label"), "labelled")

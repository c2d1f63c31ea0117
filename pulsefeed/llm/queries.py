"""The operators as named queries over the whole corpus tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed.llm import collocations, conversations, decontaminate, hosts, lines, mixing, packing, quality, sharding, simhash, spotsigs, tokens, toxicity
from pulsefeed.llm.common import held_out, shared_path, table, text_or_empty

RULES = (
    hosts.Rule("allow", "org", "/"),
    hosts.Rule("block", "example.org", "/es/"),
    hosts.Rule("block", "example.org", "/en/1"),
    hosts.Rule("allow", "com", "/fr/"),
    hosts.Rule("block", "com", "/de/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in seekable zstandard files and read back."""
    docs = table(spark, sf_dir, "documents")
    return tokens.read_tokens(tokens.write_tokens(docs, shared_path(spark, "tokens"), tokenizer_path()))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and their components."""
    return simhash.simhash(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of each document."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return plan.select("row.doc_id", "size", "source_size", "target", taken)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs.select("doc_id", toxicity.scores(model, F.col("text")).alias("score")), toxicity.THRESHOLD)


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return spotsigs.edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(text_or_empty("row.text")).alias("text_crc32")
    out = sharding.assign_shards(docs)
    return out.select("row.doc_id", "size", crc, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sources."""
    out = lines.without_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("row.doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256"))


def op8_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url."""
    return hosts.judge(table(spark, sf_dir, "pages"), RULES)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that benchmark windows hit, and the items they are of."""
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct("items"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs.select("doc_id", quality.scores(model, F.col("text")).alias("score")), quality.THRESHOLD)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def _scored(df: DataFrame, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return df.select("doc_id", held_out().alias("held_out"), "score", predicted)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_token_frames, op2_simhash, op3_mixing, op4_toxicity, op5_spotsigs, op6_sharding, op7_line_spread, op8_hosts,
        op9_decontamination, op10_quality, op11_packing, op12_collocations, op13_conversation_trie, pipeline,
    )
    return {f.__name__: f for f in named}

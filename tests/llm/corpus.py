"""Small corpora for the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, shard string, row string, copies int"


def docs(spark, rows, schema=SCHEMA):
    """Documents from (doc_id, text[, source]); extra columns have names that operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, "x", "y", "z", 9) for r in rows]
    return spark.createDataFrame(full, schema)


def awkward():
    """Null and empty texts, null ids and sources, repeated rows, odd white space, a very long text."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choices(words, k=60_000))
    return [
        (1, "The cat sat on the mat and looked at a very small dog", "a"), (1, "The cat sat on the mat and looked at a very small dog", "a"),
        (2, None, None), (3, "", "a"), (4, "   \n\t ", "b"), (None, "no id here", None), (5, "one", "b"), (6, "one two", "b"),
        (7, long, "a"), (8, long + " more", "c"), (9, "Ünïcödé ẞtraße – “quoted” 中文 text\r\nnext", "c"), (10, "tab\there  two spaces", "c"),
        (11, "the of and", "c"), (12, "x" * 5000, "c"), (None, None, None),
    ]


def texts(n, seed=1, length=(5, 60), vocabulary=200):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(vocabulary)] + ["the", "of", "and"]
    return [" ".join(rng.choices(words, k=rng.randint(*length))) for _ in range(n)]

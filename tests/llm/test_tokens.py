import os
import subprocess
import sys
import zlib

import numpy as np
import pytest
import zstandard

from corpus import awkward, docs, texts
from pulsefeed.llm import tokens
from pulsefeed.llm.common import shared_path
from pulsefeed.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    odd = [r[1] or "" for r in awkward()] + [
        " ", "a ", " a", "a\n b", "a \n b", "it's don't 'll 'x", "é ́x", "a \x1cb c", "ﬁ ﬂag ⅷ x²", "a b 　 c", "<|endoftext|> x", "a<|endoftext|> b", "a <|endoftext|>b  <|endoftext|>\n<|endoftext|>", "one <|endoftext|>", "don’t 12,5 %", "naïve, über.\nDas ß",
    ] + texts(50)
    enc = tokens.Encoder(tokenizer_path())
    for _ in range(2):  # the second time from the kept pieces
        assert [x.tolist() for x in enc.encode(odd)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_pieces_are_right_when_kept_ones_go(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 150)
    monkeypatch.setattr(tokens, "CACHE_PARTS", 3, raising=False)
    enc = tokens.Encoder(tokenizer_path())
    for seed in range(12):
        some = [r[1] or "" for r in awkward()][seed % 5 :: 5] + [f"{t}, naïve{seed}x end.\n" for t in texts(20, seed, vocabulary=400)]
        assert [x.tolist() for x in enc.encode(some)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


GROWTH = """
import random, re, sys
from pulsefeed.llm import tokens
from pulsefeed.llm.queries import tokenizer_path

def mb():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

rng, enc = random.Random(3), tokens.Encoder(tokenizer_path())
enc.encode(["a text of some words"])
before = mb()
for _ in range(26):
    enc.encode([" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(30_000))])
print(mb() - before)
"""


def test_new_words_do_not_fill_the_memory():
    # 780,000 words; an executor holds two such workers or more beside its heap.
    got = subprocess.run([sys.executable, "-c", GROWTH], env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)}, capture_output=True, text=True, check=True)
    assert float(got.stdout) < 100


def brute(rows, tokenizer):
    start, out = 0, []
    for doc_id, ids in rows:
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, tokenizer):
    rows = awkward() + [(100 - i, t) for i, t in enumerate(texts(60))]
    path = shared_path(spark, "tokens")
    index = tokens.write_tokens(docs(spark, rows), path, tokenizer_path(), file_bytes=20_000)
    got = [tuple(r) for r in tokens.read_tokens(index).collect()]
    assert index.count() > 2
    got.sort(key=lambda r: r[1])
    assert [r[0] or -1 for r in got] == sorted(r[0] or -1 for r in rows)
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0])
    seen = 0
    for doc_id, start, n, crc in got:
        assert start == seen
        assert (n, crc) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[doc_id]]
        seen += n


def test_one_document_is_read_alone_and_checked(spark):
    index = tokens.write_tokens(docs(spark, [(i, f"text {i}") for i in range(20)]), shared_path(spark, "tokens"), tokenizer_path())
    uri = index.first().file
    file = tokens.TokenFile(uri)
    doc_id, ids = file.document(len(file) - 1)
    assert ids[-1] == 0 and doc_id is not None
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    # Any zstandard tool reads the file whole and passes over the table.
    assert zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read()
    file.entries = file.entries.copy()
    file.entries[0, 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        file.document(0)


def test_reading_by_id_decompresses_nothing_else(spark, tokenizer):
    rows = [(i, f"text {i} and more") for i in range(60)] + [(7, "another seven"), (None, "no id")]
    index = tokens.write_tokens(docs(spark, rows), shared_path(spark, "tokens"), tokenizer_path(), file_bytes=400)
    assert index.count() > 3
    got = sorted((r.doc_id, list(r.ids)) for r in tokens.read_documents(index, [7, 31, 999]).collect())
    want = sorted((i, tokenizer.encode(t, add_special_tokens=False).ids + [0]) for i, t in rows if i in (7, 31))
    assert got == want and len(got) == 3
    for r in index.collect():
        file = tokens.TokenFile(r.file)
        hits = [k for k in range(len(file)) if file.document(k)[0] in (7, 31)]
        file.decompressed = 0
        assert file.frames_of([7, 31, 999]) == hits and file.decompressed == 0
        assert (r.first_id, r.last_id) == tuple(None if x == tokens.NULL_ID else x for x in (file.document(0)[0], file.document(len(file) - 1)[0]))


def test_repeated_rows_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(5, "the same row")] * 3000 + [(i, f"text {i}") for i in range(6000)]
    index = tokens.write_tokens(docs(spark, rows).repartition(8), shared_path(spark, "tokens"), tokenizer_path())
    parts = [r.n_docs for r in index.groupBy("part").agg({"n_docs": "sum"}).withColumnRenamed("sum(n_docs)", "n_docs").collect()]
    assert sum(parts) == 9000 and max(parts) < 9000 / len(parts) * 1.6 and len(parts) >= 4
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_files_share_tasks(spark):
    index = tokens.write_tokens(docs(spark, [(i, f"text {i} and more") for i in range(300)]), shared_path(spark, "tokens"), tokenizer_path(), file_bytes=400)
    assert index.count() > 20 and len(index.inputFiles()) == 1
    read = tokens.read_tokens(index)
    assert read.rdd.getNumPartitions() == 1 and sorted(r.doc_id for r in read.collect()) == list(range(300))


def test_empty_table(spark):
    index = tokens.write_tokens(docs(spark, []), shared_path(spark, "tokens"), tokenizer_path())
    assert tokens.read_tokens(index).collect() == []

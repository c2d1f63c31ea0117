"""Token ids in independent zstandard frames.

A file is a sequence of zstandard frames, one per document in ascending id order:
eight bytes of document id, then the token ids as little-endian unsigned 32-bit
integers, the last one the end id. A skippable frame with all document ids
follows. Another closes the file with the seek table of the public zstd seekable
format: compressed size, decompressed size and checksum (low 32 bits of the XXH64
of the content) of every document's frame, then the number of frames, a descriptor
and a magic number. So a reader takes the tables from the end, finds the frames of
the documents it wants, decompresses no others, and checks each of them; any
zstandard tool can read the file whole.

Files are written by tasks to names of their own and count only if the index,
written by Spark from the rows of the tasks that succeeded, lists them: a retried
or doubled task leaves an unlisted file, never a wrong one. The index has the first
and last id of each file.

Null and empty texts have the end id alone. Null document ids come first and are
kept in the frame as the smallest long. Rows with equal ids are frames of their
own, in the order of the hash of their text; repeated rows have a tie number as
well, so any number of them is spread over tasks. A text that holds the spelling
of a special token has that token's id there. An empty table gives no files.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import keep, longs, text_or_empty

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
IDS_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER = 9
ENTRY = 12

END_ID = 0
LEVEL = 1
FILE_BYTES = 128 << 20
READ_TOKENS = 4 << 20
NULL_ID = -(1 << 63)
INDEX = ("file", "part", "number", "n_docs", "n_tokens", "first_id", "last_id")
BATCH_BYTES = 4 << 20
CACHE_PIECES = 400_000
CACHE_PARTS = 20_000
# A space is a safe cut if no white space or control character is on either side of it.
_UNSAFE = re.compile(r" (?:(?![\x21-\x7e\w])|(?<![\x21-\x7e\w] ))")
# Letters after a space are one pre-token with it, whatever follows that is no letter.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^\t\n\x20-\x40\x5b-\x60\x7b-\x7e])")


class Encoder:
    """Token ids of texts; a task's words recur, so their ids are kept.

    The vocabulary's pre-tokenizer never joins what a single space between
    printing characters separates. Texts are cut there, equal pieces are encoded
    once, and the ids are put together by position. Other texts go whole.

    Kept pieces are a column of text beside one of ids, smaller than as many Python
    objects, for an executor holds as many encoders as it has started workers.
    When they are too many, those of the last texts stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Ids of ``known[k]``, with a space before it: ``ids[bounds[k]:bounds[k + 1]]``.
        self.known = pa.array([], pa.large_string())
        self.ids, self.bounds = np.array([], "<u4"), np.zeros(1, np.int64)
        self.parts: dict[str, np.ndarray] = {}
        byte_level = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in byte_level]
        self.letters = {b: chr(b) for b in byte_level} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def part(self, text: str) -> np.ndarray:
        """Ids of what recurs much: first words, punctuation after a word."""
        ids = self.parts.get(text)
        if ids is None:
            if len(self.parts) >= CACHE_PARTS:
                self.parts.clear()
            ids = self.parts[text] = self.whole(text)
        return ids

    def add(self, pieces: list[str]) -> None:
        """Encodes and keeps pieces: a leading word goes to the model directly, what follows is encoded apart."""
        ids, ends, tokenize = array("I"), array("q"), self.tokenizer.model.tokenize
        space = self.letters[32]
        for piece in pieces:
            leading = _LETTERS.match(piece)
            if leading:
                word = leading[0]
                spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                ids.extend([t.id for t in tokenize(space + spelled)])
                if len(word) < len(piece):
                    ids.extend(self.part(piece[len(word) :]).tolist())
            else:
                ids.extend(self.whole(" " + piece).tolist())
            ends.append(len(ids))
        self.known = pa.concat_arrays([self.known, pa.array(pieces, pa.large_string())])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.array(ends, np.int64)])
        self.ids = np.concatenate([self.ids, np.array(ids, "<u4")])

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the kept pieces ``at``, in a row, and how many each has."""
        starts = self.bounds[at]
        sizes = self.bounds[at + 1] - starts
        ends = np.cumsum(sizes)
        return self.ids[np.arange(sizes.sum()) + np.repeat(starts - (ends - sizes), sizes)], sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        cut = []
        for i, text in enumerate(texts):
            if not text or _UNSAFE.search(text):
                out[i] = self.whole(text)
            else:
                cut.append(i)
        if not cut:
            return out
        split = pc.split_pattern(pa.array([texts[i] for i in cut], pa.large_string()), " ")
        coded, offsets = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        pieces, codes = coded.dictionary, coded.indices.to_numpy()
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        at[new] = np.arange(len(new)) + len(self.known)
        self.add(pieces.take(pa.array(new)).to_pylist())
        for k, i in enumerate(cut):
            a, b = int(offsets[k]), int(offsets[k + 1])
            # A text's first piece has no space before it.
            out[i] = np.concatenate([self.part(pieces[codes[a]].as_py()), self.gather(at[codes[a + 1 : b]])[0]])
        if len(self.known) > CACHE_PIECES:
            self.ids, sizes = self.gather(at)
            self.known, self.bounds = pieces, np.concatenate([[0], np.cumsum(sizes)])
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, so its pieces serve all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def frame(doc_id: int | None, ids: np.ndarray, compress: zstandard.ZstdCompressor) -> tuple[bytes, bytes]:
    """A document's frame and its entry in the seek table."""
    content = struct.pack("<q", NULL_ID if doc_id is None else doc_id) + ids.tobytes()
    data = compress.compress(content)
    return data, struct.pack("<III", len(data), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)


def closing(doc_ids: list[int | None], entries: list[bytes]) -> bytes:
    """The frames that close a file: the ids of its documents, and the seek table."""
    ids = np.array([NULL_ID if x is None else x for x in doc_ids], "<i8").tobytes()
    body = b"".join(entries) + struct.pack("<IBI", len(entries), CHECKSUM_FLAG, SEEK_MAGIC)
    return struct.pack("<II", IDS_MAGIC, len(ids)) + ids + struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class TokenFile:
    """Reads single documents of one file."""

    decompressed = 0

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(FOOTER, size - FOOTER))
        if magic != SEEK_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{uri} does not end with a seek table with checksums")
        table_at = size - FOOTER - n * ENTRY
        table = self.file.read_at(n * ENTRY, table_at)
        # Before the table stands its header, before that the ids.
        self.ids_at = table_at - 8 - 8 * n
        self.entries = np.frombuffer(table, "<u4").reshape(-1, 3)
        self.starts = np.cumsum(self.entries[:, 0], dtype=np.int64) - self.entries[:, 0]

    def __len__(self) -> int:
        return len(self.entries)

    def frames_of(self, doc_ids: list[int]) -> list[int]:
        """The frames of documents with these ids; only the table of ids is read."""
        ids = np.frombuffer(self.file.read_at(8 * len(self), self.ids_at), "<i8")
        wanted = np.unique(np.array(doc_ids, np.int64))
        first, after = np.searchsorted(ids, wanted), np.searchsorted(ids, wanted, "right")
        return [k for a, b in zip(first.tolist(), after.tolist()) for k in range(a, b)]

    def document(self, k: int) -> tuple[int, np.ndarray]:
        """(doc_id, ids) of frame ``k``, decompressed alone; a frame that fails its checksum is an error."""
        self.decompressed += 1
        size, full, checksum = (int(x) for x in self.entries[k])
        content = zstandard.ZstdDecompressor().decompress(self.file.read_at(size, int(self.starts[k])), max_output_size=full)
        if len(content) != full or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} does not match its checksum")
        return struct.unpack_from("<q", content)[0], np.frombuffer(content, "<u4", offset=8)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode the documents into files under ``path``; the index, one row per file.

    It has (file, part, number, n_docs, n_tokens, first_id, last_id). Documents are
    range-partitioned by id once, and encoded where they arrive.
    """
    rows = docs.select("doc_id", text_or_empty("text").alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    rows = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(path)
        encode = encoder(tokenizer)
        compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        end = np.array([end_id], "<u4")
        out, entries, doc_ids, made, part, tokens, number = None, [], [], [], 0, 0, 0

        def close() -> None:
            nonlocal out, entries, doc_ids, tokens, number
            out.write(closing(doc_ids, entries))
            out.close()
            made.append((name, part, number, len(entries), tokens, doc_ids[0], doc_ids[-1]))
            out, entries, doc_ids, tokens, number = None, [], [], 0, number + 1

        for batch in batches:
            part = batch["part"][0].as_py() if batch.num_rows else part
            at = 0
            while at < batch.num_rows:
                size = np.cumsum(pc.binary_length(batch["text"].slice(at)).to_numpy(zero_copy_only=False))
                n = max(1, int(np.searchsorted(size, BATCH_BYTES, "right")))
                ids = encode.encode(batch["text"].slice(at, n).to_pylist())
                for doc_id, got in zip(batch["doc_id"].slice(at, n).to_pylist(), ids):
                    if out is None:
                        name = f"{path}/part-{part:05d}-{number:03d}-{uuid.uuid4().hex}.tokens.zst"
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(f"{base}/{name.rsplit('/', 1)[1]}", compression=None)
                    data, entry = frame(doc_id, np.concatenate([got, end]), compress)
                    out.write(data)
                    entries.append(entry)
                    doc_ids.append(doc_id)
                    tokens += len(got) + 1
                    if out.tell() >= file_bytes:
                        close()
                at += n
        if out is not None:
            close()
        if made:
            schema = pa.schema([("file", pa.string())] + [(c, pa.int64()) for c in INDEX[1:]])
            yield pa.RecordBatch.from_pydict(dict(zip(INDEX, map(list, zip(*made)))), schema=schema)

    # The index has few rows, however many tasks wrote files: it is one file, not one for each of them.
    return keep(rows.mapInArrow(write, "file string, " + ", ".join(f"{c} long" for c in INDEX[1:])).repartition(1), "token-index")


def read_documents(index: DataFrame, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents asked for: files without any of them are not opened, other documents not decompressed."""
    wanted = sorted(set(doc_ids))
    inside = F.exists(longs(wanted), lambda x: (x >= F.coalesce("first_id", F.lit(NULL_ID))) & (x <= F.coalesce("last_id", F.lit(NULL_ID))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["file"].to_pylist():
                file = TokenFile(uri)
                found = [file.document(k) for k in file.frames_of(wanted)]
                ids = pa.array([x.tolist() for _, x in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), ids], ["doc_id", "ids"])

    return index.filter(inside).select("file").mapInArrow(read, "doc_id long, ids array<long>")


def read_tokens(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; ``start`` counts the ids of all before it.

    The index has a row per file, so its running sum is small; files are read
    frame by frame, as many in a task as have about ``READ_TOKENS`` ids.
    """
    files = index.orderBy("part", "number").select("file", "n_tokens").collect()
    start, rows = 0, []
    for f in files:
        rows.append((f.file, start))
        start += f.n_tokens
    spark = index.sparkSession
    listed = spark.createDataFrame(rows, "file string, start long").repartition(max(1, min(len(rows), -(-start // READ_TOKENS))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, at in zip(batch["file"].to_pylist(), batch["start"].to_pylist()):
                file = TokenFile(uri)
                out = []
                for k in range(len(file)):
                    doc_id, ids = file.document(k)
                    out.append((None if doc_id == NULL_ID else doc_id, at, len(ids), zlib.crc32(ids)))
                    at += len(ids)
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), map(list, zip(*out)))),
                    schema=pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]),
                )

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

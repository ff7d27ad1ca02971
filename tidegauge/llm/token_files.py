"""Token ids in files: one zstandard frame per document, a dictionary shared by all, an index of offsets.

A file holds a range of ascending ids. Layout, little endian:

    magic ``TGTOK001``, sha256 of the dictionary, bytes per id (uint32)
    frames, one per document, each the ids of the document compressed with the dictionary
    index: doc ids (int64), known ids (uint8), ids per document (uint32), frame offsets (uint64, one more)
    number of documents (uint64), offset of the index (uint64)

One document is read with the index and one frame. The dictionary lies beside the files and is
checked by its hash. It is trained on a bounded sample, ``TRAIN_DOCS`` documents by hash of the id and
``TRAIN_CHARS`` characters of each; it only affects size, never content.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.files import opened, write_file
from tidegauge.llm.kernel import pieces, slices
from tidegauge.llm.store import bounded
from tidegauge.llm.tokens import encoder_of
from tidegauge.scratch import fresh_folder

MAGIC = b"TGTOK001"
_HEAD = "<8s32sI"
TRAIN_DOCS = 1000
TRAIN_CHARS = 4096
DICTIONARY_BYTES = 65_536
LEVEL = 3
END_ID = 2


def trained_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary for serialised id arrays; empty if there is too little to learn from."""
    sample = docs.select("doc_id", F.substring("text", 1, TRAIN_CHARS).alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    encoder = encoder_of(tokenizer)
    samples = []
    for texts in slices(sample.toArrow()["text"].combine_chunks()):
        ids, counts = encoder.encode(texts)
        samples += [x.astype("<u2" if len(encoder.closes) <= 1 << 16 else "<u4").tobytes() for x in np.split(ids, np.cumsum(counts)[:-1]) if len(x)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _writer(folder: str, tokenizer: str, end_id: int, dictionary: bytes):
    def run(batches):
        shard = TaskContext.get().partitionId()
        encoder = encoder_of(tokenizer)
        width = 2 if max(len(encoder.closes) - 1, end_id) < 1 << 16 else 4
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        doc_ids, known, counts, sizes = [], [], [], []

        def frames():
            for batch in pieces(batches, 1):
                known.append(np.asarray(batch.column(0).is_valid()).astype(np.uint8))
                doc_ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                for texts in slices(batch.column(1)):
                    ids, n = encoder.encode(texts)
                    counts.append((n + 1).astype("<u4"))
                    start = 0
                    for end in np.cumsum(n).tolist():
                        frame = packer.compress(np.append(ids[start:end], np.uint32(end_id)).astype(f"<u{width}").tobytes())
                        sizes.append(len(frame))
                        yield frame
                        start = end

        def parts(first):
            head = struct.pack(_HEAD, MAGIC, hashlib.sha256(dictionary).digest(), width)
            yield head
            yield first
            yield from packed
            offsets = (len(head) + np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))).astype("<u8")
            for column in (*doc_ids, *known, *counts, offsets):
                yield column.tobytes()
            yield struct.pack("<QQ", len(sizes), int(offsets[-1]))

        packed = frames()
        first = next(packed, None)
        if first is not None:
            uri = f"{folder}/ids-{shard:06d}.tok"
            write_file(uri, parts(first))
            yield pa.RecordBatch.from_pylist([{"shard": shard, "uri": uri, "docs": len(sizes), "ids": sum(int(c.sum(dtype=np.int64)) for c in counts)}])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order; the files' ``shard``, ``uri``, ``docs``, ``ids``.

    Null texts are empty and have the end id alone; rows without an id come last; rows that share an
    id stay apart, in any order. Other columns are not read. An empty table gives no file. A file is
    written under another name first, so a task that is run again replaces whole files.
    """
    dictionary = trained_dictionary(docs, tokenizer)
    write_file(f"{folder}/dictionary", [dictionary])
    order = F.col("doc_id").asc_nulls_last()
    rows = bounded(docs.select(F.col("doc_id").cast("long"), "text")).repartitionByRange(order).sortWithinPartitions(order)
    made = rows.mapInArrow(_writer(folder, tokenizer, end_id, dictionary), "shard long, uri string, docs long, ids long").toArrow()
    return docs.sparkSession.createDataFrame(made)


class TokenFile:
    """One file, its documents read singly."""

    def __init__(self, uri: str, dictionary: bytes) -> None:
        store, path = opened(uri)
        self.source = store.open_input_file(path)
        size = self.source.size()
        magic, digest, self.width = struct.unpack(_HEAD, self.source.read_at(struct.calcsize(_HEAD), 0))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no file of token ids")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        n, at = struct.unpack("<QQ", self.source.read_at(16, size - 16))
        index = self.source.read_at(size - 16 - at, at)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.known = np.frombuffer(index, np.uint8, n, 8 * n).astype(bool)
        self.counts = np.frombuffer(index, "<u4", n, 9 * n)
        self.offsets = np.frombuffer(index, "<u8", n + 1, 13 * n)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, place: int) -> np.ndarray:
        """Token ids of the document at this place, as uint32."""
        a, b = int(self.offsets[place]), int(self.offsets[place + 1])
        return np.frombuffer(self.unpacker.decompress(self.source.read_at(b - a, a)), f"<u{self.width}").astype("<u4")


def read_dictionary(folder: str) -> bytes:
    store, path = opened(f"{folder}/dictionary")
    with store.open_input_file(path) as source:
        return source.read()


def _reader(folder: str):
    def run(batches):
        dictionary = read_dictionary(folder)
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["uri"], dictionary)
                start = row["start"]
                for low in range(0, len(file), 5000):
                    places = range(low, min(low + 5000, len(file)))
                    crcs = []
                    for i in places:
                        ids = file.ids(i)
                        if len(ids) != file.counts[i]:
                            raise ValueError(f"{row['uri']}: document {i} has {len(ids)} ids, its index says {file.counts[i]}")
                        crcs.append(zlib.crc32(ids.tobytes()))
                    counts = file.counts[low : places.stop].astype(np.int64)
                    starts = start + np.cumsum(counts) - counts
                    start += int(counts.sum())
                    ids = pa.array(file.doc_ids[low : places.stop], mask=~file.known[low : places.stop])
                    yield pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(counts), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, read back from the files."""
    shards = sorted(files.toLocalIterator(), key=lambda r: r["shard"])
    starts = np.concatenate(([0], np.cumsum([r["ids"] for r in shards], dtype=np.int64))).tolist()
    rows = [(r["shard"], r["uri"], s) for r, s in zip(shards, starts, strict=False)]
    listed = files.sparkSession.createDataFrame(rows, "shard long, uri string, start long").repartition(max(1, len(rows)))
    return listed.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files into a new folder of the session's shared folder and read them back."""
    folder = fresh_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, folder, end_id), folder)



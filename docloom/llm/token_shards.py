"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed stride.

Texts become token ids of a public byte-level vocabulary (16 bits each, a document mark behind every text), cut
into sequences of ``LENGTH`` tokens. A keyed Feistel network permutes the numbers 0..N-1 of all sequences: it works
on the next even power of two and walks on from results outside 0..N-1 until one is inside, so every
sequence gets its own slot, computed from its number and the key alone. Slot ranges go to one task each, which writes
a file for every ``SHARD`` slots: slot s lies in shard ``s // SHARD`` at byte ``(s % SHARD) * stride``, so a
reader seeks to any slot and resumes anywhere. A record is doc_id (8 bytes), sequence in its document (4), tokens
(4), the ids padded with the document mark, and a line feed; numbers are little-endian.

Texts are tokenised twice, first to count: numbers need the total, and storing all ids in between would cost
more disk than the second pass costs time. Texts are cut before spaces in numpy, and only words that a task does not
remember are encoded; words are told apart by a 64-bit hash and their length.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.llm.wordhash import mix, span_hashes, text_blocks
from docloom.staging import scratch_path

TOKENIZERS = "/opt/tokenizers"
VOCABULARY, END = "byte_bpe_50k.tiktoken", 50256
# Fixed value: the split pattern the vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTH, SHARD, ROUNDS, KEY = 512, 4096, 6, 2026
HEAD = 16
CACHE, SLOTS = 500_000, 1 << 20  # words a task remembers, and places to find them
TASK_SHARDS = 64  # shards that one task writes at most
NO_ID = -(1 << 63)

_AS_IS = np.arange(256, dtype=np.uint8)
_SOLID = (_AS_IS > 32) & (_AS_IS < 128)
# First bytes of characters that are never white space (white space beyond ASCII begins with one of the four).
_WORD = (_AS_IS > 32) & ~np.isin(_AS_IS, [0xC2, 0xE1, 0xE2, 0xE3])


class _Encoder:
    """Token ids of whole text columns, for the vocabulary in ``folder``."""

    def __init__(self, folder: str):
        import tiktoken

        with open(os.path.join(folder, VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("docloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.token_bytes = np.zeros(1 << 16, np.int64)
        self.token_bytes[list(ranks.values())] = [len(token) for token in ranks]
        self.forget()

    def forget(self) -> None:
        """Word 0 is the document mark; ``at`` is the word that a hash slot holds."""
        self.at = np.zeros(SLOTS, np.int64)
        self.hash, self.bytes = np.zeros(1, np.uint64), np.full(1, -1, np.int64)
        self.start, self.size, self.ids = np.zeros(1, np.int64), np.ones(1, np.int64), np.array([END], "<u2")

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of every word; those not remembered are encoded, each once."""
        if len(self.hash) > CACHE or len(self.ids) > 8 * CACHE:
            self.forget()
        hashes, sizes = span_hashes(data, starts, ends, _AS_IS), ends - starts
        slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        out = self.at[slots]
        new = np.flatnonzero((self.hash[out] != hashes) | (self.bytes[out] != sizes))
        if len(new):
            _, first, code = np.unique(hashes[new], return_index=True, return_inverse=True)
            # Words behind a space and before a character come first, in one piece.
            one = new[first]
            joins = (sizes[one] > 1) & (data[starts[one]] == 32) & _WORD[data[np.minimum(starts[one] + 1, len(data) - 1)]]
            order = np.argsort(~joins, kind="stable")
            one, code = one[order], np.argsort(order)[code]
            ids, size = self.encoded(data, starts[one], ends[one], np.count_nonzero(joins))
            base = len(self.hash)
            self.start = np.append(self.start, len(self.ids) + np.cumsum(size) - size)
            self.ids = np.append(self.ids, ids)
            self.hash, self.bytes, self.size = np.append(self.hash, hashes[one]), np.append(self.bytes, sizes[one]), np.append(self.size, size)
            self.at[slots[one]] = np.arange(base, len(self.hash))
            out[new] = base + code
        return out

    def encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, joined: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given words in order, and how many each has.

        No token reaches over a space with a character behind it, so the first ``joined`` words are encoded in one
        call and told apart by the bytes of their tokens.
        """
        lengths = (ends - starts)[:joined]
        upto = np.cumsum(lengths)
        text = data[np.repeat(starts[:joined] - upto + lengths, lengths) + np.arange(upto[-1] if joined else 0)]
        parts = [np.array(self.encode(text.tobytes().decode()), "<u2")]
        size = np.diff(np.searchsorted(np.cumsum(self.token_bytes[parts[0]]), upto) + 1, prepend=0)
        parts += [np.array(self.encode(data[a:b].tobytes().decode()), "<u2") for a, b in zip(starts[joined:].tolist(), ends[joined:].tolist(), strict=True)]
        return np.concatenate(parts), np.append(size, [len(p) for p in parts[1:]]).astype(np.int64)

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, words with a mark behind every text that is not empty, first word of each text and one more)."""
        for row, data, offsets in text_blocks(texts):
            begins = np.zeros(len(data) + 1, dtype=bool)
            # No token of the pattern reaches over such a space: white space is on one side of it at most.
            before_word = np.append(_WORD[data[1:]], False)
            before_word[offsets[(offsets > 0) & (offsets < len(data))] - 1] = False  # the next text is no neighbour
            begins[1:-1] = (data[1:] == 32) & (_SOLID[data[:-1]] | before_word[1:])
            begins[offsets] = True
            starts = np.flatnonzero(begins[:-1])
            words = self.words(data, starts, np.append(starts[1:], len(data)))
            first = np.searchsorted(starts, offsets)
            filled = np.diff(offsets) > 0
            yield row, np.insert(words, first[1:][filled], 0), first + np.concatenate([[0], np.cumsum(filled)])

    def flat(self, words: np.ndarray) -> np.ndarray:
        """The ids of all ``words`` in order."""
        size = self.size[words]
        ends = np.cumsum(size)
        return self.ids[np.repeat(self.start[words] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]

    def ends(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Ids before every text of a block, and before its end."""
        return np.concatenate([[0], np.cumsum(self.size[words])])[first]


def feistel(numbers: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """Slots of ``numbers`` under a keyed permutation of 0..total-1."""
    half = np.uint64(max(1, -(-max(1, total - 1).bit_length() // 2)))
    last = (np.uint64(1) << half) - np.uint64(1)
    out = numbers.astype(np.uint64)
    outside = np.arange(len(out))
    while len(outside):
        x = out[outside]
        left, right = x >> half, x & last
        for step in range(ROUNDS):
            salt = np.uint64((key * ROUNDS + step) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            left, right = right, left ^ (mix(right ^ salt) & last)
        out[outside] = left << half | right
        outside = outside[out[outside] >= total]
    return out.astype(np.int64)


def _count_tasks(folder: str, length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = _Encoder(folder), 0
        for batch in batches:
            for _, words, first in encoder.blocks(batch.column(1)):
                found += int((-(-np.diff(encoder.ends(words, first)) // length)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([found])], ["part", "sequences"])

    return count


def _sequence_tasks(folder: str, length: int, firsts: Broadcast, total: int, key: int):
    """``firsts``: sequences before every task of the scan, and before its end. A NULL doc_id is ``NO_ID``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _Encoder(folder)
        number, stop = int(firsts.value[part]), int(firsts.value[part + 1])
        pack, rows = zstandard.ZstdCompressor(level=1), []

        def flush() -> pa.RecordBatch:
            slots = feistel(np.arange(number - len(rows), number), total, key)
            return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(rows, pa.binary())], ["slot", "record"])

        for batch in batches:
            docs = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for row, words, first in encoder.blocks(batch.column(1)):
                ids, ends = encoder.flat(words).tobytes(), encoder.ends(words, first).tolist()
                for doc, a, b in zip(docs[row:row + len(first) - 1], ends, ends[1:], strict=False):
                    name = np.array([doc], "<i8").tobytes()
                    for k, at in enumerate(range(a, b, length)):
                        n = min(length, b - at)
                        rows.append(pack.compress(name + np.array([k, n], "<i4").tobytes() + ids[2 * at:2 * (at + n)]))
                        number += 1
                        if len(rows) == 2000:
                            yield flush()
                            rows = []
        if rows:
            yield flush()
        if number != stop:
            raise ValueError(f"part {part} has other rows than when it was counted; write the documents to a table first")

    return emit


def _pad_tasks(length: int):
    def pad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, filler = zstandard.ZstdDecompressor(), np.full(length, END, "<u2").tobytes()
        for batch in batches:
            out = []
            for record in batch.column(0):
                record = unpack.decompress(record.as_py())
                out.append(record + filler[:HEAD + 2 * length - len(record)])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return pad


def write_shards(docs: DataFrame, path: str, folder: str = TOKENIZERS, length: int = LENGTH, key: int = KEY) -> int:
    """Write all sequences of ``docs`` (doc_id, text) under ``path``; returns their number.

    ``docs`` must scan stored files: both passes rely on equal tasks, and a difference is an error. NULL and
    empty texts have no sequence; NULL doc_ids are stored as the least 64-bit number; repeated rows are written
    as often as they come; other columns are ignored. An empty table writes an empty folder.
    """
    docs, context = docs.select(F.col("doc_id").cast("long"), "text"), docs.sparkSession.sparkContext
    # One row per task of the scan, of which the driver keeps a list anyway.
    counted = docs.mapInArrow(_count_tasks(folder, length), "part long, sequences long").toArrow().sort_by("part")
    sizes = np.zeros(counted["part"][-1].as_py() + 1 if len(counted) else 0, np.int64)
    sizes[counted["part"].to_numpy()] = counted["sequences"].to_numpy()
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    total = int(firsts[-1])
    sequences = docs.mapInArrow(_sequence_tasks(folder, length, context.broadcast(firsts), max(1, total), key), "slot long, record binary")
    shards = max(1, -(-total // SHARD))
    each = max(1, min(TASK_SHARDS, shards // (4 * context.defaultParallelism)))
    dealt = sequences.repartitionById(-(-shards // each), F.expr(f"CAST(slot DIV {SHARD * each} AS INT)")).sortWithinPartitions("slot")
    records = dealt.select("record").mapInArrow(_pad_tasks(length), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "none").option("maxRecordsPerFile", SHARD).text(path)
    return total


_RECORDS = "slot long, shard long, byte_offset long, doc_id long, sequence long, n_tokens long, crc long"


def _records(raw: bytes, shard: int, skipped: int, length: int) -> pa.RecordBatch:
    """The records in ``raw``, which begins ``skipped`` records into ``shard``."""
    stride = HEAD + 2 * length + 1
    count = len(raw) // stride
    rows = np.frombuffer(raw, np.uint8)[:count * stride].reshape(count, stride)
    docs = np.ascontiguousarray(rows[:, :8]).view("<i8").ravel()
    head = np.ascontiguousarray(rows[:, 8:16]).view("<i4")
    at = np.arange(skipped, skipped + count, dtype=np.int64)
    crc = [zlib.crc32(raw[i * stride + HEAD:i * stride + HEAD + 2 * int(head[i, 1])]) for i in range(count)]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard * SHARD + at), pa.array(np.full(count, shard, np.int64)), pa.array(at * stride), pa.array(docs, mask=docs == NO_ID),
         pa.array(head[:, 0].astype(np.int64)), pa.array(head[:, 1].astype(np.int64)), pa.array(crc, pa.int64())],
        ["slot", "shard", "byte_offset", "doc_id", "sequence", "n_tokens", "crc"])


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, shard) of every shard file under ``path``; file contents are not read."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0).select("path")
    place = files.select("path", *[F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)\.txt$", i).cast("long").alias(c) for i, c in ((1, "task"), (2, "file"))])
    # Every task but the last writes the same number of shards, and the first one is never behind.
    each = (place.agg(F.max("file")).first()[0] or 0) + 1
    return place.select("path", (F.col("task") * each + F.col("file")).alias("shard"))


def read_shards(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """slot, shard, byte_offset, doc_id, sequence, n_tokens, crc of the ids, read back from the shard files."""
    return read_slots(spark, path, 0, None, length)


def read_slots(spark: SparkSession, path: str, first: int, count: int | None, length: int = LENGTH) -> DataFrame:
    """The records of ``count`` slots (None: all) from slot ``first`` on, like ``read_shards``.

    Only shards of the range are opened, and each is read from the first wanted byte to the last. Slots that
    do not exist give no rows.
    """
    stride = HEAD + 2 * length + 1
    stop = None if count is None else first + count

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                skipped = max(0, first - shard * SHARD)
                wanted = SHARD if stop is None else min(SHARD, stop - shard * SHARD)
                uri = "file://" + name.removeprefix("file:") if name.startswith("file:/") and not name.startswith("file://") else name
                files, place = pafs.FileSystem.from_uri(uri)
                with files.open_input_file(place) as shard_file:
                    shard_file.seek(skipped * stride)
                    yield _records(shard_file.read((wanted - skipped) * stride), shard, skipped, length)

    shard = F.col("shard")
    wanted = shard_files(spark, path).filter((shard >= first // SHARD) & (F.lit(True) if stop is None else shard * SHARD < stop))
    return wanted.mapInArrow(records, _RECORDS)


@query()
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_shards(spark, path)

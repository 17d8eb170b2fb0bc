"""Token-id files with Elias-Fano document boundaries.

Texts are range-partitioned by id and encoded in ascending order; each
partition writes shard files of whole documents to a folder all executors
share. A shard (all numbers little-endian):

    8 bytes   magic "EFTOKID2"
    6 x u64   documents n, ids u, bytes per id (2 or 4), and of the ends: low bits l, upper bits, select samples
    2 x i64   documents without a document id (they come first), smallest document id
    3 x u64   of the document ids: low bits, upper bits, select samples
    lower     n values of l bits: low parts of the documents' ends
    upper     unary coded high parts: a one for each document, a zero for each step
    samples   u32 bit position of every 512th one: select starts there
    lower, upper, samples of the document ids, less the smallest
    ids       all ids of all documents, one after the other

Document i ends at ((select1(i) - i) << l) | lower[i]; it starts where the one
before ends. The code takes 2 + log2(u / n) bits a document against 64 of an
offset table, and document ids, which ascend, are coded alike. A file is
written under a name of its own and then renamed, so a task that is run again
leaves one whole copy.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import free_memory, materialize, small_side
from rankforge.llm.encode import encoder

MAGIC = b"EFTOKID2"
SAMPLE = 512
#: A shard is closed once it holds so many ids (a longer document has a shard of its own).
SHARD_IDS = 4 << 20
END_ID = 0
#: Values packed at a time (a multiple of 8: whole bytes).
_PACK = 8192


class EliasFano:
    """A non-decreasing list of ``n`` numbers up to ``u`` in n * (2 + log2(u / n)) bits, with select."""

    def __init__(self, n: int, low_bits: int, lower: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.lower, self.upper, self.samples = n, low_bits, lower, upper, samples

    @classmethod
    def of(cls, values: np.ndarray, u: int) -> EliasFano:
        n = len(values)
        low = max(0, int(np.log2(u / n))) if n and u > n else 0
        values = values.astype(np.uint64)
        place = np.arange(low, dtype=np.uint64)
        lower = [np.packbits((values[a: a + _PACK, None] >> place & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") for a in range(0, n, _PACK)]
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, low, np.concatenate([np.zeros(0, np.uint8), *lower]), np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Bit position of the i-th one, from the sample at or before it."""
        at, seen = int(self.samples[i // SAMPLE]), i // SAMPLE * SAMPLE
        byte = at // 8
        skip = np.bitwise_count(self.upper[byte: byte + 1] & np.uint8((1 << at % 8) - 1))[0]
        want = i - seen + int(skip)
        while True:
            chunk = np.bitwise_count(self.upper[byte: byte + 256])
            run = np.cumsum(chunk)
            if run[-1] > want:
                k = int(np.searchsorted(run, want, side="right"))
                want -= int(run[k - 1]) if k else 0
                return (byte + k) * 8 + int(np.flatnonzero(self.upper[byte + k] >> np.arange(8) & 1)[want])
            want -= int(run[-1])
            byte += 256

    def __getitem__(self, i: int) -> int:
        bits = np.arange(i * self.low_bits, (i + 1) * self.low_bits)
        low = int.from_bytes(np.packbits(self.lower[bits >> 3] >> (bits & 7).astype(np.uint8) & 1, bitorder="little").tobytes(), "little")
        return (self.select(i) - i) << self.low_bits | low

    def blocks(self) -> Iterator[int]:
        """Every number in order, ``SAMPLE`` at a time: each block is found by its select sample and decoded alone."""
        place = np.arange(self.low_bits, dtype=np.uint64)
        for k, first in enumerate(self.samples.tolist()):
            a, e = k * SAMPLE, min(self.n, (k + 1) * SAMPLE)
            stop = int(self.samples[k + 1]) if k + 1 < len(self.samples) else 8 * len(self.upper)
            bits = np.unpackbits(self.upper[first // 8: stop // 8 + 1], bitorder="little")[first % 8:]
            high = np.flatnonzero(bits)[: e - a] + first - np.arange(a, e)
            low = np.unpackbits(self.lower[a * self.low_bits // 8: (e * self.low_bits + 7) // 8], bitorder="little")[: (e - a) * self.low_bits]
            low = (low.reshape(e - a, self.low_bits).astype(np.uint64) << place).sum(axis=1, dtype=np.uint64)
            yield from (high.astype(np.uint64) << np.uint64(self.low_bits) | low).tolist()

    def all(self) -> np.ndarray:
        """Every number, in one pass over the bits."""
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        low = np.unpackbits(self.lower, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return (ones - np.arange(self.n)) << self.low_bits | (low.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


class Shard:
    """A shard file's bytes, opened: ``doc_id(i)``, ``bounds(i)`` and ``document(i)`` through select."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token-id shard")
        self.n, u, width, *ends = (int(x) for x in np.frombuffer(data, "<u8", 6, 8))
        self.nulls, self.base = (int(x) for x in np.frombuffer(data, "<i8", 2, 56))
        keys = [int(x) for x in np.frombuffer(data, "<u8", 3, 72)]
        at, codes = 96, []
        for n, (low, upper_bits, samples) in ((self.n, ends), (self.n - self.nulls, keys)):
            parts = []
            for size, kind in (((n * low + 7) // 8, np.uint8), ((upper_bits + 7) // 8, np.uint8), (samples, "<u4")):
                parts.append(np.frombuffer(data, kind, size, at))
                at += parts[-1].nbytes
            codes.append(EliasFano(n, low, *parts))
        self.ends, self.keys = codes
        self.ids = np.frombuffer(data, f"<u{width}", u, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.keys[i - self.nulls]

    def bounds(self, i: int) -> tuple[int, int]:
        return self.ends[i - 1] if i else 0, self.ends[i]

    def document(self, i: int) -> np.ndarray:
        a, e = self.bounds(i)
        return self.ids[a:e]


def shard_bytes(doc_ids: list, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """A shard of documents in ascending order of their ids, those without one first."""
    own = [k for k in doc_ids if k is not None]
    base = own[0] if own else 0
    # differences of 64-bit numbers, modulo 2 ** 64
    rest = np.array(own, dtype=np.int64).astype(np.uint64) - np.uint64(base % (1 << 64))
    ends, keys = EliasFano.of(np.cumsum(counts), len(ids)), EliasFano.of(rest, own[-1] - base if own else 0)
    head = [np.array([len(doc_ids), len(ids), width, ends.low_bits, len(ends.upper) * 8, len(ends.samples)], dtype="<u8"),
            np.array([len(doc_ids) - len(own), base], dtype="<i8"), np.array([keys.low_bits, len(keys.upper) * 8, len(keys.samples)], dtype="<u8")]
    parts = [x.tobytes() for e in (ends, keys) for x in (e.lower, e.upper, e.samples)]
    return b"".join([MAGIC, *(h.tobytes() for h in head), *parts, ids.astype(f"<u{width}").tobytes()])


def write_store(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write ``docs`` as shards under ``folder`` (a URI all executors reach); (part, shard, file, n_docs, n_ids) per shard.

    Ids must be integers. Rows with the same id are ordered by their text.
    NULL ids come first; NULL text: the end id alone."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        enc = encoder(tokenizer)
        width = 2 if max(enc.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, number = TaskContext.get().partitionId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        keys: list = []
        held: list = []
        sizes: list = []
        total = 0

        def close() -> pa.RecordBatch:
            nonlocal keys, held, sizes, total, number
            name = f"{part:06d}-{number:06d}.eft"
            own = f"{root}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                out.write(shard_bytes(keys, np.array(sizes, dtype=np.int64), np.concatenate(held), width))
            store.move(own, f"{root}/{name}")
            row = [[part], [number], [name], [len(keys)], [total]]
            keys, held, sizes, total, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                              names=["part", "shard", "file", "n_docs", "n_ids"])

        for b in batches:
            for i in range(0, len(b), 4096):  # the encoder bounds the characters it holds
                s = b.slice(i, 4096)
                ids, counts = enc.encode(s.column(1).to_pylist())
                at = 0
                for key, n in zip(s.column(0).to_pylist(), counts.tolist()):
                    if keys and total + n + 1 > shard_ids:
                        yield close()
                    held.append(np.append(ids[at: at + n], end_id).astype(f"<u{width}"))
                    at += n
                    keys.append(key)
                    sizes.append(n + 1)
                    total += n + 1
            free_memory()
        if keys:
            yield close()

    return materialize(placed.mapInArrow(write, "part long, shard long, file string, n_docs long, n_ids long"), "shards")


def read_store(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files themselves.

    ``shards`` is what ``write_store`` returned: only files listed there count.
    Each task opens the files of its rows and finds the documents' bounds and
    ids through the select samples, a block of documents at a time. No shards:
    no documents."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per partition of the writer: bounded by their number, not by the data
    parts = parts.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    starts = (shards.withColumn("inside", inside).join(small_side(materialize(parts, "parts"), row_bytes=16), F.col("part") == F.col("p"))
              .select("file", (F.col("part_start") + F.col("inside")).alias("shard_start")))
    tasks = max(1, min(shards.count(), 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def open_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_file(f"{root}/{name}") as f:
                    s = Shard(f.read())
                keys = chain(repeat(None, s.nulls), (s.base + k for k in s.keys.blocks()))
                rows, at = [], 0
                for key, end in zip(keys, s.ends.blocks()):  # a document starts where the one before ends
                    rows.append((key, first + at, end - at, zlib.crc32(s.ids[at:end].astype("<u4").tobytes())))
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return starts.repartition(tasks, "file").mapInArrow(open_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")

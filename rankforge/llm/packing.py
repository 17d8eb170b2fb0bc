"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

Documents become pieces of at most ``SEQUENCE`` ids. The histogram of piece
lengths (one count per length, at most 4096) goes to the driver, which places
lengths longest first, each piece on the pack with the most room left, and
counts packs by pattern instead of one by one. The slots of the patterns, one
row per run of equal lengths, are then joined back to the pieces by length and
rank. A length that a third of all pieces share fills its packs like any other
and is ranked over many tasks. Lengths that share no pack well (all pieces a
little over half a sequence, say) leave room: the emptiest packs are then taken
apart and their pieces cut to fill the room that the others have, at multiples
of ``GRAIN`` ids, whose checksums are kept so that no text is encoded twice.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import free_memory, materialize, number_rows, small_side
from rankforge.llm.encode import encoder

SEQUENCE, END_ID = 4096, 2
#: Pieces of text the encoder of a Python worker remembers (about 200 bytes each); fewer cost time, not results.
MEMORY = 500_000
#: Pieces are cut at multiples of so many ids to fill packs, and only if more than this share of all places is padding.
GRAIN, LITTLE = 64, 0.03


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
           end_id: int = END_ID, with_ids: bool = False, memory: int = MEMORY, slice_chars: int = 0, rows_at_once: int = 1024) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, grains[, ids]): documents with their end id, cut at every ``sequence`` ids.

    ``grains``: the CRC-32 of every ``GRAIN`` ids, 4 bytes each. ``slice_chars``, ``rows_at_once``: characters (0: the encoder's own) and documents
    encoded at a time; with ``memory`` they bound what a worker holds, not the result."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grains"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, memory, slice_chars)
        for b in batches:
            for i in range(0, len(b), rows_at_once):
                part = b.slice(i, rows_at_once)
                ids, counts = enc.encode([x or "" for x in part.column(1).to_pylist()])
                rows: list = [[] for _ in names]
                at = 0
                for key, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    own = np.append(ids[at: at + n], end_id).astype("<u4")
                    at += n
                    for a in range(0, n + 1, sequence):
                        piece = own[a: a + sequence]
                        raw = piece.tobytes()
                        grains = np.array([zlib.crc32(raw[g: g + 4 * GRAIN]) for g in range(0, len(raw), 4 * GRAIN)], dtype="<u4").tobytes()
                        for col, v in zip(rows, (key, a, len(piece), zlib.crc32(raw), n + 1, grains, piece.astype(np.int32))):
                            col.append(v)
                types = [b.schema.field(0).type] + [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)
            free_memory()

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, grains binary" + ", ids array<int>" * with_ids
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def plan_packs(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """Shortest-pack-first: [(packs, lengths of each in order)] for {length: pieces}.

    Each piece goes to the pack with the most room, also one that its own
    length has just gone into; only where no room is left are new packs opened,
    as many as the pieces left of the length fill."""
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # free ids -> [(packs, [(length, times)])]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        frees = [-f for f in room if f >= length]  # a heap of the rooms, largest first
        heapq.heapify(frees)
        while left:
            if frees:
                free, times = -frees[0], 1
                packs, pattern = room[free].pop()
                used = min(packs, left)
                if used < packs:
                    room[free].append((packs - used, pattern))
                if not room[free]:
                    del room[free]
                    heapq.heappop(frees)
            else:
                free, times, pattern = sequence, min(sequence // length, left), []
                used = left // times
            left -= used * times
            rest = free - times * length
            if rest not in room:
                room[rest] = []
                if rest >= length:
                    heapq.heappush(frees, -rest)
            if pattern and pattern[-1][0] == length:
                pattern, times = pattern[:-1], pattern[-1][1] + times
            room[rest].append((used, [*pattern, (length, times)]))
    return [(n, [x for x, times in p for _ in range(times)]) for f in sorted(room) for n, p in room[f]]


def slot_rows(packs: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, packs) of each run of equal lengths in each pattern.

    A run's ranks go through the packs first, then to the next place of the run."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for n, pattern in packs:
        at = 0
        for length, run in groupby(pattern):
            times = len(list(run))
            rows.append((length, rank[length], rank[length] + n * times, sequence, at, n))
            rank[length] += n * times
            at += length * times
        sequence += n
    return rows


def cut_to_fill(packs: list[tuple[int, list[int]]], sequence: int = SEQUENCE, grain: int = GRAIN) -> list[tuple]:
    """``slot_rows`` with (delta, part) at the end of each row: which ids of the piece, after taking the emptiest packs apart.

    Their pieces go to the room of the other packs, the longest to the largest
    room; one that is longer than the largest room is cut there, at a multiple
    of ``grain`` ids. Packs and pieces are handled by groups of equal ones."""
    groups, rank = [], defaultdict(int)
    for n, pattern in packs:
        runs = []
        for length, run in groupby(pattern):
            times = len(list(run))
            runs.append((length, rank[length], times))
            rank[length] += n * times
        groups.append((sequence - sum(pattern), n, runs))
    padding = sum(f * n for f, n, _ in groups)
    apart: list[int] = [0] * len(groups)  # packs of each group to take apart
    if padding > LITTLE * sequence * sum(n for _, n, _ in groups):
        room = sum(max(0, f - 2 * grain) * n for f, n, _ in groups)
        for g in sorted(range(len(groups)), key=lambda g: -groups[g][0]):
            f, n, runs = groups[g]
            need = sum(-(-length // grain) * grain * times for length, _, times in runs)
            apart[g] = min(n, int(room // (need + max(0, f - 2 * grain))))
            room -= apart[g] * (need + max(0, f - 2 * grain))
            if apart[g] < n:
                break
    rows, rooms, units, sequences = [], [], [], 0
    for (f, n, runs), gone in zip(groups, apart):
        kept, at = n - gone, 0
        for length, lo, times in runs:
            if not gone:
                rows.append((length, lo, lo + n * times, sequences, at, n, 0, length))
            else:  # of each place, the first packs' pieces stay and the others' go
                for t in range(times):
                    if kept:
                        rows.append((length, lo + t * n, lo + t * n + kept, sequences, at + t * length, kept, 0, length))
                    heapq.heappush(units, (-length, length, lo + t * n + kept, gone, 0))
            at += length * times
        if kept:
            heapq.heappush(rooms, (-f, sequences, kept))
            sequences += kept
    while units:
        m, length, lo, count, delta = heapq.heappop(units)
        m = -m
        f, first, n = heapq.heappop(rooms) if rooms else (0, 0, 0)
        f = -f
        part = m if m <= f else f // grain * grain
        if not part:  # no room left: new packs
            rooms = []
            n = -(-count * m // sequence)
            f, first, part = sequence, sequences, m
            sequences += n
        c = min(n, count)
        rows.append((length, lo, lo + c, first, sequence - f, c, delta, part))
        if n > c:
            heapq.heappush(rooms, (-f, first + c, n - c))
        heapq.heappush(rooms, (part - f, first, c))
        if part < m:
            heapq.heappush(units, (part - m, length, lo, c, delta + part))
        if count > c:
            heapq.heappush(units, (-m, length, lo + c, count - c, delta))
    return rows


@lru_cache(maxsize=256)
def _advance(ids: int) -> tuple[int, ...]:
    """What 4 * ``ids`` zero bytes make of each bit of a CRC-32."""
    bit = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit

    def apply(m: list[int], v: int) -> int:
        out = 0
        for i in range(32):
            if v >> i & 1:
                out ^= m[i]
        return out

    out, power, bits = [1 << i for i in range(32)], bit, 32 * ids
    while bits:
        if bits & 1:
            out = [apply(power, v) for v in out]
        power, bits = [apply(power, v) for v in power], bits >> 1
    return tuple(out)


def join_checksums(grains: list[bytes], first: np.ndarray, part: np.ndarray, grain: int = GRAIN) -> np.ndarray:
    """CRC-32 of ``part`` ids from grain ``first`` on, from the grains' own: two checksums join without the bytes."""
    def advance(crc: np.ndarray, ids: int) -> np.ndarray:
        out = np.zeros_like(crc)
        for i, m in enumerate(_advance(ids)):
            out ^= np.where(crc >> np.uint32(i) & np.uint32(1), np.uint32(m), np.uint32(0))
        return out

    own = [np.frombuffer(g, dtype="<u4") for g in grains]
    crc = np.zeros(len(own), dtype=np.uint32)
    for k in range(int(-(-part.max() // grain)) if len(part) else 0):
        size = np.minimum(part - k * grain, grain)
        for ids in np.unique(size[size > 0]).tolist():
            rows = np.flatnonzero(size == ids)
            crc[rows] = advance(crc[rows], ids) ^ np.array([own[r][first[r] + k] for r in rows.tolist()], dtype=np.uint32)
    return crc.astype(np.int64)


@F.arrow_udf(T.LongType())
def _part_crc(crc: pa.Array, grains: pa.Array, delta: pa.Array, part: pa.Array, length: pa.Array) -> pa.Array:
    out = np.array(crc)
    cut = np.flatnonzero(np.asarray(part) != np.asarray(length))
    if len(cut):
        out[cut] = join_checksums([grains[i].as_py() for i in cut.tolist()], np.asarray(delta)[cut] // GRAIN, np.asarray(part)[cut])
    return pa.array(out)


def pack(found: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces plus ``sequence_id`` and ``offset``: each piece's sequence and place, gapless from 0.

    A piece that was cut to fill packs has a row for each part. The number of
    patterns follows the number of distinct lengths, not of pieces."""
    spark = found.sparkSession
    found = materialize(found, "pieces")
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= sequence rows
    slots = spark.createDataFrame(cut_to_fill(plan_packs(histogram, sequence), sequence) or [(0, 0, 0, 0, 0, 1, 0, 0)],
                                  "slot_length long, lo long, hi long, first long, at long, packs long, delta long, part long")
    before, total = {}, 0
    for length in sorted(histogram):
        before[length], total = total, total + histogram[length]
    starts = spark.createDataFrame(sorted(before.items()) or [(0, 0)], "slot_length long, before long")
    slots = small_side(materialize(slots.join(F.broadcast(starts), "slot_length"), "slots"), row_bytes=80)
    placed = number_rows(found, ["length", "doc_id", "start"], "_place")
    rank = F.col("_place") - F.col("before")
    nth = rank - F.col("lo")
    placed = (placed.join(slots, (F.col("length") == F.col("slot_length")) & (rank >= F.col("lo")) & (rank < F.col("hi")))
              .withColumn("sequence_id", F.col("first") + nth % F.col("packs"))
              .withColumn("offset", F.col("at") + F.call_function("div", nth, F.col("packs")) * F.col("length")))
    own = {"start": F.col("start") + F.col("delta"), "length": F.col("part"),
           "ids_crc32": _part_crc("ids_crc32", "grains", "delta", "part", "length")}
    if "ids" in found.columns:
        own["ids"] = F.slice("ids", (F.col("delta") + 1).cast("int"), F.col("part").cast("int"))
    return placed.select(*[own.get(c, F.col(c)).alias(c) for c in found.columns if c != "grains"], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
                   end_id: int = END_ID, with_ids: bool = False, memory: int = MEMORY, slice_chars: int = 0, rows_at_once: int = 1024) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset``.

    NULL and empty texts are one piece with the end id alone. Repeated rows
    are packed as often as they stand; a NULL id is kept. Documents longer
    than a sequence are cut at its multiples, and others where that fills
    packs. Other columns are not read. Empty table: empty result."""
    return pack(pieces(docs, tokenizer, doc_id, text, sequence, end_id, with_ids, memory, slice_chars, rows_at_once), sequence)

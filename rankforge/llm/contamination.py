"""Benchmark decontamination: a broadcast set of test word windows, scanned over whole training texts.

The windows of the benchmark items become one sorted table of 64-bit hashes
beside the word numbers they stand for. Tasks turn every text into word numbers
(words that no item holds: -1), hash the windows of known words, look them up
and compare the words of each hit, so a hash never decides alone. Nothing is
shuffled: a passage that a third of all documents share costs what any other
does. The set is broadcast only up to ``SET_PAIRS`` pairs of a window and an
item and ``SET_BYTES`` of window text; a larger benchmark is dealt into slices
within the bounds, scanned one after the other, and the hits are united.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import free_memory, materialize, temp_name

#: Words of a window.
WINDOW = 10
#: Pairs of a window and an item, and bytes of their windows, that are broadcast at a time.
SET_PAIRS, SET_BYTES = 500_000, 64 << 20
#: Bytes of text turned into words at a time.
CHUNK = 4 << 20

#: What isn't part of a word: ASCII other than digits and letters.
NOT_WORD = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_CLEAN = bytes(0x20 if NOT_WORD.match(bytes([b])) else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, ASCII letters in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORDS), 0)


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (words: space-joined, item: string). An item of fewer words than a window is one window, one of none has none."""
    w = F.col("w")
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0)))
    cut = F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, window), " "))
    own = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    return own.select("item", F.explode(F.array_distinct(cut)).alias("words")).distinct()


class WindowSet:
    """Windows (tuples of words) by size: sorted hashes, the words' numbers, the window's place in the list."""

    def __init__(self, windows: list[bytes]):
        split = [w.split(b" ") for w in windows]
        self.number: dict[bytes, int] = {}
        for ws in split:
            for w in ws:
                self.number.setdefault(w, len(self.number))
        self.sizes = []
        for size in sorted({len(ws) for ws in split}):
            at = np.array([i for i, ws in enumerate(split) if len(ws) == size])
            rows = np.array([[self.number[w] for w in split[i]] for i in at.tolist()], dtype=np.int32)
            base, h = 0x9E3779B97F4A7C15, None
            while h is None or len(np.unique(h)) < len(h):  # another multiplier until no two windows of the set share a hash
                base = (base * 6364136223846793005 + 1442695040888963407) % (1 << 64) | 1
                powers = [np.uint64(pow(base, k + 1, 1 << 64)) for k in range(size)]
                h = self._hash(rows.T, powers)
            order = np.argsort(h)
            self.sizes.append((size, powers, h[order], rows[order], at[order]))

    @staticmethod
    def _hash(columns, powers) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c, p in zip(columns, powers):
            h += (c.astype(np.uint64) + np.uint64(1)) * p
        return h ^ (h >> np.uint64(31))

    def numbers(self, data: bytes) -> np.ndarray:
        """The number of each word of a text, -1 for words outside the set."""
        clean, parts, get = data.translate(_CLEAN), [], self.number.get
        at = 0
        while at < len(clean):
            end = len(clean) if len(clean) - at <= CHUNK else clean.find(b" ", at + CHUNK)
            end = len(clean) if end < 0 else end
            own = clean[at:end].split()
            parts.append(np.fromiter((get(w, -1) for w in own), dtype=np.int32, count=len(own)))
            at = end
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, dtype=np.int32), *parts])

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, window) of every occurrence; numbers below 0 belong to no window."""
        out = [(np.zeros(0, dtype=np.int64),) * 3]
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for size, powers, hashes, rows, at in self.sizes:
            if len(ids) < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            h = self._hash([ids[starts + k] for k in range(size)], powers)
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[place] == h)
            starts, place = starts[hit], place[hit]
            same = np.ones(len(starts), dtype=bool)
            for k in range(size):  # verified word by word
                same &= ids[starts + k] == rows[place, k]
            starts, place = starts[same], place[same]
            out.append((starts, np.full(len(starts), size), at[place]))
        return tuple(np.concatenate(x) for x in zip(*out))


def hit_runs(hit: np.ndarray, data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the runs of hit words."""
    inside = np.frombuffer(data.translate(_CLEAN), dtype=np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    first, end = edge[0::2], edge[1::2]
    turn = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    return [(int(first[a]), int(end[b - 1])) for a, b in zip(turn[0::2].tolist(), turn[1::2].tolist())]


#: Sets that this worker has built.
_BUILT: dict[str, tuple] = {}


def _scan(docs: DataFrame, text: str, pairs: list, names: dict[str, str]) -> DataFrame:
    """``docs`` plus its hits under ``pairs`` (rows of words, item): every column passes through as it came."""
    windows = sorted({p.words for p in pairs})
    place = {w: i for i, w in enumerate(windows)}
    owners: list[list[str]] = [[] for _ in windows]
    for p in pairs:
        owners[place[p.words]].append(p.item)
    shared = docs.sparkSession.sparkContext.broadcast(([w.encode() for w in windows], owners))
    raw = temp_name("raw")
    columns = docs.columns
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(names["n_words"], T.LongType()), T.StructField(names["hits"], spans),
                           T.StructField(names["items"], T.ArrayType(T.StringType())), T.StructField(names["spans"], spans)])
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    token = temp_name("set")

    def built() -> tuple:
        if token not in _BUILT:
            _BUILT.clear()
            _BUILT[token] = (WindowSet(shared.value[0]), shared.value[1])
        return _BUILT[token]

    def pieces(b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        a, held = 0, 0
        for i, s in enumerate(pc.binary_length(b.column(len(columns))).to_pylist()):
            if held and held + s > CHUNK:
                yield a, i
                a, held = i, 0
            held += s
        if a < b.num_rows:
            yield a, b.num_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, items = built()
        for b in batches:
            for a, e in pieces(b):
                part = b.slice(a, e - a)
                texts = part.column(len(columns))
                ids = [found.numbers(texts[i].as_py()) for i in range(len(texts))]
                n = np.array([len(x) for x in ids], dtype=np.int64)
                gap = np.full(1, -1, dtype=np.int32)
                start, size, window = found.find(np.concatenate([y for x in ids for y in (x, gap)]))
                first = np.cumsum(n + 1) - (n + 1)
                doc = np.searchsorted(first, start, side="right") - 1
                hits, owned, spans = [[]] * len(ids), [[]] * len(ids), [[]] * len(ids)
                for d in np.unique(doc).tolist():
                    own = doc == d
                    at, wide = start[own] - first[d], size[own]
                    change = np.zeros(n[d] + 1, dtype=np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + wide, -1)
                    hit = np.cumsum(change[:-1]) > 0
                    turn = np.flatnonzero(np.diff(hit, prepend=False, append=False)).tolist()
                    hits[d] = [{"start": x, "end": y} for x, y in zip(turn[0::2], turn[1::2])]
                    owned[d] = sorted({i for w in np.unique(window[own]).tolist() for i in items[w]})
                    spans[d] = [{"start": x, "end": y} for x, y in hit_runs(hit, texts[d].as_py())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(columns)], pa.array(n), pa.array(hits, arrow_spans), pa.array(owned, pa.list_(pa.string())), pa.array(spans, arrow_spans)],
                    names=schema.names)
        free_memory()

    return docs.withColumn(raw, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).mapInArrow(run, schema)


def _with_spans(found: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """``found`` plus the byte ranges of its runs of hit words."""
    @F.pandas_udf("array<struct<start: long, end: long>>")
    def spans(raw: pd.Series, hits: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for data, runs, k in zip(raw, hits, n):
            hit = np.zeros(k, dtype=bool)
            for r in runs:
                hit[r["start"]: r["end"]] = True
            out.append([{"start": a, "end": e} for a, e in hit_runs(hit, data)])
        return pd.Series(out)

    none = F.slice(F.col(names["hits"]), 1, 0)
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    hit = found.where(F.size(names["hits"]) > 0).withColumn(names["spans"], spans(raw, F.col(names["hits"]), F.col(names["n_words"])))
    return hit.unionByName(found.where(F.size(names["hits"]) == 0).withColumn(names["spans"], none))


def _union(a: str) -> Column:
    """Ranges of several slices (a: array of ranges) as disjoint ranges in order."""
    def add(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= r["start"]), joined).otherwise(F.concat(done, F.array(r)))
    return F.aggregate(F.array_sort(F.flatten(a)), F.slice(F.flatten(a), 1, 0), add)


def _annotated(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int,
               set_pairs: int, set_bytes: int) -> tuple[DataFrame, dict[str, str]]:
    names = {n: temp_name(n) for n in ("n_words", "hits", "items", "spans")}
    pairs = materialize(item_windows(items, item_id, item_text, window), "windows")
    dealt, slices = None, 1
    while True:
        dealt = pairs.withColumn("s", F.pmod(F.xxhash64("words", "item"), F.lit(slices)))
        top = dealt.groupBy("s").agg(F.count("*").alias("n"), F.sum(F.octet_length("words") + F.octet_length("item") + 32).alias("b")).agg(F.max("n"), F.max("b")).first()
        if (top[0] or 0) <= 1 or (top[0] <= set_pairs and top[1] <= set_bytes):
            break
        slices *= 2
    if slices == 1:
        return _scan(docs, text, pairs.collect(), names), names
    # a larger set: one scan a slice over rows that carry a number, hits united by it
    row = temp_name("row")
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = None
    for s in range(slices):
        own = dealt.where(F.col("s") == s).select("words", "item").collect()
        part = _scan(rows.select(row, text), text, own, names).drop(text)
        part = materialize(part.where((F.size(names["hits"]) > 0) | F.lit(s == 0)), "hits")
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy(row).agg(F.max(names["n_words"]).alias(names["n_words"]), *[F.collect_list(names[n]).alias(names[n]) for n in ("hits", "items")])
    merged = merged.select(row, names["n_words"], _union(names["hits"]).alias(names["hits"]),
                           F.array_sort(F.array_distinct(F.flatten(names["items"]))).alias(names["items"]))
    return _with_spans(rows.join(merged, row), text, names).select(*docs.columns, *names.values()), names


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, set_pairs: int = SET_PAIRS, set_bytes: int = SET_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items, spans``.

    ``n_hit`` counts the words inside any occurrence of a benchmark window,
    ``items`` lists the items (ids as strings, sorted) with an occurring
    window, ``spans`` the hit runs as (start, end) bytes of the UTF-8 text.
    NULL and empty texts have no words; rows that repeat are judged each for
    itself, NULL ids are kept. Item rows that share an id are one item, a
    NULL id counts as the empty string, items without words have no windows.
    Other columns are not read. Empty tables: no rows, or no hits."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found, n = _annotated(own, items, "text", item_id, item_text, window, set_pairs, set_bytes)
    return found.select("doc_id", F.col(n["n_words"]).alias("n_words"),
                        F.aggregate(n["hits"], F.lit(0).cast("long"), lambda t, r: t + r["end"] - r["start"]).alias("n_hit"),
                        F.col(n["items"]).alias("items"), F.col(n["spans"]).alias("spans"))


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` (its own columns) without what the benchmark holds.

    ``remove='spans'`` cuts the runs of hit words out of the text, with what
    stands between them; ``'documents'`` drops every row with a hit. Rows
    without a hit stay as they are (NULL texts too)."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove!r}")
    found, n = _annotated(docs, items, text, item_id, item_text, window, SET_PAIRS, SET_BYTES)
    if remove == "documents":
        return found.where(F.size(n["hits"]) == 0).select(*docs.columns)
    raw, s = F.col(text).cast("binary"), F.col(n["spans"])
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(s, lambda r: r["end"]))
    ends = F.concat(F.transform(s, lambda r: r["start"]), F.array(F.octet_length(raw).cast("long")))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("e")),
                       lambda r: F.substring(raw, (r["a"] + 1).cast("int"), (r["e"] - r["a"]).cast("int")).cast("string"))
    cut = F.when(F.size(s) > 0, F.array_join(kept, "")).otherwise(F.col(text))
    return found.select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])

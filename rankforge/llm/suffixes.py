"""Removal of repeated byte strings by a distributed difference-cover suffix order.

Every byte covered by a ``WINDOW``-byte string that also starts elsewhere is
removed. The order is built over chunks, not bytes:

1. Parse. The anchor of a window is the gram with the smallest hash among all
   ``GRAM``-byte grams inside it (the last of equals), so equal windows have
   their anchors at the same place. Windows that follow each other and share
   an anchor form a cell; anchors cut the text into chunks. Only cells whose
   anchor gram stands twice or more anywhere can hold a repeated window; texts
   without one are done.
2. Difference cover. In the chunk sequences of the other texts the positions
   1 and 2 modulo 3 are sampled: of any two positions some equal shift of 0, 1
   or 2 is sampled in both. The triples of chunks at sampled positions are
   sorted over the cluster and named in that order; the next round names
   triples of names. After ``ROUNDS`` rounds a name covers 3 ** ROUNDS chunks,
   which may be less than a window; positions 0 modulo 3 are never ordered.
3. Adjacent prefixes. Sampled suffixes are sorted by their last name, and
   each is compared with its neighbours: windows inside the common chunks are
   repeated.
4. Grouping of the rest, by hash (no merge of suffixes): windows that begin at or before unsampled positions or
   end inside a chunk. They are settled cell by cell under their anchor
   gram: cells with equal bytes are one class, a class with two members is
   repeated as a whole, and the open windows of single cells are compared
   with those of the other classes of their gram, ``BAND`` in a row at a time:
   a band whose bytes stand twice is repeated, one whose windows have nothing
   shared in common is not, and only the others are compared window by window.

Steps 2 and 3 only ever settle windows that are repeated; step 4 settles
all that they leave, so the result is exact (64-bit hashes apart) whatever
the number of rounds. A gram, chunk or text that a third of all rows share
is aggregated before each shuffle or joined where AQE can split it. Equal
texts are parsed as one. Texts travel only for documents with a repeated gram.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import materialize, release, small_side

WINDOW, GRAM = 200, 80
#: Rounds of naming; r rounds order suffixes by 3 ** r chunks (more rounds settle more in step 3, results are the same).
ROUNDS = 2
#: Windows compared at once, by what they have in common, before they are compared one by one.
BAND = 16
#: Texts that may share a hash with another before the operator gives up (a few are expected at 10 ** 10 texts).
RENAMED = 10_000
#: Bytes parsed at a time.
SEGMENT = 4 << 20

_BASE = 0x9E3779B97F4A7C15
_LOW = (1 << 31) - 1


def _powers(base: int, n: int) -> np.ndarray:
    p, m = np.ones(n, dtype=np.uint64), 1
    while m < n:
        k = min(m, n - m)
        p[m: m + k] = p[:k] * np.uint64(pow(base, m, 1 << 64))
        m += k
    return p


class Parser:
    """Anchors, cells and chunks of byte strings."""

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.wide = window, gram, window - gram + 1
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def _keys(self, b: np.ndarray, at: int) -> np.ndarray:
        """Hash of the gram at each place in the upper 33 bits; in the lower, what makes a later place smaller."""
        n = len(b)
        if n > len(self.up):
            size = max(n, 1 << 16)
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.down[:n], out=sums[1:])
        h = (sums[self.gram:] - sums[: n + 1 - self.gram]) * self.up[: n + 1 - self.gram]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        place = np.arange(at, at + len(h), dtype=np.uint64)
        return (h >> np.uint64(31) << np.uint64(31)) | (np.uint64(_LOW) - place)

    def cells(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, first window, last window) of each cell, in order."""
        n = len(data)
        if n < self.window:
            return (np.zeros(0, dtype=np.int64),) * 3
        buf = np.frombuffer(data, dtype=np.uint8)
        parts = []
        for a in range(0, n - self.window + 1, SEGMENT):
            m = self._keys(buf[a: a + SEGMENT + self.window - 1], a)
            span = 1
            while 2 * span <= self.wide:
                m = np.minimum(m[:-span], m[span:])
                span *= 2
            if span < self.wide:
                m = np.minimum(m[: len(m) - (self.wide - span)], m[self.wide - span:])
            parts.append((np.uint64(_LOW) - (m & np.uint64(_LOW))).astype(np.int64))
        anchor = np.concatenate(parts)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        return anchor[first], first, np.append(first[1:] - 1, n - self.window)

    def grams(self, data: bytes, anchors: np.ndarray) -> np.ndarray:
        h, g = xxhash.xxh3_64_intdigest, self.gram
        return np.array([h(data[x: x + g]) for x in anchors.tolist()], dtype=np.uint64).view(np.int64)


#: Entries of lists (chunks, cells, windows) that a Python step handles at a time, and bytes of text.
ENTRIES, TEXT_BYTES = 50_000, 2 << 20


def _slices(batches: Iterator[pd.DataFrame], size, limit: int) -> Iterator[pd.DataFrame]:
    """The rows of the batches in frames of about ``limit``; ``size(frame)`` gives the size of each row."""
    for b in batches:
        total = np.cumsum(np.fromiter(size(b), dtype=np.int64, count=len(b)))
        at = 0
        while at < len(b):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, side="right")))
            yield b.iloc[at:end].reset_index(drop=True)
            at = end


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _gram_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser(window, gram)
        for b in _slices(batches, lambda b: map(len, b["data"]), TEXT_BYTES):
            grams = [parser.grams(data, parser.cells(data)[0]) for data in b["data"]]
            yield pd.DataFrame({"gram": np.concatenate(grams), "tid": np.repeat(b["tid"].to_numpy(), [len(g) for g in grams])})

    return texts.mapInPandas(run, "gram long, tid long")


_PARSED = ("tid long, gram array<long>, anchor array<int>, first array<int>, last array<int>, span array<long>, "
           "start array<int>, size array<int>, chunk array<long>")


def _parse(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Per text: its cells with a repeated gram, and its chunks near them (chunk 0: a break)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser, h = Parser(window, gram), xxhash.xxh3_64_intdigest
        for b in _slices(batches, lambda b: map(len, b["data"]), TEXT_BYTES):
            rows = []
            for tid, data, often in zip(b["tid"].tolist(), b["data"], b["grams"]):
                x, lo, hi = parser.cells(data)
                grams = parser.grams(data, x)
                hot = np.isin(grams, often)
                span = [_signed(h(data[a: e + window])) for a, e in zip(lo[hot].tolist(), hi[hot].tolist())]
                cuts = np.concatenate([[0], x]) if x[0] else x
                ends = np.append(cuts[1:], len(data))
                at = np.searchsorted(x[hot], cuts - window)  # a repeated anchor within a window's length
                near = at < hot.sum()
                near[near] = x[hot][at[near]] < cuts[near] + window
                start, size, chunk = [], [], []
                for k, (a, e) in enumerate(zip(cuts.tolist(), ends.tolist())):
                    if near[k]:
                        start.append(a)
                        size.append(e - a)
                        chunk.append(_signed(h(data[a:e])) or 1)
                    elif chunk and chunk[-1]:
                        start.append(a)
                        size.append(0)
                        chunk.append(0)
                rows.append((tid, grams[hot], x[hot], lo[hot], hi[hot], span, start, size, chunk))
            yield pd.DataFrame(rows, columns=["tid", "gram", "anchor", "first", "last", "span", "start", "size", "chunk"])

    return texts.mapInPandas(run, _PARSED)


def _named(strings: DataFrame, step: int) -> DataFrame:
    """(tid, name array) -> (tid, name array): triples ``step`` apart at the sampled positions, named in their order."""
    def triples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, lambda b: map(len, b["name"]), ENTRIES):
            # the texts of a slice one after the other, each followed by zeros
            own = [np.asarray(s, dtype=np.int64) for s in b["name"]]
            sizes = np.array([len(s) + 2 * step for s in own])
            first = np.cumsum(sizes) - sizes
            long, place = np.zeros(sizes.sum(), dtype=np.int64), np.zeros(sizes.sum(), dtype=np.int64)
            for a, s in zip(first.tolist(), own):
                long[a: a + len(s)] = s
                place[a: a + len(s)] = np.arange(len(s))
            k = np.flatnonzero((place % 3 != 0) & (long != 0))
            yield pd.DataFrame({"tid": np.repeat(b["tid"].to_numpy(), sizes)[k], "i": place[k], "a": long[k], "b": long[k + step], "c": long[k + 2 * step]})

    rows = _step(strings.mapInPandas(triples, "tid long, i int, a long, b long, c long"), "triples")
    names = _step(rows.select("a", "b", "c").distinct().orderBy("a", "b", "c")
                  .select("a", "b", "c", (F.monotonically_increasing_id() + 1).alias("name")), "names")
    placed = rows.join(names, ["a", "b", "c"]).groupBy("tid").agg(F.collect_list("i").alias("i"), F.collect_list("name").alias("name"))
    placed = _step(_place(placed), "strings")
    release(strings.sparkSession, rows, names)
    return placed


def _place(strings: DataFrame) -> DataFrame:
    """(tid, i, name) -> (tid, name): names at their positions, 0 elsewhere."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, lambda b: map(len, b["i"]), ENTRIES):
            names = []
            for i, name in zip(b["i"], b["name"]):
                out = np.zeros(i.max() + 1, dtype=np.int64)
                out[i] = name
                names.append(out)
            yield pd.DataFrame({"tid": b["tid"], "name": names})

    return strings.mapInPandas(run, "tid long, name array<long>")


def sampled_order(parsed: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(tid, name array): rank of each sampled chunk suffix by its first 3 ** rounds chunks."""
    names = _named(parsed.select("tid", F.col("chunk").alias("name")), 1)
    for r in range(1, rounds):
        before, names = names, _named(names, 3 ** r)
        release(parsed.sparkSession, before)
    return names


def _common(a: tuple, b: tuple) -> int:
    """Bytes of the chunks that two suffixes have in common at their start."""
    total = 0
    for x, y, size in zip(a[2], b[2], a[3]):
        if x != y:
            break
        total += size
    return total


def adjacent_repeats(parsed: DataFrame, order: DataFrame, window: int) -> DataFrame:
    """(tid, lo, hi): windows lo..hi inside the chunks that a sampled suffix shares with a neighbour in the order."""
    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, lambda b: map(len, b["chunk"]), ENTRIES // 8):  # a suffix holds several chunks
            rows = []
            for tid, start, size, chunk, name in zip(b["tid"].tolist(), *(map(np.ndarray.tolist, b[c]) for c in ("start", "size", "chunk", "name"))):
                for i in [i for i, x in enumerate(name) if x]:
                    # all windows that begin in chunk i, and in the unsampled one after it
                    want, j = size[i] + (size[i + 1] if i % 3 == 2 and i + 1 < len(size) else 0) + window - 1, i
                    while j < len(chunk) and chunk[j] and want > 0:
                        want -= size[j]
                        j += 1
                    rows.append((name[i], tid, start[i], chunk[i:j], size[i:j]))
            yield pd.DataFrame(rows, columns=["name", "tid", "start", "chunk", "size"])

    rows = parsed.select("tid", "start", "size", "chunk").join(order, "tid").mapInPandas(
        suffixes, "name long, tid long, start int, chunk array<long>, size array<int>")
    rows = _step(rows, "suffixes")  # the range partitioning reads them twice
    parts = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, "name", "tid", "start").sortWithinPartitions("name", "tid", "start")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, before = None, 0  # a neighbour in another partition is left to the merge
        for b in _slices(batches, lambda b: map(len, b["chunk"]), ENTRIES):
            out = []
            for row in zip(b["tid"].tolist(), b["start"].tolist(), (x.tolist() for x in b["chunk"]), (x.tolist() for x in b["size"])):
                if last is not None:
                    both = _common(last, row)
                    if max(before, both) >= window:
                        out.append((last[0], last[1], last[1] + max(before, both) - window))
                    before = both
                last = row
            yield pd.DataFrame(out, columns=["tid", "lo", "hi"])
        if last is not None and before >= window:
            yield pd.DataFrame([(last[0], last[1], last[1] + before - window)], columns=["tid", "lo", "hi"])

    settled = _step(placed.mapInPandas(compare, "tid long, lo int, hi int"), "settled")
    release(parsed.sparkSession, rows)
    return settled


def _union(lo, hi) -> list[list[int]]:
    out: list[list[int]] = []
    for a, e in sorted(zip(lo, hi)):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return out


def _open_cells(parsed: DataFrame, settled: DataFrame) -> DataFrame:
    """All cells, with the range of their windows that isn't settled (NULL: none is left)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, lambda b: map(len, b["gram"]), ENTRIES):
            rows = []
            for tid, grams, anchor, first, last, span, los, his in zip(
                    b["tid"].tolist(), *(map(np.ndarray.tolist, b[c]) for c in ("gram", "anchor", "first", "last", "span")), b["los"], b["his"]):
                done = _union(los.tolist(), his.tolist()) if los is not None else []
                k = 0
                for g, x, lo, hi, s in zip(grams, anchor, first, last, span):
                    while k < len(done) and done[k][1] < lo:
                        k += 1
                    a, e, j = lo, hi, k
                    while j < len(done) and done[j][0] <= a <= done[j][1]:
                        a, j = done[j][1] + 1, j + 1
                    if a > hi:
                        a = e = None
                    else:
                        for d in done[k:]:
                            if d[0] > e:
                                break
                            if d[0] <= e <= d[1]:
                                e = d[0] - 1
                    rows.append((tid, g, x, lo, hi, s, a, e))
            yield pd.DataFrame(rows, columns=["tid", "gram", "anchor", "lo", "hi", "span", "open_lo", "open_hi"]).astype(
                {"open_lo": "Int32", "open_hi": "Int32"})

    done = settled.groupBy("tid").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
    return parsed.join(done, "tid", "left").mapInPandas(
        run, "tid long, gram long, anchor int, lo int, hi int, span long, open_lo int, open_hi int")


def _classes(rows: DataFrame, key: list[str], member: list[str], *more: Column) -> DataFrame:
    """``key``, the number ``n`` of rows that share it and ``r``, the columns of one of them (plain numbers, so that rows are hashed and not sorted)."""
    found = rows.groupBy(*key).agg(F.count("*").alias("n"), *[F.first(c).alias(f"r_{c}") for c in member], *more)
    return found.withColumn("r", F.struct(*[F.col(f"r_{c}").alias(c) for c in member])).drop(*[f"r_{c}" for c in member])


def _merge(cells: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """(tid, lo, hi): the open windows of the cells that are repeated."""
    key = ["gram", "span", "head"]
    cells = cells.withColumn("head", F.col("anchor") - F.col("lo"))
    grams = _step(cells.where("open_lo IS NOT NULL").select("gram").distinct(), "open-grams")  # no aggregate in the join's stage
    cells = _step(cells.join(grams, "gram", "left_semi"), "open-cells")
    release(texts.sparkSession, grams)
    # cells of equal bytes are one class; its representative is any member (the bytes are the same)
    classes = _step(_classes(cells, key, ["tid", "anchor", "lo", "hi", "open_lo", "open_hi"]), "classes")
    whole = cells.where("open_lo IS NOT NULL").join(classes.where("n > 1").select(*key), key, "left_semi").select("tid", "lo", "hi")
    single = (classes.where("n = 1 AND r.open_lo IS NOT NULL").groupBy("gram")
              .agg(F.min(F.expr("r.open_lo - r.anchor")).alias("from"), F.max(F.expr("r.open_hi - r.anchor")).alias("to")))
    asked = (classes.join(single, "gram")
             .select("gram", "r.tid", "r.anchor", F.greatest("r.lo", F.expr("r.anchor + `from`")).alias("a"),
                     F.least("r.hi", F.expr("r.anchor + `to`")).alias("e"), F.expr("n = 1 AND r.open_lo IS NOT NULL").alias("open")).where("a <= e"))
    asked = asked.groupBy("tid").agg(*[F.collect_list(c).alias(f"{c}s") for c in ("gram", "anchor", "a", "e", "open")])

    def bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = xxhash.xxh3_64_intdigest
        for b in _slices(batches, lambda b: (sum(map(int, e)) - sum(map(int, a)) + BAND * len(a) for a, e in zip(b["as"], b["es"])), BAND * ENTRIES):
            rows = []
            lists = [b[c].map(list) for c in ("grams", "anchors", "as", "es", "opens")]
            for tid, data, *wanted in zip(b["tid"].tolist(), b["data"], *lists):
                for gram, x, a, e, is_open in zip(*wanted):
                    x, a, e = int(x), int(a), int(e)
                    for j in range((x - e) // BAND, (x - a) // BAND + 1):
                        top = x - j * BAND  # the band's windows begin at top - BAND + 1 .. top
                        lo, hi = max(a, top - BAND + 1), min(e, top)
                        # what all windows of the band have in common, and all bytes of its windows from lo to hi
                        rows.append((gram, j, _signed(h(data[top: top - BAND + 1 + window])), tid, lo, hi, is_open,
                                     lo - x, hi - x, _signed(h(data[lo: hi + window]))))
            yield pd.DataFrame(rows, columns=["gram", "band", "hash", "tid", "a", "e", "open", "from", "to", "all"])

    key, full = ["gram", "band", "hash"], ["gram", "from", "to", "all"]
    found = _step(texts.join(asked, "tid").mapInPandas(
        bands, "gram long, band int, hash long, tid long, a int, e int, open boolean, from int, to int, all long"), "bands")
    # bands of the same bytes have the same place under the gram, so the same number and hash of what is in common
    bands_of = _step(_classes(found, full, ["band", "hash", "tid", "a", "e"], F.max("open").alias("open")), "band-classes")
    copies = bands_of.where("n > 1").select(*full)
    done = found.where("open").join(copies, full, "left_semi").select("tid", F.col("a").alias("lo"), F.col("e").alias("hi"))
    # a band whose bytes stand twice stays as a partner of others, by one of its copies
    rest = bands_of.select("gram", "r.*", (F.col("open") & (F.col("n") == 1)).alias("open"))
    shared = rest.groupBy(*key).agg(F.count("*").alias("n"), F.max("open").alias("any")).where("n > 1 AND any").select(*key)
    wanted = rest.join(shared, key, "left_semi").groupBy("tid").agg(*[F.collect_list(c).alias(f"{c}s") for c in ("gram", "a", "e", "open")])

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = xxhash.xxh3_64_intdigest
        for b in _slices(batches, lambda b: (int((e - a + 1).sum()) for a, e in zip(b["as"], b["es"])), ENTRIES):
            ids, sizes, grams, opens, places, hashes = [], [], [], [], [], []
            for tid, data, gram, first, last, is_open in zip(b["tid"].tolist(), b["data"], *(b[c] for c in ("grams", "as", "es", "opens"))):
                n = last - first + 1
                p = [p for a, e in zip(first.tolist(), last.tolist()) for p in range(a, e + 1)]
                ids.append(tid)
                sizes.append(len(p))
                grams.append(np.repeat(gram, n))
                opens.append(np.repeat(is_open.astype(bool), n))
                places.append(np.array(p))
                hashes.append(np.array([h(data[x: x + window]) for x in p], dtype=np.uint64).view(np.int64))
            if ids:
                yield pd.DataFrame({"gram": np.concatenate(grams), "hash": np.concatenate(hashes), "tid": np.repeat(ids, sizes),
                                    "p": np.concatenate(places), "open": np.concatenate(opens)})

    seen = _step(texts.join(wanted, "tid").mapInPandas(windows, "gram long, hash long, tid long, p int, open boolean"), "windows")
    twice = seen.groupBy("gram", "hash").agg(F.count("*").alias("n")).where("n > 1").select("gram", "hash")
    same = seen.where("open").join(twice, ["gram", "hash"], "left_semi").select("tid", F.col("p").alias("lo"), F.col("p").alias("hi"))
    merged = _step(whole.unionByName(done).unionByName(same), "merged")
    release(texts.sparkSession, cells, classes, found, bands_of, seen)
    return merged


def _step(df: DataFrame, name: str) -> DataFrame:
    """Materialise, and let go of the shuffle files that led here."""
    df = materialize(df, name)
    release(df.sparkSession)
    return df


def repeated_windows(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Rows (tid, data: bytes; equal texts have equal tids) -> ((tid, lo, hi): starts of repeated windows, texts with a repeated gram)."""
    spark = texts.sparkSession
    grams = _step(_gram_rows(texts, window, gram), "grams")
    # written first: an aggregate in the stage of its join would keep all rows of a frequent gram in one task
    often = _step(grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "often")
    found = grams.join(often, "gram", "left_semi").groupBy("tid").agg(F.collect_set("gram").alias("grams"))  # at most a text's anchors
    found = _step(found, "repeated-grams")
    release(spark, grams, often)
    some = small_side(found.select("tid"), row_bytes=8)
    own = texts.join(some, "tid", "left_semi").dropDuplicates(["tid"]).join(found, "tid")
    own = _step(own, "texts")
    parsed = _step(_parse(own, window, gram), "parsed")
    release(spark, found)
    data = own.select("tid", "data")
    order = sampled_order(parsed, rounds)
    settled = adjacent_repeats(parsed, order, window)
    release(spark, order)
    cells = _step(_open_cells(parsed, settled), "cells")
    release(spark, parsed)
    merged = _merge(cells, data, window)
    release(spark, cells)
    return settled.unionByName(merged), data


def _with_tid(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``tid``: a 64-bit name of the text that no other text has.

    The name is a hash. Texts are told apart by it and a second hash of another
    seed, 128 bits together; where two share a name, all but the one of the
    smallest second hash get another, until none do. At 10 ** 10 texts a few
    pairs are expected, so the renamed ones are few."""
    digest = F.xxhash64(F.lit(1), F.col("data"))
    tid = F.xxhash64("data")
    for _ in range(8):
        named = rows.select(tid.alias("tid"), digest.alias("other"))
        shared = named.groupBy("tid").agg(F.min("other").alias("low"), F.max("other").alias("high")).where("low < high")
        shared = shared.select("tid", "low").limit(RENAMED + 1).collect()
        if not shared:
            return rows.withColumn("tid", tid)
        if len(shared) > RENAMED:
            raise ValueError("too many texts share a 64-bit hash")
        keep = F.create_map(*[F.lit(x) for r in shared for x in (r["tid"], r["low"])])
        tid = F.when(keep[tid].isNotNull() & (keep[tid] != digest), F.xxhash64(digest, tid)).otherwise(tid)
    raise ValueError("texts keep sharing 64-bit hashes")


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                 rounds: int = ROUNDS, with_text: bool = False) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept]``.

    Texts are UTF-8 bytes; NULL is empty. A text that stands twice (repeated
    rows too) loses all its bytes if it has a window's length. ``spans`` are
    the removed (start, end) byte ranges, ``kept`` the bytes that stay.
    Strings are judged on the input, not on what is left. Texts shorter than
    a window keep all. NULL ids are kept; other columns are not read. Empty
    table: empty result."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = _with_tid(docs.select(F.col(doc_id).alias("doc_id"), raw.alias("data")))
    texts = rows.select("tid", "data").where(F.octet_length("data") >= window)
    repeats, own = repeated_windows(texts, window, gram, rounds)
    ranges = repeats.groupBy("tid").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))  # at most a text's windows

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, lambda b: map(len, b["data"]), TEXT_BYTES):
            out = []
            for tid, data, los, his in zip(b["tid"].tolist(), b["data"], b["los"], b["his"]):
                gone = _union(los.tolist(), (his + window - 1).tolist())
                kept, upto = [], 0
                for a, e in gone:
                    kept.append(data[upto:a])
                    upto = e + 1
                kept.append(data[upto:])
                left = b"".join(kept)
                out.append((tid, len(data) - len(left), len(gone), hashlib.sha256(left).hexdigest(),
                            [{"start": a, "end": e + 1} for a, e in gone] if with_text else [], left if with_text else b""))
            yield pd.DataFrame(out, columns=["tid", "n_removed", "n_spans", "sha", "spans", "kept"])

    done = own.join(ranges, "tid").mapInPandas(cut, "tid long, n_removed long, n_spans long, sha string, "
                                                    "spans array<struct<start: long, end: long>>, kept binary")
    done = materialize(done, "removed")
    release(docs.sparkSession, repeats, own)
    twice = materialize(rows.groupBy("tid").agg(F.count("*").alias("n")).where("n > 1").select(F.col("tid").alias("t")), "copies")
    full = rows.select("doc_id", "tid", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("own_sha"),
                       *[F.col("data")] * with_text)
    full = full.join(done, "tid", "left").join(twice, F.col("tid") == F.col("t"), "left")
    gone = F.col("t").isNotNull() & (F.col("n_bytes") >= window)
    none = F.sha2(F.lit(b""), 256)
    out = full.select("doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                      F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                      F.when(gone, none).otherwise(F.coalesce("sha", "own_sha")).alias("kept_sha256"),
                      *([F.when(gone, F.expr("array(struct(0L AS start, n_bytes AS end))")).otherwise(F.col("spans")).alias("spans"),
                         F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", "data")).alias("kept")] if with_text else []))
    return out

"""SimHash near-dedup with Golay-code keys.

A text's fingerprint has 64 bits. Two fingerprints are linked if at most
``MAX_BITS`` (4) bits differ. Candidates come from keys made of two parts:

* The 64 bits are cut into ``4 + z`` blocks. At most 4 blocks hold an error,
  so some choice of ``z`` blocks agrees exactly.
* The other bits fit two segments of at most 23 bits; one of them holds at
  most 2 of the 4 errors (pigeonhole). Each segment is read as a word of the
  binary (23, 12) Golay code and gives the indices of all codewords within
  distance 4: one or six. Two words at distance 2 or less have a word between
  them at distance 1 of both at most, whose nearest codeword is within 3
  (the code is perfect), so it is within 4 of both: they share an index.

So no link is lost. A bucket is (choice of blocks, their bits, segment,
codeword index). Buckets are joined and verified in two steps, neither of
which emits all pairs of a group: first every member is compared with the
bucket's smallest fingerprint (buckets of two or three, the random ones, are
compared whole, from aggregates alone) and the links are united; then only
members of different components are compared with each other. Equal fingerprints are one
row throughout. ``z`` grows with the number of distinct fingerprints, which
keeps the random share of a bucket small; results are the same for any ``z``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import free_memory, materialize, release, small_side, temp_name
from rankforge.llm.components import components

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints that one task makes keys of, about.
KEYED = 20_000

#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash: bit i is set if bit i is set in over half the shingle hashes (no words: 0)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - k + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64) if n < 64 else _bit_counts(octets)
    return int(sum(1 << i for i in np.flatnonzero(2 * bits > n).tolist()))


@lru_cache(maxsize=1)
def _octet_bits() -> np.ndarray:
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _bit_counts(octets: np.ndarray) -> np.ndarray:
    """Set bits per bit place, through a histogram of each byte place."""
    return np.concatenate([np.bincount(octets[:, j], minlength=256) @ _octet_bits() for j in range(8)])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, *more: Column) -> DataFrame:
    """(doc_id, fp[, more]): the fingerprint as a signed 64-bit integer."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(x, k) for x in s], dtype=np.uint64).view(np.int64))
            free_memory()

    return docs.select(F.col(doc_id).alias("doc_id"), fp(F.col(text)).alias("fp"), *more)


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each 23-bit word's low 12 and high 11 bits, error patterns of weight <= 4 per syndrome, -1 padded)."""
    def syndrome(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= GOLAY << (i - 11)
        return x

    unit = [syndrome(1 << i) for i in range(23)]
    of = np.zeros((2, 4096), dtype=np.int64)
    for i in range(23):
        half, bit = divmod(i, 12)
        rows = np.arange(4096)
        of[half] ^= np.where(rows >> bit & 1, unit[i], 0)
    patterns: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for where in combinations(range(23), weight):
            s = 0
            for i in where:
                s ^= unit[i]
            patterns[s].append(sum(1 << i for i in where))
    width = max(map(len, patterns))
    return of, np.array([p + [-1] * (width - len(p)) for p in patterns], dtype=np.int64)


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of every codeword within distance 4 of each 23-bit word; a codeword's index is its upper 12 bits."""
    of, patterns = golay_tables()
    errors = patterns[of[0][words & 4095] ^ of[1][words >> 12]]
    row, col = np.nonzero(errors >= 0)
    return row, (words[row] ^ errors[row, col]) >> 11


def layout(z: int) -> list[tuple[list[int], list[list[int]]]]:
    """For each choice of ``z`` out of ``4 + z`` blocks: the exact bit places, and two segments of the other places."""
    cuts = np.linspace(0, 64, MAX_BITS + z + 1).astype(int)
    blocks = [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]
    out = []
    for exact in combinations(range(len(blocks)), z):
        rest = [i for j, b in enumerate(blocks) if j not in exact for i in b]
        segments = [rest[0::2][:23], rest[1::2][:23]]  # places left out only widen the buckets
        out.append(([i for j in exact for i in blocks[j]], segments))
    return out


def _gather(fp: np.ndarray, places: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), dtype=np.int64)
    for j, i in enumerate(places):
        out |= ((fp >> np.uint64(i)) & np.uint64(1)).astype(np.int64) << j
    return out


def bucket_keys(fp: np.ndarray, z: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every bucket of each fingerprint (unsigned 64-bit)."""
    rows, keys = [], []
    for c, (exact, segments) in enumerate(layout(z)):
        head = _gather(fp, exact)
        for s, places in enumerate(segments):
            row, index = codeword_indices(_gather(fp, places))
            rows.append(row)
            keys.append(((head[row] << 12 | index) * 2 + s) * 64 + c)
    return np.concatenate(rows), np.concatenate(keys)


def exact_blocks(n: int) -> int:
    """``z`` for ``n`` distinct fingerprints: about 2^(25, 33, 40) buckets per choice."""
    return 1 if n < 1 << 22 else 2 if n < 1 << 30 else 3


def links(fps: DataFrame, z: int | None = None) -> DataFrame:
    """Distinct fingerprints (fp: long) -> (node, root): components of links of 4 bits or fewer."""
    fps = materialize(fps.select("fp").distinct(), "fps")
    n = fps.count()
    z = z or exact_blocks(n)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 4096):
                fp = b["fp"].to_numpy()[i: i + 4096]
                row, key = bucket_keys(fp.view(np.uint64), z)
                yield pd.DataFrame({"key": key, "fp": fp[row]})
            free_memory()

    # a fingerprint has dozens of keys: a small table of fingerprints is dealt out first
    members = fps.repartition(n // KEYED + 1, "fp").mapInPandas(keys, "key long, fp long")
    shared = materialize(members.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("pivot"), F.max("fp").alias("top"),
                                                    F.bit_xor("fp").alias("x")).where("n > 1"), "shared")
    # two or three members are known from the bucket's smallest, largest and sum modulo 2
    mid = F.col("pivot").bitwiseXOR(F.col("top")).bitwiseXOR(F.col("x"))
    few = shared.where("n <= 3").select("n", "pivot", "top", mid.alias("mid"))
    pairs = few.select(F.col("top").alias("u"), F.col("pivot").alias("v")).unionByName(
        few.where("n = 3").select(F.col("mid").alias("u"), F.col("pivot").alias("v"))).unionByName(
        few.where("n = 3").select(F.col("top").alias("u"), F.col("mid").alias("v")))
    # members of larger buckets are compared with the smallest
    members = materialize(members.join(shared.where("n > 3").select("key", "pivot"), "key"), "buckets")
    pairs = pairs.unionByName(members.where("fp != pivot").select(F.col("fp").alias("u"), F.col("pivot").alias("v")))
    first = materialize(pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).distinct(), "links")
    release(fps.sparkSession, shared)
    comp = components(first)
    named = (members.select("key", "fp").join(comp, F.col("fp") == F.col("node"), "left")
             .select("key", "fp", F.coalesce("root", "fp").alias("root")))
    whole = materialize(named, "named")
    split = whole.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key")
    named = materialize(whole.join(split, "key"), "split")  # buckets whose members aren't all united yet
    release(fps.sparkSession, members, whole)
    a, b = named.alias("a"), named.alias("b")
    more = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (F.col("a.root") != F.col("b.root"))
                   & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MAX_BITS))
            .select(F.col("a.root").alias("u"), F.col("b.root").alias("v")).distinct())
    more = materialize(more, "links")
    over = components(more)
    top = comp.join(over.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left") \
        .select("node", F.coalesce("top", "root").alias("root"))
    alone = over.join(comp.select("node"), "node", "left_anti")
    out = materialize(top.unionByName(alone), "components")
    release(fps.sparkSession, fps, named, first, more, comp, over)
    return out


def _names(of: DataFrame, z: int | None = None) -> DataFrame:
    """Rows (doc_id, fp) -> (fp, root, component_id): each fingerprint's component and the component's smallest doc_id."""
    low = materialize(of.groupBy("fp").agg(F.min("doc_id").alias("low")), "fps")
    comp = links(low, z)
    named = low.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return materialize(named.join(least, "root").select("fp", "root", "component_id"), "names")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS,
                    z: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest doc_id reachable over links, its own included.

    NULL and word-less texts have fingerprint zero and link like any other.
    NULL ids take part in links but never name a component (a component of
    NULL ids only has component_id NULL). Repeated rows are returned as often
    as they stand. Empty table: empty result."""
    of = materialize(fingerprints(docs, doc_id, text, k), "fingerprints")
    return of.join(_names(of, z), "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: one of its smallest id; columns unchanged.

    A row is known by its id and its text's hash, so rows of one id, or of
    none, fall or stay each with its own component. Of rows that repeat the
    smallest id one stays: that of the least hash, of equal texts whichever. A
    row without an id stays only if no row of its component has an id, and
    then one does. Only ids and hashes travel: the list of those to drop is
    broadcast if small, else joined."""
    i, h = temp_name("i"), temp_name("h")
    key = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    of = materialize(fingerprints(docs, doc_id, text, SHINGLE_WORDS, key.alias("h")), "fingerprints")
    found = materialize(of.join(_names(of), "fp").select("doc_id", "h", "root", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("own")), "rows")
    own = found.where("own")
    # components with several rows of their smallest id, or without any id
    several = small_side(materialize(own.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root"), "several"))
    own = materialize(own.join(several, "root", "left_semi"), "own")
    least = small_side(materialize(own.groupBy("root").agg(F.min("h").alias("least")), "least"))
    own = own.join(least, "root")
    gone = found.where("not own").select("doc_id", "h").unionByName(own.where("h != least").select("doc_id", "h")).distinct()
    twice = own.where("h = least").groupBy("doc_id", "h").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "h")
    gone, twice = (small_side(materialize(x.select(F.col("doc_id").alias(i), F.col("h").alias(f"{h}_")), "ids")) for x in (gone, twice))
    same = F.col(doc_id).eqNullSafe(F.col(i)) & (F.col(h) == F.col(f"{h}_"))
    rest = docs.withColumn(h, key).join(gone, same, "left_anti")
    return (rest.join(twice, same, "left_anti").unionByName(rest.join(twice, same, "left_semi").dropDuplicates([doc_id, h])).drop(h))

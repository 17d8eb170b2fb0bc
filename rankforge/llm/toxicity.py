"""Toxicity by weak supervision.

1. Lexicon: words that labelled toxic rows hold far more often than labelled
   clean ones, by document frequencies over at most ``LABELLED_ROWS`` labelled
   training rows.
2. Voters: ``LEXICON_VOTERS`` lexicon voters (the lexicon dealt out by rank, so
   that each holds strong and weak words) and pattern voters. Each votes or abstains.
3. Label model: a generative model of the votes given the hidden class, with
   the voters' accuracies and their correlations (each voter depends on the
   class and on one other voter, the tree of largest conditional mutual
   information). It is fitted by expectation maximisation over the counts of
   vote patterns of all documents, with the training labels as known classes. ``VOTERS``
   voters have at most 2 ** VOTERS patterns, so the counts are small whatever
   the corpus.
4. Classifier: logistic regression from word and pattern features to the
   posterior labels that the votes alone give, on a bounded sample of all
   documents, labelled or not: ``TRAIN_ROWS`` rows, half of them with a vote
   and half without (as far as there are), weighted back to their shares.

Votes and features come from one pass over the whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import materialize, small_side

LEXICON_VOTERS = 6
#: Bounds of what is fitted: labelled rows read for the lexicon, candidate words, lexicon words, rows of the classifier's sample.
LABELLED_ROWS, CANDIDATES, LEXICON_WORDS, TRAIN_ROWS = 40_000, 20_000, 256, 20_000
#: A word enters the lexicon if this many toxic training rows hold it, with this ratio of its rates in toxic and clean rows.
MIN_ROWS, MIN_RATIO = 4, 20.0
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")

# Pattern voters.
PATTERNS = (
    ("shouting", re.compile(r"!{2,}|\?{2,}")),
    ("address", re.compile(r"\b(?:you|your|u)\b[^.!?\n]{0,40}\b(?:are|suck|should|will)\b", re.I)),
    ("threat", re.compile(r"\b(?:kill|die|hurt|destroy|shut up|get lost)\b", re.I)),
    ("masked", re.compile(r"\b[A-Za-z]+[*#@$]{2,}[A-Za-z]+\b")),
)
VOTERS = LEXICON_VOTERS + len(PATTERNS) + 2  # two more: two lexicon words or more, mostly capitals


def is_training(doc_id) -> F.Column:
    """Rows whose labels may be used: CRC-32 of the id as text, modulo 4, is not 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def _word_counts(rows: DataFrame, among: list[str] | None) -> DataFrame:
    """(word, n): rows whose text ``t`` holds a word; counted per batch before the shuffle."""
    wanted = None if among is None else set(among)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n: Counter = Counter()
            for t in b["t"]:
                own = set(_WORD.findall((t or "").lower()))
                n.update(own if wanted is None else own.intersection(wanted))
            yield pd.DataFrame({"word": pd.Series(list(n.keys()), dtype=object), "n": pd.Series(list(n.values()), dtype="int64")})

    return rows.select("t").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(train: DataFrame, text: str = "text", toxic: str = "toxic") -> list[str]:
    """At most ``LEXICON_WORDS`` words of the labelled rows, strongest first.

    The words of the toxic rows are counted first; the clean rows are read for those only."""
    rows = train.select(F.col(text).alias("t"), F.col(toxic).cast("int").alias("y"))
    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos:
        return []
    often = _word_counts(rows.where("y = 1"), None).where(F.col("n") >= MIN_ROWS).orderBy(F.desc("n"), "word").limit(CANDIDATES)
    bad = {r["word"]: r["n"] for r in often.collect()}
    good = {r["word"]: r["n"] for r in _word_counts(rows.where("y = 0"), list(bad)).collect()}
    ratio = {t: (n / pos) / ((good.get(t, 0) + 0.5) / (neg + 1)) for t, n in bad.items()}
    best = sorted((t for t in bad if ratio[t] >= MIN_RATIO), key=lambda t: (-ratio[t] * bad[t], t))
    return best[:LEXICON_WORDS]


def features(docs: DataFrame, words: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, votes: bits of the voters that fire, words: indices of the lexicon words held, n_words)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    place = {t: i for i, t in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes, held, sizes = [], [], []
            for t in b.column(1):
                t = t.as_py() or ""
                ws = _WORD.findall(t.lower())
                own = sorted(place[x] for x in set(ws).intersection(place))
                v = 0
                for i in own:
                    v |= 1 << i % LEXICON_VOTERS
                for j, (_, p) in enumerate(PATTERNS):
                    v |= (p.search(t) is not None) << (LEXICON_VOTERS + j)
                v |= (len(own) > 1) << (VOTERS - 2)
                letters = sum(map(len, ws))
                v |= (letters > 20 and sum(map(str.isupper, t)) > 0.5 * letters) << (VOTERS - 1)
                votes.append(v)
                held.append(own)
                sizes.append(len(ws))
            # the ids pass through as they came
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(votes, pa.int32()), pa.array(held, pa.list_(pa.int32())), pa.array(sizes, pa.int64())],
                                             names=["doc_id", "votes", "words", "n_words"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, votes int, words array<int>, n_words long")


class LabelModel:
    """P(class, votes) = P(class) * prod P(vote | class, vote of its parent), fitted by EM over weighted patterns."""

    def __init__(self, votes: np.ndarray, label: np.ndarray, count: np.ndarray, rounds: int = 25):
        """``label``: 1, 0, or -1 where unknown."""
        x = (votes[:, None] >> np.arange(VOTERS) & 1).astype(int)
        count = count.astype(float)
        known = label >= 0
        strong = x[:, :LEXICON_VOTERS].any(axis=1)
        if not strong.any():  # no lexicon: two patterns or more
            strong = x[:, LEXICON_VOTERS:].sum(axis=1) > 1
        start = 0.02 + 0.93 * strong
        q = np.where(known, label, start)
        self.parent = np.full(VOTERS, -1)
        for r in range(rounds):
            if r in (1, 5):
                self.parent = self._tree(x, q, count)
            self._fit(x, q, count)
            new = np.where(known, label, self._posterior(x))
            if r > 6 and np.abs(new - q).max() < 1e-7:
                break
            q = new
        #: Share of votes that hit their class, and coverage, per voter: P(class 1 | vote), P(vote).
        fired = count[:, None] * x
        self.accuracy = (fired * q[:, None]).sum(axis=0) / np.maximum(fired.sum(axis=0), 1e-9)
        self.coverage = fired.sum(axis=0) / count.sum()

    @staticmethod
    def _tree(x: np.ndarray, q: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Maximum spanning tree of the voters by mutual information given the class."""
        info = np.zeros((VOTERS, VOTERS))
        for y in (0, 1):
            w = count * (q if y else 1 - q)
            total = w.sum() + 1e-9
            p1 = (w @ x) / total
            both = (x * w[:, None]).T @ x / total
            for a in (0, 1):
                for b in (0, 1):
                    pa, pb = (p1 if a else 1 - p1)[:, None], (p1 if b else 1 - p1)[None, :]
                    pab = both if a and b else (p1[:, None] - both if a else (p1[None, :] - both if b else 1 - p1[:, None] - p1[None, :] + both))
                    ok = (pab > 1e-12) & (pa * pb > 1e-12)
                    info += total / count.sum() * np.where(ok, pab * np.log(np.where(ok, pab / np.maximum(pa * pb, 1e-12), 1)), 0)
        parent, inside = np.full(VOTERS, -1), [0]
        while len(inside) < VOTERS:
            out = [j for j in range(VOTERS) if j not in inside]
            i, j = max(((i, j) for i in inside for j in out), key=lambda e: info[e])
            parent[j] = i
            inside.append(j)
        return parent

    def _fit(self, x: np.ndarray, q: np.ndarray, count: np.ndarray) -> None:
        self.prior = float((count * q).sum() + 1) / (count.sum() + 2)
        self.table = np.zeros((2, VOTERS, 2))  # P(vote = 1 | class, voter, parent's vote)
        up = np.where(self.parent[None, :] >= 0, x[:, self.parent], 0)
        for y in (0, 1):
            w = (count * (q if y else 1 - q))[:, None]
            for a in (0, 1):
                m = w * (up == a)
                self.table[y, :, a] = ((m * x).sum(axis=0) + 0.5) / (m.sum(axis=0) + 1)

    def _posterior(self, x: np.ndarray) -> np.ndarray:
        up = np.where(self.parent[None, :] >= 0, x[:, self.parent], 0)
        score = []
        for y, p in ((0, 1 - self.prior), (1, self.prior)):
            t = np.where(up == 1, self.table[y, :, 1], self.table[y, :, 0])
            score.append(np.log(p) + np.log(np.where(x == 1, t, 1 - t)).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self._posterior((votes[:, None] >> np.arange(VOTERS) & 1).astype(int))


def design(votes: np.ndarray, held: list, n_words: np.ndarray, size: int) -> np.ndarray:
    """Classifier features: lexicon words held, how many, how dense, pattern votes, a constant."""
    x = np.zeros((len(votes), size + VOTERS - LEXICON_VOTERS + 3))
    for i, own in enumerate(held):
        x[i, list(own)] = 1
    many = x[:, :size].sum(axis=1)
    x[:, size: size + VOTERS - LEXICON_VOTERS] = votes[:, None] >> np.arange(LEXICON_VOTERS, VOTERS) & 1
    x[:, -3], x[:, -2], x[:, -1] = np.log1p(many), np.log1p(100 * many / np.maximum(n_words, 1)), 1
    return x


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on soft labels of weighted rows, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (target - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Only labels of training rows are read (``is_training``); labels other than
    0 and 1 and NULL ids are passed over, an id labelled twice counts once
    (toxic if either says so). NULL and empty texts are scored as texts
    without words. Without a lexicon word the patterns are scored alone;
    without a toxic training label every score is 0. Repeated
    rows get the same score; other columns are not read."""
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isin(0, 1) & is_training(F.col(doc_id)))
             .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(toxic).cast("int")).alias("y")))
    known = small_side(materialize(known, "labels"), row_bytes=16)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    share = min(1.0, LABELLED_ROWS / max(1, known.count()))
    some = known.where(F.crc32(F.concat(F.lit("l"), F.col("doc_id").cast("string")).cast("binary")) <= int(share * (1 << 32)))
    words = lexicon(own.join(small_side(materialize(some, "labels"), row_bytes=16), "doc_id").select("text", F.col("y").alias("toxic")))
    rows = materialize(features(own, words).join(known, "doc_id", "left"), "features")
    held_out = F.coalesce(~is_training(F.col("doc_id")), F.lit(False))
    patterns = rows.groupBy("votes", F.coalesce("y", F.lit(-1)).alias("y")).agg(F.count("*").alias("n")).toPandas()  # <= 3 * 2 ** VOTERS
    if not (patterns["y"] == 1).any():
        return rows.select("doc_id", held_out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    model = LabelModel(patterns["votes"].to_numpy(), patterns["y"].to_numpy(), patterns["n"].to_numpy())
    voted = F.col("votes") != 0
    count = {v: int(patterns.loc[(patterns["votes"] != 0) == v, "n"].sum()) for v in (True, False)}
    # half of the sample from each kind; a kind of fewer rows leaves its place to the other
    want = {v: max(TRAIN_ROWS // 2, TRAIN_ROWS - count[not v]) for v in count}
    draw = F.crc32(F.concat_ws("|", F.lit("s"), F.col("doc_id").cast("string"), "votes", "n_words").cast("binary"))
    cut = F.when(voted, min(1.0, want[True] / max(1, count[True])) * (1 << 32)).otherwise(min(1.0, want[False] / max(1, count[False])) * (1 << 32))
    sample = rows.where(draw < cut).orderBy("doc_id").limit(TRAIN_ROWS + TRAIN_ROWS // 10).toPandas()
    votes = sample["votes"].to_numpy()
    x = design(votes, list(sample["words"]), sample["n_words"].to_numpy(), len(words))
    drawn = {v: max(1, int(((votes != 0) == v).sum())) for v in count}
    share = np.where(votes != 0, count[True] / drawn[True], count[False] / drawn[False])
    weights = logistic(x, model.posterior(votes), share * len(votes) / max(1, sum(count.values())))
    size = len(words)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = design(b.column(1).to_numpy(), b.column(2).to_pylist(), b.column(3).to_numpy(), size) @ weights
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "votes", "words", "n_words").mapInArrow(score, f"doc_id {kind}, score double")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

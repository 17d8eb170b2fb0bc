"""Template matches, labels and score of the license scan against regular expressions over the words of a text."""

import random

import regex
from pyspark.sql import functions as F

from rankforge.llm import licenses

SMALL = "/root/testdata/sf0.001"
SHORT = {k: t for k, t in licenses.TEMPLATES.items() if k not in licenses.TEXTS}


def pattern(template):
    """The template as an expression over words that each end in one blank."""
    out = ""
    for part in regex.split(r"(<<.*?>>)", template):
        if part == "<<beginOptional>>":
            out += "(?:"
        elif part == "<<endOptional>>":
            out += ")?"
        elif part.startswith("<<var;words="):
            low, high = part[12:-2].split("-")
            out += f"(?:[^ ]+ ){{{low},{high}}}"
        else:
            out += "".join(regex.escape(w) + " " for w in part.split())
    return regex.compile(out, regex.POSIX)  # the longest match at a place


def spans_by_hand(text, rules):
    words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", regex.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    line, at, starts = "".join(w + " " for w in words), 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = {s: i for i, s in enumerate([*starts, at])}
    return len(words), {(label, i, ends[m.end()]) for label, p in rules for i, s in enumerate(starts) if (m := p.match(line, s))}


def written(template, rng):
    """A text of the template: regions in or out, replaceable words also one too few or too many, now and then a wrong word."""
    out, open_, dropped = [], 0, 0
    for part in regex.split(r"(<<.*?>>)", template):
        if part == "<<beginOptional>>":
            open_ += 1
            dropped = dropped or (open_ if rng.random() < 0.5 else 0)
        elif part == "<<endOptional>>":
            dropped = 0 if dropped == open_ else dropped
            open_ -= 1
        elif not dropped and part.startswith("<<var;words="):
            low, high = map(int, part[12:-2].split("-"))
            out += [rng.choice(["software", "the", "license", "work", "é"]) for _ in range(rng.randint(max(0, low - 1), high + 1))]
        elif not dropped:
            out += part.split()
    if rng.random() < 0.3:
        out[rng.randrange(len(out))] = "other"
    return out


def test_labels_spans_and_score_equal_regular_expressions(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        for ts in SHORT.values():
            for t in ts:
                words = ["Before"] * rng.randint(0, 2) + written(t, rng) + ["after"] * rng.randint(0, 2) + written(t, rng) * rng.randint(0, 1)
                texts.append("".join((w.upper() if rng.random() < 0.2 and w.isascii() else w) + rng.choice([" ", ", ", "\n", " (", "."]) for w in words))
    made = spark.createDataFrame([(-1 - i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    docs = made.unionByName(spark.read.parquet(f"{SMALL}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    rules = [(label, pattern(t)) for label, ts in SHORT.items() for t in ts] + [(label, pattern(p)) for p, label in licenses.PHRASES.items()]
    got = licenses.scan_licenses(docs, templates=SHORT).collect()
    assert len(got) == len(rows) > 300
    matched = 0
    for r in got:
        n, want = spans_by_hand(rows[r.doc_id], rules)
        assert {(s.label, s["first"], s.end) for s in r.spans} == want, rows[r.doc_id]
        assert r.n_words == n and r.labels == ",".join(sorted({label for label, _, _ in want}))
        covered = {i for _, a, e in want for i in range(a, e)}
        assert r.score == (len(covered) / n if n else 0.0)
        matched += bool(want)
    assert matched > 100  # enough of both kinds

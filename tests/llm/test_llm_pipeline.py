"""The pipeline against its stages worked out by hand on small documents."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from rankforge.llm import quality
from rankforge.llm.common import materialize
from rankforge.llm.queries import import_path
from test_llm_operators import check_packs, fingerprint_by_hand, groups_by_hand

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    import_path(spark)
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, f in P.STAGES:
        docs = materialize(f(spark, docs, SMALL), name)
        out.append(docs)
    return [spark.read.parquet(f"{SMALL}/documents.parquet"), *out]


def as_map(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order(staged):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "source_mix", "packing"]
    for df in staged[:-1]:
        assert sorted(df.columns) == sorted(P.COLUMNS)
    for df in staged[1:-1]:
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality_stage(staged):
    want = {r.doc_id: quality.judge(r.text) for r in staged[0].collect()}
    got = as_map(staged[1])
    assert set(got) == {i for i, v in want.items() if v[6]} and 0 < len(got) < len(want)
    texts = as_map(staged[0])
    assert all(got[i].text == "\n".join(x for k, x in enumerate(texts[i].text.split("\n")) if k not in want[i][8]) for i in got)


def test_line_stage(staged):
    docs, got = as_map(staged[1]), as_map(staged[2])
    pages = Counter(r.source for r in docs.values())
    held = Counter((r.source, x) for r in docs.values() for x in set(r.text.split("\n")) if x.strip())
    bad = {k for k, n in held.items() if n >= 5 and n > 0.08 * pages[k[0]]}
    assert {i: r.text for i, r in got.items()} == {
        i: "\n".join(x for x in r.text.split("\n") if (r.source, x) not in bad) for i, r in docs.items()}


def test_simhash_stage(staged):
    rows = staged[2].orderBy("doc_id").collect()
    comp = groups_by_hand([fingerprint_by_hand(r.text) for r in rows], [r.doc_id for r in rows])
    assert sorted(as_map(staged[3])) == sorted(set(comp)) and staged[3].count() == len(set(comp)) < len(rows)


def test_mix_and_packing_stages(staged):
    docs, copies = as_map(staged[3]), Counter(r.doc_id for r in staged[4].collect())
    assert set(copies) <= set(docs) and max(copies.values()) <= 2
    words, taken = defaultdict(int), defaultdict(int)
    for i, r in docs.items():
        words[r.source] += len(r.text.split())
        taken[r.source] += copies[i] * len(r.text.split())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(words.values()), rel=0.1)
    pieces = staged[5].collect()
    first, seen = [], Counter()
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start, r.sequence_id, r.offset)):
        seen[r.doc_id, r.start] += 1
        if seen[r.doc_id, r.start] == 1:
            first.append(r)
    assert all(n == copies[i] for (i, _), n in seen.items()) and {i for i, _ in seen} == set(copies)
    by_seq = defaultdict(int)
    for r in pieces:
        by_seq[r.sequence_id] += r.length
    assert max(by_seq.values()) <= 4096 and sum(by_seq.values()) >= 0.95 * 4096 * len(by_seq)
    assert check_packs  # the ids of each piece are held against the tokenizer in the operator's tests
    by_doc = defaultdict(int)
    for r in first:
        by_doc[r.doc_id] += r.length
    assert all(by_doc[r.doc_id] == r.doc_tokens for r in first)


def test_run_equals_the_stages(spark, staged):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, P.run(spark, SMALL).select(*key).collect())) == sorted(map(tuple, staged[5].select(*key).collect()))


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, f in P.STAGES:
        docs = materialize(f(spark, docs, SMALL), "empty")
        assert docs.count() == 0

"""Registered queries of the subpackage: ``QUERIES`` and ``ORACLE_SQL`` (DuckDB)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import (contamination, forest, licenses, lines, mixing, packing, prefix_trie, quality, simhash, suffixes,
                           token_store, toxicity, whitening)
from rankforge.llm.common import new_folder

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


def import_path(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), root]))


#: Rows of a text table in an Arrow batch, unless the session says otherwise: both sides of a Python step hold whole batches.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for tables of texts, where the session still has Spark's own setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    import_path(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, j, ls[j] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS j FROM w)),
f AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY j) AS nth, length(line) AS n,
        (NOT regexp_matches(line, '[.!?…。！？:;»”’"''」』)\]][\x20\x09-\x0D]*$') AND (len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) < 10 OR NOT regexp_matches(line, '[.!?…。！？,;:，；]')))
        OR 10 * len(regexp_extract_all(line, '[#*$%&|<>]')) > length(line)
        OR len(regexp_extract_all(line, '[|]')) >= 3
        OR (len(regexp_extract_all(line, '[|>›·•]')) >= 2 AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) <= 3 * (len(regexp_extract_all(line, '[|>›·•]')) + 1))
        OR regexp_matches(lower(line), 'all rights reserved|privacy policy|cookie policy|terms of use|terms of service|enable javascript|click here|sign in to|subscribe to our|lorem ipsum|todos los derechos reservados|política de privacidad|política de cookies|aviso legal|iniciar sesión|tous droits réservés|politique de confidentialité|mentions légales|conditions d''utilisation|alle rechte vorbehalten|datenschutzerklärung|nutzungsbedingungen|todos os direitos reservados|tutti i diritti riservati|все права защищены|политика конфиденциальности|版权所有|隐私政策') AS bad
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
s AS (SELECT doc_id, sum(n) AS held, sum(CASE WHEN bad THEN n ELSE 0 END) AS lost, count(CASE WHEN nth > 1 THEN 1 END) AS dups FROM f GROUP BY doc_id),
b AS (SELECT w.doc_id, len(ws) AS n_words, length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        coalesce(held, 0) AS held, coalesce(lost, 0) AS lost
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN s ON s.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= 30 * held AS kept,
  lost::BIGINT AS lost_chars
FROM b""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_stats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_line_dedup", """
WITH l AS (SELECT doc_id, source, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS j, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, source, j, ls[j] AS line FROM l),
h AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
c AS (SELECT source, line, count(DISTINCT doc_id) AS n FROM x WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
b AS (SELECT c.source, c.line FROM c JOIN h ON h.source IS NOT DISTINCT FROM c.source WHERE n >= 5 AND n > pages * 0.08::DOUBLE)
SELECT x.doc_id, coalesce(string_agg(x.line, chr(10) ORDER BY j) FILTER (WHERE b.line IS NULL), '') AS text,
  count(*) AS n_lines, count(b.line) AS n_dropped
FROM x LEFT JOIN b ON b.source IS NOT DISTINCT FROM x.source AND b.line = x.line GROUP BY x.doc_id""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_dropped")


@query("op10_source_mix", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             ('0x' || substr(md5('17:' || doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source),
o AS (SELECT *, 2 * n AS cap, sum(2 * n) OVER k - 2 * n AS caps_before, sum(w) OVER (ORDER BY 2 * n / w DESC, source DESC NULLS FIRST) AS w_from,
        (SELECT 1.5 * sum(n) FROM s) AS total FROM s WINDOW k AS (ORDER BY 2 * n / w, source NULLS LAST)),
-- sources in the order in which they are clamped; the level is that of the first one that isn't
lv AS (SELECT (total - caps_before) / w_from AS level FROM o WHERE (total - caps_before) / w_from * w <= cap ORDER BY cap / w, source NULLS LAST LIMIT 1),
t AS (SELECT source, n::BIGINT AS n, CASE WHEN w * level > cap THEN cap ELSE w * level END AS target FROM o, lv),
p AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM t),
x AS (SELECT d.doc_id, d.size, p.n AS source_size, p.target, p.whole, p.target - p.whole * p.n AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) - d.size / 2.0 AS mid
      FROM d JOIN p ON p.source IS NOT DISTINCT FROM d.source),
y AS (SELECT doc_id, size, source_size, target, (whole + CASE WHEN rest > 0 AND mid <= rest THEN 1 ELSE 0 END)::BIGINT AS repeats FROM x)
SELECT doc_id, size, source_size, target, repeats, size * repeats AS taken FROM y""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


#: The public tokenizer files; callers of the operators give a path.
def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op8_token_store")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-store")
    shards = token_store.write_store(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_store(spark, folder, shards)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op4_embedding_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.drop_repeats(table(spark, sf_dir, "documents"))


@query("op11_decontamination", r"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) AS s WHERE len(w) >= n)),
h AS (SELECT doc_id, dw.n, p, item_id FROM dw JOIN iw ON iw.n = dw.n AND iw.g = dw.g),
k AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained"))).select(
        "vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error")


#: crc32 of a text, byte by byte and bit by bit (reflected polynomial 0xEDB88320).
_CRC = """list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda ch: ascii(ch)::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))"""


@query("op13_prefix_trie", f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor({_CRC.format("conv_id::VARCHAR")}, 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN t ON t.conv_id = c.base AND p <= h
      UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
s AS (SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY own, p) FILTER (WHERE p IS NOT NULL), []) AS path FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
e AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM s),
x AS (SELECT conv_id, depth, path[1 : depth] AS prefix, len(path) = depth AS ends FROM e),
n AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS ended FROM x GROUP BY depth, prefix),
-- every node's parent and every pair of an ancestor and a node below it, by the smallest member
m AS (SELECT n.*, CASE WHEN depth > 0 THEN (n_convs - 1) * length(prefix[depth].text) ELSE 0 END AS saved, prefix[1 : depth - 1] AS up FROM n),
k AS (SELECT up, depth - 1 AS depth, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY up, depth),
f AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k ON k.depth = m.depth AND k.up = m.prefix),
b AS (SELECT a.depth, a.prefix, sum(f.saved) AS saved_tokens, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves
      FROM (SELECT f.*, unnest(range(0, depth + 1)) AS top FROM f) AS f JOIN m AS a ON a.depth = f.top AND a.prefix = f.prefix[1 : f.top] GROUP BY a.depth, a.prefix)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(f.ended, '')) AS ends_sha256
FROM f JOIN b ON b.depth = f.depth AND b.prefix = f.prefix LEFT JOIN m AS p ON p.depth = f.depth - 1 AND f.depth > 0 AND p.prefix = f.up""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.turn_rows(table(spark, sf_dir, "conversations"))))
    ends = prefix_trie.ends_digest(ends)
    return nodes.join(ends, "key", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))

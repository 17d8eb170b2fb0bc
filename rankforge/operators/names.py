"""Names in one form (F1): case, accents and punctuation, and spellings that differ by a few letters.

``canonical_name`` is an expression. ``name_variants`` links canonical names
within an edit distance without comparing all pairs: two names within ``d``
edits share a name that is left of each after deleting ``d`` letters at most,
so every distinct name is sent to the blocks of its deletions and compared
there. Digits are never edited ("unit 12" and "unit 13" are two names): they
are part of the block. Names of one block are one deletion away from the same
text, so a block holds at most alphabet x length distinct names however many
rows use them."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import as_col, null_safe_join
from rankforge.functions.joins import broadcast_if_small
from rankforge.operators.graph import components
from rankforge.session import materialize

#: Letters whose plain form isn't their Unicode base letter.
SPELLED = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i"}


def _accents() -> tuple[str, str]:
    """Lower-case Latin letters with marks and their base letters, from their Unicode decomposition."""
    marked, plain = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        c = chr(code)
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base.isascii() and base.islower():
            marked.append(c)
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accents()


def canonical_name(name: str | Column) -> Column:
    """Lower case, Latin letters without marks, everything but letters and digits as one blank, trimmed; empty: NULL.

    Marks that stand on their own (decomposed text) are dropped. "&" is "and"."""
    x = F.regexp_replace(F.lower(as_col(name).cast("string")), r"\p{M}+", "")
    x = F.translate(x, _MARKED, _PLAIN)
    for letter, spelled in SPELLED.items():
        x = F.replace(x, F.lit(letter), F.lit(spelled))
    x = F.regexp_replace(F.replace(x, F.lit("&"), F.lit(" and ")), r"['’`]", "")
    x = F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))
    return F.when(x != "", x)


def _deletions(name: Column, depth: int) -> Column:
    """The names left after deleting up to ``depth`` characters that are no digits."""
    one = F.array(name)
    for _ in range(depth):
        more = F.flatten(F.transform(one, lambda t: F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest(F.char_length(t), F.lit(1))), lambda i: ~F.rlike(t.substr(i, F.lit(1)), F.lit(r"\p{N}")) & (F.char_length(t) > 0)),
            lambda i: F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.char_length(t))))))
        one = F.array_distinct(F.concat(one, more))
    return one


def name_variants(names: DataFrame, name: str = "canonical", max_distance: int = 1, min_length: int = 5) -> DataFrame:
    """(u, v): distinct names, u > v, with the same digits and an edit distance of at most ``max_distance`` (1 or 2).

    Names of fewer than ``min_length`` characters have no variants. Every such pair is found."""
    if max_distance not in (1, 2):
        raise ValueError("max_distance must be 1 or 2")
    own = names.select(F.col(name).alias("n")).where(F.col("n").isNotNull() & (F.char_length("n") >= min_length)).distinct()
    digits = F.regexp_replace("n", r"[^\p{N}]+", " ")
    keyed = own.select("n", F.explode(_deletions(F.col("n"), max_distance)).alias("key"), digits.alias("digits"))
    keyed = materialize(keyed.select("n", F.xxhash64("key", "digits").alias("key"), "digits"), "blocks")  # a shared hash only adds a comparison
    often = keyed.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    keyed = keyed.join(often, "key", "left_semi")
    other = keyed.select("key", F.col("n").alias("v"), F.col("digits").alias("d"))
    pairs = keyed.join(other, "key").where((F.col("n") > F.col("v")) & (F.col("digits") == F.col("d")))
    return pairs.select(F.col("n").alias("u"), "v").distinct().where(F.levenshtein("u", "v", max_distance) >= 0)


def normalize_names(df: DataFrame, name: str, max_distance: int = 0, min_length: int = 5, out: str = "name") -> DataFrame:
    """``df`` plus ``<out>_canonical``, ``<out>_id`` and ``<out>_label``.

    Rows with the same canonical form have one id; with ``max_distance`` 1 or 2
    so have forms within that edit distance, directly or through others. The id
    is the MD5 of the form that most rows of the group have (ties: the smaller),
    the label the spelling that most rows of the group have (ties: the smaller).
    NULL and empty names have NULLs. Spellings are counted before anything is
    compared, and the ids come back by spelling."""
    spelled = F.col(name).cast("string")
    counts = materialize(df.groupBy(spelled.alias("s")).agg(F.count("*").alias("k")).withColumn("c", canonical_name("s")).where("c IS NOT NULL"), "spellings")
    forms = counts.groupBy("c").agg(F.sum("k").alias("k"))
    if max_distance:
        comp = components(name_variants(forms, "c", max_distance, min_length)).withColumnRenamed("node", "c")
        forms = forms.join(comp, "c", "left")
    else:
        forms = forms.withColumn("root", F.lit(None).cast("string"))
    forms = materialize(forms.withColumn("root", F.coalesce("root", "c")), "forms")
    best = forms.groupBy("root").agg(F.min(F.struct((-F.col("k")).alias("k"), F.col("c").alias("c")))["c"].alias("best"))
    grouped = counts.join(forms.select("c", "root"), "c")
    label = grouped.groupBy("root").agg(F.min(F.struct((-F.col("k")).alias("k"), F.col("s").alias("s")))["s"].alias("label"))
    found = grouped.join(best, "root").join(label, "root").select(
        F.col("s").alias("__s"), F.col("c").alias(f"{out}_canonical"), F.md5(F.col("best").cast("binary")).alias(f"{out}_id"), F.col("label").alias(f"{out}_label"))
    x = df.withColumn("__s", spelled)
    return null_safe_join(x, broadcast_if_small(found, "names"), ["__s"], "left").drop("__s")

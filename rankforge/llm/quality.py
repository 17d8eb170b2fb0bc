"""Quality rules, line first.

Every line with a word is judged on its own; lines that fail are removed, and
a document that loses too much of its text that way is rejected. Base rules on
the whole text (too few words, too many repeated three-word windows) reject it
as well. Each document is judged alone, inside one Arrow batch: no shuffle.

Line rules (a line without a word passes):

* punctuation: the line ends like prose, with one of ``LINE_ENDS`` (a closing
  quote or bracket counts), or it is a stretch of wrapped prose: ``LONG_WORDS``
  words or more with a mark of ``INNER_MARKS`` among them;
* symbols: at most one character in ten is one of ``SYMBOLS``;
* navigation: fewer than ``MENU_BARS`` bars ``|``, and not ``MENU_STEPS`` or more
  of the separators ``SEPARATORS`` with ``STEP_WORDS`` words or fewer a step
  (paths and menus: "Home > Shop > Shoes");
* boilerplate: none of ``BOILERPLATE`` (phrases of seven languages), whatever the case.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import free_memory, temp_name

# Fixed values of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
LINE_ENDS = ".!?…。！？:;»”’\"'」』)]"
INNER_MARKS = ".!?…。！？,;:，；"
LONG_WORDS = 10
SEPARATORS = "|>›·•"
MENU_BARS, MENU_STEPS, STEP_WORDS = 3, 2, 3
BOILERPLATE = (
    "all rights reserved", "privacy policy", "cookie policy", "terms of use", "terms of service",
    "enable javascript", "click here", "sign in to", "subscribe to our", "lorem ipsum",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "aviso legal", "iniciar sesión",
    "tous droits réservés", "politique de confidentialité", "mentions légales", "conditions d'utilisation",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen",
    "todos os direitos reservados", "tutti i diritti riservati",
    "все права защищены", "политика конфиденциальности", "版权所有", "隐私政策")
#: A document is rejected if failing lines hold more than this share of the characters of its lines with a word.
MAX_LOST_PERCENT = 30

_BLANKS = " \t\n\v\f\r"


def line_fails(line: str) -> str | None:
    """The first rule that a line with a word fails, or None."""
    words = len(line.encode("utf-8", "surrogatepass").split())
    if line.rstrip(_BLANKS)[-1] not in LINE_ENDS and (words < LONG_WORDS or not any(c in line for c in INNER_MARKS)):
        return "punctuation"
    if 10 * sum(line.count(c) for c in SYMBOLS) > len(line):
        return "symbols"
    steps = sum(line.count(c) for c in SEPARATORS)
    if line.count("|") >= MENU_BARS or steps >= MENU_STEPS and words <= STEP_WORDS * (steps + 1):
        return "navigation"
    low = line.lower()
    if any(b in low for b in BOILERPLATE):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more in the text."""
    grams = list(zip(words, words[1:], words[2:]))
    seen = Counter(grams)
    if len(seen) == len(grams):
        return 0
    total, upto = 0, 0  # words before upto are counted
    for i, g in enumerate(grams):
        if seen[g] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def judge(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars, failing lines from 0) of a text."""
    t = text or ""
    words = t.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    lines = t.split("\n")
    full = [bool(x.strip(_BLANKS)) for x in lines]
    seen: set[str] = set()
    dup = 0
    for x, f in zip(lines, full):
        if f:
            dup += x in seen
            seen.add(x)
    repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
    fails = [f and line_fails(x) is not None for x, f in zip(lines, full)]
    lost = sum(len(x) for x, b in zip(lines, fails) if b)
    held = sum(len(x) for x, f in zip(lines, full) if f)
    kept = not failed and 100 * lost <= MAX_LOST_PERCENT * held
    return (len(words), len(t) - sum(t.count(c) for c in _BLANKS), sum(t.count(c) for c in SYMBOLS), dup, repeat,
            failed, kept, lost, [i for i, b in enumerate(fails) if b])


_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"]
_TYPE = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, kept boolean, lost_chars long, failing array<int>")


def _judge_all(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in texts:
        yield pd.DataFrame([judge(x) for x in s], columns=[*_STATS, "failing"])
        free_memory()


def quality_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus the statistics and the verdict of each row.

    NULL text: no words, so it fails the base rules. Input columns named like
    an output are replaced. Repeated rows are judged alike; an empty table
    gives an empty result."""
    q = temp_name("q")
    rest = [c for c in docs.columns if c not in _STATS and c != text]
    return docs.select(*rest, F.pandas_udf(_judge_all, _TYPE)(F.col(text)).alias(q)).select(*rest, *[f"{q}.{c}" for c in _STATS])


def clean_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that the rules keep, without their failing lines; columns unchanged.

    Only the numbers of the failing lines come back from Python, not the texts."""
    q = temp_name("q")
    found = docs.withColumn(q, F.pandas_udf(_judge_all, _TYPE)(F.col(text))).where(F.col(f"{q}.kept"))
    failing = F.col(f"{q}.failing")
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(failing, i)), "\n")
    clean = F.when(F.size(failing) == 0, F.col(text)).otherwise(left)
    return found.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])

"""License scan: template-markup matching.

A license notice is a template: wording with two kinds of marked regions,

    <<beginOptional>> ... <<endOptional>>     words that may be left out (may be nested)
    <<var;words=1-6>>                         replaceable: any words, so many of them

Everything else is mandatory. A template is compiled to an automaton over
words; a text is accepted at a place if the mandatory wording stands there
word for word, whatever its case of A-Z, punctuation and line breaks. Each
document is scanned alone, inside one Arrow batch: no shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.license_texts import TEXTS

#: Words: runs of ASCII letters and digits and of everything beyond ASCII (after A-Z were lowered).
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as templates, by label. Public wording of common license notices, and whole license texts ("...-text").
TEMPLATES = {
    "apache-2.0": [
        "<<beginOptional>>this <<var;words=1-3>> is <<endOptional>>licensed under the apache license<<beginOptional>> as published<<endOptional>>"
        " version 2 0<<beginOptional>> the license you may not use this <<var;words=1-3>> except in compliance with the license<<endOptional>>",
    ],
    "gpl-notice": [
        "<<beginOptional>>this <<var;words=1-3>> is <<endOptional>>licensed under the<<beginOptional>> terms of the<<endOptional>>"
        " gnu general public license<<beginOptional>> version <<var;words=1-2>><<endOptional>>",
        "<<var;words=1-4>> is free software you can redistribute it and or modify it under the terms of the gnu general public license"
        "<<beginOptional>> as published by the free software foundation<<endOptional>>",
    ],
    "gpl-3.0": ["gnu general public license<<beginOptional>> as published by the free software foundation either<<endOptional>> version 3"],
    "cc-by-4.0": ["<<beginOptional>>licensed under <<endOptional>><<beginOptional>>a <<endOptional>>cc by 4 0"],
    "cc-by-nc-4.0": ["<<beginOptional>>licensed under <<endOptional>><<beginOptional>>a <<endOptional>>cc by nc 4 0"],
    "mit-notice": [
        "released under the<<beginOptional>> terms of the<<endOptional>> mit license",
        "licensed under the<<beginOptional>> terms of the<<endOptional>> mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this <<var;words=1-12>> to deal in the"
        " <<var;words=1-3>> without restriction",
    ],
    "bsd-notice": [
        "redistribution and use in source and binary forms with or without modification are permitted"
        "<<beginOptional>> provided that the following conditions are met<<endOptional>>",
    ],
    "lgpl-notice": [
        "is free software you can redistribute it and or modify it under the terms of the gnu <<var;words=1-1>> general public license"
        "<<beginOptional>> as published by the free software foundation<<endOptional>>",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "all-rights-reserved": ["<<beginOptional>>copyright <<var;words=1-8>> <<endOptional>>all rights reserved"],
    **{label: [text] for label, text in TEXTS.items()},
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


class Automaton:
    """States 0..n: ``step[s]`` maps a word (None: any word) to next states, ``skip[s]`` lists states reached without a word."""

    def __init__(self, template: str):
        self.step: list[dict] = [defaultdict(list)]
        self.skip: list[list[int]] = [[]]
        opened: list[int] = []
        at = 0
        for kind, low, high, text in self._tokens(template):
            if kind == "beginOptional":
                opened.append(at)
            elif kind == "endOptional":
                if not opened:
                    raise ValueError("endOptional without beginOptional")
                self.skip[opened.pop()].append(at := self._after(at, skip=True))
            elif kind == "var":
                before = []
                for i in range(high):
                    if i >= low:
                        before.append(at)
                    at = self._after(at, None)
                for s in before:
                    self.skip[s].append(at)
            else:
                for w in WORDS.findall(text.translate(_LOWER)):
                    at = self._after(at, w)
        if opened:
            raise ValueError("beginOptional without endOptional")
        self.end = at
        self.begin = self._close({0})
        if self.end in self.begin:
            raise ValueError("a template needs mandatory wording")
        #: Words a match can begin with; None among them: any word.
        self.first = {w for s in self.begin for w in self.step[s]}

    @staticmethod
    def _tokens(template: str):
        at = 0
        for m in _MARK.finditer(template):
            yield "words", 0, 0, template[at: m.start()]
            yield m[1].partition(";")[0], int(m[2] or 0), int(m[3] or 0), ""
            at = m.end()
        yield "words", 0, 0, template[at:]

    def _after(self, state: int, word: str | None = None, skip: bool = False) -> int:
        self.step.append(defaultdict(list))
        self.skip.append([])
        new = len(self.step) - 1
        if skip:
            self.skip[state].append(new)
        else:
            self.step[state][word].append(new)
        return new

    def _close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def match(self, words: list[str], start: int) -> int | None:
        """End of the longest match that begins at ``start``, or None."""
        states, found = self.begin, None
        for i in range(start, len(words)):
            states = self._close({t for s in states for w in (words[i], None) for t in self.step[s].get(w, ())})
            if not states:
                break
            if self.end in states:
                found = i + 1
        return found


class Scanner:
    """All templates at once; a document without any word that one of them cannot do without is passed over."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str]):
        self.phrases = [(Automaton(p), label) for p, label in phrases.items()]
        self.templates = [(Automaton(t), label) for label, ts in templates.items() for t in ts]
        self.by_first = defaultdict(list)
        self.anywhere = []
        for base, group in ((True, self.phrases), (False, self.templates)):
            for a, label in group:
                for w in a.first:
                    (self.anywhere if w is None else self.by_first[w]).append((a, label, base))
        # a word of each template outside its optional regions, the longest, as a sign that the template may match
        self.signs = {max(WORDS.findall(self._mandatory(t)), key=len) for t in [*phrases, *(t for ts in templates.values() for t in ts)]}

    @staticmethod
    def _mandatory(template: str) -> str:
        depth, out = 0, []
        for kind, _, _, text in Automaton._tokens(template):
            depth += (kind == "beginOptional") - (kind == "endOptional")
            if not depth:
                out.append(text.translate(_LOWER))
        return " ".join(out)

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int, int, bool]]]:
        """(words of the text, [(label, first word, end word, base)])."""
        words = WORDS.findall((text or "").translate(_LOWER)) if text else []
        found: list = []
        if self.signs.isdisjoint(words):
            return len(words), found
        for i, w in enumerate(words):
            for a, label, base in [*self.by_first.get(w, ()), *self.anywhere]:
                end = a.match(words, i)
                if end is not None:
                    found.append((label, i, end, base))
        return len(words), found


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``n_base`` counts places of phrases, ``first_word`` and ``last_word`` are
    the smallest and largest start of one (NULL without any). ``labels`` are
    the distinct labels of phrases and templates, sorted, comma-joined.
    ``spans`` lists (label, first word, end word) of every match, ``score`` is
    the share of words that stand in one. NULL or empty text: no words, empty
    labels, score 0. Repeated rows are scanned alike; other columns are not read."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    spans = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
    types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scanner(templates, phrases)
        for b in batches:
            rows = []
            for t in b.column(1):
                n, found = s.scan(t.as_py())
                base = [x for x in found if x[3]]
                covered, upto = 0, 0
                for _, a, e, _ in sorted(found, key=lambda x: x[1]):
                    covered += max(0, e - max(a, upto))
                    upto = max(upto, e)
                rows.append((n, len(base), min((x[1] for x in base), default=None), max((x[1] for x in base), default=None),
                             ",".join(sorted({x[0] for x in base})), ",".join(sorted({x[0] for x in found})), covered / n if n else 0.0,
                             [{"label": x[0], "first": x[1], "end": x[2]} for x in found]))
            cols = list(zip(*rows)) if rows else [[]] * len(names)
            # the ids pass through as they came
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]], names=["doc_id", *names])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, spans array<struct<label: string, first: long, end: long>>")

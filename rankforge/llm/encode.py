"""Whole texts to token ids with a public tokenizer file, batch by batch.

The ids are exactly those of ``Tokenizer.encode(text, add_special_tokens=False)``.
Natural text repeats its words, so texts are cut into pieces, each distinct
piece is encoded once and remembered, and the ids are gathered. A cut is made
only where the tokenizer's own pattern has a boundary whatever stands beside it:

* at a blank. A tokenizer that drops white space has a boundary at each; a
  byte-level one keeps a blank with the next word, and has a boundary before
  it unless more white space stands beside it (such texts are encoded whole);
* between a letter and a full stop or comma that white space follows.

Texts that spell a special token are encoded whole as well.
"""

from __future__ import annotations

import os
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct pieces remembered (past it, those met once are forgotten), and texts' characters handled at a time.
MEMORY, SLICE_CHARS = 500_000, 6 << 20
#: Words encoded by one call: few enough to stay in the processor's cache.
CALL = 128

_SPACES = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


class Encoder:
    """``encode(texts) -> (ids, counts)``: all ids in order, and how many each text has."""

    def __init__(self, path: str, memory: int = 0, slice_chars: int = 0):
        from tokenizers import Tokenizer
        self.memory, self.slice_chars = memory or MEMORY, slice_chars or SLICE_CHARS
        self.tok = Tokenizer.from_file(path)
        # left out for words that are normal already (the one of a public file: NFC and lower case)
        self.normal = self.tok.normalizer
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.mark = self.special[-1] if self.special else None
        self.mark_id = self.tok.token_to_id(self.mark) if self.mark else None
        first, second = self.tok.encode("a a", add_special_tokens=False).tokens
        self.keeps_blank = first != second  # a byte-level vocabulary keeps the blank with the next word
        # the ids at a word's edge: its first, with the blank's sign, or its last, with the sign of a word's end
        sign, vocab = second[0], self.tok.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.edge[[i for t, i in vocab.items() if (t.startswith(sign) if self.keeps_blank else t.endswith("</w>"))]] = True
        self._forget()

    def _forget(self):
        self.code: dict[str, int] = {}
        self.starts, self.lens, self.met = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.flat, self.used, self.n = np.zeros(1 << 18, np.uint32), 0, 0

    def _forget_rare(self):
        """Keep the pieces met more than once; if they fill half the memory, none."""
        keep = np.flatnonzero(self.met[: self.n] > 1)
        if len(keep) > self.memory // 2:
            return self._forget()
        words = list(self.code)  # in the order of their codes
        starts, lens, flat = self.starts[keep], self.lens[keep], self.flat
        self._forget()
        total = int(lens.sum())
        at = np.cumsum(lens) - lens
        self._store([words[i] for i in keep.tolist()], flat[np.repeat(starts - at, lens) + np.arange(total)], lens)

    def _learn(self, pieces: list[str]) -> None:
        """Encode and remember pieces; those of letters only are joined by blanks, since each is one word of the pattern."""
        plain, other = [], []
        for w in pieces:
            (plain if w.isalpha() and (not self.normal or w.isascii() or w.lower() == w and is_normalized("NFC", w)) else other).append(w)
        parts = [plain[i: i + CALL] for i in range(0, len(plain), CALL)]
        first = " " if self.keeps_blank else ""
        if self.normal:
            self.tok.normalizer = None
        try:
            got = [self._bare(parts[i: i + 256], first) for i in range(0, len(parts), 256)]
        finally:
            if self.normal:
                self.tok.normalizer = self.normal
        for part, ids in zip(parts, (x for y in got for x in y)):
            edge = np.flatnonzero(self.edge[ids])
            if len(edge) != len(part):  # letters that the normalizer takes apart
                other += part
            elif self.keeps_blank:
                self._store(part, ids, np.diff(np.append(edge, len(ids))))
            else:
                self._store(part, ids, np.diff(np.concatenate([[-1], edge])))
        self._learn_marked(other)

    def _bare(self, parts: list[list[str]], first: str) -> list[np.ndarray]:
        found = self.tok.encode_batch_fast([first + " ".join(p) for p in parts], add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def _learn_marked(self, pieces: list[str]) -> None:
        """The same for any pieces, joined by a special token."""
        for i in range(0, len(pieces), CALL):
            part = pieces[i: i + CALL]
            texts = [w[1:] if w[:1] == "\0" else " " + w for w in part] if self.keeps_blank else part
            ids = np.array(self.tok.encode(self.mark.join(texts), add_special_tokens=False).ids, dtype=np.uint32)
            cut = np.flatnonzero(ids == self.mark_id)
            self._store(part, np.delete(ids, cut), np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)

    def _store(self, part: list[str], ids: np.ndarray, lens: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(part) > len(self.starts):
            self.starts, self.lens, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens, self.met))
        self.flat[self.used: self.used + len(ids)] = ids
        self.lens[self.n: self.n + len(part)] = lens
        self.starts[self.n: self.n + len(part)] = self.used + np.cumsum(lens) - lens
        self.code.update(zip(part, range(self.n, self.n + len(part))))
        self.used, self.n = self.used + len(ids), self.n + len(part)

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.keeps_blank:  # a piece that starts with the sign \0 has no blank before it
            texts = pc.binary_join_element_wise("\0", texts, "")
            texts = pc.replace_substring_regex(texts, r"(\pL)([.,]) ", "\\1 \0\\2 ")
            texts = pc.replace_substring_regex(texts, r"(\pL)([.,])\n", "\\1 \0\\2 \0\n \0")
        else:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"(\pL)([.,])[ \n]", r"\1 \2 ")
        split = pc.split_pattern(texts, " ")
        enc = split.flatten().dictionary_encode()
        words = enc.dictionary.to_pylist()
        index = enc.indices.to_numpy()
        get = self.code.get
        new = [w for w in words if get(w) is None]
        if self.n + len(new) > self.memory and self.n:
            self._forget_rare()
            new = [w for w in words if w not in self.code]
        if new:
            self._learn(new)
        code = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        self.met[code] += np.bincount(index, minlength=len(words))
        code = code[index]
        lens = self.lens[code]
        total = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(self.starts[code] - total[:-1], lens) + np.arange(total[-1])]
        ends = total[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids, np.diff(ends)

    def _whole(self, texts: pa.Array) -> pa.Array | np.ndarray:
        if self.mark is None:
            return np.ones(len(texts), dtype=bool)
        whole = np.zeros(len(texts), dtype=bool)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if self.keeps_blank:
            whole |= pc.match_substring_regex(texts, _SPACES + "{2}|\\x00").to_numpy(zero_copy_only=False)
        return whole

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        start = 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= self.slice_chars):
                chars += len(texts[stop])
                stop += 1
            a, n = self._slice(texts[start:stop])
            ids.append(a)
            counts.append(n)
            start = stop
        return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        arr = pa.array(texts, pa.string())
        whole = self._whole(arr)
        if not whole.any():
            return self._pieces(arr)
        parts: list = [None] * len(texts)
        if not whole.all():
            ids, n = self._pieces(arr.filter(pa.array(~whole)))
            for i, x in zip(np.flatnonzero(~whole).tolist(), np.split(ids, np.cumsum(n)[:-1])):
                parts[i] = x
        for i in np.flatnonzero(whole).tolist():
            parts[i] = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(parts).astype(np.uint32), np.array([len(x) for x in parts], dtype=np.int64)


@lru_cache(maxsize=2)
def encoder(path: str, memory: int = 0, slice_chars: int = 0) -> Encoder:
    """One encoder per Python worker, tokenizer file and bounds of its memory."""
    return Encoder(path, memory, slice_chars)

"""Token ids of whole texts by a public tokenizer file, with a bounded cache of runs.

Both tokenizers split a text into pre-tokens before merging.  The texts of a batch are cut, all at once by numpy over
their bytes, into runs at places that are always pre-token boundaries: before a single space between two other
characters, around a single line end before a Latin letter, and between a Latin letter and plain marks that such a place
or the text's end follows (so no special token is cut).  Equal runs of a batch are found by Arrow; each is encoded by
itself, and once while it is cached."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from propensity.llm.textnp import buffer_of

#: Cached runs of each of two generations per worker process, and the longest run that is cached.
RUNS, LONGEST = 400_000, 64
_LATIN = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
#: Kinds of bytes: Latin letter, mark, other visible ASCII, first byte of characters none of which is white space, any later byte.
_LETTER, _MARK, _SHOWN, _LEAD, _LATER = 1, 2, 4, 8, 16
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _SHOWN
_KIND[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
_KIND[[ord(c) for c in ".,!?;:*$&#%|"]] = _MARK
_KIND[0xC3:0xF5] = _LEAD
_KIND[0xE1:0xE4] = 0
_KIND[128:192] = _LATER
_WORD = re.compile(f"{_LATIN}+")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, by the installed package that holds them."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet, by its rule: visible Latin-1 characters stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


def run_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First byte of each run of the texts that stand one after another in buf; every text that is not empty begins one."""
    n = len(buf)
    kind = _KIND[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inner = ~edge[:n]                               # has a byte of its text before it
    lead = kind == _LEAD
    # the last byte of a character that is no white space; a Latin letter's first and last byte
    solid = (kind & (_LETTER | _MARK | _SHOWN)) > 0
    later = kind == _LATER
    solid[1:] |= later[1:] & lead[:-1] & (buf[:-1] < 0xE0)
    solid[2:] |= later[2:] & lead[:-2] & (buf[:-2] >= 0xE0) & (buf[:-2] < 0xF0)
    solid[3:] |= later[3:] & (buf[:-3] >= 0xF0)
    letter = kind == _LETTER
    last = letter.copy()
    last[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    first = letter.copy()
    first[:-1] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    shown = ((kind & (_LETTER | _MARK | _SHOWN)) > 0) | lead
    between = np.zeros(n, bool)                     # a single space or line end at which runs end
    between[1:-1] = solid[:-2] & (((buf[1:-1] == 32) & shown[2:]) | ((buf[1:-1] == 10) & first[2:])) & inner[1:-1] & inner[2:]
    starts = edge[:n] | between
    starts[1:] |= between[:-1] & (buf[:-1] == 10)
    mark = kind == _MARK
    begin = np.flatnonzero(mark & np.r_[True, ~mark[:-1] | edge[1:n]])
    end = np.flatnonzero(mark & np.r_[~mark[1:] | edge[1:n], True]) + 1
    ends = edge.copy()
    ends[:n] |= between
    starts[begin[ends[end] & inner[begin] & last[begin - 1]]] = True
    return np.flatnonzero(starts)


class _Runs(dict):
    """Run -> its ids as bytes.  A full cache becomes the old generation; a run met again there is taken over, the others go."""

    def __init__(self, tokenizer, kind: str):
        super().__init__()
        self.tokenizer, self.code, self.old = tokenizer, "H" if kind == "<u2" else "I", {}
        self.tokenize = tokenizer.model.tokenize
        self.table = _byte_letters()
        folded = tokenizer.normalizer is not None and tokenizer.normalizer.normalize_str("A") == "a"
        self.fold = str.lower if folded else str
        self.marks = [tokenizer.pre_tokenizer.pre_tokenize_str(lead + "a")[0][0][:-1] for lead in ("", " ")]
        probe = ["The", "stra\u00dfe", "\u00c9\u00e0\u00e7\u00fc", "\u00edn", "aaa" * 40]
        self.direct = all(self._letters(p, spaced) == self._whole(" " * spaced + p) for p in probe for spaced in (False, True))

    def _whole(self, run: str) -> bytes:
        return array(self.code, self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str, spaced: bool) -> bytes:
        """One pre-token of letters, straight through the tokenizer's model."""
        word = self.fold(word)
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.table)
        return array(self.code, [t.id for t in self.tokenize(self.marks[spaced] + word)]).tobytes()

    def __missing__(self, run: str) -> bytes:
        ids = self.old.get(run)
        if ids is None:
            spaced = run[0] == " "
            word = run[1:] if spaced else run
            ids = self._letters(word, spaced) if self.direct and (word.isascii() and word.isalpha() or _WORD.fullmatch(word)) else self._whole(run)
        if len(run) <= LONGEST:
            if len(self) >= RUNS:
                self.old = dict(self)
                self.clear()
            self[run] = ids
        return ids


class Encoder:
    """encode(texts) -> id arrays, each with `end` appended.  Ids are little-endian, 16-bit if the vocabulary allows."""

    def __init__(self, path: str, end: int = 2):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.runs = _Runs(self.tokenizer, self.kind)
        self.end = np.array([end], self.kind).tobytes()

    def encode(self, texts: Iterable[str | None] | pa.Array) -> list[np.ndarray]:
        buf, offsets = buffer_of(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.string()))
        starts = run_starts(buf, offsets) if len(buf) else np.zeros(0, np.int64)
        each = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.r_[starts, len(buf)]), pa.py_buffer(buf)]).dictionary_encode()
        known = list(map(self.runs.__getitem__, each.dictionary.to_numpy(zero_copy_only=False)))
        size = np.fromiter(map(len, known), np.int64, len(known)) // np.dtype(self.kind).itemsize
        run = each.indices.to_numpy()
        ends = np.cumsum(size[run])
        # each id's place among the ids of the distinct runs
        at = np.repeat((np.cumsum(size) - size)[run] - ends + size[run], size[run]) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(known), self.kind)[at]
        cut = np.r_[0, ends][np.searchsorted(starts, offsets)]
        return [np.frombuffer(ids[s:e].tobytes() + self.end, self.kind) for s, e in zip(cut[:-1], cut[1:])]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end: int = 2) -> Encoder:
    """One encoder per worker process, file and end id."""
    if (path, end) not in _encoders:
        _encoders[path, end] = Encoder(path, end)
    return _encoders[path, end]

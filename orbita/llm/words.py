"""Words of many texts at once as 64-bit hashes (numpy over the texts' joined UTF-8 bytes)."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(1)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)

SPACE = np.zeros(256, dtype=bool)  # \x20 \x09-\x0D
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that separate words made of letters, digits and non-ASCII characters.
NOT_ALNUM = np.ones(256, dtype=bool)
for _range in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    NOT_ALNUM[slice(*_range)] = False


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 64) - 1, _BASE)]), dtype=np.uint64)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (spreads all bits)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: Characters of texts that are cut into words at once (about 40 bytes of arrays for each byte).
BATCH_CHARS = 1 << 20


def portions(texts: list[str]) -> list[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_CHARS`` characters; a longer text is alone."""
    out, begin, size = [], 0, 0
    for k, t in enumerate(texts):
        if k > begin and size + len(t) > BATCH_CHARS:
            out.append((begin, k))
            begin, size = k, 0
        size += len(t)
    return [*out, (begin, len(texts))] if texts else []


class Words:
    """``hashes`` of all words in order, ``first[i]:first[i + 1]`` those of text i, and their byte
    ``start`` and ``size`` in ``raw`` (all texts' bytes, each followed by a line feed); text i begins
    at byte ``at[i]``."""

    def __init__(self, texts: list[str], separators: np.ndarray = SPACE):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)]).astype(np.int64)
        inside = ~separators[self.raw]
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        self.start = np.flatnonzero(edge == 1)
        self.size = np.flatnonzero(edge == -1) - self.start
        self.first = np.searchsorted(self.start, self.at)
        if len(self.start):
            where = np.flatnonzero(inside)
            begin = np.concatenate([[0], np.cumsum(self.size)[:-1]])
            place = np.arange(len(where)) - np.repeat(begin, self.size)
            terms = _BYTE[self.raw[where]] * _powers(int(self.size.max()))[place]
            self.hashes = mix(np.add.reduceat(terms, begin) + self.size.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, dtype=np.uint64)
        self.counts = np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words (runs over text borders included: mask them)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * _BASE + hashes[k:len(hashes) - n + 1 + k]
    return mix(out)


def repeated_coverage(words: Words, n: int) -> np.ndarray:
    """Per text, how many of its words lie in a run of ``n`` words found twice or more in it (the first included)."""
    owner = words.owner()
    runs = shingle_hashes(words.hashes, n)
    out = np.zeros(len(words.counts), dtype=np.int64)
    if not len(runs):
        return out
    own = owner[:len(runs)]
    valid = own == owner[n - 1:]
    key = runs ^ mix(own.astype(np.uint64) + np.uint64(1))
    key, at = key[valid], np.flatnonzero(valid)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return out
    starts = at[np.isin(key, np.unique(twice))]
    marks = np.zeros(len(owner) + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + n, -1)
    covered = np.cumsum(marks[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(out)).astype(np.int64)


def per_text(flags: np.ndarray, words: Words) -> np.ndarray:
    """Sum of a value per byte over each text."""
    return np.add.reduceat(flags.astype(np.int64), words.at[:-1]) if len(words.counts) else np.zeros(0, np.int64)

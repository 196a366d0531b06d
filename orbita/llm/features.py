"""Counts of whole texts that the quality operators are built on (numpy, a batch of texts at once)."""

from __future__ import annotations

import numpy as np

from .words import Words, per_text, portions, repeated_coverage

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"


def _set(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _DIGIT, _PUNCT = _set(SYMBOLS), _set("0123456789"), _set(".,;:!?")
_UPPER = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _set("abcdefghijklmnopqrstuvwxyz")
_LETTER[0xC3:] = True  # the first byte of a non-ASCII character, as one letter
_LEAD = np.ones(256, dtype=bool)  # bytes that begin a character
_LEAD[0x80:0xC0] = False

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "letters", "uppers", "digits",
           "puncts", "exclaims", "short_words", "long_words", "plain_words", "symbol_words", "same_next", "distinct_words",
           "word_len_sq", "stops"]


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    seen: set[str] = set()
    total = twice = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            total += 1
            twice += line in seen
            seen.add(line)
    return twice, total


def count(texts: list[str]) -> dict[str, np.ndarray]:
    """One array per name of ``COLUMNS``, one value per text."""
    parts = [_count(texts[a:b]) for a, b in portions(texts)]
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for c in COLUMNS}


def _count(texts: list[str]) -> dict[str, np.ndarray]:
    w = Words(texts)
    n, owner, raw = len(texts), w.owner(), w.raw
    total = lambda values: np.bincount(owner, weights=values, minlength=n).astype(np.int64)
    ahead = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    in_words = lambda sums: sums[w.start + w.size] - sums[w.start]
    chars, letters, symbols = in_words(ahead(_LEAD[raw])), in_words(ahead(_LETTER[raw])), in_words(ahead(_SYMBOL[raw]))
    lines = np.array([duplicate_lines(t) for t in texts], dtype=np.int64).reshape(n, 2)
    same = np.zeros(len(owner), dtype=bool)
    if len(owner) > 1:
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
    # Distinct words per text: sort by text and hash.
    order = np.lexsort((w.hashes, owner)) if len(owner) else np.zeros(0, dtype=np.int64)
    h, o = w.hashes[order], owner[order]
    fresh = np.ones(len(o), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    last = raw[w.start + w.size - 1] if len(owner) else np.zeros(0, np.uint8)
    return {
        "n_words": w.counts.astype(np.int64), "word_chars": total(chars), "n_symbols": per_text(_SYMBOL[raw], w),
        "n_dup_lines": lines[:, 0], "n_repeat_words": repeated_coverage(w, 8), "n_lines": lines[:, 1],
        "letters": per_text(_LETTER[raw], w), "uppers": per_text(_UPPER[raw], w), "digits": per_text(_DIGIT[raw], w),
        "puncts": per_text(_PUNCT[raw], w), "exclaims": per_text(raw == 0x21, w), "short_words": total(chars <= 3),
        "long_words": total(chars > 12), "plain_words": total(letters == chars), "symbol_words": total(symbols > 0),
        "same_next": total(same), "distinct_words": np.bincount(o[fresh], minlength=n).astype(np.int64),
        "word_len_sq": total(chars.astype(float) ** 2), "stops": total((last == 0x2E) | (last == 0x21) | (last == 0x3F)),
    }

"""Token ids of whole texts by the ``tokenizers`` library, encoding each distinct unit once.

A byte-level BPE never merges across its pre-tokens, and a pre-token always starts at
a space followed by a non-space, at a single line feed between non-spaces, and at punctuation
behind a letter.  Texts may therefore be cut there, each distinct unit given to the
library once, and the ids put back in order: they are those of encoding the whole text in
one call.  Cuts are only made where the bytes around them leave no doubt.

The tokenizer's added tokens are found in a text first, as the library does, and stand for their own id;
what lies between them is encoded like a text of its own.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

#: Units that one worker remembers before it starts afresh (about 200 bytes each).
CACHE_ENTRIES = 800_000
#: Units handed to the library in one call, and bytes of text cut up at once.
CHUNK, BATCH_BYTES = 400, 4 << 20


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b] = True
    return out


# Bytes that may begin or end white space of some kind (Unicode spaces begin with C2, E1, E2, E3).
_SPACE = _bytes((0x09, 0x0E), (0x1C, 0x21))
_MAY_BEGIN_SPACE = _SPACE | _bytes((0xC2, 0xC3), (0xE1, 0xE4))
_LETTER = _bytes((0x41, 0x5B), (0x61, 0x7B))
_LATIN = _bytes((0x80, 0xC0))  # second bytes of U+00C0..U+00FF, all letters but two
_LATIN[[0x97, 0xB7]] = False
_TAIL = np.zeros(256, dtype=bool)
_TAIL[[ord(c) for c in ".,!?;:%&$*#|"]] = True


def cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Byte offsets at which units begin, in ``raw`` (texts behind one another, beginning at ``starts``)."""
    n = len(raw)
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts[starts < n]] = True
    edge[n] = True
    after, before = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    after[:-1] = ~_MAY_BEGIN_SPACE[raw[1:]] & ~edge[1:-1]  # surely a non-space of the same text follows
    letter = np.zeros(n, dtype=bool)  # a letter ends at the byte before, in the same text
    letter[1:] = _LETTER[raw[:-1]]
    letter[2:] |= (raw[:-2] == 0xC3) & _LATIN[raw[1:-1]]
    letter &= ~edge[:-1]
    before[1:] = (raw[:-1] < 0x80) & ~_SPACE[raw[:-1]] & ~edge[1:-1]
    begin = ((raw == 0x20) & after) | ((raw == 0x0A) & after & (before | letter)) | (_TAIL[raw] & letter)
    return np.flatnonzero(begin | edge[:-1])


class Encoder:
    """The library with a cache of units; ids are little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
        # Tokens that swallow white space or need word borders could not be cut out by their text alone.
        if any(t.single_word or t.lstrip or t.rstrip for t in self.lib.get_added_tokens_decoder().values()):
            raise ValueError(f"{path} has added tokens that depend on the text around them")
        self._added = {t: np.array([i], "<u4") for t, i in added.items()}
        self._parts = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        vocab = self.lib.get_vocab()
        self.size = 1 + max(vocab.values())
        self._opens = np.zeros(self.size, dtype=bool)
        for token, i in vocab.items():
            self._opens[i] = token[:1] in "ĠĊ"  # byte-level forms of space and line feed
        self._limit = cache_entries
        self._known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        """One uncut call of the library."""
        return np.asarray(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        plain, pieces = [], []  # texts without added tokens, and for each text what its ids are put together from
        for t in texts:
            at, row = 0, []
            for m in self._parts.finditer(t) if self._parts else ():
                row += [len(plain), self._added[m[0]]]
                plain.append(t[at:m.start()])
                at = m.end()
            pieces.append([*row, len(plain)])
            plain.append(t[at:] if at else t)
        ids = self._encode_plain(plain)
        return [ids[row[0]] if len(row) == 1 else np.concatenate([ids[x] if isinstance(x, int) else x for x in row]) for row in pieces]

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        part, size = [], 0
        for t in texts:
            part.append(t.encode())
            size += len(part[-1])
            if size >= BATCH_BYTES:
                out += self._encode_batch(part)
                part, size = [], 0
        return out + self._encode_batch(part)

    def _encode_batch(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = b"".join(texts)
        if not joined:
            return [np.zeros(0, "<u4") for _ in texts]
        raw = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        at = cuts(raw, starts)
        offsets = np.append(at, len(raw)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self._known) > self._limit:
            self._known = {}
        known = self._known
        entries = [known.get(u) for u in distinct]
        if None in entries:
            new = [k for k, e in enumerate(entries) if e is None]
            self._learn([distinct[k] for k in new])
            for k in new:
                entries[k] = known[distinct[k]]
        ids = pa.array(entries, pa.binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32)[:len(at) + 1] // 4
        flat = np.frombuffer(ids.buffers()[2], "<u4")
        bounds = ends[np.searchsorted(at, np.append(starts, len(raw)))].tolist()
        return [flat[i:j] for i, j in zip(bounds, bounds[1:])]

    def _learn(self, units: list[bytes]) -> None:
        spaced, lined, known = [], [], self._known
        for u in units:
            c = u[0]
            if u.count(b" ") + u.count(b"\n") == (c in (0x20, 0x0A)):  # no such white space inside
                if c == 0x20:
                    spaced.append(u)
                    continue
                if not (_MAY_BEGIN_SPACE[c] or _TAIL[c]) or c == 0x0A:
                    lined.append(u)
                    continue
            known[u] = self.whole(u.decode())
        self._together(spaced, [u.decode() for u in spaced])
        # Words at the beginning of a text get a line feed before them, whose id is taken off again.
        self._together(lined, [u.decode() if u[0] == 0x0A else "\n" + u.decode() for u in lined])

    def _together(self, units: list[bytes], texts: list[str]) -> None:
        """Units that each begin with white space have ids that open at it."""
        known = self._known
        for a in range(0, len(units), CHUNK):
            part, text = units[a:a + CHUNK], texts[a:a + CHUNK]
            ids = np.asarray(self.lib.encode_batch_fast(["".join(text)], add_special_tokens=False)[0].ids, "<u4")
            opens = np.flatnonzero(self._opens[ids])
            if len(opens) != len(part) or opens[0]:  # not the expected form: one by one
                known.update((u, self.whole(u.decode())) for u in part)
                continue
            raw = ids.tobytes()
            ends = (opens * 4).tolist() + [len(raw)]
            if text[0][0] == " ":
                known.update(zip(part, [raw[i:j] for i, j in zip(ends, ends[1:])]))
            else:
                known.update(zip(part, [raw[i if u[0] == 0x0A else i + 4:j] for u, i, j in zip(part, ends, ends[1:])]))

"""Benchmark decontamination: SimHash of item-sized windows, multi-index lookup, exact verification.

Texts and items are lower-cased; words are runs of letters, digits and non-ASCII
characters.  Items belong to size classes by their length (each about ``STEP_UP`` larger); an item's first and last
window of its class's size, which cover it but for a seventh at most, are fingerprinted (64-bit SimHash of five-word
shingles).  A text's windows of each class are fingerprinted at a stride of a tenth of the size, the text's last
window too, and looked up in four 16-bit blocks that tolerate three bits each: every fingerprint within
``RADIUS`` = 15 bits shares such a block and is found.  Windows that share under ``LEAST_SHARED`` of their
shingles with the item are near by chance and go; each candidate left is then verified: weighted Jaccard similarity
(shingles with multiplicity) of the item and the item-sized window at the place it implies, or near it.

A copy of similarity ``THRESHOLD`` shares nine tenths of its shingles, which moves about 9 of 64 bits; with the stride's shift
about 12.  The radius finds 98 % or more of copies edited down to the threshold (words changed, put in, left out, or
cut off at the ends; measured in tests/llm/test_decontaminate.py), and all whole copies.

The benchmark is matched in blocks of at most ``BLOCK_BYTES`` of text, each broadcast by itself and freed when its result is
written (see :func:`find_leaks`).

Defined cases: null texts are empty; items and texts without words match nothing;
items under five words have one shingle, the whole item; items of equal text are matched
each, repeated items once; null ids are carried along; repeated rows are each reported; empty tables give no
matches; other columns are kept by ``drop_contaminated``, also where names clash with ours.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, written
from .words import NOT_ALNUM, Words, mix, portions, shingle_hashes

SHINGLE, THRESHOLD, RADIUS = 5, 0.8, 15
#: Bits that each of the four blocks tolerates: 4 x (3 + 1) - 1 = RADIUS.
TOLERATED = 3
#: Ratio of neighbouring size classes, and windows per size.
STEP_UP, PER_SIZE = 1.15, 10
#: Shingles of a found window that must be the item's; at similarity ``THRESHOLD`` about three quarters are.
LEAST_SHARED = 0.4
#: Bytes of benchmark text in one index; a larger benchmark is matched block by block.
BLOCK_BYTES = 1 << 20
#: Words fingerprinted in one go: bounds memory for very long texts.
STEP = 1 << 16


def window_sizes(limit: int) -> list[int]:
    """Size classes: every size up to 12 (where only whole copies are similar enough), then steps of ``STEP_UP``."""
    out = list(range(1, 13))
    while out[-1] < limit:
        out.append(math.ceil(out[-1] * STEP_UP))
    return out


def stride(size: int) -> int:
    return max(1, size // PER_SIZE)


def size_class(words: int) -> int:
    return max(w for w in window_sizes(words) if w <= words)


def slack(words: int) -> int:
    """Places on either side of the implied one that are verified: words put in or left out before it, and the stride."""
    return 2 + words // 8


def fingerprints(hashes: np.ndarray, size: int, at: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """SimHash of the windows of ``size`` words that begin at ``at``."""
    shingle = min(SHINGLE, size)
    n = size - shingle + 1
    if sums is None:
        sums = bit_sums(shingle_hashes(hashes, shingle), n)
    return packed(sums[at + n] - sums[at], n)


def packed(ones: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints from how many of ``n`` shingles have each bit."""
    return np.packbits(ones > n // 2, axis=1, bitorder="little").view("<u8")[:, 0]


def bit_sums(shingles: np.ndarray, n: int) -> np.ndarray:
    """Running sums of each bit; differences are exact in a type that holds ``n``."""
    kind = np.uint8 if n < 1 << 8 else np.uint16 if n < 1 << 16 else np.uint32
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(bits) + 1, 64), dtype=kind)
    np.cumsum(bits, axis=0, dtype=kind, out=sums[1:])
    return sums


_FLIPS = np.array([v for v in range(1 << 16) if v.bit_count() <= TOLERATED], dtype=np.uint64)


class MultiIndex:
    """Fingerprints by four 16-bit blocks, each entered under its own value and all those within ``TOLERATED`` bits."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.begin, self.rows = [], []
        for b in range(4):
            value = (fps >> np.uint64(16 * b)) & np.uint64(0xFFFF)
            keys = (value[:, None] ^ _FLIPS[None, :]).ravel().astype(np.int64)
            order = np.argsort(keys, kind="stable")
            self.rows.append((order // len(_FLIPS)).astype(np.int32))
            self.begin.append(np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=1 << 16))]).astype(np.int32))
        self.some = [np.diff(b) > 0 for b in self.begin]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, row) pairs within ``radius`` <= ``RADIUS`` bits."""
        found = []
        keys = queries.view(np.uint16).reshape(-1, 4)  # little-endian: block b in column b
        for b in range(4):
            hit = np.flatnonzero(self.some[b][keys[:, b]])
            if not len(hit):
                continue
            key = keys[hit, b].astype(np.int64)
            begin = self.begin[b][key]
            count = self.begin[b][key + 1] - begin
            q = np.repeat(hit, count)
            row = self.rows[b][np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            near = np.bitwise_count(queries[q] ^ self.fps[row]) <= radius
            found.append(q[near] * len(self.fps) + row[near])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // max(1, len(self.fps)), pairs % max(1, len(self.fps))


def shingles(words: list[bytes]) -> Counter:
    k = min(SHINGLE, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


class Index:
    """Items of a benchmark block, ready to be found in texts."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        words = Words([(t or "").lower() for _, t in items], NOT_ALNUM)
        raw = words.raw.tobytes()
        self.words = [[raw[words.start[k]:words.start[k] + words.size[k]] for k in range(a, b)]
                      for a, b in zip(words.first[:-1], words.first[1:])]
        self.shingles = [shingles(w) for w in self.words]
        # Each item's shingle hashes, told apart by a salt, in one sorted array for each shingle length.
        self.salt = mix(np.arange(1, len(items) + 1, dtype=np.uint64))
        spans = [(i, words.hashes[a:b], min(SHINGLE, int(b - a))) for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])) if b > a]
        self.known = {k: np.unique(np.concatenate([shingle_hashes(h, k) ^ self.salt[i] for i, h, n in spans if n == k]))
                      for k in {n for _, _, n in spans}}
        by_size: dict[int, list[tuple]] = {}
        for item, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            if b > a:
                size = size_class(int(b - a))
                shifts = np.unique([0, b - a - size])
                by_size.setdefault(size, []).append((item, shifts, fingerprints(words.hashes[a:b], size, shifts)))
        self.classes = []
        for size, rows in sorted(by_size.items()):
            item = np.concatenate([np.full(len(s), i) for i, s, _ in rows])
            self.classes.append((size, MultiIndex(np.concatenate([f for *_, f in rows])), item,
                                 np.concatenate([s for _, s, _ in rows])))

    def shared(self, runs: np.ndarray, at: np.ndarray, items: np.ndarray, k: int, n: int) -> np.ndarray:
        """Share of the ``n`` shingles from each place on that the item there has."""
        out, known = np.zeros(len(at)), self.known[k]
        for a in range(0, len(at), max(1, STEP // n)):
            part = slice(a, a + max(1, STEP // n))
            keys = runs[at[part, None] + np.arange(n)] ^ self.salt[items[part], None]
            out[part] = (known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys).mean(axis=1)
        return out

    def candidates(self, words: Words) -> set[tuple[int, int, int]]:
        """(text, item, implied first word in the text) of every window near an item's sub-window."""
        out: set[tuple[int, int, int]] = set()
        owner = words.owner()
        largest = self.classes[-1][0] if self.classes else 0
        for a in range(0, len(owner), STEP):
            hashes = words.hashes[a:a + STEP + largest]
            sums: dict[int, np.ndarray] = {}
            runs: dict[int, np.ndarray] = {}
            for size, index, items, shifts in self.classes:
                if len(hashes) < size:
                    break
                k = min(SHINGLE, size)
                if k not in sums:
                    runs[k] = shingle_hashes(hashes, k)
                    sums[k] = bit_sums(runs[k], largest)
                step, n = stride(size), size - k + 1
                at = np.arange(0, min(STEP, len(hashes) - size + 1), step)
                ones = sums[k][n:n + len(at) * step:step][:len(at)] - sums[k][:len(at) * step:step]
                whole = owner[a + at] == owner[a + at + size - 1]
                at, fps = at[whole], packed(ones, n)[whole]
                if step > 1:  # and the last window of every text
                    last = words.first[1:] - size - a
                    last = last[(words.counts >= size) & (last >= 0) & (last < STEP)]
                    at, fps = np.append(at, last), np.append(fps, fingerprints(hashes, size, last, sums[k]))
                if not len(at):
                    continue
                query, row = index.within(fps, RADIUS)
                # Fingerprints that are near by chance: their windows share next to nothing with the item.
                near = self.shared(runs[k], at[query], items[row], k, n) >= LEAST_SHARED
                query, row = query[near], row[near]
                text = owner[a + at[query]]
                place = a + at[query] - words.first[text] - shifts[row]
                out.update(zip(text.tolist(), items[row].tolist(), place.tolist()))
        return out

    def match(self, texts: list[str | None]) -> list[list[tuple]]:
        """Per text, its items as ``(item_id, similarity, first word)``, the best place of each."""
        lower = [(t or "").lower() for t in texts]
        return [found for a, b in portions(lower) for found in self._match(Words(lower[a:b], NOT_ALNUM))]

    def _match(self, words: Words) -> list[list[tuple]]:
        raw = words.raw.tobytes()
        places: dict[tuple[int, int], set[int]] = {}
        for text, item, place in self.candidates(words):
            near = slack(len(self.words[item]))
            places.setdefault((text, item), set()).update(range(place - near, place + near + 1))
        out: list[list[tuple]] = [[] for _ in words.counts]
        for (text, item), starts in sorted(places.items()):
            first, n, size = int(words.first[text]), int(words.counts[text]), len(self.words[item])
            places_ = sorted({min(max(0, s), max(0, n - size)) for s in starts})
            near = range(first + places_[0], first + min(n, places_[-1] + size))
            region = [raw[words.start[k]:words.start[k] + words.size[k]] for k in near]
            have = self.shingles[item]
            about = shingles(region) if len(region) >= SHINGLE or size < SHINGLE else Counter()
            # A similarity of THRESHOLD needs this many shared shingles, wherever the window lies.
            if size >= SHINGLE and sum(min(c, about[s]) for s, c in have.items() if s in about) * (1 + THRESHOLD) < (
                    2 * THRESHOLD * have.total() * (1 - 1e-9)) and n >= size:
                continue
            best = (0.0, 0)
            for p in places_:
                s = similarity(have, shingles(region[p - places_[0]:p - places_[0] + size]))
                if s > best[0]:
                    best = (s, p)
                if s == 1.0:
                    break
            if best[0] >= THRESHOLD:
                out[text].append((self.ids[item], best[0], best[1]))
        return out


_INDEXES: dict[str, Index] = {}


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Broadcasts of the different items, each of about ``block_bytes`` of text at most, one at a time."""
    spark = benchmark.sparkSession
    items = (benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
             .where(F.col("text").isNotNull()).dropDuplicates())
    blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield b == blocks - 1, spark.sparkContext.broadcast([(r.id, r.text) for r in rows])


def _matches(block, text: Column) -> Column:
    key = uuid.uuid4().hex

    @F.pandas_udf("array<struct<item_id: long, similarity: double, first_word: long>>")
    def matched(texts: pd.Series) -> pd.Series:
        if key not in _INDEXES:  # built once per worker process
            _INDEXES.clear()
            _INDEXES[key] = Index(block.value)
        return pd.Series([[{"item_id": i, "similarity": s, "first_word": p} for i, s, p in row]
                          for row in _INDEXES[key].match(texts.tolist())])

    return matched(text.cast("string"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, similarity, first_word`` of every item found in a document; written block by block."""
    spark = docs.sparkSession
    bound_batches(spark)
    out = spark.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long")
    for _, block in _blocks(benchmark, block_bytes):
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _matches(block, F.col("text")).alias("found"))
        out = out.unionByName(written(found.select("doc_id", F.inline("found")), "leaks"))
        block.destroy()
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without those that hold an item; what a block leaves is written before the next one is matched."""
    bound_batches(docs.sparkSession)
    for last, block in _blocks(benchmark, block_bytes):
        name = fresh(docs, "_found")
        docs = docs.withColumn(name, F.size(_matches(block, F.col("text")))).where(F.col(name) == 0).drop(name)
        if not last:
            docs = written(docs, "clean-of-block")
            block.destroy()
    return docs


_WORDS = r"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^0-9a-z\x{80}-\x{10FFFF}]+', ' ', 'g'), ' '), lambda x: x <> '')"
#: Brute force: every item-sized window that shares a shingle with the item.
ORACLE = f"""
WITH b AS (SELECT item_id, w, len(w) AS n, least({SHINGLE}, len(w)) AS k
           FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bs AS (SELECT item_id, n, k, s, count(*) AS c
       FROM (SELECT item_id, n, k, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
             FROM b) GROUP BY item_id, n, k, s),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
ds AS (SELECT doc_id, m, k, p, array_to_string(w[p + 1:p + k], ' ') AS s
       FROM (SELECT doc_id, w, len(w) AS m, k, unnest(range(0, len(w) - k + 1)) AS p
             FROM d, (SELECT DISTINCT k FROM b))),
h AS (SELECT doc_id, item_id, n, ds.k, m, p, s, c FROM ds JOIN bs USING (k, s)),
v AS (SELECT doc_id, item_id, n, k, m, s, c,
             unnest(range(greatest(0, p - (n - k)), least(p, greatest(0, m - n)) + 1)) AS first_word FROM h),
f AS (SELECT doc_id, item_id, n, k, m, first_word, s, least(count(*), any_value(c)) AS shared FROM v GROUP BY doc_id, item_id, n, k, m, first_word, s),
g AS (SELECT doc_id, item_id, first_word, sum(shared) AS shared, any_value(least(n, m) - k + 1 + n - k + 1) AS total
      FROM f GROUP BY doc_id, item_id, first_word),
r AS (SELECT doc_id, item_id, first_word, CAST(shared AS DOUBLE) / (total - shared) AS similarity FROM g)
SELECT doc_id, item_id, similarity, first_word FROM r WHERE similarity >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, first_word) = 1"""

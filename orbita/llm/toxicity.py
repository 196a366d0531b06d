"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Only documents carry labels.  A sentence's probability is logistic in the character patterns that it
holds; the document's is their noisy-or, ``1 - prod(1 - p_s)``.  Weights maximise the likelihood of the document
labels through that noisy-or, so the blame settles on the sentences that explain them.  The same
sentence probabilities then locate the offending sentences.

Texts are normalised byte by byte (A-Z lower-cased, every byte that is no letter a space).  A pattern is a run of
``SIZES`` bytes within a word (the spaces around it included) or a whole short word.  Candidates are those of
the toxic training documents; each is counted over the clean ones by one automaton (Aho-Corasick); the ``PATTERNS`` of the
strongest association (likelihood ratio) that are ``RATIO`` times likelier in toxic documents become features.  Scoring is one
pass of the automaton over each whole text.

Training reads a bounded sample of the labelled rows that are not held out: the ``MAX_TOXIC`` and ``MAX_CLEAN`` rows of
least hash of each label, all sources alike.  Rows held out have ``crc32(doc_id as text) mod 3 = 1``.

Defined cases: a null text is empty, and empty texts have a score (no sentence: probability 0); null labels and
labels without a document are ignored; with one class only, or without a pattern, every score is the training share of toxic documents at
most ``CUT``'s half; null doc_ids are scored, never trained on, and not held out; repeated rows get equal scores; very
long texts are read whole, sentence by sentence; an empty table gives no rows; other columns are kept by :func:`with_findings`,
also where their names clash with ours.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, fresh, text_or_empty, written
from .divergence import NORMAL

CUT = 0.7
MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
#: Bytes of a pattern; a whole word of up to ``WORD`` bytes is one too.
SIZES, WORD = (3, 4, 5, 6), 24
MIN_DOCS, RATIO, PATTERNS = 5, 8.0, 4_000
#: Strength of the Gaussian prior on weights, in documents; steps of the fit.
PRIOR, STEPS = 0.2, 400
#: Distinct patterns that a task counts before it hands them on (about 150 bytes each).
TALLY = 400_000
#: A sentence ends behind these marks before white space, and at a line feed.
_END = re.compile(rb"[.!?]+(?=[ \t\r\n])|\n")


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def normal(text: bytes) -> str:
    """Normalised text between two spaces, one character a byte."""
    return " " + text.translate(NORMAL).decode("latin-1") + " "


def patterns_of(text: bytes) -> set[str]:
    """All candidate patterns of a text."""
    found = set()
    for word in set(normal(text).split()):
        whole = f" {word} "
        if len(word) <= WORD:
            found.add(whole)
        for n in SIZES:
            found.update([whole[i:i + n] for i in range(len(whole) - n + 1)])
    return found


def sentence_ends(text: bytes) -> np.ndarray:
    """Byte offsets behind each sentence, the last one being the text's end."""
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array(ends, dtype=np.int64)


def automaton(patterns: list[str]) -> ahocorasick.Automaton | None:
    found = ahocorasick.Automaton()
    for k, p in enumerate(patterns):
        found.add_word(p, k)
    if not len(found):
        return None
    found.make_automaton()
    return found


class Matcher:
    """Finds patterns in the sentences of texts; the automaton is built where it is used."""

    def __init__(self, patterns: list[str]):
        self.patterns, self._found = patterns, None

    def __getstate__(self):
        return {"patterns": self.patterns, "_found": None}

    def matches(self, text: bytes) -> list[tuple[int, int]]:
        """(byte offset behind the match, pattern) of every match."""
        if self._found is None:
            self._found = automaton(self.patterns)
        return list(self._found.iter(normal(text))) if self._found is not None else []

    def sentences(self, text: bytes, ends: np.ndarray) -> dict[int, list[int]]:
        """The distinct patterns of each sentence that has any."""
        hits = self.matches(text)
        if not hits:
            return {}
        at, which = np.array(hits, dtype=np.int64).T
        # A match ends at ``at - 1`` in the text; one that ends with the space behind a sentence is still its own.
        sentence = np.searchsorted(ends, np.clip(at - 2, 0, max(len(text) - 1, 0)), side="right")
        pairs = np.unique(np.column_stack([sentence, which]), axis=0)
        cut = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        return {int(s[0, 0]): s[:, 1].tolist() for s in np.split(pairs, cut)}


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(instances: list[tuple[int, int, list[list[int]]]], patterns: int, prior: float = PRIOR, steps: int = STEPS):
    """Weights and bias from bags ``(label, sentences without a pattern, patterns of the others)``.

    Minimises the mean log loss of the noisy-or plus a ridge of ``prior`` documents, by Adam."""
    y = np.array([label for label, _, _ in instances], dtype=float)
    blank = np.array([n for _, n, _ in instances], dtype=float)
    bag = np.repeat(np.arange(len(instances)), [len(s) for _, _, s in instances])
    sizes = [len(s) for _, _, found in instances for s in found]
    row = np.repeat(np.arange(len(sizes)), sizes)
    col = np.array([k for _, _, found in instances for s in found for k in s], dtype=np.int64)
    share = np.full(len(y), 1 / max(1, len(y)))
    theta = np.zeros(patterns + 1)
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        p = sigmoid(np.bincount(row, weights=w[col], minlength=len(sizes)) + b)
        p0 = sigmoid(b)
        kept_out = np.bincount(bag, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)) + blank * np.log1p(-p0)
        clean = np.exp(kept_out)  # probability that no sentence is toxic
        # d loss / d kept_out: a toxic bag wants it low, a clean one high; d log(1 - p_s) / d z_s = -p_s.
        pull = share * np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        dz = -p * pull[bag]
        gradient = np.append(np.bincount(col, weights=dz[row], minlength=patterns), dz.sum() - p0 * (pull * blank).sum())
        gradient[:-1] += prior / len(y) * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta = theta - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:-1], float(theta[-1])


class Model:
    """Patterns with their weights, the bias, and the score of all texts where nothing could be learnt."""

    def __init__(self, patterns: list[str], weights: np.ndarray, bias: float, flat: float | None = None):
        self.matcher, self.weights, self.bias, self.flat = Matcher(patterns), weights, bias, flat

    def judge(self, text: bytes) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (begin, end, probability) of sentences of at least one half, in code points."""
        if self.flat is not None:
            return self.flat, []
        if not text:
            return 0.0, []
        ends = sentence_ends(text)
        found = self.matcher.sentences(text, ends)
        p = {s: float(sigmoid(self.bias + self.weights[k].sum())) for s, k in found.items()}
        clean = (len(ends) - len(p)) * np.log1p(-sigmoid(self.bias)) + sum(np.log1p(-min(q, 1 - 1e-12)) for q in p.values())
        spans = []
        for s in sorted(k for k, q in p.items() if q >= 0.5):
            begin = int(ends[s - 1]) if s else 0
            first = len(text[:begin].decode("utf-8", "replace"))
            spans.append((first, first + len(text[begin:int(ends[s])].decode("utf-8", "replace")), p[s]))
        return float(-np.expm1(clean)), spans


def sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """``id, y, text`` of the training rows, written (bounded by the two parameters for documents of one row an id)."""
    usable = (labels.where(~is_held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y")).distinct())
    least = [F.xxhash64("id"), F.col("id")]
    chosen = (usable.where("y = 1").orderBy(*least).limit(max_toxic)
              .unionByName(usable.where("y = 0").orderBy(*least).limit(max_clean)))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "y", "text")  # at most max_toxic + max_clean rows of two numbers
    # Repeated documents count once for a label.
    each = Window.partitionBy("id", "y").orderBy("text")
    return written(rows.withColumn("k", F.row_number().over(each)).where("k = 1").drop("k").repartition(
        max(1, docs.sparkSession.sparkContext.defaultParallelism), "id"), "toxicity-sample")


def _counted(rows: DataFrame, found_in) -> DataFrame:
    """``pattern, docs``: rows that hold each of the patterns ``found_in(text)``."""

    def count(batches):
        table: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                table.update(found_in(text))
                if len(table) > TALLY:
                    yield pa.RecordBatch.from_pydict({"pattern": list(table), "docs": list(table.values())})
                    table = Counter()
        if table:
            yield pa.RecordBatch.from_pydict({"pattern": list(table), "docs": list(table.values())})

    return (rows.select("text").mapInArrow(count, "pattern string, docs long")
            .groupBy("pattern").agg(F.sum("docs").alias("docs")))


def associated(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Likelihood-ratio statistic of a pattern and the label; 0 where it is not ``RATIO`` times likelier in toxic rows."""
    def term(k, expected):
        return np.where(k > 0, k * np.log(np.maximum(k, 1) / np.maximum(expected, 1e-12)), 0.0)

    share = (toxic + clean) / (n_toxic + n_clean)
    g = 2 * (term(toxic, n_toxic * share) + term(clean, n_clean * share)
             + term(n_toxic - toxic, n_toxic * (1 - share)) + term(n_clean - clean, n_clean * (1 - share)))
    return np.where(toxic / n_toxic >= RATIO * (clean + 0.5) / n_clean, g, 0.0)


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Fit on the bounded sample; pattern counts of the sample come to the driver filtered, instances as pattern numbers."""
    bound_batches(docs.sparkSession)
    rows = sample(docs, labels, max_toxic, max_clean)
    size = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    flat = min(CUT / 2, n_toxic / (n_toxic + n_clean)) if n_toxic + n_clean else 0.0
    if not n_toxic or not n_clean:
        return Model([], np.zeros(0), 0.0, flat)
    # Patterns of at least MIN_DOCS toxic rows that could pass RATIO: the sample bounds them.
    candidates = [(r.pattern, r.docs) for r in _counted(rows.where("y = 1"), patterns_of)
                  .where(F.col("docs") >= max(MIN_DOCS, RATIO * 0.5 * n_toxic / n_clean)).collect()]
    names = [p for p, _ in candidates]
    matcher = Matcher(names)
    seen = {r.pattern: r.docs for r in _counted(
        rows.where("y = 0"), lambda text: {names[k] for _, k in matcher.matches(text)}).collect()}
    toxic, clean = np.array([n for _, n in candidates], dtype=float), np.array([seen.get(p, 0) for p in names], dtype=float)
    strength = associated(toxic, clean, n_toxic, n_clean) if names else np.zeros(0)
    order = sorted(np.flatnonzero(strength > 10.83).tolist(), key=lambda k: (-strength[k], names[k]))[:PATTERNS]
    if not order:
        return Model([], np.zeros(0), 0.0, flat)
    patterns = [names[k] for k in order]
    matcher = Matcher(patterns)

    def bags(batches):
        for batch in batches:
            ids, labels_, blank, found = [], [], [], []
            for i, y, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ends = sentence_ends(text)
                sentences = list(matcher.sentences(text, ends).values())
                ids.append(i)
                labels_.append(y)
                blank.append(len(ends) - len(sentences) if text else 0)
                found.append(sentences)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels_, pa.int32()), pa.array(blank, pa.int64()),
                                              pa.array(found, pa.list_(pa.list_(pa.int32())))], names=["id", "y", "blank", "found"])

    collected = rows.mapInArrow(bags, "id long, y int, blank long, found array<array<int>>").collect()
    instances = [(r.y, r.blank, [list(s) for s in r.found]) for r in sorted(collected, key=lambda r: (r.id, r.y))]
    return Model(patterns, *fit(instances, len(patterns)))


FINDINGS = "struct<score:double,offending:array<struct<begin:int,end:int,score:double>>>"


def with_findings(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a column ``name``: the whole text's score and its offending sentences (spans in code points)."""
    bound_batches(docs.sparkSession)
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf(FINDINGS)
    def judged(texts: pa.Array) -> pa.Array:
        found = [model.judge(t) for t in texts.to_pylist()]
        offending = [[{"begin": a, "end": b, "score": p} for a, b, p in s] for _, s in found]
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array(offending, spans)],
                                          names=["score", "offending"])

    return docs.withColumn(name, judged(text_or_empty().cast("binary")))


def offending_sentences(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, begin, end, score, sentence``: one row per sentence of at least one half."""
    name = fresh(docs, "_found")
    rows = with_findings(docs.where(F.col("text").isNotNull()), model, name)
    return (rows.select("doc_id", "text", F.explode(F.col(name)["offending"]).alias("s"))
            .select("doc_id", "s.begin", "s.end", "s.score",
                    F.substring(F.col("text"), F.col("s.begin") + 1, F.col("s.end") - F.col("s.begin")).alias("sentence")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_offending`` of every row."""
    found = with_findings(docs.select("doc_id", "text"), train(docs, labels), "found")
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), F.col("found.score").alias("score"),
                        (F.col("found.score") >= CUT).cast("int").alias("predicted"),
                        F.size("found.offending").cast("long").alias("n_offending"))

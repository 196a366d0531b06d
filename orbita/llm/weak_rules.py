"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule votes bad (-1), good (1) or abstains (0).  A hidden class (good or bad)
explains the votes, each rule with its own accuracy for either class.  EM starts from the majority
vote and estimates the accuracies from the counts of all vote patterns over all documents; patterns are at
most 3^rules, so the driver holds a bounded table.  A prior worth ``PRIOR`` of the votes keeps
accuracies off 0 and 1, so that no single rule is a veto.  Rules that vote alike say little more than one of
them: a rule's evidence counts ``1 / sum(|correlation with each rule|^SHARPNESS)``.  A document is kept if it
passes the base checks and its posterior probability of good is ``KEEP`` or more.

Defined cases: a null text is empty and fails the base check; null doc_ids and
repeated rows are rows like others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import features
from .common import bound_batches, text_or_empty, written

KEEP = 0.9
#: Share of a rule's votes that the prior on its accuracy is worth, and the accuracy that it expects.
PRIOR, EXPECTED = 0.02, 0.8
SHARPNESS = 4
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """One row per text, one column per rule: -1 bad, 0 abstain, 1 good."""
    n = np.maximum(c["n_words"], 1).astype(float)
    letters = np.maximum(c["letters"], 1)

    def rule(bad, good):
        return np.where(bad, -1, np.where(good, 1, 0))

    repeat, symbol, upper = c["n_repeat_words"] / n, c["symbol_words"] / n, c["uppers"] / letters
    same, short, plain = c["same_next"] / n, c["short_words"] / n, c["plain_words"] / n
    variety = c["distinct_words"] / n
    mean, twice = c["word_chars"] / n, c["n_dup_lines"] / np.maximum(c["n_lines"], 1)
    out = np.column_stack([
        rule(c["n_words"] < MIN_WORDS, c["n_words"] >= 50), rule(repeat > 0.3, repeat <= 0.1),
        rule(symbol > 0.1, symbol < 0.02), rule(upper > 0.3, upper < 0.1), rule(same > 0.1, same < 0.05),
        rule(short < 0.12, (short > 0.2) & (short < 0.55)), rule(plain < 0.5, plain > 0.65),
        rule((mean < 3) | (mean > 8), (mean > 4) & (mean < 6.5)), rule(twice > 0.3, np.zeros(len(n), bool)),
        rule((variety < 0.25) & (n < 1000), variety > 0.5)])
    out[c["n_words"] == 0, 1:] = 0  # nothing to judge
    return out


RULES = 10


def codes(v: np.ndarray) -> np.ndarray:
    return (v + 1) @ (3 ** np.arange(v.shape[1]))


def decode(code: np.ndarray, rules: int = RULES) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(rules)[None, :] % 3 - 1


def dependence(v: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weight of each rule's evidence: 1 for a rule like no other, 1/2 for each of two that always vote alike."""
    weight = counts / max(1, counts.sum())
    centred = v - weight @ v
    spread = np.sqrt(weight @ centred ** 2)
    like = np.abs((centred * weight[:, None]).T @ centred) / np.maximum(np.outer(spread, spread), 1e-12)
    np.fill_diagonal(like, 1.0)
    return 1 / (np.minimum(like, 1) ** SHARPNESS).sum(axis=1)


def fit(v: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[float, np.ndarray, np.ndarray]:
    """Prior of good, accuracies ``p[rule, class]`` (how often a rule that votes is right about that class), and the
    weights of the rules' evidence.  Abstentions say nothing about the class."""
    bad, good = (v == -1).sum(axis=1), (v == 1).sum(axis=1)
    post = (good + 0.5) / (good + bad + 1.0)
    weight, evidence = counts.astype(float), dependence(v, counts)
    says_bad, says_good = (v == -1) * weight[:, None], (v == 1) * weight[:, None]
    for _ in range(rounds):
        prior = (weight @ post + 1) / (weight.sum() + 2)
        p = np.empty((v.shape[1], 2))
        for k, (klass, right) in enumerate(((1 - post, says_bad), (post, says_good))):
            cast = klass @ (says_bad + says_good)
            worth = 1 + PRIOR * cast.mean()
            p[:, k] = (klass @ right + EXPECTED * worth) / (cast + worth)
        new = posterior(v, prior, p, evidence)
        done = not len(post) or np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return float(prior), p, evidence


def posterior(v: np.ndarray, prior: float, p: np.ndarray, evidence: np.ndarray | float = 1.0) -> np.ndarray:
    """Probability of good: by Bayes' rule from the votes that were cast, each with the weight of its rule's evidence."""
    yes, no = (v == 1) * evidence, (v == -1) * evidence
    good = yes @ np.log(p[:, 1]) + no @ np.log1p(-p[:, 1]) + np.log(prior)
    bad = no @ np.log(p[:, 0]) + yes @ np.log1p(-p[:, 0]) + np.log1p(-prior)
    return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and the coded ``votes`` of every row."""
    bound_batches(docs.sparkSession)

    def count(batches):
        for batch in batches:
            c = features.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c[k]) for k in BASE], pa.array(codes(votes(c)).astype(np.int32))],
                names=["doc_id", *BASE, "votes"])

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", votes int"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(count, schema)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and the ``posterior`` of every row."""
    rows = written(counted(docs), "votes")
    patterns = sorted((r.votes, r["count"]) for r in rows.groupBy("votes").count().collect())  # at most 3^RULES
    code, n = np.array(patterns, dtype=np.int64).reshape(-1, 2).T
    v = decode(code)
    table = [(int(c), float(q)) for c, q in zip(code, posterior(v, *fit(v, n)))]
    known = docs.sparkSession.createDataFrame(table, "votes int, posterior double")
    return rows.join(F.broadcast(known), "votes").select(
        "doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & (F.col("posterior") >= KEEP)).alias("kept"),
        "posterior")


BASE_ORACLE = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''),
             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 8], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, len(w) - 7)) AS p FROM w)),
t AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM t) GROUP BY doc_id),
l AS (SELECT doc_id, line, count(*) - 1 AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
d AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM l GROUP BY doc_id),
b AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM w LEFT JOIN d ON w.doc_id = d.doc_id LEFT JOIN r ON w.doc_id = r.doc_id)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b"""

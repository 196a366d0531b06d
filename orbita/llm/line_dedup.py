"""Cross-site line dedup: HyperLogLog spread of each line over sites, exact counts near the threshold.

Per line (hash of its trimmed text) the number of distinct sites is estimated by a
HyperLogLog sketch, merged by aggregation.  Estimates of ``min_sites * 2`` and more
are boilerplate, those under ``min_sites / 2`` are not, and lines between get exact
distinct counts.  Lines of any length count that hold a letter or digit.  A boilerplate line stays once, at its
first place (smallest doc_id, then position), and goes everywhere else.

``min_sites`` follows from the counted number of sites: ``SHARE`` of them, but at least ``FEWEST`` and at most
``MIN_SITES``.

Only (doc_id, text hash, position, line hash, site) rows are shuffled for the
counts; texts move once, to meet the hashes that they lose.

Defined cases: a null text stays null and has no lines; a null site is no site;
null doc_ids sort first; repeated rows (same id and text) are one document and are
treated alike; very long texts are cut into lines whole; lines without a letter or digit are never boilerplate; a table of under
``FEWEST`` sites loses no line; an empty table gives no rows; other columns are kept, also where their names clash with ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written

#: Sites that make a line boilerplate: two in five of all, between these bounds.
FEWEST, MIN_SITES, SHARE = 3, 8, (2, 5)
#: Relative error of the sketches (128 registers).
SKETCH_ERROR = 0.1


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _counts(trimmed: Column) -> Column:
    """Whether a line can be boilerplate."""
    return trimmed.rlike(r"[\p{L}\p{N}]")


def threshold(docs: DataFrame, site: str) -> int:
    """``min_sites`` of a table: one aggregate over its site column."""
    sites = docs.select(F.col(site).cast("string").alias("s")).agg(F.count_distinct("s")).first()[0]
    return min(MIN_SITES, max(FEWEST, -(-sites * SHARE[0] // SHARE[1])))


def line_table(docs: DataFrame, site: str) -> DataFrame:
    """``doc_id, body`` (text hash)``, pos, a, b`` (line hash)``, site`` of every line that counts."""
    line = _trimmed(F.col("line"))
    return (docs.select(F.col("doc_id"), F.xxhash64("text").alias("body"), F.col(site).cast("string").alias("site"),
                        F.posexplode(_lines("text")).alias("pos", "line"))
            .where(_counts(line))
            .select("doc_id", "body", "site", "pos", F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Line hashes on ``min_sites`` sites or more, with the place of their first occurrence."""
    first = F.min(F.struct("doc_id", "pos", "body")).alias("first")
    spread = written(lines.groupBy("a", "b").agg(F.approx_count_distinct("site", SKETCH_ERROR).alias("sites"), first)
                     .where(F.col("sites") >= min_sites / 2), "line-spread")
    sure = spread.where(F.col("sites") >= min_sites * 2)
    near = spread.where(F.col("sites") < min_sites * 2)
    # Pairs are made distinct map-side first, so a line on all documents costs one row per task and site.
    exact = (lines.join(near.select("a", "b"), ["a", "b"], "left_semi").groupBy("a", "b", "site").agg(F.lit(1).alias("one"))
             .groupBy("a", "b").agg(F.count("site").alias("exact")).where(F.col("exact") >= min_sites))
    return sure.select("a", "b", "first").unionByName(
        near.join(exact.select("a", "b"), ["a", "b"]).select("a", "b", "first"))


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int | None = None,
                counts: tuple[str, ...] = ("n_lines", "n_removed", "n_removed_chars")) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``, and counts under the given names (a column of
    ``docs`` of such a name is replaced): lines, lines and characters removed."""
    min_sites = threshold(docs, site) if min_sites is None else min_sites
    lines = written(line_table(docs, site), "lines")
    hits = lines.join(boilerplate(lines, min_sites), ["a", "b"])
    stays = (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))
             & (F.col("body") == F.col("first.body")))
    # Distinct lines of one document, and where (of those that begin here) they stay.
    gone, kept, given, whole = (fresh(docs, c) for c in ("_gone", "_kept", "_id", "_body"))
    marks = hits.groupBy(F.col("doc_id").alias(given), F.col("body").alias(whole)).agg(
        F.collect_set("a").alias(gone), F.collect_set(F.when(stays, F.col("pos"))).alias(kept))
    marked = docs.withColumn(whole + "x", F.xxhash64("text")).join(
        marks, F.col("doc_id").eqNullSafe(F.col(given)) & (F.col(whole + "x") == F.col(whole)), "left")

    def goes(line: Column, pos: Column) -> Column:
        t = _trimmed(line)
        return _counts(t) & F.array_contains(F.col(gone), F.xxhash64(t)) & ~F.array_contains(
            F.col(kept), pos)

    split = _lines("text")
    left = F.filter(split, lambda x, i: ~goes(x, i))
    touched = F.col(gone).isNotNull()
    clean = F.when(touched, F.array_join(left, "\n")).otherwise(F.col("text"))
    columns = [clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns
               if c not in counts]
    n = F.coalesce(F.size(split), F.lit(0))
    return marked.select(
        *columns, F.greatest(n, F.lit(0)).cast("long").alias(counts[0]),
        F.when(touched, F.size(split) - F.size(left)).otherwise(0).cast("long").alias(counts[1]),
        F.when(touched, F.char_length("text") - F.char_length(clean)).otherwise(0).cast("long").alias(counts[2]))


def clean_documents(docs: DataFrame, site: str = "source") -> DataFrame:
    """``docs`` with cleaned ``text`` (``n_chars`` to match), without documents that this leaves blank: all that they
    had stays elsewhere.  A document that keeps anything keeps its row."""
    counts = tuple(fresh(docs, "_" + c) for c in ("lines", "removed", "lost"))
    out = dedup_lines(docs, site, counts=counts)
    removed = F.col(counts[1])
    blank = F.btrim("text", F.lit(" \t\n\r\x0b\x0c")) == ""
    out = out.where((removed == 0) | ~blank)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(removed > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = f"""
WITH t AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM t),
k AS (SELECT doc_id, source, line, pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM l),
s AS (SELECT t, min((doc_id, pos)) AS first FROM k WHERE regexp_matches(t, '[\\p{{L}}\\p{{N}}]') GROUP BY t HAVING count(DISTINCT source) >=
      (SELECT least({MIN_SITES}, greatest({FEWEST}, (count(DISTINCT source) * {SHARE[0]} + {SHARE[1] - 1}) // {SHARE[1]})) FROM documents)),
m AS (SELECT k.doc_id, k.pos, k.line, s.t IS NOT NULL AND (k.doc_id, k.pos) <> s.first AS gone
      FROM k LEFT JOIN s ON k.t = s.t)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM m GROUP BY doc_id"""

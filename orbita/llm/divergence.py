"""Source divergence audit: how far each source's term frequencies lie from its language's.

Terms are runs of letters (A-Z lower-cased, every non-ASCII character a letter).  A language
keeps the terms found in ``min_docs`` of its documents or more.  Each (lang, source) group and each
language gives a kept term the smoothed share ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``; the
divergence at a term is ``f = |p - q|``.

Part ``term`` ranks a group's over-used terms.  Terms of equal (group count, language count) have
equal ``f``, so they form a cell: ``f`` is evaluated once a cell, cells of equal value are merged and
ranked by their cumulative multiplicity, and only cells that reach the first ``top`` ranks are
expanded, in UTF-8 order.  Part ``pair`` sums ``f`` between two sources of a language over all kept terms: terms
are dealt to chunks and sources to blocks, and a task holds one chunk of two blocks as a matrix.

Counting is combined per task in Python (a bounded table of distinct terms); all the rest is
DataFrame work on counts.  Nothing is collected or broadcast by hand.  All arithmetic is exact
(decimals and 64-bit integers).

Defined cases: null text, lang and source are ''; every row is a document, repeated ones and those without
an id too; a group without terms still has its pairs; a language without kept terms has pairs of value 0
and no term rows; a source alone in its language has no pairs; very long texts are cut into terms whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, text_or_empty, written

MIN_DOCS, TOP = 30, 50
UNIT, SMOOTH = 1_000_000_000, 5
#: Distinct (lang, source, term) that a task counts before it hands them on (about 200 bytes each).
TALLY = 300_000
#: Terms and sources of one matrix of the pair part (two blocks of sources side by side).
CHUNK_TERMS, BLOCK_SOURCES = 4096, 64

_LETTER = bytes(b if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: One pass over the bytes of a text: letters lower-cased, everything else a space.
NORMAL = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b for b in _LETTER)


def terms(text: bytes) -> list[bytes]:
    """Terms of a text's UTF-8 bytes, in order."""
    return text.translate(NORMAL).split()


def tally(docs: DataFrame, limit: int = TALLY) -> DataFrame:
    """``lang, source, term, n, docs``: counts of terms and of documents that hold them, combined within a task.

    A key appears once for each time a task's table filled up."""
    bound_batches(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def handed(table):
        for (lang, source), (count, found) in table.items():
            keys = list(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()), pa.array(keys, pa.binary()),
                 pa.array(list(count.values()), pa.int64()), pa.array([found[k] for k in keys], pa.int64())], names=names)

    def counted(batches):
        table: dict = {}
        for batch in batches:
            for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = terms(text)
                if not found:
                    continue
                entry = table.get((lang, source))
                if entry is None:
                    entry = table[lang, source] = (Counter(), Counter())
                entry[0].update(found)
                entry[1].update(set(found))
            if sum(len(c) for c, _ in table.values()) > limit:
                yield from handed(table)
                table = {}
        yield from handed(table)

    read = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"),
                       text_or_empty().cast("binary").alias("text"))
    return read.mapInArrow(counted, "lang string, source string, term binary, n long, docs long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, source, n, lang_n, first``: counts of the kept terms in each group that has them, and in the
    language; ``first`` marks one row of each (lang, term)."""
    counts = (tally(docs).repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")  # one row a source
    return (counts.withColumn("lang_n", F.sum("n").over(term)).withColumn("lang_docs", F.sum("docs").over(term))
            .withColumn("first", (F.min("source").over(term) == F.col("source")).cast("long"))
            .where(F.col("lang_docs") >= min_docs).select("lang", "term", "source", "n", "lang_n", "first"))


def share(n: Column, total: Column, v: Column) -> Column:
    """``1 + floor(UNIT (n + SMOOTH) / (total + SMOOTH v))``, exact (null where there is no kept term)."""
    over = (n + SMOOTH).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    under = (total + SMOOTH * v).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", over, F.when(v > 0, under))


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per occurring (lang, source): its total ``n_group``, the language's ``n_lang``, ``v`` kept terms,
    the share ``p0`` of an absent term, its index among the language's ``sources``."""
    groups = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("first").alias("firsts"))
    lang = Window.partitionBy("lang")  # one row a source
    zero = F.lit(0).cast("long")
    return (groups.join(sums, ["lang", "source"], "left")
            .withColumn("n_group", F.coalesce("n", zero))
            .withColumn("n_lang", F.sum("n_group").over(lang)).withColumn("v", F.coalesce(F.sum("firsts").over(lang), zero))
            .withColumn("p0", F.coalesce(share(zero, F.col("n_group"), F.col("v")), zero))
            .withColumn("sources", F.count("*").over(lang))
            .withColumn("idx", (F.row_number().over(lang.orderBy("source")) - 1).cast("long"))
            .select("lang", "source", "n_group", "n_lang", "v", "p0", "sources", "idx"))


def top_terms(kept: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """Part ``term``: the first ``top`` ranks of each group."""
    group = ["lang", "source"]
    cells = (kept.groupBy(*group, "n", "lang_n").agg(F.count("*").alias("m")).join(totals, group)
             .withColumn("p", share(F.col("n"), F.col("n_group"), F.col("v")))
             .withColumn("q", share(F.col("lang_n"), F.col("n_lang"), F.col("v")))
             .where(F.col("p") > F.col("q")).withColumn("value", F.col("p") - F.col("q"))
             .select(*group, "n", "lang_n", "m", "value"))
    # Every value stands for one term at least, so values behind the first ``top`` reach no rank.
    order = Window.partitionBy(*group).orderBy(F.desc("value"))
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    values = (cells.groupBy(*group, "value").agg(F.sum("m").alias("m"))
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
              .withColumn("before", F.coalesce(F.sum("m").over(ahead), F.lit(0))).where(F.col("before") < top)
              .select(*group, "value", "before"))
    reached = cells.join(values, [*group, "value"]).select(*group, "n", "lang_n", "value", "before")
    within = Window.partitionBy(*group, "value").orderBy("term")  # binary order is UTF-8 order
    return (kept.select(*group, "term", "n", "lang_n").join(reached, [*group, "n", "lang_n"])
            .withColumn("place", F.row_number().over(within)).where(F.col("place") <= top)
            .withColumn("rank", (F.col("before") + F.col("place")).cast("int")).where(F.col("rank") <= top)
            .select(*group, F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"))


def _pair_sums(table: pa.Table, block: int) -> pa.Table:
    """``|p_i - p_j|`` summed over a chunk's terms, for the source pairs of two blocks.

    Rows without a term give a source's share of absent terms."""
    term, idx = table.column("term").combine_chunks(), table.column("idx").to_numpy()
    p, blank = table.column("p").to_numpy(), term.is_null().to_numpy(zero_copy_only=False)
    sources = np.unique(idx[blank])
    base = np.zeros(len(sources), dtype=np.int64)
    base[np.searchsorted(sources, idx[blank])] = p[blank]
    coded = term.filter(pa.array(~blank)).dictionary_encode()
    shares = np.tile(base, (len(coded.dictionary), 1))
    shares[coded.indices.to_numpy(), np.searchsorted(sources, idx[~blank])] = p[~blank]
    x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
    out = []
    for i in np.flatnonzero(sources // block == x):
        j = np.flatnonzero((sources // block == y) & (sources > sources[i]))
        if len(j):
            out.append((np.full(len(j), sources[i]), sources[j], np.abs(shares[:, j] - shares[:, i:i + 1]).sum(axis=0)))
    a, b, value = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.int64()),
                     "b": pa.array(b, pa.int64()), "value": pa.array(value, pa.int64()),
                     "terms": pa.array(np.full(len(a), len(coded.dictionary)), pa.int64())})


def source_pairs(kept: DataFrame, totals: DataFrame, chunk_terms: int = CHUNK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """Part ``pair``: each other source of the language by divergence, all ranks."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("v") / chunk_terms)).cast("int")
    rows = (kept.select("lang", "source", "term", "n").join(totals, ["lang", "source"])
            .withColumn("p", share(F.col("n"), F.col("n_group"), F.col("v")))
            .withColumn("chunk", F.pmod(F.xxhash64("term"), chunks).cast("int")))
    blank = (totals.withColumn("term", F.lit(None).cast("binary")).withColumn("p", F.col("p0"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))))
    columns = ["lang", "idx", "sources", "term", "p", "chunk"]
    block = F.floor(F.col("idx") / block_sources).cast("int")
    blocks = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / block_sources).cast("int"))
    dealt = (rows.select(*columns).unionByName(blank.select(*columns)).withColumn("other", F.explode(blocks))
             .select("lang", F.least(block, "other").alias("x"), F.greatest(block, "other").alias("y"), "chunk", "idx", "term", "p"))
    sums = (dealt.groupBy("lang", "x", "y", "chunk").applyInArrow(lambda t: _pair_sums(t, block_sources),
                                                                "lang string, a long, b long, value long, terms long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))

    def side(name):
        return totals.select("lang", F.col("idx").alias(name), F.col("source").alias(f"source_{name}"), F.col("p0").alias(f"p0_{name}"), *(
            ["v"] if name == "a" else []))

    # Terms that neither of a chunk's two blocks has count as absent from both sources.
    both = (sums.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
            .withColumn("value", F.col("value") + (F.col("v") - F.col("terms")) * F.abs(F.col("p0_a") - F.col("p0_b")))
            .withColumn("way", F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                                                 F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (both.select("lang", "way.source", "way.item", "value").withColumn("rank", F.row_number().over(order).cast("int"))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: both parts."""
    kept = written(kept_terms(docs, min_docs), "kept-terms")
    totals = written(group_totals(docs, kept), "group-totals")
    return source_pairs(kept, totals).unionByName(top_terms(kept, totals, top))


ORACLE = f"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
x AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(x.n, 0) AS n FROM g JOIN k ON g.lang = k.lang
      LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT c.lang, c.source, c.term, c.n, 1 + ({UNIT}::HUGEINT * (c.n + {SMOOTH})) // (s.n + {SMOOTH} * l.v) AS p,
             1 + ({UNIT}::HUGEINT * (c.lang_n + {SMOOTH})) // (l.n + {SMOOTH} * l.v) AS q
      FROM c JOIN s ON c.lang = s.lang AND c.source = s.source JOIN l ON c.lang = l.lang),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b
           ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pair.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= {TOP}"""

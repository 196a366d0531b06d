"""Small tables for the edge cases that every operator defines."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra="", schema=DOCS):
    """Rows of (doc_id, text) or (doc_id, text, source); the rest is filled in."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, schema)


def edge_rows():
    long = " ".join(f"w{i % 977} x{i % 13}" for i in range(40_000))
    return [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""),
            (4, " \n\t "), (None, "no id here at all, but some words"), (5, long), (6, "one"), (7, "é ü 日本 \U0001F642\r\n x"),
            (None, None)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def clashing(df, *names):
    """``df`` with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    for n in names:
        df = df.withColumn(n, F.lit("kept"))
    return df

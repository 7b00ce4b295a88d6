"""Small tables with the cases every operator must take: nulls, empty and long texts, ties, repeated
rows, no rows, and columns that clash with the operators' own."""

from __future__ import annotations

import duckdb
from comparison import DATA

SF = f"{DATA}/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, size long, fp long, key string, score double"
PROSE = "Once upon a time there was a small engine that read every single word of a very long book. "


def documents(spark, rows):
    """(doc_id, text[, source]) rows with clashing columns besides."""
    full = []
    for row in rows:
        doc_id, text, source = (*row, "a")[:3]
        full.append((doc_id, text, None, source, None if text is None else len(text), 5, 6, 7, "k", 0.5))
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    return documents(
        spark,
        [
            (1, None),
            (2, ""),
            (None, "no id"),
            (3, " \t\n\x0b\x0c\r "),
            (4, "twice the same row"),
            (4, "twice the same row"),
            (5, "twice the same row", None),
            (6, PROSE * 400),
            (7, PROSE * 400),
            (8, "x" * 300_000),
            (9, "näïve ß \U0001f600   tail", "ü"),
            (None, None, None),
        ],
    )


def table(name):
    return duckdb.sql(f"select * from '{SF}/{name}.parquet'").fetchall()


def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())



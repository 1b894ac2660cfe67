"""Rows that every operator has to take: nulls, blanks, long texts, repeats, clashing names."""

from __future__ import annotations

import duckdb

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# names that the operators use inside
CLASHING = "id string, n long, k1 string, k2 string, digest string, component string, rate string, spans string"
SCHEMA = f"doc_id long, text string, source string, {CLASHING}"
LONG = "Lorem ipsum dolor sit amet consectetur 4111 1111 1111 1111 adipiscing elit. " * 1000


def awkward_rows() -> list[tuple]:
    texts = [
        (1, "The same text twice", "a"), (1, "The same text twice", "a"), (2, "THE SAME text Twice", "b"),
        (3, "", "a"), (4, None, None), (5, "   \t\n ", "a"), (None, "no id at all", None), (None, None, None),
        (6, LONG, "a"), (7, LONG + "x", "b"), (8, "ÄÖÜ éé 中文 𝄞 text", "c"), (9, "äöü éé 中文 𝄞 text", "c"),
        (10, "one", "a"), (11, "a\x00b \x1c c d e", "a"),
        (12, "mail x@y.example.org or +1 (555) 010-9999 from 10.0.0.1 now", "b"),
    ]
    return [(i, t, s, "x", 7, "x", "x", "x", "x", "x", "x") for i, t, s in texts]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given(sf_dir: str, name: str, columns: str) -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()

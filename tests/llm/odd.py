"""Rows that every operator must stand: missing values, empty and long texts, repeated rows, columns with clashing names."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size int, sha string, keep_id int, key string, mark string, rate int, number int, _text string, bucket int, chunk int"
)


def rows() -> list[tuple]:
    clash = (1, "x", 2, "k", "m", 3, 4, "t", 5, 6)
    made = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n", None, "a", 3),
        (4, "The cat sat on the mat and looked at the very small dog", "en", "a", 1),
        (5, "The cat sat on the mat and looked at the very small dog", "en", "b", 1),
        (5, "The cat sat on the mat and looked at the very small dog", "en", "b", 1),
        (6, "Der Hund läuft über die Straße 😀 und bellt", "de", "b", 1),
        (7, "word " * 60_000, "en", "c", 1),
        (8, "x" * 300_000, None, "c", 1),
        (None, "no id here", "en", "d", 1),
        (None, None, None, None, None),
        (9, "####### 12345", "de", "d", 1),
    ]
    return [(*row, *clash) for row in made]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)

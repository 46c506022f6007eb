"""Small document tables with the awkward cases every operator has to stand."""

from __future__ import annotations

LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(30_000))
SAME = "the quick brown fox jumps over the lazy dog while seven wizards quietly judge my vow"
#: doc_id, text, lang, source, n_chars and a column that clashes with a result column.
ROWS = [
    (1, SAME, "en", "a", None, 0.5), (2, SAME, "en", "a", 3, 0.5), (2, SAME, "en", "a", 3, 0.5),
    (3, None, None, None, None, None), (4, "", "en", "a", 0, 0.1), (5, " \t\n\v\f\r ", "en", "b", 7, 0.1),
    (6, "Two words", "en", "b", 9, 0.1), (None, "a text without an id but with words", "en", "b", 1, 0.1),
    (7, LONG, "en", "a", 1, 0.1), (8, "ÉTÉ à la plage é è " * 4, "fr", "c", 1, 0.1), (9, SAME + " zebra", "en", "b", 1, 0.1),
]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"


def documents(spark, rows=ROWS, parts: int = 3):
    return spark.createDataFrame(rows, COLUMNS).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)

"""Odd rows and plain definitions that the operators are held against."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

LONG = " ".join(f"word{n % 977} and {n}" for n in range(20_000))

# Null, empty and blank texts, a very long one and its copy, a null id, repeated rows.
ODD = [
    (1, "The first of the plain texts, with some words in it.\nAnd a second line for good measure here."),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (5, LONG),
    (6, LONG),
    (None, "A text without an id, which must not stop anything."),
    (7, "Ein deutscher Text, der zweimal da ist. Über Äpfel und Öl."),
    (7, "Ein deutscher Text, der zweimal da ist. Über Äpfel und Öl."),
    (8, "中文 字 \U0001f600 x▁y\x00z"),
]

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, node string, "
    "place string, block string, part string, root string, c0 string, kept string, rows string, shard string, "
    "held_out string, toxic string, quality string, n_tokens string, signature string, count bigint"
)


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def odd_documents(spark):
    """The odd rows with columns whose names the operators use inside."""
    width = COLUMNS.count(",") + 1
    langs = {7: "de"}
    data = [(i, t, langs.get(i, "en"), None if i == 3 else "s", 0, *["x"] * (width - 6), 1) for i, t in ODD]
    return spark.createDataFrame(data, COLUMNS)


def documents(spark, texts, first: int = 0):
    data = [(first + n, t, "en", f"s{n % 3}", len(t or "")) for n, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")

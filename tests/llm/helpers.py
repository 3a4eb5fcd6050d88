"""Documents for the tests: rows that repeat, nulls, empty and long texts."""

from __future__ import annotations

import random

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = ["the", "and", "river", "stone", "über", "niño", "cat", "of", "light", "a", "ça", "x9", "日本", "😀"]
SPACES = [" ", "  ", "\n", "\t", " \r\n", "\x0b", "\x0c"]


def text_of(rng: random.Random, n: int, words=VOCABULARY) -> str:
    return "".join(w + rng.choice(SPACES if rng.random() < 0.2 else [" "]) for w in rng.choices(words, k=n))


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with copies, near copies, shared passages and odd rows."""
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(400)] + VOCABULARY
    passage = text_of(rng, 45, names)
    rows: list[tuple] = []
    for i in range(n):
        text = text_of(rng, rng.choice([0, 1, 3, 19, 20, 21, 60, 200]), names)
        kind = rng.random()
        if rows and kind < 0.15:
            text = rows[rng.randrange(len(rows))][1] or ""
        elif rows and kind < 0.3:
            words = (rows[rng.randrange(len(rows))][1] or "").split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind < 0.45:
            text += passage + text_of(rng, 5, names)
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None]), len(text)))
    last = n
    for text in (None, "", " \n\t", "again " * 300, "p q r s t u " * 40, rows[5][1], text_of(rng, 9000, names)):
        rows.append((last, text, "en", "s1", None))
        last += 1
    return rows


def frame(spark, rows, extra: bool = False):
    """A DataFrame of the rows; with ``extra`` also columns named like inner ones."""
    df = spark.createDataFrame(rows, DOC_DDL)
    if extra:
        from pyspark.sql import functions as F
        for name in ("row", "id", "t", "h", "size", "rng", "fp", "tie", "wanted", "place", "kept", "head", "a.b"):
            df = df.withColumn(name, F.lit("x"))
    return df


def by_id(df, key: str = "doc_id") -> dict:
    return {r[key]: r.asDict() for r in df.collect()}

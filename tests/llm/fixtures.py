"""Small hand-made documents: nulls, empty and long texts, copies, near copies, odd characters."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, score string, row string, bucket string, n_tokens string, added string"
EXTRA = ("x", "y", "z", "t", "a")


def texts(seed: int = 0) -> list[tuple[int | None, str | None]]:
    rnd = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma,", "delta.", "de", "la", "über", "été", "日本", "x@y.org", "&", "\u00a0w", "I'll", "don't"]
    word = lambda: rnd.choice(vocabulary) + str(rnd.randrange(40))
    base = [word() for _ in range(120)]
    rows: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "one two three four"), (6, "ONE two three FOUR"),
        (7, " ".join(base)), (8, " ".join(base)), (None, " ".join(base)), (9, " ".join(base[:119])),
        (10, "la " * 900), (11, "la la la"), (12, "a" * 5000), (12, "a" * 5000), (13, "é" * 150 + "\n" + "z" * 30),
        (14, " ".join(base[10:70])), (15, "\U0001F600 \x00 \ufffd <|endoftext|> <|ENDOFTEXT|> <s> ▁ ▁▁  x\n\ny"), (15, "other text with this id"),
    ]
    for i in range(16, 40):
        own = list(base) if i % 2 else [word() for _ in range(rnd.randrange(1, 200))]
        for _ in range(i % 9):
            own[rnd.randrange(len(own))] = word()
        rows.append((i, " ".join(own)))
    rows += [(40, " ".join(word() for _ in range(20_000))), (41, "Line one\nLine one\n\nother line\nLine one")]
    return rows


def frame(spark: SparkSession, rows: list) -> DataFrame:
    """With columns whose names operators use inside."""
    return spark.createDataFrame([(*r[:2], *EXTRA) for r in rows], SCHEMA).repartition(3)


def as_rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

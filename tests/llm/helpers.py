"""Small tables for the tests of the training-data operators."""

import random

from pyspark.sql import DataFrame, SparkSession

DATA = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n", "a", "É", "a b c d", "the " * 3000, "x" * 50_000, "日本語 テキスト", "1 2 3 +", "tab\there\r\n\x0b", "😀 " * 50]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row long"


def docs(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None, **columns) -> DataFrame:
    """A documents table; columns `score` and `row` are there to clash with what operators add."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (i, t, columns.get("lang", "en"), columns.get("source", "a"), None if t is None else len(t), 0.5, 1) for i, t in zip(ids, texts, strict=True)
    ]
    return spark.createDataFrame(rows, DOCS)


def odd_docs(spark: SparkSession) -> DataFrame:
    """Nulls in every column, repeated rows and ids, empty and long texts."""
    texts = [*ODD, None, "same text", "same text", "under one id", "under another text", None]
    ids = [*range(len(ODD)), None, 100, 100, 101, 101, 102]
    rows = docs(spark, texts, ids)
    null = spark.createDataFrame([(None,) * 7], DOCS)
    return rows.unionAll(null).unionAll(null)


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def edited(text: str, changes: int, seed: int = 1) -> str:
    rnd = random.Random(seed)
    words = text.split(" ")
    for i in rnd.sample(range(len(words)), changes):
        words[i] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)

"""Small tables with every awkward case, and brute-force versions to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names operators use themselves.
CLASHES = ["split", "id", "key", "kept", "keep_id", "group_size", "n_words", "n_removed", "kept_text", "score",
           "lang_pred", "ids", "decoded", "bucket", "__hash", "__maybe", "conv", "ts"]


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def documents(spark: SparkSession, rows: list[tuple], clashes: bool = False) -> DataFrame:
    """(doc_id, text) as a documents table; with ``clashes`` many more columns."""
    full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if clashes:
        df = df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES])
    return df


def awkward_rows() -> list[tuple]:
    rng = random.Random(5)
    long = prose(rng, 30_000)
    base = prose(rng, 60)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, base), (7, base.upper()), (8, base + " end"),
            (9, long), (10, long[:100_000]), (11, "é ü ñ 日本語 " + base), (None, base), (None, None), (6, base),
            (12, "x" * 5000), (13, "a\x00b \x1c c"), (14, "<turn> ## \\ </turn>")]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def fold(text: str) -> str:
    return text.translate({i: i + 32 for i in range(65, 91)})

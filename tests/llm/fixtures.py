"""Small document tables for the tests of the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "river stone cloud amber violet lantern meadow copper signal harbor winter thread maple orbit granite".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(r + (None, None))[:4] + (len(r[1]) if r[1] is not None else None,) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and letterless texts, ties, repeated rows, a very long text."""
    rng = random.Random(5)
    long = sentence(rng, 30_000)
    same = sentence(rng, 60)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\r\n", None, "a"), (4, "12 34 !?", "en", None),
        (5, long, "en", "a"), (6, long, "de", "b"), (7, same, "en", "b"), (8, same + " ", "en", "b"), (8, same + " ", "en", "b"),
        (None, same, "en", "c"), (None, None, None, None), (9, "one two three", "en", "c"), (10, "ONE two\tthree", "fr", "c"),
        (11, "été 你好 \U0001f600 <|endoftext|> İx", "fr", "c"),
    ]


def with_clashes(df: DataFrame) -> DataFrame:
    """The same table with further columns named like the operators' own."""
    names = "node root n u v block keep_id size target score kept _row text_sha256 component_id hash fingerprint".split()
    for name in names:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

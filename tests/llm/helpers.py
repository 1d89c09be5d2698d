"""Small document tables with every odd case."""

import random

from pyspark.sql import functions as F

SYLLABLES = "an be ci do er fa go hi in ja ku lo me no or pa re si ta un ve wo".split()


def words(rng, n):
    return [("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))) for _ in range(n)]


def prose(seed, n):
    return " ".join(words(random.Random(seed), n))


def odd_documents():
    """(doc_id, text): nulls, empty and long texts, repeats, ties, accents, marks, no spaces."""
    long = prose(1, 3000)
    passage = prose(2, 60)
    return [
        (1, None), (2, ""), (3, " "), (4, "a"), (5, prose(3, 40)), (6, prose(3, 40)),
        (7, passage + " " + prose(4, 50)), (8, prose(5, 50) + " " + passage), (9, long),
        (10, long[:-30] + " changed here"), (11, "naïve café — ÀÉ 日本語 😀 " + prose(6, 10)),
        (12, "x" * 700), (13, "ab" * 400), (14, "line\nline\nline\n\n\tend  "), (15, ""),
        (16, prose(7, 120)), (16, prose(7, 120)), (None, prose(8, 30)), (None, None),
        (17, "▁mark ▁ and <|endoftext|> here"), (18, prose(3, 39) + " other"),
    ]


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def with_clashes(docs):
    """Extra columns named like what operators add or use inside."""
    names = ["row", "digest", "_digest", "ids", "host", "kept", "score", "sketches", "text_", "n"]
    return docs.withColumns({name: F.lit(None).cast("string") for name in names})

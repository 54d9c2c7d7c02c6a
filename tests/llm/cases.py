"""Rows that every operator must take: nulls, empty, very long, tied and repeated."""

import random

WORDS = "river stone lamp garden paper window travel silver morning simple bridge cloud".split()
SCHEMA = "doc_id long, text string, id long, node string, shard string, score string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def edge_rows():
    long = prose(99, 30_000)
    return [
        (1, prose(1, 80)), (2, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, " \n\t "),
        (None, prose(2, 50)), (None, None), (6, long), (7, "one two"), (8, "é ß 日本 \x1c <|endoftext|> z"),
    ]


def frame(spark, rows=None):
    """Documents with extra columns whose names clash with those the operators use inside."""
    rows = edge_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, 0, "n", "s", "x") for i, t in rows], SCHEMA)


def empty(spark):
    return frame(spark, [])

"""Media posts as the operators read them, with columns whose names clash with the operators' own."""

import random
import uuid

from pyspark.sql import functions as F

SCHEMA = "id string, caption string, hashtag_id string, permalink string, score double, fp long, size int, block string, slot string, text string, key string, label string"
WORDS = "matcha latte whisk bowl foam green cup morning ritual uji kyoto powder sweet bitter iced oat milk ceremony grade stone".split()


def post_id(k):
    return str(uuid.UUID(int=k))


def posts(spark, rows):
    """rows: (id, caption[, hashtag_id[, permalink]]); the other columns hold what must not be read."""
    full = [(*row, *[None] * (4 - len(row)), 1.0, 7, 3, "b", "s", "t", "k", "l") for row in rows]
    return spark.createDataFrame(full, SCHEMA)


def caption(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"{draw.choice(WORDS)}{draw.randrange(vocabulary)}" for _ in range(n))


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def union_find(items, links):
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in items}


def empty(df):
    return df.filter(F.lit(False))

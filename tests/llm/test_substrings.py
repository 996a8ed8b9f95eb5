import random
import re

import pytest
from pyspark.sql import functions as F

from postlake.llm import substrings
from tests.llm.helpers import caption, empty, post_id, posts, rows_of


def brute(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s : s + window])
                first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < (i, s):
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def mixed_rows(n, window):
    draw, passages = random.Random(5), [caption(1000 + k, window + k) for k in range(12)]
    rows = []
    for k in range(n):
        parts = [caption(k, draw.randrange(0, 40))]
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages).split()
            low = draw.randrange(0, 6)
            parts += [" ".join(p[low:]), caption(5000 + draw.randrange(300), draw.randrange(0, 30))]
        rows.append((post_id(k), "\n".join(parts)))
    return rows


@pytest.mark.parametrize("flush", [1 << 20, 500])
def test_equals_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(substrings, "FLUSH_WORDS", flush)
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 200)
    rows = mixed_rows(150, 20)
    rows += [(post_id(900), rows[3][1]), (post_id(901), rows[3][1]), (post_id(902), "tick " * 70), (post_id(903), "a b " * 60), (post_id(904), "x\u00a0y " * 45)]
    cut = substrings.remove_repeats(posts(spark, rows).repartition(3))
    assert sorted(rows_of(cut, "id", "n_words", "n_removed", "kept_caption"), key=str) == brute(rows, 20)


def test_factors_point_at_equal_words(spark):
    rows = mixed_rows(80, 20)
    words = {i: t.split() for i, t in rows}
    found = rows_of(substrings.remove_repeats(posts(spark, rows)).select("id", F.explode("factors").alias("f")).select("id", "f.*"), "id", "start", "n_words", "ref_id", "ref_start")
    assert found
    for i, start, n, ref, at in found:
        assert n >= 20 and (ref, at) < (i, start)
        assert words[i][start : start + n] == words[ref][at : at + n]


def test_nulls_repeated_rows_long_texts_and_empty_table(spark):
    long = caption(1, 30_000, 10_000)
    text = caption(2, 50)
    rows = [(None, text), (post_id(1), text), (post_id(1), text), (post_id(2), None), (post_id(3), ""), (post_id(4), long), (post_id(5), long), (None, None)]
    found = sorted(rows_of(substrings.remove_repeats(posts(spark, rows)), "id", "n_words", "n_removed", "kept_caption"), key=str)
    assert found == brute(rows, 20)
    assert rows_of(substrings.remove_repeats(empty(posts(spark, rows))), "id") == []


def test_ids_may_be_numbers(spark):
    text = caption(3, 25)
    df = spark.createDataFrame([(10, text), (9, "lead " + text)], "id long, caption string")
    assert sorted(rows_of(substrings.remove_repeats(df), "id", "n_removed")) == [(9, 0), (10, 25)]


def test_a_frequent_phrase_spreads_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 1000)
    # Its only six words are the anchor of whatever window has the smallest hash there.
    phrase = "we use cookies on this site"
    rows = [(post_id(k), f"{caption(k, 18)} {phrase} {caption(7000 + k // 2, 18)}") for k in range(600)]
    table = posts(spark, rows).repartition(3)

    def windows_per_block():
        filed = substrings._filed(table.select("id", "caption", F.xxhash64("caption").alias("key")), 20)
        sizes = {}
        for block, body in rows_of(filed.filter("not done"), "block", "body"):
            n = int.from_bytes(body[:4], "little")
            sizes[block] = sizes.get(block, 0) + (len(body) - 4 - 20 * n) // 6
        return max(sizes.values()), sum(sizes.values())

    most, total = windows_per_block()
    monkeypatch.setattr(substrings, "HOT_SHARE", 1e9)
    unsplit, same = windows_per_block()
    assert total == same and most < unsplit / 2
    monkeypatch.setattr(substrings, "HOT_SHARE", 0.25)
    cut = substrings.remove_repeats(table)
    assert sorted(rows_of(cut, "id", "n_words", "n_removed", "kept_caption"), key=str) == brute(rows, 20)

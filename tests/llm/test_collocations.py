"""Phrases against plain dictionaries of counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import collocations as C
from tests.llm.helpers import empty, posts


def plain(rows, least=10, share=50, top=2000):
    out = []
    groups = {}
    for _, text, tag in rows:
        groups.setdefault(tag if tag is not None else "und", []).append(text or "")
    for tag, texts in groups.items():
        f = Counter()
        for text in texts:
            folded = text.translate({c: c + 32 for c in range(65, 91)})
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
                words = re.findall(r"[^\x20\x09]+", piece)
                for n in (1, 2, 3):
                    f.update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
        total = sum(n for p, n in f.items() if len(p) == 1)
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        scored = []
        for p, a in candidates.items():
            around = [n for q, n in candidates.items() if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q)))]
            if any(100 * n >= share * a for n in around):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((tag, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("hashtag_id", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def talk(seed, rows=150):
    draw = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(12)] + ["Été", "ß", "New", "York", "City", "x\x00y", "x\xa0y"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]

    def text():
        if draw.random() < 0.08:
            return draw.choice([None, "", " \t", ".,;"])
        words = draw.choices(vocabulary, weights, k=draw.randrange(1, 40))
        for _ in range(draw.randrange(3)):
            words += ["new", "york", "CITY"]
        return "".join(w + draw.choice([" "] * 9 + ["\t", "  ", ". ", "\n", "\r\n", ":", " !? "]) for w in words)

    return [(f"p{n}", text(), draw.choice(["a", "a", "b", None])) for n in range(rows)]


@pytest.mark.parametrize("head", [{}, {"head_words": 9, "head_pairs": 6}, {"head_words": 0, "head_pairs": 0}, {"top": 5}])
def test_phrases_equal_plain_counts(spark, head):
    rows = talk(4)
    got = found(C.caption_collocations(posts(spark, rows), **head))
    assert len(got) > 10
    assert got == plain(rows, top=head.get("top", 2000))


def test_pieces_of_a_task_are_flushed(spark, monkeypatch):
    rows = talk(5)
    monkeypatch.setattr(C, "AT_ONCE", 300)
    monkeypatch.setattr(C, "OWN_WORDS", 4)
    monkeypatch.setattr(C, "OPEN_GROUPS", 1)
    assert found(C.caption_collocations(posts(spark, rows), head_words=7, head_pairs=5)) == plain(rows)


def test_overlaps_count(spark):
    rows = [("p", "ha ha ha ha " * 10, "a")]
    assert found(C.caption_collocations(posts(spark, rows))) == plain(rows)


def test_long_caption_and_long_word(spark):
    long = "y" * 500
    rows = [("p", f"one two {long} three four, " * 5_000, "a"), ("q", "one two", "a")]
    got = found(C.caption_collocations(posts(spark, rows)))
    assert got == plain(rows) and any(long in r[2] for r in got)


def test_repeated_rows_count_each(spark):
    rows = [("p", "alpha beta", "a")] * 12
    assert found(C.caption_collocations(posts(spark, rows))) == [("a", 1, "alpha beta", 12, 12, 12, 24, 1_000_000)]


def test_empty_table(spark):
    assert C.caption_collocations(empty(posts(spark, [("a", "x", "t")]))).count() == 0
    assert C.caption_collocations(posts(spark, [("a", None, None), ("b", "", "t")])).count() == 0


def test_scores_are_exact(spark):
    rows = [(10**13 + 7, 10**14 - 3, 10**13 + 9), (3, 3, 3), (10, 19, 7)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(C.scores(*map(F.col, "alr"))).collect()
    assert [r[0] for r in got] == [10**6 * a * a // (left * right) for a, left, right in rows]


def test_tiles_count_every_pair():
    draw = np.random.default_rng(2)
    for spread in (3, 60, 5_000):
        left, right = (draw.integers(1, spread + 1, 20_000) for _ in range(2))
        a, b, n = C.count_tiles(left, right, tile_bits=4)
        assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == Counter(zip(left.tolist(), right.tolist()))
    assert len(C.count_tiles(left[:0], right[:0])[0]) == 0


def test_filter_lets_all_of_its_phrases_through(spark):
    phrases = [f"a{n} b{n % 7}" for n in range(500)]
    held = C.filter_of(spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    marks = lambda words: np.array([C.word_mark(w.encode()) for w in words], np.uint64)
    asked = C.pair_marks(*(marks(part) for part in zip(*[p.split() for p in phrases])))
    assert held.may_hold(asked).all()
    others = C.pair_marks(marks([f"c{n}" for n in range(500)]), marks(["b1"] * 500))
    assert held.may_hold(others).sum() < 5

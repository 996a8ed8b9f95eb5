import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlake.llm import line_quality, toxicity
from tests.llm.helpers import caption, empty, post_id, posts, rows_of

RUDE = ["moronic", "scumbag", "filthwit"]


def labelled(n):
    draw, rows, marks = random.Random(2), [], []
    for k in range(n):
        words = caption(k, draw.randrange(10, 80)).split()
        toxic = k % 4 == 0
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(RUDE))
        rows.append((post_id(k), " ".join(words)))
        marks.append((post_id(k), int(toxic)))
    return rows, marks


def test_toxicity_holds_on_the_held_out_fold(spark):
    rows, marks = labelled(600)
    table, labels = posts(spark, rows), spark.createDataFrame(marks + [(None, 1), (post_id(9999), None)], "id string, toxic int")
    model = toxicity.train_toxicity(table, labels)
    scored = {r[0]: r[1:] for r in rows_of(toxicity.score_toxicity(table, model), "id", "held_out", "score", "predicted")}
    truth = dict(marks)
    held = [i for i in truth if scored[i][0]]
    assert held and all(scored[i][0] == (zlib.crc32(i.encode()) % 5 == 0) for i in truth)
    assert np.mean([scored[i][2] == truth[i] for i in held]) > 0.97
    # Labels of the held-out fold change nothing.
    flipped = [(i, 1 - t if scored[i][0] else t) for i, t in marks]
    again = toxicity.train_toxicity(table, spark.createDataFrame(flipped, "id string, toxic int"))
    assert again.bias == model.bias and np.array_equal(again.weights, model.weights)


def test_toxicity_scores_every_row(spark):
    rows, marks = labelled(200)
    model = toxicity.train_toxicity(posts(spark, rows), spark.createDataFrame(marks, "id string, toxic int"))
    odd = posts(spark, [(None, None), (post_id(1), ""), (post_id(1), ""), (post_id(2), "a"), (post_id(3), caption(1, 30_000) + " moronic")])
    found = rows_of(toxicity.score_toxicity(odd, model), "id", "held_out", "score", "predicted")
    assert len(found) == 5 and all(0 <= s <= 1 and p == int(s >= 0.5) for _, _, s, p in found)
    assert [h for i, h, _, _ in found if i is None] == [False]
    assert rows_of(toxicity.score_toxicity(empty(odd), model), "id") == []


def test_toxicity_without_both_classes(spark):
    rows, marks = labelled(20)
    for kept, expected in (([], 0), ([m for m in marks if m[1]], 1)):
        model = toxicity.train_toxicity(posts(spark, rows), spark.createDataFrame(kept, "id string, toxic int"))
        assert {r[0] for r in rows_of(toxicity.score_toxicity(posts(spark, rows), model), "predicted")} == {expected}
    assert toxicity.train_toxicity(empty(posts(spark, rows)), spark.createDataFrame(marks, "id string, toxic int")).weights.size == 0


def test_toxicity_fit_holds_its_marks_once():
    batches = [pa.RecordBatch.from_pydict({"place": [k], "toxic": [k % 2], "caption": [caption(k, 2_000)]}) for k in range(60)]
    tracemalloc.start()
    at, begins, toxic = toxicity._marks(iter(batches))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert begins[0] == 0 and len(begins) == len(toxic) == 60 and toxic.tolist() == [k % 2 for k in range(60)]
    for k, part in enumerate(np.split(at, begins[1:])):
        assert part.tolist() == sorted(set(toxicity._grams([caption(k, 2_000)])[0].tolist()))
    # Beside them are the place notes of 4 MB, what one part's n-grams take, and what the buffer grows by.
    assert held < 1.3 * at.nbytes + (1 << 20) and peak < 1.3 * at.nbytes + (12 << 20), (held, peak, at.nbytes)


def test_toxicity_learns_rare_markers(spark):
    """Words in about 6 of 45 toxic texts and in no clean one are below four standard errors, and still the only sign there is."""
    markers = ["moronic", "scumbag", "filthwit", "wretchoid", "gutterpig", "slimeface", "dunghead"]
    rows, marks, toxic = [], [], 0
    for k in range(420):
        words, bad = caption(k, 40).split(), k % 8 == 0
        if bad:
            words.insert(20, markers[toxic % len(markers)])
            toxic += 1
        rows.append((post_id(k), " ".join(words)))
        marks.append((post_id(k), int(bad)))
    table = posts(spark, rows)
    model = toxicity.train_toxicity(table, spark.createDataFrame(marks, "id string, toxic int"))
    scored = {r[0]: r[1:] for r in rows_of(toxicity.score_toxicity(table, model), "id", "held_out", "predicted")}
    assert all(scored[i][1] for i, bad in marks if bad and not scored[i][0])
    assert not any(scored[i][1] for i, bad in marks if not bad)
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    for word in markers:
        assert np.mean([weight.get(g, 0.0) > 0 for g in toxicity._grams([word])[0].tolist()]) > 0.8  # hashes may meet


def plain_grams(text):
    """Hashed n-grams of one text, a character after the other."""
    mask, found = (1 << 32) - 1, []
    padded = f" {' '.join((text or '').lower().split())} "
    for n in (4, 5, 6):
        for k in range(len(padded) - n + 1):
            h = 0
            for c in padded[k : k + n]:
                h = ((h ^ (ord(c) * 0x9E3779B1 & mask)) * 0x85EBCA6B) & mask
                h ^= h >> 15
            found.append((h * 0xC2B2AE35 & mask) >> 12)
    return found


def test_ngrams_stay_in_their_text():
    texts = ["abcdef", None, "abcdef", "Été \n x", "", "🍵 tea tea"]
    for text, grams in zip(texts, toxicity._grams(texts)):
        assert sorted(grams.tolist()) == sorted(plain_grams(text))
    assert len(toxicity._grams(texts)[0]) == 5 + 4 + 3 and len(toxicity._grams([None])[0]) == 0


def test_scores_equal_plain_sums(spark):
    draw = np.random.default_rng(8)
    features = np.sort(draw.choice(1 << toxicity.BITS, 1 << 19, replace=False))
    model = toxicity.Model(0.3, features, draw.standard_normal(len(features)) / 50)
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    texts = [None, "", "a", caption(1, 30), caption(1, 30) * 3, "Ä  b\tc", caption(2, 4_000)]
    table = posts(spark, [(post_id(k), t) for k, t in enumerate(texts)])
    found = dict(rows_of(toxicity.score_toxicity(table, model), "id", "score"))
    for k, text in enumerate(texts):
        margin = 0.3 + sum(weight.get(g, 0.0) for g in set(plain_grams(text)))
        assert found[post_id(k)] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-5)


def test_slope_and_minimum_of_the_loss():
    draw = np.random.default_rng(9)
    texts = [draw.choice(30, draw.integers(0, 8), replace=False) for _ in range(600)]
    toxic = np.array([int(3 in t or draw.random() < 0.1) for t in texts])
    begins, at = np.cumsum([0, *map(len, texts)])[:-1], np.concatenate(texts).astype(np.int32)
    loss = toxicity.logistic_loss(at, begins, toxic, np.where(toxic, 1.5, 0.5), draw.standard_normal(30), 0.05)

    theta = draw.standard_normal(31)
    value, slope = loss(theta)
    for k in range(31):
        step = np.zeros(31)
        step[k] = 1e-6
        assert slope[k] == pytest.approx((loss(theta + step)[0] - loss(theta - step)[0]) / 2e-6, rel=1e-4, abs=1e-4)
    best = toxicity.minimise(loss, np.zeros(31), 40)
    plain = np.zeros(31)
    for _ in range(20_000):
        plain -= 0.002 * loss(plain)[1]
    assert loss(best)[0] <= loss(plain)[0] * 1.005


def test_rows_of_one_id_are_bounded(spark):
    rows = [(post_id(0), f"{caption(k, 30)} rotten") for k in range(300)] + [(post_id(k), caption(k, 30)) for k in range(1, 200)]
    marks = [(post_id(0), 1), (post_id(0), 0), *((post_id(k), 0) for k in range(1, 200))]
    table = posts(spark, rows)
    usable = spark.createDataFrame([(i, t) for i, t in marks if (i, t) != (post_id(0), 0)], "id string, toxic int")
    sample = toxicity._sample(table, usable, {0: 199, 1: 1}, 50, 10**9)
    assert {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()} == {0: 50, 1: 50}
    few = toxicity._sample(table, usable, {0: 199, 1: 1}, 50, 1_000)
    assert all(r["sum(length(caption))"] < 1_400 for r in few.groupBy("toxic").agg({"caption": "count"}).join(few.groupBy("toxic").agg(F.sum(F.length("caption"))), "toxic").collect())


def brute_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


TEXTS = [None, "", " \n\t", "one", "a b c d e f g h " * 4, "x " * 30, "l1\nl1\n\nl2 é ü\r\nl1 ", "# * $ % & | < > 🍵\n# * $", caption(1, 300), caption(2, 9) + "\n" + caption(2, 9)]


def test_base_figures_equal_brute_force(spark):
    table = posts(spark, [(post_id(k), t) for k, t in enumerate(TEXTS)])
    field = line_quality.train_field(table, spark.createDataFrame([], "id string, quality int"))
    columns = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    found = {r[0]: r[1:] for r in rows_of(line_quality.judge_captions(table, field), *columns)}
    for k, text in enumerate(TEXTS):
        figures = brute_figures(text)
        failed = figures[0] < 20 or 100 * figures[4] > 30 * figures[0]
        assert found[post_id(k)] == (*figures, failed, not failed)  # an untrained field keeps every line


def test_viterbi_equals_all_label_sequences():
    draw = np.random.default_rng(4)
    for n in range(1, 8):
        field = line_quality.Field(np.zeros((1, 2)), draw.standard_normal((2, 2)), draw.standard_normal(2))
        scores = draw.standard_normal((n, 2))

        def total(labels):
            return field.start[labels[0]] + sum(scores[t, a] for t, a in enumerate(labels)) + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))

        best = max(total([k >> t & 1 for t in range(n)]) for k in range(1 << n))
        assert total(line_quality.viterbi(scores, field).tolist()) == pytest.approx(best)


def test_field_tells_junk_from_prose(spark):
    draw, rows, marks = random.Random(6), [], []
    for k in range(300):
        good = k % 2
        prose = [f"{caption(k * 9 + j, draw.randrange(8, 20)).capitalize()}." for j in range(draw.randrange(3, 7))]
        junk = [" | ".join(caption(k * 9 + j, 10).split()) + " ###" for j in range(draw.randrange(3, 7))]
        rows.append((post_id(k), "\n".join(prose if good else junk)))
        marks.append((post_id(k), good))
    table, labels = posts(spark, rows), spark.createDataFrame(marks, "id string, quality int")
    field = line_quality.train_field(table, labels)
    found = dict(rows_of(line_quality.judge_captions(table, field), "id", "kept"))
    held = [(i, good) for i, good in marks if zlib.crc32(i.encode()) % 5 == 0]
    assert np.mean([found[i] == bool(good) for i, good in held]) > 0.97
    odd = posts(spark, [(None, rows[1][1]), (None, rows[1][1]), (post_id(5), caption(3, 40_000))])
    assert len(rows_of(line_quality.judge_captions(odd, field), "id", "kept")) == 3
    assert rows_of(line_quality.judge_captions(empty(odd), field), "id") == []

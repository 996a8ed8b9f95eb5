from collections import defaultdict

import numpy as np
import pytest

from postlake.llm import mixing
from tests.llm.helpers import caption, empty, post_id, posts, rows_of


def brute_targets(sizes):
    order = sorted(sizes, key=lambda t: (t is None, t or ""))
    weight = {t: (1, 2, 3)[k % 3] for k, t in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        share = {t: left * weight[t] / sum(weight[u] for u in open_) for t in open_}
        over = {t for t in open_ if share[t] > 3 * sizes[t] + 1e-9}
        if not over:
            return target | share
        for t in over:
            target[t] = 3.0 * sizes[t]
            left -= target[t]
        open_ -= over
    return target


@pytest.fixture(scope="module")
def table(spark):
    rows = [(post_id(k), caption(k, k % 90), ["aa", "b", None, "ü", "c"][min(4, k % 11)]) for k in range(900)]
    return posts(spark, rows + [(post_id(5000), caption(1, 40), "tiny"), (post_id(5001), None, "nothing")])


def test_targets_equal_step_by_step_sharing(spark):
    sizes = {"a": 10, "b": 1000, None: 7, "c": 50_000, "d": 0, "é": 300, "z": 5}
    found = mixing.mix_targets(spark.createDataFrame(list(sizes.items()), "hashtag_id string, source_size long"))
    found = {r[0]: r[1] for r in rows_of(found, "hashtag_id", "target")}
    assert found == pytest.approx(brute_targets(sizes))


def test_taken_comes_near_targets_and_no_post_exceeds_three_times_its_size(table):
    mixed = rows_of(mixing.taken_per_post(mixing.mix_posts(table, block=16)), "id", "hashtag_id", "size", "source_size", "target", "taken")
    assert len(mixed) == 902
    by_tag = defaultdict(lambda: [0, 0, 0])
    for _, tag, size, source, target, taken in mixed:
        assert taken <= 3 * size
        by_tag[tag][0] += taken
        by_tag[tag][1:] = [target, source]
    targets = brute_targets({t: v[2] for t, v in by_tag.items()})
    for tag, (taken, target, _) in by_tag.items():
        assert target == pytest.approx(targets[tag])
        assert abs(taken - target) <= 3 * 16
    again = rows_of(mixing.taken_per_post(mixing.mix_posts(table.repartition(7), block=16)), "id", "hashtag_id", "size", "source_size", "target", "taken")
    assert sorted(again, key=str) == sorted(mixed, key=str)


def test_small_tags_meet_their_targets_in_words(spark):
    rows = [(post_id(0), caption(0, 9_000), "big")] + [(post_id(k), caption(k, k), f"s{k:02d}") for k in range(1, 41)]
    mixed = rows_of(mixing.taken_per_post(mixing.mix_posts(posts(spark, rows))), "hashtag_id", "target", "taken", "size")
    assert len(mixed) == 41
    for tag, target, taken, size in mixed:
        assert taken <= 3 * size and abs(taken - target) <= (128 if tag == "big" else 1)


def test_posts_that_share_an_id_spread(spark):
    rows = [(None, caption(k, 5), "t") for k in range(9_000)]
    placed, _ = mixing.placed_posts(posts(spark, rows))
    # Offsets follow each other without a gap, and the order does not depend on how rows arrive.
    offsets = sorted(r[0] for r in placed.select("offset").collect())
    assert offsets == list(range(0, 45_000, 5))
    again, _ = mixing.placed_posts(posts(spark, rows[::-1]))
    assert sorted(rows_of(placed, "caption", "offset")) == sorted(rows_of(again, "caption", "offset"))


def test_pieces_are_words_of_their_posts(table):
    words = {i: (c or "").split() for i, c in rows_of(table, "id", "caption")}
    pieces = rows_of(mixing.mix_posts(table, block=16, shard_slots=40), "id", "start", "n_words", "text", "shard", "slot", "taken")
    slots = defaultdict(int)
    for i, start, n, text, shard, slot, taken in pieces:
        assert text.split() == words[i][start : start + n]
        if shard is not None:
            slots[shard, slot] += n
            assert taken == n
    assert max(slots.values()) == 16 and len({s for s, _ in slots}) > 10
    for shard in {s for s, _ in slots}:
        own = sorted(slot for s, slot in slots if s == shard)
        assert own == list(range(len(own)))


def test_permutation():
    for size in (1, 2, 3, 17, 1000, 4097):
        image = mixing.permuted(np.arange(size), size, 11)
        assert sorted(image.tolist()) == list(range(size))
    assert mixing.permuted(np.arange(1000), 1000, 1).tolist() != mixing.permuted(np.arange(1000), 1000, 2).tolist()


def test_nulls_repeated_rows_long_texts_and_empty_table(spark):
    rows = [(None, "a b", "t"), (post_id(1), "a b", "t"), (post_id(1), "a b", "t"), (post_id(2), None, None), (post_id(2), None, None), (post_id(3), caption(1, 20_000), None)]
    found = rows_of(mixing.taken_per_post(mixing.mix_posts(posts(spark, rows))), "id", "size", "taken")
    assert sorted((str(i), n) for i, n, _ in found) == sorted((str(i), len((c or "").split())) for i, c, _ in rows)
    assert rows_of(mixing.taken_per_post(mixing.mix_posts(empty(posts(spark, rows)))), "id") == []

import re

import numpy as np
import xxhash

from postlake.llm import simhash
from postlake.llm.common import components
from tests.llm.helpers import caption, empty, post_id, posts, rows_of, union_find


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_groups_equal_brute_force(spark):
    rows = [(post_id(k), caption(k, 600)) for k in range(40)]
    for k in range(40, 70):  # near copies: one word of an earlier caption changed
        words = caption(k % 9, 600).split()
        words[k % 60] = f"Changed{k}"
        rows.append((post_id(k), " ".join(words)))
    rows += [(post_id(70 + k), t) for k, t in enumerate(["", "one", "ONE", "two words", "İ Straße\u00a0x", "a b c d " * 9000, None])]
    found = {r[0]: r for r in rows_of(simhash.simhash_duplicates(posts(spark, rows), tile=8), "id", "fp", "component_id", "kept")}
    prints = {i: brute_fingerprint(t) for i, t in rows}
    ids = list(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    groups = union_find(ids, links)
    assert len(set(groups.values())) < len(ids) - 20
    for i in ids:
        assert found[i][1] % (1 << 64) == prints[i]
        assert found[i][2:] == (groups[i], groups[i] == i)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, "same text here again"), (post_id(2), "same text here again"), (post_id(2), "same text here again"), (post_id(3), None), (post_id(1), "")]
    found = rows_of(simhash.simhash_duplicates(posts(spark, rows)), "id", "component_id", "kept")
    assert sorted(found, key=str) == sorted(
        [(None, post_id(2), False), (post_id(2), post_id(2), True), (post_id(2), post_id(2), True), (post_id(3), post_id(1), False), (post_id(1), post_id(1), True)], key=str
    )
    assert rows_of(simhash.simhash_duplicates(empty(posts(spark, rows))), "id") == []


def test_links_skip_no_pair_within_the_radius():
    draw = np.random.default_rng(3)
    a = draw.integers(0, 1 << 63, 300, np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, n, np.uint64)) if n else np.uint64(0) for n in draw.integers(0, 7, 300)], np.uint64)
    b = a ^ flips
    left, right = simhash._links(a, b, 4)
    expected = {(i, j) for i in range(300) for j in range(300) if int(a[i] ^ b[j]).bit_count() <= 4}
    assert set(zip(left.tolist(), right.tolist())) == expected


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 180)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = dict(rows_of(components(spark.createDataFrame(edges, "src long, dst long")), "node", "component"))
    expected = union_find({n for e in edges for n in e if n is not None and e != (7, 7) and None not in e}, [e for e in edges if None not in e])
    assert found == expected
    assert rows_of(components(spark.createDataFrame([], "src long, dst long")), "node") == []

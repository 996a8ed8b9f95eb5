import struct
import zlib
from collections import Counter, defaultdict
from statistics import median

import xxhash
from pyspark.sql import functions as F

from postlake.llm import queries, sharding
from tests.llm.helpers import caption, empty, post_id, posts, rows_of

COLUMNS = ("post.id", "size", "shard", "slot", "grown_shard", "bucket", "post.score")


def test_slots_have_no_gap_and_growth_moves_rows_to_the_new_shard_only(spark):
    table = posts(spark, [(post_id(k), caption(k, k % 30)) for k in range(600)])
    found = rows_of(sharding.shard_posts(table, shards=7, bucket_bytes=4000), *COLUMNS)
    slots = defaultdict(list)
    for _, _, shard, slot, grown, _, extra in found:
        slots[shard].append(slot)
        assert grown in (shard, 7) and extra == 1.0
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({f[5] for f in found}) > 7 and Counter(f[0] for f in found) == Counter(post_id(k) for k in range(600))
    again = sharding.shard_posts(table.repartition(5), shards=7, bucket_bytes=4000)
    assert sorted(rows_of(again, *COLUMNS)) == sorted(found)
    grown = {i: s for i, s in rows_of(sharding.shard_posts(table, shards=8), "post.id", "shard")}
    assert all(grown[f[0]] == f[4] for f in found)


def test_order_inside_a_bucket_is_shuffled(spark):
    table = posts(spark, [(post_id(k), "x") for k in range(400)])
    found = sorted((slot, i) for i, slot in rows_of(sharding.shard_posts(table, shards=1), "post.id", "slot"))
    ids = [i for _, i in found]
    assert ids != sorted(ids) and sum(a < b for a, b in zip(ids, ids[1:])) in range(140, 260)


def test_nulls_repeated_rows_and_empty_table(spark):
    rows = [(None, None), (None, "x"), (None, "x"), (post_id(1), None), (post_id(1), ""), (post_id(2), "é" * 50_000)]
    found = rows_of(sharding.shard_posts(posts(spark, rows), shards=3), "post.id", "post.caption", "size", "shard", "slot")
    assert sorted(map(str, [f[:2] for f in found])) == sorted(map(str, rows))
    assert {f[2] for f in found} == {16, 17, 100_016}
    assert len({f[3:] for f in found}) == len(rows)
    assert rows_of(sharding.shard_posts(empty(posts(spark, rows))), "slot") == []


def plain_shard(key, shards, seed=20240215):
    """The shard by its definition: Spark's hash of several values takes the hash of one as the seed of the next."""

    def score(s):
        h = xxhash.xxh64_intdigest(key.encode(), 42)
        for part in (s, seed):
            h = xxhash.xxh64_intdigest(struct.pack("<i", part), h)
        return h - (1 << 64) if h >= 1 << 63 else h

    return max(range(shards), key=score)


def test_shards_are_those_of_plain_python(spark):
    rows = [(post_id(k), caption(k, 5)) for k in range(60)] + [(None, None), (None, "über"), (None, "")]
    found = rows_of(sharding.shard_posts(posts(spark, rows), shards=9), "post.id", "post.caption", "shard", "grown_shard")
    for i, text, shard, grown in found:
        key = i if i is not None else "?" + (text or "")
        assert (shard, grown) == (plain_shard(key, 9), plain_shard(key, 10))


def test_a_heavy_id_spreads_over_the_buckets_of_its_shard(spark):
    hot = [(None, "the same caption")] * 3000 + [(post_id(0), caption(k, 4)) for k in range(3000)]
    rows = hot + [(post_id(k), caption(k, 4)) for k in range(1, 3001)]
    table = posts(spark, rows)
    found = rows_of(sharding.shard_posts(table, shards=5, bucket_bytes=6000), "post.id", "post.caption", "shard", "bucket", "slot", "size")
    assert Counter(f[:2] for f in found) == Counter(rows)
    # The law holds for heavy ids too: all of one key in one shard.
    shards = defaultdict(set)
    for i, text, shard, *_ in found:
        shards[i or text].add(shard)
    assert all(len(s) == 1 for s in shards.values())
    sizes = Counter()
    for *_, bucket, _, size in found:
        sizes[bucket] += size
    assert max(sizes.values()) < 2 * median(sizes.values())
    slots = defaultdict(list)
    for _, _, shard, _, slot, _ in found:
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = rows_of(sharding.shard_posts(table, shards=5, bucket_bytes=6000), "post.id", "post.caption", "shard", "bucket", "slot", "size")
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_query_columns(spark, tmp_path):
    docs = [(1, "a b"), (2, None), (3, "é")]
    spark.createDataFrame(docs, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")}).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.QUERIES["op9_two_pass_shuffle"](spark, str(tmp_path)).collect()}
    for i, text in docs:
        r, raw = found[i], (text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (plain_shard(str(i), 40), plain_shard(str(i), 41))

"""Sharding of posts by a two-pass external shuffle."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.session import shared_dir, staged

LAW = "key"


def _highest(key, shards: int, seed: int):
    """The shard whose seeded hash with the key is highest. One more shard can only win keys for itself."""
    return F.array_max(
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(key, s, F.lit(seed)).alias("h"), s.alias("s")))
    )["s"]


def shard_posts(
    posts: DataFrame, shards: int = 40, seed: int = 20240215, bucket_bytes: int = 24 << 20, root: str | None = None
) -> DataFrame:
    """Write posts in random order into ``shards`` folders and return the written records.

    ``posts``: media posts, of which ``id`` and ``caption`` are read and all columns are kept. Pass one scatters
    records by seeded hashes into buckets that fit in memory: a shard is split into as many buckets as its own bytes
    need, and the id decides the bucket. Rows of an id that alone exceed ``bucket_bytes`` are dealt to the buckets of
    their shard row by row; these rows are stored first, so a task that runs again finds them in the same bucket. Pass two
    takes each bucket, in id order, through Spark's ``shuffle`` (a seeded Fisher-Yates pass over the bucket's array) and
    writes it into its shard's folder below ``root``, by default a fresh folder of the shared scratch space. A bucket is
    a task of its own. Only column expressions are used.

    Returns ``post`` (the whole record as a struct, so no column can clash), ``size`` (UTF-8 bytes of the caption plus
    16), ``shard``, ``grown_shard`` (the shard if there was one more: unchanged or the new one), ``bucket`` and
    ``slot``, which counts from 0 without a gap within the shard. The law is "key": id and number of shards decide.

    A null caption counts no bytes. A null id is dealt by its caption. Equal rows all stay, in one shard, and take
    different slots. A caption longer than a bucket makes a bucket that large. An empty table gives an empty result.
    """
    spark = posts.sparkSession
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("?"), F.coalesce("caption", F.lit(""))))
    size = (F.octet_length(F.coalesce("caption", F.lit(""))) + 16).cast("long")
    dealt = posts.select(
        F.struct(*[F.col(f"`{c}`") for c in posts.columns]).alias("post"), key.alias("key"), size.alias("size")
    ).withColumns({"shard": _highest(F.col("key"), shards, seed), "place": F.xxhash64("key", F.lit(seed + 1))})
    # One row per shard: how many buckets it needs, and the number of its first one.
    weights = {r.shard: r.bytes for r in dealt.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    parts = [max(1, -(-weights.get(s, 0) // bucket_bytes)) for s in range(shards)]
    firsts = [0, *accumulate(parts)]
    dealt = _spread(dealt, bucket_bytes)
    first, many = (F.element_at(F.array(*map(F.lit, v)), F.col("shard") + 1) for v in (firsts[:-1], parts))
    dealt = dealt.withColumns(
        {
            "grown_shard": _grown(F.col("key"), F.col("shard"), shards, seed),
            "bucket": (first + F.pmod("spread", many)).cast("int"),
        }
    )
    # Where each bucket starts in its shard: one row per bucket, dealt like the buckets so that their join moves no record.
    per_bucket = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = per_bucket.selectExpr(
        "bucket AS b", "sum(n) OVER (PARTITION BY shard ORDER BY bucket) - n AS first_slot"
    ).repartitionById(firsts[-1], "b")
    scattered = dealt.repartitionById(firsts[-1], "bucket").sortWithinPartitions("bucket", "key", F.expr("post.caption"))
    row = F.struct("post", "size", "shard", "grown_shard").alias("row")
    mixed = scattered.groupBy("bucket").agg(F.collect_list(row).alias("rows"))
    mixed = mixed.select("bucket", F.posexplode(F.shuffle("rows", seed)).alias("at", "row"))
    placed = mixed.join(starts, F.col("bucket") == F.col("b")).select(
        "row.*", "bucket", (F.col("first_slot") + F.col("at")).cast("long").alias("slot")
    )
    root = root or shared_dir(spark, "shards")
    placed.write.partitionBy("shard").parquet(root)
    return spark.read.schema(placed.schema).parquet(root)


def _spread(dealt: DataFrame, bucket_bytes: int) -> DataFrame:
    """Add ``spread``, the hash that picks a row's bucket: of its id, or of its own number where the id is too heavy.

    There are at most as many heavy ids as buckets. Their rows are written once, as row numbers would change
    if the table were read in another order.
    """
    heavy = dealt.groupBy("place").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > bucket_bytes)
    heavy = staged(heavy.select("place"), "heavy-ids")
    if heavy.isEmpty():
        return dealt.withColumn("spread", F.col("place"))
    rows = dealt.join(heavy, "place", "left_semi").withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    light = dealt.join(heavy, "place", "left_anti").withColumn("spread", F.col("place"))
    return light.unionByName(staged(rows, "heavy-rows"))


def _grown(key, shard, shards: int, seed: int):
    """The shard among one more: the new one where its hash is the highest of all."""
    new = F.xxhash64(key, F.lit(shards), F.lit(seed))
    return F.when(new > F.xxhash64(key, shard, F.lit(seed)), F.lit(shards)).otherwise(shard)

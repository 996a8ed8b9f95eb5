"""Mixing tags to target weights: packed blocks of words, drawn slots, permuted indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import WORD, n_words
from postlake.session import staged

BLOCK = 64
FEWEST_BLOCKS = 64
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
SHARD_SLOTS = 1 << 16
CHUNK_ROWS = 4_000

_U = np.uint64


def permuted(index: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Image of ``index`` under a pseudorandom permutation of 0 to size-1: a Feistel network, walked until in range."""
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    low = _U((1 << half) - 1)
    x = np.asarray(index, np.uint64).copy()
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> _U(half), x[todo] & low
        for turn in range(4):
            f = right * _U(0x9E3779B97F4A7C15) + _U((seed * 0x2545F4914F6CDD1D + turn * 0xD6E8FEB86659FD93) & ((1 << 64) - 1))
            f ^= f >> _U(32)
            f *= _U(0xD6E8FEB86659FD93)
            f ^= f >> _U(29)
            left, right = right, left ^ (f & low)
        x[todo] = (left << _U(half)) | right
        todo[todo] = x[todo] >= _U(size)
    return x.astype(np.int64)


def mix_targets(sizes: DataFrame) -> DataFrame:
    """``sizes(hashtag_id, source_size)`` with ``rank``, ``weight`` and ``target``.

    Tags in code point order, null last, weigh 1, 2, 3, repeating. Targets share all words by weight and stop at
    MOST_TIMES a tag's own size; the excess is shared by weight among the rest until none is above. That is
    min(cap, level x weight) with one level for all: each number of capped tags gives a level, the largest one
    holds. Windows run over one row per tag.
    """
    order = Window.orderBy(F.col("hashtag_id").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")))
    ranked = ranked.withColumn("cap", (MOST_TIMES * F.col("source_size")).cast("double"))
    every = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = every.rowsBetween(Window.unboundedPreceding, -1), every.rowsBetween(0, Window.unboundedFollowing)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level)
    top = F.max("level").over(whole)
    return leveled.withColumn("target", F.least("cap", top * F.col("weight"))).select("hashtag_id", "source_size", "rank", "weight", "target")


def _draw(batches: Iterator[pa.RecordBatch], shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Per tag, how many of its slots each output shard takes: a multinomial draw, so totals are exact."""
    for batch in batches:
        for rank, blocks, slots in zip(*(batch[c].to_pylist() for c in ("rank", "n_blocks", "n_slots"))):
            counts = np.random.default_rng([seed, rank]).multinomial(slots, np.full(shards, 1 / shards))
            first = np.cumsum(counts) - counts
            at = np.flatnonzero(counts)
            columns = [np.full(len(at), rank, np.int32), np.full(len(at), blocks), at, first[at], counts[at]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["rank", "n_blocks", "shard", "first", "n"])


def _place(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Every slot of a draw: the block that the tag's permutation gives it, and its place in the output shard."""
    for batch in batches:
        for rank, blocks, shard, first, n, before, size in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
            t = np.arange(first, first + n)
            columns = [
                np.full(n, rank, np.int32), permuted(t % blocks, blocks, seed + rank), t // blocks, np.full(n, shard),
                permuted(before + np.arange(n), size, seed ^ (shard + 1)),
            ]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["rank", "block", "times", "shard", "slot"])


def block_of(source_size: Column, most: int) -> Column:
    """Words per block of a tag: ``most``, and less for small tags, so that each has at least FEWEST_BLOCKS, or a word per block."""
    return F.greatest(F.lit(1), F.least(F.lit(most), F.floor(source_size / FEWEST_BLOCKS))).cast("long")


def placed_posts(posts: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Posts with ``size``, their tag's target and ``offset``, the words of the tag in front; and the tags' table.

    A tag's words are laid end to end: posts are dealt to chunks of about CHUNK_ROWS by a hash of id and text, ordered by id,
    size and text in a chunk, and chunks follow each other. So a tag with a third of all posts is summed up in many tasks, and
    so are posts that share an id, or have none.
    """
    sized = posts.select("id", "caption", "hashtag_id", n_words(F.col("caption")).alias("size"), F.xxhash64("caption").alias("text_hash"))
    sizes = sized.groupBy("hashtag_id").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_posts"))
    sizes = staged(sizes, "tag-sizes")
    total = sizes.agg(F.sum("n_posts")).first()[0] or 0
    targets = mix_targets(sizes.drop("n_posts")).withColumn("block_words", block_of(F.col("source_size"), block))
    tags = staged(targets, "tag-targets")
    chunks = max(1, -(-total // CHUNK_ROWS))
    renamed = tags.withColumnRenamed("hashtag_id", "tag")
    joined = sized.join(renamed, F.col("hashtag_id").eqNullSafe(F.col("tag"))).drop("tag")
    joined = joined.withColumn("chunk", F.pmod(F.xxhash64("id", "text_hash"), F.lit(chunks)))
    inside = Window.partitionBy("rank", "chunk").orderBy(F.col("id").asc_nulls_last(), "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    local = joined.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    lengths = joined.groupBy("rank", "chunk").agg(F.sum("size").alias("words"))
    starts = lengths.select(
        F.col("rank").alias("r"), F.col("chunk").alias("c"),
        (F.sum("words").over(Window.partitionBy("rank").orderBy("chunk")) - F.col("words")).alias("chunk_start"),
    )
    starts = staged(starts, "chunk-starts")
    placed = local.join(starts, (F.col("rank") == F.col("r")) & (F.col("chunk") == F.col("c")))
    return placed.select("id", "caption", "hashtag_id", "rank", "size", "source_size", "target", "block_words", (F.col("chunk_start") + F.col("inside")).alias("offset")), tags


def slots_of(tags: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """All slots of the mix: ``rank`` of the tag, ``block``, ``times`` it was taken before, output ``shard`` and ``slot``."""
    per_tag = tags.select(
        "rank", F.ceil(F.col("source_size") / F.col("block_words")).cast("long").alias("n_blocks"), F.round(F.col("target") / F.col("block_words")).cast("long").alias("n_slots")
    ).filter("n_blocks > 0 and n_slots > 0")
    total = per_tag.agg(F.sum("n_slots")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    drawn = per_tag.mapInArrow(lambda b: _draw(b, shards, seed), "rank int, n_blocks long, shard long, first long, n long")
    drawn = staged(drawn, "draws")
    shard = Window.partitionBy("shard").orderBy("rank")
    drawn = drawn.withColumn("before", F.sum("n").over(shard) - F.col("n")).withColumn("size", F.sum("n").over(Window.partitionBy("shard")))
    tasks = int(tags.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = drawn.repartition(tasks, "rank", "shard").mapInArrow(lambda b: _place(b, seed), "rank int, block long, times long, shard long, slot long")
    # Written, so that the join with blocks goes by the measured size: a plan takes the slots for as few as the draws.
    return staged(placed, "slots")


def mix_posts(posts: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """Mix the captions of posts so that the words of tags come in target shares.

    Reads ``id``, ``caption`` and ``hashtag_id`` of media posts. The words of a tag are packed into blocks of ``block`` words, of
    a small tag into smaller ones down to a word (the last may be shorter), so no tag loses its words to rounding; a tag gets as many slots as its target needs blocks, spread over output shards by a
    multinomial draw. Slot t of a tag takes the block that a pseudorandom permutation of the tag's blocks gives for t
    modulo their number, so blocks are taken equally often, up to once, and never over MOST_TIMES. Blocks and slots
    meet by index. Everything depends on seeds and ids only, so reruns agree.

    Returns one row per piece, a stretch of one post in one slot: ``id``, ``hashtag_id``, ``size`` (words of the post),
    ``source_size``, ``target``, ``offset`` (identifies the post's place in its tag), ``shard``, ``slot``, ``times``, ``start`` and
    ``n_words`` of the stretch, and its ``text``. A stretch no slot takes, and a post without words, has null ``shard``
    and ``slot`` and ``taken`` 0; otherwise ``taken`` is ``n_words``. A null tag is a tag of its own. Null and empty captions
    have no words. Posts without id and repeated rows are mixed like others.
    """
    placed, tags = placed_posts(posts, block)
    slots = slots_of(tags, shard_slots, seed)
    words_of_block = F.col("block_words")
    words = F.regexp_extract_all(F.coalesce("caption", F.lit("")), F.lit(WORD), F.lit(0))
    last = F.floor((F.col("offset") + F.col("size") - 1) / words_of_block)
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("offset") / words_of_block), last))
    pieces = placed.withColumn("words", words).drop("caption").withColumn("block", F.explode_outer(blocks))
    begin = F.greatest(F.lit(0), F.col("block") * words_of_block - F.col("offset"))
    end = F.least(F.col("size"), (F.col("block") + 1) * words_of_block - F.col("offset"))
    pieces = pieces.withColumn("start", begin).withColumn("n_words", F.coalesce(end - F.col("start"), F.lit(0)))
    cut = F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    pieces = pieces.withColumn("text", cut).drop("words")
    taken = slots.withColumnsRenamed({"rank": "r", "block": "b"})
    mixed = pieces.join(taken, (F.col("rank") == F.col("r")) & (F.col("block") == F.col("b")), "left")
    return mixed.select(
        "id", "hashtag_id", "size", "source_size", "target", "offset", "shard", "slot", "times", "start", "n_words", "text",
        F.when(F.col("slot").isNotNull(), F.col("n_words")).otherwise(0).alias("taken"),
    )


def taken_per_post(mixed: DataFrame) -> DataFrame:
    """``taken`` words per post: one row per row that was mixed, with its size and its tag's size and target."""
    keys = ["id", "hashtag_id", "size", "source_size", "target", "offset"]
    # Posts with words have offsets of their own; repeated rows without words are counted and given back.
    per_post = mixed.groupBy(*keys).agg(F.sum("taken").alias("taken"), F.count(F.when(F.col("size") == 0, 1)).alias("rows"))
    per_post = per_post.withColumn("row", F.explode(F.sequence(F.lit(1), F.greatest("rows", F.lit(1)))))
    return per_post.drop("offset", "rows", "row")

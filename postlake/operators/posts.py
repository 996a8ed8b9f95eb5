"""Current state of posts: the snapshot that repeated observations leave behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.captions import caption_hashtags, caption_mentions
from postlake.functions.scalars import stable_id
from postlake.operators.history import ARRIVAL, observation_flags
from postlake.schemas import MEDIA_POSTS

# Columns a first sighting fixes for good, and columns every sighting overwrites.
_FIRST = ("hashtag_id", "media_type", "permalink", "taken_at")
_LAST = ("caption", "media_url", "like_count", "comments_count")


def _folded(flagged: DataFrame) -> DataFrame:
    """One row per post touched by the observations, which have their flags. All aggregates combine map-side, so a hot
    post leaves each task as a single row."""
    arrival = F.struct(*ARRIVAL)
    return flagged.groupBy("ig_media_id").agg(
        F.min_by(F.struct(*_FIRST, "source"), arrival).alias("f"),
        F.max_by(F.struct(*_LAST), arrival).alias("l"),
        F.min("fetched_at").alias("first_at"),
        F.max("fetched_at").alias("last_at"),
        F.max(F.when(F.col("content_changed"), F.col("fetched_at"))).alias("edited_at"),
        F.bool_or(F.col("source") == "top").alias("in_top"),
        F.bool_or(F.col("source") == "recent").alias("in_recent"),
        F.min("rank").alias("best_rank"),
    )


def upsert_posts(
    observations: DataFrame, current: DataFrame | None = None, width: str = "day", flagged: DataFrame | None = None
) -> DataFrame:
    """Insert-or-update of ``media_posts``, set-based.

    Without ``current`` this is a rebuild from all observations; with it, the snapshot after
    the observations arrived on top. Fed in arrival order, both give the same table. ``flagged`` are the
    ``observation_flags`` against ``current``, where the caller has them already.
    """
    batch = _folded(observation_flags(observations, current, width) if flagged is None else flagged)
    if current is None:
        return _shape(batch, None)
    # Posts the batch did not touch pass through unchanged.
    old = current.select("ig_media_id", F.struct(*current.columns).alias("old"))
    joined = old.join(batch, "ig_media_id", "full_outer")
    return _shape(joined, F.col("old"))


def _shape(df: DataFrame, old: Column | None) -> DataFrame:
    touched = F.col("l").isNotNull()

    def keep_first(name: str, value: Column) -> Column:
        return value if old is None else F.when(old.isNotNull(), old[name]).otherwise(value)

    def take_last(name: str, value: Column) -> Column:
        return value if old is None else F.when(touched, value).otherwise(old[name])

    def merge(name: str, value: Column, how) -> Column:
        return value if old is None else how(old[name], value)

    caption = take_last("caption", F.col("l.caption"))
    no_tags = F.array().cast("array<string>")
    columns = {
        "id": keep_first("id", stable_id(F.col("ig_media_id"))),
        "ig_media_id": F.col("ig_media_id"),
        "hashtag_id": keep_first("hashtag_id", F.col("f.hashtag_id")),
        "media_type": keep_first("media_type", F.col("f.media_type")),
        "caption": caption,
        "permalink": keep_first("permalink", F.col("f.permalink")),
        "source_media_url": take_last("source_media_url", F.col("l.media_url")),
        "caption_hashtags": take_last("caption_hashtags", F.coalesce(caption_hashtags(F.col("l.caption")), no_tags)),
        "caption_mentions": take_last("caption_mentions", F.coalesce(caption_mentions(F.col("l.caption")), no_tags)),
        "taken_at": keep_first("taken_at", F.col("f.taken_at")),
        "first_seen_at": keep_first("first_seen_at", F.col("first_at")),
        "last_seen_at": take_last("last_seen_at", F.col("last_at")),
        "content_updated_at": merge("content_updated_at", F.col("edited_at"), lambda a, b: F.coalesce(b, a)),
        "like_count": take_last("like_count", F.col("l.like_count")),
        "comments_count": take_last("comments_count", F.col("l.comments_count")),
        "metrics_updated_at": take_last("metrics_updated_at", F.col("last_at")),
        "first_seen_via": keep_first("first_seen_via", F.col("f.source")),
        "seen_in_top": merge("seen_in_top", F.coalesce("in_top", F.lit(False)), lambda a, b: F.coalesce(a, F.lit(False)) | b),
        "seen_in_recent": merge("seen_in_recent", F.coalesce("in_recent", F.lit(False)), lambda a, b: F.coalesce(a, F.lit(False)) | b),
        "best_top_rank": merge("best_top_rank", F.col("best_rank"), F.least),
        "is_stale": take_last("is_stale", F.lit(False)),
        "created_at": keep_first("created_at", F.col("first_at")),
        "updated_at": take_last("updated_at", F.col("last_at")),
    }
    return df.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in MEDIA_POSTS.fields])


def mark_stale(posts: DataFrame, hashtag_id: str, threshold: Column, now: Column) -> DataFrame:
    """Flag the tag's posts last seen before ``threshold``. ``flipped`` marks the rows changed."""
    flips = (F.col("hashtag_id") == hashtag_id) & (F.col("last_seen_at") < threshold) & ~F.col("is_stale")
    return posts.withColumn("flipped", flips).withColumns(
        {
            "is_stale": F.col("is_stale") | F.col("flipped"),
            "updated_at": F.when(F.col("flipped"), now).otherwise(F.col("updated_at")),
        }
    )

"""Analytical reports over posts and their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.history import changed_names
from postlake.operators.timeline import SLOT, carry, slot_of

CAPTURED = ("captured_at", "sync_run_id", "position_overall")


def unnested(posts: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per array element; posts with a null or empty array vanish."""
    return posts.select("id", "hashtag_id", F.explode(column).alias(alias))


def _ranking(values: DataFrame, value: str, limit: int | None) -> DataFrame:
    counted = values.groupBy(value).agg(F.count("*").alias("posts"))
    if limit is None:
        return counted
    return counted.orderBy(F.desc("posts"), value).limit(limit)


def cooccurring_tags(posts: DataFrame, hashtag_id: str, limit: int = 20) -> DataFrame:
    """Tags used in the posts of a tracked tag (itself included), most used first."""
    return _ranking(unnested(posts.filter(F.col("hashtag_id") == hashtag_id), "caption_hashtags", "tag"), "tag", limit)


def global_tags(posts: DataFrame, limit: int | None = None) -> DataFrame:
    return _ranking(unnested(posts, "caption_hashtags", "tag"), "tag", limit)


def mention_ranking(posts: DataFrame, limit: int | None = None) -> DataFrame:
    return _ranking(unnested(posts, "caption_mentions", "account"), "account", limit)


def history_join_posts(history: DataFrame, posts: DataFrame) -> DataFrame:
    names = posts.select(F.col("id").alias("media_id"), F.col("ig_media_id").alias("post"))
    return history.join(names, "media_id")


def metric_series(history: DataFrame, posts: DataFrame, limit: int = 5) -> DataFrame:
    """Posts with several history rows: how many, fewest and most likes. Counted per post
    before the join, so the join sees one row per post."""
    series = history.groupBy("media_id").agg(
        F.count("*").alias("observations"), F.min("like_count").alias("min_likes"), F.max("like_count").alias("max_likes")
    )
    names = posts.select(F.col("id").alias("media_id"), "ig_media_id")
    return (
        series.filter("observations > 1").join(names, "media_id")
        .select("ig_media_id", "observations", "min_likes", "max_likes")
        .orderBy(F.desc("observations"), "ig_media_id")
        .limit(limit)
    )


def rank_movement(history: DataFrame, width: str = "day") -> DataFrame:
    """Rank in each recorded top sighting against the one before; positive ``moved`` is a climb."""
    top = history.filter(F.col("source") == "top")
    rows = carry(top, ["media_id"], CAPTURED, previous=["rank"], width=width)
    return rows.filter(F.col("prev").isNotNull()).select(
        "ig_media_id", "sync_run_id", "captured_at", "rank",
        F.col("prev.rank").alias("previous_rank"), (F.col("prev.rank") - F.col("rank")).alias("moved"),
    )


def engagement_velocity(history: DataFrame, width: str = "day") -> DataFrame:
    """Likes gained per hour between consecutive history rows of a post."""
    rows = carry(history, ["media_id"], CAPTURED, previous=["like_count", "captured_at"], width=width)
    micros = F.unix_micros("captured_at") - F.unix_micros("prev.captured_at")
    gained = F.col("like_count") - F.col("prev.like_count")
    return rows.filter(F.col("prev").isNotNull()).select(
        "ig_media_id", "sync_run_id", "captured_at", gained.alias("likes_gained"),
        F.when(micros > 0, F.round(gained * 3_600_000_000 / micros, 4)).alias("likes_per_hour"),
    )


def edited_captions(history: DataFrame, width: str = "day") -> DataFrame:
    """Caption versions after the first, with the text they replaced."""
    rows = carry(history, ["media_id"], CAPTURED, previous=["caption"], width=width)
    return rows.filter(F.col("prev").isNotNull() & F.array_contains("changed_fields", "caption")).select(
        "ig_media_id", "sync_run_id", "captured_at", F.col("prev.caption").alias("old_caption"), "caption",
    )


def state_at(history: DataFrame, moment: Column) -> DataFrame:
    """Each post as its history knew it at one moment."""
    columns = [c for c in history.columns if c != "media_id"]
    newest = F.max_by(F.struct(*columns), F.struct(*CAPTURED))
    return history.filter(F.col("captured_at") <= moment).groupBy("media_id").agg(newest.alias("s")).select("media_id", "s.*")


def asof_state(questions: DataFrame, history: DataFrame, width: str = "day") -> DataFrame:
    """For every question (ig_media_id, at, ...) the newest history row at or before ``at``.

    Questions and history share one time line per post: within a slot the newest state is
    carried forward by a window, across slots by one summary row per (post, slot).
    """
    state = F.struct("caption", "like_count", "comments_count", "rank", "permalink", "media_type", "captured_at")
    ask = questions.select("ig_media_id", F.col("at"), F.struct(*questions.columns).alias("asked"))
    know = history.select(
        "ig_media_id", F.col("captured_at").alias("at"), state.alias("state"), F.struct(*CAPTURED).alias("at_order")
    )
    both = ask.unionByName(know, allowMissingColumns=True).withColumn(SLOT, slot_of("at", width))
    # Nulls sort first within a tie on ``at``, so a question comes after the rows it may see.
    along = Window.partitionBy("ig_media_id", SLOT).orderBy("at", F.col("asked").isNotNull(), "at_order")
    within = F.last("state", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    slots = both.groupBy("ig_media_id", SLOT).agg(F.max_by("state", "at_order").alias("_last"))
    across = Window.partitionBy("ig_media_id").orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("ig_media_id", SLOT, F.last("_last", ignorenulls=True).over(across).alias("_carried"))
    answered = (
        both.withColumn("_within", within)
        .filter(F.col("asked").isNotNull())
        .join(slots, ["ig_media_id", SLOT], "left")
        .withColumn("state", F.coalesce("_within", "_carried"))
    )
    return answered.select("asked.*", "state.*")


def gap_resolution(questions: DataFrame, runs: DataFrame, data_points: DataFrame, history: DataFrame) -> DataFrame:
    """Why a (post, run) pair has no history row: recorded, unchanged, not seen or not checked.

    All joins are on unique (post, run) or run keys, so no side can fan out.
    """
    pair = ["ig_media_id", "sync_run_id"]
    seen = data_points.select(*pair).distinct().withColumn("_seen", F.lit(True))
    kept = history.select(*pair).distinct().withColumn("_kept", F.lit(True))
    known = runs.select(F.col("id").alias("sync_run_id")).distinct().withColumn("_run", F.lit(True))
    verdict = (
        F.when(F.col("_kept"), "recorded")
        .when(F.col("_seen"), "unchanged")
        .when(F.col("_run"), "not_seen")
        .otherwise("not_checked")
    )
    joined = questions.join(kept, pair, "left").join(seen, pair, "left").join(known, "sync_run_id", "left")
    return joined.withColumn("verdict", verdict).drop("_kept", "_seen", "_run")


def prev_state_join(incoming: DataFrame, latest: DataFrame) -> DataFrame:
    """Incoming observations beside the newest history row of their post, with the fields that
    differ (all six without a row)."""
    before = latest.select(
        "ig_media_id",
        F.struct("like_count", "comments_count", "rank", "caption", "permalink", "media_type").alias("before"),
    )
    joined = incoming.join(before, "ig_media_id", "left")
    return joined.withColumn("changed_fields", changed_names(F.col("before")))

"""The paginated read query over posts, tags and assets."""

from __future__ import annotations

import base64
import binascii
import datetime as dt
import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions.captions import strip_tag
from postlake.functions.scalars import UUID_PATTERN, decode_cursor, encode_cursor, iso_millis, locator
from postlake.schemas import DEFAULT_PAGE_LIMIT, MAX_PAGE_LIMIT, MAX_TAG_LENGTH, MEDIA_TYPES
from postlake.session import staged

PROJECTION = (
    "id", "ig_media_id", "hashtag_name", "media_type", "caption", "caption_hashtags",
    "caption_mentions", "permalink", "taken_at", "like_count", "comments_count", "best_top_rank",
    "seen_in_top", "seen_in_recent", "is_stale", "first_seen_at", "last_seen_at",
    "content_updated_at", "asset_status", "asset_key", "asset_sha256", "asset_size_bytes",
    "asset_content_type",
)


@dataclass(frozen=True)
class ListArgs:
    """Checked arguments of the read query."""

    hashtag: str | None = None
    media_type: str | None = None
    taken_after: dt.datetime | None = None
    taken_before: dt.datetime | None = None
    include_stale: bool = True
    include_asset: bool = True
    limit: int = DEFAULT_PAGE_LIMIT
    cursor: str | None = None

    def __post_init__(self) -> None:
        if isinstance(self.limit, bool) or not isinstance(self.limit, int) or not 1 <= self.limit <= MAX_PAGE_LIMIT:
            raise ValueError(f"limit must be a whole number from 1 to {MAX_PAGE_LIMIT}")
        if self.media_type is not None and self.media_type not in MEDIA_TYPES:
            raise ValueError(f"media_type must be one of {MEDIA_TYPES}")
        if self.hashtag is not None and not 1 <= len(self.hashtag) <= MAX_TAG_LENGTH:
            raise ValueError(f"hashtag must have 1 to {MAX_TAG_LENGTH} characters")
        if self.cursor is not None:
            check_cursor(self.cursor)


def check_cursor(token: str) -> None:
    """Raise a ValueError for a token that is no cursor: an empty page would look like the end of the list."""
    try:
        body = json.loads(base64.urlsafe_b64decode(token + "=" * (-len(token) % 4)))
    except (binascii.Error, ValueError) as wrong:
        raise ValueError("cursor is not base64url-encoded JSON") from wrong
    if not isinstance(body, dict) or not isinstance(body.get("takenAt"), str) or not isinstance(body.get("id"), str):
        raise ValueError("cursor lacks takenAt or id")
    try:
        dt.datetime.fromisoformat(body["takenAt"])
    except ValueError as wrong:
        raise ValueError("cursor has no valid takenAt") from wrong
    if not re.match(UUID_PATTERN, body["id"]):
        raise ValueError("cursor has no valid id")


def _common(args: ListArgs) -> list[Column]:
    conditions = []
    if args.hashtag is not None:
        conditions.append(F.col("hashtag_name") == strip_tag(F.lit(args.hashtag)))
    if args.media_type is not None:
        conditions.append(F.col("media_type") == args.media_type)
    if not args.include_stale:
        conditions.append(~F.col("is_stale"))
    return conditions


def keyset_predicate(taken_at: Column, id: Column) -> Column:
    """Strictly after (taken_at, id) in descending order. The separate bound on the time alone
    is implied, but it is the part a parquet scan can push down."""
    earlier = F.col("taken_at") < taken_at
    tied = (F.col("taken_at") == taken_at) & (F.col("id") < id)
    return (F.col("taken_at") <= taken_at) & (earlier | tied)


def posts_join_tags(posts: DataFrame, tags: DataFrame) -> DataFrame:
    """Posts with their tag's name. Without a hint: Spark broadcasts the dimension when its
    measured size is below the threshold and splits a hot tag in the join otherwise."""
    names = tags.select(F.col("id").alias("hashtag_id"), F.col("name").alias("hashtag_name"))
    return posts.join(names, "hashtag_id")


def posts_left_assets(posts: DataFrame, assets: DataFrame) -> DataFrame:
    """Posts with their asset, posts without one kept."""
    files = assets.select(
        F.col("media_id").alias("id"), F.col("status").alias("asset_status"),
        F.col("storage_key").alias("asset_key"), F.col("sha256").alias("asset_sha256"),
        F.col("size_bytes").alias("asset_size_bytes"), F.col("content_type").alias("asset_content_type"),
    )
    return posts.join(files, "id", "left")


def filtered(posts: DataFrame, tags: DataFrame, args: ListArgs) -> DataFrame:
    """All posts the filters let through; date bounds are inclusive."""
    conditions = _common(args)
    if args.taken_after is not None:
        conditions.append(F.col("taken_at") >= F.lit(args.taken_after))
    if args.taken_before is not None:
        conditions.append(F.col("taken_at") <= F.lit(args.taken_before))
    rows = posts_join_tags(posts, tags)
    for condition in conditions:
        rows = rows.filter(condition)
    return rows


def list_media_projection(posts: DataFrame, tags: DataFrame, assets: DataFrame, args: ListArgs = ListArgs()) -> DataFrame:
    return posts_left_assets(filtered(posts, tags, args), assets).select(*PROJECTION)


def count_media(posts: DataFrame, tags: DataFrame, args: ListArgs = ListArgs()) -> DataFrame:
    """Total for the filters on tag, type and staleness; dates and cursor do not narrow it."""
    rows = posts_join_tags(posts, tags)
    for condition in _common(args):
        rows = rows.filter(condition)
    return rows.agg(F.count("*").alias("total"))


def list_media(posts: DataFrame, tags: DataFrame, assets: DataFrame, args: ListArgs = ListArgs()) -> DataFrame:
    """One page, newest post first, with ``has_more`` and ``next_cursor`` (null on the last page).

    One extra row tells whether more follow. Assets are 1:0..1, so they join after the limit. The
    page's ids, at most 101, pick the assets first, so the asset table is filtered where it lies
    and never shuffled.
    """
    rows = filtered(posts, tags, args)
    if args.cursor is not None:
        # A constant, checked with the arguments and folded once by the optimizer.
        at = decode_cursor(F.lit(args.cursor))
        rows = rows.filter(keyset_predicate(at["taken_at"], at["id"]))
    top = rows.orderBy(F.desc("taken_at"), F.desc("id")).limit(args.limit + 1)
    # Bounded by the page limit, hence a window over the whole page.
    page = Window.orderBy(F.desc("taken_at"), F.desc("id"))
    whole = Window.partitionBy()
    numbered = top.withColumns({"row_no": F.row_number().over(page), "_n": F.count("*").over(whole)})
    has_more = F.col("_n") > args.limit
    last = F.max(F.when(F.col("row_no") == args.limit, encode_cursor(F.col("taken_at"), F.col("id")))).over(whole)
    out = numbered.withColumns({"has_more": has_more, "next_cursor": F.when(has_more, last)})
    shown = out.filter(F.col("row_no") <= args.limit)
    # Bounded by the page limit: at most 101 ids.
    ids = F.broadcast(top.select(F.col("id").alias("media_id")))
    return (
        posts_left_assets(shown, assets.join(ids, "media_id", "left_semi"))
        .select("row_no", *PROJECTION, "has_more", "next_cursor")
        .orderBy("row_no")
    )


def media_document(rows: DataFrame, include_asset: bool = True, locator_prefix: str = "s3://media-bucket") -> DataFrame:
    """The nested response document per row, as JSON text."""
    no_tags = F.array().cast("array<string>")
    nested = {
        "id": F.col("id"),
        "igMediaId": F.col("ig_media_id"),
        "hashtag": F.col("hashtag_name"),
        "mediaType": F.col("media_type"),
        "caption": F.col("caption"),
        "permalink": F.col("permalink"),
        "captionHashtags": F.coalesce("caption_hashtags", no_tags),
        "captionMentions": F.coalesce("caption_mentions", no_tags),
        "takenAt": iso_millis(F.col("taken_at")),
        "metrics": F.struct(
            F.col("like_count").alias("likeCount"), F.col("comments_count").alias("commentsCount"),
            F.col("best_top_rank").alias("bestTopRank"),
        ),
        "discovery": F.struct(
            F.col("seen_in_top").alias("seenInTop"), F.col("seen_in_recent").alias("seenInRecent"),
            iso_millis(F.col("first_seen_at")).alias("firstSeenAt"),
            iso_millis(F.col("last_seen_at")).alias("lastSeenAt"),
            iso_millis(F.col("content_updated_at")).alias("contentUpdatedAt"),
            F.col("is_stale").alias("isStale"),
        ),
    }
    keep_nulls = {"ignoreNullFields": "false"}
    fields = [value.alias(name) for name, value in nested.items()]
    if not include_asset:
        return rows.select("id", F.to_json(F.struct(*fields), keep_nulls).alias("document"))
    stored = F.struct(
        F.col("asset_status").alias("status"), F.col("asset_key").alias("storageKey"),
        locator(locator_prefix, F.col("asset_key")).alias("locator"), F.col("asset_sha256").alias("sha256"),
        F.col("asset_size_bytes").alias("sizeBytes"), F.col("asset_content_type").alias("contentType"),
    )
    waiting = F.struct(F.coalesce("asset_status", F.lit("pending")).alias("status"))
    # The two asset shapes differ, so each document is rendered with its own.
    with_file = F.to_json(F.struct(*fields, stored.alias("asset")), keep_nulls)
    without = F.to_json(F.struct(*fields, waiting.alias("asset")), keep_nulls)
    return rows.select("id", F.when(F.col("asset_key").isNotNull(), with_file).otherwise(without).alias("document"))


def page_document(posts: DataFrame, tags: DataFrame, assets: DataFrame, args: ListArgs = ListArgs()) -> DataFrame:
    """``pagination`` of a page as JSON text: limit, count, total, hasMore and nextCursor (null on the last page).

    One row, also for an empty page. ``total`` follows ``count_media``: dates and cursor do not narrow it.
    """
    page = list_media(posts, tags, assets, args)
    summary = page.agg(F.count("*").alias("count"), F.coalesce(F.bool_or("has_more"), F.lit(False)).alias("hasMore"), F.max("next_cursor").alias("nextCursor"))
    # Two tables of one row each.
    both = summary.withColumn("one", F.lit(1)).join(count_media(posts, tags, args).withColumn("one", F.lit(1)), "one")
    body = F.struct(F.lit(args.limit).alias("limit"), "count", "total", "hasMore", "nextCursor")
    return both.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("pagination"))


def paging_walk(posts: DataFrame, tags: DataFrame, args: ListArgs = ListArgs()) -> DataFrame:
    """The page number and place of every post, as a reader who follows the cursors sees them.

    Posts are range-partitioned on the unique sort key, so parts are even whatever the times
    look like; a post's place is the size of the parts before its own plus its place within.
    The parts are stored once, because a second sampling could draw their edges differently.
    """
    order = (F.desc("taken_at"), F.desc("id"))
    rows = filtered(posts, tags, args).select("id", "taken_at")
    parts = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "walk")
    # One row per part.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("part").agg(F.count("*").alias("_n"))
    starts = sizes.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (
        parts.withColumn("_within", within)
        .join(starts, "part")
        .withColumn("place", F.col("_before") + F.col("_within"))
        .select("id", "taken_at", "place", F.ceil(F.col("place") / args.limit).alias("page"))
    )

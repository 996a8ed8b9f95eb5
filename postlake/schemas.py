"""Declared schemas of the six tables and of the JSON documents. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The enumerations of the stored tables.
MEDIA_TYPES = ("IMAGE", "VIDEO", "CAROUSEL_ALBUM")
SOURCES = ("top", "recent")
RUN_TYPES = ("SYNC_TOP_HASHTAG_MEDIA", "SYNC_RECENT_HASHTAG_MEDIA")
RUN_STATUSES = ("running", "succeeded", "partial", "failed")
ASSET_STATUSES = ("pending", "downloading", "stored", "failed", "skipped")

# The change-tracked fields in report order, (column, reported name).
TRACKED_FIELDS = (
    ("like_count", "likeCount"),
    ("comments_count", "commentsCount"),
    ("rank", "rank"),
    ("caption", "caption"),
    ("permalink", "permalink"),
    ("media_type", "mediaType"),
)
TRACKED_COLUMNS = tuple(column for column, _ in TRACKED_FIELDS)

# Limits of the pipeline and of the read query.
DEFAULT_ITEM_CAP = 500
DEFAULT_PAGE_LIMIT = 25
MAX_PAGE_LIMIT = 100
MAX_TAG_LENGTH = 255
UNIQUE_TAG_LIMIT = 30
UNIQUE_TAG_DAYS = 7
RETENTION_DAYS = 7
MAX_DELIVERIES = 3

_S, _I, _L, _B, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()
_TAGS = T.ArrayType(T.StringType())


def _table(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], len(c) < 3) for c in columns])


HASHTAGS = _table(
    ("id", _S, 1), ("name", _S, 1), ("ig_hashtag_id", _S), ("ig_hashtag_id_resolved_at", _TS),
    ("is_active", _B, 1), ("track_from", _TS), ("track_until", _TS),
    ("top_sync_enabled", _B, 1), ("recent_sync_enabled", _B, 1), ("max_media_per_sync", _I),
    ("last_top_synced_at", _TS), ("last_recent_synced_at", _TS), ("last_sync_error", _S),
    ("consecutive_failures", _I, 1), ("notes", _S), ("created_at", _TS, 1), ("updated_at", _TS, 1),
)

SYNC_RUNS = _table(
    ("id", _S, 1), ("type", _S, 1), ("status", _S, 1), ("hashtag_id", _S, 1),
    ("triggered_by_message_id", _S), ("started_at", _TS, 1), ("finished_at", _TS),
    ("duration_ms", _L), ("pages_fetched", _I, 1), ("items_seen", _I, 1), ("items_new", _I, 1),
    ("items_updated", _I, 1), ("metrics_recorded", _I, 1), ("asset_jobs_enqueued", _I, 1),
    ("hit_item_cap", _I, 1), ("rate_limit_snapshot", _S), ("last_cursor", _S),
    ("attempts", _I, 1), ("error", _S), ("created_at", _TS, 1),
)

DATA_POINTS = _table(
    ("id", _S, 1), ("sync_run_id", _S, 1), ("hashtag_id", _S, 1), ("ig_media_id", _S),
    ("source", _S, 1), ("page_number", _I, 1), ("position_in_page", _I, 1),
    ("position_overall", _I, 1), ("payload", _S, 1), ("fetched_at", _TS, 1),
)

MEDIA_POSTS = _table(
    ("id", _S, 1), ("ig_media_id", _S, 1), ("hashtag_id", _S, 1), ("media_type", _S, 1),
    ("caption", _S), ("permalink", _S, 1), ("source_media_url", _S),
    ("caption_hashtags", _TAGS), ("caption_mentions", _TAGS), ("taken_at", _TS, 1),
    ("first_seen_at", _TS, 1), ("last_seen_at", _TS, 1), ("content_updated_at", _TS),
    ("like_count", _L), ("comments_count", _L), ("metrics_updated_at", _TS),
    ("first_seen_via", _S, 1), ("seen_in_top", _B, 1), ("seen_in_recent", _B, 1),
    ("best_top_rank", _I), ("is_stale", _B, 1), ("created_at", _TS, 1), ("updated_at", _TS, 1),
)

MEDIA_POST_HISTORY = _table(
    ("id", _S, 1), ("media_id", _S, 1), ("hashtag_id", _S, 1), ("sync_run_id", _S, 1),
    ("ig_media_id", _S, 1), ("media_type", _S, 1), ("caption", _S), ("permalink", _S, 1),
    ("caption_hashtags", _TAGS), ("caption_mentions", _TAGS), ("like_count", _L),
    ("comments_count", _L), ("rank", _I), ("source", _S, 1), ("changed_fields", _TAGS),
    ("captured_at", _TS, 1), ("position_overall", _I),
)

MEDIA_ASSETS = _table(
    ("id", _S, 1), ("media_id", _S, 1), ("status", _S, 1), ("sha256", _S), ("storage_key", _S),
    ("storage_provider", _S), ("content_type", _S), ("size_bytes", _L), ("fetched_from_url", _S),
    ("attempts", _I, 1), ("last_error", _S), ("download_started_at", _TS), ("stored_at", _TS),
    ("created_at", _TS, 1), ("updated_at", _TS, 1),
)

TABLES = {
    "hashtags": HASHTAGS,
    "sync_runs": SYNC_RUNS,
    "data_points": DATA_POINTS,
    "media_posts": MEDIA_POSTS,
    "media_post_history": MEDIA_POST_HISTORY,
    "media_assets": MEDIA_ASSETS,
}

# Columns of a validated observation: one post as one run reported it once.
OBSERVATION = _table(
    ("ig_media_id", _S), ("hashtag_id", _S), ("sync_run_id", _S), ("source", _S),
    ("position_overall", _I), ("fetched_at", _TS), ("media_type", _S), ("caption", _S),
    ("permalink", _S), ("media_url", _S), ("taken_at", _TS), ("like_count", _L),
    ("comments_count", _L),
)

# One landed page response. ``body`` is the response text exactly as received.
LANDED_PAGE = _table(
    ("sync_run_id", _S), ("hashtag_id", _S), ("source", _S), ("attempt", _I),
    ("arrival_seq", _L), ("fetched_at", _TS), ("body", _S),
    # Usage headers of the response, where the fetcher kept them.
    ("app_usage", _S), ("business_usage", _S),
)

# How many pages each attempt of a run has landed.
ATTEMPT_PAGES = T.ArrayType(T.StructType().add("attempt", _I).add("pages", _L))

# Items stay JSON text here, so bronze keeps keys that the post schema does not name.
PAGE_BODY = "data array<string>, paging struct<cursors: struct<before: string, after: string>, next: string, previous: string>"

JOB_BODY = "type string, kind string, hashtagId string, mediaId string"


USAGE_ENTRY = "call_count double, total_cputime double, total_time double, estimated_time_to_regain_access double"

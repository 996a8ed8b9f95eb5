"""Small column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.captions import BLANK
from postlake.schemas import USAGE_ENTRY

# Content types with a known file extension.
EXTENSIONS = {
    "image/jpeg": ".jpg",
    "image/jpg": ".jpg",
    "image/png": ".png",
    "image/webp": ".webp",
    "image/heic": ".heic",
    "image/gif": ".gif",
    "video/mp4": ".mp4",
    "video/quicktime": ".mov",
    "video/webm": ".webm",
}
DEFAULT_EXTENSION = ".bin"

# Text formats.
SOURCE_TS_PATTERN = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2}))?$"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
UUID_PATTERN = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

# Pauses in milliseconds, and stored lengths of error texts.
REGAIN_MINUTE_MS = 60_000
REGAIN_CAP_MS = 300_000
RAMP_FLOOR_MS = 1_000
RAMP_SPAN_MS = 29_000
TAG_ERROR_LENGTH = 2_000
ASSET_ERROR_LENGTH = 2_000
RUN_ERROR_LENGTH = 4_000


def stable_id(*parts: Column) -> Column:
    """A uuid-shaped id derived from the natural key, so that a retried task repeats it."""
    digest = F.md5(F.concat_ws("\u0001", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def parse_source_ts(raw: Column) -> Column:
    """``2026-08-12T17:08:55+0000`` -> timestamp, null when it does not parse.

    The offset may also be ``+00:00`` or ``Z``, seconds may be missing or have a fraction (cut to microseconds), and a bare
    date is midnight UTC. A time without an offset is rejected: it names no moment.
    """
    spelled = F.regexp_replace(F.regexp_replace(raw, r"(T.*[+-]\d{2})(\d{2})$", "$1:$2"), r"(\.\d{6})\d+", "$1")
    return F.when(raw.rlike(SOURCE_TS_PATTERN), spelled.try_cast("timestamp"))


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, ISO_MILLIS_FORMAT)


def effective_rank(source: Column, position: Column) -> Column:
    """Position counts as a popularity rank on the top edge only."""
    return F.when(source == "top", (position + 1).cast("int"))


def extension_for(content_type: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    bare = F.lower(F.regexp_replace(F.split(content_type, ";").getItem(0), f"^{BLANK}|{BLANK}$", ""))
    return F.coalesce(F.try_element_at(table, bare), F.lit(DEFAULT_EXTENSION))


def content_key(sha256: Column, extension: Column) -> Column:
    dotted = F.when(extension.startswith("."), extension).otherwise(F.concat(F.lit("."), extension))
    return F.concat(
        F.lit("media/"), F.substring(sha256, 1, 2), F.lit("/"), F.substring(sha256, 3, 2),
        F.lit("/"), sha256, dotted,
    )


def content_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def content_size(content: Column) -> Column:
    return F.octet_length(content).cast("long")


def locator(prefix: str, key: Column) -> Column:
    """Where the object lives: ``s3://bucket/`` or a local root, followed by the key."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), key)


def asset_source_url(asset_url: Column, post_url: Column) -> Column:
    return F.coalesce(asset_url, post_url)


def encode_cursor(taken_at: Column, id: Column) -> Column:
    """(taken_at, id) as base64url JSON, without padding or line breaks."""
    body = F.to_json(F.struct(iso_millis(taken_at).alias("takenAt"), id.alias("id")))
    plain = F.regexp_replace(F.base64(F.encode(body, "UTF-8")), r"[=\r\n]", "")
    return F.translate(plain, "+/", "-_")


def decode_cursor(token: Column) -> Column:
    """struct(taken_at, id), or null when the token is not a cursor we issued."""
    padded = F.rpad(
        F.translate(token, "-_", "+/"),
        (F.ceil(F.length(token) / 4) * 4).cast("int"),
        "=",
    )
    text = F.try_validate_utf8(F.try_to_binary(padded, F.lit("base64")).cast("string"))
    parsed = F.from_json(text, "takenAt string, id string")
    taken_at = parsed["takenAt"].try_cast("timestamp")
    ok = taken_at.isNotNull() & parsed["id"].rlike(UUID_PATTERN)
    return F.when(ok, F.struct(taken_at.alias("taken_at"), parsed["id"].alias("id")))


def usage_entries(app_usage: Column, business_usage: Column) -> Column:
    """Both usage headers as one array of entries; unreadable parts are left out.

    The business header is a map of arrays. Its levels are opened as text one by one, so that a
    malformed part does not take its neighbours with it.
    """
    def is_object(text: Column) -> Column:
        return text.rlike(r"^\s*\{") & F.try_parse_json(text).isNotNull()

    groups = F.map_values(F.from_json(business_usage, "map<string,string>"))
    lists = F.transform(groups, lambda text: F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>")))
    nested = F.flatten(F.filter(lists, lambda entries: entries.isNotNull()))
    texts = F.concat(F.array(app_usage), F.coalesce(nested, F.array().cast("array<string>")))
    return F.transform(F.filter(texts, is_object), lambda text: F.from_json(text, USAGE_ENTRY))


def usage_summary(app_usage: Column, business_usage: Column) -> Column:
    """struct(worst_pct, call_pct, cpu_pct, total_pct, regain_minutes); null without headers."""
    # Bound by a one-element transform, so that the headers are parsed once per row.
    return F.transform(F.array(usage_entries(app_usage, business_usage)), _summary_of)[0]


def _summary_of(entries: Column) -> Column:
    def worst(field: str) -> Column:
        return F.array_max(F.transform(entries, lambda e: e[field]))

    call, cpu, total = worst("call_count"), worst("total_cputime"), worst("total_time")
    regain = worst("estimated_time_to_regain_access")
    return F.when(
        F.size(entries) > 0,
        F.struct(
            F.greatest(F.lit(0.0), call, cpu, total).alias("worst_pct"),
            call.alias("call_pct"),
            cpu.alias("cpu_pct"),
            total.alias("total_pct"),
            F.when(regain > 0, regain).alias("regain_minutes"),
        ),
    )


def throttle_delay_ms(worst_pct: Column, regain_minutes: Column, threshold: float) -> Column:
    """Pause before the next request; 0 below the threshold or without a reading."""
    ramp = RAMP_FLOOR_MS + RAMP_SPAN_MS * (worst_pct - F.lit(float(threshold))) / max(100.0 - threshold, 1.0)
    return (
        F.when(regain_minutes > 0, F.least(regain_minutes * REGAIN_MINUTE_MS, F.lit(float(REGAIN_CAP_MS))))
        .when(worst_pct >= threshold, F.floor(ramp + 0.5))
        .otherwise(F.lit(0))
        .cast("long")
    )


def duration_ms(started_at: Column, finished_at: Column) -> Column:
    return F.round((F.unix_micros(finished_at) - F.unix_micros(started_at)) / 1000).cast("long")


def truncate_error(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def redact_token(url: Column) -> Column:
    return F.regexp_replace(url, r"(access_token=)[^&]*", "$1[redacted]")


def source_of_run(run_type: Column) -> Column:
    return F.when(run_type == "SYNC_TOP_HASHTAG_MEDIA", "top").when(
        run_type == "SYNC_RECENT_HASHTAG_MEDIA", "recent"
    )


def run_type_of(source: Column) -> Column:
    return F.when(source == "top", "SYNC_TOP_HASHTAG_MEDIA").when(
        source == "recent", "SYNC_RECENT_HASHTAG_MEDIA"
    )

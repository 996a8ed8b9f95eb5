"""Validation, routing and integrity checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.captions import normalize_tag
from postlake.functions.scalars import UUID_PATTERN, parse_source_ts
from postlake.schemas import JOB_BODY, MEDIA_TYPES, SOURCES
from postlake.session import staged
from postlake.sources.bronze import with_page_items

# Error codes and statuses by what they mean.
AUTH_CODES = (190, 102, 463, 467)
THROTTLE_CODES = (4, 17, 32, 613, 80004)
TOO_LARGE_CODE = 1
TOO_LARGE_TEXT = r"(?i)reduce the amount of data"
TRANSIENT_STATUSES = (408, 425, 429, 500, 502, 503, 504)

URL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*:(//)?[^\s/?#]+\S*$"
NUMERIC_KIND = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
# Fixed value: the largest whole number that a JSON reader with double precision keeps exactly.
MAX_COUNT = 2**53 - 1


def with_validation(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Add the post fields read from the JSON text and ``errors``, the fields that break a rule.

    One parse reads every named field as a variant, which keeps its raw JSON type: a typed
    reader would turn the text ``"7"`` into a number and 3.5 into null. An optional field may be
    absent but not JSON null.
    """
    names = ("id", "media_type", "timestamp", "permalink", "media_url", "caption", "like_count", "comments_count")
    schema = ", ".join(f"{name} variant" for name in names) + ", _corrupt_record string"
    parsed = rows.withColumn("_doc", F.from_json(payload, schema, {"mode": "PERMISSIVE"}))

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.col(f"_doc.{field}"))

    def text(field: str) -> Column:
        return F.when(kind(field) == "STRING", F.try_variant_get(F.col(f"_doc.{field}"), "$", "string"))

    def count(field: str) -> Column:
        number = F.try_variant_get(F.col(f"_doc.{field}"), "$", "double")
        return F.when(kind(field).rlike(NUMERIC_KIND), number)

    readable = F.col(payload).rlike(r"^\s*\{") & F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull()
    fields = {f"_k_{f}": F.col(f"_doc.{f}").isNotNull() for f in ("media_url", "caption", "like_count", "comments_count")}
    fields |= {f"_{f}": text(f) for f in ("id", "media_type", "timestamp", "permalink", "media_url", "caption")}
    fields |= {f"_{f}": count(f) for f in ("like_count", "comments_count")}
    fields["_readable"] = F.coalesce(readable, F.lit(False))
    read = parsed.withColumns(fields)

    def whole(field: str) -> Column:
        value = F.col(f"_{field}")
        return ~F.col(f"_k_{field}") | F.coalesce(
            (value == F.floor(value)) & (value >= 0) & (value <= MAX_COUNT), F.lit(False)
        )

    def good(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    taken_at = parse_source_ts(F.col("_timestamp"))
    rules = {
        "id": good(F.col("_id") != ""),
        "media_type": good(F.col("_media_type").isin(*MEDIA_TYPES)),
        "timestamp": taken_at.isNotNull(),
        "permalink": good(F.col("_permalink").rlike(URL_PATTERN)),
        "media_url": ~F.col("_k_media_url") | good(F.col("_media_url").rlike(URL_PATTERN)),
        "caption": ~F.col("_k_caption") | F.col("_caption").isNotNull(),
        "like_count": whole("like_count"),
        "comments_count": whole("comments_count"),
    }
    broken = F.filter(
        F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]), lambda e: e.isNotNull()
    )
    errors = F.when(~F.col("_readable"), F.array(F.lit("document"))).otherwise(broken)
    named = {
        "errors": errors,
        "ig_media_id": F.col("_id"),
        "media_type": F.col("_media_type"),
        "taken_at": taken_at,
        "permalink": F.col("_permalink"),
        "media_url": F.col("_media_url"),
        "caption": F.col("_caption"),
        "like_count": F.col("_like_count").try_cast("long"),
        "comments_count": F.col("_comments_count").try_cast("long"),
    }
    temporary = ["_doc", *fields]
    return read.withColumns(named).drop(*temporary)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows). Best applied to a stored table: on an unstored one the
    filter is pushed below the parsing and repeats it."""
    ok = F.size("errors") == 0
    return validated.filter(ok).drop("errors"), validated.filter(~ok)


def observations_of(data_points: DataFrame) -> DataFrame:
    """Valid raw rows as observations. The checked rows are stored once, because everything
    built from observations reads them several times."""
    raw = data_points.select("sync_run_id", "hashtag_id", "source", "position_overall", "fetched_at", "payload")
    good, _ = split_valid(staged(with_validation(raw).drop("payload"), "checked"))
    return good


def validate_pages(pages: DataFrame) -> DataFrame:
    """Page by page: a page counts only when its body parses and every item is valid.

    Items are exploded, checked and counted back per page; the count combines map-side.
    """
    parsed = with_page_items(pages)
    items = parsed.select(
        "sync_run_id", "arrival_seq", F.col("items").isNotNull().alias("readable"),
        F.explode_outer("items").alias("payload"),
    )
    is_item = F.col("payload").isNotNull()
    bad_item = is_item & (F.size("errors") > 0)
    return (
        with_validation(items)
        .groupBy("sync_run_id", "arrival_seq")
        .agg(
            F.count_if(is_item).alias("items"),
            F.count_if(bad_item).alias("invalid_items"),
            F.bool_and(F.col("readable") & ~bad_item).alias("accepted"),
        )
    )


def route_messages(messages: DataFrame) -> DataFrame:
    """Add the parsed job and ``route``: its type, or ``dead_letter`` for anything else."""
    job = F.from_json("body", JOB_BODY)
    parsed = messages.withColumn("_job", job)

    def field(name: str) -> Column:
        return F.col(f"_job.{name}")

    fits = (
        F.when(field("type") == "DISPATCH_DUE_SYNCS", field("kind").isin(*SOURCES))
        .when(
            field("type").isin("SYNC_TOP_HASHTAG_MEDIA", "SYNC_RECENT_HASHTAG_MEDIA"),
            field("hashtagId").rlike(UUID_PATTERN),
        )
        .when(field("type") == "DOWNLOAD_MEDIA_ASSET", field("mediaId").rlike(UUID_PATTERN))
    )
    routed = F.when(F.coalesce(fits, F.lit(False)), field("type")).otherwise("dead_letter")
    return parsed.withColumns(
        {
            "route": routed,
            "kind": field("kind"),
            "hashtag_id": field("hashtagId"),
            "media_id": field("mediaId"),
        }
    ).drop("_job")


def classify_errors(responses: DataFrame) -> DataFrame:
    """Add ``outcome``. The code in the body is the better signal, so it goes before the status."""
    status = F.col("status")
    empty = F.col("body") == ""
    doc = F.try_parse_json(F.col("body"))

    # An envelope counts only with the declared kinds: a text message, and numbers or texts where they are declared.
    def member(name: str, kind: str, *kinds: str) -> tuple[Column, Column]:
        raw = F.try_variant_get(doc, f"$.error.{name}", "variant")
        found = F.schema_of_variant(raw)
        return F.try_variant_get(doc, f"$.error.{name}", kind), raw.isNull() | found.rlike("|".join(kinds))

    text, text_ok = member("message", "string", "^STRING$")
    code, code_ok = member("code", "double", NUMERIC_KIND)
    others = [member(n, "string", k)[1] for n, k in (("type", "^STRING$"), ("fbtrace_id", "^STRING$"), ("error_subcode", NUMERIC_KIND))]
    envelope = text_ok & code_ok
    for fits in others:
        envelope = envelope & fits
    message = F.when(envelope, text)
    outcome = (
        F.when(~empty & doc.isNull(), "invalid_json")
        .when(message.isNotNull() & code.isin(*AUTH_CODES), "auth")
        .when(message.isNotNull() & (code.isin(*THROTTLE_CODES) | (status == 429)), "throttled")
        .when((code == TOO_LARGE_CODE) & message.rlike(TOO_LARGE_TEXT), "payload_too_large")
        .when(message.isNotNull() & status.isin(*TRANSIENT_STATUSES), "transient")
        .when(message.isNotNull(), "rejected")
        .when(~status.between(200, 299), "http_error")
        .otherwise("ok")
    )
    return responses.withColumn("outcome", outcome)


def untracked_check(asked: DataFrame, name: str, tags: DataFrame) -> DataFrame:
    """Asked-for tags that are not tracked: an error, unlike a tracked tag without rows."""
    wanted = asked.select(normalize_tag(F.col(name)).alias("name")).distinct()
    return wanted.join(tags.select("name"), "name", "left_anti")


def unique_check(df: DataFrame, constraint: str, keys: Iterable[str]) -> DataFrame:
    """Keys held by more than one row; nulls do not collide."""
    keys = list(keys)
    held = df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return (
        held.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
        .select(F.lit(constraint).alias("constraint"), F.concat_ws("|", *keys).alias("key"), "rows")
    )


def fk_check(child: DataFrame, constraint: str, column: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Child keys without a parent. The child is counted per key first, so a hot key joins once."""
    held = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(key)).agg(F.count("*").alias("rows"))
    return held.join(parent.select(key), key, "left_anti").select(
        F.lit(constraint).alias("constraint"), F.col(key).alias("key"), "rows"
    )

"""The dimension of tracked tags: who is due, what is broken, how tags change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.captions import normalize_tag
from postlake.functions.scalars import TAG_ERROR_LENGTH, run_type_of, stable_id, truncate_error
from postlake.operators.timeline import carry, running_total
from postlake.schemas import UNIQUE_TAG_DAYS, UNIQUE_TAG_LIMIT


def due_for_sync(tags: DataFrame, kind: str, now: Column) -> DataFrame:
    """Active tags with this kind enabled whose tracking window covers ``now`` (open ends pass)."""
    return tags.filter(
        F.col("is_active")
        & F.col(f"{kind}_sync_enabled")
        & (F.col("track_from").isNull() | (F.col("track_from") <= now))
        & (F.col("track_until").isNull() | (F.col("track_until") >= now))
    )


def dispatch_jobs(tags: DataFrame, now: Column, kinds: tuple[str, ...] = ("top", "recent")) -> DataFrame:
    """One sync job per due tag and kind, with the message body that carries it."""
    due = None
    for kind in kinds:
        part = due_for_sync(tags, kind, now).select(run_type_of(F.lit(kind)).alias("type"), F.col("id").alias("hashtag_id"))
        due = part if due is None else due.unionByName(part)
    body = F.to_json(F.struct(F.col("type"), F.col("hashtag_id").alias("hashtagId")))
    return due.withColumn("body", body)


def resolved_tags(tags: DataFrame) -> DataFrame:
    return tags.filter(F.col("ig_hashtag_id").isNotNull())


def broken_tags(tags: DataFrame) -> DataFrame:
    """Tags that failed since their last success, worst first."""
    return tags.filter("consecutive_failures > 0").orderBy(F.desc("consecutive_failures"), "name")


def ensure_tracked(tags: DataFrame, asked: DataFrame, name: str, now: Column) -> DataFrame:
    """Add the asked tags that are not tracked yet. A known tag keeps its settings and only
    has ``updated_at`` touched.

    ``asked`` may carry ``track_from``, ``track_until`` and ``notes`` for new tags; when a tag is asked for several
    times, the smallest (name as written, window, notes) counts.
    """
    given = [c for c in ("track_from", "track_until", "notes") if c in asked.columns]
    named = asked.select(normalize_tag(F.col(name)).alias("name"), F.struct(F.col(name).alias("_as"), *given).alias("_ask"))
    wanted = named.groupBy("name").agg(F.min("_ask").alias("_ask"))
    touched = wanted.drop("_ask").withColumn("_asked", F.lit(True))
    kept = tags.join(touched, "name", "left").withColumn(
        "updated_at", F.when(F.col("_asked"), now).otherwise(F.col("updated_at"))
    )
    fresh = wanted.join(tags.select("name"), "name", "left_anti").select(
        stable_id(F.col("name")).alias("id"), "name", F.lit(True).alias("is_active"),
        F.lit(True).alias("top_sync_enabled"), F.lit(True).alias("recent_sync_enabled"),
        F.lit(0).alias("consecutive_failures"), now.alias("created_at"), now.alias("updated_at"),
        *[F.col(f"_ask.{c}").alias(c) for c in given],
    )
    return kept.drop("_asked").unionByName(fresh, allowMissingColumns=True)


def set_active(tags: DataFrame, asked: DataFrame, name: str, active: bool, now: Column) -> DataFrame:
    """Track or untrack the asked tags by flag; nothing is deleted."""
    wanted = asked.select(normalize_tag(F.col(name)).alias("name")).distinct().withColumn("_asked", F.lit(True))
    hit = F.col("_asked").isNotNull()
    return (
        tags.join(wanted, "name", "left")
        .withColumns(
            {
                "is_active": F.when(hit, F.lit(active)).otherwise(F.col("is_active")),
                "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
            }
        )
        .drop("_asked")
    )


def cache_external_id(tags: DataFrame, resolved: DataFrame, now: Column) -> DataFrame:
    """Fill in external ids from ``resolved`` (id, external_id) where none is cached."""
    fills = F.col("ig_hashtag_id").isNull() & F.col("external_id").isNotNull()
    return (
        tags.join(resolved.select("id", "external_id"), "id", "left")
        .withColumn("_fills", fills)
        .withColumns(
            {
                "ig_hashtag_id": F.coalesce("ig_hashtag_id", "external_id"),
                "ig_hashtag_id_resolved_at": F.when(F.col("_fills"), now).otherwise(F.col("ig_hashtag_id_resolved_at")),
                "updated_at": F.when(F.col("_fills"), now).otherwise(F.col("updated_at")),
            }
        )
        .drop("external_id", "_fills")
    )


def sync_health(tags: DataFrame, ends: DataFrame) -> DataFrame:
    """Apply run ends (hashtag_id, source, at, run_id, failure) to the tags.

    A success clears the failure count and the error; failures after the last success count up.
    """
    when = F.struct("at", "run_id")
    failed = F.col("failure").isNotNull()
    succeeded = ends.groupBy("hashtag_id").agg(
        F.max(F.when(~failed, when)).alias("_ok"),
        F.max(F.when(~failed & (F.col("source") == "top"), F.col("at"))).alias("_top_at"),
        F.max(F.when(~failed & (F.col("source") == "recent"), F.col("at"))).alias("_recent_at"),
        F.max("at").alias("_at"),
    )
    # One row per tag: small enough for AQE to broadcast, and a skew join otherwise.
    since = (
        ends.filter(failed)
        .join(succeeded.select("hashtag_id", "_ok"), "hashtag_id")
        .filter(F.col("_ok").isNull() | (when > F.col("_ok")))
        .groupBy("hashtag_id")
        .agg(F.count("*").alias("_fails"), F.max_by("failure", when).alias("_error"))
    )
    news = succeeded.join(since, "hashtag_id", "left").withColumnRenamed("hashtag_id", "id")
    fails = F.coalesce("_fails", F.lit(0))
    cleared = F.col("_ok").isNotNull()
    return (
        tags.join(news, "id", "left")
        .withColumns(
            {
                "consecutive_failures": (
                    F.when(cleared, fails).otherwise(F.col("consecutive_failures") + fails).cast("int")
                ),
                "last_sync_error": F.when(F.col("_fails") > 0, truncate_error(F.col("_error"), TAG_ERROR_LENGTH)).when(
                    ~cleared, F.col("last_sync_error")
                ),
                "last_top_synced_at": F.coalesce("_top_at", "last_top_synced_at"),
                "last_recent_synced_at": F.coalesce("_recent_at", "last_recent_synced_at"),
                "updated_at": F.coalesce("_at", "updated_at"),
            }
        )
        .drop("_ok", "_top_at", "_recent_at", "_at", "_fails", "_error")
    )


def rolling_unique_tags(
    runs: DataFrame, days: int = UNIQUE_TAG_DAYS, limit: int = UNIQUE_TAG_LIMIT, account: str | None = None, width: str = "month"
) -> DataFrame:
    """Unique tags asked for in the trailing window, at every moment a tag enters it.

    With ``account``, the quota of each account is counted on its own. ``width`` is the slot that one task orders.

    A tag is inside the window from a query until ``days`` after its last query. Those spans
    turn into +1 and -1 steps whose running total is the count, so no task ever holds the
    queries of a week, and the total is ordered by day, not by one global window over rows.
    """
    by = [account] if account else []
    asked = runs.select(*by, "hashtag_id", F.col("started_at").alias("at")).distinct()
    span = F.expr(f"INTERVAL {days} DAYS")
    before = carry(asked, [*by, "hashtag_id"], ["at"], previous=["at"], width=width)
    enters = before.filter(F.col("prev").isNull() | (F.col("at") > F.col("prev.at") + span))
    # Looking backwards from every entry gives the end of the span before it; the last span of
    # a tag ends after all entries that could count it twice, so it needs no step.
    leaves = enters.filter(F.col("prev").isNotNull()).select(
        *by,
        # A query exactly at the edge still counts: the tag leaves one microsecond later.
        (F.col("prev.at") + span + F.expr("INTERVAL 1 MICROSECOND")).alias("at"), F.lit(-1).alias("step"),
    )
    final = asked.groupBy(*by, "hashtag_id").agg(F.max("at").alias("at")).select(
        *by,
        (F.col("at") + span + F.expr("INTERVAL 1 MICROSECOND")).alias("at"), F.lit(-1).alias("step")
    )
    steps = enters.select(*by, "at", F.lit(1).alias("step")).unionByName(leaves).unionByName(final)
    per_moment = steps.groupBy(*by, "at").agg(F.sum("step").alias("step"), F.count_if(F.col("step") > 0).alias("entered"))
    total = running_total(per_moment, "at", "step", "unique_tags", width=width, keys=by)
    return total.filter("entered > 0").select(
        *by,        F.col("at").alias("entered_at"), "entered", "unique_tags", (F.col("unique_tags") > limit).alias("over_limit")
    )

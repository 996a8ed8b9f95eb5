"""The audit table of ingestion runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.scalars import (
    RUN_ERROR_LENGTH,
    duration_ms,
    stable_id,
    truncate_error,
    usage_summary,
)
from postlake.operators.history import ARRIVAL, observation_flags, record_changes
from postlake.operators.validate import split_valid
from postlake.schemas import ATTEMPT_PAGES, DEFAULT_ITEM_CAP, RUN_TYPES, SOURCES, TRACKED_COLUMNS

COUNTERS = ("items_seen", "items_new", "items_updated", "metrics_recorded", "asset_jobs_enqueued")


def resumable_run(runs: DataFrame) -> DataFrame:
    """Newest ``running`` run per (type, tag); finished runs have nothing to resume."""
    newest = F.max_by(F.struct(*runs.columns), F.struct("started_at", "id"))
    return (
        runs.filter(F.col("status") == "running")
        .groupBy("type", "hashtag_id")
        .agg(newest.alias("run"))
        .select("run.*")
    )


def start_runs(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """The run each (type, tag) of the jobs works on: the unfinished one, else a new one.

    ``jobs`` has type, hashtag_id, message_id, attempt and at. Jobs of one batch that name the
    same (type, tag) share the run that the earliest of them starts. The id of a new run is made from
    message, attempt and start, so a message that comes again after its run ended starts another run.
    A resumed run goes on after ``last_cursor`` and ``items_seen`` where ``runs`` has them, and counts one more attempt.
    """
    first = F.min_by(F.struct("message_id", "attempt", "at"), F.struct("at", "message_id"))
    wanted = jobs.groupBy("type", "hashtag_id").agg(first.alias("job"))
    open_runs = resumable_run(runs)

    def stored(name: str, kind: str, default: Column) -> Column:
        held = F.coalesce(F.col(name), default) if name in runs.columns else default
        return held.cast(kind)

    resumed = open_runs.join(wanted.select("type", "hashtag_id"), ["type", "hashtag_id"], "left_semi").select(
        "id", "type", "hashtag_id", "status", "triggered_by_message_id", "started_at",
        (stored("attempts", "int", F.lit(1)) + 1).alias("attempts"), stored("items_seen", "int", F.lit(0)).alias("items_seen"),
        stored("last_cursor", "string", F.lit(None)).alias("last_cursor"), F.lit(True).alias("resumed"),
    )
    fresh = wanted.join(open_runs.select("type", "hashtag_id"), ["type", "hashtag_id"], "left_anti").select(
        stable_id(
            F.col("job.message_id"), F.col("type"), F.col("hashtag_id"), F.col("job.attempt").cast("string"), F.unix_micros("job.at").cast("string")
        ).alias("id"),
        "type", "hashtag_id", F.lit("running").alias("status"),
        F.col("job.message_id").alias("triggered_by_message_id"),
        F.col("job.at").alias("started_at"), F.coalesce("job.attempt", F.lit(1)).cast("int").alias("attempts"),
        F.lit(0).alias("items_seen"), F.lit(None).cast("string").alias("last_cursor"), F.lit(False).alias("resumed"),
    )
    return resumed.unionByName(fresh)


def finish_runs(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Close the runs named in ``outcomes`` (id, ended_at, failure, items_landed, hit_cap).

    A failure after at least one landed item is ``partial``: those items stay queryable.
    """
    ended = outcomes.select("id", F.struct("ended_at", "failure", "items_landed", "hit_cap").alias("end"))
    status = (
        F.when(F.col("end").isNull(), F.col("status"))
        .when(F.col("end.failure").isNull(), "succeeded")
        .when(F.col("end.items_landed") > 0, "partial")
        .otherwise("failed")
    )

    def closed(value: Column, old: str) -> Column:
        return F.when(F.col("end").isNotNull(), value).otherwise(F.col(old))

    return (
        runs.join(ended, "id", "left")
        .withColumns(
            {
                "status": status,
                "finished_at": closed(F.col("end.ended_at"), "finished_at"),
                "duration_ms": closed(duration_ms(F.col("started_at"), F.col("end.ended_at")), "duration_ms"),
                "error": closed(truncate_error(F.col("end.failure"), RUN_ERROR_LENGTH), "error"),
                "hit_item_cap": closed(F.col("end.hit_cap").cast("int"), "hit_item_cap"),
            }
        )
        .drop("end")
    )


def advance_runs(heads: DataFrame, known: DataFrame, item_cap: int | None = DEFAULT_ITEM_CAP) -> DataFrame:
    """The runs that pages arrived for, after those pages: one audit row each.

    ``heads`` has one row per page (``page_heads``), ``known`` the runs as they were. A run goes on where it was: offset, pages of
    each attempt, first start, last cursor and usage reading are kept unless newer ones came. A run ends with the page
    that names no next one, or at the item cap (None: the source has none); it then succeeds, or with a page that could not be read fails, in part where
    items landed. A run that ended goes on if newer pages still come. Counters of curated items are added by ``add_counters``.
    """
    seq = F.col("arrival_seq")
    readable = F.col("items").isNotNull()
    seen = heads.groupBy("sync_run_id").agg(
        F.min_by(F.struct("hashtag_id", "source"), seq).alias("of"), F.min("fetched_at").alias("first_at"), F.max("fetched_at").alias("last_at"),
        F.max("attempt").alias("attempt"), F.count_if(readable).alias("pages"), F.count_if(~readable).alias("unread"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.max(F.when(readable, seq)).alias("seq"),
        F.max_by("goes_on", F.when(readable, seq)).alias("goes_on"), F.max_by("next_cursor", F.when(F.col("next_cursor").isNotNull(), seq)).alias("cursor"),
        F.max_by("usage", F.when(F.col("usage").isNotNull(), seq)).alias("usage"),
    )
    # A run has few attempts.
    pages = heads.filter(readable).groupBy("sync_run_id", "attempt").agg(F.count("*").alias("pages"))
    earlier = known.select(F.col("id").alias("sync_run_id"), F.inline("attempt_pages"))
    counted = pages.unionByName(earlier).groupBy("sync_run_id", "attempt").agg(F.sum("pages").alias("pages"))
    counted = counted.groupBy("sync_run_id").agg(F.sort_array(F.collect_list(F.struct("attempt", "pages"))).alias("attempt_pages"))
    old = known.select(F.col("id").alias("_id"), F.struct(*known.columns).alias("old"))
    runs = seen.join(counted, "sync_run_id", "left").join(old, F.col("sync_run_id") == F.col("_id"), "left")

    def added(name: str, more: Column) -> Column:
        return F.coalesce(F.col(f"old.{name}"), F.lit(0)) + more

    def kept(name: str) -> Column:
        return F.coalesce(F.col(f"old.{name}"), F.lit(0))

    newer = F.col("old.last_seq").isNull() | (F.col("seq") >= F.col("old.last_seq"))
    landed = added("items_landed", F.col("items"))
    capped = F.lit(False) if item_cap is None else landed >= item_cap
    ends = F.when(F.coalesce(newer, F.lit(False)), ~F.col("goes_on")).otherwise(F.coalesce(F.col("old.status") != "running", F.lit(False)))
    runs = runs.select(
        F.col("sync_run_id").alias("id"),
        F.coalesce("old.type", F.when(F.col("of.source") == SOURCES[0], RUN_TYPES[0]).otherwise(RUN_TYPES[1])).alias("type"),
        F.lit("running").alias("status"), F.coalesce("old.hashtag_id", "of.hashtag_id").alias("hashtag_id"), F.col("old.triggered_by_message_id"),
        F.coalesce("old.started_at", "first_at").alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit(None).cast("long").alias("duration_ms"), added("pages_fetched", F.col("pages")).alias("pages_fetched"),
        *[kept(c).alias(c) for c in COUNTERS], F.lit(0).alias("hit_item_cap"), F.coalesce("usage", "old.rate_limit_snapshot").alias("rate_limit_snapshot"),
        F.coalesce(F.when(newer, F.col("cursor")), F.col("old.last_cursor")).alias("last_cursor"),
        F.greatest("old.attempts", "attempt").alias("attempts"), F.lit(None).cast("string").alias("error"),
        F.coalesce("old.created_at", "first_at").alias("created_at"), landed.alias("items_landed"),
        F.coalesce("attempt_pages", F.array().cast(ATTEMPT_PAGES)).alias("attempt_pages"),
        added("pages_unreadable", F.col("unread")).alias("pages_unreadable"), kept("items_invalid").alias("items_invalid"),
        F.greatest("old.last_seen_at", "last_at").alias("last_seen_at"), F.greatest("old.last_seq", "seq").alias("last_seq"),
        (ends | capped).alias("_ends"), capped.alias("_capped"),
    )
    lost = F.when(F.col("pages_unreadable") > 0, F.format_string("%d unreadable page(s)", F.col("pages_unreadable")))
    ended = runs.filter("_ends").select(
        "id", F.col("last_seen_at").alias("ended_at"), lost.alias("failure"), "items_landed", F.col("_capped").alias("hit_cap")
    )
    return finish_runs(runs.drop("_ends", "_capped"), ended)


def add_counters(runs: DataFrame, counters: DataFrame) -> DataFrame:
    """``runs`` with the counters of curated items, by ``sync_run_id``, added."""
    names = [c for c in counters.columns if c != "sync_run_id"]
    more = counters.select(F.col("sync_run_id").alias("id"), F.struct(*names).alias("_more"))
    return runs.join(more, "id", "left").withColumns({c: F.col(c) + F.coalesce(F.col(f"_more.{c}"), F.lit(0)) for c in names}).drop("_more")


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("id")).limit(limit)


def run_item_cap(data_points: DataFrame, tags: DataFrame) -> DataFrame:
    """Items of every run up to its tag's cap, and ``hit_item_cap`` when the cap was reached.

    ``position_overall`` already numbers a run's items from 0, so the cut is a filter. A run
    that ends exactly at its cap is flagged as well.
    """
    caps = tags.select(F.col("id").alias("hashtag_id"), F.coalesce("max_media_per_sync", F.lit(DEFAULT_ITEM_CAP)).alias("cap"))
    kept = data_points.join(caps, "hashtag_id").filter(F.col("position_overall") < F.col("cap"))
    return kept.groupBy("sync_run_id", "hashtag_id", "cap").agg(
        F.count("*").alias("items_kept"),
    ).withColumn("hit_item_cap", (F.col("items_kept") >= F.col("cap")).cast("int"))


def run_counters(observations: DataFrame, page: Column, runs: DataFrame | None = None, width: str = "day") -> DataFrame:
    """Progress per run: pages, items seen, new and updated, history rows, asset jobs.

    ``page`` identifies the page an observation arrived on. With ``runs`` the increments are
    added to the stored counters.
    """
    flags = observation_flags(observations.withColumn("_page", page), width=width)
    # A post first seen without a file URL is skipped for good, so later URLs start no job.
    wants_file = F.col("media_url").isNotNull() & F.col("first_media_url").isNotNull()
    seen = flags.groupBy("sync_run_id").agg(
        F.count_distinct("_page").alias("pages_fetched"),
        F.count("*").alias("items_seen"),
        F.count_if("is_new").alias("items_new"),
        F.count_if("content_changed").alias("items_updated"),
        F.count_if(wants_file).alias("asset_jobs_enqueued"),
    )
    tracked = observations.select("ig_media_id", *ARRIVAL, "source", *[c for c in TRACKED_COLUMNS if c != "rank"])
    written = record_changes(tracked, width=width).groupBy("sync_run_id").agg(F.count("*").alias("metrics_recorded"))
    counters = seen.join(written, "sync_run_id", "left").withColumn(
        "metrics_recorded", F.coalesce("metrics_recorded", F.lit(0))
    )
    if runs is None:
        return counters
    names = [c for c in counters.columns if c != "sync_run_id"]
    delta = counters.select(F.col("sync_run_id").alias("id"), F.struct(*names).alias("delta"))
    return (
        runs.join(delta, "id", "left")
        .withColumns({c: (F.col(c) + F.coalesce(F.col(f"delta.{c}"), F.lit(0))).cast("int") for c in names})
        .drop("delta")
    )


def replay_summary(validated: DataFrame, width: str = "day") -> DataFrame:
    """Per run: payloads reprocessed, posts created, posts changed, payloads invalid.

    ``validated`` is the checked raw layer, with its ``errors`` column.
    """
    invalid = validated.groupBy("sync_run_id").agg(F.count_if(F.size("errors") > 0).alias("invalid"))
    observations, _ = split_valid(validated)
    applied = observation_flags(observations, width=width).groupBy("sync_run_id").agg(
        F.count("*").alias("reprocessed"),
        F.count_if("is_new").alias("created"),
        F.count_if("content_changed").alias("changed"),
    )
    counts = ["reprocessed", "created", "changed"]
    return invalid.join(applied, "sync_run_id", "left").select(
        "sync_run_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "invalid"
    )


def dedupe_report(runs: DataFrame) -> DataFrame:
    """Seen against new items per run, oldest run first."""
    return runs.select(
        "id", "type", "status", "started_at", "items_seen", "items_new",
        (F.col("items_seen") - F.col("items_new")).alias("duplicates"),
    ).orderBy("started_at", "id")


def duplicate_delivery(runs: DataFrame) -> DataFrame:
    """Messages that started more than one run."""
    return (
        runs.filter(F.col("triggered_by_message_id").isNotNull())
        .groupBy("triggered_by_message_id")
        .agg(F.count("*").alias("runs"), F.min("started_at").alias("first_started"), F.max("started_at").alias("last_started"))
        .filter("runs > 1")
    )


def usage_vs_duration(runs: DataFrame, app_usage: Column, business_usage: Column, step: int = 10) -> DataFrame:
    """Run duration and failure rate by bucket of the worst usage percentage, and over all runs the correlation of
    usage and duration (``usage_corr``, null with fewer than two different values)."""
    worst = usage_summary(app_usage, business_usage)["worst_pct"]
    finished = runs.filter(F.col("finished_at").isNotNull()).withColumn("worst_pct", worst)
    took = duration_ms(F.col("started_at"), F.col("finished_at"))
    read = finished.filter(F.col("worst_pct").isNotNull())
    whole = read.agg(F.corr("worst_pct", took.cast("double")).alias("_corr")).select(
        F.lit(1).alias("one"), F.when(~F.isnan("_corr"), F.round("_corr", 6)).alias("usage_corr")
    )
    buckets = (
        read.groupBy((F.floor(F.col("worst_pct") / step) * step).cast("int").alias("usage_from"))
        .agg(
            F.count("*").alias("runs"),
            F.sum(took.cast("long")).alias("total_ms"),
            F.round(F.avg(took), 3).alias("avg_ms"),
            F.round(F.avg(F.when(F.col("status").isin("failed", "partial"), 1.0).otherwise(0.0)), 6).alias("failure_rate"),
        )
    )
    return buckets.withColumn("one", F.lit(1)).join(whole, "one").drop("one")


def cascade_delete(run_ids: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    """Each table without the rows of the deleted runs."""
    gone = run_ids.select(F.col("id").alias("sync_run_id")).distinct()
    return [table.join(gone, "sync_run_id", "left_anti") for table in tables]

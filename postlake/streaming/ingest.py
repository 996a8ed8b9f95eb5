"""Structured Streaming ingestion: the batch transformations, one micro-batch at a time.

What a micro-batch needs of the past is state in buckets: the runs that its pages belong to, the posts and files it touches.
It reads and rewrites those buckets only, so its cost follows its own size and not the age of the lake.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.functions.scalars import stable_id
from postlake.operators.assets import ensure_pending, merge_assets
from postlake.operators.history import change_history, observation_flags
from postlake.operators.posts import upsert_posts
from postlake.operators.runs import add_counters, advance_runs
from postlake.operators.validate import route_messages, split_valid, with_validation
from postlake.schemas import DEFAULT_ITEM_CAP, LANDED_PAGE, MAX_DELIVERIES
from postlake.session import staged
from postlake.sources.bronze import land_pages, page_heads, parsed_pages, read_landing_stream, unreadable_pages
from postlake.sources.tables import (
    RECORDED_COLUMNS,
    append_log,
    conform_to,
    merge_state,
    read_log,
    read_state,
    run_bucket,
    run_day,
    state_before,
    state_rows,
)

# A run is looked for among those that began so many days before its pages came.
RUN_DAYS = 7


@dataclass
class Landed:
    """A load after its raw rows are written. ``runs``: sync_run_id, run_day and ``continues`` for the runs at hand; ``audit``:
    their rows after these pages; ``since``: the first day on which they may have begun."""

    load: str
    runs: DataFrame
    audit: DataFrame
    since: str


def _land(pages: DataFrame, load: str, root: str, item_cap: int | None) -> Landed | None:
    """Raw rows of a micro-batch, placed where the runs were left."""
    spark = pages.sparkSession
    # The bodies are read and parsed once: heads, raw rows and unreadable pages are columns or filters of the stored pages.
    pages = staged(parsed_pages(conform_to(pages, LANDED_PAGE)), "pages")
    heads = staged(page_heads(pages), "heads")
    first = heads.agg(F.min("fetched_at")).first()[0]
    if first is None:
        return None
    since = (first - dt.timedelta(days=RUN_DAYS)).strftime("%Y-%m-%d")
    known = state_before(spark, "sync_runs", root, heads.select(F.col("sync_run_id").alias("id")).distinct(), load, since)
    audit = staged(advance_runs(heads, known, item_cap), "runs")
    begun = known.select("id", F.lit(True).alias("continues"), F.col("items_landed").alias("_landed"), F.col("attempt_pages").alias("_pages"))
    runs = audit.join(begun, "id", "left").select(
        F.col("id").alias("sync_run_id"), run_day(F.col("started_at")).alias("run_day"), F.coalesce("continues", F.lit(False)).alias("continues"),
        F.col("_landed").alias("items_landed"), F.col("_pages").alias("attempt_pages"),
    )
    runs = staged(runs, "runs-at-hand")
    append_log(land_pages(pages, runs.filter("continues")), "data_points", root, load, runs)
    append_log(unreadable_pages(pages), "page_quarantine", root, load, runs)
    return Landed(load, runs, audit, since)


def _curate(spark: SparkSession, landed: Landed, root: str) -> None:
    """Posts, history, assets and run progress of one landed load.

    Everything is read back from the landed rows, so a retry starts from storage, and only buckets of touched posts are written.
    """
    load, runs = landed.load, landed.runs
    raw = read_log(spark, "data_points", root, runs, load).drop("id", "ig_media_id", "run_day", "run_bucket", "load")
    # Checked once: both parts are filters over the stored rows.
    good, bad = split_valid(staged(with_validation(raw), "checked"))
    append_log(bad, "item_quarantine", root, load, runs)
    observations = good.drop("payload")
    flags = _apply(spark, observations, runs.filter("continues"), load, root, runs)

    files = observations.select(stable_id(F.col("ig_media_id")).alias("media_id")).distinct()
    before = state_before(spark, "media_assets", root, files, load)
    pending = staged(ensure_pending(observations, before), "pending")
    merge_state(merge_assets(before, pending), "media_assets", root, load)
    jobs = pending.filter("enqueue").select(F.lit("DOWNLOAD_MEDIA_ASSET").alias("type"), "media_id", F.col("fetched_from_url").alias("url"))
    append_log(jobs, "download_jobs", root, load)

    # Progress last: counters never run ahead of the rows they count.
    counters = _counters(spark, flags, before, landed, root)
    merge_state(add_counters(landed.audit, counters), "sync_runs", root, load, landed.since)


def _apply(spark: SparkSession, observations: DataFrame, continuing: DataFrame, load: str, root: str, runs: DataFrame) -> DataFrame:
    """Posts and history after the observations; returns the observations with their flags, stored.

    ``continuing`` are the runs that may have recorded a post in an earlier load.
    """
    touched = observations.select("ig_media_id").distinct()
    posts = state_before(spark, "media_posts", root, touched, load)
    seed = posts.filter(F.col("recorded").isNotNull()).select("ig_media_id", "recorded.*")
    pairs = read_log(spark, "media_post_history", root, continuing).filter(F.col("load") != load).select("ig_media_id", "sync_run_id")
    append_log(change_history(observations, seed, pairs), "media_post_history", root, load, runs)

    written = read_log(spark, "media_post_history", root, runs, load).withColumnRenamed("captured_at", "fetched_at")
    newest = written.groupBy("ig_media_id").agg(F.max(F.struct(*RECORDED_COLUMNS)).alias("_newest"))
    old = posts.select("ig_media_id", F.col("recorded").alias("_old"))
    current = posts.drop("recorded")
    flags = staged(observation_flags(observations, current), "flags")
    after = upsert_posts(observations, current, flagged=flags).join(newest, "ig_media_id", "left").join(old, "ig_media_id", "left")
    merge_state(after.withColumn("recorded", F.greatest("_newest", "_old")), "media_posts", root, load)
    return flags


def _counters(spark: SparkSession, flags: DataFrame, assets: DataFrame, landed: Landed, root: str) -> DataFrame:
    flags = flags.withColumn("media_id", stable_id(F.col("ig_media_id")))
    status = assets.select("media_id", F.col("status").alias("_status"))
    new_status = F.when(F.col("first_media_url").isNull(), "skipped").otherwise("pending")
    waits = F.coalesce("_status", new_status) == "pending"
    seen = flags.join(status, "media_id", "left").groupBy("sync_run_id").agg(
        F.count("*").alias("items_seen"),
        F.count_if("is_new").alias("items_new"),
        F.count_if("content_changed").alias("items_updated"),
        F.count_if(waits & F.col("media_url").isNotNull()).alias("asset_jobs_enqueued"),
    )
    out = landed.runs.select("sync_run_id").join(seen, "sync_run_id", "left")
    for table, name in (("media_post_history", "metrics_recorded"), ("item_quarantine", "items_invalid")):
        rows = read_log(spark, table, root, landed.runs, landed.load)
        out = out.join(rows.groupBy("sync_run_id").agg(F.count("*").alias(name)), "sync_run_id", "left")
    return out.fillna(0)


def run_progress(spark: SparkSession, root: str) -> DataFrame:
    """Counters per run and ``failure``: a run with an unreadable page is not complete and cannot succeed."""
    lost = F.format_string("%d unreadable page(s)", F.col("pages_unreadable"))
    return read_state(spark, "sync_runs", root).select(
        F.col("id").alias("sync_run_id"), "pages_fetched", "items_seen", "items_new", "items_updated", "metrics_recorded", "asset_jobs_enqueued",
        "pages_unreadable", "items_invalid", F.when(F.col("pages_unreadable") > 0, lost).alias("failure"),
    )


def stored_run(spark: SparkSession, root: str, sync_run_id: str) -> DataFrame:
    """Day and bucket of a stored run, by its audit row."""
    rows = state_rows(spark, "sync_runs", root).filter(F.col("bucket") == run_bucket(F.lit(sync_run_id)))
    return rows.filter(F.col("id") == sync_run_id).select(F.col("id").alias("sync_run_id"), "run_day", F.col("bucket").alias("run_bucket"))


def stored_run_scan(spark: SparkSession, root: str, sync_run_id: str) -> DataFrame:
    """Raw rows of one run in response order. The audit row tells the folder, so only that is read (dynamic pruning)."""
    raw = read_log(spark, "data_points", root).drop("load")
    return raw.join(stored_run(spark, root, sync_run_id), ["run_day", "run_bucket", "sync_run_id"]).drop("run_day", "run_bucket").orderBy("position_overall")


def replay_stored(spark: SparkSession, root: str, sync_run_id: str, now: Column) -> None:
    """Apply one stored run's raw rows again, as of ``now``, and store the result beside what streams write.

    A new load with an old run id: its values become the current ones even when newer runs exist, and a history row is added only for
    posts that have none from this run. No asset and audit rows are touched. The same replay stored twice equals once.
    """
    at = spark.range(1).select(F.date_format(now, "yyyyMMdd'T'HHmmssSSSSSS")).first()[0]
    load = f"replay-{sync_run_id}-{at}"
    run = staged(stored_run(spark, root, sync_run_id), "replayed-run")
    raw = read_log(spark, "data_points", root, run).drop("id", "ig_media_id", "run_day", "run_bucket", "load").withColumn("fetched_at", now)
    good, _ = split_valid(with_validation(raw))
    _apply(spark, staged(good, "replayed"), run, load, root, run)


def land_available(
    spark: SparkSession, landing: str, root: str, checkpoint: str, max_files: int | None = None, item_cap: int | None = DEFAULT_ITEM_CAP
) -> None:
    """Land every page that arrived since the checkpoint, raw rows and runs only, then stop."""

    def step(pages: DataFrame, load: str) -> None:
        landed = _land(pages, load, root, item_cap)
        if landed is not None:
            merge_state(landed.audit, "sync_runs", root, load, landed.since)

    _run(read_landing_stream(spark, landing, max_files), checkpoint, step)


def ingest_available(
    spark: SparkSession, landing: str, root: str, checkpoint: str, max_files: int | None = None, item_cap: int | None = DEFAULT_ITEM_CAP
) -> None:
    """Process every page that arrived since the checkpoint, then stop.

    The checkpoint is the resume cursor: a batch is marked done after all its tables are
    written. A crash in between repeats the batch, which replaces its own rows.
    """

    def step(pages: DataFrame, load: str) -> None:
        landed = _land(pages, load, root, item_cap)
        if landed is not None:
            _curate(pages.sparkSession, landed, root)

    _run(read_landing_stream(spark, landing, max_files), checkpoint, step)


def _run(rows: DataFrame, checkpoint: str, step: Callable[[DataFrame, str], None]) -> None:
    """Run ``step`` on every micro-batch. A load is named by stream and batch: a new checkpoint is a new stream, whose loads
    replace none of another's."""

    def named(batch_rows: DataFrame, batch: int) -> None:
        stream = batch_rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        step(batch_rows, f"{stream}-{batch}")

    query = (
        rows.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def dedupe_available(messages: DataFrame, root: str, checkpoint: str) -> None:
    """Add every message of the stream that is not in the lake's ``messages`` yet, then stop.

    However late a delivery comes, it is kept when it is the first with its id: there is no watermark that would drop
    it. Ids lie in buckets by hash; a micro-batch reads the buckets that its ids fall into. Of several
    deliveries in a micro-batch the earliest stays.
    """

    def step(rows: DataFrame, load: str) -> None:
        first = F.min_by(F.struct("hashtag_id", "delivered_at"), F.struct("delivered_at", "hashtag_id"))
        fresh = staged(rows.groupBy("message_id").agg(first.alias("first")).select("message_id", "first.*"), "deliveries")
        known = state_before(rows.sparkSession, "messages", root, fresh, load)
        merge_state(fresh.join(known.select("message_id"), "message_id", "left_anti"), "messages", root, load)

    _run(messages, checkpoint, step)


def dead_letter(deliveries: DataFrame, max_deliveries: int = MAX_DELIVERIES) -> DataFrame:
    """Messages delivered more often than allowed, with the count. Works on a batch and, in
    complete or update mode, on a stream."""
    return (
        deliveries.groupBy("message_id")
        .agg(F.count("*").alias("deliveries"), F.max("delivered_at").alias("last_delivered_at"))
        .filter(F.col("deliveries") > max_deliveries)
    )


def park_available(deliveries: DataFrame, root: str, checkpoint: str, max_deliveries: int = MAX_DELIVERIES) -> None:
    """Park every message of the stream once, on the delivery that passes the limit, then stop.

    ``message_counts`` holds the deliveries so far of every message, ``parked`` a row per parked message. Of a message that a micro-batch
    brings very often, only the first deliveries up to the limit are ordered.
    """

    def step(rows: DataFrame, load: str) -> None:
        spark = rows.sparkSession
        rows = rows.filter(F.col("message_id").isNotNull())
        counts = staged(rows.groupBy("message_id").agg(F.count("*").alias("n")), "counts")
        before = state_before(spark, "message_counts", root, counts, load)
        so_far = F.coalesce("deliveries", F.lit(0))
        by_time = Window.partitionBy("message_id").orderBy("delivered_at")
        early = rows.select("message_id", "delivered_at", F.row_number().over(by_time).alias("k")).filter(F.col("k") <= max_deliveries + 1)
        passing = early.join(before, "message_id", "left").filter(so_far + F.col("k") == max_deliveries + 1)
        append_log(passing.select("message_id", F.lit(max_deliveries + 1).alias("deliveries"), F.col("delivered_at").alias("parked_at")), "parked", root, load)
        total = counts.join(before, "message_id", "left").select("message_id", (so_far + F.col("n")).alias("deliveries"))
        merge_state(total, "message_counts", root, load)

    _run(deliveries, checkpoint, step)


def route_stream(messages: DataFrame, root: str, checkpoint: str) -> None:
    """Route messages as they arrive: jobs to ``jobs``, unreadable ones to ``dead_letter``."""

    def step(rows: DataFrame, load: str) -> None:
        routed = route_messages(rows)
        parked = F.col("route") == "dead_letter"
        append_log(routed.filter(~parked), "jobs", root, load)
        append_log(routed.filter(parked), "dead_letter", root, load)

    _run(messages, checkpoint, step)

"""Files of posts: what to download, what is stored, which posts share the same bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.scalars import (
    ASSET_ERROR_LENGTH,
    asset_source_url,
    content_key,
    content_sha256,
    content_size,
    extension_for,
    stable_id,
    truncate_error,
)
from postlake.operators.history import ARRIVAL
from postlake.schemas import RETENTION_DAYS

RETRYABLE = ("pending", "failed", "downloading")


def write_files(files: DataFrame, folder: str) -> list[str]:
    """Store the ``content`` bytes of every row as a file of its own, named after ``media_id``, and return the folders that hold them.

    Spark's writers would need a folder, a checksum file and several changes of permissions per file. Here a task writes all its files into
    one new folder and names it at its end, so what a failed attempt left is not among the folders returned. Two rows of one post are two
    files, a row without bytes is none. ``folder`` is a mounted path or a store that ``pyarrow.fs`` opens; ``media_id`` holds no dot or slash.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(folder)
        home, n = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", 0
        for batch in batches:
            if not n:
                store.create_dir(f"{base}/{home}")
            for name, content in zip(batch.column("media_id").to_pylist(), batch.column("content")):
                with store.open_output_stream(f"{base}/{home}/{name}.{n}") as out:
                    out.write(content.as_buffer())
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"folder": [f"{folder}/{home}"]})

    rows = files.select("media_id", "content").filter(F.col("content").isNotNull()).repartition("media_id").mapInArrow(save, "folder string")
    return [row.folder for row in rows.collect()]


def read_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Downloaded files with digest and size. ``media_id`` is the file's name up to its first dot: a flat or nested
    folder of files works alike, a list of folders is listed by tasks, and no folder per file has to be."""
    if path:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    else:
        files = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    return files.withColumns({"media_id": F.regexp_extract("path", r"([^/.]+)[^/]*$", 1), "sha256": content_sha256(F.col("content")), "size_bytes": content_size(F.col("content"))})


def asset_exists(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """The candidate keys that are stored already."""
    return candidates.select("storage_key").distinct().join(stored.select("storage_key"), "storage_key", "left_semi")


def stored_anti(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """The candidate posts whose file is not stored yet."""
    done = stored.filter(F.col("status") == "stored").select("media_id")
    return candidates.join(done, "media_id", "left_anti")


def with_storage_key(files: DataFrame) -> DataFrame:
    return files.withColumn("storage_key", content_key(F.col("sha256"), extension_for(F.col("content_type"))))


def _first_arrivals(files: DataFrame, known: DataFrame | None) -> DataFrame:
    """(storage_key, arrival) of the file to store per new key. The minimum combines map-side,
    so a key shared by a third of all files leaves each task once."""
    firsts = files.groupBy("storage_key").agg(F.min("arrival").alias("arrival"))
    if known is not None:
        firsts = firsts.join(known.select("storage_key"), "storage_key", "left_anti")
    return firsts


def download_outcome(files: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Add ``storage_key`` and ``outcome`` per download job.

    ``files``: media_id, arrival (unique), url, already_stored, fetch_fails, sha256,
    content_type. The first arrival of a key is stored, later ones reuse the object.
    """
    keyed = with_storage_key(files)
    skipped = F.col("already_stored") | F.col("url").isNull()
    fetched = keyed.filter(~skipped & ~F.col("fetch_fails"))
    # Joining on (key, arrival) instead of the key keeps copies of one file spread out.
    winners = _first_arrivals(fetched.select("storage_key", "arrival"), known).withColumn("_wins", F.lit(True))
    outcome = (
        F.when(skipped, "skipped")
        .when(F.col("fetch_fails"), "failed")
        .when(F.col("_wins"), "stored")
        .otherwise("deduplicated")
    )
    done = keyed.join(winners, ["storage_key", "arrival"], "left").withColumn("outcome", outcome).drop("_wins")
    has_key = F.col("outcome").isin("stored", "deduplicated")
    return done.withColumn("storage_key", F.when(has_key, F.col("storage_key")))


def download_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("files"))


def asset_store(files: DataFrame, root: str, known: DataFrame | None = None, batch: str = "0") -> None:
    """Write each distinct new object once, below ``batch`` and a folder per key level.

    A repeated batch replaces its own folders, so nothing is stored twice. Winners are chosen on keys alone and found by
    (key, arrival), so copies of one file are never gathered; where the winners' table is small Spark broadcasts it
    and no bytes move for this. Then the winners, each object once, move to the task of their folder: a folder is
    written by one task, as one file.
    """
    keyed = with_storage_key(files)
    firsts = _first_arrivals(keyed.select("storage_key", "arrival"), known)
    objects = keyed.join(firsts, ["storage_key", "arrival"], "left_semi")
    out = objects.select("storage_key", "sha256", "size_bytes", "content_type", "content").withColumns(
        {"p1": F.substring("sha256", 1, 2), "p2": F.substring("sha256", 3, 2)}
    )
    out.repartition("p1", "p2").write.mode("overwrite").partitionBy("p1", "p2").parquet(f"{root}/batch={batch}")


def ensure_pending(observations: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Asset rows after the observations: insert when missing, else only refresh the URL.

    The status of a new row follows the URL of the post's first sighting and is never changed
    here. ``enqueue`` is set when a download job is due.
    """
    arrival = F.struct(*ARRIVAL)
    seen = observations.groupBy("ig_media_id").agg(
        F.min_by(F.struct("media_url", "fetched_at"), arrival).alias("head"),
        F.max_by(F.struct("media_url", "fetched_at"), arrival).alias("tail"),
    )
    seen = seen.withColumn("media_id", stable_id(F.col("ig_media_id"))).drop("ig_media_id")
    new_status = F.when(F.col("head.media_url").isNull(), "skipped").otherwise("pending")
    if assets is None:
        merged = seen.withColumns({"status": new_status, "created_at": F.col("head.fetched_at")})
    else:
        old = assets.select("media_id", F.struct(*[c for c in assets.columns if c != "media_id"]).alias("old"))
        merged = seen.join(old, "media_id", "left").withColumns(
            {
                "status": F.coalesce("old.status", new_status),
                "created_at": F.coalesce("old.created_at", "head.fetched_at"),
            }
        )
    url = F.col("tail.media_url")
    return merged.select(
        stable_id(F.lit("asset"), F.col("media_id")).alias("id"), "media_id", "status",
        url.alias("fetched_from_url"), "created_at", F.col("tail.fetched_at").alias("updated_at"),
        ((F.col("status") == "pending") & url.isNotNull()).alias("enqueue"),
    )


def merge_assets(assets: DataFrame, pending: DataFrame) -> DataFrame:
    """The asset table with the rows of ``ensure_pending`` applied."""
    news = pending.select("media_id", F.struct("id", "status", "fetched_from_url", "created_at", "updated_at").alias("new"))
    had = F.col("had").isNotNull()
    old = assets.withColumn("had", F.lit(True))
    touched = F.col("new").isNotNull()

    def fill(name: str) -> Column:
        return F.when(had, F.col(name)).otherwise(F.col(f"new.{name}"))

    joined = old.join(news, "media_id", "full_outer")
    return joined.withColumns(
        {
            "id": fill("id"),
            "status": fill("status"),
            "created_at": fill("created_at"),
            "attempts": F.coalesce("attempts", F.lit(0)),
            "fetched_from_url": F.when(touched, F.col("new.fetched_from_url")).otherwise(F.col("fetched_from_url")),
            "updated_at": F.when(touched, F.col("new.updated_at")).otherwise(F.col("updated_at")),
        }
    ).select(*assets.columns)


def asset_transitions(assets: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply ordered state changes (media_id, seq, status, at, sha256, storage_key, storage_provider, size_bytes,
    content_type, reason) to the asset rows."""
    to = F.col("status")
    stored = F.struct("sha256", "storage_key", "storage_provider", "content_type", "size_bytes", F.col("at").alias("stored_at"))
    settled = to.isin("stored", "failed", "skipped")
    reason = F.struct(F.when(to != "stored", truncate_error(F.col("reason"), ASSET_ERROR_LENGTH)).alias("text"))
    last = changes.groupBy("media_id").agg(
        F.max_by("status", "seq").alias("_status"),
        F.count_if(to == "downloading").alias("_tries"),
        F.max_by(F.when(to == "downloading", F.col("at")), F.when(to == "downloading", F.col("seq"))).alias("_begun"),
        F.max_by(F.when(to == "stored", stored), F.when(to == "stored", F.col("seq"))).alias("_stored"),
        F.max_by(F.when(settled, reason), F.when(settled, F.col("seq"))).alias("_reason"),
        F.max_by("at", "seq").alias("_at"),
    )
    joined = assets.join(last, "media_id", "left")
    columns = {
        "status": F.coalesce("_status", "status"),
        "attempts": (F.col("attempts") + F.coalesce("_tries", F.lit(0))).cast("int"),
        "download_started_at": F.coalesce("_begun", "download_started_at"),
        "last_error": F.when(F.col("_reason").isNotNull(), F.col("_reason.text")).otherwise(F.col("last_error")),
        "updated_at": F.coalesce("_at", "updated_at"),
    }
    for name in ("sha256", "storage_key", "storage_provider", "content_type", "size_bytes", "stored_at"):
        columns[name] = F.when(F.col("_stored").isNotNull(), F.col(f"_stored.{name}")).otherwise(F.col(name))
    return joined.withColumns(columns).select(*assets.columns)


def asset_source(assets: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts with the URL to download from: the asset's own, else the post's."""
    urls = assets.select("media_id", "fetched_from_url", "status")
    return posts.select(F.col("id").alias("media_id"), "source_media_url").join(urls, "media_id", "left").select(
        "media_id", "status", asset_source_url(F.col("fetched_from_url"), F.col("source_media_url")).alias("url")
    )


def repost_clusters(assets: DataFrame, min_count: int = 2) -> DataFrame:
    """Digests shared by at least ``min_count`` posts."""
    return (
        assets.filter(F.col("sha256").isNotNull())
        .groupBy("sha256")
        .agg(F.count("*").alias("media_count"))
        .filter(F.col("media_count") >= min_count)
    )


def retryable_assets(assets: DataFrame, limit: int | None = None) -> DataFrame:
    """Assets to try again, all of them unless the caller sets a limit."""
    rows = assets.filter(F.col("status").isin(*RETRYABLE)).orderBy("media_id")
    return rows if limit is None else rows.limit(limit)


def retention_expired(assets: DataFrame, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Keys below ``media/`` whose object is older than the retention. An object lives as long
    as its newest write."""
    objects = assets.filter(F.col("storage_key").startswith("media/")).groupBy("storage_key").agg(
        F.max("stored_at").alias("stored_at")
    )
    return objects.filter(F.col("stored_at") < now - F.expr(f"INTERVAL {days} DAYS"))


def storage_daily(assets: DataFrame) -> DataFrame:
    """Objects and bytes written per day; each object counts on the day of its first write."""
    objects = assets.filter(F.col("stored_at").isNotNull()).groupBy("storage_key").agg(
        F.min("stored_at").alias("stored_at"), F.max("size_bytes").alias("size_bytes")
    )
    return objects.groupBy(F.to_date("stored_at").alias("day")).agg(
        F.count("*").alias("objects"), F.sum("size_bytes").alias("bytes")
    )

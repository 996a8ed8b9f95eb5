"""Rebuilding curated tables from the raw layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.history import change_history, latest_history
from postlake.operators.posts import upsert_posts
from postlake.operators.validate import observations_of
from postlake.session import staged


@dataclass
class Rebuilt:
    posts: DataFrame
    new_history: DataFrame


def rebuild_all(data_points: DataFrame, width: str = "day") -> Rebuilt:
    """Both tables from all raw rows in their original order."""
    observations = observations_of(data_points)
    return Rebuilt(upsert_posts(observations, width=width), change_history(observations, width=width))


def replay_run(
    data_points: DataFrame, sync_run_id: str, now: Column, posts: DataFrame, history: DataFrame, width: str = "day"
) -> Rebuilt:
    """Apply one run's raw rows again, as of ``now``.

    This is a new batch with an old run id: its values become the current ones even when newer
    runs exist, and a history row is added only for posts that have none from this run. Items
    keep the rank they were landed with. No asset rows are touched.
    """
    run = data_points.filter(F.col("sync_run_id") == sync_run_id).withColumn("fetched_at", now)
    # Stored: flags and fold read them several times, and below them lie all raw rows and the whole history.
    observations = staged(observations_of(run), "replayed")
    touched = observations.select("ig_media_id").distinct()
    known = staged(history.join(touched, "ig_media_id", "left_semi"), "known")
    pairs = known.filter(F.col("sync_run_id") == sync_run_id).select("ig_media_id", "sync_run_id")
    return Rebuilt(
        upsert_posts(observations, posts, width),
        change_history(observations, latest_history(known), pairs, width),
    )

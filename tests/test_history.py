"""History and post upsert against the row-by-row model, on random overlapping runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from model import Store, arrival, random_observations
from postlake.operators import assets, history, posts, runs
from postlake.schemas import OBSERVATION

NAIVE = ("fetched_at", "taken_at", "first_seen_at", "last_seen_at", "content_updated_at", "captured_at")


def frame(spark, rows):
    zone = dt.timezone.utc
    data = [
        tuple(row[n].replace(tzinfo=zone) if n in NAIVE else row[n] for n in OBSERVATION.names) for row in rows
    ]
    return spark.createDataFrame(data, OBSERVATION)


def plain(row, names):
    out = []
    for name in names:
        value = row[name]
        out.append(tuple(value) if isinstance(value, list) else value)
    return tuple(out)


def texts(df, names):
    """Timestamps as text, so that the comparison does not depend on the machine's zone."""
    kinds = dict(df.dtypes)
    columns = [F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) if kinds[n] == "timestamp" else F.col(n) for n in names]
    return sorted((plain(r, names) for r in df.select(*columns).collect()), key=repr)


def expected(rows, names):
    def show(value):
        return value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else value

    return sorted((plain({n: show(r[n]) for n in names}, names) for r in rows), key=repr)


HISTORY = ("ig_media_id", "sync_run_id", "hashtag_id", "source", "position_overall", "like_count", "comments_count",
           "rank", "caption", "permalink", "media_type", "changed_fields")
POST = ("ig_media_id", "hashtag_id", "media_type", "permalink", "taken_at", "first_seen_at", "last_seen_at", "first_seen_via",
        "content_updated_at", "best_top_rank", "seen_in_top", "seen_in_recent", "caption", "source_media_url",
        "like_count", "comments_count", "is_stale")


def model_posts(store):
    return [{"ig_media_id": key, **post} for key, post in store.posts.items()]


@pytest.mark.parametrize("seed", range(5))
def test_fold_matches_the_model(spark, seed):
    rows = random_observations(seed)
    store = Store().apply_all(rows)
    seen = frame(spark, rows)
    width = ["hour", "day", "month"][seed % 3]
    assert texts(history.change_history(seen, width=width), HISTORY) == expected(store.history, HISTORY)
    assert texts(posts.upsert_posts(seen, width=width), POST) == expected(model_posts(store), POST)
    flags = history.observation_flags(seen).collect()
    assert {(f.sync_run_id, f.position_overall): (f.is_new, f.content_changed) for f in flags} == store.flags


@pytest.mark.parametrize("seed", [11, 12])
def test_batches_in_order_equal_one_rebuild(spark, seed):
    rows = sorted(random_observations(seed), key=arrival)
    third = len(rows) // 3
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    store = Store().apply_all(rows)
    state = log = None
    for part in parts:
        seen = frame(spark, part)
        if state is None:
            state, log = posts.upsert_posts(seen), history.change_history(seen)
        else:
            fresh = history.change_history(seen, history.latest_history(log), log.select("ig_media_id", "sync_run_id"))
            state, log = posts.upsert_posts(seen, state), log.unionByName(fresh)
        state, log = state.checkpoint(), log.checkpoint()
    assert texts(log, HISTORY) == expected(store.history, HISTORY)
    assert texts(state, POST) == expected(model_posts(store), POST)


def test_run_counters_match_the_model(spark):
    rows = random_observations(21)
    store = Store().apply_all(rows)
    got = {r.sync_run_id: r for r in runs.run_counters(frame(spark, rows), F.col("position_overall")).collect()}
    for run in {r["sync_run_id"] for r in rows}:
        mine = [store.flags[k] for k in store.flags if k[0] == run]
        assert got[run].items_seen == len(mine)
        assert got[run].items_new == sum(new for new, _ in mine)
        assert got[run].items_updated == sum(changed for _, changed in mine)
        assert got[run].metrics_recorded == sum(h["sync_run_id"] == run for h in store.history)
        assert got[run].asset_jobs_enqueued == store.enqueued.get(run, 0)


def test_pending_assets_match_the_model(spark):
    rows = random_observations(22)
    store = Store().apply_all(rows)
    made = assets.ensure_pending(frame(spark, rows))
    got = sorted((r.status, r.fetched_from_url or "") for r in made.collect())
    assert got == sorted((a["status"], a["url"] or "") for a in store.assets.values())


def one_post(spark, steps):
    """steps: (hour, run, source, caption, likes)"""
    rows = [
        {
            "ig_media_id": "m", "hashtag_id": "h", "sync_run_id": run, "source": source, "position_overall": n,
            "fetched_at": dt.datetime(2024, 3, 1) + dt.timedelta(hours=hour), "media_type": "IMAGE", "caption": caption,
            "permalink": "https://e.com/1", "media_url": None, "taken_at": dt.datetime(2024, 3, 1),
            "like_count": likes, "comments_count": None,
        }
        for n, (hour, run, source, caption, likes) in enumerate(steps)
    ]
    return [(r.sync_run_id, r.position_overall, r.changed_fields) for r in
            history.change_history(frame(spark, rows)).orderBy("captured_at", "position_overall").collect()]


ALL = ["likeCount", "commentsCount", "rank", "caption", "permalink", "mediaType"]


def test_second_difference_in_a_run_is_dropped(spark):
    got = one_post(spark, [(0, "a", "recent", "x", 1), (1, "a", "recent", "y", 1), (30, "b", "recent", "x", 1)])
    assert got == [("a", 0, ALL)]


def test_later_difference_counts_when_the_run_began_unchanged(spark):
    got = one_post(spark, [(0, "a", "recent", "x", 1), (30, "b", "recent", "x", 1), (60, "b", "recent", "y", 1)])
    assert got == [("a", 0, ALL), ("b", 2, ["caption"])]


def test_alternating_edges_write_every_time(spark):
    got = one_post(spark, [(0, "a", "top", "x", 1), (30, "b", "recent", "x", 1), (60, "c", "top", "x", 1)])
    assert [changed for _, _, changed in got] == [ALL, ["rank"], ["rank"]]


def test_caption_back_and_forth(spark):
    got = one_post(spark, [(0, "a", "recent", "A", 1), (30, "b", "recent", "B", 1), (60, "c", "recent", "A", None)])
    assert [changed for _, _, changed in got] == [ALL, ["caption"], ["likeCount", "caption"]]


def test_a_replay_stores_what_it_reads_again(spark, monkeypatch):
    from postlake.operators import replay

    labels, stored = [], replay.staged
    monkeypatch.setattr(replay, "staged", lambda df, label: labels.append(label) or stored(df, label))
    raw = spark.createDataFrame(
        [("r1", "h1", "top", 0, "2026-01-01 00:00:00", '{"id":"x","media_type":"IMAGE","permalink":"https://e.com/x","timestamp":"2026-01-02T03:04:05+0000"}')],
        "sync_run_id string, hashtag_id string, source string, position_overall int, fetched_at string, payload string",
    ).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    built = replay.rebuild_all(raw)
    again = replay.replay_run(raw, "r1", F.lit("2026-02-01 00:00:00").cast("timestamp"), built.posts, built.new_history)
    assert labels == ["replayed", "known"] and again.posts.count() == 1 and again.new_history.count() == 0


def test_columns_of_the_fold_become_plain_values():
    import pyarrow as pa

    for column in (pa.array([3, None]), pa.array([3, 4]), pa.array(["a", None])):
        assert history._plain(column) == column.to_pylist() and type(history._plain(column)[0]) is type(column.to_pylist()[0])

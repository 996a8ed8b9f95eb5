"""Streams end in the same tables as the batch jobs, also across a restart and a repeated batch."""

import json
import os
import random

import pandas as pd
from pyspark.sql import functions as F

from model import Store, random_observations
from postlake.operators import replay
from postlake.session import clear_scratch, shared_dir
from postlake.schemas import TRACKED_COLUMNS
from postlake.sources import bronze, tables
from postlake.streaming import history as SH
from postlake.streaming import ingest
from test_history import HISTORY, POST, expected, frame, model_posts, texts


def pages_of(rows, size=3):
    """Rows of a run as page responses of a few items; a page's rows share its fetch time."""
    by_run = {}
    for row in sorted(rows, key=lambda r: (r["fetched_at"], r["sync_run_id"], r["position_overall"])):
        by_run.setdefault(row["sync_run_id"], []).append(row)
    pages, landed = [], []
    for run, items in by_run.items():
        for n in range(0, len(items), size):
            part = items[n : n + size]
            at = part[-1]["fetched_at"]
            data = []
            for k, row in enumerate(part):
                kept = {**row, "fetched_at": at, "position_overall": n + k, "hashtag_id": part[0]["hashtag_id"], "source": items[0]["source"]}
                kept["taken_at"] = row["taken_at"].replace(microsecond=0)
                landed.append(kept)
                doc = {"id": row["ig_media_id"], "media_type": row["media_type"], "permalink": row["permalink"],
                       "timestamp": kept["taken_at"].strftime("%Y-%m-%dT%H:%M:%S+0000")}
                doc |= {f: row[f] for f in ("caption", "media_url", "like_count", "comments_count") if row[f] is not None}
                data.append(doc)
            pages.append({"sync_run_id": run, "hashtag_id": part[0]["hashtag_id"], "source": items[0]["source"], "attempt": 1 + n // 6,
                          "arrival_seq": n, "fetched_at": at.strftime("%Y-%m-%dT%H:%M:%S.000000Z"), "body": json.dumps({"data": data})})
    return pages, landed


def put(folder, name, pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in pages))


def test_ingest_resumes_and_repeats(spark, tmp_path):
    pages, landed = pages_of(random_observations(31, rows=80, runs=12))
    cut = sorted(p["fetched_at"] for p in pages)[len(pages) // 2]
    store = Store().apply_all(landed)
    lake, checkpoint = f"{tmp_path}/lake", f"{tmp_path}/checkpoint"
    put(tmp_path / "in", "a.json", [p for p in pages if p["fetched_at"] < cut])
    ingest.ingest_available(spark, f"{tmp_path}/in", lake, checkpoint)
    put(tmp_path / "in", "b.json", [p for p in pages if p["fetched_at"] >= cut])
    ingest.ingest_available(spark, f"{tmp_path}/in", lake, checkpoint)

    def state():
        return (
            texts(tables.read_state(spark, "media_posts", lake), POST),
            texts(tables.read_log(spark, "media_post_history", lake), HISTORY),
            {r.sync_run_id: r for r in ingest.run_progress(spark, lake).collect()},
        )

    posts, history, progress = state()
    assert posts == expected(model_posts(store), POST)
    assert history == expected(store.history, HISTORY)
    assert sum(r.items_seen for r in progress.values()) == len(landed)
    assert sum(r.pages_fetched for r in progress.values()) == len(pages)
    for run, row in progress.items():
        assert row.asset_jobs_enqueued == store.enqueued.get(run, 0)
        assert row.metrics_recorded == sum(h["sync_run_id"] == run for h in store.history)
    raw = tables.read_log(spark, "data_points", lake)
    assert raw.groupBy("sync_run_id").agg((F.max("position_overall") + 1).alias("n"), F.count("*").alias("c")).filter("n <> c").count() == 0

    # A crash before the commit runs the last batch again, from the pages on.
    load = max(r.load for r in raw.select("load").distinct().collect())
    assert load.endswith("-1")
    landed_again = ingest._land(bronze.read_landing(spark, f"{tmp_path}/in/b.json"), load, lake, 500)
    ingest._curate(spark, landed_again, lake)
    assert state() == (posts, history, progress)


def test_resumed_attempt_restarts_page_numbers(spark):
    body = '{"data":[{"id":"a"},{"id":"b"}]}'
    pages = [("r", "h", "top", 1, 1, body), ("r", "h", "top", 1, 2, body), ("r", "h", "top", 2, 3, body), ("r", "h", "top", 2, 4, '{"data":[')]
    df = spark.createDataFrame(pages, "sync_run_id string, hashtag_id string, source string, attempt int, arrival_seq long, body string").withColumn("fetched_at", F.current_timestamp())
    got = [(r.page_number, r.position_in_page, r.position_overall) for r in bronze.land_pages(df).orderBy("position_overall").collect()]
    assert got == [(1, 0, 0), (1, 1, 1), (2, 0, 2), (2, 1, 3), (1, 0, 4), (1, 1, 5)]


def test_stateful_history_equals_the_model(spark, tmp_path):
    rows = sorted(random_observations(32, rows=70, runs=10), key=lambda r: (r["fetched_at"], r["sync_run_id"], r["position_overall"]))
    store = Store().apply_all(rows)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SH.ROCKSDB)
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        seen = frame(spark, part)
        seen.write.mode("append").parquet(f"{tmp_path}/in")
        query = (
            SH.stream_history(spark.readStream.schema(seen.schema).parquet(f"{tmp_path}/in"))
            .writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    out = spark.read.schema(SH.OUTPUT).parquet(f"{tmp_path}/out")
    assert texts(out, HISTORY) == expected(store.history, HISTORY)


def test_messages_are_routed_once(spark, tmp_path):
    put(tmp_path / "in", "m.json", [{"message_id": "1", "body": '{"type":"DISPATCH_DUE_SYNCS","kind":"top"}'}, {"message_id": "2", "body": "{oops"}])
    stream = spark.readStream.schema("message_id string, body string").json(f"{tmp_path}/in")
    ingest.route_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    ingest.route_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    # A stream of its own replaces nothing that another one routed.
    put(tmp_path / "in2", "m.json", [{"message_id": "3", "body": '{"type":"DISPATCH_DUE_SYNCS","kind":"recent"}'}])
    ingest.route_stream(spark.readStream.schema("message_id string, body string").json(f"{tmp_path}/in2"), f"{tmp_path}/out", f"{tmp_path}/cp2")
    assert sorted(r.message_id for r in spark.read.parquet(f"{tmp_path}/out/jobs").collect()) == ["1", "3"]
    assert [r.message_id for r in spark.read.parquet(f"{tmp_path}/out/dead_letter").collect()] == ["2"]


def test_shared_folder_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_nothing_is_lost_at_ingestion(spark, tmp_path):
    good = {"id": "a", "media_type": "IMAGE", "permalink": "https://e.com/a", "timestamp": "2026-01-02T03:04:05.678+00:00", "like_count": 3_000_000_000}
    bad = [{**good, "id": "b", "like_count": 3.0000001}, {**good, "id": "c", "permalink": "https://e xample.com/"}, {**good, "id": "d", "timestamp": "2026-01-02T03:04:05"}]
    base = {"hashtag_id": "h", "source": "top", "attempt": 1, "fetched_at": "2026-01-03T00:00:00.000000Z"}
    pages = [
        {**base, "sync_run_id": "r1", "arrival_seq": 1, "body": json.dumps({"data": [good, *bad]})}, {**base, "sync_run_id": "r1", "arrival_seq": 2, "body": '{"data":['},
        {**base, "sync_run_id": "r2", "arrival_seq": 1, "body": "<html>"}, {**base, "sync_run_id": "r3", "arrival_seq": 1, "body": json.dumps({"data": [good]})},
    ]
    put(tmp_path / "in", "a.json", pages)
    lake = f"{tmp_path}/lake"
    ingest.ingest_available(spark, f"{tmp_path}/in", lake, f"{tmp_path}/cp")
    parked = {(r.sync_run_id, r.arrival_seq): (r.body, r.reason) for r in tables.read_log(spark, "page_quarantine", lake).collect()}
    assert parked == {("r1", 2): ('{"data":[', "not JSON"), ("r2", 1): ("<html>", "not JSON")}
    items = {json.loads(r.payload)["id"]: list(r.errors) for r in tables.read_log(spark, "item_quarantine", lake).collect()}
    assert items == {"b": ["like_count"], "c": ["permalink"], "d": ["timestamp"]}
    runs = {r.sync_run_id: r for r in ingest.run_progress(spark, lake).collect()}
    assert (runs["r1"].pages_fetched, runs["r1"].pages_unreadable, runs["r1"].items_seen, runs["r1"].items_invalid) == (1, 1, 1, 3)
    assert runs["r1"].failure and runs["r2"].failure and runs["r3"].failure is None
    post = tables.read_state(spark, "media_posts", lake).first()
    assert post.like_count == 3_000_000_000 and post.taken_at.microsecond == 678_000


def test_new_checkpoint_overwrites_nothing(spark, tmp_path):
    pages, landed = pages_of(random_observations(33, rows=30, runs=5))
    lake = f"{tmp_path}/lake"
    put(tmp_path / "a", "a.json", pages[: len(pages) // 2])
    ingest.land_available(spark, f"{tmp_path}/a", lake, f"{tmp_path}/cp1")
    put(tmp_path / "b", "b.json", pages[len(pages) // 2 :])
    ingest.land_available(spark, f"{tmp_path}/b", lake, f"{tmp_path}/cp2")
    assert tables.read_log(spark, "data_points", lake).count() == len(landed)


def test_late_deliveries_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("message_id string, hashtag_id string, delivered_at timestamp").json(f"{tmp_path}/in")
    put(tmp_path / "in", "a.json", [{"message_id": m, "hashtag_id": "h", "delivered_at": f"2026-05-{d:02d}T00:00:00Z"} for m, d in (("x", 9), ("y", 8), ("x", 7))])
    ingest.dedupe_available(stream, f"{tmp_path}/lake", f"{tmp_path}/cp")
    put(tmp_path / "in", "b.json", [{"message_id": m, "hashtag_id": "h", "delivered_at": "2020-01-01T00:00:00Z"} for m in ("y", "z")])
    ingest.dedupe_available(stream, f"{tmp_path}/lake", f"{tmp_path}/cp")
    rows = sorted((r.message_id, r.delivered_at.day) for r in tables.read_state(spark, "messages", f"{tmp_path}/lake").collect())
    assert [m for m, _ in rows] == ["x", "y", "z"] and rows[0][1] == 7


def test_scratch_is_cleared_by_its_owner(spark, tmp_path):
    pages, _ = pages_of(random_observations(34, rows=20, runs=4))
    put(tmp_path / "in", "a.json", pages)
    clear_scratch(spark)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    built = replay.rebuild_all(bronze.land_pages(bronze.read_landing(spark, f"{tmp_path}/in")))
    assert built.posts.count() and built.new_history.count()
    assert set(os.listdir(shared)) > before
    clear_scratch(spark)
    assert set(os.listdir(shared)) == before


def test_only_runs_at_hand_are_read_from_the_state():
    asked = []

    class Value:
        def get(self):
            return tuple(["old"] * 6)

        def update(self, value):
            pass

    class Runs:
        def containsKey(self, key):
            asked.append(key)
            return key == ("r1",)

        def updateValue(self, key, value):
            assert key == ("r2",)

    state = SH.RecordChanges()
    state.last, state.runs = Value(), Runs()
    row = {c: [None] * 4 for c in [*SH._INPUT, *[f"digest_{c}" for c in TRACKED_COLUMNS]]}
    row |= {"sync_run_id": ["r1", "r1", "r2", "r2"], "fetched_at": pd.to_datetime(["2026-01-01"] * 4), "position_overall": [0, 1, 0, 1]}
    out = list(state.handleInputRows(("p",), iter([pd.DataFrame(row)]), None))
    assert asked == [("r1",), ("r2",)] and out[0]["sync_run_id"].tolist() == ["r2"]


class CountedMap:
    """A map state that counts its calls and the entries read."""

    def __init__(self):
        self.stored, self.calls, self.read = {}, 0, 0

    def getValue(self, key):
        self.calls += 1
        value = self.stored.get(key)
        self.read += len(value[0]) if value else 0
        return value

    def containsKey(self, key):
        self.calls += 1
        return key in self.stored

    def updateValue(self, key, value):
        self.calls += 1
        self.stored[key] = value


class CountedHandle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, CountedMap())

    getValueState = getMapState

    def spent(self):
        spent = sum(s.calls for s in self.states.values()), sum(s.read for s in self.states.values())
        for state in self.states.values():
            state.calls = state.read = 0
        return spent


def fed(processor, rows):
    """What the processor records of (post, time, run, state) rows."""
    post, at, run, state = map(list, zip(*rows))
    columns = {c: state for c in [*SH._INPUT, *[f"digest_{c}" for c in TRACKED_COLUMNS]]}
    columns |= {"post": post, "fetched_at": at, "sync_run_id": run, "position_overall": [0] * len(rows), "observation": list(map(repr, rows))}
    return [text for out in processor.handleInputRows((0,), iter([pd.DataFrame(columns)]), None) for text in out["observation"]]


def folded(rows, last, done):
    kept = []
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        post, _, run, state = row
        if state != last.get(post) and (post, run) not in done:
            last[post] = state
            done.add((post, run))
            kept.append(repr(row))
    return kept


def test_posts_of_a_group_share_state_calls():
    draw = random.Random(7)
    handle, processor = CountedHandle(), SH.RecordChanges()
    processor.init(handle)
    last, done = {}, set()
    for batch in range(4):
        # Half of the runs go on from the batch before.
        rows = [(f"m{draw.randrange(20)}", batch * 1000 + n, f"r{batch * 5 + draw.randrange(10)}", draw.randrange(3)) for n in range(600)]
        assert fed(processor, rows) == folded(rows, last, done)
        # 20 posts with 200 runs at hand: before, a call for each of them or two.
        assert handle.spent()[0] <= 4


def test_what_a_run_at_hand_reads_does_not_grow():
    handle, processor = CountedHandle(), SH.RecordChanges()
    processor.init(handle)
    last, done = {}, set()
    reads = []
    for batch in range(40):
        rows = [("m1", batch * 1000 + n, f"r{batch}-{n}", n) for n in range(200)]
        assert fed(processor, rows) == folded(rows, last, done)
        handle.spent()
        again = [("m1", batch * 1000 + 999, f"r{batch}-7", -1 - batch)]
        assert fed(processor, again) == folded(again, last, done) == []
        reads.append(handle.spent())
    assert max(calls for calls, _ in reads) <= 4 and max(read for _, read in reads) < 2 * SH.PAGE + 2
    assert len(handle.states["runs"].stored) > 8


def files_of(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def posts_frame(spark, keys, likes):
    return spark.createDataFrame([(k, k, likes) for k in keys], "id string, ig_media_id string, like_count long")


def test_a_load_reads_and_writes_its_buckets_only(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    tables.merge_state(posts_frame(spark, [f"p{n}" for n in range(400)], 1), "media_posts", lake, "l0")
    one = posts_frame(spark, ["p7"], 2)
    bucket = one.select(tables._bucket("media_posts", F.col("ig_media_id"))).first()[0]
    here, sizes, before = f"{lake}/media_posts/bucket={bucket}/", [], files_of(f"{lake}/media_posts")
    for n in range(10):
        tables.merge_state(posts_frame(spark, ["p7"], 2 + n), "media_posts", lake, f"l{n + 1}")
        after = files_of(f"{lake}/media_posts")
        sizes.append(sum(os.path.getsize(f) for f in after if f.startswith(here)))
        # Files of other buckets keep their names and times.
        assert {f: t for f, t in after.items() if not f.startswith(here)} == {f: t for f, t in before.items() if not f.startswith(here)}
    # What a load reads does not grow with the loads before it.
    assert max(sizes) - min(sizes) < 600
    plan = tables._folders_of(tables.state_rows(spark, "media_posts", lake), "media_posts", one, None)._jdf.queryExecution().toString()
    assert f"PartitionFilters: [isnotnull(bucket#" in plan and f"= {bucket})" in plan
    rows = {r.ig_media_id: r.like_count for r in tables.read_state(spark, "media_posts", lake).collect()}
    assert len(rows) == 400 and rows.pop("p7") == 11 and set(rows.values()) == {1}


def test_a_repeated_load_starts_from_the_rows_before_it(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    tables.merge_state(posts_frame(spark, ["a", "b"], 1), "media_posts", lake, "l0")
    for _ in range(3):
        keys = posts_frame(spark, ["a", "c"], 0)
        before = {r.ig_media_id: r.like_count for r in tables.state_before(spark, "media_posts", lake, keys, "l1").collect()}
        assert before == {"a": 1}
        tables.merge_state(posts_frame(spark, ["a", "c"], 2), "media_posts", lake, "l1")
    assert {r.ig_media_id: r.like_count for r in tables.read_state(spark, "media_posts", lake).collect()} == {"a": 2, "b": 1, "c": 2}


def page(run, seq, day, n=1, goes_on=True, body=None, **more):
    data = [{"id": f"{run}-{seq}-{k}", "media_type": "IMAGE", "permalink": "https://e.com/p", "timestamp": "2026-01-02T03:04:05+0000"} for k in range(n)]
    paging = {"cursors": {"after": f"c{seq}"}, **({"next": "https://e.com/n"} if goes_on else {})}
    return {"sync_run_id": run, "hashtag_id": "h", "source": "top", "attempt": 1, "arrival_seq": seq, "fetched_at": f"2026-01-{day:02d}T00:00:0{seq % 10}.000000Z",
            "body": body or json.dumps({"data": data, "paging": paging}), **more}


def test_runs_are_started_advanced_and_finished(spark, tmp_path):
    lake, arrivals = f"{tmp_path}/lake", [
        [page("a", 1, 2, 3, app_usage='{"call_count":12}'), page("b", 1, 2, body="oops"), page("c", 1, 2, 4)],
        [page("a", 2, 3, 2, app_usage='{"call_count":40}'), page("b", 2, 3, goes_on=False), page("d", 1, 3, goes_on=False, body='{"data":[')],
        [page("a", 3, 4, 1, goes_on=False, attempt=2), page("c", 2, 4, 5)],
    ]
    for n, pages in enumerate(arrivals):
        put(tmp_path / "in", f"{n}.json", [{**p, **({"attempt": 2} if p["sync_run_id"] == "a" and n == 2 else {})} for p in pages])
        ingest.ingest_available(spark, f"{tmp_path}/in", lake, f"{tmp_path}/cp", item_cap=9)
    runs = {r.id: r for r in tables.read_state(spark, "sync_runs", lake).collect()}
    a, b, c, d = (runs[k] for k in "abcd")
    assert (a.status, a.pages_fetched, a.items_seen, a.items_new, a.attempts, a.last_cursor, a.hit_item_cap) == ("succeeded", 3, 6, 6, 2, "c2", 0)
    assert json.loads(a.rate_limit_snapshot)["worst_pct"] == 40 and a.duration_ms == 2 * 86_400_000 + 2_000
    assert (b.status, b.error, b.pages_unreadable) == ("partial", "1 unreadable page(s)", 1)
    # The source stops at the cap, whatever page comes next.
    assert (c.status, c.hit_item_cap, c.items_seen, c.last_cursor) == ("succeeded", 1, 9, "c2")
    assert (d.status, d.pages_fetched, d.finished_at, d.pages_unreadable) == ("running", 0, None, 1)
    raw = ingest.stored_run_scan(spark, lake, "a").select("page_number", "position_overall").collect()
    assert [tuple(r) for r in raw] == [(1, 0), (1, 1), (1, 2), (2, 3), (2, 4), (1, 5)]
    plan = ingest.stored_run_scan(spark, lake, "a")._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan


def test_runs_of_long_ago_are_forgotten(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    for n, pages in enumerate([[page("a", 1, 1, 3), page("b", 1, 1, 3)], [page("a", 2, 1 + ingest.RUN_DAYS, 1)], [page("b", 2, 3 + ingest.RUN_DAYS, 1)]]):
        put(tmp_path / "in", f"{n}.json", pages)
        ingest.land_available(spark, f"{tmp_path}/in", lake, f"{tmp_path}/cp")
    raw = {(r.sync_run_id, r.fetched_at.day): r.position_overall for r in tables.read_log(spark, "data_points", lake).orderBy("position_overall").collect()}
    assert raw[("a", 1 + ingest.RUN_DAYS)] == 3 and raw[("b", 3 + ingest.RUN_DAYS)] == 0


def test_a_stored_replay_repeats_without_effect(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    first = {"id": "x", "media_type": "IMAGE", "permalink": "https://e.com/x", "timestamp": "2026-01-02T03:04:05+0000"}
    bodies = [("r1", 2, {**first, "like_count": 1}), ("r2", 3, {**first, "like_count": 2}), ("r3", 4, {**first, "like_count": 2})]
    put(tmp_path / "in", "a.json", [page(run, 1, day, body=json.dumps({"data": [doc]})) for run, day, doc in bodies])
    ingest.ingest_available(spark, f"{tmp_path}/in", lake, f"{tmp_path}/cp")

    def state():
        history = tables.read_log(spark, "media_post_history", lake).orderBy("captured_at").collect()
        return [(r.sync_run_id, r.like_count, r.rank) for r in history], tables.read_state(spark, "media_posts", lake).first().like_count

    assert state() == ([("r1", 1, 1), ("r2", 2, 1)], 2)
    # Run r1 has recorded the post, so its value becomes the current one without a history row.
    for _ in range(2):
        ingest.replay_stored(spark, lake, "r1", F.lit("2026-02-01 00:00:00").cast("timestamp"))
        assert state() == ([("r1", 1, 1), ("r2", 2, 1)], 1)
    # Run r3 changed nothing in its time and has no row, so nothing changes now either.
    for _ in range(2):
        ingest.replay_stored(spark, lake, "r3", F.lit("2026-02-02 00:00:00").cast("timestamp"))
        assert state() == ([("r1", 1, 1), ("r2", 2, 1)], 2)


def test_messages_are_parked_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lake, stream = f"{tmp_path}/lake", spark.readStream.schema("message_id string, delivered_at timestamp").json(f"{tmp_path}/in")
    for n, times in enumerate([{"a": [1, 2], "b": [1, 2, 3, 4, 5]}, {"a": [6, 7, 8], "b": [9], "c": [9]}, {"a": [10]}]):
        put(tmp_path / "in", f"{n}.json", [{"message_id": m, "delivered_at": f"2026-05-01T00:00:{t:02d}Z"} for m, at in times.items() for t in at])
        ingest.park_available(stream, lake, f"{tmp_path}/cp")
    parked = sorted((r.message_id, r.deliveries, r.parked_at.second) for r in tables.read_log(spark, "parked", lake).collect())
    assert parked == [("a", 4, 7), ("b", 4, 4)]


def test_runs_of_a_source_without_a_cap_go_on(spark, tmp_path):
    put(tmp_path / "in", "a.json", [page("a", 1, 2, 600), page("b", 1, 2, 600, goes_on=False)])
    ingest.land_available(spark, f"{tmp_path}/in", f"{tmp_path}/lake", f"{tmp_path}/cp", item_cap=None)
    runs = {r.id: (r.status, r.hit_item_cap, r.items_landed) for r in tables.read_state(spark, "sync_runs", f"{tmp_path}/lake").collect()}
    assert runs == {"a": ("running", 0, 600), "b": ("succeeded", 0, 600)}


def test_a_merge_moves_its_rows_once(spark, tmp_path, monkeypatch):
    plans, write = [], tables._write_folders

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args)

    monkeypatch.setattr(tables, "_write_folders", noted)
    for load, (low, high) in (("one", (0, 40)), ("two", (20, 60)), ("two", (20, 60))):
        rows = spark.range(low, high).select(F.concat(F.lit("m"), "id").alias("message_id"), F.lit(load).alias("hashtag_id"))
        tables.merge_state(rows, "messages", str(tmp_path), load)
    assert all(plan.count("Exchange ") == 1 and "Join" not in plan for plan in plans)
    kept = {r.message_id: (r.hashtag_id, r.load, r.prior and r.prior.hashtag_id) for r in tables.state_rows(spark, "messages", str(tmp_path)).collect()}
    assert len(kept) == 60 and kept["m1"] == ("one", "one", None) and kept["m30"] == ("two", "two", "one") and kept["m50"] == ("two", "two", None)


def test_bodies_are_parsed_once(spark, tmp_path, monkeypatch):
    seen = []
    for name in ("page_heads", "land_pages", "unreadable_pages"):
        step = getattr(ingest, name)
        monkeypatch.setattr(ingest, name, lambda pages, *more, step=step: seen.append(pages) or step(pages, *more))
    put(tmp_path / "in", "a.json", [page("a", 1, 2, 3), page("a", 2, 2, body="oops")])
    ingest.land_available(spark, f"{tmp_path}/in", f"{tmp_path}/lake", f"{tmp_path}/cp")
    assert len(seen) == 3 and all("items" in pages.columns for pages in seen)
    lost = tables.read_log(spark, "page_quarantine", f"{tmp_path}/lake").collect()
    assert [(r.body, r.reason) for r in lost] == [("oops", "not JSON")]

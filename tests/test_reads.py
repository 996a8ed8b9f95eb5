"""Time-line operators, the read query, and the tag and asset state changes."""

import datetime as dt
import json
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from postlake.functions import scalars as fn
from postlake.operators import assets as A
from postlake.operators import listing as L
from postlake.operators import reports as R
from postlake.operators import runs as RN
from postlake.operators import tags as TG
from postlake.operators import timeline as TL
from postlake.plans import catalog
from postlake.session import clear_scratch

UTC = dt.timezone.utc
DAY0 = dt.datetime(2024, 1, 1, tzinfo=UTC)


def random_rows(seed, rows=300):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(6)}", DAY0 + dt.timedelta(hours=rng.randrange(400)), n, rng.randrange(9))
        for n in range(rows)
    ]


@pytest.mark.parametrize("width", ["hour", "day", "month"])
def test_carry_is_lag_and_first(spark, width):
    rows = random_rows(1)
    df = spark.createDataFrame(rows, "k string, at timestamp, n int, v int")
    got = {r.n: (r.prev.v if r.prev else None, r["head"].v) for r in TL.carry(df, ["k"], ["at", "n"], ["v"], ["v"], width).collect()}
    want, last, first = {}, {}, {}
    for k, at, n, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want[n] = (last.get(k), first.setdefault(k, v))
        last[k] = v
    assert got == want


def test_running_total_counts_ties(spark):
    rows = random_rows(2)
    df = spark.createDataFrame(rows, "k string, at timestamp, n int, v int")
    got = {r.n: r.total for r in TL.running_total(df, "at", "v", "total").collect()}
    assert got == {n: sum(w for _, t, _, w in rows if t <= at) for _, at, n, _ in rows}


def test_segments_keep_straddling_groups_together(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(2)}", f"g{rng.randrange(30)}", DAY0 + dt.timedelta(hours=rng.randrange(500))) for _ in range(60)]
    df = spark.createDataFrame(rows, "k string, g string, at timestamp")
    out = TL.closed_segments(df, "k", "g", "at").collect()
    by_group = {}
    for r in out:
        by_group.setdefault((r.k, r.g), set()).add(r.segment)
    assert len(out) == len(rows) and all(len(s) == 1 for s in by_group.values())
    for k in {r.k for r in out}:
        mine = sorted((r.at, r.segment) for r in out if r.k == k)
        assert [s for _, s in mine] == sorted(s for _, s in mine)


def listing(spark):
    rng = random.Random(4)
    posts = [
        (f"00000000-0000-4000-8000-{n:012d}", f"h{n % 3}", rng.choice(["IMAGE", "VIDEO"]), DAY0 + dt.timedelta(days=rng.randrange(6)), n % 4 == 0)
        for n in range(40)
    ]
    df = spark.createDataFrame(posts, "id string, hashtag_id string, media_type string, taken_at timestamp, is_stale boolean")
    none = {c: F.lit(None).cast("string") for c in (
        "ig_media_id", "caption", "permalink", "like_count", "comments_count", "best_top_rank", "seen_in_top",
        "seen_in_recent", "first_seen_at", "last_seen_at", "content_updated_at")}
    df = df.withColumns(none | {"caption_hashtags": F.array().cast("array<string>"), "caption_mentions": F.array().cast("array<string>")})
    tags = spark.createDataFrame([("h0", "matcha"), ("h1", "kyoto"), ("h2", "wagashi")], "id string, name string")
    files = spark.createDataFrame([(posts[1][0], "stored", "media/k", "s", 3, "image/png"), (posts[2][0], "failed", None, None, None, None)],
                                  "media_id string, status string, storage_key string, sha256 string, size_bytes long, content_type string")
    return df, tags, files, posts


def test_pages_neither_skip_nor_repeat(spark):
    df, tags, files, posts = listing(spark)
    want = [p[0] for p in sorted(posts, key=lambda p: (p[3], p[0]), reverse=True)]
    seen, cursor, pages = [], None, 0
    while True:
        page = L.list_media(df, tags, files, L.ListArgs(limit=7, cursor=cursor)).collect()
        seen += [r.id for r in page]
        pages += 1
        cursor = page[-1].next_cursor
        assert page[0].has_more == (cursor is not None)
        if cursor is None:
            break
    assert pages == 6 and seen == want
    walk = sorted(L.paging_walk(df, tags, L.ListArgs(limit=7)).collect(), key=lambda r: r.place)
    assert [r.id for r in walk] == want and walk[-1].page == 6


def test_filters_count_and_documents(spark):
    df, tags, files, posts = listing(spark)
    args = L.ListArgs(hashtag="#Matcha", media_type="IMAGE", include_stale=False, taken_after=DAY0 + dt.timedelta(days=1), taken_before=DAY0 + dt.timedelta(days=3))
    base = [p for p in posts if p[1] == "h0" and p[2] == "IMAGE" and not p[4]]
    dated = {p[0] for p in base if 1 <= (p[3] - DAY0).days <= 3}
    assert {r.id for r in L.filtered(df, tags, args).collect()} == dated
    # The total ignores the date bounds.
    assert L.count_media(df, tags, args).first().total == len(base)
    documents = {r.id: r.document for r in L.media_document(L.list_media_projection(df, tags, files)).collect()}
    assert '"asset":{"status":"stored","storageKey":"media/k","locator":"s3://media-bucket/media/k"' in documents[posts[1][0]]
    assert documents[posts[2][0]].endswith('"asset":{"status":"failed"}}')
    assert documents[posts[3][0]].endswith('"asset":{"status":"pending"}}')


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 101}, {"limit": "abc"}, {"media_type": "GIF"}, {"hashtag": ""}, {"hashtag": "x" * 256}, {"cursor": ""}])
def test_bad_arguments(bad):
    with pytest.raises(ValueError):
        L.ListArgs(**bad)


def test_default_arguments():
    args = L.ListArgs()
    assert (args.limit, args.include_stale, args.include_asset) == (25, True, True)


def test_asof_against_brute_force(spark):
    rng = random.Random(5)
    known = [("hot" if rng.random() < 0.5 else f"p{rng.randrange(3)}", DAY0 + dt.timedelta(hours=rng.randrange(300)), f"r{n}", n) for n in range(80)]
    asked = [(n, rng.choice(["hot", "p0", "p1", "p9"]), DAY0 + dt.timedelta(hours=rng.randrange(320))) for n in range(60)]
    history = spark.createDataFrame(known, "ig_media_id string, captured_at timestamp, sync_run_id string, position_overall int").withColumns(
        {"caption": F.lit("c"), "like_count": F.col("position_overall"), "comments_count": F.lit(0), "rank": F.lit(1), "permalink": F.lit("p"), "media_type": F.lit("IMAGE")}
    )
    questions = spark.createDataFrame(asked, "n int, ig_media_id string, at timestamp")
    got = {r.n: r.like_count for r in R.asof_state(questions, history).collect()}
    for n, post, at in asked:
        before = [(t, run, pos) for p, t, run, pos in known if p == post and t <= at]
        assert got[n] == (max(before)[2] if before else None)
    moment = DAY0 + dt.timedelta(hours=150)
    states = {r.ig_media_id: r.like_count for r in R.state_at(history.withColumn("media_id", F.col("ig_media_id")), F.lit(moment)).collect()}
    for post in {k[0] for k in known}:
        before = [(t, run, pos) for p, t, run, pos in known if p == post and t <= moment]
        assert states.get(post) == (max(before)[2] if before else None)


def test_rolling_unique_tags_against_brute_force(spark):
    rng = random.Random(6)
    queries = [(f"h{rng.randrange(6)}", DAY0 + dt.timedelta(hours=12 * rng.randrange(160))) for _ in range(60)]
    runs = spark.createDataFrame(queries, "hashtag_id string, started_at timestamp")
    week = dt.timedelta(days=7)
    got = TG.rolling_unique_tags(runs, limit=3).collect()
    assert got
    for r in got:
        at = r.entered_at.astimezone(UTC) if r.entered_at.tzinfo else r.entered_at.replace(tzinfo=dt.datetime.now().astimezone().tzinfo).astimezone(UTC)
        inside = {tag for tag, t in queries if at - week <= t <= at}
        assert r.unique_tags == len(inside) and r.over_limit == (len(inside) > 3)


def test_files_with_the_same_bytes(spark):
    rows = [
        ("m1", 1, "u", False, False, "aa", "image/png"), ("m2", 2, "u", False, False, "aa", "image/png"),
        ("m3", 3, "u", False, False, "aa", "video/mp4"), ("m4", 4, None, False, False, "bb", "image/png"),
        ("m5", 5, "u", True, False, "bb", "image/png"), ("m6", 6, "u", False, True, "cc", "image/png"),
    ]
    files = spark.createDataFrame(rows, "media_id string, arrival int, url string, already_stored boolean, fetch_fails boolean, sha256 string, content_type string")
    got = {r.media_id: r.outcome for r in A.download_outcome(files).collect()}
    assert got == {"m1": "stored", "m2": "deduplicated", "m3": "stored", "m4": "skipped", "m5": "skipped", "m6": "failed"}
    # Two content types are two objects, but one cluster of reposts.
    assert [(r.sha256, r.media_count) for r in A.repost_clusters(files).filter("sha256 = 'aa'").collect()] == [("aa", 3)]
    known = spark.createDataFrame([("media/aa//aa.png",)], "storage_key string")
    again = {r.media_id: r.outcome for r in A.download_outcome(files, known).collect()}
    assert again["m1"] == "deduplicated" and again["m3"] == "stored"


def test_skipped_stays_skipped(spark):
    at = DAY0
    seen = spark.createDataFrame(
        [("p", None, at, "r1", 0), ("p", "https://u", at + dt.timedelta(days=1), "r2", 0), ("q", "https://u", at, "r1", 1), ("q", None, at + dt.timedelta(days=1), "r2", 1)],
        "ig_media_id string, media_url string, fetched_at timestamp, sync_run_id string, position_overall int",
    )
    got = sorted((r.status, r.fetched_from_url, r.enqueue) for r in A.ensure_pending(seen).collect())
    assert got == [("pending", None, False), ("skipped", "https://u", False)]


def test_run_that_ends_at_the_cap_is_flagged(spark):
    items = [("a", "h", n) for n in range(3)] + [("b", "h", n) for n in range(2)] + [("c", "h", n) for n in range(5)]
    df = spark.createDataFrame(items, "sync_run_id string, hashtag_id string, position_overall int")
    tags = spark.createDataFrame([("h", 3)], "id string, max_media_per_sync int")
    got = {r.sync_run_id: (r.items_kept, r.hit_item_cap) for r in RN.run_item_cap(df, tags).collect()}
    assert got == {"a": (3, 1), "b": (2, 0), "c": (3, 1)}


def test_health_counts_failures_since_success(spark):
    def at(h):
        return DAY0 + dt.timedelta(hours=h)

    ends = spark.createDataFrame(
        [("h1", "top", at(1), "r1", "boom"), ("h1", "top", at(2), "r2", None), ("h1", "recent", at(3), "r3", "late"), ("h2", "top", at(1), "r4", "x" * 3000), ("h3", "recent", at(1), "r5", None)],
        "hashtag_id string, source string, at timestamp, run_id string, failure string",
    )
    none = F.lit(None)
    tags = spark.createDataFrame([("h1", 5, "old"), ("h2", 5, "old"), ("h3", 5, "old"), ("h4", 5, "old")], "id string, consecutive_failures int, last_sync_error string").withColumns(
        {"last_top_synced_at": none.cast("timestamp"), "last_recent_synced_at": none.cast("timestamp"), "updated_at": none.cast("timestamp")}
    )
    got = {r.id: (r.consecutive_failures, r.last_sync_error) for r in TG.sync_health(tags, ends).collect()}
    assert got == {"h1": (1, "late"), "h2": (6, "x" * 2000), "h3": (0, None), "h4": (5, "old")}


def test_runs_over_midnight_do_not_tie_the_days_together(spark):
    night = dt.datetime(2026, 3, 1, 23, 58, tzinfo=UTC)
    rows = [("m1", f"r{d}", night + dt.timedelta(days=d, minutes=m)) for d in range(10) for m in (0, 3, 5)]
    # A run inside the night's run goes with it; one that starts a second later does not.
    rows += [("m1", "inner", night + dt.timedelta(days=4, minutes=4)), ("m1", "next", night + dt.timedelta(days=4, minutes=5, seconds=1))]
    out = TL.closed_segments(spark.createDataFrame(rows, "k string, g string, at timestamp"), "k", "g", "at").collect()
    found = {}
    for r in out:
        found.setdefault(r.g, set()).add(r.segment)
    assert all(len(s) == 1 for s in found.values()) and len(out) == len(rows)
    assert len({min(s) for g, s in found.items() if g[0] == "r"}) == 10
    assert found["inner"] == found["r4"] and found["next"] == found["r5"]


def test_run_of_several_days_is_one_segment(spark):
    day = dt.timedelta(days=1)
    rows = [("m1", "long", DAY0), ("m1", "long", DAY0 + 4 * day), ("m1", "a", DAY0 + 2 * day), ("m1", "b", DAY0 + 4 * day + dt.timedelta(hours=1)), ("m1", "c", DAY0 + 4 * day - dt.timedelta(hours=1))]
    out = {r.g: r.segment for r in TL.closed_segments(spark.createDataFrame(rows, "k string, g string, at timestamp"), "k", "g", "at").collect()}
    assert out["long"] == out["a"] == out["c"] != out["b"]


@pytest.mark.parametrize("token", ["!!", "bm90IGpzb24", "eyJpZCI6MX0", "W10", "eyJ0YWtlbkF0IjoibmV2ZXIiLCJpZCI6IjAwMDAwMDAwLTAwMDAtNDAwMC04MDAwLTAwMDAwMDAwMDAwMSJ9"])
def test_broken_cursors_are_refused(token):
    with pytest.raises(ValueError, match="cursor"):
        L.ListArgs(cursor=token)


def test_page_document_and_asset_scan(spark):
    posts, tags, files, _ = listing(spark)
    first = json.loads(L.page_document(posts, tags, files, L.ListArgs(limit=7)).first()[0])
    assert list(first) == ["limit", "count", "total", "hasMore", "nextCursor"] and (first["count"], first["total"], first["hasMore"]) == (7, 40, True)
    none = json.loads(L.page_document(posts, tags, files, L.ListArgs(hashtag="kyoto", taken_after=dt.datetime(2200, 1, 1))).first()[0])
    assert none["count"] == 0 and none["total"] > 0 and none["hasMore"] is False and none["nextCursor"] is None


def test_redelivered_message_starts_another_run(spark):
    jobs = "type string, hashtag_id string, message_id string, attempt int, at timestamp"
    runs = spark.createDataFrame([("old", "T", "h1", "partial", "m", DAY0, 3, 40, "c9"), ("open", "T", "h2", "running", "n", DAY0, 1, 12, "c2")],
                                 "id string, type string, hashtag_id string, status string, triggered_by_message_id string, started_at timestamp, attempts int, items_seen int, last_cursor string")
    def start(at, attempt):
        rows = spark.createDataFrame([("T", "h1", "m", attempt, at), ("T", "h2", "x", 1, at)], jobs)
        return {r.hashtag_id: r for r in RN.start_runs(rows, runs).collect()}
    one, two = start(DAY0, 1), start(DAY0 + dt.timedelta(days=1), 2)
    assert one["h1"].id != two["h1"].id and one["h1"].id == start(DAY0, 1)["h1"].id and two["h1"].attempts == 2
    assert (one["h2"].id, one["h2"].attempts, one["h2"].items_seen, one["h2"].last_cursor) == ("open", 2, 12, "c2")


def test_sixty_day_run_has_a_duration(spark):
    row = spark.createDataFrame([(DAY0, DAY0 + dt.timedelta(days=60))], "a timestamp, b timestamp")
    assert row.select(fn.duration_ms(F.col("a"), F.col("b"))).first()[0] == 60 * 86_400_000


def test_quota_per_account(spark):
    rows = [("a", "h1", DAY0), ("a", "h2", DAY0 + dt.timedelta(days=1)), ("b", "h1", DAY0 + dt.timedelta(days=1))]
    runs = spark.createDataFrame(rows, "account string, hashtag_id string, started_at timestamp")
    got = {(r.account, r.entered): r.unique_tags for r in TG.rolling_unique_tags(runs, account="account").orderBy("entered_at").collect()}
    assert got == {("a", 1): 2, ("b", 1): 1}


def test_stored_objects_are_written_once(spark, tmp_path):
    files = spark.createDataFrame([("ab" * 32, bytearray(b"x"), 1, 1), ("ab" * 32, bytearray(b"x"), 1, 2), ("cd" * 32, bytearray(b"y"), 1, 3)], "sha256 string, content binary, size_bytes long, arrival int")
    files = files.withColumn("content_type", F.lit("image/png"))
    for _ in range(2):
        A.asset_store(files, str(tmp_path))
    assert sorted(r.storage_key for r in spark.read.parquet(f"{tmp_path}/batch=0").collect()) == [f"media/ab/ab/{'ab' * 32}.png", f"media/cd/cd/{'cd' * 32}.png"]
    assert (tmp_path / "batch=0" / "p1=ab" / "p2=ab").exists()


def test_a_page_does_not_shuffle_the_assets(spark):
    posts, tags, files, _ = listing(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = L.list_media(posts, tags, files, L.ListArgs(limit=5))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin [media_id" in plan and "LeftSemi" in plan


def test_files_are_written_without_a_folder_each(spark, tmp_path):
    rows = [(n, f"text {n}\nend", "en", "src1", 9) for n in range(300)] + [(7, "a second file of a post", "en", "src1", 9), (300, None, "en", "src1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    clear_scratch(spark)
    scanned = catalog.QUERIES["asset_bytes_scan"](spark, f"{tmp_path}/in")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/in/documents.parquet/*.parquet'")
    want = db.execute(catalog.ORACLES["asset_bytes_scan"]).fetchall()
    assert sorted(map(tuple, scanned.select("media_id", "sha256", "size_bytes").collect()), key=repr) == sorted(want, key=repr)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    folders = [folder for name in os.listdir(shared) if name.startswith("files-") for folder, _, _ in os.walk(f"{shared}/{name}")]
    assert 1 < len(folders) < 20
    clear_scratch(spark)


def test_a_folder_list_without_files_is_an_empty_scan(spark, tmp_path):
    nothing = spark.createDataFrame([], "media_id string, content binary")
    assert A.write_files(nothing, f"file://{tmp_path}/none") == []
    assert A.read_files(spark, []).select("media_id", "sha256", "size_bytes").collect() == []

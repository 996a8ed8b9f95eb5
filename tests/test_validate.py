import json

import pytest
from pyspark.sql import functions as F

from postlake.operators import validate as V

GOOD = {
    "id": "a1", "media_type": "CAROUSEL_ALBUM", "timestamp": "2026-08-12T17:08:55+0000",
    "permalink": "https://posts.example.com/p/a1/", "media_url": "https://cdn.example.com/v/a1.jpg",
    "caption": "matcha morning #matcha", "like_count": 594, "comments_count": 8,
}
CASES = [
    (GOOD, []),
    ({k: GOOD[k] for k in ("id", "media_type", "timestamp", "permalink")}, []),
    ({**GOOD, "caption": "", "extra": {"x": [1]}}, []),
    ({**GOOD, "like_count": 3.0}, []),
    ({**GOOD, "id": ""}, ["id"]),
    ({**GOOD, "id": 7}, ["id"]),
    ({**GOOD, "media_type": "GIF"}, ["media_type"]),
    ({**GOOD, "timestamp": "not-a-date"}, ["timestamp"]),
    ({**GOOD, "permalink": "p/a1"}, ["permalink"]),
    ({**GOOD, "media_url": "nope"}, ["media_url"]),
    ({**GOOD, "caption": None}, ["caption"]),
    ({**GOOD, "caption": 5}, ["caption"]),
    ({**GOOD, "like_count": "7"}, ["like_count"]),
    ({**GOOD, "like_count": 3.5}, ["like_count"]),
    ({**GOOD, "like_count": -1}, ["like_count"]),
    ({**GOOD, "like_count": None}, ["like_count"]),
    ({**GOOD, "comments_count": True}, ["comments_count"]),
    ({**GOOD, "comments_count": 2**53}, ["comments_count"]),
    ({k: v for k, v in GOOD.items() if k != "permalink"}, ["permalink"]),
]


def test_rules(spark):
    rows = [(n, json.dumps(doc)) for n, (doc, _) in enumerate(CASES)]
    rows += [(100, '{"id": "a1", "media_type": '), (101, "[1, 2]"), (102, "text"), (103, "7")]
    checked = {r.n: r for r in V.with_validation(spark.createDataFrame(rows, "n int, payload string")).collect()}
    for n, (_, errors) in enumerate(CASES):
        assert checked[n].errors == errors, CASES[n]
    assert all(checked[n].errors == ["document"] for n in (100, 101, 102, 103))
    assert (checked[0].like_count, checked[0].comments_count, checked[3].like_count) == (594, 8, 3)
    assert checked[2].caption == "" and checked[1].caption is None


@pytest.mark.parametrize(
    "status, body, outcome",
    [
        (200, '{"data":[]}', "ok"),
        (200, '{"error":{"message":"expired","code":190}}', "auth"),
        (400, '{"error":{"message":"expired","code":190}}', "auth"),
        (400, '{"error":{"message":"slow down","code":613}}', "throttled"),
        (429, '{"error":{"message":"slow down"}}', "throttled"),
        (500, '{"error":{"message":"Please reduce the amount of data you are asking for","code":1}}', "payload_too_large"),
        (500, '{"error":{"message":"hiccup","code":1}}', "transient"),
        (400, '{"error":{"message":"bad field","code":100}}', "rejected"),
        (404, '{"data":[]}', "http_error"),
        (500, "", "http_error"),
        (200, "<html>", "invalid_json"),
    ],
)
def test_error_classes(spark, status, body, outcome):
    df = spark.createDataFrame([(status, body)], "status int, body string")
    assert V.classify_errors(df).first().outcome == outcome


ID = "949d67c3-b749-48b2-bfc4-31ae82ef2d14"


@pytest.mark.parametrize(
    "body, route",
    [
        ('{"type":"DISPATCH_DUE_SYNCS","kind":"top"}', "DISPATCH_DUE_SYNCS"),
        ('{"type":"DISPATCH_DUE_SYNCS","kind":"all"}', "dead_letter"),
        ('{"type":"SYNC_TOP_HASHTAG_MEDIA","hashtagId":"%s"}' % ID, "SYNC_TOP_HASHTAG_MEDIA"),
        ('{"type":"SYNC_TOP_HASHTAG_MEDIA","hashtagId":"3"}', "dead_letter"),
        ('{"type":"DOWNLOAD_MEDIA_ASSET","mediaId":"%s"}' % ID, "DOWNLOAD_MEDIA_ASSET"),
        ('{"type":"DOWNLOAD_MEDIA_ASSET"}', "dead_letter"),
        ('{"type":"PURGE"}', "dead_letter"),
        ("{oops", "dead_letter"),
        ("[]", "dead_letter"),
    ],
)
def test_routes(spark, body, route):
    assert V.route_messages(spark.createDataFrame([(body,)], "body string")).first().route == route


def test_integrity_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert [(r.key, r.rows) for r in V.unique_check(df, "c", ["k"]).collect()] == [("a", 2)]
    parents = spark.createDataFrame([("a",)], "id string")
    assert [(r.key, r.rows) for r in V.fk_check(df, "c", "k", parents).collect()] == [("b", 1)]


def test_page_is_all_or_nothing(spark):
    good, bad = json.dumps(GOOD), json.dumps({**GOOD, "media_type": "GIF"})
    pages = [("r", 1, '{"data":[%s,%s]}' % (good, good)), ("r", 2, '{"data":[%s,%s]}' % (good, bad)), ("r", 3, '{"data":[]}'), ("r", 4, '{"data":[')]
    df = spark.createDataFrame(pages, "sync_run_id string, arrival_seq long, body string")
    got = {r.arrival_seq: (r.items, r.invalid_items, r.accepted) for r in V.validate_pages(df).collect()}
    assert got == {1: (2, 0, True), 2: (2, 1, False), 3: (0, 0, True), 4: (0, 0, False)}

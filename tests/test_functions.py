"""Golden cases of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.functions import captions as cap
from postlake.functions import scalars as fn

CAPTIONS = [
    (None, [], []),
    ("", [], []),
    ("no tags at all here", [], []),
    ("Morning ritual #Matcha #MatchaLatte at @SomeCafe_London", ["matcha", "matchalatte"], ["somecafe_london"]),
    ("#matcha #matcha #MATCHA #Matcha", ["matcha"], []),
    ("#มัทฉะ", ["มัทฉะ"], []),
    ("#抹茶 #マッチャ", ["抹茶", "マッチャ"], []),
    ("#Matchá #café", ["matchá", "café"], []),
    ("#2026 #1 #matcha", ["matcha"], []),
    ("thanks @some.cafe. lovely", [], ["some.cafe"]),
    ("dots only @... here", [], []),
    ("#matcha,\n#kyoto!\n(#wagashi)", ["matcha", "kyoto", "wagashi"], []),
    ("#" + "a" * 400, ["a" * 255], []),
    ("reach me at hi@somecafe", [], ["somecafe"]),
    ("@" + "b" * 40, [], ["b" * 30]),
    ("#Matcha at @SomeCafe with #Kyoto vibes", ["matcha", "kyoto"], ["somecafe"]),
    (" ".join(f"#tag{n}" for n in range(30)), [f"tag{n}" for n in range(30)], []),
]


def one(spark, columns, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(columns).first()[0]


def test_captions(spark):
    rows = spark.createDataFrame([(n, c) for n, (c, _, _) in enumerate(CAPTIONS)], "n int, caption string")
    for row in cap.with_caption_arrays(rows).collect():
        _, tags, mentions = CAPTIONS[row.n]
        assert (row.caption_hashtags, row.caption_mentions) == (tags, mentions), row.caption
    entities = cap.caption_entities(rows, "n").collect()
    assert len(entities) == sum(len(t) + len(m) for _, t, m in CAPTIONS)
    mixed = sorted((e.entity_no, e.type, e.value) for e in entities if e.n == 15)
    assert mixed == [(0, "hashtag", "matcha"), (1, "hashtag", "kyoto"), (2, "mention", "somecafe")]


@pytest.mark.parametrize("raw", ["#Matcha", "  ##MATCHA ", "　#matcha ", "﻿matcha ", "matcha"])
def test_normalize_tag(spark, raw):
    assert one(spark, cap.normalize_tag(F.col("v")), raw) == "matcha"


def test_strip_tag_keeps_blanks(spark):
    assert one(spark, cap.strip_tag(F.col("v")), " #Matcha") == " #matcha"


def test_source_timestamps(spark):
    parse = fn.iso_millis(fn.parse_source_ts(F.col("v")))
    assert one(spark, parse, "2026-08-12T17:08:55+0000") == "2026-08-12T17:08:55.000Z"
    assert one(spark, parse, "2026-08-12T17:08:55+0230") == "2026-08-12T14:38:55.000Z"
    assert one(spark, parse, "not-a-date") is None


@pytest.mark.parametrize(
    "content_type, extension",
    [("image/jpeg", ".jpg"), (" Image/PNG ; q=1", ".png"), ("video/quicktime", ".mov"), ("\timage/gif\u00a0;x", ".gif"), ("text/html", ".bin"), ("", ".bin"), (None, ".bin")],
)
def test_extensions(spark, content_type, extension):
    assert one(spark, fn.extension_for(F.col("v")), content_type) == extension


def test_content_key(spark):
    assert one(spark, fn.content_key(F.col("v"), F.lit("jpg")), "abcdef") == "media/ab/cd/abcdef.jpg"


ID = "949d67c3-b749-48b2-bfc4-31ae82ef2d14"


def decoded(spark, token):
    at = fn.decode_cursor(F.col("v"))
    return one(spark, F.when(at.isNotNull(), F.concat_ws("|", fn.iso_millis(at["taken_at"]), at["id"])), token)


def encoded(spark, text):
    import base64

    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def test_cursor_round_trip(spark):
    token = one(spark, fn.encode_cursor(F.col("v").cast("timestamp"), F.lit(ID)), "2026-08-12T17:08:55.000Z")
    assert not set("+/=\r\n") & set(token)
    assert decoded(spark, token) == f"2026-08-12T17:08:55.000Z|{ID}"
    assert decoded(spark, encoded(spark, '{"takenAt":"2026-08-12T17:08:55.000Z","id":"%s"}' % ID)) is not None


@pytest.mark.parametrize(
    "text",
    ["not json", "{}", "[]", '{"takenAt":"soon","id":"%s"}' % ID, '{"takenAt":"2026-08-12T17:08:55.000Z","id":"x"}',
     '{"takenAt":"2026-08-12T17:08:55.000Z","id":"\' OR 1=1 --"}'],
)
def test_broken_cursors(spark, text):
    assert decoded(spark, encoded(spark, text)) is None
    assert decoded(spark, "%%" + text) is None


def test_usage(spark):
    rows = [
        (1, '{"call_count":12,"total_cputime":3,"total_time":5}', None),
        (2, '{"call_count":12}', '{"1":[{"call_count":80,"estimated_time_to_regain_access":0}],"2":[{"total_time":90.5,"estimated_time_to_regain_access":3}]}'),
        (3, "{broken", None),
        (4, None, '{"1":"text","2":[7,{"call_count":"9"}]}'),
        (5, None, None),
    ]
    df = spark.createDataFrame(rows, "n int, app string, business string")
    usage = fn.usage_summary(F.col("app"), F.col("business"))
    got = {r.n: r.u for r in df.select("n", usage.alias("u")).collect()}
    assert (got[1].worst_pct, got[1].cpu_pct, got[1].regain_minutes) == (12.0, 3.0, None)
    assert (got[2].worst_pct, got[2].call_pct, got[2].total_pct, got[2].regain_minutes) == (90.5, 80.0, 90.5, 3.0)
    assert got[3] is None and got[5] is None
    assert got[4].worst_pct == 0.0 and got[4].call_pct is None


@pytest.mark.parametrize(
    "worst, regain, delay",
    [(50.0, None, 0), (80.0, None, 1000), (90.0, None, 15500), (100.0, None, 30000), (10.0, 2.0, 120000), (10.0, 99.0, 300000), (None, None, 0)],
)
def test_throttle(spark, worst, regain, delay):
    df = spark.createDataFrame([(worst, regain)], "w double, r double")
    assert df.select(fn.throttle_delay_ms(F.col("w"), F.col("r"), 80)).first()[0] == delay


def test_redaction_and_errors(spark):
    assert one(spark, fn.redact_token(F.col("v")), "https://e.com/x?access_token=abc&limit=3") == "https://e.com/x?access_token=[redacted]&limit=3"
    assert len(one(spark, fn.truncate_error(F.col("v"), fn.TAG_ERROR_LENGTH), "x" * 3000)) == 2000


def test_duration_rounds_to_whole_milliseconds(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(start, start + dt.timedelta(microseconds=1_500_600))], "a timestamp, b timestamp")
    assert df.select(fn.duration_ms(F.col("a"), F.col("b"))).first()[0] == 1501

"""Domain tables derived from the given parquet tables.

Each view is one SELECT that both Spark and the checking database read; the few spellings that
differ are filled in from a dialect table. Whole tables and whole texts are used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    "sha256": "sha2({0}, 256)",
    "plus_seconds": "timestampadd(SECOND, CAST({1} AS INT), {0})",
    "bytes": "octet_length({0})",
    "millis": "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
    "text_ts": "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss'+0000'\")",
    "ts": "CAST({0} AS TIMESTAMP)",
    "joined": "listagg({0}, ',') WITHIN GROUP (ORDER BY {1})",
}
DUCKDB = {
    "sha256": "sha256({0})",
    "plus_seconds": "({0} + to_seconds(CAST({1} AS INT)))",
    "bytes": "octet_length(encode({0}))",
    "millis": "strftime({0}, '%Y-%m-%dT%H:%M:%S.%gZ')",
    "text_ts": "strftime({0}, '%Y-%m-%dT%H:%M:%S+0000')",
    "ts": "CAST({0} AS TIMESTAMP)",
    "joined": "string_agg({0}, ',' ORDER BY {1})",
    "us": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
}

_ID = "'00000000-0000-4000-8000-' || lpad(CAST({0} AS STRING), 12, '0')"

# name -> (views it reads, SQL). ``@fn{a;b}`` is replaced from the dialect table.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "tags": (
        (),
        """
        SELECT 'h' || CAST(n_nationkey AS STRING) AS id, lower(n_name) AS name,
               CASE WHEN n_nationkey % 4 = 1 THEN NULL ELSE '178' || lpad(CAST(n_nationkey AS STRING), 6, '0') END AS ig_hashtag_id,
               n_nationkey % 5 <> 0 AS is_active,
               CASE n_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN @ts{'2024-01-01 00:00:00'} ELSE @ts{'2024-03-01 00:00:00'} END AS track_from,
               CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN @ts{'2024-02-01 00:00:00'} ELSE @ts{'2024-12-31 00:00:00'} END AS track_until,
               n_nationkey % 7 <> 3 AS top_sync_enabled, n_nationkey % 6 <> 2 AS recent_sync_enabled,
               CASE WHEN n_nationkey % 3 = 1 THEN 10 + n_nationkey END AS max_media_per_sync,
               n_nationkey % 4 AS consecutive_failures
        FROM nation
        """,
    ),
    "observations": (
        (),
        """
        SELECT ig_media_id, hashtag_id, sync_run_id, source, event_id, k,
               CAST(row_number() OVER (PARTITION BY sync_run_id ORDER BY fetched_at, event_id) - 1 AS INT) AS position_overall,
               fetched_at,
               CASE WHEN k % 33 = 0 THEN 'VIDEO' WHEN user_id % 2 = 0 THEN 'IMAGE' ELSE 'CAROUSEL_ALBUM' END AS media_type,
               'Post ' || CAST(user_id AS STRING) || ' #NATION_' || CAST(user_id % 25 AS STRING) || ' #Common #T' || CAST(user_id % 7 AS STRING)
                 || ' #2024 @Acc_' || CAST(user_id % 11 AS STRING) || '.' || CASE WHEN k % 20 = 0 THEN ' #Edited @fan.x' ELSE '' END AS caption,
               'https://posts.example.com/p/' || ig_media_id || CASE WHEN k % 50 = 0 THEN '/moved' ELSE '/' END AS permalink,
               CASE WHEN k % 7 = 0 THEN NULL ELSE 'https://cdn.example.com/' || ig_media_id || '/' || CAST(k % 3 AS STRING) || '.jpg' END AS media_url,
               date_trunc('day', fetched_at) AS taken_at,
               CAST(CASE WHEN k % 10 < 7 THEN 10 ELSE k END AS INT) AS like_count,
               CAST(k % 2 AS INT) AS comments_count
        FROM (SELECT *, 'r-' || replace(CAST(CAST(fetched_at AS DATE) AS STRING), '-', '') || '-' || source || '-' || CAST(user_id % 25 AS STRING) AS sync_run_id
              FROM (SELECT event_id, user_id, @ts{ts} AS fetched_at, 'm' || CAST(user_id AS STRING) AS ig_media_id,
                           'h' || CAST(user_id % 25 AS STRING) AS hashtag_id,
                           CASE WHEN event_type IN ('click', 'view') THEN 'top' ELSE 'recent' END AS source,
                           CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
                    FROM events) AS e) AS r
        """,
    ),
    "payloads": (
        ("observations",),
        """
        SELECT sync_run_id, hashtag_id, source, event_id, position_overall, fetched_at,
               CASE WHEN k = 13 THEN '{"id": "' || ig_media_id || '", "media_type": '
                    ELSE '{"id":"' || CASE WHEN k = 17 THEN '' ELSE ig_media_id END
                      || '","media_type":"' || CASE WHEN k = 19 THEN 'GIF' ELSE media_type END
                      || '","timestamp":"' || CASE WHEN k = 23 THEN 'not-a-date' ELSE @text_ts{fetched_at} END || '"'
                      || CASE WHEN k = 29 THEN '' ELSE ',"permalink":"' || permalink || '"' END
                      || CASE WHEN media_url IS NULL THEN '' ELSE ',"media_url":"' || media_url || '"' END
                      || CASE WHEN k = 31 THEN ',"caption":null' ELSE ',"caption":"' || caption || '"' END
                      || CASE WHEN k = 37 THEN ',"like_count":3.5' WHEN k = 41 THEN ',"like_count":"7"' WHEN k = 43 THEN '' WHEN k = 47 THEN ',"like_count":-1'
                              ELSE ',"like_count":' || CAST(like_count AS STRING) END
                      || ',"comments_count":' || CAST(comments_count AS STRING) || ',"extra":' || CAST(k AS STRING) || '}' END AS payload,
               k, ig_media_id, media_type, caption, permalink, media_url, like_count, comments_count
        FROM observations
        """,
    ),
    "landed": (
        ("payloads",),
        """
        SELECT sync_run_id, hashtag_id, source, CAST(CASE WHEN block >= 3 THEN 2 ELSE 1 END AS INT) AS attempt, block AS arrival_seq, max(fetched_at) AS fetched_at,
               '{"data":[' || @joined{payload;position_overall} || '],"paging":{"cursors":{"after":"c' || CAST(block AS STRING) || '"}}}' AS body,
               count(*) AS n_items, max(CASE WHEN k = 13 THEN 1 ELSE 0 END) AS broken
        FROM (SELECT *, CAST(floor(position_overall / 6) AS BIGINT) AS block FROM payloads) AS p
        GROUP BY sync_run_id, hashtag_id, source, block
        """,
    ),
    "captions": (
        (),
        """
        SELECT doc_id, text || ' #' || lang || ' #Src' || substr(source, 4) || ' #' || CAST(n_chars % 7 AS STRING) || ' #' || upper(lang)
                 || ' #' || lang || '_' || CAST(doc_id % 3 AS STRING) || ' @' || source || '.x.' AS caption, lang, source
        FROM documents
        """,
    ),
    "posts": (
        (),
        f"""
        SELECT {_ID.format("o_orderkey")} AS id, 'p' || CAST(o_orderkey AS STRING) AS ig_media_id,
               'h' || CAST(o_custkey % 25 AS STRING) AS hashtag_id,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'IMAGE' WHEN '2' THEN 'IMAGE' WHEN '3' THEN 'VIDEO' WHEN '4' THEN 'VIDEO' ELSE 'CAROUSEL_ALBUM' END AS media_type,
               'By customer #C' || CAST(o_custkey AS STRING) || ' #NATION_' || CAST(o_custkey % 25 AS STRING) || ' #P' || substr(o_orderpriority, 1, 1) || ' @cust.' || CAST(o_custkey % 40 AS STRING) AS caption,
               'https://posts.example.com/p/' || CAST(o_orderkey AS STRING) || '/' AS permalink,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'https://cdn.example.com/p' || CAST(o_orderkey AS STRING) END AS source_media_url,
               @ts{{o_orderdate}} AS taken_at, @plus_seconds{{@ts{{o_orderdate}};o_orderkey % 86400}} AS first_seen_at,
               @plus_seconds{{@ts{{o_orderdate}};86400 + o_orderkey % 86400}} AS last_seen_at,
               CASE WHEN o_orderkey % 10 = 0 THEN @plus_seconds{{@ts{{o_orderdate}};86400}} END AS content_updated_at,
               CAST(floor(o_totalprice / 1000) AS INT) AS like_count, CAST(o_orderkey % 50 AS INT) AS comments_count,
               o_orderkey % 2 = 0 AS seen_in_top, o_orderkey % 3 = 0 AS seen_in_recent,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 100 + 1 AS INT) END AS best_top_rank,
               o_orderstatus = 'P' AS is_stale
        FROM orders
        """,
    ),
    "files": (
        (),
        f"""
        SELECT doc_id, {_ID.format("doc_id")} AS media_id, text AS content, @sha256{{text}} AS sha256, CAST(@bytes{{text}} AS BIGINT) AS size_bytes,
               CASE CAST(substr(source, 4) AS INT) % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN ' Image/PNG ; charset=binary' WHEN 2 THEN 'video/mp4'
                    WHEN 3 THEN 'application/x-unknown' ELSE NULL END AS content_type,
               CASE WHEN doc_id % 11 = 3 THEN NULL ELSE 'https://cdn.example.com/p' || CAST(doc_id AS STRING) END AS url,
               doc_id % 13 = 5 AS already_stored, doc_id % 17 = 7 AS fetch_fails
        FROM documents
        """,
    ),
    "assets": (
        (),
        f"""
        SELECT {_ID.format("d.doc_id")} AS media_id,
               CASE d.doc_id % 8 WHEN 1 THEN 'pending' WHEN 3 THEN 'failed' WHEN 5 THEN 'skipped' WHEN 7 THEN 'downloading' ELSE 'stored' END AS status,
               CASE WHEN d.doc_id % 2 = 0 THEN @sha256{{d.text}} END AS sha256,
               CASE WHEN d.doc_id % 2 = 0 THEN 'media/' || substr(@sha256{{d.text}}, 1, 2) || '/' || substr(@sha256{{d.text}}, 3, 2) || '/' || @sha256{{d.text}} || '.jpg' END AS storage_key,
               CASE WHEN d.doc_id % 2 = 0 THEN 'image/jpeg' END AS content_type,
               CASE WHEN d.doc_id % 2 = 0 THEN CAST(@bytes{{d.text}} AS BIGINT) END AS size_bytes,
               CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE 'https://cdn.example.com/p' || CAST(d.doc_id AS STRING) END AS fetched_from_url,
               CASE WHEN d.doc_id % 2 = 0 THEN @ts{{e.ts}} END AS stored_at
        FROM documents AS d LEFT JOIN events AS e ON e.event_id = d.doc_id
        """,
    ),
    "runs": (
        (),
        """
        SELECT 'run-' || CAST(o_orderkey AS STRING) AS id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'SYNC_TOP_HASHTAG_MEDIA' ELSE 'SYNC_RECENT_HASHTAG_MEDIA' END AS type,
               CASE WHEN o_orderstatus = 'F' THEN 'succeeded' WHEN o_orderstatus = 'O' THEN 'running' WHEN o_custkey % 2 = 0 THEN 'failed' ELSE 'partial' END AS status,
               'h' || CAST(o_custkey % 25 AS STRING) AS hashtag_id,
               'msg-' || CAST(o_orderkey % 14000 AS STRING) AS triggered_by_message_id,
               @ts{o_orderdate} AS started_at,
               CASE WHEN o_orderstatus <> 'O' THEN @plus_seconds{@ts{o_orderdate};o_custkey % 700} END AS finished_at,
               CASE WHEN o_orderstatus = 'P' THEN 'page failed: ' || repeat(o_orderpriority || ' ', 400) END AS error,
               CAST(o_orderkey % 500 AS INT) AS items_seen, CAST(o_orderkey % 120 % 50 AS INT) AS items_new,
               '{"call_count":' || CAST(o_custkey % 101 AS STRING) || ',"total_time":' || CAST(o_orderkey % 90 AS STRING) || '}' AS app_usage
        FROM orders
        """,
    ),
    "deliveries": (
        (),
        """
        SELECT event_id AS delivery_no, 'q-' || CAST(user_id AS STRING) || '-' || CAST(k % 10 AS STRING) AS message_id, @ts{ts} AS delivered_at,
               'h' || CAST(user_id % 40 AS STRING) AS hashtag_id, user_id
        FROM (SELECT event_id, user_id, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) AS e
        """,
    ),
    "messages": (
        (),
        f"""
        SELECT conv_id, turn, 'msg-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS message_id,
               CASE WHEN role = 'system' THEN '{{"type": "SYNC_TOP'
                    WHEN (conv_id + turn) % 7 = 0 THEN '{{"type":"DISPATCH_DUE_SYNCS","kind":"' || CASE WHEN turn % 3 = 0 THEN 'top' WHEN turn % 3 = 1 THEN 'recent' ELSE 'all' END || '"}}'
                    WHEN (conv_id + turn) % 7 = 1 THEN '{{"type":"PURGE","mediaId":"' || {_ID.format("conv_id")} || '"}}'
                    WHEN (conv_id + turn) % 7 = 2 THEN '{{"type":"DOWNLOAD_MEDIA_ASSET","mediaId":"' || CAST(conv_id AS STRING) || '"}}'
                    WHEN (conv_id + turn) % 7 = 3 THEN '{{"type":"DOWNLOAD_MEDIA_ASSET","mediaId":"' || {_ID.format("conv_id")} || '"}}'
                    WHEN (conv_id + turn) % 7 = 4 THEN '{{"type":"DOWNLOAD_MEDIA_ASSET","hashtagId":"' || {_ID.format("conv_id")} || '"}}'
                    WHEN role = 'user' THEN '{{"type":"SYNC_TOP_HASHTAG_MEDIA","hashtagId":"' || {_ID.format("conv_id")} || '"}}'
                    ELSE '{{"type":"SYNC_RECENT_HASHTAG_MEDIA","hashtagId":"' || {_ID.format("conv_id")} || '"}}' END AS body
        FROM conversations
        """,
    ),
    "usage": (
        (),
        """
        SELECT event_id,
               CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN '{"call_count": ' ELSE
                 '{"call_count":' || CAST(k AS STRING) || ',"total_cputime":' || CAST(user_id % 100 AS STRING) || ',"total_time":"x"}' END AS app_usage,
               CASE WHEN k % 6 = 0 THEN NULL ELSE
                 '{"17841":[{"type":"a","call_count":' || CAST((k + 20) % 100 AS STRING) || ',"total_time":' || CAST(event_id % 97 AS STRING)
                 || ',"estimated_time_to_regain_access":' || CAST(CASE WHEN k % 8 = 0 THEN k % 5 ELSE 0 END AS STRING) || '},{"total_cputime":50.5}],"17842":[{"call_count":'
                 || CAST(k % 30 AS STRING) || '}],"note":7}' END AS business_usage, k, user_id
        FROM (SELECT event_id, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) AS e
        """,
    ),
    "responses": (
        (),
        """
        SELECT event_id,
               CAST(CASE k % 10 WHEN 0 THEN 500 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 404 WHEN 4 THEN 400 ELSE 200 END AS INT) AS status,
               CASE WHEN k % 21 = 20 THEN '<html>' WHEN k % 21 = 19 THEN '' WHEN k % 21 > 12 OR k % 10 = 3 THEN '{"data":[]}' ELSE
                 '{"error":{"message":"' || CASE WHEN k % 21 < 3 THEN 'Please REDUCE the amount of data you ask for' ELSE 'Nope' END || '"'
                 || CASE WHEN k % 21 = 12 THEN '' ELSE ',"code":' || CASE k % 21 WHEN 0 THEN '1' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '190' WHEN 4 THEN '102' WHEN 5 THEN '463'
                      WHEN 6 THEN '467' WHEN 7 THEN '4' WHEN 8 THEN '17' WHEN 9 THEN '32' WHEN 10 THEN '613' WHEN 11 THEN '80004' ELSE '100' END END || '}}' END AS body,
               'https://graph.example.com/tag?fields=id&access_token=tok' || CAST(k AS STRING) || '&limit=' || CAST(k % 50 AS STRING) AS url, k
        FROM (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) AS e
        """,
    ),
    "names": (
        (),
        """
        SELECT c_custkey, '  ##' || CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) ELSE c_mktsegment END
                 || CASE WHEN c_custkey % 4 = 0 THEN '_' || CAST(c_nationkey AS STRING) ELSE '' END || CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE chr(160) END AS raw_name,
               CASE WHEN c_custkey % 5 = 0 THEN '#NATION_' || CAST(c_custkey % 40 AS STRING) ELSE 'seg ' || lower(c_mktsegment) END AS asked
        FROM customer
        """,
    ),
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


_MARK = re.compile(r"@(" + "|".join(DUCKDB) + r")\{([^{}]*)\}")


def _fill(sql: str, dialect: dict[str, str]) -> str:
    """Replace ``@name{arg;arg}`` marks, innermost first."""
    while True:
        filled = _MARK.sub(lambda m: dialect[m[1]].format(*m[2].split(";")), sql)
        if filled == sql:
            return sql
        sql = filled


def duckdb_with(*names: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """Common table expressions for the named views and whatever they read."""
    known = VIEWS | (extra or {})
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in known[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ",\n".join(f"{name} AS ({duckdb_text(known[name][1])})" for name in ordered)


def duckdb_text(sql: str) -> str:
    return _fill(sql, DUCKDB)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame; ``{table}`` marks are bound to the frames it reads."""
    needs, sql = VIEWS[name]
    sources = {needed: view(spark, sf_dir, needed) for needed in needs}
    sources |= {table: table_of(spark, sf_dir, table) for table in TABLES if re.search(rf"\b(FROM|JOIN) {table}\b", sql)}
    text = _fill(sql, SPARK).replace("{", "{{").replace("}", "}}")
    for source in sources:
        text = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", text)
    return spark.sql(text, **sources)


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Independent SQL definitions of the derived tables, for checking the Spark jobs.

Written row by row (recursion, plain windows) for clarity, with no regard to scale.
"""

from __future__ import annotations

from postlake.plans.driver_views import duckdb_text, duckdb_with

# Lists keep their first appearance of each value.
_FIRST_OF = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_TAGS = (
    "list_filter(list_transform(regexp_extract_all({0}, '#([\\pL\\pN\\pM_]+)', 1), lambda x: substr(lower(x), 1, 255)),"
    " lambda x: NOT regexp_matches(x, '^[0-9]+$'))"
)
_MENTIONS = (
    "list_filter(list_transform(regexp_extract_all({0}, '@([A-Za-z0-9._]+)', 1),"
    " lambda x: lower(regexp_replace(x, '\\.+$', ''))), lambda x: x <> '')"
)


def tags_sql(caption: str) -> str:
    return _FIRST_OF.format(_TAGS.format(caption))


def mentions_sql(caption: str) -> str:
    # The cap of 30 characters is not met by the given texts.
    return _FIRST_OF.format(_MENTIONS.format(caption))


def joined(expr: str) -> str:
    return f"array_to_string({expr}, ',')"


def _chain(prefix: str, base: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """Fold views over an observation table: numbered, fold, history, flags, current posts."""
    tracked = ("like_count", "comments_count", "rank", "caption", "permalink", "media_type")
    names = ("likeCount", "commentsCount", "rank", "caption", "permalink", "mediaType")
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM f.{c}" for c in tracked)
    rec = f"(({differs}) AND NOT list_contains(f.runs, o.sync_run_id))"
    kept = ", ".join(f"CASE WHEN {rec} THEN o.{c} ELSE f.{c} END" for c in tracked)
    changed = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM f.{c} THEN '{n}' END" for c, n in zip(tracked, names))
    return {
        f"{prefix}numbered": (
            (base,),
            f"""SELECT *, CASE WHEN source = 'top' THEN position_overall + 1 END AS rank,
                row_number() OVER (PARTITION BY ig_media_id ORDER BY fetched_at, sync_run_id, position_overall) AS n FROM {base}""",
        ),
        f"{prefix}fold": (
            (f"{prefix}numbered",),
            f"""SELECT ig_media_id, n, [sync_run_id] AS runs, TRUE AS rec, {", ".join(tracked)},
                  {list(names)} AS changed_fields
                FROM {prefix}numbered WHERE n = 1
                UNION ALL
                SELECT o.ig_media_id, o.n, CASE WHEN {rec} THEN list_append(f.runs, o.sync_run_id) ELSE f.runs END, {rec}, {kept},
                  list_filter([{changed}], lambda x: x IS NOT NULL)
                FROM {prefix}fold AS f JOIN {prefix}numbered AS o ON o.ig_media_id = f.ig_media_id AND o.n = f.n + 1""",
        ),
        f"{prefix}history": (
            (f"{prefix}fold",),
            f"""SELECT o.*, f.changed_fields, o.fetched_at AS captured_at FROM {prefix}fold AS f
                JOIN {prefix}numbered AS o ON o.ig_media_id = f.ig_media_id AND o.n = f.n WHERE f.rec""",
        ),
        f"{prefix}flags": (
            (f"{prefix}numbered",),
            f"""SELECT *, n = 1 AS is_new,
                  n > 1 AND (caption IS DISTINCT FROM lag(caption) OVER w OR permalink IS DISTINCT FROM first_value(permalink) OVER w
                             OR media_type IS DISTINCT FROM first_value(media_type) OVER w) AS content_changed,
                  first_value(media_url) OVER w AS first_media_url
                FROM {prefix}numbered WINDOW w AS (PARTITION BY ig_media_id ORDER BY n)""",
        ),
        f"{prefix}posts": (
            (f"{prefix}flags",),
            f"""SELECT ig_media_id, arg_min(hashtag_id, n) AS hashtag_id, arg_min(media_type, n) AS media_type, arg_min(permalink, n) AS permalink,
                  arg_min(taken_at, n) AS taken_at, arg_min(source, n) AS first_seen_via, arg_max_null(caption, n) AS caption,
                  arg_max_null(media_url, n) AS source_media_url, arg_max_null(like_count, n) AS like_count, arg_max_null(comments_count, n) AS comments_count,
                  min(fetched_at) AS first_seen_at, max(fetched_at) AS last_seen_at, max(fetched_at) FILTER (WHERE content_changed) AS content_updated_at,
                  bool_or(source = 'top') AS seen_in_top, bool_or(source = 'recent') AS seen_in_recent, min(rank) AS best_top_rank
                FROM {prefix}flags GROUP BY ig_media_id""",
        ),
    }


EXTRA: dict[str, tuple[tuple[str, ...], str]] = {
    # Readable pages land; a broken body lands nothing, so later positions move up.
    "raw": (
        ("landed",),
        """SELECT p.sync_run_id, p.hashtag_id, p.source, l.fetched_at, l.page_number,
             row_number() OVER (PARTITION BY p.sync_run_id, l.arrival_seq ORDER BY p.position_overall) - 1 AS position_in_page,
             row_number() OVER (PARTITION BY p.sync_run_id ORDER BY p.position_overall) - 1 AS position_overall, p.payload
           FROM payloads AS p
           JOIN (SELECT *, row_number() OVER (PARTITION BY sync_run_id, attempt ORDER BY arrival_seq) AS page_number FROM landed WHERE broken = 0) AS l
             ON l.sync_run_id = p.sync_run_id AND l.arrival_seq = p.position_overall // 6""",
    ),
    "checked": (
        ("raw",),
        """SELECT *, concat_ws(',', CASE WHEN NOT coalesce(json_type(payload, '$.id') = 'VARCHAR' AND payload->>'$.id' <> '', FALSE) THEN 'id' END,
             CASE WHEN NOT coalesce(payload->>'$.media_type' IN ('IMAGE', 'VIDEO', 'CAROUSEL_ALBUM'), FALSE) THEN 'media_type' END,
             CASE WHEN try_strptime(payload->>'$.timestamp', '%Y-%m-%dT%H:%M:%S+0000') IS NULL THEN 'timestamp' END,
             CASE WHEN NOT coalesce(payload->>'$.permalink' LIKE 'https://%', FALSE) THEN 'permalink' END,
             CASE WHEN json_type(payload, '$.caption') = 'NULL' THEN 'caption' END,
             CASE WHEN json_type(payload, '$.like_count') NOT IN ('UBIGINT') THEN 'like_count' END) AS errors
           FROM raw""",
    ),
    "robs": (
        ("checked",),
        """SELECT payload->>'$.id' AS ig_media_id, hashtag_id, sync_run_id, source, position_overall, fetched_at, payload->>'$.media_type' AS media_type,
             payload->>'$.caption' AS caption, payload->>'$.permalink' AS permalink, payload->>'$.media_url' AS media_url,
             strptime(payload->>'$.timestamp', '%Y-%m-%dT%H:%M:%S+0000') AS taken_at, CAST(payload->>'$.like_count' AS INT) AS like_count,
             CAST(payload->>'$.comments_count' AS INT) AS comments_count
           FROM checked WHERE errors = ''""",
    ),
    **_chain("", "observations"),
    **_chain("r", "robs"),
}
EXTRA["now_posts"] = EXTRA.pop("posts")


def oracle(views: str, sql: str) -> str:
    """A complete statement: the views it reads, then ``sql`` (which may add more, after a comma)."""
    ctes = duckdb_with(*views.split(), extra=EXTRA) if views else ""
    body = duckdb_text(sql).strip()
    if not ctes:
        return body
    return f"WITH RECURSIVE {ctes}\n{body}"

"""A slow row-by-row model of the upsert rules, in plain Python, to compare the jobs with."""

from __future__ import annotations

import datetime as dt
import random

FIELDS = ("like_count", "comments_count", "rank", "caption", "permalink", "media_type")
NAMES = ("likeCount", "commentsCount", "rank", "caption", "permalink", "mediaType")
START = dt.datetime(2024, 3, 1)


def random_observations(seed: int, posts: int = 4, rows: int = 120, hours: int = 120, runs: int = 25) -> list[dict]:
    """Runs overlap, span several days, alternate edges and repeat posts with few values."""
    rng = random.Random(seed)
    run_of = [(f"r{n:03d}", rng.choice(["top", "recent"]), rng.randrange(hours), rng.choice([1, 5, 40])) for n in range(runs)]
    out, position = [], {}
    for _ in range(rows):
        run, source, begin, length = rng.choice(run_of)
        at = START + dt.timedelta(hours=begin, minutes=rng.randrange(length * 60 // 30 + 1) * 30)
        position[run] = position.get(run, -1) + 1
        hot = rng.random() < 0.4
        out.append(
            {
                "ig_media_id": "hot" if hot else f"p{rng.randrange(posts)}",
                "hashtag_id": f"h{rng.randrange(3)}",
                "sync_run_id": run,
                "source": source,
                "position_overall": position[run] if rng.random() < 0.7 else position[run] + 1000,
                "fetched_at": at,
                "media_type": rng.choice(["IMAGE", "IMAGE", "VIDEO"]),
                "caption": rng.choice([None, "", "a #x", "a #x", "b #y @z."]),
                "permalink": rng.choice(["https://e.com/1", "https://e.com/1", "https://e.com/2"]),
                "media_url": rng.choice([None, "https://c.com/1"]),
                "taken_at": START + dt.timedelta(hours=rng.randrange(5)),
                "like_count": rng.choice([None, 1, 1, 2]),
                "comments_count": rng.choice([0, 0, None]),
            }
        )
    seen = set()
    unique = []
    for row in out:
        key = (row["sync_run_id"], row["position_overall"])
        if key not in seen:
            seen.add(key)
            unique.append(row)
    return unique


def arrival(row: dict):
    return (row["fetched_at"], row["sync_run_id"], row["position_overall"])


class Store:
    """Applies observations one at a time."""

    def __init__(self) -> None:
        self.posts: dict[str, dict] = {}
        self.history: list[dict] = []
        self.assets: dict[str, dict] = {}
        self.flags: dict[tuple, tuple] = {}
        self.enqueued: dict[str, int] = {}

    def apply(self, row: dict) -> None:
        rank = row["position_overall"] + 1 if row["source"] == "top" else None
        now, key = row["fetched_at"], row["ig_media_id"]
        post = self.posts.get(key)
        new = post is None
        changed = False
        if new:
            post = self.posts[key] = {
                "hashtag_id": row["hashtag_id"], "media_type": row["media_type"], "permalink": row["permalink"],
                "taken_at": row["taken_at"], "first_seen_at": now, "first_seen_via": row["source"],
                "content_updated_at": None, "best_top_rank": None, "seen_in_top": False, "seen_in_recent": False,
            }
        else:
            changed = (
                post["caption"] != row["caption"] or post["permalink"] != row["permalink"]
                or post["media_type"] != row["media_type"]
            )
            if changed:
                post["content_updated_at"] = now
        post.update(
            caption=row["caption"], source_media_url=row["media_url"], like_count=row["like_count"],
            comments_count=row["comments_count"], last_seen_at=now, is_stale=False,
        )
        post["seen_in_top"] |= row["source"] == "top"
        post["seen_in_recent"] |= row["source"] == "recent"
        if rank is not None:
            post["best_top_rank"] = rank if post["best_top_rank"] is None else min(rank, post["best_top_rank"])
        self.flags[(row["sync_run_id"], row["position_overall"])] = (new, changed)

        mine = [h for h in self.history if h["ig_media_id"] == key]
        current = {**{f: row.get(f) for f in FIELDS}, "rank": rank}
        before = mine[-1] if mine else None
        names = [n for f, n in zip(FIELDS, NAMES) if before is None or before[f] != current[f]]
        if names and all(h["sync_run_id"] != row["sync_run_id"] for h in mine):
            self.history.append({**row, **current, "changed_fields": names})

        asset = self.assets.setdefault(key, {"status": "pending" if row["media_url"] else "skipped"})
        asset["url"] = row["media_url"]
        if asset["status"] == "pending" and row["media_url"]:
            self.enqueued[row["sync_run_id"]] = self.enqueued.get(row["sync_run_id"], 0) + 1

    def apply_all(self, rows: list[dict]) -> "Store":
        for row in sorted(rows, key=arrival):
            self.apply(row)
        return self

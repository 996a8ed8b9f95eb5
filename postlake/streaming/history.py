"""Change-only history on an unbounded stream, with per-post state."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import Any
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from postlake.operators.history import _ALL, _mask, field_digests, names_of, ranked
from postlake.schemas import OBSERVATION, TRACKED_COLUMNS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What passes through Python beside the digests: post, order of arrival, and all columns in one text.
_INPUT = ["post", "fetched_at", "sync_run_id", "position_overall", "observation"]
_RECORDED = "sync_run_id string, observation string, changed int"
OUTPUT = (
    T.StructType([T.StructField(f.name, f.dataType) for f in OBSERVATION.fields])
    .add("rank", T.IntegerType())
    .add("changed_fields", T.ArrayType(T.StringType()))
)
_PACKED = T.StructType([T.StructField(f.name, T.LongType() if f.dataType == T.TimestampType() else f.dataType) for f in OUTPUT.fields[:-1]])

# Groups that posts are dealt into, and the entries that a page of a group's state holds before its pages grow in number.
BUCKETS = 4096
PAGE = 512


class Pages:
    """Entries of a group of posts, as pages of a map state.

    A state call costs far more than a page, so what a micro-batch asks for shares calls. An entry's page follows from its key, and
    pages grow in number when one is full: however many entries there are, a page stays small, and only pages of
    keys at hand are read.
    """

    SCHEMA = "keys array<string>, numbers array<long>, pages int"

    def __init__(self, state: Any, width: int) -> None:
        self.state, self.width = state, width
        self._forget()

    def _forget(self) -> None:
        self.pages, self.held, self.changed = 0, {}, set()

    def _load(self, page: int) -> dict[str, tuple]:
        if page not in self.held:
            keys, numbers, pages = self.state.getValue((page,)) or ((), (), 1)
            self.held[page] = {key: tuple(numbers[n * self.width : (n + 1) * self.width]) for n, key in enumerate(keys)}
            # Page 0 is the first one written, and tells how many there are.
            if page == 0:
                self.pages = pages
        return self.held[page]

    def _page_of(self, key: str) -> int:
        if not self.pages:
            self._load(0)
        return crc32(key.encode()) % self.pages

    def get(self, key: str) -> tuple | None:
        return self._load(self._page_of(key)).get(key)

    def put(self, key: str, numbers: tuple) -> None:
        page = self._page_of(key)
        self._load(page)[key] = numbers
        self.changed.add(page)

    def store(self) -> None:
        """Write the changed pages of the group at hand and forget it."""
        if any(len(self.held[page]) > PAGE for page in self.changed):
            entries = [entry for page in range(self.pages) for entry in self._load(page).items()]
            while len(entries) > self.pages * PAGE // 2:
                self.pages *= 2
            self.held = {page: {} for page in range(self.pages)}
            self.changed = set(self.held)
            for key, numbers in entries:
                self.held[self._page_of(key)][key] = numbers
        for page in self.changed:
            entries = self.held[page]
            self.state.updateValue((page,), (list(entries), [n for numbers in entries.values() for n in numbers], self.pages))
        self._forget()


class PostState:
    """The part of a group's pages that belongs to one post: a value, and values by run."""

    post: str | None = None

    def __init__(self, pages: Pages) -> None:
        self.pages = pages

    def get(self) -> tuple | None:
        return self.pages.get(repr(self.post))

    def update(self, value: tuple) -> None:
        self.pages.put(repr(self.post), value)

    def containsKey(self, key: tuple) -> bool:
        return self.pages.get(f"{self.post!r} {key[0]!r}") is not None

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.pages.put(f"{self.post!r} {key[0]!r}", ())


class RecordChanges(StatefulProcessor):
    """State per post: digests of the last recorded fields, and the runs already recorded.

    Every state call is a round trip between worker and executor, and every group costs several frames. So posts come in groups, which
    share both: a group costs two calls per page that its posts and their runs at hand fall into.
    """

    views: tuple[PostState, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = PostState(Pages(handle.getMapState("last", "page int", Pages.SCHEMA), len(TRACKED_COLUMNS)))
        self.runs = PostState(Pages(handle.getMapState("runs", "page int", Pages.SCHEMA), 0))
        self.views = (self.last, self.runs)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        posts, at, runs, positions, texts, *digests = columns = [[] for _ in [*_INPUT, *TRACKED_COLUMNS]]
        names = [*_INPUT, *[f"digest_{column}" for column in TRACKED_COLUMNS]]
        for frame in rows:
            for column, name in zip(columns, names):
                column.extend(frame[name].tolist())
        # A micro-batch may hold several observations of a post: restore their arrival order.
        order = sorted(
            range(len(at)), key=lambda n: (posts[n] is None, posts[n] or "", at[n], runs[n] is None, runs[n] or "", positions[n])
        )
        states = list(zip(*digests))
        keep, masks = [], []
        for post, places in groupby(order, key=posts.__getitem__):
            for view in self.views:
                view.post = post
            places = list(places)
            stored = self.last.get()
            last = tuple(stored) if stored is not None else None
            at_hand = dict.fromkeys(runs[n] for n in places) if last is not None else ()
            recorded = {run for run in at_hand if self.runs.containsKey((run,))}
            begun = len(keep)
            for n in places:
                run, state = runs[n], states[n]
                if state == last or run in recorded:
                    continue
                masks.append(_ALL if last is None else _mask(state, last))
                keep.append(n)
                last = state
                recorded.add(run)
                self.runs.updateValue((run,), (True,))
            if len(keep) > begun:
                self.last.update(last)
        for view in self.views:
            view.pages.store()
        if keep:
            yield pd.DataFrame({"sync_run_id": [runs[n] for n in keep], "observation": [texts[n] for n in keep], "changed": masks})

    def close(self) -> None:
        pass


def stream_history(observations: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The observations that enter the history, emitted as they arrive.

    Needs the RocksDB state store. 64-bit digests of the fields, not the texts, are kept as state. Recorded runs are kept by name per
    post, one per history row. Posts are dealt into ``buckets`` groups, a number that stays for the life of a checkpoint; the rows of a
    group that share a micro-batch are in one task's memory, bounded by the source's ``maxFilesPerTrigger``.

    Python pays per column, so the columns travel as one JSON text, times as microseconds.
    """
    rows = ranked(observations)
    packed = [F.unix_micros(f.name).alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name) for f in OUTPUT.fields[:-1]]
    digests = [digest.alias(f"digest_{column}") for column, digest in zip(TRACKED_COLUMNS, field_digests().values())]
    recorded = (
        rows.select(
            F.pmod(F.xxhash64("ig_media_id"), F.lit(buckets)).alias("bucket"),
            F.col("ig_media_id").alias("post"),
            # Without a time or place a row comes last.
            F.coalesce(F.unix_micros("fetched_at"), F.lit(2**63 - 1)).alias("fetched_at"),
            "sync_run_id",
            F.coalesce("position_overall", F.lit(2**31 - 1)).alias("position_overall"),
            F.to_json(F.struct(*packed)).alias("observation"),
            *digests,
        )
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=RecordChanges(), outputStructType=_RECORDED, outputMode="Append", timeMode="None"
        )
        .select(F.from_json("observation", _PACKED).alias("row"), "changed")
    )
    columns = [
        (F.timestamp_micros(f"row.{f.name}") if f.dataType == T.TimestampType() else F.col(f"row.{f.name}")).alias(f.name)
        for f in OUTPUT.fields[:-1]
    ]
    return recorded.select(*columns, names_of(F.col("changed")).alias("changed_fields"))

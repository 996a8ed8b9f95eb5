"""Change-only history.

Rule: walking the observations of a post in arrival order, a row is recorded when one of the
six tracked fields differs from the last *recorded* row of that post, and the (post, run) pair
has no recorded row yet. A differing second row of the same run is dropped and does not become
the base of later comparisons. This is a fold, not a ``lag``.

How it is spread out. The time line of a post is cut into segments that no run straddles, so
each segment starts with an empty set of recorded runs and depends on the past only through
the last recorded state S. If S differs from the segment's first observation x, that one is
recorded and everything after it is determined; if S equals x it is skipped, and everything
after it is determined as well. A segment therefore has exactly two possible outcomes, which
are folded without knowing S. One small row per (post, segment) then decides which outcome
holds, and a hot post is folded by as many tasks as it has segments. The fold sees keys and a digest
per field only, and tells which fields changed; the recorded rows are fetched afterwards, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.captions import with_caption_arrays
from postlake.functions.scalars import effective_rank, stable_id
from postlake.operators.timeline import carry, closed_segments
from postlake.schemas import OBSERVATION, TRACKED_COLUMNS, TRACKED_FIELDS
from postlake.session import staged

ARRIVAL = ("fetched_at", "sync_run_id", "position_overall")


def ranked(observations: DataFrame) -> DataFrame:
    return observations.withColumn("rank", effective_rank(F.col("source"), F.col("position_overall")))


def changed_names(before: Column) -> Column:
    """Names of the tracked fields that differ from ``before``; all of them without one."""
    flags = [
        F.when(before.isNull() | ~F.col(column).eqNullSafe(before[column]), F.lit(name))
        for column, name in TRACKED_FIELDS
    ]
    return F.filter(F.array(*flags), lambda name: name.isNotNull())


def field_digests() -> dict[str, Column]:
    """One 64-bit digest per tracked field, null being a value."""
    return {f"_d{i}": F.xxhash64(c, F.col(c).isNull()) for i, c in enumerate(TRACKED_COLUMNS)}


def names_of(mask: Column) -> Column:
    """Names of the tracked fields whose bit is set."""
    names = [F.when(mask.bitwiseAND(1 << i) > 0, F.lit(name)) for i, (_, name) in enumerate(TRACKED_FIELDS)]
    return F.filter(F.array(*names), lambda name: name.isNotNull())


_DIGESTS = [f"_d{i}" for i in range(len(TRACKED_COLUMNS))]
_ALL = (1 << len(_DIGESTS)) - 1


def _mask(state: tuple[int, ...], before: tuple[int, ...]) -> int:
    return sum(1 << i for i, (a, b) in enumerate(zip(state, before)) if a != b)


def _plain(column: pa.Array) -> list:
    """The values as Python objects. By way of numpy that is one call a column and not one a value, but it has no null numbers."""
    if column.null_count and not pa.types.is_string(column.type):
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False).tolist()


def _fold_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that either outcome records, with the fields that changed as bits (0: not recorded). Rows arrive sorted by
    (post, segment, arrival), so a segment is never held in memory, only its last state and its recorded runs.

    What changed in the first row that a new start records depends on the segment before; it is filled in later.
    """
    here_post = here_segment = fresh_state = kept_state = None
    fresh_runs: set[str] = set()
    kept_runs: set[str] = set()
    for batch in batches:
        columns = [_plain(batch.column(name)) for name in ("ig_media_id", "_seg", "sync_run_id")]
        states = zip(*[_plain(batch.column(name)) for name in _DIGESTS])
        if_new, if_same = [], []
        for post, segment, run, state in zip(*columns, states):
            if segment != here_segment or post != here_post:
                here_post, here_segment = post, segment
                fresh_state, kept_state = None, state
                fresh_runs, kept_runs = set(), set()
            new = same = 0
            if state != fresh_state and run not in fresh_runs:
                new = _ALL if fresh_state is None else _mask(state, fresh_state)
                fresh_state = state
                fresh_runs.add(run)
            if state != kept_state and run not in kept_runs:
                same = _mask(state, kept_state)
                kept_state = state
                kept_runs.add(run)
            if_new.append(new)
            if_same.append(same)
        new, same = pa.array(if_new, pa.int32()), pa.array(if_same, pa.int32())
        flagged = batch.append_column("_if_new", new).append_column("_if_same", same)
        yield flagged.filter(pa.compute.greater(pa.compute.add(new, same), 0))


def record_changes(
    observations: DataFrame,
    seed: DataFrame | None = None,
    recorded_pairs: DataFrame | None = None,
    width: str = "day",
) -> DataFrame:
    """The observations that enter the history, with ``changed_fields``.

    ``seed`` holds the tracked fields of the newest history row per post, and
    ``recorded_pairs`` the (ig_media_id, sync_run_id) pairs already in the history: together
    they continue an earlier history. A pair already recorded can neither be recorded again
    nor alter the comparison base, so its observations are dropped up front.
    """
    if recorded_pairs is not None:
        observations = observations.join(
            recorded_pairs.select("ig_media_id", "sync_run_id"), ["ig_media_id", "sync_run_id"], "left_anti"
        )
    observations = ranked(observations)
    # Keys, order and digests are all that segments and fold need; texts stay where they are.
    narrow = staged(observations.select("ig_media_id", *ARRIVAL, *[d.alias(name) for name, d in field_digests().items()]), "narrow")
    rows = closed_segments(narrow, "ig_media_id", "sync_run_id", "fetched_at", "_seg", width).withColumn("_seg", F.unix_micros("_seg"))
    flagged = (
        rows.repartition("ig_media_id", "_seg")
        .sortWithinPartitions("ig_media_id", "_seg", *ARRIVAL)
        .mapInArrow(
            _fold_segments,
            T.StructType(list(rows.schema.fields))
            .add("_if_new", T.IntegerType())
            .add("_if_same", T.IntegerType()),
        )
    )
    # Two branches read the fold: it runs once.
    candidates = staged(flagged, "fold")

    # One row per (post, segment): its first state, and where each outcome leaves the post.
    arrival, state = F.struct(*ARRIVAL), F.struct(*_DIGESTS)
    segments = candidates.groupBy("ig_media_id", "_seg").agg(
        F.min_by(state, arrival).alias("first"),
        F.min(F.when(F.col("_if_new") > 0, arrival)).alias("opens"),
        F.max_by(state, F.when(F.col("_if_new") > 0, arrival)).alias("end_new"),
        F.max_by(state, F.when(F.col("_if_same") > 0, arrival)).alias("end_same"),
    )
    segments = segments.withColumn("end_same", F.coalesce("end_same", "first"))
    if seed is not None:
        stored = F.struct(*[d.alias(name) for name, d in field_digests().items()])
        segments = segments.join(seed.select("ig_media_id", stored.alias("seed")), "ig_media_id", "left")
    else:
        segments = segments.withColumn("seed", F.lit(None).cast(T.StructType([T.StructField(d, T.LongType()) for d in _DIGESTS])))
    segments = _choose(segments)

    # A row counts when the outcome it belongs to is the one that holds.
    opening = arrival == F.col("opens")
    changed = F.when(F.col("starts_same"), F.col("_if_same")).when(opening, F.col("opening_mask")).otherwise(F.col("_if_new"))
    held = F.when(F.col("starts_same"), F.col("_if_same")).otherwise(F.col("_if_new")) > 0
    chosen = candidates.join(segments, ["ig_media_id", "_seg"]).filter(held).select("ig_media_id", *ARRIVAL, changed.alias("_changed"))
    # A row that was delivered twice counts once.
    recorded = observations.join(chosen, ["ig_media_id", *ARRIVAL]).dropDuplicates(["ig_media_id", *ARRIVAL])
    return recorded.withColumn("changed_fields", names_of(F.col("_changed"))).select(*observations.columns, "changed_fields")


def _choose(segments: DataFrame) -> DataFrame:
    """Decide per segment whether it starts in its own first state, and what its first row changes if it does not.

    ``starts_same(k)`` is a function of ``starts_same(k-1)`` only: constant, identity or
    negation. Composing those along the post needs the last constant before k and the parity
    of the negations since, which plain windows give.
    """
    along = Window.partitionBy("ig_media_id").orderBy("_seg")
    x = F.col("first")

    def same_after(end: str) -> Column:
        return F.coalesce(F.lag(end).over(along) == x, F.lit(False))

    is_head = F.row_number().over(along) == 1
    seeded = F.coalesce(F.col("seed") == x, F.lit(False))
    out = segments.withColumns(
        {
            "_a": F.when(is_head, seeded).otherwise(same_after("end_same")),
            "_b": F.when(is_head, seeded).otherwise(same_after("end_new")),
        }
    )
    flips = F.when(F.col("_a") == F.col("_b"), 0).otherwise(F.when(F.col("_b"), 1).otherwise(0))
    out = out.withColumn("_flips", F.sum(flips).over(along))
    fixed = F.when(F.col("_a") == F.col("_b"), F.struct(F.col("_a").alias("value"), F.col("_flips").alias("flips")))
    out = out.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(along))
    odd = (F.col("_flips") - F.col("_fixed.flips")) % 2 == 1
    out = out.withColumn("starts_same", F.col("_fixed.value") != odd)
    left = F.lag(F.when(F.col("starts_same"), F.col("end_same")).otherwise(F.col("end_new"))).over(along)
    out = out.withColumn("_before", F.coalesce(left, F.col("seed")))
    bits = [F.when(F.col(f"_before.{d}") == x[d], 0).otherwise(1 << i) for i, d in enumerate(_DIGESTS)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    return out.select("ig_media_id", "_seg", "opens", "starts_same", mask.alias("opening_mask"))


def change_history(
    observations: DataFrame,
    seed: DataFrame | None = None,
    recorded_pairs: DataFrame | None = None,
    width: str = "day",
) -> DataFrame:
    """``media_post_history`` rows for the observations."""
    # The fold is opaque to column pruning, so unused columns are dropped before it.
    narrow = observations.select(*[c for c in OBSERVATION.names if c not in ("media_url", "taken_at")])
    rows = with_caption_arrays(record_changes(narrow, seed, recorded_pairs, width))
    return rows.select(
        stable_id(F.col("ig_media_id"), F.col("sync_run_id")).alias("id"),
        stable_id(F.col("ig_media_id")).alias("media_id"),
        "hashtag_id", "sync_run_id", "ig_media_id", "media_type", "caption", "permalink",
        "caption_hashtags", "caption_mentions", "like_count", "comments_count", "rank", "source",
        "changed_fields", F.col("fetched_at").alias("captured_at"), "position_overall",
    )


def latest_history(history: DataFrame) -> DataFrame:
    """The newest history row per post, as a map-side combined aggregate."""
    newest = F.max_by(F.struct(*history.columns), F.struct("captured_at", "sync_run_id", "position_overall"))
    return history.groupBy("media_id").agg(newest.alias("row")).select("row.*")


def observation_flags(observations: DataFrame, known: DataFrame | None = None, width: str = "day") -> DataFrame:
    """Add ``is_new`` and ``content_changed`` per observation.

    ``first_media_url`` is the file URL of the post's first observation in the batch. Content
    changed when the caption differs from the observation before, or the permalink or type differ
    from the *first* observation: neither is updated once stored. ``known`` are the current
    posts that the observations continue.
    """
    rows = carry(
        ranked(observations), ["ig_media_id"], ARRIVAL,
        previous=["caption"], first=["permalink", "media_type", "media_url"], width=width,
    )
    stored = F.lit(None).cast("struct<caption:string,permalink:string,media_type:string>")
    if known is not None:
        state = known.select("ig_media_id", F.struct("caption", "permalink", "media_type").alias("_stored"))
        rows = rows.join(state, "ig_media_id", "left")
    else:
        rows = rows.withColumn("_stored", stored)
    fresh = F.col("prev").isNull() & F.col("_stored").isNull()
    # Field by field: a missing ``prev`` means the stored row, a null caption is a value.
    caption = F.when(F.col("prev").isNull(), F.col("_stored.caption")).otherwise(F.col("prev.caption"))

    def kept(name: str) -> Column:
        return F.when(F.col("_stored").isNotNull(), F.col(f"_stored.{name}")).otherwise(F.col(f"head.{name}"))

    changed = ~(
        F.col("caption").eqNullSafe(caption)
        & F.col("permalink").eqNullSafe(kept("permalink"))
        & F.col("media_type").eqNullSafe(kept("media_type"))
    )
    return rows.withColumns(
        {"is_new": fresh, "content_changed": ~fresh & changed, "first_media_url": F.col("head.media_url")}
    ).drop("prev", "head", "_stored")

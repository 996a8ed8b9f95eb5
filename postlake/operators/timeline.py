"""Per-key time-line operators that survive a hot key.

A window partitioned by the key alone sends every row of a hot key through one task. Here
the key's time line is cut into slots (hours, days); rows are windowed per (key, slot), and
only one summary row per (key, slot) is ordered across the whole key. The summary grows with
elapsed time, not with the number of rows, so a key that holds a third of a table spreads
over as many tasks as it has slots.

The first ordering column must be the slotted timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT = "_slot"


def slot_of(at: str, width: str = "day") -> Column:
    return F.date_trunc(width, F.col(at))


def carry(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Sequence[str] = (),
    first: Sequence[str] = (),
    width: str = "day",
) -> DataFrame:
    """Add ``prev`` (struct of ``previous`` columns of the row before, null on the first row)
    and ``head`` (struct of ``first`` columns of the key's first row)."""
    keys, order = list(keys), list(order)
    slotted = df.withColumn(SLOT, slot_of(order[0], width))
    rank = F.struct(*order)

    summary = [F.max_by(F.struct(*previous), rank).alias("_last")] if previous else []
    summary += [F.min_by(F.struct(*first), rank).alias("_first")] if first else []
    slots = slotted.groupBy(*keys, SLOT).agg(*summary)

    across = Window.partitionBy(*keys).orderBy(SLOT)
    carried = [F.lag("_last").over(across).alias("_carried")] if previous else []
    carried += [F.first("_first").over(across).alias("head")] if first else []
    slots = slots.select(*keys, SLOT, *carried)

    out = slotted
    if previous:
        within = Window.partitionBy(*keys, SLOT).orderBy(*order)
        out = out.withColumn("_before", F.lag(F.struct(*previous)).over(within))
    out = out.join(slots, [*keys, SLOT], "left")
    if previous:
        out = out.withColumn("prev", F.coalesce("_before", "_carried")).drop("_before", "_carried")
    return out.drop(SLOT)


def running_total(df: DataFrame, at: str, amount: str, alias: str, width: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    """Sum of ``amount`` over all rows of the same ``keys`` at or before each row's ``at`` (ties included)."""
    keys = list(keys)
    slotted = df.withColumn(SLOT, slot_of(at, width))
    totals = slotted.groupBy(*keys, SLOT).agg(F.sum(amount).alias("_slot_sum"))
    # One row per slot: without keys the only unpartitioned window, bounded by elapsed time.
    before = Window.partitionBy(*keys).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, SLOT, F.coalesce(F.sum("_slot_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys, SLOT).orderBy(at).rangeBetween(Window.unboundedPreceding, 0)
    return (
        slotted.withColumn("_inner", F.sum(amount).over(within))
        .join(totals, [*keys, SLOT])
        .withColumn(alias, F.col("_base") + F.col("_inner"))
        .drop(SLOT, "_base", "_inner")
    )


def closed_segments(
    df: DataFrame, key: str, group: str, at: str, alias: str = "segment", width: str = "day"
) -> DataFrame:
    """Add the start of the row's time segment, such that all rows of one (key, group) share a segment and
    segments of a key follow each other in time.

    A segment is a slot, cut where no group is running: groups that still run at a slot's start, and whatever overlaps
    them to the microsecond, belong to the slot before; the rest of the slot is a segment of its own. Only groups that
    straddle a slot's start and the slots they reach into are looked at closely, one key and slot per window. Without
    straddlers those tables are empty and AQE drops their joins.
    """
    step = F.expr(f"INTERVAL 1 {width}")
    spans = df.groupBy(key, group).agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    spans = spans.withColumns({"in": F.date_trunc(width, "lo"), "out": F.date_trunc(width, "hi")})
    straddlers = spans.filter(F.col("in") < F.col("out"))
    # Per key and slot that begins under a running group: until when it runs.
    reached = straddlers.select(key, F.explode(F.sequence(F.col("in") + step, F.col("out"), step)).alias("in"), "hi")
    reached = reached.groupBy(key, "in").agg(F.max("hi").alias("until"))
    by_start = Window.partitionBy(key, "in").orderBy("lo")
    ahead = F.max("hi").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("lo") > F.greatest(F.col("until"), ahead)
    inside = spans.join(reached, [key, "in"]).withColumn("opens", opens)
    free = F.max(F.col("opens").cast("int")).over(by_start.rowsBetween(Window.unboundedPreceding, 0)) == 1
    inside = inside.withColumn("free", free)
    # The segment that runs into a reached slot starts in the slot before, unless nothing opened there either.
    freed = inside.filter("free").select(key, "in").distinct().withColumn("has_free", F.lit(True))
    along = Window.partitionBy(key).orderBy("in")
    before = F.lag("in").over(along) == F.col("in") - step
    closed = before & F.lag("has_free").over(along).isNull()
    origin = reached.join(freed, [key, "in"], "left")
    origin = origin.withColumn("base", F.when(~F.coalesce(closed, F.lit(False)), F.col("in") - step))
    origin = origin.select(key, F.col("in").alias("_in"), F.last("base", ignorenulls=True).over(along).alias("_origin"))
    tied = inside.filter(~F.col("free")).select(key, group, "in")
    # Straddlers, and what is tied to one, do not belong to the slot of each of their rows.
    moved = straddlers.select(key, group, "in").join(tied.withColumn("_tied", F.lit(True)), [key, group, "in"], "full_outer")
    moved = moved.join(origin.withColumnsRenamed({key: "_key"}), (F.col(key) == F.col("_key")) & (F.col("in") == F.col("_in")), "left")
    moved = moved.select(key, group, F.when(F.col("_tied"), F.col("_origin")).otherwise(F.col("in")).alias("_start"))
    return df.join(moved, [key, group], "left").withColumn(alias, F.coalesce("_start", slot_of(at, width))).drop("_start")

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.session import staged

# Fixed value: what counts as a word everywhere here, every run of bytes outside the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8. ``bytes.split`` cuts at the six ASCII blanks and at nothing else."""
    return text.encode("utf-8", "replace").split() if text else []


def n_words(column) -> F.Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def lowest_hashes(rows: DataFrame, n: int, total: int, *columns: str) -> DataFrame:
    """About the ``n`` rows with the lowest hash of ``columns``, out of ``total``.

    Rows whose hash is far above the n-th lowest are left out before the sort, so what the tasks send to be sorted is
    bounded by ``n`` and does not grow with their number.
    """
    place = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    edge = int(min(1.0, (2 * n + 1000) / max(total, 1)) * (1 << 53))
    return rows.filter(place < edge).orderBy(place, *columns).limit(n)


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut small, so that few texts at a time are Python objects."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows sorted by ``keys``, cut so that no group is split: a table and the bounds of its groups.

    For tasks with very many small groups, where a call per group would cost more than its work.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for key in keys:
            values = table[key].to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(change).tolist()
        if len(cuts) > 1:
            yield table.slice(0, cuts[-1]), cuts
        held = table.slice(cuts[-1])
    if held is not None:
        yield held, [0, held.num_rows]


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Lowest position reachable from each of ``n`` positions over the links."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    return root


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(src, dst)``: one row per node with the smallest node it reaches.

    Alternates the large-star and small-star steps until nothing moves, so the number of rounds grows with
    the logarithm of the longest path. Every round only takes minima per node (combined before the shuffle)
    and joins them back, so a node with very many links is never gathered in one task; the join's two sides are
    plain shuffles that adaptive execution splits. Rounds are cut by written tables. Self links and nulls are ignored.
    """
    pairs = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    pairs = staged(pairs.filter("u != v and u is not null and v is not null").distinct(), label)
    seen = None
    while True:
        mark = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or mark[0] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                pairs.select("v", "v").distinct()
            )
        seen = mark
        both = pairs.union(pairs.select("v", "u"))
        lows = staged(both.groupBy("u").agg(F.min("v").alias("low")), label)
        lows = lows.select(F.col("u").alias("k"), F.least("u", "low").alias("low"))
        # Large star: larger neighbours move to the smallest neighbour.
        large = both.filter("v > u").join(lows, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = staged(large.filter("u != v").distinct(), label)
        # Small star: a node and its smaller neighbours move to the smallest of them.
        lows = staged(large.groupBy("u").agg(F.min("v").alias("low")), label).withColumnRenamed("u", "k")
        small = large.join(lows, F.col("u") == F.col("k")).filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        pairs = staged(small.union(lows.select(F.col("k"), F.col("low"))).filter("u != v").distinct(), label)

"""Near-duplicate captions by SimHash fingerprints, compared exactly tile against tile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import components, forest, in_parts, words_of
from postlake.session import staged

SHINGLE = 4
RADIUS = 4
# Fixed value: the seed of the shingle hash.
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits of a text: a bit is 1 if it is set in over half of the hashes of its word shingles."""
    words = words_of(text)
    if not words:
        return 0
    line = b" ".join(words).lower()  # of bytes: A-Z only
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones, step = np.zeros(64, np.int64), 1 << 14
    for low in range(0, n, step):  # keeps a very long text's bit table small
        hi = min(n, low + step)
        last = ends[low + shingle - 1 : hi + shingle - 1] if len(words) >= shingle else ends[-1:]
        hashes = np.fromiter(
            (digest(line[a:b], SEED) for a, b in zip(starts[low:hi].tolist(), last.tolist())), np.uint64, hi - low
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        prints = np.array([fingerprint(t, shingle) for t in batch["caption"].to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(prints)], names=["id", "fp"])


def _links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` of all pairs that differ in at most ``radius`` bits.

    Both sides are cut again into runs of equal population counts of the two halves of a fingerprint. Half
    counts differ by no more than the bits do, so most pairs of runs are skipped without looking at them.
    """
    def runs(x):
        low = np.bitwise_count(x & np.uint64(0xFFFFFFFF)).astype(np.int64)
        high = np.bitwise_count(x >> np.uint64(32)).astype(np.int64)
        key = low * 64 + high
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        return order, keys, [*first.tolist(), len(x)]

    (oa, ka, fa), (ob, kb, fb) = runs(a), runs(b)
    left, right = [], []
    for i, k in enumerate(ka):
        near = np.abs(kb // 64 - k // 64) + np.abs(kb % 64 - k % 64) <= radius
        for j in np.flatnonzero(near):
            ra, rb = oa[fa[i] : fa[i + 1]], ob[fb[j] : fb[j + 1]]
            step = max(1, (1 << 20) // len(rb))
            for low in range(0, len(ra), step):
                part = ra[low : low + step]
                p, q = np.nonzero(np.bitwise_count(a[part][:, None] ^ b[rb][None, :]) <= radius)
                if len(p):
                    left.append(part[p])
                    right.append(rb[q])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _compare(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Fewest links that connect what two tiles have in common: at most one per fingerprint of the pair."""
    for frame in frames:
        for a, b in zip(frame["a"], frame["b"]):
            a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
            left, right = _links(a.view(np.uint64), b.view(np.uint64), radius)
            root = forest(left, right + len(a), len(a) + len(b))
            both, moved = np.concatenate((a, b)), np.flatnonzero(root != np.arange(len(root)))
            found = pd.DataFrame({"src": both[moved], "dst": both[root[moved]]})
            yield found[found.src != found.dst].drop_duplicates()


def simhash_duplicates(posts: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = 8192) -> DataFrame:
    """Group the captions of posts whose fingerprints differ in at most ``radius`` bits.

    Reads ``id`` and ``caption`` of media posts, whole texts. A caption's A-Z are lower-cased, its words joined into
    shingles of ``shingle`` words (repeats count; fewer words make one shingle, none the fingerprint zero).
    Equal fingerprints are one class, so copies never meet in pairs. Classes are filed by the population counts of their
    fingerprints into tiles of about ``tile``; a count's fingerprints are spread evenly over as many tiles as they
    need. Two tiles whose counts differ by more than ``radius`` cannot hold a pair and are skipped; all others are
    compared exactly with numpy, exclusive-or and bit counts. A tile pair returns links that connect what it found,
    at most one per fingerprint, and no link between different groups is lost. The compared pairs grow with the
    square of the number of distinct fingerprints, as in any exhaustive comparison.

    Returns one row per row of ``posts``: ``id``, ``fp`` (the 64 bits as a signed long), ``component_id`` (smallest id
    in the group) and ``kept`` (the row holds that id). Null and empty captions have the fingerprint zero, which
    links like any other. A null id is in its fingerprint's group and never its smallest; a fingerprint
    that only posts without id have links nothing. Repeated rows give repeated results. An empty table gives an empty result.
    """
    kind = posts.schema["id"].dataType.simpleString()
    prints = posts.select("id", "caption").mapInArrow(lambda b: _fingerprints(b, shingle), f"id {kind}, fp long")
    prints = staged(prints, "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("id").alias("lowest")).withColumn("ones", F.bit_count("fp"))
    classes = staged(classes, "fingerprint-classes")
    # At most 65 rows: how many tiles each population count needs.
    counts = classes.groupBy("ones").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    counts = F.broadcast(counts.withColumnRenamed("ones", "o"))
    spread = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int")
    tiles = classes.join(counts, F.col("ones") == F.col("o")).withColumn("part", spread)
    tiles = staged(tiles.groupBy("ones", "part").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "tiles")
    here = tiles.select("ones", "part")
    there = here.select(F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)).alias("near"), "ones", "part")
    other = here.select(F.col("ones").alias("near"), F.col("part").alias("part_b"))
    pairs = there.join(other, "near").filter("near > ones or part_b >= part")
    left = tiles.select("ones", "part", F.col("fps").alias("a"))
    right = tiles.select(F.col("ones").alias("near"), F.col("part").alias("part_b"), F.col("fps").alias("b"))
    # Contents are attached last, and pairs are dealt evenly to a fixed number of tasks: they are small but costly.
    met = pairs.join(left, ["ones", "part"]).join(right, ["near", "part_b"])
    tasks = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(tasks, "ones", "part", "near", "part_b").select("a", "b")
    links = staged(met.mapInPandas(lambda frames: _compare(frames, radius), "src long, dst long"), "simhash-links")
    # From here on a class goes by its smallest id, so a component's smallest node is its smallest id.
    by_id = links.join(classes.select(F.col("fp").alias("src"), F.col("lowest").alias("p")), "src")
    by_id = by_id.join(classes.select(F.col("fp").alias("dst"), F.col("lowest").alias("q")), "dst")
    groups = components(by_id.select(F.col("p").alias("src"), F.col("q").alias("dst")), "simhash-components")
    member = classes.join(groups, F.col("lowest") == F.col("node"), "left")
    final = member.select(F.col("fp").alias("f"), F.coalesce("component", "lowest").alias("component_id"))
    final = staged(final, "simhash-groups")
    return prints.join(final, F.col("fp") == F.col("f")).select(
        "id", "fp", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )

"""Toxic captions: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import in_parts, lowest_hashes
from postlake.session import staged

ORDERS = (4, 5, 6)
BITS = 20
# The classifier is fitted on at most so many labelled posts of each class, and on so many of their characters.
SAMPLE_PER_CLASS = 10_000
CHARS_PER_CLASS = 12_000_000
# Posts whose id hashes to 0 modulo FOLDS are never learned from.
FOLDS = 5

_SLICES = 64
_U = np.uint32


class Model(NamedTuple):
    bias: float
    features: np.ndarray  # hashed n-grams, ascending
    weights: np.ndarray  # log-count ratio times fitted coefficient


def _grams(texts: list[str | None]) -> list[np.ndarray]:
    """Hashed n-grams of each text, repeats included, in lower case with blanks as single spaces."""
    padded = [f" {' '.join((text or '').lower().split())} " for text in texts]
    lengths = np.array([len(p) for p in padded], np.int64)
    flat = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), "<u4")
    mixed = flat * _U(0x9E3779B1)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))  # characters up to the end of the text
    owner = np.repeat(np.arange(len(texts)), lengths)
    h = np.zeros(len(flat), _U)
    owners, hashes = [], []
    # A longer n-gram's hash goes on from that of its first characters.
    for j in range(max(ORDERS)):
        if len(flat) <= j:
            break
        h = (h[: len(flat) - j] ^ mixed[j:]) * _U(0x85EBCA6B)
        h ^= h >> _U(15)
        if j + 1 in ORDERS:
            inside = left[: len(h)] > j
            owners.append(owner[: len(h)][inside])
            hashes.append((h[inside] * _U(0xC2B2AE35) >> _U(32 - BITS)).astype(np.int32))
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for own, hashed in zip(owners, hashes):
        for k, part in enumerate(np.split(hashed, np.searchsorted(own, np.arange(1, len(texts))))):
            out[k].append(part)
    return [np.concatenate(parts) if parts else np.empty(0, np.int32) for parts in out]


def _parts(batches: Iterator[pa.RecordBatch], chars: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches cut so that a part holds about ``chars`` characters, or one text."""
    for batch in in_parts(batches):
        texts, low, size = batch["caption"].to_pylist(), 0, 0
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= chars:
                yield batch.slice(low, k + 1 - low), texts[low : k + 1]
                low, size = k + 1, 0
        if low < len(texts):
            yield batch.slice(low), texts[low:]


class _Once:
    """Drops repeats within a text: every n-gram notes where it stands, and the last note of each stays."""

    def __init__(self) -> None:
        self.last = np.empty(1 << BITS, np.int32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        places = np.arange(len(grams), dtype=np.int32)
        self.last[grams] = places
        return grams[self.last[grams] == places]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of either class each hashed n-gram occurs, in slices."""
    counts = np.zeros((2, 1 << BITS), np.int32)
    seen = np.zeros(2, np.int64)
    once = _Once()
    for batch, texts in _parts(batches):
        for toxic, grams in zip(batch["toxic"].to_pylist(), _grams(texts)):
            counts[toxic, once(grams)] += 1
            seen[toxic] += 1
    if seen.any():
        cut = counts.reshape(2, _SLICES, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(_SLICES)), pa.array([cut[:, s].tobytes() for s in range(_SLICES)], pa.binary()), pa.array(np.full(_SLICES, seen[0])), pa.array(np.full(_SLICES, seen[1]))],
            names=["slice", "counts", "clean", "toxic"],
        )


def _ratios(frame: pd.DataFrame) -> pd.DataFrame:
    """Log-count ratio of every n-gram of a slice, NaN for those that no text holds, packed."""
    clean, toxic = np.sum([np.frombuffer(b, np.int32).reshape(2, -1) for b in frame["counts"]], axis=0)
    n_clean, n_toxic = frame["clean"].sum(), frame["toxic"].sum()
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((clean + 1) / (n_clean + 2))
    ratio[clean + toxic == 0] = np.nan
    return pd.DataFrame({"slice": [frame["slice"].iloc[0]], "ratios": [ratio.tobytes()]})


def _marks(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of all texts end to end, where each text begins, and the texts' classes. They are held once, in a
    buffer that grows in place."""
    once, marks, lengths, toxic = _Once(), bytearray(), [], []
    for batch, texts in _parts(batches):
        for grams in _grams(texts):
            own = np.sort(once(grams)).astype("<i4")
            marks += own.tobytes()
            lengths.append(len(own))
        toxic += batch["toxic"].to_pylist()
    return np.frombuffer(marks, "<i4"), np.cumsum([0, *lengths])[:-1], np.array(toxic, np.int64)


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, turns: int, kept: int = 5) -> np.ndarray:
    """Limited-memory BFGS: ``loss`` gives value and gradient. Stops when a turn gains next to nothing."""
    value, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(turns):
        direction, parts = slope.copy(), []
        for s, y, r in reversed(steps):
            a = r * float(s @ direction)
            parts.append(a)
            direction -= a * y
        if steps:
            s, y, r = steps[-1]
            direction *= 1 / (r * float(y @ y))
        for (s, y, r), a in zip(steps, reversed(parts)):
            direction += (a - r * float(y @ direction)) * s
        fall, rate = float(slope @ direction), 1.0 if steps else 1.0 / max(float(np.abs(slope).max()), 1e-12)
        if fall <= 0:
            break
        while True:
            moved = x - rate * direction
            new_value, new_slope = loss(moved)
            if new_value <= value - 1e-4 * rate * fall or rate < 1e-10:
                break
            rate /= 2
        s, y = moved - x, new_slope - slope
        curve = float(s @ y)
        if curve > 1e-12:
            steps = [*steps[1 - kept :], (s, y, 1 / curve)] if kept > 1 else [(s, y, 1 / curve)]
        gained = value - new_value
        x, value, slope = moved, new_value, new_slope
        if gained < 1e-5 * abs(value):
            break
    return x


def logistic_loss(at: np.ndarray, begins: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ratio: np.ndarray, ridge: float):
    """Loss of a ridge logistic regression on ratio-scaled marks, and its slope, as a function of coefficients and, last, the
    bias. ``at`` holds the texts' marks end to end, text k from ``begins[k]`` on. Marks are read in stretches of texts, so what is
    computed beside them stays small."""
    cuts = [0, *range(256, len(begins), 256), len(begins)]
    ends = np.append(begins, len(at))
    sign = np.where(toxic > 0, 1.0, -1.0)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        scaled = theta[:-1] * ratio
        slope, value = np.zeros(len(ratio)), 0.0
        bias_slope = 0.0
        for low, high in zip(cuts[:-1], cuts[1:]):
            here = at[ends[low] : ends[high]]
            if high == low:
                continue
            lengths = np.diff(ends[low : high + 1])
            sums = np.zeros(high - low)
            held = np.flatnonzero(lengths)
            if len(held):
                sums[held] = np.add.reduceat(scaled[here], (ends[low:high] - ends[low])[held])
            margin = sign[low:high] * (sums + theta[-1])
            value += float((weight[low:high] * np.logaddexp(0, -margin)).sum())
            pull = -sign[low:high] * weight[low:high] / (1 + np.exp(np.clip(margin, -500, 500)))
            slope += np.bincount(here, np.repeat(pull, lengths), len(ratio))
            bias_slope += float(pull.sum())
        slope = slope * ratio + ridge * theta[:-1]
        return value + ridge / 2 * float(theta @ theta), np.append(slope, bias_slope + ridge * theta[-1])

    return loss


def _fit(batches: Iterator[pa.RecordBatch], ratio: np.ndarray, share: dict[int, int], ridge: float, passes: int) -> Iterator[pa.RecordBatch]:
    """Ridge logistic regression on the ratio-scaled marks of texts. Gives, packed, the weight per n-gram and, last, the bias, which
    is the weight of a mark that every text has. Texts come in the order of ``place``, so the result does not depend on how they
    were dealt out."""
    at, begins, toxic = _marks(batches)
    n = [int((toxic == c).sum()) for c in (0, 1)]
    theta = np.zeros(len(ratio) + 1)
    if min(n):
        top = np.array([share[c] / n[c] * len(toxic) / (share[0] + share[1]) for c in (0, 1)])
        theta = minimise(logistic_loss(at, begins, toxic, top[toxic], ratio, ridge * len(toxic)), theta, passes)
        theta[:-1] *= ratio
    else:
        theta[-1] = 60.0 if n[1] else -60.0
    yield pa.RecordBatch.from_arrays([pa.array([theta.tobytes()])], names=["theta"])


def held_out(post_id) -> F.Column:
    return F.coalesce(F.crc32(post_id.cast("string")) % FOLDS == 0, F.lit(False))


def _sample(posts: DataFrame, usable: DataFrame, shares: dict[int, int], per_class: int, chars: int) -> DataFrame:
    """Labelled texts for the fit: ``place``, ``caption``, ``toxic``. Of each class those with the lowest hashes of id and text, each
    text of an id once, until ``per_class`` texts or ``chars`` characters are reached."""
    drawn = [lowest_hashes(usable.filter(F.col("toxic") == c), per_class, shares[c], "id") for c in (0, 1)]
    found = posts.select("id", "caption").join(F.broadcast(drawn[0].union(drawn[1])), "id")
    size = F.length(F.coalesce("caption", F.lit("")))
    found = staged(found.select(F.xxhash64("id", "caption").alias("place"), "caption", "toxic", size.alias("size")), "labelled-texts")
    # An id may have very many rows, so the rows are bounded again, and then by what they hold.
    narrow = found.groupBy("toxic", "place").agg(F.max("size").alias("size"))
    rows = dict(narrow.groupBy("toxic").count().collect())
    kept = [lowest_hashes(narrow.filter(F.col("toxic") == c), per_class, n, "place") for c, n in sorted(rows.items())]
    if not kept:
        return found.drop("size")
    narrow = kept[0] if len(kept) == 1 else kept[0].union(kept[1])
    before = Window.partitionBy("toxic").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    narrow = narrow.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).filter(F.col("before") < chars)
    return found.join(F.broadcast(narrow.select("toxic", "place")), ["toxic", "place"]).dropDuplicates(["toxic", "place"]).drop("size")


def train_toxicity(
    posts: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, chars: int = CHARS_PER_CLASS, ridge: float = 1e-5, passes: int = 40
) -> Model:
    """Fit the classifier on labelled posts.

    ``posts``: ``id`` and ``caption`` of media posts; ``labels``: ``id`` and ``toxic`` (0 or 1). Labels of the held-out fold, null
    ids and null labels are left out; of several labels of a post the highest counts. The fit uses at most
    ``per_class`` texts and, but for the last text, ``chars`` characters of either class, those with the lowest hashes; these documented
    bounds are what makes it safe to send the sample's ids to all tasks and the sample to one task, which holds its
    marks (hashed n-grams), at most three per character, once, and of its texts a batch at a time. Of rows that share an id and its text one is used.
    Classes are weighted back to their share among all labels of the fold.

    A text is the set of its hashed character n-grams of 4 to 6 characters. Every n-gram of the sample is scaled by its log-count
    ratio, the logarithm of how much more often it occurs in toxic texts; none is left out. A logistic regression is fitted on
    the ratios of the n-grams present, and its ridge term shrinks those that tell little.

    Without labels of both classes the model is a constant: the share of toxic labels, 0 without any.
    """
    usable = labels.filter("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    usable = usable.filter(~held_out(F.col("id"))).select("id", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))
    usable = staged(usable, "labels")
    shares = dict(usable.groupBy("toxic").count().collect())
    if len(shares) < 2:
        return Model(60.0 if shares.get(1) else -60.0, np.empty(0, np.int64), np.empty(0))
    # Dealt to few tasks, as a count table is made per task.
    texts = staged(_sample(posts, usable, shares, per_class, chars).repartition(16), "sample")
    counted = texts.mapInArrow(_count, "slice long, counts binary, clean long, toxic long")
    ratios = counted.groupBy("slice").applyInPandas(_ratios, "slice long, ratios binary").collect()
    # Packed, as the driver would hold very many rows otherwise.
    ratios = np.frombuffer(b"".join(bytes(row["ratios"]) for row in sorted(ratios, key=lambda row: row["slice"])), np.float64)
    if not len(ratios):
        return Model(60.0 if shares[1] > shares[0] else -60.0, np.empty(0, np.int64), np.empty(0))
    ratio = np.nan_to_num(ratios)
    # One task fits the bounded sample. It makes the marks itself: they are many times its texts, and would be in memory several
    # times on their way from another worker.
    ordered = texts.select("place", "toxic", "caption").coalesce(1).sortWithinPartitions("place", "toxic")
    fitted = ordered.mapInArrow(lambda b: _fit(b, ratio, shares, ridge, passes), "theta binary")
    theta = np.frombuffer(bytes(fitted.first()["theta"]), np.float64)
    features = np.flatnonzero(~np.isnan(ratios))
    return Model(float(theta[-1]), features, theta[features])


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    weights = np.zeros(1 << BITS, np.float32)
    weights[model.features] = model.weights
    once = _Once()
    for batch, texts in _parts(batches):
        margin = model.bias + np.array([weights[once(grams)].sum(dtype=np.float64) for grams in _grams(texts)])
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(1 / (1 + np.exp(-np.clip(margin, -60, 60))))], names=["id", "score"])


def score_rows(rows: DataFrame, model: Model) -> DataFrame:
    """``id`` of any type and ``score`` of the ``caption`` of every row, in place."""
    schema = T.StructType().add("id", rows.schema["id"].dataType).add("score", T.DoubleType())
    return rows.select("id", "caption").mapInArrow(lambda b: _score(b, model), schema)


def score_toxicity(posts: DataFrame, model: Model) -> DataFrame:
    """Score whole captions: ``id``, ``held_out``, ``score`` (0 to 1, higher is likelier toxic) and ``predicted`` (1 from 0.5).

    One row per row of ``posts``, repeated rows included; rows are not shuffled. Null and empty captions get the score of
    a text without any of the model's n-grams. A null id is not held out.
    """
    scored = score_rows(posts, model)
    return scored.select("id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

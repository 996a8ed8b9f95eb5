"""Quality of captions: lines labelled content or boilerplate by a linear-chain conditional random field."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import in_parts, lowest_hashes
from postlake.session import staged

# The base rules.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW, FEWEST_WORDS, MOST_REPEATED = 8, 20, 30
# The field is fitted on at most so many labelled posts of each class, and on so many lines of each, evenly spaced.
SAMPLE_PER_CLASS, SAMPLE_LINES = 2_500, 32
# A caption is kept if content lines hold at least this share of its words.
CONTENT_SHARE = 0.5
FOLDS = 5

_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[list(SYMBOLS.encode())] = True
_ENDS, _STOPS = frozenset(b".!?:;,\"')"), frozenset(b".,;:!?")
# Kinds of bytes: 1 symbols, 2 digits, 3 capitals A-Z, 4 blanks.
_KINDS = np.zeros(256, np.int64)
_KINDS[list(SYMBOLS.encode())] = 1
_KINDS[48:58] = 2
_KINDS[65:91] = 3
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
# Upper bounds of the bins that a line's figures fall into.
_BINS = (
    ("words", (1, 2, 4, 8, 16, 32, 64, 128)),
    ("symbols_per_word", (0.0, 0.02, 0.05, 0.1, 0.25, 0.5, 1.0)),
    ("repeated_next", (0.0, 0.02, 0.05, 0.1, 0.25, 0.5)),
    ("distinct", (0.1, 0.25, 0.4, 0.55, 0.7, 0.85, 0.95)),
    ("digits", (0.0, 0.01, 0.05, 0.1, 0.3)),
    ("word_length", (2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 15.0)),
    ("stops_per_word", (0.0, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3)),
    ("upper", (0.0, 0.02, 0.05, 0.1, 0.2, 0.5)),
    ("seen_before", (0.0,)),
    ("ends_sentence", (0.0,)),
    ("starts_upper", (0.0,)),
)
_OFFSETS = np.cumsum([0] + [len(bounds) + 1 for _, bounds in _BINS])
N_FEATURES = int(_OFFSETS[-1])


class Field(NamedTuple):
    """Scores of a line's bins for boilerplate (0) and content (1), of neighbours and of the first line."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray


def line_figures(line: bytes, words: list[bytes], seen: bool) -> tuple:
    """Figures of a line with words."""
    n = len(words)
    codes = np.frombuffer(line, np.uint8)
    kinds = np.bincount(_KINDS[codes], minlength=5)
    letters = len(line) - int(kinds[4])
    first, last = words[0][0], words[-1][-1]
    return (
        n, kinds[1] / n, sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n, kinds[2] / letters, letters / n,
        sum(w[-1] in _STOPS for w in words) / n, kinds[3] / letters, seen, last in _ENDS, 65 <= first <= 90 or first >= 0xC3,
    )


def line_bins(figures: list[tuple]) -> np.ndarray:
    """One bin per figure of every line."""
    table = np.array(figures, np.float64).reshape(-1, len(_BINS))
    return np.stack([offset + np.searchsorted(bounds, table[:, k]) for k, (offset, (_, bounds)) in enumerate(zip(_OFFSETS, _BINS))], axis=1)


def base_figures(text: str | None) -> tuple[dict, list[tuple[bytes, list[bytes], bool]]]:
    """Counts of the base rules over a whole text, and its lines with words: bytes, words, seen before."""
    raw = (text or "").encode("utf-8", "replace")
    lines, seen, repeats = [], set(), 0
    for line in raw.split(b"\n"):
        words = line.split()
        if words:
            again = line in seen
            repeats += again
            seen.add(line)
            lines.append((line, words, again))
    words = raw.split()
    joined = b"".join(words)
    codes = np.frombuffer(joined, np.uint8)
    figures = {
        "n_words": len(words), "word_chars": int(((codes & 0xC0) != 0x80).sum()), "n_symbols": int(_SYMBOL_BYTES[np.frombuffer(raw, np.uint8)].sum()),
        "n_dup_lines": repeats, "n_repeat_words": repeated_words(words),
    }
    return figures, lines


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of words which the text holds twice or more, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    # Words by number, windows by number of their halves: equal numbers are equal words, nothing is hashed.
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    width = 1
    while width < window:
        both = codes[: len(codes) - width] * (int(codes.max()) + 1) + codes[width:]
        codes = np.unique(both, return_inverse=True)[1].astype(np.int64)
        width *= 2
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, np.flatnonzero(twice), 1)
    np.add.at(marks, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def viterbi(scores: np.ndarray, field: Field) -> np.ndarray:
    """Best labels of a line sequence. On a tie content stays."""
    (m00, m01), (m10, m11) = field.move.tolist()
    rows = scores.tolist()
    b0, b1 = rows[0][0] + float(field.start[0]), rows[0][1] + float(field.start[1])
    back = []
    for s0, s1 in rows[1:]:
        to0, to1 = b1 + m10 >= b0 + m00, b1 + m11 >= b0 + m01
        back.append((to0, to1))
        b0, b1 = (b1 + m10 if to0 else b0 + m00) + s0, (b1 + m11 if to1 else b0 + m01) + s1
    label = b1 >= b0
    labels = [label]
    for step in reversed(back):
        label = step[label]
        labels.append(label)
    return np.array(labels[::-1], np.int64)


def held_out(post_id) -> F.Column:
    return F.coalesce(F.crc32(post_id.cast("string")) % FOLDS == 0, F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        rows = []
        for text in batch["caption"].to_pylist():
            _, lines = base_figures(text)
            # Neighbours stay neighbours: a stretch of lines, from a place that the text itself decides.
            begin = zlib.crc32((text or "").encode("utf-8", "replace")) % max(len(lines) - SAMPLE_LINES + 1, 1)
            rows.append(line_bins([line_figures(*line) for line in lines[begin : begin + SAMPLE_LINES]]).reshape(-1).tolist())
        yield pa.RecordBatch.from_arrays([batch["quality"], pa.array(rows, pa.list_(pa.int16()))], names=["quality", "features"])


def _fit(sequences: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, ridge: float, steps: int) -> Field:
    """Maximum likelihood by forward and backward sums over all sequences at once, with Adam.

    Lines of a good post are taken for content, of a bad one for boilerplate.
    """
    lengths = np.array([len(s) for s in sequences])
    longest = int(lengths.max())
    grid = np.full((len(sequences), longest, len(_BINS)), N_FEATURES, np.int64)
    for row, s in zip(grid, sequences):
        row[: len(s)] = s
    inside = np.arange(longest)[None] < lengths[:, None]
    truth = np.zeros((len(sequences), longest, 2))
    truth[np.arange(len(sequences)), :, labels] = 1
    theta = np.zeros((N_FEATURES + 1) * 2 + 6)
    m, v, total = np.zeros_like(theta), np.zeros_like(theta), (weight * lengths).sum()
    w = weight[:, None, None] * inside[..., None]
    for turn in range(1, steps + 1):
        emit, move, start = theta[:-6].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:]
        scores = emit[grid].sum(axis=2)
        forward, backward = np.zeros((len(sequences), longest, 2)), np.zeros((len(sequences), longest, 2))
        forward[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            reach = np.logaddexp(forward[:, t - 1, 0, None] + move[0], forward[:, t - 1, 1, None] + move[1]) + scores[:, t]
            forward[:, t] = np.where(inside[:, t, None], reach, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = backward[:, t + 1] + scores[:, t + 1]
            reach = np.logaddexp(move[:, 0] + ahead[:, 0, None], move[:, 1] + ahead[:, 1, None])
            backward[:, t] = np.where(inside[:, t + 1, None], reach, 0.0)
        log_z = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        marginal = np.exp(forward + backward - log_z[:, None, None])
        error = (marginal - truth) * w
        g_emit = np.stack([np.bincount(grid.reshape(-1), np.repeat(error[..., c].reshape(-1), len(_BINS)), N_FEATURES + 1) for c in (0, 1)], axis=1)
        pair = np.exp(
            forward[:, :-1, :, None] + move + (scores + backward)[:, 1:, None, :] - log_z[:, None, None, None]
        ) - truth[:, :-1, :, None] * truth[:, 1:, None, :]
        g_move = (pair * w[:, 1:, :, None]).sum(axis=(0, 1))
        gradient = np.concatenate((g_emit.reshape(-1), g_move.reshape(-1), error[:, 0].sum(axis=0))) / total + ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= 0.05 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-9)
    return Field(theta[:-6].reshape(-1, 2)[:N_FEATURES], theta[-6:-2].reshape(2, 2), theta[-2:])


def train_field(posts: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, ridge: float = 1e-4, steps: int = 150) -> Field:
    """Fit the field on labelled posts.

    ``posts``: ``id`` and ``caption`` of media posts; ``labels``: ``id`` and ``quality`` (0 or 1). The fold whose id hashes to 0 modulo
    FOLDS, null ids and null labels are left out; of several labels of a post the lowest counts. At most ``per_class``
    posts of either class are used, those with the lowest hash of their id, and SAMPLE_LINES lines of each that follow each other:
    this documented bound makes it safe to send the ids to all tasks and the lines' bins, no texts, to the driver.
    Classes weigh alike. Without labels of both classes the field scores nothing and every line is content.
    """
    usable = labels.filter("id is not null and quality is not null").groupBy("id").agg(F.min("quality").alias("quality"))
    usable = staged(usable.filter(~held_out(F.col("id"))).select("id", F.when(F.col("quality") > 0, 1).otherwise(0).alias("quality")), "quality-labels")
    shares = dict(usable.groupBy("quality").count().collect())
    drawn = [lowest_hashes(usable.filter(F.col("quality") == c), per_class, shares.get(c, 0), "id") for c in (0, 1)]
    texts = posts.select("id", "caption").join(F.broadcast(drawn[0].union(drawn[1])), "id").select("caption", "quality")
    rows = texts.mapInArrow(_featured, "quality int, features array<smallint>").collect()
    rows = sorted((row[0], row[1]) for row in rows if row[1])
    quality = np.array([row[0] for row in rows], np.int64)
    if len(set(quality)) < 2:
        return Field(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    sequences = [np.array(row[1], np.int64).reshape(-1, len(_BINS)) for row in rows]
    lengths = np.array([len(s) for s in sequences])
    share = np.array([(lengths * (quality == c)).sum() for c in (0, 1)])
    return _fit(sequences, quality, 1 / share[quality], ridge, steps)


def _judge(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for batch in in_parts(batches):
        judged = [base_figures(text) for text in batch["caption"].to_pylist()]
        scores = field.emit[line_bins([line_figures(*line) for _, lines in judged for line in lines])].sum(axis=1)
        rows, low = [], 0
        for figures, lines in judged:
            n = figures["n_words"]
            failed = n < FEWEST_WORDS or 100 * figures["n_repeat_words"] > MOST_REPEATED * n
            content = 0
            if lines:
                labels = viterbi(scores[low : low + len(lines)], field)
                low += len(lines)
                content = sum(len(words) for (_, words, _), label in zip(lines, labels) if label)
            share = content / n if n else 0.0
            rows.append((*(figures[c] for c in names), failed, share, not failed and share >= CONTENT_SHARE))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch["id"], *columns], names=["id", *names, "base_failed", "content_share", "kept"])


def judge_captions(posts: DataFrame, field: Field) -> DataFrame:
    """Judge whole captions of media posts.

    Lines with words are labelled content or boilerplate by Viterbi decoding; ``content_share`` is the share of the words
    that content lines hold and must reach CONTENT_SHARE. Before that the base rules count: fewer than FEWEST_WORDS words, or
    over MOST_REPEATED percent of them in windows of REPEAT_WINDOW words that the caption holds twice, fail.

    Returns ``id``, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an
    earlier line), ``n_repeat_words``, ``base_failed``, ``content_share`` and ``kept``, one row per row of ``posts``; rows are not
    shuffled. Null and empty captions have no words and fail. Null ids and repeated rows are judged like others.
    """
    kind = posts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"
    return posts.select("id", "caption").mapInArrow(lambda b: _judge(b, field), schema)

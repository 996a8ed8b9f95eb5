"""Phrases that words form more often than by chance, counted in tiles of frequency-ranked ids."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import in_parts
from postlake.session import staged

# Fixed value: what a caption is cut at before its pieces are cut at spaces and tabs.
CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + CUTS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(CUTS))

NO_GROUP = "und"
LEAST = 10
KEEP_SHARE = 50
SCALE = 1_000_000
TOP = 2_000
HEAD_WORDS = 1 << 19
HEAD_WORD_BYTES = 64
HEAD_PAIRS = 1 << 20
FILTER_BITS = 27
SEGMENT_BITS = 17
TILE_BITS = 9
AT_ONCE = 1 << 20
OWN_WORDS = 1 << 18
SENT_ROWS = 50_000

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


# -- words ------------------------------------------------------------------------------------------------------------


def grouped_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Captions of a group, folded, with a line end after each."""
    for batch in in_parts(batches):
        groups: dict[str, list[str]] = {}
        for group, text in zip(batch["group"].to_pylist(), batch["caption"].to_pylist()):
            if text:
                groups.setdefault(group, []).append(text)
        for group, texts in groups.items():
            yield group, "\n".join(texts).encode("utf-8", "replace").translate(_FOLD)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words per group with their counts, and all of them under no word."""
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for group, words in counts.items():
            columns = [
                pa.array([group] * (len(words) + 1)), pa.array([*(w.decode("utf-8", "replace") for w in words), None], pa.string()),
                pa.array([*words.values(), words.total()], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "word", "n"])
        counts.clear()

    for group, text in grouped_texts(batches):
        counts.setdefault(group, Counter()).update(text.split())
        if sum(map(len, counts.values())) > 2 * OWN_WORDS:
            yield from flush()
    yield from flush()


# -- a filter of fixed size -------------------------------------------------------------------------------------------


def word_mark(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pair_marks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Marks of pairs out of the marks of their words."""
    x = (left ^ (left >> np.uint64(31))) * _MULTIPLY + right
    x ^= x >> np.uint64(29)
    return x * _MULTIPLY


def _places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    marks = marks ^ (marks >> np.uint64(32))
    low = np.uint64((1 << FILTER_BITS) - 1)
    return (marks & low).astype(np.int64), ((marks >> np.uint64(FILTER_BITS)) & low).astype(np.int64)


class Filter(NamedTuple):
    """Tells which phrases are surely not frequent. Two places of a bit field of fixed size belong to a phrase; a full field
    lets more through, which costs time and changes no count."""

    bits: np.ndarray | None

    def may_hold(self, marks: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.zeros(len(marks), bool)
        one, two = _places(marks)
        return (self.bits[one >> 3] >> (one & 7).astype(np.uint8) & 1).astype(bool) & (self.bits[two >> 3] >> (two & 7).astype(np.uint8) & 1).astype(bool)


def _phrase_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        phrases = [p.encode("utf-8", "replace").split(b" ") for p in batch["phrase"].to_pylist()]
        marks = np.array([word_mark(p[0]) for p in phrases], np.uint64)
        if phrases and len(phrases[0]) > 1:
            marks = pair_marks(marks, np.array([word_mark(p[1]) for p in phrases], np.uint64))
        place = np.concatenate(_places(marks))
        yield pa.RecordBatch.from_arrays([pa.array(place >> SEGMENT_BITS), pa.array(place & ((1 << SEGMENT_BITS) - 1))], names=["segment", "place"])


def _segment(key: tuple, table: pa.Table) -> pa.Table:
    field = np.zeros(1 << SEGMENT_BITS, np.uint8)
    field[table["place"].to_numpy()] = 1
    return pa.table({"segment": pa.array([key[0].as_py()]), "bits": pa.array([np.packbits(field, bitorder="little").tobytes()])})


def filter_of(phrases: DataFrame) -> Filter:
    """The filter of ``phrases(phrase)``, words or pairs. Equal places are dropped before a segment is put together, so it is
    bounded, and so is what the driver gets: the bit field."""
    places = phrases.select("phrase").mapInArrow(_phrase_places, "segment long, place long").distinct()
    segments = places.groupBy("segment").applyInArrow(_segment, "segment long, bits binary").collect()
    if not segments:
        return Filter(None)
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = 1 << (SEGMENT_BITS - 3)
    for row in segments:
        bits[row.segment * width : (row.segment + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return Filter(bits)


# -- counting in tiles ------------------------------------------------------------------------------------------------


def count_tiles(left: np.ndarray, right: np.ndarray, tile_bits: int = TILE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of ids and how often each occurs.

    Ids are ranks by frequency, so pairs crowd into tiles of low ids. A tile that holds at least an eighth as many pairs as
    it has cells is addressed directly and counted by ``bincount``; the pairs of all other tiles are sorted as coordinates.
    """
    side = np.int64(1) << tile_bits
    across = (int(right.max()) >> tile_bits) + 1 if len(right) else 1
    tile = (left >> tile_bits) * across + (right >> tile_bits)
    numbers, sizes = np.unique(tile, return_counts=True)
    dense = numbers[sizes * 8 >= side * side]
    out = []
    rest = np.ones(len(tile), bool)
    for number in dense.tolist():
        here = tile == number
        rest &= ~here
        cells = ((left[here] & (side - 1)) << tile_bits) | (right[here] & (side - 1))
        counts = np.bincount(cells, minlength=side * side)
        found = np.flatnonzero(counts)
        out.append(((found >> tile_bits) + (number // across) * side, (found & (side - 1)) + (number % across) * side, counts[found]))
    codes = np.sort((left[rest] << 32) | right[rest])
    if len(codes):
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        out.append((codes[first] >> 32, codes[first] & 0xFFFFFFFF, np.diff(np.append(first, len(codes)))))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out))


class Head(NamedTuple):
    """The most frequent words and pairs by group. ``words``: by falling frequency, a line each, the first has id 1; ``pairs``:
    sorted codes of two word ids with the pairs' ranks by falling frequency. Filters of frequent words beyond, and of
    all frequent pairs."""

    words: dict[str, bytes]
    other_words: Filter
    pairs: dict[str, tuple[np.ndarray, np.ndarray]]
    frequent_pairs: Filter


class _Ids(dict):
    """Ids of a group's words: those of the head, and own ones for words that may be frequent. Other words have id -1."""

    def __init__(self, head: list[bytes], other: Filter) -> None:
        super().__init__(zip(head, range(1, len(head) + 1)))
        self.n_head, self.other = len(head), other
        self.words: list[bytes] = []
        self.marks = np.array([0, *map(word_mark, head)], np.uint64)
        self[None] = 0

    def __missing__(self, word: bytes) -> int:
        mark = word_mark(word)
        known = self.other.may_hold(np.array([mark], np.uint64))[0]
        self[word] = number = self.n_head + len(self.words) + 1 if known else -1
        if known:
            self.words.append(word)
            self.own.append(mark)
        elif len(self) > self.n_head + 2 * OWN_WORDS:
            del self[word]
        return number

    own: list[int]

    def ids_of(self, text: bytes) -> np.ndarray:
        """Ids of all words in order, 0 between pieces."""
        words: list[bytes | None] = []
        for piece in text.split(b"\n"):
            found = piece.split()
            if found:
                words += found
                words.append(None)
        self.own = []
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.own:
            self.marks = np.concatenate((self.marks, np.array(self.own, np.uint64)))
        return ids

    def forget(self) -> None:
        for word in self.words:
            del self[word]
        self.words = []
        self.marks = self.marks[: self.n_head + 1]

    def spell(self, ids: np.ndarray, head: list[bytes]) -> list[bytes]:
        return [head[i - 1] if i <= self.n_head else self.words[i - self.n_head - 1] for i in ids.tolist()]


_EMPTY = np.empty(0, np.int64)
_NAMES = ["group", "left", "right", "phrase", "n"]
PHRASES = "group string, left long, right long, phrase string, n long"


class _Counting:
    """Counts of one group: codes wait until there are enough of them to be counted in tiles."""

    def __init__(self, group: str, head: Head, length: int) -> None:
        self.group, self.length = group, length
        self.head = head.words[group].split(b"\n") if group in head.words else []
        self.pairs = head.pairs.get(group, (_EMPTY, _EMPTY))
        self.frequent = head.frequent_pairs
        self.ids = _Ids(self.head, head.other_words)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0
        self.spelled: Counter = Counter()

    def add(self, text: bytes) -> None:
        ids = self.ids.ids_of(text)
        n = self.length
        if len(ids) < n:
            return
        word = ids > 0
        whole = word[: len(ids) - n + 1].copy()
        for k in range(1, n):
            whole &= word[k : len(ids) - n + 1 + k]
        at = np.flatnonzero(whole)
        if n == 3:
            marks = self.ids.marks
            for k in (0, 1):
                at = at[self.frequent.may_hold(pair_marks(marks[ids[at + k]], marks[ids[at + k + 1]]))]
        near = np.ones(len(at), bool)
        for k in range(n):
            near &= ids[at + k] <= self.ids.n_head
        left, right = ids[at], ids[at + n - 1]
        if n == 3:
            # The first two words are one id of the next round: the rank of their pair.
            codes, ranks = self.pairs
            wanted = (ids[at] << 32) | ids[at + 1]
            place = np.minimum(np.searchsorted(codes, wanted), max(len(codes) - 1, 0))
            near &= (codes[place] == wanted) if len(codes) else False
            left = ranks[place] if len(codes) else left
        self.waiting.append((left[near].astype(np.int32), right[near].astype(np.int32)))
        self.size += int(near.sum())
        far = at[~near]
        if len(far):
            words = [self.ids.spell(ids[far + k], self.head) for k in range(n)]
            self.spelled.update(map(b" ".join, zip(*words)))

    def full(self) -> bool:
        return self.size >= AT_ONCE or len(self.spelled) >= OWN_WORDS or len(self.ids.words) >= OWN_WORDS

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            left, right, n = count_tiles(*(np.concatenate(part).astype(np.int64) for part in zip(*self.waiting)))
            self.waiting = []
            columns = [pa.repeat(pa.scalar(self.group), len(n)), pa.array(left), pa.array(right), pa.nulls(len(n), pa.string()), pa.array(n.astype(np.int64))]
            yield from in_parts([pa.RecordBatch.from_arrays(columns, names=_NAMES)], SENT_ROWS)
        if self.spelled:
            n = len(self.spelled)
            phrases = [p.decode("utf-8", "replace") for p in self.spelled]
            columns = [
                pa.repeat(pa.scalar(self.group), n), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(phrases), pa.array(list(self.spelled.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
        self.waiting, self.size, self.spelled = [], 0, Counter()
        self.ids.forget()


OPEN_GROUPS = 64


def _count_phrases(batches: Iterator[pa.RecordBatch], shared: Broadcast, length: int) -> Iterator[pa.RecordBatch]:
    head: Head = shared.value
    counting: dict[str, _Counting] = {}
    for group, text in grouped_texts(batches):
        if group not in counting:
            if len(counting) >= OPEN_GROUPS:
                for each in counting.values():
                    yield from each.flush()
                counting.clear()
            counting[group] = _Counting(group, head, length)
        counting[group].add(text)
        if counting[group].full():
            yield from counting[group].flush()
    for each in counting.values():
        yield from each.flush()


# -- ranking, scoring -------------------------------------------------------------------------------------------------


def _level() -> Column:
    return F.floor(F.log2("n") * 16).cast("int")


def most_frequent(rows: DataFrame, most: int, fits: Column) -> Column:
    """Condition for the rows with the highest ``n`` among those that fit: whole levels of ``n``, not more than ``most`` rows.

    The driver sees how many rows each level has, which are under 1100 numbers for any table.
    """
    levels = dict(rows.filter(fits).groupBy(_level().alias("level")).count().collect())
    least, taken = None, 0
    for level in sorted(levels, reverse=True):
        taken += levels[level]
        if taken > most:
            break
        least = level
    return fits & (_level() >= least) if least is not None else F.lit(False)


def _ranked(rows: DataFrame, *ties: str) -> DataFrame:
    """Ids from 1 by falling frequency in the group. Only for rows whose number is bounded."""
    return rows.withColumn("id", F.row_number().over(Window.partitionBy("group").orderBy(F.desc("n"), *ties)))


def _by_group(table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    table = table.sort_by([("group", "ascending"), ("id", "ascending")])
    groups = table["group"].to_pylist()
    cuts = [0, *(n for n in range(1, len(groups)) if groups[n] != groups[n - 1]), len(groups)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        if high > low:
            yield groups[low], table.slice(low, high - low)


def _counted(texts: DataFrame, head: Head, length: int, least: int) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(head)
    counts = texts.mapInArrow(lambda b: _count_phrases(b, shared, length), PHRASES)
    return counts.groupBy("group", "left", "right", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _spelled(counts: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``phrase`` for counts that have ids: what the left id stands for, then what the right one does."""
    one = left.select("group", F.col("id").cast("long").alias("left"), F.col("phrase").alias("_left"))
    two = right.select("group", F.col("id").cast("long").alias("right"), F.col("phrase").alias("_right"))
    joined = counts.join(one, ["group", "left"], "left").join(two, ["group", "right"], "left")
    return joined.select("group", F.coalesce("phrase", F.concat_ws(" ", "_left", "_right")).alias("phrase"), "left", "right", "n")


def scores(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a a / (left right)), exact: products of counts up to 10^14 have at most 35 digits."""
    whole = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", whole[0] * whole[0] * F.lit(SCALE).cast("decimal(7,0)"), whole[1] * whole[2])


def _with_counts(rows: DataFrame, counts: DataFrame, of: Column, alias: str) -> DataFrame:
    known = counts.select(F.col("group").alias("_group"), F.col("phrase").alias("_phrase"), F.col("n").alias(alias))
    return rows.join(known, (F.col("group") == F.col("_group")) & (of == F.col("_phrase"))).drop("_group", "_phrase")


def caption_collocations(
    posts: DataFrame, least: int = LEAST, keep_share: int = KEEP_SHARE, top: int = TOP,
    head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """Phrases of two and three words that captions of a tag use more often than their words' frequencies suggest.

    Reads ``caption`` and ``hashtag_id`` of media posts; a null tag is "und". Captions are lower-cased (A to Z) and cut into pieces at
    punctuation and line ends, pieces into words at spaces and tabs. A phrase with at least ``least`` occurrences in its
    tag is a candidate, overlaps counted. Its score is floor(10^6 a a / (l r)), a, l and r being the occurrences of the phrase and of its
    two parts, cut where that is lowest. A candidate inside a longer one that has ``keep_share`` per cent of its occurrences goes.

    Returns the first ``top`` phrases per tag by score, occurrences and phrase: ``hashtag_id``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``
    (all words of the tag) and ``score``.

    Method: words are ranked by frequency. The first ``head_words`` get ids that every task knows, their pairs are counted by tiles
    of ids (``count_tiles``) and Spark adds up the tasks' counts. Frequent pairs are ranked again, and a phrase of three words
    is a pair of a frequent pair and a word. What lies beyond the ranked heads is counted by its spelling; filters of fixed
    size keep back what cannot be frequent. So the broadcasts are bounded at any size of the vocabulary, and all
    counts are exact. Keys are phrases, combined in the tasks, so a tag with most posts is no hot key.

    Null and empty captions have no words, a tag without words no rows. Repeated rows count as often as they occur, ids are not
    read. Very long captions are counted whole. An empty table gives an empty result.
    """
    texts = posts.select(F.coalesce(F.col("hashtag_id").cast("string"), F.lit(NO_GROUP)).alias("group"), "caption")
    words = texts.mapInArrow(_count_words, "group string, word string, n long").groupBy("group", F.col("word").alias("phrase")).agg(F.sum("n").alias("n"))
    words = staged(words.filter(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    totals = words.filter("phrase IS NULL").select(F.col("group").alias("_total_group"), F.col("n").alias("total"))
    words = words.filter("phrase IS NOT NULL")

    chosen = most_frequent(words, head_words, F.octet_length("phrase") <= HEAD_WORD_BYTES)
    head_table = staged(_ranked(words.filter(chosen), "phrase"), "head-words")
    by_group = {g: "\n".join(t["phrase"].to_pylist()).encode("utf-8", "replace") for g, t in _by_group(head_table.toArrow())}
    head = Head(by_group, filter_of(words.filter(~chosen)), {}, Filter(None))

    pairs = staged(_spelled(_counted(texts, head, 2, least), head_table, head_table), "pairs")
    ranked = _ranked(pairs.filter(most_frequent(pairs, head_pairs, F.col("left").isNotNull())), "phrase")
    pair_table = staged(ranked, "head-pairs")
    known = {}
    for group, table in _by_group(pair_table.toArrow()):
        codes = (table["left"].to_numpy() << 32) | table["right"].to_numpy()
        order = np.argsort(codes)
        known[group] = codes[order], table["id"].to_numpy()[order].astype(np.int64)
    head = head._replace(pairs=known, frequent_pairs=filter_of(pairs))

    threes = staged(_spelled(_counted(texts, head, 3, least), pair_table, head_table), "threes")
    return _best(words, pairs, threes, totals, keep_share, top)


def _best(words: DataFrame, pairs: DataFrame, threes: DataFrame, totals: DataFrame, keep_share: int, top: int) -> DataFrame:
    word = lambda k: F.split_part("phrase", F.lit(" "), F.lit(k))
    front, back = F.concat_ws(" ", word(1), word(2)), F.concat_ws(" ", word(2), word(3))
    longer = threes.select("group", F.explode(F.array(front, back)).alias("inner"), F.col("n").alias("longer"))
    longer = longer.groupBy(F.col("group").alias("_group"), "inner").agg(F.max("longer").alias("longer"))
    kept = pairs.join(longer, (F.col("group") == F.col("_group")) & (F.col("phrase") == F.col("inner")), "left")
    kept = kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < keep_share * F.col("n"))).select("group", "phrase", F.col("n").alias("a"))
    two = _with_counts(_with_counts(kept, words, word(1), "l"), words, word(2), "r")
    two = two.withColumn("score", scores(F.col("a"), F.col("l"), F.col("r")))

    three = threes.select("group", "phrase", F.col("n").alias("a"))
    for counts, of, alias in ((words, word(1), "l1"), (pairs, back, "r1"), (pairs, front, "l2"), (words, word(3), "r2")):
        three = _with_counts(three, counts, of, alias)
    cuts = F.array(*[
        F.struct(scores(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in (1, 2)
    ])
    three = three.withColumn("cut", F.array_min(cuts)).select("group", "phrase", "a", "cut.l", "cut.r", "cut.score")

    scored = two.select("group", "phrase", "a", "l", "r", "score").unionByName(three)
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    # The first rows of each of 64 parts of a tag, then of the tag: no task sees all candidates of a tag.
    part = Window.partitionBy("group", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = scored.withColumn("_place", F.row_number().over(part)).filter(F.col("_place") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return first.join(totals, F.col("group") == F.col("_total_group")).select(
        F.col("group").alias("hashtag_id"), "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score")
    )

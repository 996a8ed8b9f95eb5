"""Repeated passages of captions, removed by joining equal windows, found by hash, into factors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import in_parts, words_of
from postlake.session import staged

WINDOW = 20
# A window is filed under the smallest hash among its runs of GRAM words.
GRAM = 6
# Words that a task indexes before it sends what it found, and about as many windows as a block holds.
FLUSH_WORDS = 1 << 18
BLOCK_WORDS = 1 << 20
# An anchor's windows count as many from this share of a block on. They are counted in TALLY_SLOTS slots a block, on one
# text in TALLY_EVERY: the count says how windows are dealt out, not what is found.
HOT_SHARE, TALLY_SLOTS, TALLY_EVERY = 0.25, 64, 8

_U = np.uint64
_BASE = 0x9E3779B97F4A7C13  # odd
_MASK = (1 << 64) - 1
_MIX = _U(0xD6E8FEB86659FD93)


class _Words(dict):
    """Word to position in two tables of independent 64-bit hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.low, self.high = [], []

    def __missing__(self, word: bytes) -> int:
        digest = xxhash.xxh3_128_intdigest(word)
        self.low.append(digest & _MASK)
        self.high.append(digest >> 64)
        self[word] = at = len(self)
        return at


def _windows(low: np.ndarray, high: np.ndarray, window: int, gram: int):
    """For the window at every position: its anchor's hash and position, and 48 more bits of its own content.

    The anchor is the leftmost of the window's grams with the smallest hash, so it depends on the words of the
    window alone: equal windows have equal anchors at equal distances.
    """
    n = len(low) - window + 1
    grams = np.zeros(len(low) - gram + 1, np.uint64)
    for j in range(gram):
        grams += low[j : j + len(grams)] * _U(pow(_BASE, 2 * j + 1, 1 << 64))
    grams ^= grams >> _U(32)
    grams *= _MIX
    grams ^= grams >> _U(29)
    span = window - gram + 1
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, span):
        other = grams[j : j + n]
        less = other < best
        np.copyto(best, other, where=less)
        at[less] = j
    powers = np.full(len(low), _U(_BASE))
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(high * powers)))
    back = np.full(n, _U(pow(_BASE, -1, 1 << 64)))
    back[0] = 1
    own = (sums[window : window + n] - sums[:n]) * np.multiply.accumulate(back)
    own ^= own >> _U(31)
    return best, at, (own * _MIX) >> _U(16)


def _runs(*same: np.ndarray) -> np.ndarray:
    """Starts of the runs over which none of the arrays changes; each array holds a run's constant."""
    change = np.zeros(len(same[0]), bool)
    change[:1] = True
    for x in same:
        change[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(change)


def _later(h, own, rank, start):
    """Positions of windows that occur earlier too, and the position of the earliest of each.

    Only anchors that occur in two runs or more can hold such windows.
    """
    order = np.lexsort((start, rank, own, h))
    hs, ow = h[order], own[order]
    first = np.zeros(len(order), bool)
    first[:1] = True
    first[1:] = (hs[1:] != hs[:-1]) | (ow[1:] != ow[:-1])
    lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    after = (rank[order] != rank[lead]) | (start[order] != start[lead])
    return order[after], lead[after]


def _shared(h: np.ndarray) -> np.ndarray:
    """Marks values that occur more than once."""
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def _expand(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... n[0] times, then the next run."""
    ends = np.cumsum(n)
    return np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


class _Flush:
    """Texts that a task has read, and the packed rows they give."""

    def __init__(self, id_type: pa.DataType, window: int, blocks: int, slots: int = 1, hot: np.ndarray | None = None) -> None:
        self.id_type, self.window, self.blocks, self.vocabulary = id_type, window, blocks, _Words()
        self.slots, self.hot = slots, np.empty(0, np.int64) if hot is None else hot
        self.clear()

    def clear(self) -> None:
        self.ids, self.keys, self.lengths, self.codes, self.size = [], [], [], [], 0
        if len(self.vocabulary) > 1 << 17:
            self.vocabulary = _Words()

    def add(self, post, key: int, words: list[bytes]) -> None:
        self.ids.append(post)
        self.keys.append(key)
        self.lengths.append(len(words))
        self.codes.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def windows(self) -> tuple[np.ndarray, ...]:
        """Anchor's hash, own bits, anchor's position, text and start of every window that lies in one text."""
        codes = np.concatenate(self.codes)
        lows, highs = np.array(self.vocabulary.low, np.uint64), np.array(self.vocabulary.high, np.uint64)
        lengths = np.array(self.lengths)
        begin = np.cumsum(lengths) - lengths
        h, at, own = _windows(lows[codes], highs[codes], self.window, GRAM)
        where = _expand(begin, lengths - self.window + 1)
        doc = np.repeat(np.arange(len(lengths)), lengths - self.window + 1)
        return h[where], own[where], at[where] + where, doc, where - begin[doc]

    def rows(self) -> Iterator[tuple]:
        if not self.ids:
            return
        h, own, anchor, doc, start = self.windows()
        ordered = sorted(set(self.ids))
        place = {post: k for k, post in enumerate(ordered)}
        rank = np.array([place[post] for post in self.ids])[doc]
        runs = _runs(anchor, doc)
        twice = np.repeat(_shared(h[runs]), np.diff([*runs, len(h)]))
        some = np.flatnonzero(twice)
        dup, lead = _later(h[some], own[some], rank[some], start[some])
        dup, lead = some[dup], some[lead]
        # What occurs earlier in this task is decided here and travels as finished factors; only the earliest
        # window of a kind is sent to its block, so a passage of very many texts is one row per task there.
        order = np.argsort(dup)
        dup, lead = dup[order], lead[order]
        for part in np.array_split(np.arange(len(dup)), max(1, len(dup) // (1 << 16))):
            if len(part):
                d, e = dup[part], lead[part]
                yield self._factors(doc[d], start[d], doc[e], start[e])
        alone = np.ones(len(h), bool)
        alone[dup] = False
        left = np.flatnonzero(alone)
        yield from self._blocks(h[left], own[left], doc[left], start[left], anchor[left])

    def _factors(self, doc, start, ref, ref_start) -> tuple:
        runs = _runs(doc, ref, start - np.arange(len(start)), ref_start - start)
        n = np.diff([*runs, len(doc)])
        used, codes = np.unique(np.concatenate((doc[runs], ref[runs])), return_inverse=True)
        body = np.stack((codes[: len(runs)], start[runs], n, codes[len(runs) :], ref_start[runs])).astype("<u4")
        return int(doc[0]) % self.blocks, True, *self._named(used), body.tobytes()

    def _blocks(self, h, own, doc, start, anchor) -> Iterator[tuple]:
        # Windows of a frequent anchor go one by one, each to a block of its own words.
        spread = np.isin(_slot(h, self.slots), self.hot)
        runs = _runs(anchor, doc, start - np.arange(len(start)), np.where(spread, np.arange(len(h)), -1))
        n = np.diff([*runs, len(h)])
        key = (h[runs] >> _U(20)) + np.where(spread[runs], own[runs], _U(0))
        block = (key % _U(self.blocks)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order], prepend=-1))
        for part in np.split(order, cuts[1:]):
            if not len(part):
                continue
            used, codes = np.unique(doc[runs[part]], return_inverse=True)
            head = np.stack((codes, start[runs[part]], n[part])).astype("<u4")
            tail = own[_expand(runs[part], n[part])].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            body = len(part).to_bytes(4, "little") + h[runs[part]].astype("<u8").tobytes() + head.tobytes() + tail.tobytes()
            yield int(block[part[0]]), False, *self._named(used), body

    def _named(self, used: np.ndarray) -> tuple[list, list]:
        return [self.ids[k] for k in used], [self.keys[k] for k in used]


def _slot(h: np.ndarray, slots: int) -> np.ndarray:
    """Slot of an anchor's hash, by its low bits: the high ones of a smallest hash are small."""
    return (h % _U(slots)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch], window: int, slots: int) -> Iterator[pa.RecordBatch]:
    """How many windows have their anchor in each slot."""
    flush, counts = None, np.zeros(slots, np.int64)
    for batch in in_parts(batches):
        flush = flush or _Flush(batch.schema.field("id").type, window, 1)
        for post, text in zip(batch["id"].to_pylist(), batch["caption"].to_pylist()):
            words = words_of(text)
            if post is not None and len(words) >= window:
                flush.add(post, 0, words)
            if flush.size >= FLUSH_WORDS:
                counts += np.bincount(_slot(flush.windows()[0], slots), minlength=slots)
                flush.clear()
    if flush and flush.ids:
        counts += np.bincount(_slot(flush.windows()[0], slots), minlength=slots)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])


def _index(batches: Iterator[pa.RecordBatch], window: int, blocks: int, slots: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    flush = None
    for batch in in_parts(batches):
        id_type = batch.schema.field("id").type
        flush = flush or _Flush(id_type, window, blocks, slots, hot)
        for post, key, text in zip(batch["id"].to_pylist(), batch["key"].to_pylist(), batch["caption"].to_pylist()):
            words = words_of(text)
            if post is not None and len(words) >= window:
                flush.add(post, key, words)
            if flush.size >= FLUSH_WORDS:
                yield from _packed(flush.rows(), id_type)
                flush.clear()
    if flush:
        yield from _packed(flush.rows(), flush.id_type)


def _packed(rows: Iterator[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.bool_(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary()]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4])
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=_PACKED)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=_PACKED)


_PACKED = ["block", "done", "ids", "keys", "body"]


def _parse_block(table: pa.Table) -> pa.Table:
    """All factors of one block: windows that occur in it earlier, as runs, and those that came finished."""
    id_type = table.schema.field("ids").type.value_type
    ids, keys, parts, ready = [], [], [], []
    for done, post, key, body in zip(*(table[c].to_pylist() for c in _PACKED[1:])):
        base = len(ids)
        ids += post
        keys += key
        if done:
            found = np.frombuffer(body, "<u4").reshape(5, -1).astype(np.int64)
            found[[0, 3]] += base
            ready.append(found)
            continue
        n = int.from_bytes(body[:4], "little")
        h = np.frombuffer(body, "<u8", n, 4)
        doc, start, many = np.frombuffer(body, "<u4", 3 * n, 4 + 8 * n).reshape(3, n).astype(np.int64)
        tail = np.frombuffer(body, np.uint8, offset=4 + 20 * n).reshape(-1, 6)
        parts.append((h, doc + base, start, many, tail))
    if parts:
        h, doc, start, many = (np.concatenate([p[k] for p in parts]) for k in range(4))
        tail = np.concatenate([p[4] for p in parts])
        shared = _shared(h)
        tail = tail[np.repeat(shared, many)]
        own = np.zeros((len(tail), 8), np.uint8)
        own[:, :6] = tail
        own = own.view("<u8").reshape(-1)
        h, doc, start, many = (x[shared] for x in (h, doc, start, many))
        place = {post: k for k, post in enumerate(sorted(set(ids)))}
        rank = np.array([place[post] for post in ids])[doc] if len(doc) else doc
        h, doc, rank, start = np.repeat(h, many), np.repeat(doc, many), np.repeat(rank, many), _expand(start, many)
        dup, lead = _later(h, own, rank, start)
        order = np.lexsort((start[dup], doc[dup]))
        dup, lead = dup[order], lead[order]
        d, s, r, q = doc[dup], start[dup], doc[lead], start[lead]
        runs = _runs(d, r, s - np.arange(len(s)), q - s)
        ready.append(np.stack((d[runs], s[runs], np.diff([*runs, len(d)]), r[runs], q[runs])))
    found = np.concatenate(ready, axis=1) if ready else np.zeros((5, 0), np.int64)
    columns = {
        "id": pa.array([ids[k] for k in found[0]], id_type), "key": pa.array([keys[k] for k in found[0]], pa.int64()),
        "start": pa.array(found[1], pa.int32()), "n": pa.array(found[2], pa.int32()),
        "ref_id": pa.array([ids[k] for k in found[3]], id_type), "ref_start": pa.array(found[4], pa.int32()),
    }
    return pa.table(columns)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        ids = batch["id"]
        totals, removed, kept, lists = [], [], [], []
        for text, found in zip(batch["caption"].to_pylist(), batch["factors"].to_pylist()):
            words = words_of(text)
            factors = _joined(found or (), window)
            totals.append(len(words))
            lists.append(factors)
            if factors:
                keep = np.ones(len(words), bool)
                for f in factors:
                    keep[f["start"] : f["start"] + f["n_words"]] = False
                left = [words[k] for k in np.flatnonzero(keep)]
            else:
                left = words
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("ref_id", ids.type), ("ref_start", pa.int32())]))
        columns = [ids, batch["key"], pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(lists, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "caption_hash", "n_words", "n_removed", "kept_caption", "factors"])


def _joined(found: list[dict], window: int) -> list[dict]:
    """Windows joined into factors: a factor goes on as long as the next window continues it in the same reference text."""
    factors, last = [], None
    for f in sorted(found, key=lambda f: (f["start"], f["n"])):
        if last and f["ref_id"] == last["ref_id"] and f["ref_start"] - f["start"] == last["ref_start"] - last["start"] and f["start"] <= last["start"] + last["n_words"] - window + 1:
            last["n_words"] = max(last["n_words"], f["start"] - last["start"] + f["n"] + window - 1)
        else:
            last = {"start": f["start"], "n_words": f["n"] + window - 1, "ref_id": f["ref_id"], "ref_start": f["ref_start"]}
            factors.append(last)
    return factors


def _filed(texts: DataFrame, window: int) -> DataFrame:
    """Packed windows and finished factors of ``texts(id, caption, key)`` with the number of their block."""
    id_type = texts.schema["id"].dataType
    size = texts.agg(F.sum(F.octet_length("caption"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    slots, hot = blocks * TALLY_SLOTS, np.empty(0, np.int64)
    if blocks > 1:
        some = texts.filter(F.pmod(F.xxhash64("id", "key"), F.lit(TALLY_EVERY)) == 0)
        counted = some.mapInArrow(lambda b: _tally(b, window, slots), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
        many = counted.filter(F.col("n") * TALLY_EVERY > HOT_SHARE * BLOCK_WORDS).collect()
        hot = np.array(sorted(row["slot"] for row in many), np.int64)
    packed = T.StructType().add("block", T.IntegerType()).add("done", T.BooleanType()).add("ids", T.ArrayType(id_type))
    packed = packed.add("keys", T.ArrayType(T.LongType())).add("body", T.BinaryType())
    return texts.mapInArrow(lambda b: _index(b, window, blocks, slots, hot), packed)


def remove_repeats(posts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove from captions the passages of at least ``window`` words that occur earlier.

    Reads ``id`` and ``caption`` of media posts, whole texts. Earlier means in a post with a smaller id, or further in
    front in the same caption. A word goes if it lies in a window of ``window`` words that occurs earlier; windows are
    judged on the captions as they are, not on what is left.

    A caption's repeated windows are joined into factors, each a reference (post, start, words) to the earliest occurrence.
    Reference texts are not parsed against: windows are compared by hash, in blocks. A window is filed by its anchor, the gram of ``GRAM`` words with the
    smallest hash in it, and every block that holds the anchor's kind is consulted, so no window is missed:
    equal windows always meet in one block, including the windows that straddle the end of one factor and the start
    of the next. A window is known in its block by 64 bits of its anchor and 48 of its words. Runs of windows that go
    on in the same reference text make one factor. Factors shorter than ``window`` cannot arise.

    Each task first settles what repeats among its own texts and sends one window of a kind, so a passage that is in a third
    of all posts reaches its block once per task. Blocks get a number of words set by ``BLOCK_WORDS``, so their
    number grows with the table. A phrase shorter than a window with ever different words around it may be the anchor of very
    many different windows: anchors are counted first, and windows of a frequent one are filed under their own words
    too, which equal windows share, so they spread over all blocks. The captions move once, to meet their factors.

    Returns one row per row of ``posts``: ``id``, ``caption_hash`` (XXH64, tells rows of one id apart), ``n_words``, ``n_removed``, ``kept_caption`` (the words left, joined by one
    space) and ``factors`` (``start``, ``n_words``, ``ref_id``, ``ref_start`` in words; they may overlap). Null and empty captions
    have no words and the kept caption is empty. Rows that share an id are read as one post: only an earlier start
    counts among them. A post without id keeps all words and is no reference. An empty table gives an empty result.
    """
    id_type = posts.schema["id"].dataType
    texts = posts.select("id", "caption", F.xxhash64("caption").alias("key"))
    found = T.StructType().add("id", id_type).add("key", T.LongType()).add("start", T.IntegerType()).add("n", T.IntegerType())
    found = found.add("ref_id", id_type).add("ref_start", T.IntegerType())
    parsed = staged(_filed(texts, window).groupBy("block").applyInArrow(_parse_block, found), "factors")
    factor = F.struct("start", "n", "ref_id", "ref_start")
    parsed = parsed.groupBy("id", "key").agg(F.collect_list(factor).alias("factors"))
    given = texts.join(parsed, ["id", "key"], "left").select("id", "key", "caption", "factors")
    kept = T.StructType().add("start", T.IntegerType()).add("n_words", T.IntegerType()).add("ref_id", id_type).add("ref_start", T.IntegerType())
    out = T.StructType().add("id", id_type).add("caption_hash", T.LongType()).add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept_caption", T.StringType())
    return given.mapInArrow(lambda b: _cut(b, window), out.add("factors", T.ArrayType(kept)))

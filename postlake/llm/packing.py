"""Captions as token sequences of a fixed capacity, packed best-fit in supersteps."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlake.llm.common import in_parts
from postlake.session import shared_dir, staged

CAPACITY = 1024
END_ID = 2
CHUNK_BITS = 14
# With all of the least need opened at once, packs of middling lengths came out 5 % longer than with an eighth.
OPENED = 8

# Fixed value: how byte-level tokenizers of this kind cut a text before its bytes are merged.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Blanks on which implementations of that pattern may differ.
_UNSURE = "[\x1c-\x1f]"


def _byte_of() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order
    from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + n): b for n, b in enumerate(others)}


def merge_ranks(model: str) -> dict[bytes, int] | None:
    """Ids by byte string, if the tokenizer merges in the order of its ids, after cutting by PATTERN and nothing else."""
    given = json.loads(model)
    cut = given.get("pre_tokenizer") or {}
    plain = given.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or given["model"].get("type", "BPE") != "BPE" or given["model"].get("dropout"):
        return None
    special = {t["content"] for t in given.get("added_tokens", [])}
    byte_of, vocabulary = _byte_of(), given["model"]["vocab"]
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in given["model"]["merges"]]
    order = [vocabulary[token] for token in made]
    if order != sorted(order) or len(set(order)) < len(order):
        return None
    ranks = {bytes(byte_of[c] for c in token): n for token, n in vocabulary.items() if token not in special}
    return ranks if len(ranks) == 256 + len(made) else None


class Encoder:
    """Ids of whole texts, packed as 32-bit numbers, as the tokenizer file gives them.

    Where its ids are also the order of its merges, a text is encoded by those ranks, which takes a quarter of the time. Texts with a
    special token or unusual blanks, and all texts of other tokenizers, go through the tokenizer itself.
    """

    def __init__(self, model: str, ranks: dict[bytes, int] | None) -> None:
        self.model, self.tokenizer = model, None
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        special = [re.escape(t["content"]) for t in json.loads(model).get("added_tokens", [])]
        self.whole = re.compile("|".join([_UNSURE, *special]))

    def ids(self, text: str) -> list[int]:
        if self.ranks is not None and not self.whole.search(text):
            return self.ranks.encode_ordinary(text)
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_str(self.model)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.ids(t), "<u4").tobytes() for t in texts]


PIECE = "piece int, start long, length int, ids_crc32 long, ids binary"


def _pieces(batches: Iterator[pa.RecordBatch], model: Broadcast, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(*model.value)
    end = np.array([end_id], "<u4").tobytes()
    for batch in in_parts(batches, 100):
        at, piece, start, length, crc, ids = [], [], [], [], [], []
        texts = [t or "" for t in batch["caption"].to_pylist()]
        for row, packed in enumerate(encoder.encode(texts)):
            packed += end
            total = len(packed) // 4
            first = (total - 1) % capacity + 1 if total > capacity else total
            cuts = [0, *range(first, total + 1, capacity)]
            for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                part = packed[4 * a : 4 * b]
                at.append(row), piece.append(n), start.append(a), length.append(b - a), crc.append(zlib.crc32(part)), ids.append(part)
        columns = [
            batch["id"].take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array(ids, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "ids"])


def caption_pieces(posts: DataFrame, model: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token ids of every whole caption, closed by ``end_id`` and cut into pieces of ``capacity`` where they are longer.

    Only the first piece of a long caption may be shorter than ``capacity``. ``model`` is the tokenizer's JSON, whose size
    bounds what is sent to the tasks.
    """
    kind = posts.schema["id"].dataType.simpleString()
    shared = posts.sparkSession.sparkContext.broadcast((model, merge_ranks(model)))
    return posts.select("id", "caption").mapInArrow(lambda b: _pieces(b, shared, capacity, end_id), f"id {kind}, {PIECE}")


class Run(NamedTuple):
    """``count`` pieces of one length, from a rank on, laid into sequences that follow each other, ``copies`` into each."""

    length: int
    first_rank: int
    count: int
    first_sequence: int
    copies: int
    offset: int


def supersteps(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit in supersteps, for ``counts`` of pieces by length.

    Pieces over half the capacity open a sequence each. In a superstep, pieces and gaps are swept together by size: a piece goes to the
    smallest gap that is large enough and not claimed, the largest piece first; where several want gaps of
    one size, ranks decide. Then gaps shrink and the next sweep follows. Once no piece fits a gap, the largest pieces open an
    eighth of the sequences that all pieces left need at least. A gap may take several pieces of one length at once, so short
    pieces need no superstep each.

    Pieces of one length are alike and so are gaps of one size, so a sweep works with runs of ranks: a few per size and
    superstep, however many pieces there are.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    gaps: dict[int, list[list[int]]] = {}
    runs: list[Run] = []
    sequences = 0

    def put(length: int, sequence: int, n: int, copies: int, gap: int) -> None:
        runs.append(Run(length, int(used[length]), n * copies, sequence, copies, capacity - gap))
        used[length] += n * copies
        left[length] -= n * copies
        rest = gap - copies * length
        if rest:
            gaps.setdefault(rest, []).append([sequence, n])

    def open_sequences(length: int, n: int) -> None:
        nonlocal sequences
        put(length, sequences, n, 1, capacity)
        sequences += n

    def sweep() -> bool:
        before = len(runs)
        waiting: list[int] = []
        offered, smallest = dict(gaps), int(np.flatnonzero(left)[0])
        for size in range(smallest, capacity):
            if left[size]:
                waiting.append(size)
            if size not in offered or not waiting:
                continue
            kept = []
            for sequence, n in gaps.pop(size):
                while n and waiting:
                    length = waiting[-1]
                    copies = int(min(size // length, left[length]))
                    taken = int(min(n, left[length] // copies))
                    put(length, sequence, taken, copies, size)
                    sequence, n = sequence + taken, n - taken
                    if not left[length]:
                        waiting.pop()
                if n:
                    kept.append([sequence, n])
            if kept:
                gaps.setdefault(size, []).extend(kept)
        return len(runs) > before

    for length in range(capacity, capacity // 2, -1):
        if left[length]:
            open_sequences(length, int(left[length]))
    while left.any():
        if sweep():
            continue
        need = -(-int((left * np.arange(capacity + 1)).sum()) // (capacity * OPENED))
        for length in np.flatnonzero(left)[::-1].tolist():
            n = int(min(need, left[length]))
            open_sequences(length, n)
            need -= n
            if not need:
                break
    return runs


def pack_captions(posts: DataFrame, model: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack the captions of media posts into as few token sequences as best-fit finds.

    Reads ``id`` and ``caption``. Every caption becomes token ids and ``end_id``; what is longer than ``capacity`` is cut into pieces of
    that length, of which the first may be shorter. Pieces lie in sequences of at most ``capacity`` without a gap in front of them.

    Returns per piece ``id``, ``piece`` (from 0), ``start`` (ids of the caption before it), ``length``, ``ids_crc32`` and ``ids``
    (unsigned 32-bit little-endian numbers, end to end), ``sequence_id`` and ``offset``.

    Pieces are written once, with a key. Their numbers by length, at most ``capacity`` counts, are all that the sweeps
    need. Pieces are range-sorted in two levels, by length and by stretches of 2^14 keys, so a length that most pieces have is
    ranked in many tasks. Rank and length find the run, hence the sequence; runs are a few per length, so their table is sent to
    every task. Everything is decided by keys that are stored, so a repeated task repeats its answer.

    A null caption is an empty one: its end id is packed. Posts without id and repeated rows are packed like others. Very
    long captions are encoded whole. An empty table gives an empty result.
    """
    spark = posts.sparkSession
    path = shared_dir(spark, "pieces")
    pieces = caption_pieces(posts, model, capacity, end_id).withColumn("key", F.monotonically_increasing_id())
    pieces.write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(pieces.schema).parquet(path).withColumn("chunk", F.shiftright("key", CHUNK_BITS))

    per_chunk = staged(pieces.groupBy("length", "chunk").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r.length: r.n for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(supersteps(counts, capacity), "l int, first_rank long, count long, first_sequence long, copies long, base long")

    along = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select(F.col("length").alias("sl"), F.col("chunk").alias("sc"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "chunk").orderBy("key")
    ranked = pieces.withColumn("place", F.row_number().over(inside) - 1)
    ranked = ranked.join(starts, (F.col("length") == F.col("sl")) & (F.col("chunk") == F.col("sc")))
    ranked = ranked.withColumn("rank", F.col("first") + F.col("place"))
    ahead = F.col("rank") - F.col("first_rank")
    found = ranked.join(F.broadcast(runs), (F.col("length") == F.col("l")) & (ahead >= 0) & (ahead < F.col("count")))
    return found.select(
        "id", "piece", "start", "length", "ids_crc32", "ids",
        (F.col("first_sequence") + F.floor(ahead / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("base") + ahead % F.col("copies") * F.col("length")).cast("long").alias("offset"),
    )

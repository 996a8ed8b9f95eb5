"""SentencePiece encoding by one Viterbi pass over the matches of an Aho-Corasick automaton, and decoding."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from postlake.llm.common import in_parts

# Fixed value: the mark that stands for a space in pieces.
SPACE = "▁"
# Fixed value: how much less than the worst piece an uncovered character scores.
UNKNOWN_PENALTY = 10.0
# Encoded chunks that a task remembers.
REMEMBERED = 1 << 18
MARKS = ".,;:!?"


class Vocabulary(NamedTuple):
    """What a model file says: pieces with scores by id, ids of the 256 bytes, id of the unknown piece."""

    pieces: list[tuple[int, str, float]]
    bytes_: list[int]
    unknown: int


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces of a model file. The file is read once, on the driver; its size is bounded by its vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, by_byte = [], {}
    for k in range(model.get_piece_size()):
        text = model.id_to_piece(k)
        if model.is_byte(k):
            by_byte[int(text[1:-1], 16)] = k
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            pieces.append((k, text, model.get_score(k)))
    return Vocabulary(pieces, [by_byte.get(b, -1) for b in range(256)], model.unk_id())


class Encoder:
    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        self.bytes_, self.unknown = vocabulary.bytes_, vocabulary.unknown
        self.automaton = ahocorasick.Automaton()
        for k, text, score in vocabulary.pieces:
            self.automaton.add_word(text, (k, len(text), score))
        self.automaton.make_automaton()
        self.floor = min((score for _, _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, bytes] = {}
        texts = [text for _, text, _ in vocabulary.pieces]
        # Marks that no piece holds behind a letter: a word with such a mark is the word's pieces and the mark's.
        joined = {b for text in texts for a, b in zip(text, text[1:]) if b in MARKS and a.isalpha()}
        self.marks = "".join(m for m in MARKS if m in texts and m not in joined)
        # No piece reaches over a place where a space mark follows another character, nor over a line end that no
        # piece holds, so a text may be cut there and its parts looked up.
        if any(SPACE in text.lstrip(SPACE) for text in texts):
            self.chunks = re.compile("(?s).+")
        elif any("\n" in text for text in texts):
            self.chunks = re.compile(f"(?s){SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def fallback(self, character: str) -> list[int]:
        found = [self.bytes_[b] for b in character.encode("utf-8", "replace")]
        return found if min(found) >= 0 else [self.unknown]

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}i", *ids)

    def viterbi(self, chunk: str) -> list[int]:
        """Best-scoring pieces of a chunk.

        The automaton reports, for every position in turn, all pieces that end there, longest first, by following
        output links. A position's best score is final once the next is reached. On a tie the longer piece stays.
        """
        n, floor, at = len(chunk), self.floor, 0
        best: list[float] = [0.0] * (n + 1)
        back: list = [None] * (n + 1)
        for end, match in self.automaton.iter(chunk) if len(self.automaton) else ():
            end += 1
            while at < end:  # reach this position by an uncovered character first
                at += 1
                best[at] = best[at - 1] + floor
            total = best[end - match[1]] + match[2]
            if total > best[end]:
                best[end], back[end] = total, match
        ids, at = [], n
        while at:
            match = back[at]
            ids.append([match[0]] if match else self.fallback(chunk[at - 1]))
            at -= match[1] if match else 1
        return [k for part in reversed(ids) for k in part]

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers, end to end."""
        out: list[bytes] = []
        if text:
            for n, part in enumerate(text.split(SPACE)):
                if n:  # the mark itself occurs in the text: its bytes stand for it
                    out.append(self._packed(self.fallback(SPACE)))
                chunks = self.chunks.findall((SPACE if n == 0 else "") + part.replace(" ", SPACE))
                found = list(map(self.known.get, chunks))
                if None in found:
                    found = [ids if ids is not None else self._learn(chunk) for ids, chunk in zip(found, chunks)]
                out += found
        return b"".join(out)

    def _learn(self, chunk: str) -> bytes:
        if len(self.known) >= self.remembered:
            self.known.clear()
        if chunk[-1] in self.marks and chunk[-2:-1].isalpha():
            word, mark = chunk[:-1], chunk[-1]
            ids = (self.known.get(word) or self._learn(word)) + (self.known.get(mark) or self._learn(mark))
        else:
            ids = self._packed(self.viterbi(chunk))
        self.known[chunk] = ids
        return ids


class Decoder:
    """Bytes of all pieces end to end; ids that are no piece spell nothing."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        table = {k: text.replace(SPACE, " ").encode() for k, text, _ in vocabulary.pieces}
        table |= {k: bytes([b]) for b, k in enumerate(vocabulary.bytes_) if k >= 0}
        table[vocabulary.unknown] = " ⁇ ".encode()
        texts = [table.get(k, b"") for k in range(max(table) + 1)]
        self.lengths = np.array([*map(len, texts), 0])
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        """Texts of runs of ids: run k lies between cuts k and k+1."""
        ids = np.where((ids < 0) | (ids >= len(self.lengths) - 1), len(self.lengths) - 1, ids)
        lengths = self.lengths[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        spelled = self.blob[np.repeat(self.begins[ids] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
        places = ends[cuts].tolist()
        return [spelled[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(places[:-1], places[1:])]


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast, remembered: int = REMEMBERED) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(Vocabulary(*vocabulary.value), remembered)
    for batch in in_parts(batches, 100):
        texts = batch["caption"].to_pylist()
        ids = [encoder.encode(t) if t is not None else b"" for t in texts]
        counts = np.array([len(x) // 4 for x in ids], np.int64)
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        values = pa.Array.from_buffers(pa.int32(), int(counts.sum()), [None, pa.py_buffer(b"".join(ids))])
        missing = pa.array([t is None for t in texts])
        lists = pa.ListArray.from_arrays(offsets, values, mask=missing)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(counts), lists], names=["id", "n_pieces", "pieces"])


def encode_captions(posts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Encode whole captions of media posts into piece ids: ``id``, ``n_pieces``, ``pieces``.

    Spaces become space marks and one is put in front, as the model does; nothing else is normalised. The
    segmentation has the highest sum of piece scores; characters that no piece covers are spelled in byte pieces (or
    the unknown piece where the model has no bytes). A space mark that occurs in a caption is spelled in bytes, so
    that decoding gives back every caption exactly.

    Rows stay where they are; the vocabulary, whose size is the model file's, is sent to the tasks. One row
    per row of ``posts``. A null caption has null pieces, an empty one none, both count 0.
    """
    kind = posts.schema["id"].dataType.simpleString()
    shared = SparkSession.active().sparkContext.broadcast(tuple(vocabulary))
    return posts.select("id", "caption").mapInArrow(lambda b: _encode(b, shared), f"id {kind}, n_pieces long, pieces array<int>")


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(Vocabulary(*vocabulary.value))
    for batch in in_parts(batches, 100):
        lists = batch["pieces"]
        counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
        texts = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(counts))))
        columns = [*batch.columns, pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "caption"])


def decode_captions(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add to rows with ``id``, ``n_pieces`` and ``pieces`` the ``caption`` that the pieces spell. Null pieces give null."""
    kind = encoded.schema["id"].dataType.simpleString()
    shared = SparkSession.active().sparkContext.broadcast(tuple(vocabulary))
    rows = encoded.select("id", "n_pieces", "pieces")
    return rows.mapInArrow(lambda b: _decode(b, shared), f"id {kind}, n_pieces long, pieces array<int>, caption string")


def round_trip(posts: DataFrame, vocabulary: Vocabulary, remembered: int = REMEMBERED) -> DataFrame:
    """``encode_captions`` and ``decode_captions`` in one pass: ``id``, ``n_pieces``, ``pieces`` and the ``caption`` that the pieces
    spell. The pieces are decoded in the worker that made them, so a task needs one worker and they move once.
    ``remembered`` chunks are looked up instead of encoded again: fewer take less memory and more time."""
    kind = posts.schema["id"].dataType.simpleString()
    shared = SparkSession.active().sparkContext.broadcast(tuple(vocabulary))
    rows = posts.select("id", "caption")
    return rows.mapInArrow(lambda b: _decode(_encode(b, shared, remembered), shared), f"id {kind}, n_pieces long, pieces array<int>, caption string")

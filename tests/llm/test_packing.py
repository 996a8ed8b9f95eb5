"""Packing against best-fit decreasing on one list, and token ids against the tokenizer."""

import bisect
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postlake.llm import packing as P
from postlake.llm.queries import QUERIES
from tests.llm.helpers import caption, empty, posts

MODEL = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
TOKENIZER = Tokenizer.from_str(MODEL)
ENCODER = P.Encoder(MODEL, P.merge_ranks(MODEL))


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def best_fit(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        n += gap == capacity
        bisect.insort(gaps, gap - length)
    return n


def laid(runs, counts):
    """Sequences of all pieces, by the runs."""
    sequences, ranks = {}, {length: set() for length in counts}
    for run in runs:
        for k in range(run.count):
            ranks[run.length].add(run.first_rank + k)
            place = run.offset + k % run.copies * run.length
            sequences.setdefault(run.first_sequence + k // run.copies, []).append((place, run.length))
    assert all(seen == set(range(counts[length])) for length, seen in ranks.items())
    return sequences


def is_tight(sequence, capacity):
    at = 0
    for place, length in sorted(sequence):
        if place != at:
            return False
        at += length
    return at <= capacity


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=300), st.sampled_from([40, 64]))
def test_supersteps_lay_every_piece_once(lengths, capacity):
    counts = {n: lengths.count(n) for n in set(lengths)}
    sequences = laid(P.supersteps(counts, capacity), counts)
    assert all(is_tight(s, capacity) for s in sequences.values())
    assert len(sequences) <= 1.06 * best_fit(lengths, capacity) + 2


@pytest.mark.parametrize("low, high", [(1, 1024), (300, 420), (1, 60), (400, 400), (1, 1), (500, 530)])
def test_as_few_sequences_as_best_fit_decreasing(low, high):
    lengths = np.random.default_rng(3).integers(low, high + 1, 20_000).tolist()
    counts = {n: lengths.count(n) for n in set(lengths)}
    n = len(laid(P.supersteps(counts, 1024), counts))
    assert n <= 1.002 * best_fit(lengths, 1024) + 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x00\xa0'aäß.,1"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_ids_equal_the_tokenizer(texts):
    texts = [*texts, *texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode(texts)] == [plain_ids(t) for t in texts]


def test_ids_of_texts_with_special_tokens():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "it's  we'll\n\n x ", " lead", "a\n b"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode(texts)] == [plain_ids(t) for t in texts]


def test_tokenizers_of_other_kinds_are_used_as_they_are():
    assert P.merge_ranks(MODEL)
    assert P.merge_ranks(MODEL.replace('"add_prefix_space":false', '"add_prefix_space":true').replace('"add_prefix_space": false', '"add_prefix_space": true')) is None
    other = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    assert P.merge_ranks(other) is None
    got = P.Encoder(other, None).encode(["Matcha LATTE"])
    assert np.frombuffer(got[0], "<u4").tolist() == Tokenizer.from_str(other).encode("Matcha LATTE", add_special_tokens=False).ids


def check_packed(rows, texts, capacity):
    """rows: (key of the text, piece, start, length, crc, sequence, offset)"""
    pieces, sequences = {}, {}
    for key, piece, start, length, crc, sequence, offset in rows:
        pieces.setdefault(key, []).append((piece, start, length, crc))
        sequences.setdefault(sequence, []).append((offset, length))
    assert all(is_tight(s, capacity) for s in sequences.values())
    for key, text in texts.items():
        ids = [*plain_ids(text), 2]
        n = -(-len(ids) // capacity)
        first = len(ids) - (n - 1) * capacity
        want = []
        for k in range(n):
            start = 0 if k == 0 else first + (k - 1) * capacity
            part = ids[start : first + k * capacity]
            want.append((k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        assert sorted(pieces.pop(key)) == want
    assert not pieces
    return len(sequences)


def test_captions_are_packed_whole(spark):
    draw = random.Random(8)
    rows = [(f"p{n}", draw.choice([None, "", caption(n, draw.randrange(1, 300)), "same"])) for n in range(200)]
    rows += [("long", caption(7, 9_000))]
    out = P.pack_captions(posts(spark, rows), MODEL, capacity=256)
    got = out.select("id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids").collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    n = check_packed([tuple(r)[:7] for r in got], dict(rows), 256)
    lengths = [r.length for r in got]
    assert n <= best_fit(lengths, 256) + 2


def test_repeated_rows_and_missing_ids(spark):
    out = P.pack_captions(posts(spark, [("a", "x y"), ("a", "x y"), (None, "z"), (None, None)]), MODEL)
    rows = [(r.id, r.length, r.offset, r.sequence_id) for r in out.collect()]
    assert len(rows) == 4 and len(set(rows)) == 4 and len({r[3] for r in rows}) == 1


def test_empty_table(spark):
    assert P.pack_captions(empty(posts(spark, [("a", "x")])), MODEL).count() == 0


def test_query_packs_all_documents(spark):
    out = QUERIES["op12_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    n = check_packed([tuple(r) for r in out], texts, 1024)
    assert n <= best_fit([r.length for r in out], 1024) + 2

import itertools
import math

import numpy as np
import pytest
import sentencepiece

from postlake.llm import sentencepiece_codec as sp
from postlake.llm.queries import TOKENIZER
from tests.llm.helpers import caption, empty, post_id, posts, rows_of

TEXTS = ["", " ", "Hello  world", "a\nb\r\n\tc ", "日本語の抹茶 ラテ", "naïve café 🍵🍵", "▁mark ▁ inside▁", "\u0000​ x", "###***   %%%", "x" * 3000, None]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.read_vocabulary(TOKENIZER)


def ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


def best_score(text, scores, floor):
    """Plain dynamic programme over all pieces."""
    best = [0.0] + [-math.inf] * len(text)
    longest = max(map(len, scores))
    for end in range(1, len(text) + 1):
        best[end] = best[end - 1] + floor
        for begin in range(max(0, end - longest), end):
            if text[begin:end] in scores:
                best[end] = max(best[end], best[begin] + scores[text[begin:end]])
    return best[-1]


def test_round_trip_is_exact_and_pieces_are_best(spark, vocabulary):
    texts = TEXTS + [caption(k, 40) for k in range(20)]
    encoded = sp.encode_captions(posts(spark, [(post_id(k), t) for k, t in enumerate(texts)]), vocabulary)
    decoded = {r[0]: r[1:] for r in rows_of(sp.decode_captions(encoded, vocabulary), "id", "caption", "pieces", "n_pieces")}
    both = sp.round_trip(posts(spark, [(post_id(k), t) for k, t in enumerate(texts)]), vocabulary)
    assert {r[0]: r[1:] for r in rows_of(both, "id", "caption", "pieces", "n_pieces")} == decoded
    scores = {t: s for _, t, s in vocabulary.pieces}
    by_id = {k: s for k, _, s in vocabulary.pieces}
    floor = min(scores.values()) - sp.UNKNOWN_PENALTY
    for k, text in enumerate(texts):
        back, pieces, n = decoded[post_id(k)]
        assert back == text
        assert n == len(pieces or [])
        if text and sp.SPACE not in text and all(p in by_id for p in pieces):
            assert sum(by_id[p] for p in pieces) == best_score(sp.SPACE + text.replace(" ", sp.SPACE), scores, floor)


def test_toy_model_against_all_segmentations():
    pieces = [(0, "▁", -2.0), (1, "a", -3.0), (2, "ab", -4.0), (3, "b", -2.5), (4, "bab", -3.5), (5, "▁a", -3.2), (6, "aba", -5.0)]
    encoder = sp.Encoder(sp.Vocabulary(pieces, [-1] * 256, 9))
    texts = {k: (t, s) for k, t, s in pieces}
    for letters in itertools.chain.from_iterable(itertools.product("ab", repeat=n) for n in range(1, 7)):
        word = "▁" + "".join(letters)
        found = encoder.viterbi(word)
        assert "".join(texts[k][0] for k in found) == word
        assert sum(texts[k][1] for k in found) == pytest.approx(best_score(word, {t: s for _, t, s in pieces}, -15.0))
    assert ids(encoder.encode("aXb")) == [5, 9, 3]


def test_cut_texts_give_the_pieces_of_whole_texts(vocabulary):
    encoder = sp.Encoder(vocabulary)
    for text in TEXTS[1:6] + [caption(5, 50)]:
        whole = sp.SPACE + text.replace(" ", sp.SPACE)
        assert ids(encoder.encode(text)) == encoder.viterbi(whole)


def test_pieces_decode_as_the_library_decodes(vocabulary):
    model, encoder = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER), sp.Encoder(vocabulary)
    for text in ["Hello  world", "naïve café 🍵", caption(6, 30)]:
        assert model.decode(ids(encoder.encode(text))) == text


def test_repeated_rows_null_ids_and_empty_table(spark, vocabulary):
    table = posts(spark, [(None, "a b"), (None, "a b"), (post_id(1), None)])
    assert len(rows_of(sp.encode_captions(table, vocabulary), "id")) == 3
    assert rows_of(sp.decode_captions(sp.encode_captions(empty(table), vocabulary), vocabulary), "id") == []

"""What the encoder does for each word and each piece, and its order of suffixes."""

import random
import sys

import numpy as np
import sentencepiece

from shelfwise.llm import piece_model
from shelfwise.llm.piece_model import PACK, SPACE, PieceModel
from shelfwise.llm.sentence_pieces import MODEL


def test_words_with_strange_characters_cost_no_call_for_each_piece():
    model = PieceModel.load(MODEL)
    deal = random.Random(3)
    words = [SPACE + "".join(deal.choices("abcdeinorst", k=40)) + "漢😀"[k % 2] for k in range(4000)]
    calls = 0

    def count(frame, event, argument):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        found = model.encode_words(words)
    finally:
        sys.setprofile(None)
    assert calls < 8 * len(words)
    ids, counts = found
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ends = np.cumsum(counts)
    for word, a, b in list(zip(words, ends - counts, ends, strict=True))[::37]:
        assert ids[a:b].tolist() == library.encode(word[1:])


def test_no_words():
    ids, counts = PieceModel.load(MODEL).encode_words([])
    assert len(ids) == len(counts) == 0


def test_suffix_order_is_that_of_the_keys():
    deal = random.Random(5)
    for size, width in [(1, 4), (3, 4), (200, 1), (200, 2), (500, 3), (500, 4)]:
        codes = [deal.choice([1, 1, 2]) for _ in range(size - 1)] + [0]
        padded = codes + [0] * PACK * 8
        keys = np.array([sum(padded[k + j] << 16 * (PACK - 1 - j) for j in range(PACK)) for k in range(size)], np.uint64)
        order = piece_model._suffix_order(keys, width).tolist()
        assert sorted(order) == list(range(size))
        ordered = [padded[k : k + PACK * width] for k in order]
        assert ordered == sorted(ordered)

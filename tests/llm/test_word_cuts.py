"""Words cut before the tokenizer's model against the whole tokenizer."""

import random

import numpy as np
import pytest

pytest.importorskip("tokenizers")
from merchpulse.llm import idcodec  # noqa: E402
from merchpulse.llm.queries import tokenizer_path  # noqa: E402

PARTS = ["a", "B", "é", "×", "÷", "Ā", "ɏ", "ɐ", "ª", "²", "1", "9", "٣", "'", "'s", "’", "-", "*", "\x1c", "\x7f", " ", " ", "  ", "\t", "\n", "中", "😀"]


def test_cuts_settle_plain_words_only():
    words = [b" su,***", b"ab12", b"it's", " ñandú!".encode(), "×".encode(), "中".encode()]
    buf, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    cuts, unsettled = idcodec.cut_words(buf, np.cumsum(size) - size)
    assert unsettled.tolist() == [False, False, True, False, True, True]
    assert cuts[:4].tolist() == [0, 3, 7, 9]


def test_model_gets_settled_words_and_ids_stay():
    encoder = idcodec.PieceEncoder(tokenizer_path())
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(50))) for _ in range(2000)]
    ids, sizes = encoder.encode([t.encode() for t in texts], 0)
    want = [[*e.ids, 0] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]

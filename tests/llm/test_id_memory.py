"""What the tokenizer's memory saves, and the coder's symbols found at once
against a plain walk over the ids."""

import numpy as np
import pytest

pytest.importorskip("tokenizers")
from merchpulse.llm import idcodec  # noqa: E402
from merchpulse.llm.queries import tokenizer_path  # noqa: E402


class Spy:
    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.given += [run for t in texts for run in t.split("\n")]
        return self.tokenizer.encode_batch_fast(texts, **options)


def check(encoder, texts):
    ids, sizes = encoder.encode([t.encode() for t in texts], 0)
    want = [[*e.ids, 0] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_known_runs_are_not_encoded_again():
    encoder = idcodec.PieceEncoder(tokenizer_path())
    check(encoder, ["alpha beta7 gamma alpha"])
    encoder.words = Spy(encoder.words)
    check(encoder, ["alpha, beta! gamma... beta7, alpha;alpha gamma! beta"])
    assert sorted(encoder.words.given) == ["!", ",", "...", ";"]  # beta was cut from its digit


def test_full_memory_keeps_what_is_met_again(monkeypatch):
    monkeypatch.setattr(idcodec, "MEMORY", 100)
    encoder = idcodec.PieceEncoder(tokenizer_path())
    encoder.words = Spy(encoder.words)
    for i in range(40):
        check(encoder, ["common words, here and now " + " ".join(f"rare{i}x{j}y" for j in range(9))])
        assert len(encoder.hashes) + len(encoder.late[0]) < 150
    assert encoder.words.given.count("Ġwords") == encoder.words.given.count("common") == 1


def test_symbols_at_once_are_those_of_a_walk():
    rng = np.random.default_rng(4)
    ranks = np.stack([rng.integers(0, n, 300) for n in (1, 2, 5, 40, 60_000)]).astype(np.int32)
    context = rng.integers(0, 30, ranks.shape)
    predicted, confidence = idcodec._followed(context, ranks)
    for row in range(len(ranks)):
        slots = {}
        for t, (c, rank) in enumerate(zip(context[row].tolist(), ranks[row].tolist())):
            last, sure = slots.get(c, (-1, 0))
            assert (predicted[row, t], confidence[row, t]) == (last, sure)
            slots[c] = rank, min(sure + 1, 3) if last == rank else int(last < 0)


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 1023, 1025, 140_000])
def test_round_trip_over_groups_of_blocks(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_000).astype("<u4")
    assert (idcodec.read_chunk(idcodec.write_chunk(ids)) == ids).all()

"""Passages are removed by their bytes: runs that hashes may confuse, many
variants of one anchor, repetitive texts."""

import random

import pytest

from merchpulse.llm import suffixdedup
from merchpulse.llm.textbytes import prefix_sums, span_hash

SCHEMA = "doc_id long, text string"


def brute(rows):
    least = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for p in range(len(b) - 49):
            least[b[p : p + 50]] = min(d, least.get(b[p : p + 50], d))
    want = {}
    for d, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < d:
                gone[p : p + 50] = b"\1" * 50
        want[d] = (len(b), sum(gone))
    return want


def passages():
    rnd = random.Random(1)
    base = "".join(rnd.choices("abcdefgh ", k=3000))
    rows = []
    for i in range(150):
        a, n, c = rnd.randrange(2800), rnd.randrange(20, 300), rnd.randrange(2900)
        rows.append((i, base[a : a + n] + "".join(rnd.choices("abc", k=30)) + base[c : c + 60]))
    rows += [(200, "a" * 5000), (201, "a" * 7000 + "b"), (202, "ab" * 3000), (203, None), (204, "ab" * 20 + "x" + "a" * 60)]
    # two runs of one anchor whose bytes beside it have equal 32-bit hashes
    rows += [(300, "x9ncxaigxh8bheqwimz1lucljqw42xv2ua5xxrmqxg3w7kjht2hutpbmma2xs9hqkxsdo"),
             (301, "x9ncxaigxh8bheqwimz1lucljqw42xv2ua5xxrmqxg3w7kjht219pay9hrvmj9fx4brzq")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("variants", [20_000, 2])
def test_only_repeated_bytes_go(spark, monkeypatch, variants):
    """In one task by factor arrays, and anchors of many runs by windows."""
    monkeypatch.setattr(suffixdedup, "MAX_VARIANTS", variants)
    rows = passages()
    got = suffixdedup.dedup_passages(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in got} == want and want[301] == (69, 50)


def test_repetitive_text_is_few_runs():
    import numpy as np

    runs = suffixdedup.find_runs([b"a" * 100_000], np.array([1]))
    assert len(runs["start"]) == -(-(100_000 - 49) // suffixdedup.LONGEST)


def test_anchors_are_no_more_than_meeting_places(spark):
    """A core of 50 bytes with many tails: only the core is repeated."""
    import numpy as np

    core = "x9ncxaigxh8bheqwimz1lucljqw42xv2ua5xxrmqxg3w7kjht2"
    rnd = random.Random(3)
    rows = [(i, core + "".join(rnd.choices("0123456789abcdef", k=19))) for i in range(3000)]
    got = suffixdedup.dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in got} == want and max(n for _, n in want.values()) < 60
    buf = np.frombuffer(core.encode(), np.uint8)
    assert span_hash(prefix_sums(buf), np.array([0]), np.array([12]))[0] != span_hash(prefix_sums(buf), np.array([1]), np.array([13]))[0]

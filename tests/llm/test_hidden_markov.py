"""Hidden Markov scores against a plain program over all training words."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from merchpulse.llm import hmm


def texts():
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefé", k=rnd.randint(1, 4))) for _ in range(150)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 7, 60])))) for i in range(50)]
    rows += [(50, "Only\tHERE  once"), (51, None), (52, ""), (53, " ".join(rnd.choices(words, k=700))), (3, "same id"), (None, rows[4][1])]
    return rows + [rows[7], (60, "new1 new2 new1 " + rows[1][1]), (70, "unseen"), (74, "unseen words only"), (77, rows[2][1])]


def is_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 10 == 0


def plain(rows, states, rounds):
    lists = [(k, (t or "").encode().lower().split() + [b""]) for k, t in rows]
    c = Counter(w for k, ws in lists if not is_held(k) for w in ws)
    n, types = sum(c.values()), len(c)
    under = n + hmm.ALPHA * (types + 1)
    words = list(c)
    prior = hmm.PRIOR / under
    found = {w: c[w] * f / f.sum() for w, f in zip(words, hmm.noise(words, states))}
    smooth = hmm.ALPHA * sum(found.values()) / n
    weights = {w: found[w] + smooth + prior * (c[w] + hmm.ALPHA) for w in words}
    unknown = smooth + prior * hmm.ALPHA
    start, move = np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    for _ in range(rounds):
        norm = sum(weights.values()) + unknown
        later = np.linalg.matrix_power(move, 5000)[0]
        starts, moves, found = np.full(states, 0.1), np.full((states, states), 0.1), {w: np.zeros(states) for w in words}
        for k, ws in lists:
            if is_held(k):
                continue
            for a in range(0, len(ws), hmm.LANE):
                lane = [weights[w] / norm for w in ws[a : a + hmm.LANE]]
                alpha = [(start if a == 0 else later) * lane[0]]
                alpha[0] /= alpha[0].sum()
                for e in lane[1:]:
                    x = (alpha[-1] @ move) * e
                    alpha.append(x / x.sum())
                beta = np.ones(states)
                for t in range(len(lane) - 1, -1, -1):
                    gamma = alpha[t] * beta / (alpha[t] * beta).sum()
                    found[ws[a + t]] += gamma
                    if t:
                        pair = alpha[t - 1][:, None] * move * (lane[t] * beta)[None]
                        moves += pair / pair.sum()
                        beta = move @ (lane[t] * beta)
                        beta /= beta.sum()
                if a == 0:
                    starts += gamma
        smooth = hmm.ALPHA * sum(found.values()) / n
        weights = {w: found[w] + smooth + prior * (c[w] + hmm.ALPHA) for w in words}
        unknown = smooth + prior * hmm.ALPHA
        start, move = starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True)
    norm = sum(weights.values()) + unknown
    out = []
    for k, ws in lists:
        p, score = start, 0.0
        for t, w in enumerate(ws):
            p = (p @ move if t else p) * weights.get(w, unknown) / norm
            score += math.log10(p.sum())
            p = p / p.sum()
        out.append((k, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + hmm.ALPHA) / under) for w in ws), score))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_bytes, part_places", [(hmm.SLICE_BYTES, hmm.PART_PLACES), (600, 40)])
def test_scores_equal_a_plain_program(spark, slice_bytes, part_places):
    rows = texts()
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, symbols int")
    got = sorted(
        [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in hmm.score_documents(docs, states=3, rounds=2, part_places=part_places, slice_bytes=slice_bytes).collect()],
        key=lambda r: str((r[0], r[1])),
    )
    want = sorted(plain(rows, 3, 2), key=lambda r: str((r[0], r[1])))
    assert any(is_held(k) for k, _ in rows) and len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[1], round(r[4], 6))), sorted(want, key=lambda r: (str(r[0]), r[1], round(r[4], 6)))):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and g[5] == pytest.approx(w[5], rel=2e-4)


def test_only_held_out_texts_are_all_unknown(spark):
    keys = [k for k in range(200) if is_held(k)][:3]
    got = hmm.score_documents(spark.createDataFrame([(k, "a b") for k in keys], "doc_id long, text string"), states=2).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, pytest.approx(0, abs=1e-6))] * 3


def test_probabilities_of_one_symbol_sum_to_one(spark):
    docs = spark.createDataFrame([(k, t) for k, t in texts()], "doc_id long, text string")
    chain, _, replies = hmm.train(docs, states=3, rounds=1)
    seen = {}
    for r in replies.where("slice >= 0").collect():
        c, shares = np.frombuffer(r["c"], np.int64), np.frombuffer(r["shares"], np.uint16).reshape(-1, 3)
        for i, x in enumerate(np.frombuffer(r["idx"], np.int32)):
            if c[i]:
                seen[r["part"], int(x)] = c[i] * shares[i] / 65535 + chain.flat + chain.prior * (c[i] + hmm.ALPHA)
    total = sum(seen.values()) + chain.flat + chain.prior * hmm.ALPHA
    assert len(seen) == chain.n_types and total / chain.norm == pytest.approx(np.ones(3), rel=1e-9)

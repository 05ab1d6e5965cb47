"""The toxicity field against enumeration of all label sequences, its spans and
the documents that it learns from."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from merchpulse.llm import crf


def enumerated(flat, move):
    """Marginals and expected pairs from every label sequence."""
    p, pairs, whole = np.zeros(len(flat)), np.zeros((2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=len(flat)):
        weight = np.exp(sum(s * v for s, v in zip(flat, y)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        whole += weight
        p += weight * np.array(y)
        for a, b in zip(y, y[1:]):
            pairs[a, b] += weight
    return p / whole, pairs / whole


def test_marginals_and_pairs_equal_enumeration():
    rng = np.random.default_rng(4)
    move = rng.normal(size=(2, 2))
    lines = [rng.normal(scale=2, size=n) for n in (4, 1, 7, 0, 7, 2)]
    got, pairs = crf.forward_backward(lines, move, pairs=True)
    expected = np.zeros((2, 2))
    for line, p in zip(lines, got):
        if len(line):
            q, more = enumerated(line, move)
            assert np.allclose(p, q)
            expected += more
        else:
            assert len(p) == 0
    assert np.allclose(pairs, expected)
    assert np.isclose(pairs.sum(), sum(max(len(x) - 1, 0) for x in lines))
    none, pairs = crf.forward_backward([np.zeros(0), np.zeros(0)], move, pairs=True)
    assert [len(x) for x in none] == [0, 0] and not pairs.any()


def test_shares():
    assert crf.shares(50, 50, 1000) == (50, 50)
    assert crf.shares(10, 100_000, 1000) == (10, 990)
    assert crf.shares(5_000, 95_000, 1000) == (200, 800)
    assert crf.shares(60_000, 40_000, 1000) == (600, 400)
    assert crf.shares(0, 7, 3) == (0, 3)


def labelled(n, every):
    rnd = random.Random(8)
    clean, bad = [f"word{i}" for i in range(50)], ["vilething", "vilesome", "nasty"]
    rows = []
    for d in range(n):
        w = rnd.choices(clean, k=30)
        if d % every == 0:
            w[7:7] = rnd.choices(bad, k=4)
        rows.append((d, " ".join(w), int(d % every == 0)))
    return rows


def test_spans_are_the_offending_words(spark):
    rows = labelled(400, 4) + [(1001, "word1 word2 été NASTY vilesome, vilething! word3", 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, x) for d, _, x in rows if d < 1000], "doc_id long, toxic int")
    got = {r.doc_id: r.spans for r in crf.toxicity(docs, labels).collect()}
    for d, text, x in rows:
        words = [text.encode()[s.start : s.end].lower() for s in got[d]]
        assert set(words) <= {b"nasty", b"vilesome", b"vilething"} and bool(words) == bool(x)
    assert [text.encode()[s.start : s.end] for s in got[1001]] == [b"NASTY", b"vilesome", b"vilething"]


def test_learning_from_a_bounded_number_with_repeated_rows_and_labels(spark):
    rows = labelled(2000, 20)
    docs = spark.createDataFrame([(d, t, "clash") for d, t, _ in rows + rows[:300] + [rows[41]] * 500], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(d, x, "other") for d, _, x in rows] + [(5_000_000, 1, "no such text")] * 3, "doc_id long, toxic int, text string")
    got = crf.toxicity(docs, labels, sample=60).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("predicted").alias("lo"), F.max("predicted").alias("hi"))
    got = {r.doc_id: r for r in got.collect()}
    assert all(got[d].lo == got[d].hi == x for d, _, x in rows) and got[41].n == 502 and got[0].n == 2
    field = crf.learn(docs, labels, sample=60, counted=300)
    assert field.regression is not None and abs(field.rate - 1 / 20) < 0.02


def test_drawn_by_label(spark):
    known = spark.createDataFrame([(i, i % 3 == 0) for i in range(3000)], "doc_id long, toxic boolean")
    n = crf.drawn(known, 1000, 2000, 600).groupBy("toxic").count().collect()
    n = {r.toxic: r["count"] for r in n}
    assert abs(n[True] - 200) < 60 and abs(n[False] - 400) < 90
    assert crf.drawn(known, 1000, 2000, 5000).count() == 3000

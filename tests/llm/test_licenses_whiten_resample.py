"""License scans, whitening and resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchpulse.llm import licenses, resample, whiten

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words(t):
    return WORD.findall((t or "").encode().lower().decode())


def texts():
    rnd = random.Random(11)
    filler = ["lorem", "ipsum", "the", "license", "apache", "cc", "by", "mit", "gnu", "general", "public", "été"]
    rows = [" ".join(rnd.choices(filler, k=rnd.choice([0, 1, 5, 30, 300]))) for _ in range(60)]
    notice = next(t for t in licenses.NOTICES if t.label == "mit-text").text
    cut = notice.split()
    rows += [
        None, "", "CC-BY", "the MIT License. MIT LICENSE; mit  license", "GNU General Public", "License",
        "Intro text. " + notice + " tail", " ".join(cut[:30] + ["inserted", "words"] + cut[30:]), " ".join(cut[:20]), " ".join(cut[::2]),
        "x " * 1023 + "Licensed under the Apache License, Version 2.0.", ("cc by " * 3000).strip(), "MIT License", "mıt license",
    ]
    return [(i, t) for i, t in enumerate(rows)] + [(3, "another text of id 3: mit license"), (5, rows[5])]


def places(w, phrase):
    p = phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]


def test_licenses(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows] + [(None, "mit license", None, None, None)], "doc_id long, text string, label string, template string, n_words int")
    got = licenses.licenses(docs).collect()
    want = Counter()
    for i, t in rows + [(None, "mit license")]:
        w = words(t)
        at = {p: places(w, p) for p in PHRASES}
        every = sorted(x for xs in at.values() for x in xs)
        want[(i, len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(PHRASES[p] for p in at if at[p])))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    by = {(r.doc_id, r.n_words): r for r in got}
    notice = next(t for t in licenses.NOTICES if t.label == "mit-text").text
    first = len(texts()) - 2 - 14  # where the hand-made texts begin
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in got)
    named = lambda k: next(r for r in got if r.doc_id == first + k)
    assert named(6).labels == "mit-text" and named(6).score == 1
    assert [(p.first_word, p.last_word) for p in named(6).places] == [(2, 1 + len(words(rows[first + 6][1])) - 3)]
    # two neighbouring diagonals, with two words between them
    assert named(7).labels == "mit-text" and [(p.first_word, p.last_word, p.share) for p in named(7).places] == [(0, len(words(notice)) + 1, 1)]
    assert named(8).labels == "" and 0 < named(8).score < 0.6
    assert named(9).score == 0
    assert named(10).labels == "apache,apache-2.0" and named(10).first_word == 1023 + 3
    assert named(11).n_base == 3000
    assert by[(None, 2)].labels == "mit"
    assert licenses.licenses(docs.limit(0)).count() == 0


def test_a_span_is_the_share_its_votes_cover(spark):
    t = licenses.Template("t", "t", " ".join(f"w{i}" for i in range(20)))
    rnd = random.Random(2)
    rows = []
    for i in range(40):
        w = [f"w{k}" for k in range(20)]
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = "other"
        rows.append((i, " ".join(["before"] * rnd.randrange(5) + w)))
    got = {r.doc_id: r.share for r in licenses.spans(spark.createDataFrame(rows, "doc_id long, text string"), [t]).collect()}
    for i, text in rows:
        w = words(text)
        covered = set()
        for p in range(len(w) - 4):
            if all(x.startswith("w") for x in w[p : p + 5]):
                covered |= {*w[p : p + 5]}
        assert got.get(i, 0) == pytest.approx(len(covered) / 20)


def vectors(n=300, d=12):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((n, d)) * np.linspace(3, 0.2, d) @ np.linalg.qr(rng.standard_normal((d, d)))[0]
    return base.astype(np.float32)


def whitened(rows, d):
    """By exact integers and NumPy's own solver."""
    x = [tuple(math.floor(256 * float(c)) + 0 for c in v) + (0,) * (d - len(v)) for v in rows]
    fit = np.array(sorted(set(x)), object)
    n, s = len(fit), fit.sum(axis=0)
    z = n * fit - s
    v = np.array([[float(c) / n**3 for c in row] for row in z.T.dot(z)], float)
    e, u = np.linalg.eigh(v)
    return x, n, s, e[::-1], u[:, ::-1]


def test_whitening(spark):
    d, base = 12, vectors()
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(50)] + [(7, rows[7][1]), (None, rows[8][1]), (2000, rows[9][1][:5])]
    bad = [(3000, None), (3001, []), (3002, [1.0] * 11 + [None]), (3003, [float("nan")] * 12), (3004, [float("inf")] * 12)]
    table = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows + bad], "vec_id long, embedding array<float>, component string, n int").repartition(5)
    got = whiten.whiten(table, k=4).collect()
    x, n, s, e, u = whitened([v for _, v in rows], d)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    want = {(i, c + 1): [] for i, _ in rows for c in range(4)}
    for (i, _), xs in zip(rows, x):
        z = n * np.array(xs, object) - s
        for c in range(4):
            want[(i, c + 1)].append((int((z * z).sum()), float((z.astype(float) / n) @ u[:, c]) / math.sqrt(e[c])))
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        dev = [w for w in want[(r.vec_id, r.component)] if w[0] == r.deviation]
        assert dev
        signs.setdefault(r.component, np.sign(r.whitened * dev[0][1]))
        assert min(abs(r.whitened - signs[r.component] * w[1]) for w in dev) < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-10) and r.identity_error < 1e-9
    assert whiten.whiten(table.limit(0)).count() == 0
    assert whiten.whiten(table.where("vec_id = 7")).count() == 0  # one distinct vector has no spread


def test_products_beyond_doubles_are_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**62), 2**62, (50, 3))
    want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
    assert whiten._exact_products(x).tolist() == want
    limbs = [c.to_pylist() for c in whiten._limbs([w for row in want for w in row])]
    assert [sum(c[k] << (32 * i) for i, c in enumerate(limbs)) for k in range(9)] == [w for row in want for w in row]


@pytest.mark.parametrize("kind", ["spread", "equal", "close", "low rank", "graded", "one", "zero"])
def test_contours_miss_no_eigenvalue(kind):
    rng = np.random.default_rng(3)
    d = 30
    e = {
        "spread": np.linspace(1, 30, d), "equal": np.r_[np.full(5, 7.0), rng.random(d - 5)], "close": 1 + np.arange(d) * 1e-9,
        "low rank": np.r_[[5.0, 2.0], np.zeros(d - 2)], "graded": 10.0 ** -np.arange(d), "one": np.array([3.0]), "zero": np.zeros(4),
    }[kind]
    q = np.linalg.qr(rng.standard_normal((len(e), len(e))))[0]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    for s in (0.5, 1.5, 6.0):
        assert whiten.below(v, s) == (np.linalg.eigvalsh(v) < s).sum()
    for k in (1, 4, 10):
        got, x = whiten.components(v, k)
        some = np.sort(e)[::-1][:k]
        some = some[some > 1e-11 * max(e.max(), 1e-300)]
        assert len(got) >= len(some) and np.allclose(got[: len(some)], some, rtol=1e-9, atol=1e-12)
        assert np.allclose(x.T @ x, np.eye(x.shape[1]), atol=1e-12)
        assert np.allclose(v @ x, x * got, atol=1e-11 * max(e.max(), 1e-300) + 1e-300)


def features(t, longest):
    w = words(t)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling(spark, longest, monkeypatch):
    monkeypatch.setattr(resample, "SLICE_BYTES", 500)
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices([f"w{k}" for k in range(50)] + ["Été", "THE"], k=rnd.choice([0, 5, 19, 20, 21, 80])))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "..."), (203, "-a b-"), (204, "x " * 5000), (7, rows[7][1])]
    target = ["the w1 w2 w3", None, "", "w4 w5 " * 9]
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows] + [(None, "no id " * 20, None, None)], "doc_id long, text string, score double, rank int")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    rows = rows + [(None, "no id " * 20)]
    buckets = 101
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, longest))
    t_ = Counter(bucket(f) for t in target for f in features(t, longest))
    up, down = sum(s.values()) + buckets, sum(t_.values()) + buckets
    gain = [math.floor(1000 * math.log((t_[b] + 1) * up / ((s[b] + 1) * down))) for b in range(buckets)]
    want, able = [], []
    for i, t in rows:
        f = features(t, longest)
        weight, score = sum(gain[bucket(x)] for x in f), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words(t)) >= 20:
                able.append((-score, i, len(want)))
        want.append([i, len(f), weight, score, None])
    for rank, (_, _, at) in enumerate(sorted(able)[: 30 * len(able) // 100], 1):
        want[at][4] = rank
    got = resample.resample(docs, bench, percent=30, longest=longest, buckets=buckets).select("doc_id", "n_features", "weight", "score", "rank").collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert resample.resample(docs.limit(0), bench).count() == 0
    assert resample.resample(docs, bench.limit(0), buckets=7).where("rank is not null").count() == 10 * len(able) // 100

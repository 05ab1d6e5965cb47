"""The text operators on a small fixture against brute force: nulls, empty and
long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchpulse.llm import crf, decontam, hmm, htmltext, idcodec, neardup, packing, suffixdedup, urlfilter, vptree
from merchpulse.llm.queries import URL_RULES, tokenizer_path

DOCS = "doc_id long, text string, component_id string, score double"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def corpus():
    rnd = random.Random(3)
    vocabulary = ["the", "and", "of", *("".join(rnd.choices("abcdeé", k=rnd.randint(2, 7))) for _ in range(400))]
    rows = [" ".join(rnd.choices(vocabulary, k=rnd.choice([3, 40, 200]))) for _ in range(60)]
    rows += [rows[5], rows[5], rows[7] + " added", "Ab", "", None, "x" * 300, "y " * 400]
    words = rows[9].split() if len(rows[9].split()) > 50 else " ".join(rows[:9]).split()[:120]
    for i in range(8):  # edited copies
        w = list(words)
        w[rnd.randrange(len(w))] = f"edit{i}"
        rows.append(" ".join(w))
    rows += [rows[0][:20] + " " + " ".join(words[10:40]) + " tail", "Say " + " ".join(words[:30]).upper()]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "extra", 1.0) for i, t in corpus()] + [(None, "no id here", None, None)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(t):
    return (t or "").encode().lower().decode()


def test_decontamination(spark, docs, empty):
    words = WORD.findall(lower(corpus()[70][1]))
    items = [(1, " ".join(words[5:30])), (2, "Ab"), (3, None), (4, ""), (5, " ".join(words[8:20])), (None, "the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n and i else 0):
            windows.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    for blocks in (4 << 20, 10):  # one block, and a block for each item
        got = {r.doc_id: r for r in decontam.contamination(docs, bench, block_bytes=blocks).collect()}
        for d, t in corpus():
            w, hit, found = WORD.findall(lower(t)), set(), set()
            for n in {len(k) for k in windows}:
                for j in range(len(w) - n + 1):
                    if tuple(w[j : j + n]) in windows:
                        hit |= set(range(j, j + n))
                        found |= windows[tuple(w[j : j + n])]
            assert (got[d].n_words, got[d].n_hit, got[d]["items"]) == (len(w), len(hit), sorted(found)), d
    assert decontam.contamination(empty, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_near_duplicates(docs, empty):
    sets = {}
    for d, t in corpus():
        w = re.findall("[^\x20\x09-\x0d]+", lower(t))
        sets[d] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    root = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: r for r in neardup.near_duplicates(docs, 4).collect()}
    assert {d: got[d].component_id for d in sets} == root
    assert all(got[d].n_shingles == len(sets[d]) and got[d].kept == (root[d] == d) for d in sets)
    assert got[None].kept and got[None].component_id is None
    assert neardup.near_duplicates(empty, 4).count() == 0


def test_passages(docs, empty):
    seen, want = set(), {}
    for d, t in corpus():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if b[p : p + 50] in seen:
                gone[p : p + 50] = b"\1" * 50
        seen |= {b[p : p + 50] for p in range(len(b) - 49)}
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.dedup_passages(docs).collect()}
    assert {d: got[d] for d in want} == want and got[None][1] == 0
    stage = {r.doc_id: r for r in suffixdedup.without_repeats(docs).collect()}
    assert len(stage[6].text.encode()) == want[6][0] - want[6][1] and stage[0].component_id == "extra"
    assert suffixdedup.dedup_passages(empty).count() == 0


def test_hidden_markov_scores(docs, empty):
    got = [r for r in hmm.score_documents(docs, states=3, rounds=2).collect()]
    assert len(got) == len(corpus()) + 1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got if r.doc_id is not None)
    train = [r for r in got if not r.held_out]
    assert {r.train_tokens for r in got} == {sum(r.n_tokens for r in train)}
    assert all(r.n_known == r.n_tokens for r in train) and all(r.score < 0 and r.base_score < 0 for r in got)
    assert hmm.score_documents(empty).count() == 0


def test_forward_recursion_is_the_likelihood():
    rng = np.random.default_rng(1)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T
    lines = [rng.integers(0, 5, n).astype(np.int32) for n in (4, 1, 6)]
    symbols, active, order = hmm.packed(lines)
    _, scale = hmm.forward(symbols, active, start, move, emit)
    who = order[np.arange(len(symbols)) - np.repeat(np.cumsum(active) - active, active)]
    for i, line in enumerate(lines):
        p = start * emit[line[0]]
        for s in line[1:]:
            p = (p @ move) * emit[s]
        assert np.log(scale[who == i]).sum() == pytest.approx(np.log(p.sum()))


def test_toxicity(spark, empty):
    rnd = random.Random(5)
    clean = [f"word{i}" for i in range(60)]
    rows = []
    for d in range(300):
        w = rnd.choices(clean, k=40)
        if d % 4 == 0:
            w[5:5] = rnd.choices(["vilething", "vilesome", "nasty"], k=4)
        rows.append((d, " ".join(w), d % 4 == 0))
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows] + [(1000, ""), (1001, None), (None, "nasty nasty nasty nasty")], "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(x)) for d, _, x in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in crf.toxicity(docs, labels).collect()}
    held = [d for d, _, _ in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out for d in held)
    assert all(got[d].predicted == int(d % 4 == 0) for d in held)
    assert got[0].spans and got[1000].predicted == 0 and got[1001].score == got[1000].score and got[None].predicted == 1
    assert crf.toxicity(docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0
    assert crf.toxicity(empty, labels).count() == 0


def test_rare_toxicity_is_in_the_sample(spark):
    rnd = random.Random(6)
    clean = [f"word{i}" for i in range(60)]
    rows = []
    for d in range(3000):
        w = rnd.choices(clean, k=12)
        if d % 150 == 0:
            w[5:5] = rnd.choices(["vilething", "vilesome", "nasty"], k=4)
        rows.append((d, " ".join(w), int(d % 150 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r for r in crf.toxicity(docs.drop("toxic"), docs.drop("text"), sample=20).collect()}
    assert all(got[d].predicted == x for d, _, x in rows)


def test_nearest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[40:80] = x[40]  # a vector that is often repeated
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(900, None), (920, [0.0] * 8), (940, [float("nan")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=70, leaf=16, query_block=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.arange(300)
    for q in range(0, 300, 20):
        s = np.zeros(300)
        for j in range(8):
            s += x[q, j].astype(float) * x[:, j].astype(float)
        best = [i for i in np.lexsort((ids, -s)) if i != q][:20]
        assert sorted(got[q]) == [(n + 1, i, s[i]) for n, i in enumerate(best)]
    assert set(got) == set(range(0, 300, 20))
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_with_ties_and_one_huge_vector(spark):
    rng = np.random.default_rng(4)
    ones = np.eye(100, dtype=np.float32)[rng.permutation(100)]  # one-hot: almost all products are 0
    signs = rng.choice([-1.0, 1.0], (400, 8)).astype(np.float32)
    unit = rng.normal(size=(400, 8))
    unit /= np.sqrt((unit**2).sum(axis=1))[:, None]
    huge = unit.astype(np.float32)
    huge[1] *= 1e9
    for x in (ones, signs, huge):
        ids = rng.permutation(len(x))
        df = spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
        got = {}
        for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=250, leaf=16).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert set(got) == set(range(0, len(x), 20))
        for q, hits in got.items():
            s = np.zeros(len(x))
            for j in range(x.shape[1]):
                s += x[ids == q][0, j].astype(float) * x[:, j].astype(float)
            best = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
            assert sorted(hits) == [(n + 1, ids[i], s[i]) for n, i in enumerate(best)]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><header>Top</header>
<div class="sidebar"><p>side, words, many, commas, here</p></div><div id="cookie-notice"><p>We use cookies, yes</p></div>
<article><h1>A &amp; B</h1><p>First  paragraph, with commas, and
words enough to count as text.<p>Second &lt;one&gt; <a href=y>link</a> text, more of it.</p><script>x("</p>")</script>
<div class="ad"><p>Buy, now</p></div></article><section class="comments"><p>Nice, I liked this, a lot</p></section>
<form><p>Name, mail</p></form><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, "v", None), (3, "w", ""), (4, "x", "<p>" * 3000 + "deep, text" + "<b>" * 3000), (5, "y", "plain < text")]
    got = {r.page_id: r for r in htmltext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "A & B\nFirst paragraph, with commas, and words enough to count as text.\nSecond <one> link text, more of it."
    assert (got[2].text, got[3].text, got[2].n_chars) == ("", "", 0)
    assert got[4].text == "deep, text" and got[5].text == "plain < text"


def test_main_text_keeps_what_only_looks_unlikely():
    words = "First paragraph, with commas, and words enough to count as text."
    for mark in ('<a href="/the-hidden-valley">{}</a>', '<a title="A hidden gem">{}</a>', "<a href='/p?id=comment'>{}</a>", "<a data-id=comment>{}</a>"):
        assert htmltext.extract(f"<article><p>{words} {mark.format('linked')} end</p></article>") == f"{words} linked end"
    for tag in ('div class="post-content with-sidebar"', 'main class="content has-header"', 'main class="has-sidebar"', 'div id=content class="no-search"'):
        assert htmltext.extract(f"<body><{tag}><p>{words}</p></{tag.split()[0]}></body>") == words
    for tag in ("div hidden", "div HIDDEN=''", "div class=ad", "div data-x='a' id=\"comments\"", "div style='display: none'", "div aria-hidden=true"):
        assert htmltext.extract(f"<body><p>{words}</p><{tag}><p>not, this</p></div></body>") == words, tag


def test_url_filter(spark):
    urls = ["http://www.Example.com/en/a?x", "https://a.example.com/en/", "https://a.example.com/fr/", "http://x.net/es/1", "http://x.net", None,
            "no scheme", "http://www.example.com/en/#t", "http://com/q", "http://netx/es/", "http:///path", "http://x.net/es/1"]
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in urlfilter.judge_urls(pages, rules).collect()}
    want = [("www.example.com", "www.example.com/en/", "allow"), ("a.example.com", "example.com/en/", "block"), ("a.example.com", "com/", "allow"),
            ("x.net", "net/es/", "block"), ("x.net", None, "allow"), ("", None, "allow"), ("", None, "allow"),
            ("www.example.com", "www.example.com/en/", "allow"), ("com", "com/", "allow"), ("netx", None, "allow"), ("", None, "allow"), ("x.net", "net/es/", "block")]
    assert [got[i] for i in range(len(urls))] == want


def best_padding(histogram, buckets):
    lengths = [x for x, _ in histogram]
    cost = {(0, 0): 0}
    for b in range(1, buckets + 1):
        for j in range(1, len(lengths) + 1):
            cost[b, j] = min(
                (cost[b - 1, i] + sum(n * (lengths[j - 1] - x) for x, n in histogram[i:j]) for i in range(j) if (b - 1, i) in cost), default=None
            )
            if cost[b, j] is None:
                del cost[b, j]
    return min(v for (b, j), v in cost.items() if j == len(lengths))


def test_boundaries_are_optimal():
    rnd = random.Random(1)
    for _ in range(40):
        lengths = sorted(rnd.sample(range(1, 90), rnd.randint(1, 14)))
        histogram = [(x, rnd.randint(1, 30)) for x in lengths]
        for buckets in (1, 3, 8):
            bounds = packing.optimal_boundaries(histogram, buckets)
            assert len(bounds) <= buckets and bounds[-1] == lengths[-1]
            padding = sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram)
            assert padding == best_padding(histogram, buckets)


def test_packing(docs, empty):
    rows = packing.pack(docs, buckets=4, token_budget=500, group_rows=20).collect()
    assert len(rows) == len(corpus()) + 1
    size = {r.doc_id: len(re.findall("[^\x20\x09-\x0d]+", t or "")) + 1 for r in rows for d, t in corpus() if d == r.doc_id}
    batches = {}
    for r in rows:
        assert r.doc_id is None or r.n_tokens == size[r.doc_id]
        assert 0 <= r.padding == r.bucket_length - r.n_tokens
        batches.setdefault(r.batch_id, []).append(r)
    for b in batches.values():
        assert len({r.bucket for r in b}) == 1 and sorted(r.slot for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0].bucket_length <= 500
    assert packing.pack(empty).count() == 0


def test_token_ids(docs, empty, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    odd = [(900, "a　b \x1c c  \n\n d \t"), (901, "it's  ''s <|endoftext|>!\r\n"), (902, "\x85\xa0 ​ x"), (903, "a <|endoftext|> b")]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    got = idcodec.read_ids(idcodec.write_ids(more, tokenizer_path())).collect()
    at = 0
    for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id)):
        text = "no id here" if r.doc_id is None else dict(corpus() + odd)[r.doc_id] or ""
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes())), r.doc_id
        at += len(ids)
    assert idcodec.read_ids(idcodec.write_ids(empty, tokenizer_path())).count() == 0


def test_damaged_chunk():
    data = bytearray(idcodec.write_chunk(np.arange(5000, dtype="<u4") % 700))
    assert (idcodec.read_chunk(bytes(data)) == np.arange(5000) % 700).all()
    data[-40] ^= 255
    with pytest.raises(ValueError):
        idcodec.read_chunk(bytes(data))


def test_pieces_give_the_tokenizers_ids():
    rng = np.random.default_rng(5)
    bits = ["a", "b c", " ", "  ", "\n", "\t", "\xa0", "é", "日本", "'s", "don't", "23", "!!", "\r\n", "<|endoftext|>", "​", "\x85", "\x1c"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 30))) for _ in range(500)]
    encoder = idcodec.PieceEncoder(tokenizer_path())
    for _ in range(2):  # new pieces, then remembered ones
        ids, sizes = encoder.encode([t.encode() for t in texts], 0)
        for t, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
            assert got.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids + [0]


def test_a_piece_under_a_wrong_hash_is_noticed():
    encoder = idcodec.PieceEncoder(tokenizer_path())
    want, _ = encoder.encode([b"one two three"], 0)
    encoder.begin, encoder.size = encoder.begin[::-1].copy(), encoder.size[::-1].copy()
    assert encoder.encode([b"one two three"], 0)[0].tolist() == want.tolist()

"""Near duplicates at several similarities against brute force, and the tables
that a run leaves."""

import os
import random

import pytest

from merchpulse.llm import neardup
from merchpulse.session import shared_path


def sets_of(texts, width):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def brute(texts, width, percent):
    sets, comp = sets_of(texts, width), list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    return comp


def planted(seed):
    """Pairs with similarities from about 0.4 to 0.9, of short and long texts,
    and two that lie in one another."""
    rnd, texts = random.Random(seed), []
    for n in (12, 60, 400):
        for edits in (0.01, 0.05, 0.08, 0.12, 0.2):
            w = [f"{seed}w{rnd.randrange(10**6)}" for _ in range(n)]
            again = [x if rnd.random() > edits else f"e{rnd.randrange(10**6)}" for x in w]
            texts += [" ".join(w), " ".join(again)]
        texts += [" ".join(w[: n // 2]), " ".join(w[: n * 7 // 10])]
    return texts + [texts[0], "", "one", "one", "two words", None]


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_components_equal_brute_force(spark, percent):
    texts = planted(percent)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 4, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, percent)


def test_thresholds():
    for k in (64, 256):
        least = [neardup.least_common(k, p) for p in range(1, 101)]
        assert least == sorted(least) and least[0] == 1 and least[-1] == k
    assert neardup.least_common(64, 80) <= 64 * 0.8 - 5 * (64 * 0.16) ** 0.5


def test_thue_morse_words_and_what_is_left(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), "x " + word, "x " + word]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = os.path.dirname(shared_path(spark, "look")).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 4).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 2}
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert not left & {"lists", "hubs", "pairs", "postings", "sets", "sketch", "sketches", "classes", "shortlist", "edges"}


def test_edited_copies_below_the_threshold_are_not_paired(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)]
    for c in range(40):  # 10 words of 300 changed: similarities of about 0.76 to the first, 0.6 to one another
        w = list(base)
        for i in rnd.sample(range(5, 295), 10):
            w[i] = f"e{c}x{i}"
        texts.append(" ".join(w))
    paired, written = [], neardup.written

    def counted(df, name, **options):
        out = written(df, name, **options)
        if name == "pairs":
            paired.append(out.count())
        return out

    monkeypatch.setattr(neardup, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 4, 80).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, 80)
    assert sum(paired) <= 2 * len(texts)


def test_short_lists_are_done_in_two_rounds(spark, monkeypatch):
    rnd = random.Random(6)
    parts = [" ".join(f"p{i}w{rnd.randrange(10**6)}" for _ in range(40)) for i in range(9)]
    texts = [f"{parts[i]} {parts[j]}" for i in range(9) for j in range(i)]  # each part in 8 texts, none similar
    texts += [texts[0] + " more", texts[0]]
    lists, written = [], neardup.written

    def counted(df, name, **options):
        lists.extend([name] if name == "lists" else [])
        return written(df, name, **options)

    monkeypatch.setattr(neardup, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 4, 80).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, 80)
    assert len(lists) <= 3  # the last is empty

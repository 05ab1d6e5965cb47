"""Toxicity by a linear-chain conditional random field over words.

Labels are of documents; words of training documents get theirs from them: a
word of a toxic document is labelled toxic if one of its features is much
more frequent in toxic documents than in others.  Features of a word
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, A-Z lower-cased) are the word and its
first 3 to 6 bytes, hashed to ``2**BITS`` buckets.  All learning is from
labelled training documents, whose number is bounded: document frequencies by
label come from about ``COUNTED`` of them (all, if there are fewer), the
field's weights and the step from marginals to a document's score from
``SAMPLE`` of these.  Both are drawn by a hash of the ids, of each label its
share, but at least a fifth of the number or all it has.  The regression
weighs them back to the true rate.  Ids are drawn without reading a text;
they are broadcast, at most about ``COUNTED`` of them, so that texts are read
in place and never shuffled, but for one text of each of the ``SAMPLE``.

Forward-backward gives each word's probability of being toxic in its whole
text.  Their sum, its share above one, their maximum and their density
become a score through logistic regression; words above one half are the
offending spans (byte offsets).

Defined cases: null and empty texts have no words and the score of zero
evidence; documents without an id are scored and never learned from, neither
are labels that are null; several labels of one id count as toxic if one is;
repeated rows are scored each, and counted each, while the field is fitted on
the one whose text has the smallest hash; other columns are not looked at; without
labels of both kinds every score is the rate of toxic labels (0 if none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.hmm import packed
from merchpulse.llm.tables import done_with, rows_with_key, ship_package, text_slices, written
from merchpulse.llm.textbytes import ALNUM, U, Words, prefix_sums, span_hash, split_words

BITS = 20
PREFIXES = (3, 4, 5, 6)
#: Labelled documents that frequencies are counted on, about, and the field is fitted on.
COUNTED = 200_000
SAMPLE = 3_000
LANE = 256
ROUNDS = 25
#: A feature marks toxic words from this log odds and this many toxic documents.
SEED_ODDS, SEED_DOCS = 2.5, 3
THRESHOLD = 0.7
SLICE_BYTES = 4 << 20
NONE = 1 << BITS  # the bucket of features that a word does not have; weight 0
DOCS = NONE + 1  # where documents themselves are counted


def features(words: Words) -> np.ndarray:
    """Buckets of each word's features, a row a word."""
    sums = prefix_sums(words.buf)
    out = np.empty((len(words.starts), 1 + len(PREFIXES)), np.int32)
    out[:, 0] = span_hash(sums, words.starts, words.ends) >> U(64 - BITS)
    for i, k in enumerate(PREFIXES):
        h = span_hash(sums, words.starts, np.minimum(words.starts + k, words.ends)) * U(2 * k + 1)
        out[:, i + 1] = np.where(words.ends - words.starts > k, (h >> U(64 - BITS)).astype(np.int32), NONE)
    return out


def _count_features(batches):
    """Documents with each bucket, by label."""
    for rows, texts in text_slices(batches, SLICE_BYTES):
        words = split_words(texts, ALNUM)
        of = np.repeat(np.arange(len(texts)), np.diff(words.first))
        keys = np.unique((of[:, None] * (NONE + 1) + features(words)).ravel())
        label = np.array(rows.column("toxic").to_pylist(), bool)
        toxic = label[keys // (NONE + 1)]
        bucket, at = np.unique(keys % (NONE + 1), return_inverse=True)
        n = np.bincount(at, minlength=len(bucket))
        t = np.bincount(at, weights=toxic, minlength=len(bucket)).astype(np.int64)
        bucket, n, t = np.append(bucket, DOCS), np.append(n, len(label)), np.append(t, label.sum())
        yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(t), pa.array(n - t)], names=["bucket", "toxic", "clean"])


def marginals(lines: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """Probability of label 1 at each place of some sequences, given each
    place's score of label 1 (label 0 has 0) and the scores of label pairs."""
    return forward_backward(lines, move)[0]


def forward_backward(lines: list[np.ndarray], move: np.ndarray, pairs: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """``marginals``, and with ``pairs`` the expected number of each pair of
    neighbouring labels, from the same pass."""
    flat, active, order = packed_floats(lines)
    # potentials divided by their larger one, so that no score overflows
    high = np.maximum(flat, 0)
    emit = np.stack([np.exp(-high), np.exp(flat - high)], axis=1)
    step = np.exp(move - move.max())
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    base = np.cumsum(active) - active
    before = None
    for b, n in zip(base, active):
        here = emit[b : b + n] if before is None else emit[b : b + n] * (before[:n] @ step)
        before = here / here.sum(axis=1, keepdims=True)
        alpha[b : b + n] = before
    for t in range(len(active) - 1, 0, -1):
        n, b, p = active[t], base[t], base[t - 1]
        here = (emit[b : b + n] * beta[b : b + n]) @ step.T
        beta[p : p + n] = here / here.sum(axis=1, keepdims=True)
    both = alpha * beta
    p = both[:, 1] / both.sum(axis=1)
    expected = np.zeros((2, 2))
    if pairs and len(active) > 1:
        at = np.repeat(np.arange(len(active)), active)
        later = np.flatnonzero(at > 0)
        earlier = base[at[later] - 1] + (later - base[at[later]])
        ahead = emit[later] * beta[later]
        whole = ((alpha[earlier] @ step) * ahead).sum(axis=1)
        expected = step * (alpha[earlier].T @ (ahead / whole[:, None]))
    out: list[np.ndarray] = [np.zeros(0)] * len(lines)
    for rank, i in enumerate(order):
        out[i] = p[base[: len(lines[i])] + rank]
    return out, expected


def packed_floats(lines: list[np.ndarray]):
    """``packed`` for scores: their places are packed, then the scores."""
    sizes = np.array([len(x) for x in lines])
    starts = np.cumsum(sizes) - sizes
    places, active, order = packed([np.arange(s, s + n, dtype=np.int32) for s, n in zip(starts, sizes)])
    return np.concatenate([*lines, np.zeros(0)])[places], active, order


class Field:
    """Weights by bucket, bias, pair scores and the regression of scores."""

    def __init__(self, weights, bias, move, regression, rate):
        self.weights, self.bias, self.move, self.regression, self.rate = weights, bias, move, regression, rate

    def line_scores(self, words: Words) -> list[np.ndarray]:
        flat = self.weights[features(words)].sum(axis=1, dtype=np.float64) + self.bias
        return [flat[a:b] for a, b in zip(words.first[:-1], words.first[1:])]

    def score(self, p: list[np.ndarray]) -> np.ndarray:
        if self.regression is None:
            return np.full(len(p), self.rate)
        return 1 / (1 + np.exp(-np.clip(evidence(p) @ self.regression, -40, 40)))


def evidence(p: list[np.ndarray]) -> np.ndarray:
    """What a document's score is made of."""
    total = np.array([x.sum() for x in p])
    top = np.array([x.max(initial=0.0) for x in p])
    size = np.array([len(x) for x in p])
    return np.stack([np.ones(len(p)), np.minimum(total, 1), np.clip(total - 1, 0, 1), np.log1p(total), top, np.sqrt(total / np.maximum(size, 1))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge; a step
    is halved until it gains."""
    def loss(w):
        z = x @ w
        return weight @ (np.logaddexp(0, z) - y * z) + ridge / 2 * (w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step, now = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w), loss(w)
        for _ in range(30):
            if loss(w + step) <= now:
                w = w + step
                break
            step = step / 2
    return w


def fit_field(texts: list[bytes], toxic: np.ndarray, odds: np.ndarray, rate: float, weight: np.ndarray) -> Field:
    """Weights from labelled words of the sample by gradient ascent on the
    field's likelihood; then the regression on its marginals, where a document
    counts as many times as ``weight`` says."""
    words = split_words(texts, ALNUM)
    feats = features(words)
    of = np.repeat(np.arange(len(texts)), np.diff(words.first))
    labels = (odds[feats].max(axis=1, initial=-9) >= SEED_ODDS) & toxic[of]
    start = np.zeros(len(of), bool)
    start[words.first[:-1][np.diff(words.first) > 0]] = True
    place = np.arange(len(of)) - np.repeat(words.first[:-1], np.diff(words.first))
    start |= place % LANE == 0
    cuts = np.flatnonzero(start)
    lanes = np.split(np.arange(len(of)), cuts[1:]) if len(cuts) else []
    used, column = np.unique(feats, return_inverse=True)
    column = column.reshape(feats.shape)
    w, bias, move = np.where(odds[used] > 0, odds[used] * 0.5, 0.0), -4.0, np.zeros((2, 2))
    step_w = np.full(len(used), 0.3)
    w[used == NONE] = 0.0
    step_b, step_m, last = 0.5, np.full((2, 2), 0.3), None
    seen = ~start[1:]
    pairs = np.bincount(labels[:-1][seen] * 2 + labels[1:][seen], minlength=4).reshape(2, 2) if len(of) else np.zeros((2, 2))
    for _ in range(ROUNDS if len(of) else 0):
        flat = w[column].sum(axis=1) + bias
        p, expected = forward_backward([flat[x] for x in lanes], move, pairs=True)
        gap = labels - np.concatenate(p)
        g_w = np.bincount(column.ravel(), weights=np.repeat(gap, feats.shape[1]), minlength=len(used)) - 0.02 * w
        g_b = gap.sum()
        g_m = pairs - expected - 0.1 * move
        if last is not None:  # each step grows while the gradient keeps its sign
            step_w *= np.where(g_w * last[0] >= 0, 1.2, 0.5)
            step_b *= 1.2 if g_b * last[1] >= 0 else 0.5
            step_m *= np.where(g_m * last[2] >= 0, 1.2, 0.5)
        np.clip(step_w, 1e-4, 0.5, out=step_w)
        step_b, step_m = min(step_b, 0.5), np.clip(step_m, 1e-4, 0.3)
        w = np.clip(w + step_w * np.sign(g_w), -12, 12)
        w[used == NONE] = 0.0
        bias = float(np.clip(bias + step_b * np.sign(g_b), -15, 0))
        move = np.clip(move + step_m * np.sign(g_m), -4, 4)
        last = g_w, g_b, g_m
    weights = np.where(odds > 1, 0.25 * odds, 0.0)  # buckets that the sample does not hold
    weights[used] = w
    weights[NONE] = 0.0
    field = Field(weights.astype(np.float32), bias, move, None, rate)
    if toxic.any() and not toxic.all():
        p = marginals(field.line_scores(words), move)
        field.regression = logistic(evidence(p), toxic.astype(float), weight)
    return field


FIELD = "weights array<float>, bias double, move array<double>, regression array<double>"


def shares(n_toxic: int, n_clean: int, size: int) -> tuple[int, int]:
    """How many of ``size`` documents are to be toxic and clean: each label's
    share, but at least a fifth of them or all it has."""
    rate, least = n_toxic / max(n_toxic + n_clean, 1), size // 5
    toxic = min(n_toxic, max(least, round(size * rate), size - n_clean), size - min(n_clean, least))
    return toxic, min(n_clean, size - toxic)


def drawn(known: DataFrame, n_toxic: int, n_clean: int, size: int) -> DataFrame:
    """About ``size`` of the rows of ``known(doc_id, toxic)``, by a hash of the
    id that is even over its range; nothing is sorted."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / float(1 << 52)
    toxic, clean = shares(n_toxic, n_clean, size)
    share = F.when(F.col("toxic"), toxic / max(n_toxic, 1)).otherwise(clean / max(n_clean, 1))
    return known.where(place < share)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, counted: int = COUNTED) -> Field:
    spark = docs.sparkSession
    ship_package(spark)
    texts = rows_with_key(docs, "doc_id", "text")
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
        .join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    known = written(known, "known")

    def numbers(rows: DataFrame) -> tuple[int, int]:
        n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        return n.get(True, 0), n.get(False, 0)

    n_toxic, n_clean = numbers(known)
    rate = n_toxic / max(n_toxic + n_clean, 1)
    if not n_toxic or not n_clean:
        done_with(known)
        return Field(np.zeros(NONE + 1, np.float32), -9.0, np.zeros((2, 2)), None, rate)
    taught = written(drawn(known, n_toxic, n_clean, max(counted, sample)).coalesce(8), "taught")
    counts = (
        texts.join(F.broadcast(taught), "doc_id").mapInArrow(_count_features, "bucket int, toxic long, clean long")
        .groupBy("bucket").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    )
    counts = written(counts, "frequencies")  # at most 2**BITS + 2 rows
    whole = counts.where(F.col("bucket") == DOCS).first()
    rows_toxic, rows_clean = (whole["t"], whole["c"]) if whole else (0, 0)
    odds = np.zeros(NONE + 1)
    telling = counts.where((F.col("t") >= SEED_DOCS) & (F.col("t") * (rows_clean + 1) > F.col("c") * (rows_toxic + 1)) & (F.col("bucket") < NONE))
    found = telling.toArrow()
    t, c = found["t"].to_numpy(), found["c"].to_numpy()
    odds[found["bucket"].to_numpy()] = np.log((t + 0.5) / (rows_toxic + 1)) - np.log((c + 0.5) / (rows_clean + 1))
    sent = spark.sparkContext.broadcast(odds.astype(np.float32))
    few_toxic, few_clean = shares(n_toxic, n_clean, sample)
    here_toxic, here_clean = numbers(taught)
    few_toxic, few_clean = min(few_toxic, here_toxic), min(few_clean, here_clean)
    # documents that one of the sample stands for; 1 for the label with the larger share in it
    each = np.array([n_clean / max(few_clean, 1), n_toxic / max(few_toxic, 1)])
    each /= each.min()

    def fit(batches):
        texts, toxic = [], []
        for part, bytes_ in text_slices(batches, SLICE_BYTES):
            texts += bytes_
            toxic += part.column("toxic").to_pylist()
        toxic = np.array(toxic, bool)
        f = fit_field(texts, toxic, sent.value.astype(np.float64), rate, each[toxic.astype(int)])
        used = [f.weights.tolist()], [f.bias], [f.move.ravel().tolist()], [None if f.regression is None else f.regression.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[0], pa.list_(pa.float32())), pa.array(used[1]), pa.array(used[2], pa.list_(pa.float64())), pa.array(used[3], pa.list_(pa.float64()))],
            names=["weights", "bias", "move", "regression"],
        )

    by_hash = lambda kind, n: taught.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    few = by_hash(F.col("toxic"), few_toxic).union(by_hash(~F.col("toxic"), few_clean))
    chosen = (
        texts.join(F.broadcast(few), "doc_id")
        .groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    # the order of rows is that of their ids, so that sums come out alike in every run
    got = chosen.repartition(1).sortWithinPartitions("doc_id").select("text", "toxic").mapInArrow(fit, FIELD).toArrow()
    done_with(known, taught, counts)
    if not got.num_rows:
        return Field(np.zeros(NONE + 1, np.float32), -9.0, np.zeros((2, 2)), None, rate)
    weights = got["weights"].combine_chunks().flatten().to_numpy()
    move, regression = np.array(got["move"][0].as_py()).reshape(2, 2), got["regression"][0].as_py()
    return Field(weights, got["bias"][0].as_py(), move, None if regression is None else np.array(regression), rate)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


SCORES = "doc_id long, score double, n_toxic_words double, spans array<struct<start:int,end:int>>"


def _score(sent):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def score(batches):
        field = sent.value
        for rows, texts in text_slices(batches, SLICE_BYTES):
            words = split_words(texts, ALNUM)
            p = marginals(field.line_scores(words), field.move)
            text_start = np.cumsum([0] + [len(t) + 1 for t in texts])
            spans = []
            for i, x in enumerate(p):
                bad = np.flatnonzero(x >= 0.5) + words.first[i]
                spans.append([{"start": int(words.starts[j] - text_start[i]), "end": int(words.ends[j] - text_start[i])} for j in bad])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(field.score(p)), pa.array([float(x.sum()) for x in p]), pa.array(spans, kind)],
                names=["doc_id", "score", "n_toxic_words", "spans"],
            )

    return score


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_toxic_words, spans`` of every
    row."""
    field = learn(docs, labels, sample)
    sent = docs.sparkSession.sparkContext.broadcast(field)
    scored = rows_with_key(docs, "doc_id", "text").mapInArrow(_score(sent), SCORES)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_toxic_words", "spans"
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those scored ``THRESHOLD`` or more."""
    bad = toxicity(docs, labels).where((F.col("predicted") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)

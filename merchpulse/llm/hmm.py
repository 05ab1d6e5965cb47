"""Hidden Markov language model: Baum-Welch counts aggregated across
partitions train the latent states, the scaled forward recursion gives the
exact likelihood of a text.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased,
then one end.  Symbols of the hidden chain are all words of the training texts,
the end, and one symbol for all words that these never hold, so that the
probabilities of all texts sum to one.  Every symbol has its own emissions by
state; there is no bound on their number.

Texts are cut once into slices of whole documents, numbered by the slice's own
words; the slice's word list is dealt by hash into parts.  A round of
Baum-Welch is two shuffles: each slice runs forward-backward with its words'
emissions and sends their expected counts to the words' parts; each part adds
them up and sends the new emissions back to the slices that hold its words.
What travels is one row a slice and part, of one entry for each different word
of the slice: the word's number, its training count, and its counts' shares by
state in 65,535ths.  A part's task holds its words' sums and the places of its
words (about 16 bytes a place), never the rows themselves; the number of parts
grows with the places, and the most frequent word has one place a slice.  The driver
holds the start and move probabilities and the totals alone.

For training, documents are cut into lanes of ``LANE`` tokens (a later lane
begins with the stationary probabilities and adds nothing to the starts);
scores run over whole texts.

Defined cases: null and empty texts are one end token; a document without an
id counts as training text (its remainder is unknown) and is scored; repeated
rows count and are scored each; other columns are not looked at; with no
training text all words are unknown and have probability one.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.tables import done_with, rows_with_key, ship_package, text_slices, written

STATES = 8
ROUNDS = 4
LANE = 256
ALPHA = 0.1
#: Text bytes of a slice (a longer text stands alone).
SLICE_BYTES = 16 << 20
#: Places of words (a word in a slice) that a part has on average, at most.
PART_PLACES = 500_000
#: Weight of the whole training text's distribution in each state's.
PRIOR = 20.0
#: Tokens that forward-backward takes at a time.
STEP_TOKENS = 200_000

#: Tables of large rows: small row groups, as a task reads one at a time.
ZSTD = {"compression": "zstd", "parquet.block.size": str(32 << 20)}

SLICES = "slice long, doc_ids array<long>, held array<boolean>, sizes array<int>, symbols binary, words binary, n binary, n_words long"
BLOCKS = "part int, slice long, first long, words binary, n binary"
EXPECTED = "part int, slice long, first long, idx binary, c binary, n binary, shares binary, totals array<double>"
REPLIES = "slice long, part int, first long, idx binary, c binary, shares binary, totals array<double>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z only, and the six white-space bytes


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))


def unpacked(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and how many each row has."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].copy() if data is not None else np.empty(0, np.uint8)
    return flat.view(dtype), np.diff(bounds) // np.dtype(dtype).itemsize


def packed_rows(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of rows of so many numbers each."""
    flat = np.ascontiguousarray(flat)
    bounds = (np.concatenate([[0], np.cumsum(counts)]) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])


def _cut(slice_bytes: int):
    """Slices: documents as numbers of the slice's words (0 is the end), the
    words in order of their hash, so that each part has a run of them, and how
    often each occurs in training documents."""
    def cut(batches):
        base, k = TaskContext.get().partitionId() << 32, 0
        for rows, texts in text_slices(batches, slice_bytes):
            numbers: defaultdict = defaultdict()
            numbers.default_factory = numbers.__len__
            end = numbers[b""]
            lines = []
            for t in texts:
                line = list(map(numbers.__getitem__, tokens(t)))
                line.append(end)
                lines.append(np.array(line, np.int32))
            words = list(numbers)
            order = np.argsort(np.fromiter(map(zlib.crc32, words), np.int64, len(words)), kind="stable")  # the end's is 0
            rank = np.empty(len(words), np.int32)
            rank[order] = np.arange(len(words))
            lines = [rank[x] for x in lines]
            held = rows.column("held_out").to_pylist()
            n = np.bincount(np.concatenate([np.empty(0, np.int32), *(x for x, h in zip(lines, held) if not h)]), minlength=len(words))
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array([base + k], pa.int64()), "doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([held], pa.list_(pa.bool_())), "sizes": pa.array([[len(x) for x in lines]], pa.list_(pa.int32())),
                    "symbols": pa.array([np.concatenate(lines).tobytes()], pa.binary()), "words": pa.array([b" ".join([words[i] for i in order.tolist()])], pa.binary()),
                    "n": pa.array([n.astype(np.int64).tobytes()], pa.binary()), "n_words": pa.array([len(words)], pa.int64()),
                }
            )
            k += 1

    return cut


def _deal(parts: int):
    """A row for each slice and part: places of the part's words in the slice."""
    def deal(batches):
        for batch in batches:
            for name, words, n in zip(batch.column("slice").to_pylist(), batch.column("words").to_pylist(), batch.column("n").to_pylist()):
                words, n = words.split(b" "), np.frombuffer(n, np.int64)
                part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) * parts >> 32
                used, first, counts = np.unique(part, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(used, pa.int32()), "slice": pa.array([name] * len(used), pa.int64()), "first": pa.array(first, pa.int64()),
                        "words": pa.array([b" ".join(words[a : a + c]) for a, c in zip(first, counts)], pa.binary()), "n": packed_rows(n, counts),
                    }
                )

    return deal


def _parts(batches):
    """Runs of rows of one part, in order; ``(part, None)`` after its last."""
    last = None
    for batch in batches:
        part = batch.column("part").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]) if len(part) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if last is not None and part[a] != last:
                yield last, None
            last = int(part[a])
            yield last, batch.slice(a, b - a)
    if last is not None:
        yield last, None


def _grown(a: np.ndarray, size: int) -> np.ndarray:
    """``a`` with at least ``size`` rows, new ones zero."""
    if len(a) >= size:
        return a
    out = np.zeros((max(size, 2 * len(a)), *a.shape[1:]), a.dtype)
    out[: len(a)] = a
    return out


def noise(words: list[bytes], states: int) -> np.ndarray:
    """Factors that differ by word and state, fixed by the word's hash."""
    rng = np.random.default_rng(7)
    one, two = rng.normal(0, 1, (4099, states)), rng.normal(0, 1, (4093, states))
    h = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    return np.exp((one[h % 4099] + two[h // 4099 % 4093]) / math.sqrt(2))


def quantised(shares: np.ndarray) -> np.ndarray:
    return np.rint(shares * 65535).astype(np.uint16)


def _replies(part: int, kept: list, c: np.ndarray, shares: np.ndarray):
    """Counts and shares by state of a part's words, for each slice that holds
    them; a row of slice -1 has the part's totals: training tokens, different
    words, counts by state."""
    shares = quantised(shares)
    totals = [float(c.sum()), float((c > 0).sum()), *(c @ shares.astype(np.float64) / 65535)]
    schema = ["slice", "part", "first", "idx", "c", "shares", "totals"]
    none = pa.array([b""], pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1], pa.int64()), pa.array([part], pa.int32()), pa.array([0], pa.int64()), none, none, none, pa.array([totals], pa.list_(pa.float64()))], names=schema
    )
    for slices, first, idx, counts in kept:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(slices, pa.int64()), pa.array([part] * len(slices), pa.int32()), pa.array(first, pa.int64()), packed_rows(idx, counts),
                packed_rows(c[idx], counts), packed_rows(shares[idx].ravel(), counts * shares.shape[1]), pa.nulls(len(slices), pa.list_(pa.float64())),
            ],
            names=schema,
        )


def _first_shares(states: int):
    """Numbers of the words of each part, and the shares the training starts
    from, which differ by word, so that Baum-Welch can tell the states apart."""
    def first(batches):
        numbers, kept, c = None, [], None
        for part, rows in _parts(batches):
            if numbers is None:
                numbers, kept, c = defaultdict(), [], np.zeros(1 << 10, np.int64)
                numbers.default_factory = numbers.__len__
            if rows is not None:
                lists = [w.split(b" ") for w in rows.column("words").to_pylist()]
                idx = np.fromiter((numbers[w] for some in lists for w in some), np.int32)
                n, counts = unpacked(rows.column("n"), np.int64)
                c = _grown(c, len(numbers))
                np.add.at(c, idx, n)
                kept.append((rows.column("slice").to_numpy().copy(), rows.column("first").to_numpy().copy(), idx, counts))
                continue
            shares = noise(list(numbers), states)
            yield from _replies(part, kept, c[: len(numbers)], shares / shares.sum(axis=1, keepdims=True))
            numbers = None

    return first


def _add(states: int):
    """Expected counts of each part's words added up."""
    def add(batches):
        total = None
        for part, rows in _parts(batches):
            if total is None:
                total, c, kept, size = np.zeros((1 << 10, states)), np.zeros(1 << 10, np.int64), [], 0
            if rows is not None:
                idx, counts = unpacked(rows.column("idx"), np.int32)
                n, _ = unpacked(rows.column("n"), np.int32)
                found, _ = unpacked(rows.column("shares"), np.uint16)
                found = found.reshape(-1, states)
                size = max(size, int(idx.max(initial=-1)) + 1)
                total, c = _grown(total, size), _grown(c, size)
                c[idx], _ = unpacked(rows.column("c"), np.int64)  # the same wherever the word is
                for s in range(states):
                    total[:size, s] += np.bincount(idx, weights=found[:, s] * n.astype(np.float64), minlength=size)
                kept.append((rows.column("slice").to_numpy().copy(), rows.column("first").to_numpy().copy(), idx, counts))
                continue
            total = total[:size]
            yield from _replies(part, kept, c[:size], total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300))
            total = None

    return add


def packed(lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences step by step: the symbols of step 0 of all, of step 1 of those
    that have one, and so on; how many each step has; the order (longest first)."""
    sizes = np.array([len(x) for x in lines])
    order = np.argsort(-sizes, kind="stable")
    steps = np.arange(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -steps, side="left")
    base = np.cumsum(active) - active
    out = np.empty(sizes.sum(), np.int32)
    for rank, i in enumerate(order):
        out[base[: sizes[i]] + rank] = lines[i]
    return out, active, order


def forward(symbols, active, start, move, emit):
    """Scaled forward recursion: state probabilities and the scale of each
    step (the probability of its symbol given those before).  ``start`` is one
    row for all sequences or one for each, longest first."""
    alpha = emit[symbols]
    scale = np.empty(len(symbols), alpha.dtype)
    at, before = 0, None
    for n in active:
        here = alpha[at : at + n]
        here *= start if before is None else before[:n] @ move
        s = here.sum(axis=1)
        here /= s[:, None]
        scale[at : at + n] = s
        before, at = here, at + n
    return alpha, scale


def stationary(move: np.ndarray) -> np.ndarray:
    """The distribution that ``move`` leaves as it is."""
    states = len(move)
    left = np.vstack([move.T - np.eye(states), np.ones(states)])
    return np.clip(np.linalg.lstsq(left, np.append(np.zeros(states), 1.0), rcond=None)[0], 1e-12, None)


def expected_counts(lines, begins, start, move, emit, found: np.ndarray):
    """Baum-Welch: expected starts and moves of some sequences; their expected
    emissions are added to ``found``, a row for each state.  ``begins`` says
    which of the sequences begin a document."""
    symbols, active, order = packed(lines)
    begins = np.asarray(begins)[order]
    rows = np.where(begins[:, None], start, stationary(move)).astype(emit.dtype)
    alpha, scale = forward(symbols, active, rows, move.astype(emit.dtype), emit)
    beta = np.ones_like(alpha)
    base = np.cumsum(active) - active
    weighted = emit[symbols]
    weighted /= scale[:, None]
    back, pairs = move.T.astype(emit.dtype), np.zeros(move.shape)
    for t in range(len(active) - 1, 0, -1):
        n, b, p = active[t], base[t], base[t - 1]
        weighted[b : b + n] *= beta[b : b + n]
        beta[p : p + n] = weighted[b : b + n] @ back
        pairs += alpha[p : p + n].T @ weighted[b : b + n]
    gamma = alpha * beta
    for s, row in enumerate(found):
        row += np.bincount(symbols, weights=gamma[:, s], minlength=len(row))
    return gamma[: active[0]][begins].sum(axis=0, dtype=np.float64), move * pairs


class Chain:
    """The trained chain but for its words: starts, moves, the words' weights
    added up by state, and the numbers of training tokens and different words.
    A word's weight in a state is its count there, ``ALPHA`` times the state's
    share of all tokens (``flat``) and ``prior`` times its smoothed count; the
    weights of all words and of the unknown one add up to ``norm``."""

    def __init__(self, start: np.ndarray, move: np.ndarray, counts: np.ndarray, n_tokens: int, n_types: int):
        self.start, self.move = start / start.sum(), move / move.sum(axis=1, keepdims=True)
        self.flat = ALPHA * counts / max(n_tokens, 1)
        self.norm = counts + (n_types + 1) * self.flat + PRIOR
        self.n_tokens, self.n_types = n_tokens, n_types
        self.under = n_tokens + ALPHA * (n_types + 1)
        self.prior = PRIOR / self.under


def _lines(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A slice's symbols, document bounds, and whether each is held out."""
    symbols, _ = unpacked(rows.column("symbols"), np.int32)
    sizes = np.array(rows.column("sizes")[0].as_py(), np.int64)
    return symbols, np.concatenate([[0], np.cumsum(sizes)]), np.array(rows.column("held")[0].as_py(), bool)


def _emissions(replies: pa.Table, chain: Chain):
    """The replies of a slice in order of its words, the words' training
    counts, and their emissions."""
    replies = replies.sort_by("first").combine_chunks()
    c, _ = unpacked(replies.column("c"), np.int64)
    shares, _ = unpacked(replies.column("shares"), np.uint16)
    emit = shares.reshape(len(c), -1).astype(np.float32)
    emit *= (c / 65535.0).astype(np.float32)[:, None]
    emit += (chain.prior * (c + ALPHA)).astype(np.float32)[:, None]
    emit += chain.flat.astype(np.float32)
    emit /= chain.norm.astype(np.float32)
    return replies, c, emit


def _expect(chain: Chain):
    """A slice's expected counts: those of its words to their parts, of starts
    and moves in a row of part -1."""
    start, move, states = chain.start, chain.move, len(chain.start)

    def expect(rows: pa.Table, replies: pa.Table) -> pa.Table:
        symbols, bounds, held = _lines(rows)
        replies, _, emit = _emissions(replies, chain)
        starts, moves, found = np.zeros(states), np.zeros((states, states)), np.zeros((states, len(emit)))
        lines, begins, room = [], [], 0

        def take():
            nonlocal starts, moves
            s, m = expected_counts(lines, begins, start, move, emit, found)
            starts, moves = starts + s, moves + m

        for i in np.flatnonzero(~held):
            for a in range(bounds[i], bounds[i + 1], LANE):
                lines.append(symbols[a : min(a + LANE, bounds[i + 1])])
                begins.append(a == bounds[i])
                room += len(lines[-1])
                if room >= STEP_TOKENS:
                    take()
                    lines, begins, room = [], [], 0
        if lines:
            take()
        _, counts = unpacked(replies.column("idx"), np.int32)
        total = found.sum(axis=0)
        n = np.rint(total)  # a word's states sum to one at each place
        shares = np.empty(emit.shape, np.uint16)
        for s, row in enumerate(found):
            shares[:, s] = quantised(row / np.maximum(total, 1e-300))
        k, name = replies.num_rows, rows.column("slice")[0].as_py()
        none = pa.array([b""], pa.binary())
        one = lambda column: pa.concat_arrays([*column.cast(pa.binary()).chunks, none])
        return pa.table(
            {
                "part": pa.array([*replies.column("part").to_pylist(), -1], pa.int32()), "slice": pa.array([name] * (k + 1), pa.int64()),
                "first": pa.array([*replies.column("first").to_pylist(), 0], pa.int64()), "idx": one(replies.column("idx")), "c": one(replies.column("c")),
                "n": pa.concat_arrays([packed_rows(n.astype(np.int32), counts), none]),
                "shares": pa.concat_arrays([packed_rows(shares.ravel(), counts * states), none]),
                "totals": pa.array([None] * k + [[*starts, *moves.ravel()]], pa.list_(pa.float64())),
            }
        )

    return expect


def _score(chain: Chain):
    """Documents of a slice: log10 of the likelihood, and the unigram base."""
    start, move = chain.start.astype(np.float32), chain.move.astype(np.float32)

    def score(rows: pa.Table, replies: pa.Table) -> pa.Table:
        symbols, bounds, held = _lines(rows)
        _, c, emit = _emissions(replies, chain)
        likelihood, first = np.zeros(len(held)), 0
        while first < len(held):
            end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + STEP_TOKENS, side="right")) - 1)
            line, active, order = packed([symbols[bounds[i] : bounds[i + 1]] for i in range(first, end)])
            _, scale = forward(line, active, start, move, emit)
            who = first + order[np.arange(len(line)) - np.repeat(np.cumsum(active) - active, active)]
            likelihood += np.bincount(who, weights=np.log10(scale, dtype=np.float64), minlength=len(held))
            first = end
        base, known = np.log10((c + ALPHA) / chain.under)[symbols], (c > 0)[symbols]
        return pa.table(
            {
                "doc_id": pa.array(rows.column("doc_ids")[0].as_py(), pa.int64()), "held_out": pa.array(held),
                "n_tokens": pa.array(np.diff(bounds), pa.int64()), "n_known": pa.array(np.add.reduceat(known.astype(np.int64), bounds[:-1])),
                "base_score": pa.array(np.add.reduceat(base, bounds[:-1])), "score": pa.array(likelihood),
            }
        )

    return score


def _totals(rows: DataFrame, size: int) -> np.ndarray:
    """The sums of the rows of totals, one number each."""
    found = rows.where(F.col("totals").isNotNull()).agg(*[F.sum(F.col("totals")[i]) for i in range(size)]).first()
    return np.array([x or 0.0 for x in found])


def train(
    docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, part_places: int = PART_PLACES, slice_bytes: int = SLICE_BYTES
) -> tuple[Chain, DataFrame, DataFrame]:
    """The chain of the documents that are not held out, all documents in
    slices, and the counts and shares of each slice's words."""
    ship_package(docs.sparkSession)
    rows = rows_with_key(docs, "doc_id", "text").withColumn("held_out", held_out())
    slices = written(rows.mapInArrow(_cut(slice_bytes), SLICES), "slices", **ZSTD)
    places = slices.agg(F.sum("n_words")).first()[0] or 0
    by_part = lambda df: df.repartition("part").sortWithinPartitions("part", "slice")
    dealt = slices.select("slice", "words", "n").mapInArrow(_deal(max(1, -(-places // part_places))), BLOCKS)
    replies = written(by_part(dealt).mapInArrow(_first_shares(states), REPLIES), "replies", **ZSTD)
    whole, slices = slices, written(slices.drop("words", "n", "n_words"), "symbols", **ZSTD)
    done_with(whole)
    n_tokens, n_types, *counts = _totals(replies, states + 2)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    chain = Chain(np.ones(states), move, np.array(counts), int(n_tokens), int(n_types))
    for _ in range(rounds if n_tokens else 0):
        found = written(with_replies(slices, replies).applyInArrow(_expect(chain), EXPECTED), "expected", **ZSTD)
        done_with(replies)
        sums = _totals(found.where("part = -1"), states * (states + 1))
        replies = written(by_part(found.where("part >= 0").drop("totals")).mapInArrow(_add(states), REPLIES), "replies", **ZSTD)
        done_with(found)
        chain = Chain(sums[:states] + 0.1, sums[states:].reshape(states, states) + 0.1, _totals(replies, states + 2)[2:], chain.n_tokens, chain.n_types)
    return chain, slices, replies


def with_replies(slices: DataFrame, replies: DataFrame):
    """Each slice together with its words' counts and shares."""
    words = replies.where("slice >= 0").drop("totals")
    return slices.groupBy("slice").cogroup(words.groupBy("slice"))


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, part_places: int = PART_PLACES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` of every row."""
    chain, slices, replies = train(docs, states, rounds, part_places, slice_bytes)
    scored = with_replies(slices, replies).applyInArrow(_score(chain), SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(chain.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")

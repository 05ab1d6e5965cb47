"""Token ids as a compressed binary table, by an adaptive context-mixing range
coder in independently reset, checksummed blocks.

Texts are encoded by a public tokenizer (its path is a parameter; it is never
trained or copied), a document's ids end with one end id, and documents lie in
ascending id order over files of chunks of whole documents.  A chunk holds a
table of its different ids by falling frequency, then blocks of ``BLOCK`` ids.

Model of a block, reset at its begin: order 2 and order 1 each predict the id
that last followed the hashed context, with a confidence.  A symbol says which
order predicted the id, or the size class of its frequency rank (order 0), the
rank's other bits follow.  The symbol's probability mixes three adaptive
counts: over all (order 0), by the confidence of order 1, and by that of order
2; a confident context has seen more and so weighs more.  The mix takes in new
counts after 16, 32, 64, 128 and then every further 128 ids of a block, and is
scaled to 2^16.  All arithmetic is on integers, so every machine decodes the
same.  The blocks of a chunk are coded side by side with NumPy, a step for all
blocks at a time.

Chunk: b"MPI2", counts of different ids, ids and blocks, the table, and for
each block its ids, bytes and CRC-32 (of its ids, little-endian unsigned
32-bit); then the blocks' bytes.  A wrong checksum raises an error.

Defined cases: null and empty texts are the end id alone; repeated rows are
stored each; documents without an id come first; other columns are not looked
at; an empty table gives an empty table.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchpulse.llm.tables import rows_with_key, ship_package, text_slices, written
from merchpulse.llm.textbytes import prefix_sums, span_hash

BLOCK = 1024
CHUNK_IDS = 4 << 20
END_ID = 0
#: Text bytes behind one partition of the id order.
PART_BYTES = 32 << 20
#: Pieces whose ids a worker remembers, and the most ids of them.
MEMORY, MEMORY_IDS = 1_500_000, 8 << 20
#: New pieces in one text for the tokenizer.
TOGETHER = 128
#: Text bytes encoded at a time (a longer text stands alone).
SLICE_BYTES = 1 << 20

SYMBOLS = 19  # order 2, order 1, and ranks of 0 to 16 further bits
C1, C2 = 512, 1024
#: A mix's cumulative counts end at TOTAL and take up ROW places.
TOTAL_BITS, ROW = 16, 32
TOTAL = 1 << TOTAL_BITS
#: Ids between two mixes of a block, once it has this many.
MIX_EVERY = 128
#: Blocks whose symbols are found, or whose counts are mixed, at a time.
LANES = 128
#: The coder works on 64 bits and puts out words of 32.
MASK, WORD = (1 << 64) - 1, 1 << 32

CHUNKS = "part int, seq int, n_ids long, doc_ids array<long>, sizes array<int>, chunk binary"

#: White space beyond ASCII; a text that has it is encoded whole.
_RARE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_IS_WHITE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: Kinds of bytes: 0 other, 1 letters (of Latin-1 and Latin Extended above ASCII), 2 digits.
_KIND = np.array([1 if chr(b).isalpha() and b < 128 or 128 <= b <= 0xBF or 0xC3 <= b <= 0xC8 else 2 if 48 <= b <= 57 else 0 for b in range(256)], np.int8)
#: Bytes that leave the split of a word to the tokenizer: the apostrophe and all that begin other characters.
_OPEN = np.array([b == 39 or b == 0xC2 or b > 0xC8 for b in range(256)])
_tokenizers: dict = {}


def cut_pieces(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts of pieces that a byte-level tokenizer never joins, of texts that
    lie in ``buf`` from ``starts`` on and have ASCII white space only: a run of
    other characters with one blank before it, or white space up to that
    blank."""
    white = _IS_WHITE[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[starts] = True
    cut = first[:-1].copy()
    cut[1:] |= white[1:] & ~white[:-1]
    cut[:-1] |= white[:-1] & ~white[1:] & ~first[1:-1]  # the last of a run, before a word
    cut[1:] |= ~white[1:] & white[:-1] & (buf[:-1] != 32)
    return np.flatnonzero(cut)


def cut_words(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of what the byte-level expression makes of the words that lie in
    ``buf`` from ``starts`` on (a blank may stand before each): runs of letters,
    of digits and of others; and the words for which that is not settled."""
    times = (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
    unsettled = _OPEN[buf]
    unsettled[:-1] |= times
    kind = _KIND[buf]
    cut = np.zeros(len(buf), bool)
    cut[1:] = (kind[1:] != kind[:-1]) & (buf[:-1] != 32)  # a blank goes with what follows
    cut[starts] = True
    return np.flatnonzero(cut), np.logical_or.reduceat(unsettled, starts)


def _runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``begins``, one after the other."""
    after = np.cumsum(sizes)
    return np.repeat(begins - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0)


class PieceEncoder:
    """The tokenizer with a memory of pieces, by 64-bit hash: sorted, with
    late pieces apart until they are many.  A full memory keeps the pieces met
    again since it was last full.

    A byte-level tokenizer's ids spell the text's bytes, so what the memory
    gave is checked against the text; where it doesn't spell the text (two
    pieces of one hash), the texts are encoded whole.  So are all texts of
    other kinds of tokenizers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # texts that hold an added token's content are encoded whole
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        cut = self.tokenizer.pre_tokenizer
        self.bytewise = self.tokenizer.normalizer is None and isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space
        if self.bytewise:
            # a byte that is no visible Latin-1 character is written as one above U+0100
            seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
            letter = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(seen)))}
            spelled = [b""] * self.tokenizer.get_vocab_size()
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                spelled[i] = bytes(letter[c] for c in token)
            self.length = np.array([len(x) for x in spelled])
            self.spelled = pa.array(spelled, pa.large_binary())
            # the same model, given words that are cut and spelled in its letters, each once
            self.spelling = {b: c for c, b in letter.items()} | {10: "\n"}
            self.words = Tokenizer(Tokenizer.from_file(path).model)
            self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            if hasattr(self.words.model, "_resize_cache"):
                self.words.model._resize_cache(0)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.begin, self.size, self.again = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool)
        self.late = (self.hashes, self.begin, self.size, self.again)
        self.ids, self.n_ids = np.zeros(1 << 16, "<u4"), 0

    def settle(self, full: bool = False) -> None:
        """Sort the late pieces in; of a full memory, keep those met again."""
        old = (self.hashes, self.begin, self.size, self.again)
        hashes, begin, size, again = (np.concatenate(x) for x in zip(old, self.late))
        if full:
            if not 0 < np.count_nonzero(again) <= MEMORY // 2 or size[again].sum() > MEMORY_IDS // 2:
                return self.forget()
            hashes, begin, size = hashes[again], begin[again], size[again]
            self.ids = self.ids[_runs(begin, size)]
            self.n_ids = len(self.ids)
            begin, again = (np.cumsum(size) - size).astype(np.int32), np.zeros(len(size), bool)
        at = np.argsort(hashes, kind="stable")  # two sorted runs
        self.hashes, self.begin, self.size, self.again = hashes[at], begin[at], size[at], again[at]
        self.late = tuple(x[:0] for x in old)

    def recall(self, hashes: np.ndarray, met: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of pieces begin (-1: unknown), and how many they are."""
        begin, size = np.full(len(hashes), -1, np.int32), np.zeros(len(hashes), np.int32)
        for known, begins, sizes, again in ((self.hashes, self.begin, self.size, self.again), self.late):
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = np.flatnonzero(known[place] == hashes)
                place = place[hit]
                begin[hit], size[hit] = begins[place], sizes[place]
                again[place] |= met
        return begin, size

    def remember(self, hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        hashes = np.append(self.late[0], hashes)
        at = np.argsort(hashes, kind="stable")
        begin, size = (np.append(x, new.astype(np.int32))[at] for x, new in ((self.late[1], begin), (self.late[2], size)))
        self.late = (hashes[at], begin, size, np.append(self.late[3], np.zeros(len(at) - len(self.late[3]), bool))[at])
        if len(hashes) > len(self.hashes) // 8:
            self.settle()

    def keep(self, ids: np.ndarray) -> int:
        """Store ids; gives their place."""
        begin, self.n_ids = self.n_ids, self.n_ids + len(ids)
        if self.n_ids > len(self.ids):
            self.ids = np.append(self.ids[:begin], np.zeros(begin + 2 * len(ids), "<u4"))
        self.ids[begin : self.n_ids] = ids
        return begin

    def keep_texts(self, found: list, sizes: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray]:
        """Store the ids of encoded texts of pieces of these bytes, of whose
        ids ``gap`` bytes' stand between two; gives each piece's place and ids."""
        begins, counts = [], []
        for e, size in zip(found, sizes):
            ids = np.array(e.ids, "<u4")
            first = np.cumsum(self.length[ids]) - self.length[ids]
            ends = np.cumsum(size + gap)
            a = np.searchsorted(first, np.append(0, ends[:-1]))
            begins.append(self.keep(ids) + a)
            counts.append(np.searchsorted(first, ends - gap) - a)
        return np.concatenate(begins), np.concatenate(counts)

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Remember new pieces, many at a time: words whose runs are known are
        put together from runs; others go through the whole tokenizer, with
        line feeds between them, and white space each for itself."""
        kind = np.array([2 * (p[-1] in b" \t\n\v\f\r") for p in pieces])  # 0 settled words, 1 other words, 2 white space
        size = np.array([len(p) for p in pieces])
        buf = np.frombuffer(b"".join(pieces), np.uint8)
        kind = np.maximum(kind, cut_words(buf, np.cumsum(size) - size)[1])
        order = np.argsort(kind, kind="stable")
        n_cut, n_words = np.searchsorted(kind[order], [1, 2]).tolist()
        pieces, hashes = [pieces[i] for i in order], hashes[order]
        if n_cut:
            self.learn_words(hashes[:n_cut], pieces[:n_cut], size[order[:n_cut]])
        groups = [pieces[i : min(i + TOGETHER, n_words)] for i in range(n_cut, n_words, TOGETHER)] + [[p] for p in pieces[n_words:]]
        if groups:
            whole = self.tokenizer.encode_batch_fast([b"\n".join(g).decode() for g in groups], add_special_tokens=False)
            self.remember(hashes[n_cut:], *self.keep_texts(whole, [np.array([len(p) for p in g]) for g in groups], 1))

    def learn_words(self, hashes: np.ndarray, words: list[bytes], size: np.ndarray) -> None:
        """Remember settled words and their runs, of which the model gets the
        new ones, each once and spelled in its letters."""
        joined, starts = b"".join(words), np.cumsum(size) - size
        buf = np.frombuffer(joined, np.uint8)
        cuts, _ = cut_words(buf, starts)
        ends = np.append(cuts[1:], len(buf))
        runs, at, which = np.unique(span_hash(prefix_sums(buf), cuts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(self.recall(runs)[0] < 0)
        if len(new):
            some = [joined[a:b] for a, b in zip(cuts[at[new]].tolist(), ends[at[new]].tolist())]
            groups = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)]
            found = self.words.encode_batch_fast([b"\n".join(g).decode("latin1").translate(self.spelling) for g in groups], add_special_tokens=False)
            self.remember(runs[new], *self.keep_texts(found, [np.array([len(p) for p in g]) for g in groups], 0))
        begin, size = (x[which] for x in self.recall(runs, met=False))
        first = np.searchsorted(cuts, starts)
        count = np.diff(np.append(first, len(cuts)))
        several = np.flatnonzero(count > 1)  # a single run is remembered
        if len(several):
            parts = _runs(first[several], count[several])
            place = self.keep(self.ids[_runs(begin[parts], size[parts])])
            size = np.add.reduceat(size, first)[several]
            self.remember(hashes[several], place + np.cumsum(size) - size, size)

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def by_pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        joined = b"".join(texts)
        buf = np.frombuffer(joined, np.uint8)
        bounds = np.cumsum([0] + [len(t) for t in texts])
        if not len(buf):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        starts = cut_pieces(buf, bounds[:-1])
        ends = np.append(starts[1:], len(buf))
        found = pa.array(span_hash(prefix_sums(buf), starts, ends)).dictionary_encode()
        hashes, which = found.dictionary.to_numpy(), found.indices.to_numpy()
        order = np.argsort(hashes)
        hashes, at = hashes[order], np.empty(len(hashes), np.int64)
        at[which] = np.arange(len(which))  # one of the places of each
        if len(self.hashes) + len(self.late[0]) > MEMORY or self.n_ids > MEMORY_IDS:
            self.settle(full=True)
        begin, size = self.recall(hashes)
        new = np.flatnonzero(begin < 0)
        if len(new):
            some = at[order[new]]
            self.learn(hashes[new], [joined[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())])
            begin, size = self.recall(hashes, met=False)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[which]
        size = size[place]
        ids = self.ids[_runs(begin[place], size)]
        if self.length[ids].sum() != len(buf) or not np.array_equal(np.frombuffer(self.spelled.take(pa.array(ids)).buffers()[2], np.uint8, len(buf)), buf):
            parts = self.whole(texts)
            return np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, np.diff(np.append(0, np.cumsum(size))[np.searchsorted(starts, bounds)])

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and how many each has."""
        apart = [
            i for i, t in enumerate(texts)
            if not self.bytewise or any(a in t for a in self.added) or not t.isascii() and _RARE.search(t.decode())
        ]
        skip = set(apart)
        ids, sizes = self.by_pieces([b"" if i in skip else t for i, t in enumerate(texts)])
        if apart:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, part in zip(apart, self.whole([texts[i] for i in apart])):
                parts[i] = part
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        ends = np.cumsum(sizes + 1) - 1
        out = np.full(len(ids) + len(texts), end_id, "<u4")
        body = np.ones(len(out), bool)
        body[ends] = False
        out[body] = ids
        return out, sizes + 1


def piece_encoder(path: str) -> PieceEncoder:
    if path not in _tokenizers:
        _tokenizers[path] = PieceEncoder(path)
    return _tokenizers[path]


class Mixes:
    """The symbols' adaptive counts of many blocks, each for itself.
    ``table`` holds each mix's cumulative counts by block, confidence of
    order 1 and confidence of order 2; ``row`` is a block's first place."""

    def __init__(self, lanes: int):
        self.row = np.arange(lanes) * (16 * ROW)
        self.counts = [
            (np.ones((SYMBOLS, 1, 1, n), np.uint32), np.ones((SYMBOLS, 4, 1, n), np.uint32), np.ones((SYMBOLS, 1, 4, n), np.uint32))
            for n in (min(LANES, lanes - i) for i in range(0, lanes, LANES))
        ]
        self.table = np.full(lanes * 16 * ROW, TOTAL, np.uint32)
        self.table[::ROW] = 0
        self.mix(None)

    def mix(self, seen: np.ndarray | None) -> None:
        """Take in the symbols since the last mix: their places in the table,
        by step and block (those of ended blocks don't matter)."""
        for i, (counts0, counts1, counts2) in enumerate(self.counts):
            lanes = counts0.shape[3]
            if i == 0 or lanes < LANES:  # places by symbol, mix and block
                turned = np.arange(ROW * 16 * lanes).reshape(ROW, 16, lanes).transpose(2, 1, 0).ravel()
            at = i * LANES * 16 * ROW
            table = self.table[at : at + lanes * 16 * ROW].reshape(lanes, 16, ROW)
            if seen is not None:
                places = turned.take((seen[:, i * LANES : i * LANES + lanes] - at).ravel())
                new = np.bincount(places, minlength=ROW * 16 * lanes)[: SYMBOLS * 16 * lanes].astype(np.uint32).reshape(SYMBOLS, 4, 4, lanes)
                new1, new2 = new.sum(axis=2, keepdims=True, dtype=np.uint32), new.sum(axis=1, keepdims=True, dtype=np.uint32)
                counts0 += 2 * new1.sum(axis=1, keepdims=True, dtype=np.uint32)
                counts1 += 6 * new1
                counts2 += 12 * new2
            c = (counts0 + counts1 + counts2).reshape(SYMBOLS, 16, lanes)
            for a, b in zip(c, c[1:]):
                b += a
            # every symbol keeps a share of one: TOTAL - SYMBOLS is dealt by counts
            c *= np.uint32((TOTAL - SYMBOLS) << 16) // c[-1]
            c >>= np.uint32(16)
            c += np.arange(1, SYMBOLS + 1, dtype=np.uint32)[:, None, None]
            table[..., 1:SYMBOLS] = c[:-1].transpose(2, 1, 0)


def _context1(last1: np.ndarray) -> np.ndarray:
    return last1 * 0x9E3779B1 >> 12 & (C1 - 1)


def _context2(last1: np.ndarray, last2: np.ndarray) -> np.ndarray:
    return last1 * 0x85EBCA6B + last2 * 0xC2B2AE35 >> 11 & (C2 - 1)


class Slots:
    """What the decoder knows of many blocks' contexts: a slot holds the id
    that last followed a context, times 4, and the confidence in it."""

    def __init__(self, lanes: int):
        self.base1, self.base2 = np.arange(lanes) * C1, np.arange(lanes) * C2
        self.last1, self.last2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.slots1, self.slots2 = np.full(lanes * C1, -4, np.int32), np.full(lanes * C2, -4, np.int32)

    def narrow(self, n: int) -> None:
        """Go on with the first ``n`` blocks (blocks are sorted by length)."""
        self.base1, self.base2 = self.base1[:n], self.base2[:n]
        self.last1, self.last2 = self.last1[:n], self.last2[:n]

    def predict(self):
        """Predicted ids of both orders and the place of the mix to use, from
        its block's first."""
        self.at1 = self.base1 + _context1(self.last1)
        self.at2 = self.base2 + _context2(self.last1, self.last2)
        self.slot1, self.slot2 = self.slots1.take(self.at1), self.slots2.take(self.at2)
        self.sure1, self.sure2 = self.slot1 & 3, self.slot2 & 3
        return self.slot1 >> 2, self.slot2 >> 2, (self.sure1 * 4 + self.sure2).astype(np.int64) * ROW

    def update(self, ids, p1, p2) -> None:
        for slots, at, slot, sure, p in ((self.slots1, self.at1, self.slot1, self.sure1, p1), (self.slots2, self.at2, self.slot2, self.sure2, p2)):
            slots[at] = (ids << 2) + np.where(p == ids, np.minimum(sure + 1, 3), slot < 0)
        self.last2, self.last1 = self.last1, ids.astype(np.int64)


def _followed(context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``Slots`` predicts at each place of the rows of ``ids``, and its
    confidence, for one order: found at once, place after place of a context."""
    at = np.argsort(context.astype(np.uint16), axis=1, kind="stable")
    at += np.arange(len(ids))[:, None] * ids.shape[1]
    at = at.ravel()
    context, following = context.ravel().take(at), ids.ravel().take(at)
    first = np.ones(len(at), bool)
    np.not_equal(context[1:], context[:-1], out=first[1:])
    first[:: ids.shape[1]] = True
    right = np.zeros(len(at), bool)
    np.equal(following[1:], following[:-1], out=right[1:])
    right &= ~first
    sure = first.astype(np.int8)  # after a place; three rounds reach the highest
    for _ in range(3):
        up = np.minimum(sure[:-1] + np.int8(1), np.int8(3))
        up *= right[1:]
        up += first[1:]
        sure[1:] = up
    predicted, confidence = np.empty(len(at), np.int32), np.empty(len(at), np.int32)
    # the first of a context has no prediction
    predicted[at] = np.where(first, -1, np.roll(following, 1))
    confidence[at] = np.roll(sure, 1) * ~first
    return predicted.reshape(ids.shape), confidence.reshape(ids.shape)


def _symbols(ranks: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each place of the rows of ``ranks``: mix (from its block's first)
    and symbol as a place in the table, direct bits and their value."""
    last = np.zeros((len(ranks), ranks.shape[1] + 2), np.int64)
    last[:, 2:] = ranks
    p1, sure1 = _followed(_context1(last[:, 1:-1]), ranks)
    p2, sure2 = _followed(_context2(last[:, 1:-1], last[:, :-2]), ranks)
    size = _bits.take(ranks + 1)
    symbol = np.where(p2 == ranks, 0, np.where(p1 == ranks, 1, size + 2))
    direct = symbol >= 2
    size *= direct
    return sure1 * (4 * ROW) + sure2 * ROW + symbol, size.astype(np.uint8), (ranks.view(np.uint32) + 1 - (1 << size)) * direct


def _shift(low, rng) -> tuple[np.ndarray, np.ndarray]:
    """A block whose range is small puts its higher word out.  A range across
    a border of words is cut at the border, which settles the word.  Gives the
    blocks and their words."""
    who = np.flatnonzero(rng < WORD)
    at, size = low[who], rng[who]
    low[who] = at << 32
    rng[who] = np.where((at ^ (at + size)) < WORD, size, -at & (WORD - 1)) << 32
    return who, at >> 32


def _live(sizes: np.ndarray, steps: int) -> list[int]:
    """Blocks that go on at each step, of falling ``sizes``."""
    return np.searchsorted(-sizes, -np.arange(steps), side="left").tolist()


_bits = np.zeros(1 << 17, np.uint32)
_bits[1:] = np.floor(np.log2(np.arange(1, 1 << 17)))


def encode_blocks(ranks: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Code the rows of ``ranks``, of which ``sizes`` (falling) are used."""
    lanes, steps = ranks.shape
    mixes = Mixes(lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, MASK, np.uint64)
    lows, width = low, steps + 2
    words, at = np.zeros(lanes * width, ">u4"), np.arange(lanes) * width

    def put(who, word):
        place = at[who]
        words[place] = word
        at[who] = place + 1

    # what is coded, by step
    columns = [np.empty((steps, lanes), d) for d in (np.int32, np.uint8, np.uint32)]
    for i in range(0, lanes, LANES):
        for column, x in zip(columns, _symbols(ranks[i : i + LANES])):
            column[:, i : i + LANES] = x.T
    live, begin = _live(sizes, steps), 0
    for end in [t for t in (16, 32, 64) if t < steps] + [*range(MIX_EVERY, steps, MIX_EVERY), steps]:
        place = columns[0][begin:end] + mixes.row
        below = mixes.table.take(place).astype(np.uint64)
        share = mixes.table.take(place + 1) - below
        size, rest = (c[begin:end].astype(np.uint64) for c in columns[1:])
        for t, n in enumerate(live[begin:end]):
            low, rng = low[:n], rng[:n]
            unit = rng >> TOTAL_BITS
            rng = unit * share[t, :n] >> size[t, :n]
            low += unit * below[t, :n] + rng * rest[t, :n]
            put(*_shift(low, rng))
        if end < steps:
            mixes.mix(place)
        begin = end
    for _ in range(2):
        put(np.arange(lanes), lows >> 32)
        lows = lows << 32
    return [words[i * width : at[i]].tobytes() for i in range(lanes)]


def decode_blocks(coded: list[bytes], sizes: np.ndarray) -> np.ndarray:
    lanes, steps = len(coded), int(sizes.max(initial=0))
    slots, mixes = Slots(lanes), Mixes(lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, MASK, np.uint64)
    width = max(map(len, coded), default=0) // 4 + 2
    words = np.zeros((lanes, width), np.uint32)
    for i, b in enumerate(coded):
        words[i, : len(b) // 4] = np.frombuffer(b, ">u4")
    words, at = words.reshape(-1), np.arange(lanes) * width
    # what is read, less the range's begin
    value = np.zeros(lanes, np.uint64)

    def take(value, who):
        place = at[who]
        value[who] = value[who] << 32 | words.take(place, mode="clip")
        at[who] = place + 1

    for _ in range(2):
        take(value, np.arange(lanes))
    columns = np.zeros((steps, lanes), np.int32)
    # places in the table since the last mix; an ended block has its first
    places, begin = np.repeat(mixes.row[None], MIX_EVERY, axis=0), 0
    for t, n in enumerate(_live(sizes, steps)):
        if n < len(low):
            slots.narrow(n)
            low, rng, value = low[:n], rng[:n], value[:n]
        p1, p2, row = slots.predict()
        row += mixes.row[:n]
        unit = rng >> TOTAL_BITS
        target = np.minimum(value // unit, TOTAL - 1).astype(np.uint32)
        place = row
        for half in (16, 8, 4, 2, 1):
            place = place + half * (mixes.table.take(place + half) <= target)
        symbol = place - row
        below = mixes.table.take(place)
        size = np.maximum(symbol - 2, 0).astype(np.uint32)
        rng = unit * (mixes.table.take(place + 1) - below) >> size
        before = unit * below
        value = value - before
        most = (1 << size) - 1
        rest = np.minimum(value // rng, most)
        ids = np.where(symbol == 0, p2, np.where(symbol == 1, p1, (most + rest).astype(np.int32)))
        columns[t, :n] = ids
        inside = rng * rest
        low += before + inside
        value -= inside
        take(value, _shift(low, rng)[0])
        slots.update(ids, p1, p2)
        places[t - begin, :n] = place
        if t + 1 in (16, 32, 64) or (t + 1) % MIX_EVERY == 0:
            mixes.mix(places[: t + 1 - begin])
            begin = t + 1
    return np.ascontiguousarray(columns.T)


def write_chunk(ids: np.ndarray) -> bytes:
    """The binary form of some ids."""
    count = np.bincount(ids)
    table = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
    place = np.zeros(len(count), np.int32)
    place[table] = np.arange(len(table))
    n = -(-len(ids) // BLOCK)
    ranks = np.zeros((n, min(BLOCK, max(len(ids), 1))), np.int32)
    ranks.ravel()[: len(ids)] = place[ids]
    sizes = np.full(n, BLOCK)
    if n:
        sizes[-1] = len(ids) - (n - 1) * BLOCK
    coded = encode_blocks(ranks, sizes) if n else []
    blocks = b"".join(
        struct.pack("<III", sizes[i], len(c), zlib.crc32(ids[i * BLOCK : i * BLOCK + sizes[i]].astype("<u4").tobytes())) for i, c in enumerate(coded)
    )
    return b"MPI2" + struct.pack("<IQI", len(table), len(ids), n) + table.astype("<u4").tobytes() + blocks + b"".join(coded)


def read_chunk(data: bytes) -> np.ndarray:
    """The ids of a chunk; raises ValueError if it isn't what was written."""
    if data[:4] != b"MPI2":
        raise ValueError("not a chunk of token ids")
    different, total, n = struct.unpack_from("<IQI", data, 4)
    table = np.frombuffer(data, "<u4", different, 20)
    at = 20 + 4 * different
    heads = np.frombuffer(data, "<u4", 3 * n, at).reshape(n, 3)
    ends = at + 12 * n + np.cumsum(heads[:, 1], dtype=np.int64)
    ranks = decode_blocks([data[e - s : e] for e, s in zip(ends, heads[:, 1])], heads[:, 0].astype(np.int64))
    ids = table[np.minimum(ranks.ravel()[:total], max(different - 1, 0))] if n else np.zeros(0, "<u4")
    for i, (size, _, check) in enumerate(heads):
        if zlib.crc32(ids[i * BLOCK : i * BLOCK + size].tobytes()) != check:
            raise ValueError(f"block {i}: wrong checksum")
    return ids


def _encode_part(path: str, end_id: int):
    """Chunks of whole documents, in the order of the partition's rows."""
    def encode(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder, part = piece_encoder(path), TaskContext.get().partitionId()
        seq, docs, sizes, lines, size = 0, [], [], [], 0

        def chunk():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int32())), pa.array([write_chunk(np.concatenate(lines))], pa.binary())],
                names=["part", "seq", "n_ids", "doc_ids", "sizes", "chunk"],
            )

        for rows, texts in text_slices(batches, SLICE_BYTES):
            ids, lengths = encoder.encode(texts, end_id)
            begin = at = 0
            for doc, length in zip(rows.column("doc_id").to_pylist(), lengths.tolist()):
                if docs and size + length > CHUNK_IDS:
                    lines.append(ids[begin:at])
                    yield chunk()
                    seq, docs, sizes, lines, size, begin = seq + 1, [], [], [], 0, at
                docs.append(doc)
                sizes.append(length)
                size += length
                at += length
            lines.append(ids[begin:])
        if docs:
            yield chunk()

    return encode


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """The table of chunks: written as Parquet, then read again."""
    ship_package(docs.sparkSession)
    rows = rows_with_key(docs, "doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(_encode_part(tokenizer, end_id), CHUNKS), "ids")


def _read(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            ids = read_chunk(batch.column("chunk")[row].as_py())
            sizes = np.array(batch.column("sizes")[row].as_py(), np.int64)
            ends = np.cumsum(sizes)
            raw = ids.astype("<u4")
            marks = [zlib.crc32(raw[e - s : e].tobytes()) for s, e in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()), pa.array(ends - sizes + batch.column("at")[row].as_py(), pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(marks, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_ids(chunks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded."""
    sizes = chunks.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each partition of the id order
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    at = sizes.withColumn("inside", inside).join(before, "part").select("part", "seq", (F.col("inside") + F.col("before")).alias("at"))
    return chunks.join(at, ["part", "seq"]).select("doc_ids", "sizes", "at", "chunk").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )

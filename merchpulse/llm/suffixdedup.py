"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a
document with a smaller id.  Matches are judged on the input, and on bytes:
hashes only bring places together.

1. Every window of ``LENGTH`` bytes has an anchor, the leftmost of its grams
   (``GRAM`` bytes) with the least hash, so equal windows have equal anchors.
   Neighbouring windows of one anchor are one run, about one for every
   seventeen bytes (windows whose anchors tie, as in repetitive text, are one
   run too).
2. Runs whose anchor's hash occurs in one document alone go; only numbers are
   shuffled for that.  Where a slice of text has an anchor in two documents
   already, its runs stay without meeting others and one marker tells the
   other slices, so a frequent anchor is a row for each slice in its task.
3. The bytes of the runs left are fetched, and runs with equal bytes become
   one, with the smallest and the largest of their documents, before and after
   the shuffle.  In documents after the smallest all of such a run is a match
   of an earlier one.
4. The different runs of an anchor that agree on one side of it, without which
   they share no window, are put behind each other.  A suffix array
   and the previous and next smaller positions in suffix order give the longest
   previous factor of each place: what an earlier document has.
5. Each place of a run takes the verdict of its bytes by a join on them.

An anchor with more than ``MAX_VARIANTS`` different runs is not put into one
task: its runs' windows are compared by themselves, in a group-by on their
bytes, with the same result.

Defined cases: null and empty texts have no bytes; documents without an id
neither lose bytes nor count as earlier ones; repeated rows of one id never
match each other and are treated alike; other columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchpulse.llm.tables import done_with, rows_with_key, ship_package, text_slices, written
from merchpulse.llm.textbytes import U, prefix_sums, span_hash

LENGTH = 50
GRAM = 18
#: Text worked on at once, and the largest piece of a longer text.
SLICE, PIECE = 1 << 20, 8 << 20
#: Windows of one run at most: longer ones go on as another run.
LONGEST = 4096
#: Different runs of an anchor that one task takes.
MAX_VARIANTS = 20_000
#: Bytes of different runs behind one task's share.
SHARE_BYTES = 8 << 20
RUNS = "anchor long, salt int, kind int, doc_id long, start int, size int"
#: Kinds of rows: a run, a run whose anchor is known to be shared, and a marker that it is.
ALONE, KNOWN, MARKER = 0, 1, 2
COPIES = "anchor long, bytes binary, doc_id long, start int"
VERDICT = "anchor long, bytes binary, first_doc long, first array<struct<start: int, end: int>>, later array<struct<start: int, end: int>>"


def _pieces(texts: list[bytes], length: int):
    """Texts cut where they are very long, with ``length - 1`` bytes of
    overlap, in groups of about SLICE bytes: (text number, offset, bytes)."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - length + 1, 0), PIECE):
            piece = t[at : at + PIECE + length - 1]
            if group and size + len(piece) > SLICE:
                yield group
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield group


def find_runs(texts: list[bytes], ids: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The runs of all texts: anchor hash, document, first byte and bytes."""
    windows, parts = length - gram + 1, {c: [] for c in ("anchor", "doc_id", "start", "size")}
    for group in _pieces(texts, length):
        buf = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        sizes = np.array([len(p) for _, _, p in group])
        first = np.cumsum(sizes) - sizes
        sums = prefix_sums(buf)
        grams = np.arange(len(buf) - gram + 1)
        hashes = span_hash(sums, grams, grams + gram)
        # least hash with its place: 40 bits of the hash, 24 of the place
        least = (hashes & ~U((1 << 24) - 1)) | grams.astype(U)
        width = 1
        while width * 2 <= windows:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < windows:
            rest = windows - width
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & U((1 << 24) - 1)).astype(np.int64)  # the anchor of each window
        valid = np.zeros(len(at) + 2, bool)
        for f, s in zip(first, sizes):
            valid[f + 1 : f + s - length + 2] = True
        # windows go on a run while the anchor stays, or moves on by one to equal bytes
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = valid[2:-1] & valid[1:-2] & ((at[1:] == at[:-1]) | (at[1:] == at[:-1] + 1) & (hashes[at[1:]] == hashes[at[:-1]]))
        begin = np.flatnonzero(valid[1:-1] & ~same[:-1])
        end = np.flatnonzero(valid[1:-1] & ~same[1:]) + 1
        blocks = -(-(end - begin) // LONGEST)
        which = np.repeat(np.arange(len(begin)), blocks)
        begin = begin[which] + (np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * LONGEST
        end = np.minimum(begin + LONGEST, end[which]) + length - 1
        piece = np.searchsorted(first, begin, side="right") - 1
        parts["anchor"].append(hashes[at[begin]].view(np.int64))
        parts["doc_id"].append(ids[np.array([i for i, _, _ in group])[piece]])
        parts["start"].append((begin - first[piece] + np.array([o for _, o, _ in group])[piece]).astype(np.int32))
        parts["size"].append((end - begin).astype(np.int32))
    kinds = {"anchor": np.int64, "doc_id": np.int64, "start": np.int32, "size": np.int32}
    return {c: np.concatenate(v) if v else np.zeros(0, kinds[c]) for c, v in parts.items()}


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each group of equal keys (sorted), and each row's group."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _runs_of(length: int, gram: int):
    def runs(batches):
        for rows, texts in text_slices(batches, 4 * SLICE):
            r = find_runs(texts, rows.column("doc_id").to_numpy(zero_copy_only=False), length, gram)
            if not len(r["anchor"]):
                continue
            order = np.argsort(r["anchor"], kind="stable")
            r = {c: v[order] for c, v in r.items()}
            first, group = _groups(r["anchor"])
            shared = np.minimum.reduceat(r["doc_id"], first) < np.maximum.reduceat(r["doc_id"], first)
            kind = np.where(shared[group], KNOWN, ALONE)
            # known runs are dealt out by document as well
            salt = np.where(shared[group], 1 + (r["doc_id"] & 0xFFFF), 0)
            r = {c: np.concatenate([v, v[first[shared]]]) for c, v in r.items()}
            marks = np.full(int(shared.sum()), MARKER)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["anchor"]), pa.array(np.concatenate([salt, 0 * marks]).astype(np.int32)), pa.array(np.concatenate([kind, marks]).astype(np.int32)),
                 pa.array(r["doc_id"]), pa.array(r["start"]), pa.array(r["size"])],
                names=["anchor", "salt", "kind", "doc_id", "start", "size"],
            )

    return runs


#: Symbols (9 bits each) that one number holds.
PACK = 7
BREAK = 257  # after each run; bytes are symbols 1 to 256


def packed_symbols(text: np.ndarray, pad: int) -> np.ndarray:
    """The next PACK symbols from each place on, as one number; ``pad`` more
    places behind the end."""
    longer = np.concatenate([text, np.zeros(pad + PACK, np.int64)])
    out = np.zeros(len(text) + pad, np.int64)
    for j in range(PACK):
        out = out << 9 | longer[j : j + len(out)]
    return out


def suffix_order(packed: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Suffix array of ``n`` symbols, in the order of their first ``depth`` at
    least, by prefix doubling from packed symbols on."""
    rank, key, h = np.zeros(len(packed), np.int64), packed[:n], PACK
    while True:
        order = np.argsort(key)
        key = key[order]
        step = np.ones(n, np.int64)
        step[1:] = key[1:] != key[:-1]
        rank[order] = np.cumsum(step)
        if h >= depth or step.all():
            return order
        key = rank[:n] * (n + 2) + rank[h : h + n]
        h *= 2


def previous_smaller(keys: np.ndarray) -> np.ndarray:
    """For each place, the nearest one before it with a smaller key, or -1.
    Whatever lies between a place and its pointer is not smaller, so a pointer
    to a place that is not smaller either moves on to where that one points."""
    to = np.arange(len(keys)) - 1
    open_ = np.arange(len(keys))
    while True:
        open_ = open_[to[open_] >= 0]
        open_ = open_[keys[to[open_]] >= keys[open_]]
        if not len(open_):
            return to
        to[open_] = to[to[open_]]


def previous_factors(packed: np.ndarray, order: np.ndarray, before: np.ndarray, cap: int) -> np.ndarray:
    """For each place, the longest match (up to ``cap``) that starts at a
    place of smaller ``before``: with the previous and the next suffix in
    suffix order of smaller ``before``, as nothing in between is longer."""
    n = len(order)
    keys = before[order]
    longest = np.zeros(n, np.int64)
    after = n - 1 - previous_smaller(keys[::-1])[::-1]
    for smaller in (previous_smaller(keys), np.where(after < n, after, -1)):
        here = np.flatnonzero(smaller >= 0)
        a, b = order[here], order[smaller[here]]
        size, going = np.zeros(len(here), np.int64), np.arange(len(here))
        while len(going):  # whole packs, then the equal symbols of the next one
            x = packed[a[going] + size[going]] ^ packed[b[going] + size[going]]
            last = going[x != 0]
            top = np.frexp(x[x != 0].astype(np.float64))[1]  # bits up to the highest that differs
            size[last] += (9 * PACK - top) // 9
            going = going[x == 0]
            size[going] += PACK
            going = going[size[going] < cap]
        longest[a] = np.maximum(longest[a], np.minimum(size, cap))
    return longest


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _ranges(hit: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rising places of repeated windows as starts and ends of byte ranges."""
    cut = np.flatnonzero(np.diff(hit) > length)
    return hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)] + length


def _lists(counts: np.ndarray, starts: list[np.ndarray], ends: list[np.ndarray]) -> pa.Array:
    """Lists of ranges, ``counts`` in each."""
    ranges = [pa.array(np.concatenate([_NONE[0], *x]).astype(np.int32)) for x in (starts, ends)]
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.StructArray.from_arrays(ranges, names=["start", "end"]))


def may_share(texts: list[bytes], anchors: np.ndarray, docs: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which runs can share a window with a run of the same anchor (in order of
    anchors) and another document.

    Around its anchor a window has ``length - gram`` bytes, so two runs that
    share one agree in half of that before the anchor or behind it; unequal
    hashes of these bytes are unequal bytes.  Where a run holds its anchor
    several times, the anchor's runs all stay.
    """
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sums = prefix_sums(buf)
    grams = np.arange(len(buf) - gram + 1)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(span_hash(sums, grams, grams + gram).view(np.int64) == anchors[owner[: len(grams)]])
    at = at[at + gram <= (begin + sizes)[owner[at]]]
    first, group = _groups(anchors)
    several = np.bincount(owner[at], minlength=len(texts)) != 1
    out = np.maximum.reduceat(several.astype(np.int8), first)[group].astype(bool)
    where = np.zeros(len(texts), np.int64)
    where[owner[at]] = at
    reach = (length - gram + 1) // 2
    for a, b in ((where - reach, where), (where + gram, where + gram + reach)):
        inside = np.flatnonzero((a >= begin) & (b <= begin + sizes))
        side = span_hash(sums, a[inside], b[inside])
        order = np.lexsort((side, anchors[inside]))
        some = inside[order]
        if len(some):
            first, group = _groups(anchors[some], side[order])
            out[some] |= (np.minimum.reduceat(docs[some], first) < np.maximum.reduceat(docs[some], first))[group]
    return np.flatnonzero(out)


def _factors(length: int, gram: int):
    """Verdicts on the different runs of some anchors, by longest previous
    factors: which bytes go in the run's first document, and in later ones."""
    def factors(table: pa.Table) -> pa.Table:
        table = table.sort_by("anchor")
        anchors, texts = table["anchor"].to_numpy(), table["bytes"].to_pylist()
        first_doc, last_doc = table["first_doc"].to_numpy(), table["last_doc"].to_numpy()
        sizes = np.array([len(t) + 1 for t in texts])
        # whole anchors at a time, about SLICE bytes
        _, anchor_no = _groups(anchors)
        share = (np.cumsum(sizes) // SLICE)[np.searchsorted(anchor_no, anchor_no)]
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(share)) + 1):
            rows = rows[may_share([texts[r] for r in rows], anchors[rows], first_doc[rows], length, gram)]
            if not len(rows):
                continue
            text = np.concatenate([np.append(np.frombuffer(texts[r], np.uint8).astype(np.int64) + 1, BREAK) for r in rows])
            packed = packed_symbols(text, 2 * length + PACK)
            begin = np.cumsum(sizes[rows]) - sizes[rows]
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            before = np.unique(first_doc[rows], return_inverse=True)[1][owner]
            longest = previous_factors(packed, suffix_order(packed, len(text), length), before, length)
            inside = np.repeat(begin + sizes[rows] - 1, sizes[rows]) - np.arange(len(text)) >= length  # not over a break
            hit = np.flatnonzero((longest >= length) & inside)
            bounds = np.searchsorted(owner[hit], np.arange(len(rows) + 1))
            for k in np.flatnonzero(np.diff(bounds)).tolist():
                found[int(rows[k])] = _ranges(hit[bounds[k] : bounds[k + 1]] - begin[k], length)
        several = last_doc > first_doc  # later documents lose all of it
        kept = several.copy()
        kept[list(found)] = True
        rows = np.flatnonzero(kept)
        some = [found.get(r, _NONE) for r in rows.tolist()]
        first = _lists(np.array([len(a) for a, _ in some], np.int64), [a for a, _ in some], [b for _, b in some])
        later = _lists(several[rows].astype(np.int64), [np.zeros(int(several.sum()), np.int64)], [sizes[several] - 1])
        return pa.table(
            [pa.array(anchors[rows]), table["bytes"].combine_chunks().take(pa.array(rows)), pa.array(first_doc[rows]), first, later],
            names=["anchor", "bytes", "first_doc", "first", "later"],
        )

    return factors


def _by_windows(runs: DataFrame, length: int) -> DataFrame:
    """Verdicts on the runs of anchors with very many of them: each window's
    smallest document from a group-by on its bytes."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("at")
    windows = runs.select("anchor", "bytes", "first_doc", "last_doc", at).withColumn("window", F.expr(f"substring(bytes, at + 1, {length})"))
    least = windows.groupBy("anchor", "window").agg(F.min("first_doc").alias("least"))
    here = F.struct(F.col("at").alias("start"), (F.col("at") + length).alias("end"))
    gone = F.collect_list(F.when(F.col("least") < F.col("first_doc"), here))  # of one run
    return windows.join(least, ["anchor", "window"]).groupBy("anchor", "bytes", "first_doc").agg(
        F.array_sort(gone).alias("first"),
        F.when(F.max("last_doc") > F.col("first_doc"), F.array_sort(F.collect_list(here))).otherwise(F.array().cast("array<struct<start: int, end: int>>")).alias("later"),
    ).where("size(first) > 0 or size(later) > 0")


def _fetch(batches):
    """The bytes of the runs asked for, from whole texts."""
    for rows, texts in text_slices(batches, SLICE):
        wanted = rows.column("wanted")
        runs, counts = wanted.flatten(), np.diff(wanted.offsets.to_numpy())
        starts, sizes = runs.field("start").to_numpy(), runs.field("size").to_numpy()
        of = np.repeat(np.arange(len(texts)), counts)
        cut = [texts[i][s : s + n] for i, s, n in zip(of.tolist(), starts.tolist(), sizes.tolist())]
        yield pa.RecordBatch.from_arrays(
            [runs.field("anchor"), pa.array(cut, pa.binary()), rows.column("doc_id").take(pa.array(of)), runs.field("start")],
            names=["anchor", "bytes", "doc_id", "start"],
        )


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, start, end``: byte ranges to remove, overlapping ones apart."""
    ship_package(docs.sparkSession)
    rows = rows_with_key(docs, "doc_id", "text").where(F.col("doc_id").isNotNull())
    runs = rows.mapInArrow(_runs_of(length, gram), RUNS)
    by = Window.partitionBy("anchor", "salt")
    shared = (F.max("kind").over(by) > ALONE) | (F.min("doc_id").over(by) < F.max("doc_id").over(by))
    places = written(runs.withColumn("shared", shared).where((F.col("kind") != MARKER) & F.col("shared")).select("anchor", "doc_id", "start", "size"), "places")
    wanted = places.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "size")).alias("wanted"))  # of one document
    copies = written(rows.join(wanted, "doc_id").mapInArrow(_fetch, COPIES), "copies", compression="zstd")
    done_with(places)
    different = written(
        copies.groupBy("anchor", "bytes").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")), "different", compression="zstd"
    )
    counted = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    hot = counted.where(F.col("n") > MAX_VARIANTS).select("anchor")
    total = different.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shares = max(1, -(-total // SHARE_BYTES))
    share = F.pmod(F.xxhash64("anchor"), F.lit(shares))
    some = different
    if not hot.isEmpty():
        hot = written(hot, "hot")
        some = different.join(hot, "anchor", "left_anti")
    verdicts = some.withColumn("share", share).groupBy("share").applyInArrow(_factors(length, gram), VERDICT)
    if some is not different:
        verdicts = verdicts.unionByName(_by_windows(different.join(hot, "anchor", "left_semi"), length))
    verdicts = written(verdicts, "verdicts", compression="zstd")
    done_with(different)
    gone = F.when(F.col("doc_id") == F.col("first_doc"), F.col("first")).otherwise(F.col("later"))
    # the bytes hold their anchor
    spans = copies.select("bytes", "doc_id", "start").join(verdicts.drop("anchor"), "bytes").select("doc_id", "start", F.explode(gone).alias("r"))
    found = written(spans.select("doc_id", (F.col("start") + F.col("r.start")).alias("start"), (F.col("start") + F.col("r.end")).alias("end")), "spans")
    done_with(copies, verdicts)
    return found


def _kept(with_text: bool):
    """Removed and kept bytes of each document."""
    def kept(batches):
        for batch, texts in text_slices(batches, 4 * SLICE):
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, spans in zip(texts, batch.column("spans").to_pylist()):
                parts, at, removed, n = [], 0, 0, 0
                reach = -1
                for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                    if s > reach:  # a new run; touching runs are one
                        n += 1
                        parts.append(text[at:s])
                        removed += e - s
                        reach = at = e
                    elif e > reach:
                        removed += e - reach
                        reach = at = e
                parts.append(text[at:])
                rest = b"".join(parts)
                out["n_bytes"].append(len(text))
                out["n_removed"].append(removed)
                out["n_spans"].append(n)
                out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                # a character whose bytes went in part goes
                out["kept"].append(rest.decode("utf-8", "ignore") if with_text else None)
            arrays = {k: pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in out.items()}
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays.values()], names=["doc_id", *arrays])

    return kept


def dedup_passages(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every
    row; ``kept`` (the remaining text) only if asked for."""
    spans = repeats(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # of one document
    joined = rows_with_key(docs, "doc_id", "text").join(spans, "doc_id", "left")
    return joined.mapInArrow(
        _kept(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    )



def _cut(batches):
    """Rows with the spans cut from their text."""
    for batch, _ in text_slices(batches, 4 * SLICE):
        at = batch.schema.get_field_index("text")
        raw = batch.column(at).cast(pa.large_binary()).to_pylist()
        out = []
        for text, spans in zip(raw, batch.column(batch.schema.get_field_index(SPANS)).to_pylist()):
            if text is not None and spans:
                parts, reach = [], 0
                for s, e in sorted((x["start"], x["end"]) for x in spans):
                    if s > reach:
                        parts.append(text[reach:s])
                    reach = max(reach, e)
                text = b"".join([*parts, text[reach:]])
            out.append(None if text is None else text.decode("utf-8", "ignore"))  # a character cut in part goes
        batch = batch.set_column(at, "text", pa.array(out, pa.string()))
        yield batch.drop_columns([SPANS])


SPANS = "__spans"


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated passages cut from their texts; ``n_chars``,
    where there is one, is that of the text left.  Null texts stay null."""
    spans = repeats(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias(SPANS))  # of one document
    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    cut = docs.withColumn("text", F.col("text").cast("string")).join(spans, "doc_id", "left").select(*docs.columns, SPANS).mapInArrow(_cut, schema)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars").cast("long")).cast(docs.schema["n_chars"].dataType))
    return cut

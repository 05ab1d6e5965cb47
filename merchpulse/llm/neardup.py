"""Near duplicates by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, hashed to 64 bits by one
function; its sketch is the k smallest hashes.  Inverted lists of retained
values give overlaps, the union sketch (the k smallest of both) estimates the
similarity, and the full sets confirm it exactly.

1. Documents with equal sets are one class, represented by its smallest id.
2. Retained values that only one class has link nothing.  Each class keeps
   its rarest values only: two classes that share t of k values share one of
   the k - t + 1 rarest of either (prefix filter), so text that very many
   documents share makes no list unless a document has little else.  Coarse
   sketches (k = 64) give a shortlist of classes, fine ones (k = 1024) of these
   the lists.  Where both sets are whole, a list brings a pair together only if
   enough values follow the list's one in either: an edited copy has shingles
   that nobody shares, which come first, and drops out.
3. In each list, hubs are compared with all other members that are not yet in
   their component.  The first round takes one hub a list, the member whose
   values are the most common, which an original has and its edited copies
   have not.  From then on, a list with few members outside its largest
   component is done in one round, with all of these as hubs: of two members
   of different components, one is outside.  Longer lists take some hubs, which
   then leave the list, and both numbers grow sixteenfold a round.  No pair is
   compared twice; rounds go on until every pair of every list was compared or
   lies in one component, so no link is lost, while a group of copies costs
   about one comparison a member.
4. Components of confirmed links; the smallest id names a component.

The prefix and estimate thresholds follow from the similarity asked for: of
the k values of a union sketch, fewer than ``least_common(k, percent)`` are
common to two documents as similar as that with a probability below 1e-8 (the
values are drawn from the union without replacement, whose tail is below the
binomial one); sets of up to k shingles are compared exactly.  Tables of a
round are removed when the next one's are written.

Defined cases: null texts and texts without words have an empty set, are
linked with nothing and stay; documents without an id take no part in linking
and stay (component null); rows of one id are one node, linked by each of
their texts, and kept is true for all of them if the id is its component's
smallest; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import count
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.graph import components
from merchpulse.llm.tables import done_with, rows_with_key, ship_package, text_slices, written
from merchpulse.llm.textbytes import NONSPACE, U, mix, split_words

#: Values of the coarse sketch, and of the fine one of documents that it shortlists.
K, FINE_K = 64, 1024
#: The probability that a pair is missed by a sketch's threshold.
MISSED = 1e-8
SLICE_BYTES = 4 << 20
_ORDER = [U(0x9FB21C651E98DF25), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)]


def least_common(k: int, percent: int) -> int:
    """Common values that the union sketch of two documents with a similarity
    of ``percent`` has at least, but for a chance of ``MISSED``."""
    p, tail = percent / 100, 0.0
    for n in range(k + 1):
        tail += comb(k, n) * p**n * (1 - p) ** (k - n)
        if tail >= MISSED:
            return max(n, 1)
    return k


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles, as signed integers."""
    words = split_words(texts, NONSPACE)
    h = words.hashes()
    n = len(h)
    rolled = np.zeros(n, U)
    for i in range(width):
        shifted = np.zeros(n, U)
        shifted[: max(n - i, 0)] = h[i:]
        rolled += mix(shifted * _ORDER[i % 5] + U(i))
    rolled = mix(rolled).view(np.int64)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:  # the whole sequence, told apart from full shingles by its length
            place = np.arange(b - a, dtype=U)
            whole = mix(h[a:b] * _ORDER[0] + mix(place + U(1000))).sum(dtype=U)
            out.append(mix(np.array([whole]) + U(b - a)).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def class_of(members: np.ndarray) -> int:
    """A 64-bit name of a set of hashes, the same for equal sets."""
    h = members.view(U)
    both = mix(np.array([mix(h).sum(dtype=U), np.bitwise_xor.reduce(mix(h + U(1))) + U(len(h))], U))
    return int(mix(both[:1] + both[1:] * _ORDER[0]).view(np.int64)[0])


def _sketch_batches(width: int, k: int):
    def sketch(batches):
        for rows, texts in text_slices(batches, SLICE_BYTES):
            sets = shingle_sets(texts, width)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([s[:k] for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "class", "sketch"],
            )

    return sketch


def _set_batches(width: int):
    def sets(batches):
        for _, texts in text_slices(batches, SLICE_BYTES):
            made = [s for s in shingle_sets(texts, width) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in made], pa.int64()), pa.array(made, pa.list_(pa.int64()))], names=["class", "members"]
            )

    return sets


def sketches(docs: DataFrame, width: int, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, class, sketch``; the class names the whole set."""
    return rows_with_key(docs, "doc_id", "text").mapInArrow(
        _sketch_batches(width, k), "doc_id long, n_shingles long, class long, sketch array<long>"
    )


def postings(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``value, class, n, weight, place, near``: each class under its rarest
    retained values; ``place`` counts the rarer ones that it retains, ``near``
    marks those that the smaller of a pair is found by."""
    values = classes.select("class", F.col("n_shingles").alias("n"), F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    shared = (
        values.join(often, "value")
        .groupBy("class", "n", "kept")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"), F.sum("df").alias("weight"))  # at most k values
    )
    # Common values that two sketches of similar documents have at least.  Sets
    # so small that all similar ones are whole share p % of the larger one, and
    # 2p / (100 + p) of the smaller one; a whole set of up to k shingles shares
    # 2 - 100 / p of them with a sketch.
    whole, small = F.col("n") <= k, 100 * F.col("n") < percent * k
    n = F.col("kept")
    far = F.when(small, F.ceil(n * percent / 100)).when(whole, F.ceil(n * (2 - 100 / percent))).otherwise(F.lit(least_common(k, percent)).cast("long"))
    near = F.when(small, F.ceil(n * (2 * percent) / (100 + percent))).otherwise(far)
    unshared = n - F.size("shared")
    return (
        shared.withColumns({"far": (n - far + 1 - unshared).cast("int"), "close": (n - near + 1 - unshared).cast("int")})
        .where(F.col("far") > 0)
        .select("class", "n", "weight", "close", unshared.alias("unshared"), F.posexplode(F.slice("shared", 1, F.col("far"))).alias("at", "s"))
        .select(
            F.col("s.value").alias("value"), "class", "n", "weight", (F.col("unshared") + F.col("at")).alias("place"),
            (F.col("at") < F.col("close")).alias("near"),
        )
    )


def can_begin(n: Column, place: Column, other: Column, percent: int) -> Column:
    """If the value at ``place`` of a set of ``n``, all retained, can be the
    rarest one common with a set of ``other``, as similar as asked for: what
    follows must hold all common values, ``percent / (100 + percent)`` of both."""
    return (100 + percent) * (n - place) >= percent * (n + other)


def union_estimate(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    """Common values in the k smallest of both sketches, and how many these are."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)), F.size(union)


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def links(classes: DataFrame, texts, width: int, percent: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Links between classes that connect all similar ones: every pair with
    ``100 * common >= percent * union`` is a link or joined by links.  Written
    tables: links of each round, and the components they make (none without links).

    ``classes``: class, n_shingles, sketch; ``texts(classes)`` gives
    rows with the texts of the classes asked for.
    """
    coarse = written(postings(classes, K, percent).select("value", "class"), "coarse")
    shared = coarse.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1).select("value")
    in_lists = written(coarse.join(shared, "value").select("class").distinct(), "shortlist")
    done_with(coarse)
    sets = texts(in_lists).mapInArrow(_set_batches(width), "class long, members array<long>").join(in_lists, "class", "left_semi")
    sets = written(sets.dropDuplicates(["class"]), "sets")
    fine = sets.select("class", F.size("members").cast("long").alias("n_shingles"), F.slice("members", 1, FINE_K).alias("sketch"))
    live = written(postings(fine, FINE_K, percent), "postings")
    sketch = written(classes.select("class", "sketch").join(live.select("class").distinct(), "class"), "sketch")
    labels = tested = None
    all_links = []
    kept = [in_lists, sets, sketch]
    for round_ in count():
        member = live
        if labels is not None:
            member = live.join(labels.withColumnRenamed("node", "class"), "class", "left")
        else:
            member = live.withColumn("component", F.col("class"))
        member = member.withColumn("component", F.coalesce("component", "class"))
        # members outside the list's largest component, and hubs of longer lists
        few, some = (1, 1) if round_ == 0 else (4 * 16 ** min(round_, 14), 4 * 16 ** min(round_ - 1, 13))
        each = member.groupBy("value", "component").agg(F.count(F.lit(1)).alias("members")) if labels is not None else member.withColumn("members", F.lit(1).cast("long"))
        open_ = (
            each.groupBy("value").agg((F.sum("members") - F.max("members")).alias("outside"), F.max(F.struct("members", "component")).alias("largest"))
            .where("outside > 0").select("value", (F.col("outside") <= few).alias("last"), F.col("largest.component").alias("largest"))
        )
        member = written(member.join(open_, "value"), "lists")
        if member.isEmpty():
            kept += [live, member]
            break
        deal = F.when(F.col("last"), F.col("class")).otherwise(F.pmod(F.xxhash64("class", F.lit(round_)), F.lit(some)))
        hubs = (
            member.where("not last or component <> largest").groupBy("value", deal.alias("deal"))
            .agg(
                F.max(
                    F.struct("weight", "class", F.col("component").alias("hub_component"), F.col("n").alias("hub_n"), F.col("place").alias("hub_place"), F.col("near").alias("hub_near"))
                ).alias("h")
            )
            .select("value", F.col("h.class").alias("hub"), "h.hub_component", "h.hub_n", "h.hub_place", "h.hub_near")
        )
        hubs = written(hubs, "hubs")
        smaller = (F.col("n") < F.col("hub_n")) | (F.col("n") == F.col("hub_n")) & (F.col("class") < F.col("hub"))
        whole = F.greatest("n", "hub_n") <= FINE_K
        begins = can_begin(F.col("n"), F.col("place"), F.col("hub_n"), percent) & can_begin(F.col("hub_n"), F.col("hub_place"), F.col("n"), percent)
        pairs = (
            member.join(hubs, "value")
            .where((F.col("component") != F.col("hub_component")) & _sizes_fit("n", "hub_n", percent))
            .where(F.when(whole, begins).otherwise(F.when(smaller, F.col("near")).otherwise(F.col("hub_near"))))
            .select(F.least("class", "hub").alias("class"), F.greatest("class", "hub").alias("hub"), "n", "hub_n")
            .dropDuplicates(["class", "hub"])
        )
        if tested is not None:
            pairs = pairs.join(tested, ["class", "hub"], "left_anti")
        pairs = written(pairs, "pairs")
        kept.append(pairs)
        tested = pairs.select("class", "hub") if tested is None else tested.union(pairs.select("class", "hub"))
        common, of = union_estimate(F.col("sketch"), F.col("hub_sketch"), K)
        likely = (
            pairs.join(sketch, "class").join(sketch.select(F.col("class").alias("hub"), F.col("sketch").alias("hub_sketch")), "hub")
            .where(common * K >= of * least_common(K, percent))
            .select("class", "hub", "n", "hub_n")
        )
        both = F.size(F.array_intersect("members", "hub_members"))
        found = written(
            likely.join(sets, "class").join(sets.select(F.col("class").alias("hub"), F.col("members").alias("hub_members")), "hub")
            .where(100 * both >= percent * (F.col("n") + F.col("hub_n") - both))
            .select(F.col("class").alias("a"), F.col("hub").alias("b")),
            "links",
        )
        all_links.append(found)
        if not found.isEmpty():
            before, labels = labels, components(united(all_links))
            if before is not None:
                done_with(before)
        left = member.where("not last").drop("component", "last", "largest")
        rest = written(left.join(hubs.select("value", F.col("hub").alias("class")), ["value", "class"], "left_anti"), "postings")
        done_with(live, member, hubs)
        live = rest
    done_with(*kept)
    return all_links, labels


def united(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, tables)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    ship_package(docs.sparkSession)
    sketched = written(sketches(docs, width), "sketches")
    linked = F.col("doc_id").isNotNull() & F.col("class").isNotNull()
    heads = written(sketched.where(linked).groupBy("class").agg(F.min("doc_id").alias("doc_id")), "heads")
    classes = sketched.where(linked).join(heads, ["class", "doc_id"]).dropDuplicates(["class"])
    classes = written(classes.select("class", "n_shingles", "sketch"), "classes")
    drawn = written(sketched.select("doc_id", "n_shingles", "class"), "drawn")
    done_with(sketched)  # its sketches are those of the classes
    fit = drawn.where(linked)

    def texts(wanted: DataFrame) -> DataFrame:
        ids = heads.join(wanted, "class").select("doc_id").distinct()
        return rows_with_key(docs, "doc_id", "text").join(ids, "doc_id", "left_semi").select("text")

    found, labels = links(classes, texts, width, percent)
    done_with(classes)
    # rows of one id with other texts hold their classes together
    several = fit.groupBy("doc_id").agg(F.min("class").alias("b"), F.max("class").alias("hi")).where("b < hi").select("doc_id", "b")
    held = written(fit.join(several, "doc_id").where("class <> b").select(F.col("class").alias("a"), "b"), "held")
    if not held.isEmpty():
        done_with(*([] if labels is None else [labels]))
        labels = components(united([*found, held]))
    done_with(held, *found)
    reach = heads.withColumn("component", F.col("class"))
    if labels is not None:
        reach = heads.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    # a component's smallest id is that of one of its classes; most ids are alone
    first = reach.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = reach.join(first, "component").select("class", "component_id")
    moved = fit.join(named, "class").where("component_id < doc_id").select("doc_id", "component_id").distinct()
    moved = written(moved, "reach")
    done_with(heads, *([] if labels is None else [labels]))
    out = drawn.select("doc_id", "n_shingles").join(moved, "doc_id", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    )


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id."""
    gone = near_duplicates(docs, width, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

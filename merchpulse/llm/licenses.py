"""License scans by diagonal voting.

Every text's words give rolling hashes of two and of five words at each
position; the templates' positions do the same.  Spark joins the two on the
hash, with the words behind it compared, so that a vote is never a collision.
A vote of text position p for template position q lies on the diagonal p - q: a
place of the template is a diagonal with many votes, and words put in or left
out continue it on a neighbouring one.  Votes are gathered by diagonal (at most
one for each template position), neighbouring diagonals are merged, and a
merged span is accepted by the share of the template's words that its votes
cover: all of a phrase, ``SHARE`` of a longer text.

A phrase (a template of fewer than ten words) is voted for by pairs of words, a
longer template by runs of five.  Only the places of whole phrases marked
``base`` are base places, each counted.  The score is the largest share covered
of any longer template, 1 where a phrase is found, 0 where there is neither.

Sizes: texts go through tasks a few megabytes at a time; they are never
shuffled.  What is shuffled are votes, by text and diagonal, merged before by
``collect_set`` of template positions, which a template's length bounds.  The
templates' positions are broadcast only up to ``MAX_POSITIONS``; beyond it Spark
chooses the join by its own size check.

Defined results: a null text is empty and has no words; a row without an id is
scanned like any other.  Rows that repeat id and text get equal results, rows
that repeat an id with other texts their own.  Ties and overlapping places all
count.  An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchpulse.llm.tables import rows_with_key, ship_package, text_slices
from merchpulse.llm.textbytes import ALNUM, Words, mix, split_words

SHORT, LONG = 2, 5
#: Templates of at least this many words are voted for by runs of five.
LONG_FROM = 10
#: Share of a long template's words that a label needs.
SHARE = 0.6
#: Neighbouring diagonals at most this far apart are one place.
SLACK = 8
#: Positions of a text in one row of the join's left side.
BLOCK = 1024
MAX_POSITIONS = 20_000
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    base: bool = False


#: The base phrases and their labels.
BASE = (
    Template("gnu general public license", "gpl", "gnu general public license", True),
    Template("apache license", "apache", "apache license", True),
    Template("cc by", "cc-by", "cc by", True),
    Template("mit license", "mit", "mit license", True),
)

#: Short notices that name a version, and the published notices
#: and opening paragraphs of common licenses.
NOTICES = (
    Template("apache 2.0 line", "apache-2.0", "licensed under the Apache License, Version 2.0"),
    Template("gpl 3 line", "gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template("gpl 2 line", "gpl-2.0", "licensed under the GNU General Public License, version 2"),
    Template("mit line", "mit-notice", "released under the MIT License"),
    Template("cc by 4.0 line", "cc-by-4.0", "CC BY 4.0"),
    Template("cc by-sa 4.0 line", "cc-by-sa-4.0", "CC BY-SA 4.0"),
    Template("mit permission", "mit-text",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
             '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
             "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
             "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
             "of the Software."),
    Template("apache notice", "apache-text",
             'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
             "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
             'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
             "implied. See the License for the specific language governing permissions and limitations under the License."),
    Template("gpl notice", "gpl-text",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
             "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
             "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
             "PURPOSE. See the GNU General Public License for more details."),
    Template("bsd conditions", "bsd-text",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
             "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
             "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution."),
    Template("cc by statement", "cc-by-text",
             "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit "
             "http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons"),
)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Rolling hash of ``length`` hashes from each place on, 0 near the end."""
    out = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - length + 1
    if n > 0:
        for k in range(length):
            out[:n] = mix(out[:n] * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n] + np.uint64(length))
    return out


def template_positions(templates) -> list[tuple]:
    """``(template, n, q, hash, gram)`` for each position q of each template
    of n words."""
    rows = []
    for t, template in enumerate(templates):
        words = split_words([template.text.encode()], ALNUM)
        spelled = [bytes(words.buf[a:b]).decode() for a, b in zip(words.starts, words.ends)]
        k = LONG if len(spelled) >= LONG_FROM else min(SHORT, len(spelled))
        if not spelled:
            raise ValueError(f"template {template.name!r} has no words")
        if k == 1:
            raise ValueError(f"template {template.name!r} has a single word")
        found = run_hashes(words.hashes(), k).astype(np.int64)
        rows += [(t, len(spelled), k, q, int(found[q]), spelled[q : q + k]) for q in range(len(spelled) - k + 1)]
    return rows


def _word_array(words: Words) -> pa.Array:
    """All words as one Arrow string array."""
    size = words.ends - words.starts
    inside = np.zeros(len(words.buf) + 1, np.int8)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    kept = words.buf[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(kept))


def _blocks(batches):
    """Texts as blocks of positions: the words from ``at`` on with the few
    after the block, and two hashes for each position, side by side."""
    for batch in batches:
        for rows, texts in text_slices([batch], SLICE_BYTES):
            words = split_words(texts, ALNUM)
            hashes, spelled = words.hashes(), _word_array(words)
            n = np.diff(words.first)
            blocks = -(-n // BLOCK)
            row = np.repeat(np.arange(len(texts)), blocks)
            at = (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
            # hashes within each text alone
            both = np.zeros((len(hashes), 2), np.uint64)
            for col, k in enumerate((SHORT, LONG)):
                both[:, col] = run_hashes(hashes, k)
                for back in range(1, k):  # runs that would leave their text
                    last = words.first[1:] - back
                    both[last[last >= words.first[:-1]], col] = 0
            begin = words.first[row] + at
            own = np.minimum(BLOCK, words.first[row + 1] - begin)
            more = np.minimum(BLOCK + LONG - 1, words.first[row + 1] - begin)
            take = np.repeat(begin - (np.cumsum(more) - more), more) + np.arange(more.sum())
            listed = pa.ListArray.from_arrays(np.append(0, np.cumsum(more)).astype(np.int32), spelled.take(pa.array(take)).cast(pa.string()))
            flat = np.repeat(begin - (np.cumsum(own) - own), own) + np.arange(own.sum())
            pairs = pa.ListArray.from_arrays(np.append(0, 2 * np.cumsum(own)).astype(np.int32), pa.array(both[flat].ravel().view(np.int64)))
            take_rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(take_rows), rows.column("mark").take(take_rows), pa.array(at, pa.int64()), listed, pairs],
                names=["doc_id", "mark", "at", "words", "hashes"],
            )


def _sizes(batches):
    for batch in batches:
        for rows, texts in text_slices([batch], SLICE_BYTES):
            n = np.diff(split_words(texts, ALNUM).first)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), pa.array(n.astype(np.int64))], names=["doc_id", "mark", "n_words"])


def _marked(docs: DataFrame) -> DataFrame:
    """Rows with a mark of their text, by which rows of one id are told apart."""
    return rows_with_key(docs, "doc_id", "text").withColumn("mark", F.sha2(F.coalesce("text", F.lit("")), 256))


def votes(docs: DataFrame, templates) -> DataFrame:
    """``doc_id, mark, template, n, k, diagonal, places``: the template
    positions voted for on each diagonal."""
    spark: SparkSession = docs.sparkSession
    rows = template_positions(templates)
    table = spark.createDataFrame(rows, "template int, n int, k int, q int, hash long, gram array<string>")
    if len(rows) <= MAX_POSITIONS:
        table = F.broadcast(table)  # at most MAX_POSITIONS rows
    blocks = _marked(docs).mapInArrow(_blocks, "doc_id long, mark string, at long, words array<string>, hashes array<long>")
    each = blocks.select("doc_id", "mark", "at", "words", F.posexplode("hashes").alias("i", "hash"))
    step = F.shiftright("i", 1)  # two hashes a position
    same = (each["hash"] == table["hash"]) & (F.slice(each["words"], step + 1, table["k"]) == table["gram"])
    found = each.join(table, same).select(
        "doc_id", "mark", "template", "n", "k", "q", (F.col("at") + step - F.col("q")).alias("diagonal")
    )
    return found.groupBy("doc_id", "mark", "template", "n", "k", "diagonal").agg(F.collect_set("q").alias("places"))


def spans(docs: DataFrame, templates=BASE + NOTICES, slack: int = SLACK) -> DataFrame:
    """``doc_id, mark, template, first_word, last_word, share``: merged places,
    with the share of the template's words that their votes cover.

    A phrase's places are its whole diagonals alone; for a longer template,
    diagonals at most ``slack`` apart are one place.
    """
    voted = votes(docs, templates)
    by = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > slack, F.lit(True)) | (F.col("k") < LONG)
    # spans of one text follow each other, so their number is bounded by its length
    grouped = voted.withColumn("far", far.cast("int")).withColumn("place", F.sum("far").over(by))
    merged = grouped.groupBy("doc_id", "mark", "template", "n", "k", "place").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("places") + F.col("k") - 1).alias("last_word"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda q: F.sequence(q, q + F.col("k") - 1)))))
    return merged.select("doc_id", "mark", "template", "k", "first_word", "last_word", (covered / F.col("n")).alias("share"))


def licenses(docs: DataFrame, templates=BASE + NOTICES, share: float = SHARE) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, places`` of every row, ``places`` being the accepted spans."""
    ship_package(docs.sparkSession)
    names = docs.sparkSession.createDataFrame([(t, x.label, x.base) for t, x in enumerate(templates)], "template int, label string, base boolean")
    found = spans(docs, templates).join(F.broadcast(names), "template")  # a row for each template
    # a phrase counts only whole
    found = found.where((F.col("k") == LONG) | (F.col("share") >= 1)).withColumn("taken", (F.col("k") < LONG) | (F.col("share") >= share))
    base = F.col("base") & F.col("taken")
    by_text = found.groupBy("doc_id", "mark").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(F.col("taken"), F.col("label"))).alias("labels"),
        F.max("share").alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("taken"), F.struct("first_word", "last_word", "label", "share")))).alias("places"),
    )
    sizes = _marked(docs).mapInArrow(_sizes, "doc_id long, mark string, n_words long")
    same = sizes["doc_id"].eqNullSafe(by_text["doc_id"]) & (sizes["mark"] == by_text["mark"])
    text = lambda c: F.array_join(F.sort_array(F.coalesce(c, F.array().cast("array<string>"))), ",")
    return sizes.join(by_text, same, "left").select(
        sizes["doc_id"], "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        text(F.col("base_labels")).alias("base_labels"), text(F.col("labels")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "places",
    )

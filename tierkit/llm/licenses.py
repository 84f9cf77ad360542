"""License scans: templates found by votes on diagonals.

1. Every ``k`` consecutive words of every text are hashed, whole texts, and
   joined in Spark to the positions of the templates' own ``k``-grams.
2. *Votes*: a hit says that a template would begin at text position minus
   template position, its diagonal; hits are counted by diagonal.  A phrase
   (fewer than ``K`` words) needs all of its pairs on one diagonal.  Of a notice,
   diagonals close to each other are merged, as inserted or dropped words move
   the rest by a few, and a share of its grams has to vote.
3. *Verification*: texts with candidates are read again, and a span's words are
   compared with the template's: a phrase word for word, a notice by the longest
   common subsequence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep
from tierkit.llm.words import chunks, utf8, windows
from tierkit.operators._names import q
from tierkit.operators.membership import key_filter, possible_rows
from tierkit.operators.merge import broadcast_limit


class Template(NamedTuple):
    label: str
    text: str


# Phrases, and the usual notices of some licenses.
PHRASES = (
    Template("mit", "mit license"),
    Template("apache", "apache license"),
    Template("gpl", "general public license"),
)
NOTICES = (
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    Template("apache", """you may not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
        ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License."""),
    Template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details."""),
    Template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution."""),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies."""),
    Template("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
)

K, PAIR = 5, 2
#: Share of a notice's grams that have to vote, and of its words to be verified.
VOTES, SHARE = 0.1, 0.75
#: Words of a text in one row of grams.
PIECE = 1 << 15

#: Bytes between words: all ASCII but digits and letters.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8, A-Z as a-z."""
    return _WORD.findall(text.encode().lower())  # bytes.lower() knows A-Z alone


class _Sought(NamedTuple):
    label: str
    words: list[bytes]
    size: int  # words of a gram
    grams: list[int]
    need: int
    reach: int  # diagonals this close are one place


def _sought(templates: Sequence[Template]) -> list[_Sought]:
    out = []
    for label, text in templates:
        words = words_of(text)
        if len(words) < PAIR:
            raise ValueError(f"a template needs {PAIR} words: {text!r}")
        size = K if len(words) >= K else PAIR
        (chunk,) = chunks(pa.array([text]), between=BETWEEN)
        grams = windows(chunk.hashes, size).view(np.int64).tolist()
        whole = size == PAIR
        out.append(_Sought(label, words, size, grams, len(grams) if whole else max(2, round(VOTES * len(grams))), 0 if whole else max(4, len(words) // 8)))
    return out


def _gramer(sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2), between=BETWEEN):
                lens = np.diff(chunk.bounds)
                # Pieces: (document, first word in the chunk, words).
                n = -(-lens // PIECE)
                doc = np.repeat(np.arange(len(lens)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                offsets = np.append(chunk.bounds[doc] + piece * PIECE, chunk.bounds[-1]).astype(np.int32)
                ends = np.repeat(chunk.bounds[1:], lens)
                take = pa.array(chunk.first + doc)
                for size in sizes:
                    grams = np.zeros(len(chunk.hashes), np.uint64)
                    grams[: max(0, len(grams) - size + 1)] = windows(chunk.hashes, size)
                    grams[np.arange(len(grams)) + size > ends] = 0  # runs into the next text
                    values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), pa.array((piece * PIECE).astype(np.int32)), values],
                        names=["id", "hash", "base", "grams"],
                    )

    return run


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        data, offsets = utf8(batch.column(2))
        step = 1 << 20
        for i in range(batch.num_rows):
            a, b = int(offsets[i]), int(offsets[i + 1])
            before = True
            for at in range(a, b, step):
                gap = BETWEEN[data[at : min(b, at + step)]]
                n[i] += np.count_nonzero(gap[:-1] & ~gap[1:]) + (before and not gap[0])
                before = gap[-1]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], names=["id", "hash", "n_words"])


def common(template: list[bytes], words: list[bytes]) -> int:
    """Length of the longest common subsequence, a word of the text at a time."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(template):
        where[w] = where.get(w, 0) | 1 << i
    whole = (1 << len(template)) - 1
    left = whole
    for w in words:
        met = left & where.get(w, 0)
        left = ((left + met) | (left - met)) & whole
    return len(template) - left.bit_count()


_SPAN = "hash long, template int, start_word long, end_word long, matched int"


def _verifier(sought: list[_Sought]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = utf8(batch.column(2))
            rows, out = [], []
            spans = batch.column(3)
            for chunk in chunks(batch.column(2), between=BETWEEN):
                for d in range(len(chunk.bounds) - 1):
                    row, (first, last) = chunk.first + d, chunk.bounds[d : d + 2].tolist()
                    for span in spans[row].as_py() if last > first else ():
                        wanted = sought[span["template"]]
                        start, end = max(0, span["low"]), min(last - first, span["high"] + len(wanted.words))
                        if end <= start:
                            continue
                        begin = int(chunk.starts[first + start])
                        # Up to where the next word starts, of this text or of none.
                        stop = int(chunk.starts[first + end]) if first + end < last else int(chunk.starts[last - 1])
                        found = _WORD.findall(data[begin:stop].tobytes().lower())
                        if first + end >= last:
                            found.append(_WORD.match(_tail(data, stop, batch.column(2), row)).group())
                        if wanted.size == PAIR:
                            matched = len(found) if found == wanted.words else 0
                        else:
                            matched = common(wanted.words, found)
                        if matched >= (1 if wanted.size == PAIR else SHARE) * len(wanted.words):
                            rows.append(row)
                            out.append((span["template"], start, end, matched))
            take = pa.array(rows, pa.int64())
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32())
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *columns], names=["id", *[x.split()[0] for x in _SPAN.split(", ")]])

    return run


def _tail(data: np.ndarray, start: int, column: pa.Array, row: int) -> bytes:
    """The text of ``row`` from byte ``start`` on, as far as its last word goes."""
    end = int(utf8(column.slice(row, 1))[1][-1])
    return data[start:end].tobytes().lower()


def find_templates(
    docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Verified places of templates: ``id``, ``hash`` (xxhash64 of the text),
    ``template`` (its place in ``templates``), ``start_word``, ``end_word``,
    ``matched`` (words of the template found there in order).

    Rows that repeat an id and its text are told once.  Null and empty texts
    have no place.  A notice changed in every few words, so that less than
    ``VOTES`` of its ``K``-grams are whole, is not found.
    """
    spark = docs.sparkSession
    sought = _sought(templates)
    text = F.coalesce(q(text_col).cast("string"), F.lit(""))
    rows = docs.select(q(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    places = [(g, t, at) for t, s in enumerate(sought) for at, g in enumerate(s.grams)]
    known = spark.createDataFrame(places, "gram long, template int, at int").coalesce(1)
    if 64 * len(places) <= broadcast_limit(spark):  # bytes of such a row, hashed
        known = F.broadcast(known)
    grams = rows.mapInArrow(_gramer(sorted({s.size for s in sought})), f"id {kind}, hash long, base int, grams array<long>")
    hits = grams.select("id", "hash", "base", F.posexplode("grams").alias("i", "gram")).join(known, "gram")
    hits = hits.select("id", "hash", "template", (F.col("base") + F.col("i") - F.col("at")).cast("long").alias("diagonal"), "at")
    # All that follows goes by text, so one exchange serves it.
    votes = hits.repartition("id", "hash").distinct().groupBy("id", "hash", "template", "diagonal").agg(F.count(F.lit(1)).alias("votes"))
    rules = F.array(*[F.struct(F.lit(s.need).alias("need"), F.lit(s.reach).alias("reach")) for s in sought])
    votes = votes.withColumn("rule", F.get(rules, F.col("template")))
    in_text = Window.partitionBy("id", "hash", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_text) > F.col("rule.reach")
    runs = votes.withColumn("run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(in_text))
    runs = runs.groupBy("id", "hash", "template", "run", "rule").agg(
        F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high")
    )
    spans = F.collect_list(F.struct("template", "low", "high")).alias("spans")
    asked = keep(runs.where("votes >= rule.need").groupBy("id", "hash").agg(spans), "license-spans")
    only = key_filter(asked, ["id", "hash"], asked.count(), broadcast_limit(spark))
    texts = rows if only is None else possible_rows(rows, ["id", "hash"], only)
    theirs = asked.select(F.col("id").alias("i"), F.col("hash").alias("h"), "spans")
    met = texts.dropDuplicates(["id", "hash"]).join(theirs, F.expr("id <=> i and hash = h")).select("id", "hash", "text", "spans")
    return met.mapInArrow(_verifier(sought), f"id {kind}, {_SPAN}")


def scan(
    docs: DataFrame,
    phrases: Sequence[Template] = PHRASES,
    notices: Sequence[Template] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_base`` (places of
    phrases), ``first_word`` and ``last_word`` (least and greatest of their
    starts), ``base_labels`` (of phrases), ``labels`` (of all), ``score`` (the
    greatest share of a template's words that stand in a place of it).

    Null and empty texts have no words, labels '' and a score of 0, as has a text
    without a place.  Rows with a null id, or that repeat one, each have a row;
    other columns are ignored.  An empty table gives no row.
    """
    templates = [*phrases, *notices]
    found = find_templates(docs, templates, id_col, text_col)
    facts = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(len(words_of(t.text))).alias("n")) for t in templates])
    found = found.withColumn("fact", F.get(facts, F.col("template"))).withColumn("base", F.col("template") < len(phrases))
    start = F.when(F.col("base"), F.col("start_word"))
    label = F.col("fact.label")
    told = found.groupBy(F.col("id").alias("i"), F.col("hash").alias("h")).agg(
        F.count(start).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"),
        F.max(F.col("matched") / F.col("fact.n")).alias("score"),
    )
    text = F.coalesce(q(text_col).cast("string"), F.lit(""))
    rows = docs.select(q(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    counted = rows.mapInArrow(_counter, f"id {rows.schema['id'].dataType.simpleString()}, hash long, n_words long")
    return counted.join(told, F.expr("id <=> i and hash = h"), "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

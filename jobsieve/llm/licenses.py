"""Licence scans by diagonal voting.

Every run of k words in a document is looked up among the runs of the licence templates.  A hit at word i of the
document and word j of a template votes for the diagonal i - j; an unbroken copy puts all its votes on one diagonal,
an edited one on a few close ones.  Votes are counted by diagonal, close diagonals are merged, and spans are verified:
short phrases word for word, long texts by the share of their runs that the span has in the template's order.  Merged
diagonals lie in a window of bounded width, so a span is hardly longer than its template.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import words
from .store import written

#: Words in a run, for phrases of up to SHORT words and for longer templates.
SHORT_RUN, LONG_RUN, SHORT = 2, 4, 8
#: Diagonals at most so far apart are one span.
SLACK = 8
#: A span's diagonals lie at most twice so far apart; a copy whose words moved by no more is in one window as a whole.
DRIFT = 4 * SLACK
#: Share of a long template's runs that makes a span count.
COVERAGE = 0.6

# The phrases that are counted as base, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Further phrases and the opening passages of public licence notices.
MORE = (
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("apache license version 2 0", "apache-2.0"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("mozilla public license", "mpl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("spdx license identifier", "spdx"),
    ("all rights reserved", "reserved"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", "apache-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gpl"),
    ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", "unlicense"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
)


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    base: bool
    run: int

    @property
    def runs(self) -> int:
        return len(self.words) - self.run + 1


def templates(base=BASE, more=MORE) -> list[Template]:
    out = []
    for number, (text, label, is_base) in enumerate([(*x, True) for x in base] + [(*x, False) for x in more]):
        own = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text))
        run = min(len(own), SHORT_RUN if len(own) <= SHORT else LONG_RUN)
        if own:
            out.append(Template(number, label, own, is_base, run))
    return out


def _hashes(texts: list[str]) -> np.ndarray:
    out = []
    for chunk in words.chunks(pa.array(texts, pa.string()), words.ALNUM):
        out.append(chunk.h)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def runs_of(found: list[Template]):
    """(hash, template, place in it, words) of every run of every template."""
    out = []
    for t in found:
        for place, h in enumerate(words.grams(_hashes([" ".join(t.words)]), t.run)):
            out.append((int(h.view(np.int64)), t.number, place, " ".join(t.words[place : place + t.run])))
    return out


def rolling_runs(docs: DataFrame, found: list[Template], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document one row (row, doc_id, n_words), and a row (row, at, hash, run) for every run of its words.

    run has the words themselves where the hash may be a template's, so that a match can be verified without reading
    the text again.
    """
    sizes = sorted({t.run for t in found})
    wanted = {k: [] for k in sizes}
    size_of = {t.number: t.run for t in found}
    for h, number, _, _ in runs_of(found):
        wanted[size_of[number]].append(h)
    marks = {}
    for k, hs in wanted.items():
        marks[k] = np.zeros(1 << 16, bool)
        marks[k][(np.array(hs, np.int64).view(np.uint64) >> np.uint64(48)).astype(np.int64)] = True
    names = ["row", "doc_id", "n_words", "at", "hash", "run"]

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for chunk in words.chunks(batch.column(1), words.ALNUM):
                n = len(chunk.at) - 1
                row, empty = ids[chunk.lo : chunk.hi], pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(row), batch.column(2).slice(chunk.lo, n), pa.array(np.diff(chunk.at), pa.int64()), empty, empty, pa.nulls(n, pa.string())], names)
                owner = np.repeat(np.arange(n), np.diff(chunk.at))
                for k in sizes:
                    g = words.grams(chunk.h, k)
                    inside = np.flatnonzero(owner[: len(g)] == owner[k - 1 :])
                    for start in range(0, len(inside), 32768):
                        at = inside[start : start + 32768]
                        text = np.full(len(at), None, object)
                        for j in np.flatnonzero(marks[k][(g[at] >> np.uint64(48)).astype(np.int64)]).tolist():
                            i = at[j]
                            text[j] = b" ".join(chunk.buf[s:e].tobytes().lower() for s, e in zip(chunk.starts[i : i + k], chunk.ends[i : i + k])).decode("utf-8", "replace")
                        none = pa.nulls(len(at), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(row[owner[at]]), none, none, pa.array(at - chunk.at[owner[at]]), pa.array(g[at].view(np.int64)), pa.array(text, pa.string())], names)

    own = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    return own.mapInArrow(scan, "row long, doc_id long, n_words long, at long, hash long, run string")


def matched(rows: DataFrame, found: list[Template]) -> DataFrame:
    """The rows of ``rolling_runs`` that open a document, and those that meet templates' runs, with (template, place)."""
    # bounded by the fixed list of templates
    table = rows.sparkSession.createDataFrame(runs_of(found), "hash long, template int, place long, words string")
    met = rows.join(F.broadcast(table), "hash", "left")
    return met.where(F.col("at").isNull() | (F.col("run") == F.col("words"))).select("row", "doc_id", "n_words", "at", "template", "place")


def aligned(hits: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(length, first at, last at) of a longest chain of hits (at, place) in which both grow."""
    ends: list[int] = []  # the least last place of a chain of each length, and which hit that is
    held: list[int] = []
    hits = sorted(hits, key=lambda x: (x[0], -x[1]))
    before = [-1] * len(hits)
    for i, (_, place) in enumerate(hits):
        k = bisect_left(ends, place)
        if k == len(ends):
            ends.append(place), held.append(i)
        else:
            ends[k], held[k] = place, i
        before[i] = held[k - 1] if k else -1
    i = held[-1]
    last = hits[i][0]
    while before[i] >= 0:
        i = before[i]
    return len(ends), hits[i][0], last


_VOTES = T.StructType([T.StructField("met", T.LongType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])


@F.arrow_udf(_VOTES)
def _ordered(column: pa.Array) -> pa.Array:
    """``aligned`` of each list of (diagonal, places)."""
    found = [aligned([(d["diagonal"] + p, p) for d in own for p in d["places"]]) for own in column.to_pylist()]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], ["met", "low", "high"])


def spans(met: DataFrame, found: list[Template], slack: int = SLACK, drift: int = DRIFT) -> DataFrame:
    """(row, template, label, base, short, start, stop, coverage): verified spans of each document and template.

    A short phrase has a span per diagonal, with the share of its runs there.  Diagonals of a long template at most
    ``slack`` apart are merged; where more than ``drift`` lie between the first and the last, overlapping windows of twice
    that width are taken.  A span's coverage is the share of the template's runs that it has in order.
    """
    facts = met.sparkSession.createDataFrame([(t.number, t.label, t.base, t.runs, len(t.words) <= SHORT, t.run) for t in found], "template int, label string, base boolean, runs int, short boolean, size int")
    met = met.where("at is not null")
    votes = met.groupBy("row", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.collect_set("place").alias("places"), F.min("at").alias("low"), F.max("at").alias("high"))
    votes = votes.join(F.broadcast(facts), "template")  # bounded by the fixed list of templates
    names = ["row", "template", "label", "base", "short"]
    phrases = votes.where("short").select(*names, F.col("low").alias("start"), (F.col("high") + F.col("size")).alias("stop"), (F.size("places") / F.col("runs")).alias("coverage"))

    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.lag("diagonal").over(order).isNull() | (F.col("diagonal") - F.lag("diagonal").over(order) > slack)
    grouped = votes.where("not short").withColumn("span", F.sum(apart.cast("long")).over(order))
    cell = F.floor((F.col("diagonal") - F.min("diagonal").over(Window.partitionBy("row", "template", "span"))) / (drift + 1))
    windows = grouped.withColumn("cell", cell).withColumn("window", F.explode(F.sequence(F.greatest(F.col("cell") - 1, F.lit(0)), F.col("cell"))))
    merged = windows.groupBy(*names, "runs", "size", "span", "window").agg(F.collect_list(F.struct("diagonal", "places")).alias("votes"))
    long = merged.withColumn("chain", _ordered("votes")).select(*names, F.col("chain.low").alias("start"), (F.col("chain.high") + F.col("size")).alias("stop"), (F.col("chain.met") / F.col("runs")).alias("coverage"))
    return phrases.unionByName(long)


def scan(docs: DataFrame, found: list[Template] | None = None, coverage: float = COVERAGE, slack: int = SLACK, drift: int = DRIFT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of docs.

    A short phrase counts where its words stand consecutively, a long template where a span has at least
    ``coverage`` of its runs in order.  score is the largest share of a template that a document has in one place.  Texts
    without words or null have no labels and score 0; null ids stay null; repeated rows are scanned each; an empty
    table gives no rows; other columns are ignored.
    """
    found = found or templates()
    got = written(matched(rolling_runs(docs, found, id_col, text_col), found), "hits")
    every = spans(got, found, slack, drift)
    good = F.col("coverage") >= F.when(F.col("short"), F.lit(1.0)).otherwise(F.lit(coverage))
    base = good & F.col("base")
    per = every.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(base, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(good, F.col("label"))))).alias("labels"),
        F.max("coverage").alias("score"),
    )
    heads = got.where("at is null").select("row", "doc_id", "n_words")
    zero = F.lit("")
    return heads.join(per, "row", "left").select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", zero).alias("base_labels"), F.coalesce("labels", zero).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))

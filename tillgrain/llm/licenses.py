"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of a text's words, wherever lines and paragraphs end: for a template of L words every
run of up to ``span`` times L words. So a wrapped or commented notice is one block, also with its address in a
paragraph of its own, and words scattered over a long paragraph are none. A template meets a block that
holds at least ``threshold`` of its distinct words. Words are ordered by how often templates' words stand
in the corpus, rarest first. A window that meets a template of m distinct words with at least o of them
holds one of the template's first m - o + 1 words (prefix filter): only the words around such places are
looked at. They must hold o words of the template (length filter), and after their first one at place i of
the template at most m - i - 1 more can follow (positional filter). The windows that are left are counted exactly, word
by word.

Besides, every place is counted where the words of a base phrase stand one after the other.

Words: ASCII letters in lower case, digits and everything beyond ASCII. A null text is empty: no
words, no labels, score 0. Repeated rows give a result each; an empty table gives no rows; columns
other than the id and the text are left out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.llm.tables import query, table, whole_text

#: Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Public license notices by the label that they give.
TEMPLATES = {
    "agpl-notice": "This program is free software: you can redistribute it and/or modify it under "
    "the terms of the GNU Affero General Public License as published by the Free Software "
    "Foundation",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may "
    "not use this file except in compliance with the License. You may obtain a copy of the License "
    "at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-line": "Licensed under the Apache License",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met",
    "cc-by-nc-line": "Licensed under CC BY-NC",
    "cc-by-sa-line": "Licensed under CC BY-SA",
    "gpl-line": "This work is licensed under the GNU General Public License",
    "gpl-notice": "This program is free software; you can redistribute it and/or modify it under "
    "the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose "
    "with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies",
    "mit-line": "Released under the MIT License",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    "this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, "
    "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
    "http://mozilla.org/MPL/2.0/",
}
THRESHOLD = 0.9
#: A window has so many times the words of the template.
SPAN = 1.5

#: Upper case to lower case; everything in ASCII that is no letter or digit to a blank.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
                 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class Templates:
    """Templates as word lists in the corpus's order, with the filters of the join."""

    def __init__(self, templates: dict[str, str], threshold: float, frequency: dict[bytes, int],
                 span: float = SPAN):
        order = lambda w: (frequency.get(w, 0), w)
        texts = {label: words_of(text.encode()) for label, text in templates.items()}
        self.sets = {label: sorted(set(ws), key=order) for label, ws in texts.items() if ws}
        self.width = {label: max(len(ws), int(span * len(ws) + 1e-9)) for label, ws in texts.items()}
        self.least = {label: max(1, int(np.ceil(threshold * len(ws) - 1e-9)))
                      for label, ws in self.sets.items()}
        self.place = {label: {w: i for i, w in enumerate(ws)} for label, ws in self.sets.items()}
        self.prefixes = {label: ws[:len(ws) - self.least[label] + 1]
                         for label, ws in self.sets.items()}
        self.prefix_words = frozenset(w for ws in self.prefixes.values() for w in ws)

    def matches(self, words: list[bytes], held: set[bytes]) -> dict[str, tuple[float, list[int]]]:
        """For every template that a window of the words meets, the largest share that one holds, and
        where the windows begin that meet it, each with a word of the template."""
        found = {}
        if held.isdisjoint(self.prefix_words):
            return found
        for label, own in self.sets.items():
            if sum(w in held for w in own) < self.least[label]:
                continue
            best, starts = 0, []
            for begin, end in self._around(label, words, held):
                most, at = self._windows(label, words, begin, end)
                best = max(best, most)
                starts += at
            if starts:
                found[label] = best / len(own), starts
        return found

    def _around(self, label: str, words: list[bytes], held: set[bytes]) -> Iterator[tuple[int, int]]:
        """Stretches of the text that hold every window with a prefix word."""
        width = self.width[label]
        near = sorted(n for w in self.prefixes[label] if w in held for n in places(words, [w]))
        begin = end = 0
        for n in near:
            if n - width + 1 > end:
                if end:
                    yield begin, end
                begin = n - width + 1
            end = n + width
            begin = max(begin, 0)
        if end:
            yield begin, min(end, len(words))

    def _windows(self, label: str, words: list[bytes], begin: int, end: int) -> tuple[int, list[int]]:
        place, least, width = self.place[label], self.least[label], self.width[label]
        known = [(n, place[w]) for n, w in enumerate(words[begin:end], begin) if w in place]
        first = min(i for _, i in known)
        if len(known) < least or len(place) - first < least:
            return 0, []
        inside, last, best, starts = Counter(), 0, 0, []
        for n, i in known:
            while last < len(known) and known[last][0] < n + width:
                inside[known[last][1]] += 1
                last += 1
            if len(inside) >= least:
                best = max(best, len(inside))
                starts.append(n)
            inside[i] -= 1
            if not inside[i]:
                del inside[i]
        return best, starts


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: frozenset) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            seen.update(w for w in words_of(text.as_py().encode()) if w in vocabulary)
    yield pa.RecordBatch.from_pydict({
        "word": pa.array([w.decode() for w in seen], pa.string()),
        "places": pa.array(list(seen.values()), pa.int64())})


def word_frequency(docs: DataFrame, templates: dict[str, str], text: str = "text",
                   ) -> dict[bytes, int]:
    """How often each word of the templates stands in all documents; as many rows reach the driver as
    the templates have words."""
    vocabulary = frozenset(w for t in templates.values() for w in words_of(t.encode()))
    counted = docs.select(whole_text(text)).mapInArrow(
        lambda batches: _counts(batches, vocabulary), "word string, places bigint")
    rows = counted.groupBy("word").agg(F.sum("places").alias("places")).collect()
    return {r["word"].encode(): r["places"] for r in rows}


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the phrase's words stand one after the other."""
    found, at = [], -1
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at:at + len(phrase)] == phrase:
                found.append(at)
    except ValueError:
        return found


RESULT = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double, blocks array<int>")


def lines_of(text: bytes, at: list[int]) -> list[int]:
    """The numbers of the lines in which the words at the given places stand."""
    before = list(accumulate(len(words_of(line)) for line in text.split(b"\n")))
    return sorted({bisect_right(before, n) for n in at})


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         base: dict[str, str] = BASE, id: str = "doc_id", text: str = "text",
         span: float = SPAN) -> DataFrame:
    """Per document: its words, the places of base phrases, the labels of phrases and templates, the
    largest share of a template that a block holds (1 for a phrase), and the numbers of the lines
    in which blocks that meet a template begin with a word of it."""
    ready = Templates(templates, threshold, word_frequency(docs, templates, text), span)
    phrases = [(words_of(p.encode()), label) for p, label in base.items()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py().encode()
                words = words_of(body)
                held = set(words)
                starts, base_labels = [], set()
                for phrase, label in phrases:
                    if held.issuperset(phrase) and (at := places(words, phrase)):
                        starts += at
                        base_labels.add(label)
                met = ready.matches(words, held)
                lines = lines_of(body, [n for _, at in met.values() for n in at]) if met else []
                rows.append((doc_id, len(words), len(starts), min(starts, default=None),
                             max(starts, default=None), ",".join(sorted(base_labels)),
                             ",".join(sorted(base_labels | set(met))),
                             1.0 if starts else max((share for share, _ in met.values()), default=0.0),
                             lines))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*rows) if rows else [[]] * 9,
                    [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.int32())])],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                 "score", "blocks"])

    return docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"),
                       whole_text(text).alias("text")).mapInArrow(search, RESULT)


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))

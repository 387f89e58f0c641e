"""Licence scan with a positional index of rare licence words.

The index holds, for every word of the licence templates, its postings
(template, position) and its inverse document frequency over all documents of
the scan.  A template's anchors are its words at or above the template's median
IDF.  In a file, every anchor occurrence is looked up and gives diagonals
(place in the file minus place in the template); diagonals that agree within
``SLACK`` words form an alignment.  An alignment whose anchors carry at least
``SHARE`` of the template's anchor IDF is a candidate, and it counts when the
template's mandatory key phrases all stand, word for word, inside the aligned
stretch.  Its score is the share of the template's whole IDF that is found.

Besides, the base phrases are found wherever their words stand consecutively;
they label a file by themselves with score 1.

Scale: one narrow pass counts document frequencies of the few template words;
the scan is a second map over the documents.  The index is a fixed table of the
templates' size, and nothing is shuffled but those counts.

Defined cases: null counts as empty; a text without words has no place and no
label, score 0; repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, words

#: Phrases that label a file wherever their words stand consecutively (fixed by contract).
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, notice as it is customarily given in files, and phrases that must be there.
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the software without restriction",
     ("permission is hereby granted free of charge", "without restriction")),
    ("mit", "released under the terms of the MIT license", ("the mit license",)),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
     "with the License", ("apache license", "except in compliance with the license")),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2",
     ("gnu general public license version 2",)),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3",
     ("gnu general public license version 3",)),
    ("gpl-3", "redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
     ("gnu general public license", "version 3 of the license")),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3",
     ("gnu lesser general public license version 3",)),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3",
     ("gnu affero general public license version 3",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met",
     ("redistribution and use in source and binary forms", "following conditions are met")),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license v 2",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted", ("with or without fee is hereby granted",)),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal", ("cc0 1 0",)),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution 4 0 international",)),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ("attribution sharealike 4 0",)),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("attribution noncommercial 4 0",)),
]

SHARE = 0.6
SLACK = 4


def _words(text: str) -> tuple[bytes, ...]:
    return tuple(words(text))


def places(text: list[bytes], phrase: tuple[bytes, ...], where: list[int] | None = None) -> list[int]:
    """Places where a phrase's words stand consecutively, among ``where`` if given."""
    n = len(phrase)
    starts = where if where is not None else [i for i, w in enumerate(text) if w == phrase[0]]
    return [i for i in starts if tuple(text[i:i + n]) == phrase]


def vocabulary() -> set[bytes]:
    return {w for _, text, _ in TEMPLATES for w in _words(text)} | {w for p in BASE for w in _words(p)}


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Documents, and of each template word the documents that hold it; all rows count."""
    bounded_batches(docs.sparkSession)
    known = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(known.intersection(words(text)))
        yield pa.RecordBatch.from_pylist([{"word": w, "n": n} for w, n in found.items()],
                                         pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    counts = docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return docs.count(), {bytes(r.word): r.n for r in counts.collect()}


class Index:
    """Postings and weights of the templates."""

    def __init__(self, n_docs: int, df: dict[bytes, int]):
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-9 for w in vocabulary()}
        self.texts = [_words(text) for _, text, _ in TEMPLATES]
        self.keys = [[_words(k) for k in keys] for _, _, keys in TEMPLATES]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.anchors: list[dict[int, float]] = []
        for t, text in enumerate(self.texts):
            middle = sorted(self.idf[w] for w in text)[len(text) // 2]
            anchors = {q: self.idf[w] for q, w in enumerate(text) if self.idf[w] >= middle}
            self.anchors.append(anchors)
            for q in anchors:
                self.postings[text[q]].append((t, q))
        #: Base phrases with the place of their rarest word.
        self.base = [(w, max(range(len(w)), key=lambda i: self.idf[w[i]]), label)
                     for w, label in ((_words(p), label) for p, label in BASE.items())]
        #: The words to look for in a file.
        self.known = {*self.postings, *(w[i] for w, i, _ in self.base)}

    def alignments(self, at: dict[bytes, list[int]]) -> Iterator[tuple[int, int, int]]:
        """(template, first diagonal, last diagonal) of every candidate."""
        diagonals: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for word, found in at.items():
            for t, q in self.postings.get(word, ()):
                diagonals[t] += [(p - q, q) for p in found]
        for t, hits in diagonals.items():
            hits.sort()
            total = sum(self.anchors[t].values())
            weight: Counter = Counter()
            held, lo = 0.0, 0
            best: tuple[float, int, int] | None = None
            for diagonal, q in hits:  # a window of diagonals at most SLACK apart
                while diagonal - hits[lo][0] > SLACK:
                    old = hits[lo][1]
                    weight[old] -= 1
                    held -= self.anchors[t][old] if weight[old] == 0 else 0.0
                    lo += 1
                held += self.anchors[t][q] if weight[q] == 0 else 0.0
                weight[q] += 1
                if held >= SHARE * total - 1e-9:
                    if best and hits[lo][0] - best[2] > SLACK:
                        yield t, best[1], best[2]
                        best = None
                    if best is None or held > best[0]:
                        best = (held, hits[lo][0], diagonal)
            if best:
                yield t, best[1], best[2]

    def scan(self, text: list[bytes]) -> dict:
        starts: list[int] = []
        labels: dict[str, float] = {}
        at: dict[bytes, list[int]] = {}
        known = self.known
        if not known.isdisjoint(text):
            for i, w in enumerate(text):
                if w in known:
                    at.setdefault(w, []).append(i)
        for phrase, rarest, label in self.base:
            if found := places(text, phrase, [i - rarest for i in at.get(phrase[rarest], ()) if i >= rarest]):
                starts += found
                labels[label] = 1.0
        base = sorted(labels)
        for t, first, last in self.alignments(at):
            stretch = text[max(0, first):last + len(self.texts[t]) + SLACK]
            if all(places(stretch, k) for k in self.keys[t]):
                all_idf = sum(self.idf[w] for w in self.texts[t])
                seen = set(stretch)
                score = sum(self.idf[w] for w in self.texts[t] if w in seen) / all_idf
                label = TEMPLATES[t][0]
                labels[label] = max(labels.get(label, 0.0), min(1.0, score))
        return {"n_words": len(text), "n_base": len(starts), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": ",".join(base),
                "labels": ",".join(sorted(labels)), "score": max(labels.values(), default=0.0)}


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType())])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the columns of ``RESULT``."""
    n_docs, df = document_frequencies(docs)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(n_docs, df)
        kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
        for texts in batches:
            yield pa.array([index.scan(words(t)) for t in texts.to_pylist()], kind)

    found = F.arrow_udf(scan, RESULT)(F.col("text"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")

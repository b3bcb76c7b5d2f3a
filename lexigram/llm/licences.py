"""Licence scans with a positional index of rare words.

Licence wordings are templates of words. Document frequencies of all template words are counted over the whole corpus; the
``ANCHORS`` words of highest inverse document frequency of each template, with their positions, form the index. A file looks up
those of its words that are in the index, rarest first. Every hit says where the template would begin; places on which two
different anchors agree (up to ``SLACK`` words) are verified: the template's key phrases must stand there in full, and at least
``COVERAGE`` of its words at their relative positions.

Base phrases are found wherever their words stand consecutively, for any number of places.

Words are maximal runs of ASCII letters and digits and of everything beyond ASCII, A-Z lower-cased. Null and empty texts have
no words, no labels and score 0. Rows that repeat are reported one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import importable, map_batches
from lexigram.llm.words import ALNUM, Words, blocks, doc_runs, runs

ANCHORS, SLACK, COVERAGE = 4, 2, 0.75

#: Base phrases and their labels; fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


#: Licence wordings (public texts) and the phrases that must be in them; fixed values.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Licensed under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template(
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        " on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        ("applicable law", "conditions of any kind"),
    ),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation",
        ("free software", "general public license"),
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation",
        ("lesser general public license",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        ("source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee",),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("unencumbered software", "public domain"),
    ),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4",)),
    Template(
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4",),
    ),
    Template("reserved", "All rights reserved", ("all rights reserved",)),
)


def _words(texts: list[str]) -> list[tuple[list[bytes], np.ndarray]]:
    found = Words(pa.array(texts, pa.string()), ALNUM)
    cuts = [(int(a), int(b)) for a, b in zip(found.first, found.first[1:])]
    return [([found.text(i) for i in range(a, b)], found.hashes[a:b]) for a, b in cuts]


class _Lookup:
    """Places of a batch's hashes in a small sorted table, -1 elsewhere."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.keys >> np.uint64(48)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(48)])
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        same = self.keys[at] == hashes[maybe]
        return maybe[same], at[same]


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[int, int], int]:
    """Documents that hold each template word, by its hash, and the number of documents: one row per template word."""
    table = _Lookup(np.concatenate([h for _, h in _words([t.text for t in templates])]))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.zeros(len(table.keys), np.int64)
        for a, b in blocks(batch.column(0)):
            words = Words(batch.column(0).slice(a, b - a), ALNUM)
            places, which = table.hits(words.hashes)
            met = np.unique(words.doc[places] * len(table.keys) + which)
            counts += np.bincount(met % len(table.keys), minlength=len(table.keys))
        keys, counts = np.append(table.keys.view(np.int64), 0), np.append(counts, batch.num_rows)
        kind = np.append(np.zeros(len(table.keys), np.int32), 1)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts), pa.array(kind, pa.int32())], names=["key", "n", "kind"])

    sums = map_batches(docs.select("text"), make, "key bigint, n bigint, kind int").groupBy("key", "kind").agg(F.sum("n").alias("n"))
    rows = sums.collect()
    return {r.key & (2**64 - 1): r.n for r in rows if not r.kind}, sum(r.n for r in rows if r.kind)


class Index:
    """Templates with their anchors: the rarest words of each and their positions."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[int, int], n_docs: int, anchors: int = ANCHORS):
        self.templates = templates
        self.words = _words([t.text for t in templates])
        self.idf = {k: math.log((n_docs + 1) / (n + 1)) + 1 for k, n in frequency.items()}
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for t, (_, hashes) in enumerate(self.words):
            rare = sorted({int(h) for h in hashes}, key=lambda h: (-self._idf(h), h))[:anchors]
            for position, h in enumerate(hashes.tolist()):
                if h in rare:
                    self.postings.setdefault(h, []).append((t, position))
        self.lookup = _Lookup(np.array(sorted(self.postings), np.uint64))
        self.phrases = [[words for words, _ in _words(list(t.phrases))] for t in templates]
        self.base = [(label, words, runs(h, len(h))[0]) for (words, h), label in zip(_words(list(BASE)), BASE.values())]

    def _idf(self, h: int) -> float:
        return self.idf.get(h, 50.0)

    def _phrases_stand(self, t: int, here: list[bytes]) -> bool:
        return all(any(here[k : k + len(p)] == p for k in range(len(here) - len(p) + 1)) for p in self.phrases[t])

    def matches(self, words: Words, first: int, last: int, places: list[int], keys: list[int]) -> list[tuple[str, int, int, float]]:
        """``(label, first word, last word, share of words in place)`` in words ``first`` to ``last`` of a batch.

        ``places``, ``keys``: the document's words that are anchors.
        """
        votes: dict[tuple[int, int], set[int]] = {}
        for place, key in sorted(zip(places, keys), key=lambda x: -self._idf(x[1])):
            for t, position in self.postings[key]:
                votes.setdefault((t, place - position), set()).add(key)
        best: dict[tuple[str, int], tuple[float, int, int]] = {}
        for (t, start), own in votes.items():
            agreed = set(own)
            for d in range(1, SLACK + 1):
                agreed |= votes.get((t, start - d), set()) | votes.get((t, start + d), set())
            size = len(self.words[t][1])
            if len(agreed) < min(2, size):
                continue
            begin, end = max(first, start - SLACK), min(last, start + size + SLACK)
            if not self._phrases_stand(t, [words.text(k) for k in range(begin, end)]):
                continue
            met = np.zeros(size, bool)
            for d in range(-SLACK, SLACK + 1):
                a, b = max(first, start + d), min(last, start + d + size)
                if a < b:
                    at = slice(a - start - d, b - start - d)
                    met[at] |= words.hashes[a:b] == self.words[t][1][at]
            share = float(met.mean())
            if share >= COVERAGE:
                label, place = self.templates[t].label, max(first, start) - first
                found = (share, place, min(last, start + size) - first)
                best[label, place] = max(best.get((label, place), (0.0, 0, 0)), found)
        return sorted((label, a, b, share) for (label, _), (share, a, b) in best.items())


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``docs`` (any columns, one of them ``text``) with ``n_words``, ``base`` (label, first: places of base phrases) and
    ``matches`` (label, first, last, score: places of templates, words from 0, end exclusive). Such columns are replaced."""
    index = Index(templates, *document_frequencies(docs, templates))
    shared = importable(docs.sparkSession).sparkContext.broadcast(index)
    none = {
        "n_words": F.lit(0).cast("bigint"),
        "base": F.array().cast("array<struct<label:string,first:bigint>>"),
        "matches": F.array().cast("array<struct<label:string,first:bigint,last:bigint,score:double>>"),
    }
    docs = docs.withColumns(none)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = shared.value
        text = batch.column(batch.schema.get_field_index("text"))
        counts = np.zeros(batch.num_rows, np.int64)
        base: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        matches: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for begin, end in blocks(text):
            words = Words(text.slice(begin, end - begin), ALNUM)
            counts[begin:end] = np.diff(words.first)
            for label, phrase, key in index.base:
                places, hashes = doc_runs(words, len(phrase))
                for place in places[hashes == key].tolist():
                    if all(words.text(place + k) == w for k, w in enumerate(phrase)):
                        doc = int(words.doc[place])
                        base[begin + doc].append({"label": label, "first": place - int(words.first[doc])})
            places, which = index.lookup.hits(words.hashes)
            docs_met, starts = np.unique(words.doc[places], return_index=True)
            keys = index.lookup.keys[which].tolist()
            for doc, a, b in zip(docs_met.tolist(), starts.tolist(), [*starts[1:].tolist(), len(places)]):
                first, last = int(words.first[doc]), int(words.first[doc + 1])
                for label, x, y, share in index.matches(words, first, last, places[a:b].tolist(), keys[a:b]):
                    matches[begin + doc].append({"label": label, "first": x, "last": y, "score": share})
        new = {"n_words": counts, "base": base, "matches": matches}
        columns = [pa.array(new[f.name], f.type) if f.name in new else c for f, c in zip(batch.schema, batch.columns)]
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, make, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """One row per document, in the form of the registered query; a base phrase scores 1."""
    found = scan(docs.select("doc_id", "text"))
    starts = F.transform("base", lambda b: b["first"])
    base = F.transform("base", lambda b: b["label"])
    labels = F.concat(base, F.transform("matches", lambda m: m["label"]))
    best = F.array_max(F.transform("matches", lambda m: m["score"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )

"""Licence scans with a positional index of words.

Method: how rare each licence word is follows from the number of documents that hold it, counted over all documents.
A template is a candidate if all its mandatory phrases stand in the file. All licence words of the file are looked up in
the index of its words, which gives the place of each. Words that are as far apart in the file as in the template agree
on one offset; a candidate with enough words on one offset is a finding, whatever else the file holds. Its weight is that
of the ``RARE`` words of highest IDF found on an offset.
Base findings are places where the words of a base phrase stand one after another.

Words are runs of bytes ``[0-9a-z]`` or beyond ASCII after lower-casing A-Z; they don't cross documents. Null and
empty texts have no words, no labels (an empty string) and score 0. Rows are independent.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import kernels as K

# Phrases of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Openings and notices of well-known licences: label, text, phrases without which a file doesn't carry it.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted", "free of charge"),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
        ("licensed under the apache license",),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("terms of the gnu general public license", "free software foundation"),
    ),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
        ("mozilla public license",),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee"),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("licensed under cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("licensed under cc by sa",)),
)
RARE, AGREE = 16, 4


class Index:
    """Postings of the template words."""

    def __init__(self, templates):
        self.labels = [label for label, _, _ in templates]
        words = [text.split() for _, text, _ in templates]
        self.words = sorted({w for x in words for w in x})
        by_hash = sorted((int(K.hash_words(w)[0]), w) for w in self.words)
        self.table = K.Lookup(np.array([h for h, _ in by_hash], dtype=np.uint64))
        self.order = [w for _, w in by_hash]
        number = {w: i for i, w in enumerate(self.order)}
        # For each template, of each word: where its places begin, and the places.
        self.postings = []
        for x in words:
            held = np.array([number[w] for w in x], dtype=np.int64)
            places = np.argsort(held, kind="stable")
            self.postings.append((np.searchsorted(held[places], np.arange(len(self.order) + 1)), places))
        self.in_template = [sorted({number[w] for w in x}) for x in words]
        self.mandatory = [[K.hash_words(p) for p in phrases] for _, _, phrases in templates]
        self.asked = [{number[w] for p in phrases for w in p.split() if w in number} for _, _, phrases in templates]


def _phrase_places(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand one after another."""
    n = len(words) - len(phrase) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero(words[:n] == phrase[0])
    for i in range(1, len(phrase)):
        at = at[words[at + i] == phrase[i]]
    return at


def document_frequencies(docs: DataFrame, index: Index) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that hold each template word."""

    def run(batches):
        counts, n = np.zeros(len(index.order), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, data, offsets in K.text_pieces(batch):
                lowered = K.lower_ascii(data)
                starts, ends, first = K.word_spans(lowered, offsets)
                at, which = index.table.find(K.span_hashes(K.prefix_sums(lowered), starts, ends))
                doc = np.searchsorted(first, at, side="right") - 1
                pairs = np.unique(doc * len(counts) + which)
                counts += np.bincount(pairs % len(counts), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used.tolist()], pa.int32()), pa.array([n, *counts[used].tolist()], pa.int64())], ["word", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word: r.n for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(len(index.order))])


def _scan(index, idf, words, at, which, rare, agree):
    """Labels of one file and its best share of a template's weight. ``at``: places of licence words."""
    present = set(which.tolist())
    labels, best = set(), 0.0
    for template, (begin, places) in enumerate(index.postings):
        if not index.asked[template] <= present:
            continue
        if not all(len(_phrase_places(words, p)) for p in index.mandatory[template]):
            continue
        counts = begin[which + 1] - begin[which]
        from_ = np.repeat(begin[which] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        offset, word = np.repeat(at, counts) - places[from_], np.repeat(which, counts)
        low = offset.min(initial=0)
        offset, word = np.divmod(np.unique((offset - low) * len(idf) + word), len(idf))
        weight = np.asarray(idf)[word]
        order = np.lexsort((-weight, offset))
        offset, weight = offset[order], weight[order]
        _, heads, found = np.unique(offset, return_index=True, return_counts=True)
        if not (found >= agree).any():
            continue
        labels.add(index.labels[template])
        rank = np.arange(len(offset)) - np.repeat(heads, found)
        share = np.add.reduceat(np.where(rank < rare, weight, 0.0), heads)[found >= agree].max()
        top = sorted((idf[w] for w in index.in_template[template]), reverse=True)[:rare]
        best = max(best, min(1.0, float(share) / max(sum(top), 1e-9)))
    return labels, best


def scan(docs: DataFrame, templates=None, base: dict | None = None, rare: int = RARE, agree: int = AGREE):
    """Findings for each row of ``docs(doc_id, text)``; the score is 1 where a base phrase stands, else the share of
    the best template's weight found on one offset."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index, base = Index(TEMPLATES if templates is None else templates), BASE if base is None else base
    total, frequency = document_frequencies(docs, index)
    idf = [math.log((1 + total) / (1 + n)) for n in frequency.tolist()]
    phrases = [(K.hash_words(p), p.encode().split(), label) for p, label in base.items()]
    heads = np.unique([p[0] for p, _, _ in phrases])
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def piece(data, offsets):
        lowered = K.lower_ascii(data)
        starts, ends, first = K.word_spans(lowered, offsets)
        words = K.span_hashes(K.prefix_sums(lowered), starts, ends)
        word_at, which = index.table.find(words)
        bounds = np.searchsorted(word_at, first)
        places = []
        for phrase, spelled, label in phrases if np.isin(words, heads).any() else []:
            for at in _phrase_places(words, phrase).tolist():
                doc = int(np.searchsorted(first, at, side="right")) - 1
                same = at + len(phrase) <= first[doc + 1]
                if same and all(lowered[starts[at + i] : ends[at + i]].tobytes() == w for i, w in enumerate(spelled)):
                    places.append((doc, at - int(first[doc]), label))
        out = [[int(n), 0, None, None, "", "", 0.0] for n in np.diff(first)]
        for doc, place, label in places:
            row = out[doc]
            row[1] += 1
            row[2] = place if row[2] is None else min(row[2], place)
            row[3] = place if row[3] is None else max(row[3], place)
            row[4] = ",".join(sorted({label, *filter(None, row[4].split(","))}))
        for doc in np.flatnonzero(np.diff(bounds) >= agree).tolist():
            a, b = bounds[doc], bounds[doc + 1]
            own = words[first[doc] : first[doc + 1]]
            labels, out[doc][6] = _scan(index, idf, own, word_at[a:b] - first[doc], which[a:b], rare, agree)
            out[doc][5] = ",".join(sorted(labels))
        for row in out:
            row[5] = ",".join(sorted({*filter(None, row[4].split(",")), *filter(None, row[5].split(","))}))
            if row[1]:
                row[6] = 1.0
        return out

    def run(batches):
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            for begin, end, data, offsets in K.text_pieces(batch):
                columns = zip(*piece(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names,
                )

    return docs.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double",
    )

"""Licence scan by a positional index of rare words.

The index holds every word of the licence templates with its postings (template, position). One pass over all documents counts how
many hold each of these words (grouped, so the driver gets one row a word of the templates). In the second pass a
file is held against each template of whose key phrases it has all words: of the template's words that stand in the file
the `rare` ones of highest IDF are looked up, each place in the file and each posting give a relative position, and
regions of `slack` relative positions to which enough of these words point are intersected with the whole template. A
region is a finding if every key phrase stands in it, word by word, and at least `share` of the template's words stand there
at their relative position. Each template has its own rare words, so none is hidden by another's.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case. Base phrases are
found wherever their words stand consecutively, without the index.

Nulls: a null text has no words; a null id passes through. A text without words has no findings. Ties: of a template's
regions that cover equally much the first is reported; words of equal IDF are taken in the order of the templates' words. Repeated
rows get equal findings. A very long text is alone in its task's step; its places are walked once a template. An
empty table gives none. Other columns pass through in `row` whatever their names."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_map, buffer_of, slices, words_of

# Base phrases (label, phrase), as the contract names them.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Wordings of public licences and their notices (label, text, key phrases).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ["permission is hereby granted free of charge", "without restriction"]),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ["apache license", "in compliance with the license"]),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice", ["redistribution and use in source and binary forms", "must retain the above copyright notice"]),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["neither the name of", "endorse or promote products"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ["for any purpose with or without fee is hereby granted"]),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely", ["to alter it and redistribute it freely"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ["gnu general public license", "free software foundation"]),
    ("gpl", "This work is licensed under the GNU General Public License, version", ["licensed under the gnu general public license"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ["gnu lesser general public license"]),
    ("agpl", "redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ["gnu affero general public license"]),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", ["mozilla public license", "source code form"]),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", ["unencumbered software released into the public domain"]),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software", ["permission is hereby granted free of charge", "use reproduce display distribute execute and transmit"]),
    ("cc0", "has waived all copyright and related or neighboring rights to this work. This work is published under the CC0 1.0 Universal Public Domain Dedication", ["cc0"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4"]),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", ["creative commons attribution sharealike"]),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", ["creative commons attribution noncommercial"]),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution NoDerivatives 4.0 International License", ["creative commons attribution noderivatives"]),
]

#: ASCII characters that part words.
APART = np.zeros(256, bool)
APART[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLACES = "array<struct<label: string, base: boolean, start: long, end: long, score: double>>"


def words(text: str) -> list[str]:
    """The words of a short text, A-Z in lower case."""
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _hashes(listed: list[str]) -> np.ndarray:
    buf, at = buffer_of(pa.array([" ".join(listed)]))
    return words_of(buf, at, apart=APART)[0]


class Index:
    """Templates by word: `vocabulary` (hashes, ascending), the words of each template as places in it, and its key phrases."""

    def __init__(self, templates: list[tuple[str, str, list[str]]]):
        own = [_hashes(words(text)) for _, text, _ in templates]
        keys = [[_hashes(words(p)) for p in phrases] for _, _, phrases in templates]
        self.labels = [label for label, _, _ in templates]
        # first use decides the order of words of equal IDF
        self.vocabulary, first = np.unique(np.concatenate([*own, *(p for k in keys for p in k), np.zeros(0, np.uint64)]), return_index=True)
        self.order = np.argsort(np.argsort(first))
        self.words = [np.searchsorted(self.vocabulary, w) for w in own]
        self.keys = [[np.searchsorted(self.vocabulary, p) for p in k] for k in keys]
        self.needs = np.zeros((len(templates), len(self.vocabulary)), bool)
        for t, k in enumerate(self.keys):
            for p in k:
                self.needs[t, p] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """For each word of a text its place in the vocabulary, -1 if it has none."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)


def _present(code: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Which text (row) has which word of the vocabulary."""
    here = np.zeros((len(first) - 1, size), bool)
    at = np.flatnonzero(code >= 0)
    here[np.searchsorted(first, at, side="right") - 1, code[at]] = True
    return here


def document_counts(docs: DataFrame, index: Index, text_col: str = "text") -> tuple[int, np.ndarray]:
    """How many documents there are, and how many hold each word of the vocabulary (over all documents)."""
    size = len(index.vocabulary)

    def run(batches):
        n, count = 0, np.zeros(size, np.int64)
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at, apart=APART)
            count += _present(index.places(h), first, size).sum(axis=0)
            n += part.num_rows
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(count[at], n), pa.int64())], names=["word", "n"])

    counted = arrow_map(docs.select(F.col(text_col).cast("string").alias("text")), run, "word int, n long")
    found = {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # a row a word of the templates
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(size)], np.int64)


def inverse_frequency(n: int, counts: np.ndarray) -> np.ndarray:
    return np.log((n + 1) / (counts + 1)) + 1


def regions(at: np.ndarray, code: np.ndarray, template: np.ndarray, idf: np.ndarray, order: np.ndarray, rare: int, slack: int) -> np.ndarray:
    """First relative positions of the regions to which a quarter of the looked-up words point.

    at, code: the places in the text of the vocabulary's words. Regions span `slack` relative positions and begin every half of that."""
    have = np.unique(code[np.isin(code, template)])
    look = have[np.lexsort((order[have], -idf[have]))][:rare]
    offsets, word = [], []
    for w in look.tolist():
        here, there = at[code == w], np.flatnonzero(template == w)
        offsets.append((here[:, None] - there[None, :]).ravel())
        word.append(np.full(len(here) * len(there), w))
    if not offsets:
        return np.zeros(0, np.int64)
    half, offsets, word = slack // 2, np.concatenate(offsets), np.concatenate(word)
    bins = np.concatenate([offsets // half, offsets // half - 1])
    votes = np.unique(np.stack([bins, np.concatenate([word, word])]), axis=1)
    begin, n = np.unique(votes[0], return_counts=True)
    return begin[4 * n >= len(look)] * half


def covered(at: np.ndarray, code: np.ndarray, template: np.ndarray, begin: int, slack: int) -> int:
    """How many of the template's words stand in the region, each within `slack` words from its relative position."""
    a, b = np.searchsorted(at, (begin, begin + slack + len(template)))
    off = at[a:b, None] - begin - np.arange(len(template))[None, :]
    return int(((code[a:b, None] == template[None, :]) & (off >= 0) & (off < slack)).any(axis=0).sum())


def stands(code: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase's words stand consecutively."""
    n = len(code) - len(phrase) + 1
    if n <= 0 or not len(phrase):
        return np.zeros(0, np.int64)
    hit = code[:n] == phrase[0]
    for k in range(1, len(phrase)):
        hit &= code[k : n + k] == phrase[k]
    return np.flatnonzero(hit)


def findings(code: np.ndarray, index: Index, idf: np.ndarray, which: list[int], rare: int, slack: int, share: float) -> list[tuple]:
    """(label, start, end, score) of the best region of each template of `which` that passes; code: every word's place in the vocabulary."""
    out, at = [], np.flatnonzero(code >= 0)
    have = code[at]
    for t in which:
        keys = [stands(code, p) for p in index.keys[t]]
        if not all(len(k) for k in keys):
            continue
        own, best = index.words[t], None
        for begin in regions(at, have, own, idf, index.order, rare, slack).tolist():
            lo, hi = max(0, begin), min(len(code), begin + slack + len(own))
            if not all(np.searchsorted(k, hi - len(p), side="right") > np.searchsorted(k, lo) for k, p in zip(keys, index.keys[t], strict=True)):
                continue
            score = covered(at, have, own, begin, slack) / len(own)
            if score >= share and (best is None or score > best[3]):
                best = (index.labels[t], lo, hi, score)
        if best:
            out.append(best)
    return out


def scan(docs: DataFrame, templates: list | None = None, base: list | None = None, rare: int = 12, slack: int = 32, share: float = 0.6, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of docs (its columns `keep`, all if None) as struct `row`, with n_words and `places`: base phrases and regions of
    licence wordings (words from 0, end excluded, score)."""
    index, base = Index(TEMPLATES if templates is None else templates), BASE if base is None else base
    idf = inverse_frequency(*document_counts(docs, index, text_col))
    phrases = [(label, _hashes(words(p)), " ".join(words(p)).encode()) for label, p in base]
    given = docs.select(F.struct(*(docs.columns if keep is None else keep)).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = given.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(PLACES).alias("places")).schema
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def run(batches):
        kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, starts, ends, first = words_of(buf, at, apart=APART)
            found: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for label, phrase, spelt in phrases:
                for p in stands(h, phrase).tolist():
                    row, last = int(np.searchsorted(first, p, side="right")) - 1, p + len(phrase)
                    same = b" ".join(buf[starts[k] : ends[k]].tobytes().lower() for k in range(p, last)) == spelt
                    if last <= first[row + 1] and same:
                        found[row].append({"label": label, "base": True, "start": p - int(first[row]), "end": last - int(first[row]), "score": 1.0})
            code = index.places(h)
            lacks = index.needs.astype(np.float32) @ (~_present(code, first, len(index.vocabulary))).T.astype(np.float32)
            for row in np.flatnonzero((lacks == 0).any(axis=0)).tolist():
                got = findings(code[first[row] : first[row + 1]], index, idf, np.flatnonzero(lacks[:, row] == 0).tolist(), rare, slack, share)
                found[row] += [{"label": n, "base": False, "start": a, "end": b, "score": s} for n, a, b, s in got]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(np.diff(first), pa.int64()), pa.array(found, kind)], names=["row", "n_words", "places"])

    return arrow_map(given, run, schema)


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")


def op12_rare_token_index(spark, sf_dir: str) -> DataFrame:
    """Query: every document's words, base phrases, labels and the best score."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("places", lambda x: x["base"])
    start = F.transform(base, lambda x: x["start"])
    best = F.coalesce(F.array_max(F.transform("places", lambda x: x["score"])), F.lit(0.0))
    return found.select("row.doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"), _labels(base).alias("base_labels"), _labels(F.col("places")).alias("labels"), F.round(best, 6).alias("score"))

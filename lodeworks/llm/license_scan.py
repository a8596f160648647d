"""Licences named or quoted in texts: a positional index of rare licence words, and key phrases.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A to Z in lower case.

Plain part: places where the words of a licence's name stand one after another (``PHRASES``).

Index part, for quoted notices and headers (``TEMPLATES``):

1. The documents that hold each word of the templates are counted over the whole table; what is collected
   is one number per template word. A word's weight is its inverse document frequency.
2. The index files, for each template, the positions of its rarest words: half of its different words, ``anchors`` at most.
3. In each text the indexed words are looked up. An occurrence at place p of a word with template position t
   votes for the alignment p - t; votes of one template that fall into a cell of 2 ``slack`` alignments (two grids of
   cells, so that no border parts votes up to ``slack`` apart, by an inserted name or a lost word) are taken
   together. Their share is the weight of the different anchors among them, over that of all anchors of the template.
4. An alignment with a share of ``least`` or more is a candidate. It is confirmed if every mandatory key
   phrase of the template stands word for word where the alignment expects it, within ``slack``.

Every occurrence votes, in texts of any length; nothing is cut off. Words are compared by 64-bit hashes.

A null or empty text has no words, no places and no matches. Every row gives one row, repeated rows and null ids too.
Other input columns are ignored. With an empty table, or none but empty texts, all words weigh the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import Words, slices

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # mandatory phrases, each a part of the text


#: Public licence notices, each with the phrases that must stand in a match.
TEMPLATES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template("mit", "Released under the MIT License", ("the mit license",)),
    Template("mit", "Licensed under the MIT License", ("the mit license",)),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
        ("redistribution and use in source and binary forms", "conditions are met"),
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ("licensed under the apache license version 2 0", "in compliance with the license"),
    ),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("the apache license version 2 0",)),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ("under the terms of the gnu general public license",),
    ),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("licensed under the gnu general public license",)),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation",
        ("gnu affero general public license",),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at",
        ("mozilla public license",),
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("licensed under cc by 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("licensed under cc by sa 4 0",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("licensed under cc by nc 4 0",)),
    Template(
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("has waived all copyright and related or neighboring rights",)),
)


def _hashed(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, _, w in slices(pa.array(texts, pa.string()), folded=True, apart=False):
        hashes = w.hashes()
        out += [hashes[w.first[r] : w.first[r + 1]] for r in range(w.rows)]
    return out


def _standing(w: Words, hashes: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Indexes of words at which the phrase starts, inside one row."""
    k = len(phrase)
    if not k or len(hashes) < k:
        return np.empty(0, np.int64)
    at = np.flatnonzero(hashes[: len(hashes) - k + 1] == phrase[0])
    for i in range(1, k):
        at = at[hashes[at + i] == phrase[i]]
    return at[w.row[at] == w.row[at + k - 1]]


class Index:
    """Anchors of the templates, by word: bounded by the templates, whatever the table."""

    def __init__(self, templates: tuple[Template, ...], weight: dict[int, float], anchors: int):
        self.templates = templates
        words = _hashed([t.text for t in templates])
        self.keys, self.weight, self.total = [], [], np.zeros(len(templates))
        postings = []  # word, template, position, number of the anchor
        for t, (template, found) in enumerate(zip(templates, words, strict=True)):
            kinds = sorted(set(found.tolist()), key=lambda h: (-weight.get(h, 1.0), int(np.argmax(found == np.uint64(h)))))
            for h in kinds[: min(anchors, max(2, (len(kinds) + 1) // 2))]:
                number = len(self.weight)
                self.weight.append(weight.get(h, 1.0))
                self.total[t] += self.weight[-1]
                postings += [(h, t, int(p), number) for p in np.flatnonzero(found == np.uint64(h))]
            keys = []
            for key in _hashed(list(template.keys)):
                starts = [p for p in range(len(found) - len(key) + 1) if (found[p : p + len(key)] == key).all()]
                if not starts:
                    raise ValueError(f"a key phrase of {template.label} is no part of its text")
                keys.append((key, starts))
            self.keys.append(keys)
        postings.sort()
        self.word = np.array([p[0] for p in postings], np.uint64)
        self.template, self.position, self.anchor = (np.array([p[k] for p in postings], np.int64) for k in (1, 2, 3))
        self.weight = np.array(self.weight)
        self.length = [len(x) for x in words]

    def matches(self, w: Words, hashes: np.ndarray, slack: int, least: float) -> Iterator[tuple[int, str, int, int, float]]:
        """(row, label, first word, word behind the last, share) of confirmed alignments."""
        low, high = np.searchsorted(self.word, hashes, "left"), np.searchsorted(self.word, hashes, "right")
        place = np.flatnonzero(high > low)
        many = (high - low)[place]
        if not len(place):
            return
        posting = np.repeat(low[place] - np.cumsum(many) + many, many) + np.arange(many.sum())
        place = np.repeat(place, many)
        row, template, anchor, lag = w.row[place], self.template[posting], self.anchor[posting], place - self.position[posting]
        stands: dict[tuple[int, int], np.ndarray] = {}
        found = []
        for shift in (0, slack):  # two grids of cells: alignments up to slack apart share a cell of one of them
            cell = (lag + shift + max(self.length)) // (2 * slack)
            order = np.lexsort((lag, cell, template, row))
            new = np.ones(len(order), bool)
            key = np.stack([row, template, cell])[:, order]
            new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            group = np.cumsum(new) - 1
            once = np.unique(np.stack([group, anchor[order]]), axis=1)  # an anchor counts once per alignment
            first = np.flatnonzero(new)
            share = np.bincount(once[0], self.weight[once[1]]) / self.total[template[order[first]]]
            last = np.append(first[1:], len(order)) - 1
            for g in np.flatnonzero(share >= least - 1e-9):
                a, b = order[first[g]], order[last[g]]
                r, t, low_lag, high_lag = int(row[a]), int(template[a]), int(lag[a]), int(lag[b])
                begin, end = int(w.first[r]), int(w.first[r + 1])
                for k, (key_words, starts) in enumerate(self.keys[t]):
                    if (t, k) not in stands:
                        stands[t, k] = _standing(w, hashes, key_words)
                    at = stands[t, k]
                    at = at[np.searchsorted(at, begin) : np.searchsorted(at, end)]
                    if not any(np.searchsorted(at, high_lag + slack + p, "right") > np.searchsorted(at, low_lag - slack + p) for p in starts):
                        break
                else:
                    cell_rows = order[first[g] : last[g] + 1]
                    votes = np.bincount(lag[cell_rows] - low_lag, self.weight[anchor[cell_rows]])
                    start = low_lag + int(votes.argmax())  # where most of the weight stands
                    found.append((r, t, -float(share[g]), max(start, begin) - begin, min(start + self.length[t], end) - begin))
        taken: dict[tuple[int, int], list] = {}
        for r, t, share, begin, end in sorted(found):  # both grids may find the same place
            if all(end <= x or begin >= y for x, y in taken.setdefault((r, t), [])):
                taken[r, t].append((begin, end))
                yield r, self.templates[t].label, begin, end, min(1.0, -share)


def _document_counts(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, n): texts that hold each word of the sorted vocabulary; word 0 counts all texts."""
    counts, texts = np.zeros(len(vocabulary), np.int64), 0
    for batch in batches:
        for _, _, w in slices(batch.column("text"), folded=True, apart=False):
            hashes = w.hashes()
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[at] == hashes)
            pairs = np.unique(w.row[hit] * len(vocabulary) + at[hit])
            counts += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            texts += w.rows
    words = np.append(vocabulary, np.uint64(0)).view(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.append(counts, texts))], ["word", "n"])


def weights(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[int, float]:
    """Inverse document frequency of every template word, by its hash; counted over all rows."""
    vocabulary = np.unique(np.concatenate(_hashed([t.text for t in templates])))
    counted = docs.select(docs[text].alias("text")).mapInArrow(lambda b: _document_counts(b, vocabulary), "word bigint, n bigint")
    found = Counter({r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()})  # one row per template word
    texts = found[0]
    return {int(h): float(np.log((texts + 2) / (found[int(np.uint64(h).view(np.int64))] + 1))) for h in vocabulary}


def _scan(batches: Iterator[pa.RecordBatch], index: Index, phrases: dict[str, str], slack: int, least: float) -> Iterator[pa.RecordBatch]:
    names = list(zip(_hashed(list(phrases)), phrases.values(), strict=True))
    place_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    match_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))
    for batch in batches:
        for at, stop, w in slices(batch.column("text"), folded=True, apart=False):
            hashes = w.hashes()
            places: list[list] = [[] for _ in range(w.rows)]
            matches: list[list] = [[] for _ in range(w.rows)]
            for phrase, label in names:
                for p in _standing(w, hashes, phrase):
                    r = w.row[p]
                    places[r].append((int(p - w.first[r]), label, int(p - w.first[r]) + len(phrase)))
            for r, label, begin, end, share in index.matches(w, hashes, slack, least):
                matches[r].append((begin, label, end, share))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(at, stop - at),
                    pa.array(w.counts, pa.int64()),
                    pa.array([[{"label": x[1], "start": x[0], "end": x[2]} for x in sorted(p)] for p in places], place_type),
                    pa.array([[{"label": x[1], "start": x[0], "end": x[2], "share": x[3]} for x in sorted(m)] for m in matches], match_type),
                ],
                ["id", "n_words", "places", "matches"],
            )


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    anchors: int = 8,
    slack: int = 4,
    least: float = 0.7,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, n_words, places, matches) for every row of docs.

    ``places`` are structs (label, start, end) of the names found word for word, ``matches`` structs
    (label, start, end, share) of confirmed templates; start and end count words, end is exclusive.
    """
    index = Index(templates, weights(docs, templates, text), anchors)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, places array<struct<label: string, start: bigint, end: bigint>>, matches array<struct<label: string, start: bigint, end: bigint, share: double>>"
    chosen = docs.select(docs[id_column].alias("id"), docs[text].alias("text"))
    return chosen.mapInArrow(lambda batches: _scan(batches, index, phrases, slack, least), schema).withColumnRenamed("id", id_column)

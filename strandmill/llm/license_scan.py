"""License scans by template markup compiled into token automata.

A template is words with two kinds of markup: ``[[ ... ]]`` is an optional region (may nest) and
``<<n-m>>`` stands for n to m arbitrary words (names, years). A text is accepted where all
mandatory words stand in the template's order with nothing else between them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, Words, text_slices, word_hash

#: Fixed phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: label -> (anchor word that every match holds, templates)
TEMPLATES = {
    "mit": ("license", ["[[released]] [[licensed]] [[distributed]] under the [[terms of the]] mit license", "the mit license [[mit]] [[copyright [[c]] <<1-8>>]] permission is hereby granted"]),
    "mit-text": (
        "hereby",
        [
            "permission is hereby granted free of charge to any person obtaining a copy of this software [[and associated documentation files [[the software]]"
            " [[to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
            " and to permit persons to whom the software is furnished to do so subject to the following conditions"
            " [[the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
            " [[the software is provided as is without warranty of any kind express or implied]]]]]]]]"
        ],
    ),
    "isc-text": ("permission", ["permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted [[provided that the above copyright notice and this permission notice appear in all copies]]"]),
    "zlib-text": ("liable", ["this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"]),
    "apache-2": ("apache", ["[[licensed under]] [[the]] apache license [[version]] 2 [[0]]"]),
    "gpl-2": ("gnu", ["[[this work is]] licensed under the gnu general public license [[gpl]] version 2 [[or [[at your option]] any later version]]"]),
    "gpl-3": ("gnu", ["[[this work is]] licensed under the gnu general public license [[gpl]] version 3 [[or [[at your option]] any later version]]"]),
    "lgpl": ("gnu", ["licensed under the gnu lesser general public license", "licensed under the gnu library general public license"]),
    "agpl-3": ("affero", ["licensed under the gnu affero general public license [[version 3]]"]),
    "mpl-2": ("mozilla", ["mozilla public license [[version]] [[v]] 2 [[0]]"]),
    "bsd": ("bsd", ["licensed under [[the]] [[a]] [[2 clause]] [[3 clause]] bsd [[style]] license"]),
    "bsd-text": ("redistributions", ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"]),
    "bsd-3-text": ("endorse", ["neither the name of <<1-12>> nor the names of [[its]] [[<<1-3>>]] contributors may be used to endorse or promote products derived from this software without specific prior written permission"]),
    "gpl-text": ("gnu", ["this <<1-2>> is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]] general public license as published by the free software foundation [[either version <<1-1>> [[1]] of the license or at your option any later version]]"]),
    "unlicense": ("unencumbered", ["this is free and unencumbered software released into the public domain"]),
    "epl": ("eclipse", ["eclipse public license [[version]] [[v]] <<1-1>> 0"]),
    "boost": ("boost", ["boost software license [[version 1 0]]"]),
    "cc-by": ("cc", ["licensed under [[a]] [[creative commons]] cc by <<1-1>> 0"]),
    "cc-by-sa": ("cc", ["licensed under cc by sa [[<<1-1>> 0]]"]),
    "cc-by-nc": ("cc", ["[[licensed under]] cc by nc [[4 0]]"]),
    "all-rights-reserved": ("reserved", ["[[copyright [[c]] [[<<1-6>>]]]] all rights reserved"]),
}

_MARK = re.compile(r"\[\[|\]\]|<<\d+-\d+>>|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class TokenAutomaton:
    """A non-deterministic automaton over words; ``None`` on an edge is any word."""

    def __init__(self, template: str):
        self.edges: list[list[tuple[str | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.need = 0
        open_at: list[int] = []
        for t in _MARK.findall(template):
            if t == "[[":
                open_at.append(self._last())
            elif t == "]]":
                self._skip(open_at.pop(), self._last())
            elif t.startswith("<<"):
                low, high = map(int, t[2:-2].split("-"))
                for k in range(high):
                    at = self._word(None)
                    if k >= low:
                        self._skip(at, at + 1)
            else:
                self._word(t)
        assert not open_at, "an optional region is not closed"
        self.end = self._last()
        self.first = {w for s in self._closed({0}) for w, _ in self.edges[s]}

    def _last(self) -> int:
        return len(self.edges) - 1

    def _word(self, word: str | None) -> int:
        at = self._last()
        self.edges.append([])
        self.skips.append([])
        self.edges[at].append((word, at + 1))
        return at

    def _skip(self, a: int, b: int) -> None:
        if a != b:
            self.skips[a].append(b)

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for b in self.skips[todo.pop()]:
                if b not in states:
                    states.add(b)
                    todo.append(b)
        return states

    def match(self, words: list[str], at: int) -> int | None:
        """The end of the longest match that starts at word ``at``."""
        states, found = self._closed({0}), None
        for i in range(at, len(words) + 1):
            if self.end in states:
                found = i
            if i == len(words):
                break
            states = self._closed({b for s in states for w, b in self.edges[s] if w is None or w == words[i]})
            if not states:
                break
        return found


def compiled(templates: dict) -> list[tuple[str, str, TokenAutomaton]]:
    return [(label, anchor, TokenAutomaton(t)) for label, (anchor, texts) in templates.items() for t in texts]


def scan_words(words: list[str], automata) -> list[tuple[str, int, int]]:
    """Leftmost-longest, non-overlapping matches of each automaton: (label, start, end) in words."""
    found, there = [], set(words)
    for label, anchor, automaton in automata:
        if anchor not in there:
            continue
        free = 0
        for i, w in enumerate(words):
            if i >= free and (w in automaton.first or None in automaton.first) and (end := automaton.match(words, i)):
                found.append((label, i, end))
                free = end
    return found


SCHEMA = "id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,start:long,end:long>>"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict | None = None, phrases: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: n_words, base phrase places, labels, score (share of words that
    matches cover) and the matches themselves as word spans.

    Null and empty texts have no words, no labels and score 0. Repeated rows give repeated results,
    rows without an id keep theirs, an empty table gives no row. Other columns are not read. Nothing
    is shuffled; a task holds one slice of text at a time.
    """
    automata = compiled(TEMPLATES if templates is None else templates)
    base = {tuple(_MARK.findall(p)): label for p, label in (BASE_PHRASES if phrases is None else phrases).items()}
    kind = docs.schema[id_col].dataType.simpleString()
    anchors = np.unique(np.array([word_hash(a) for _, a, _ in automata], np.uint64))
    hashes = {p: [np.uint64(word_hash(w)) for w in p] for p in base}

    def scan(batches):
        out_type = None
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch):
                data = LOWER[data]
                w = Words(data, offs, ALNUM)
                places: dict[int, list[tuple[int, str, int]]] = {}
                for p, hs in hashes.items():
                    if len(w.hash) < len(hs):
                        continue
                    n = len(w.hash) - len(hs) + 1
                    at = np.flatnonzero(w.hash[:n] == hs[0])
                    for k, h in enumerate(hs[1:], 1):
                        at = at[w.hash[at + k] == h]
                    at = at[w.doc[at] == w.doc[at + len(hs) - 1]]
                    for i in at.tolist():
                        d = int(w.doc[i])
                        places.setdefault(d, []).append((i - int(w.first[d]), base[p], len(p)))
                marked = set(w.doc[np.isin(w.hash, anchors)].tolist())
                raw = data.tobytes()
                rows = []
                for d in range(hi - lo):
                    n = int(w.first[d + 1] - w.first[d])
                    mine = places.get(d, [])
                    spans = []
                    if d in marked:
                        a, b = int(w.first[d]), int(w.first[d + 1])
                        words = [raw[s:e].decode() for s, e in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist())]
                        spans = scan_words(words, automata)
                    covered = len({i for _, s, e in spans for i in range(s, e)} | {i + k for i, _, size in mine for k in range(size)})
                    own = {label for _, label, _ in mine}
                    starts = [i for i, _, _ in mine]
                    rows.append((n, len(mine), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(own | {x[0] for x in spans})), min(1.0, covered / n) if n else 0.0, [{"label": x, "start": s, "end": e} for x, s, e in spans]))
                cols = list(zip(*rows))
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))]
                names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo)] + [pa.array(c, t) for c, t in zip(cols, types)], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, SCHEMA.format(id=kind)).withColumnRenamed("id", id_col)

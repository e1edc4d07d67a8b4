"""License scans by template markup compiled to token automata.

A template is text in the markup of license lists: ``<<beginOptional>> ...
<<endOptional>>`` may be left out, and ``<<var;name=...;match=...>>`` stands for
any words (``match=".{M,N}"`` bounds them to M to N characters from the first
word's start to the last one's end, and to one run of words without white space
between, such as 4.0, for every MEAN_WORD characters of N; ``.+`` asks for one
word at least; other regions have no bound).  It compiles to an automaton over words; a text is accepted where the
mandatory words stand exactly, one after another, whatever stands between
words.  A phrase is a template without markup, and is found the same way.

Every template has an anchor, its longest run of consecutive mandatory words
(at most ANCHOR_WORDS).  A byte pattern of the anchors finds the texts that can
hold a match at all; only those are cut into words.  All places of a text are
found, and overlapping ones count each.

Defined results: a null or empty text has no words and no labels; the words of
a place are those from its first to its last; repeated rows each get their
result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_ALNUM, encoded, groups_of, word_spans, word_table

#: The phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Public license texts and notices in template markup, with their labels.
TEMPLATES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.",
    ),
    ("mit", "<<beginOptional>>This <<var;name=what;match=.{0,30}>> is<<endOptional>> <<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\"); you may not use this file except in compliance with the License.<<endOptional>>"),
    ("gpl-3", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>> version 3 <<beginOptional>>or any later version<<endOptional>>"),
    ("gpl-3", "GNU General Public License <<var;name=publisher;match=.{0,60}>> either version 3 of the License, or (at your option) any later version"),
    ("gpl-2", "GNU General Public License <<var;name=publisher;match=.{0,60}>> either version 2 of the License, or (at your option) any later version"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl-3", "GNU Affero General Public License <<beginOptional>>version 3<<endOptional>>"),
    ("cc-by-nc", "<<beginOptional>>licensed under<<endOptional>> <<beginOptional>>a Creative Commons<<endOptional>> CC BY-NC <<beginOptional>>4.0<<endOptional>> <<beginOptional>>International License<<endOptional>>"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial <<var;name=version;match=.{0,12}>> <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-sa", "<<beginOptional>>licensed under<<endOptional>> CC BY-SA <<beginOptional>>4.0<<endOptional>>"),
    ("cc-by", "Creative Commons Attribution <<var;name=version;match=.{0,6}>> <<beginOptional>>International<<endOptional>> License"),
    ("cc0-1", "CC0 1.0 Universal"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike <<var;name=version;match=.{0,12}>> <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives <<var;name=version;match=.{0,12}>> <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike <<var;name=version;match=.{0,12}>> <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives <<var;name=version;match=.{0,12}>> <<beginOptional>>International<<endOptional>> License"),
    (
        "apache-2",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("gpl-3", "GNU General Public License v3 <<beginOptional>>or later<<endOptional>>"),
    ("gpl-2", "GNU General Public License v2 <<beginOptional>>or later<<endOptional>>"),
    ("epl-2", "made available under the terms of the Eclipse Public License <<beginOptional>>v<<endOptional>> 2.0"),
    (
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "<<beginOptional>>1.<<endOptional>> The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    ),
    (
        "bsl-1",
        "Boost Software License - Version 1.0 <<beginOptional>>- <<var;name=date;match=.{0,30}>><<endOptional>>",
    ),
    (
        "bsd",
        "Neither the name of <<var;name=organization;match=.{1,120}>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "<<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    ("isc", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "<<beginOptional>>Copyright <<var;name=holder;match=.{0,60}>><<endOptional>> All rights reserved"),
)

ANCHOR_WORDS = 4
MEAN_WORD = 6
BATCH_BYTES = 1 << 20

#: A word of a lower-cased text, and what stands between two.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(WORD)
_SPACE = re.compile(rb"\s")
_IS_WORD = word_table(NOT_ALNUM)
_MARKUP = re.compile(r"<<\s*(beginOptional|endOptional|var)\b(.*?)>>", re.S | re.I)
_BOUND = re.compile(r"match\s*=\s*\"?\.(?:\{(\d*),(\d+)\}|([*+]))", re.I)


@dataclass
class Automaton:
    """words[i] is the word of state i, or the least and most characters of a region; after[i] the states that may follow; begin those that may start."""

    label: str
    words: list[bytes | tuple[int, int | None]]
    after: list[set[int]]
    begin: set[int]
    final: set[int]
    anchor: list[bytes] = field(default_factory=list)

    def places(self, text: list[bytes], spans: list[tuple[int, int]], joined: list[bool]) -> list[tuple[int, int]]:
        """First and last word of the longest match from every word at which one begins.

        spans are the words' characters; joined[i]: no white space stands before word i.
        """
        starts = {self.words[i] for i in self.begin}
        found = []
        for at, word in enumerate(text):
            if word not in starts:
                continue
            live = {i: {(0, 0)} for i in self.begin if self.words[i] == word}  # of a region: where it may have begun, and its runs of words
            end, here = (at if self._done(live, 0) else -1), at
            while live and here + 1 < len(text):
                reached = spans[here][1]
                here += 1
                live = self._step(live, reached, text[here], *spans[here], not joined[here])
                if self._done(live, spans[here][1]):
                    end = here
            if end >= 0:
                found.append((at, end))
        return found

    def _left(self, i: int, begun: set[tuple[int, int]], reached: int) -> bool:
        """Whether what follows state i may come, if its words reach so far."""
        return isinstance(self.words[i], bytes) or any(reached - b >= self.words[i][0] for b, _ in begun)

    def _done(self, live: dict[int, set[tuple[int, int]]], reached: int) -> bool:
        return any(i in self.final and self._left(i, begun, reached) for i, begun in live.items())

    def _step(self, live: dict[int, set[tuple[int, int]]], reached: int, word: bytes, start: int, stop: int, apart: bool) -> dict[int, set[tuple[int, int]]]:
        out: dict[int, set[tuple[int, int]]] = {}
        for i, begun in live.items():
            own = self.words[i]
            if not isinstance(own, bytes):  # the region goes on
                if own[1] is None:
                    more = {min(begun)}
                else:
                    more = {(b, runs + apart) for b, runs in begun if stop - b <= own[1] and runs + apart <= -(-own[1] // MEAN_WORD)}
                if more:
                    out.setdefault(i, set()).update(more)
            if self._left(i, begun, reached):
                for j in self.after[i]:
                    following = self.words[j]
                    if isinstance(following, bytes):
                        if following == word:
                            out[j] = {(0, 0)}
                    elif following[1] is None or stop - start <= following[1]:
                        out.setdefault(j, set()).add((start, 1))
        return out


def _tree(template: str) -> list:
    """Words, bounds of replaceable regions (the upper one None: without) and nested lists of optional parts, in order."""
    stack: list[list] = [[]]

    def add(text: str) -> None:
        stack[-1].extend(_WORD.findall(encoded([text])[0]))

    at = 0
    for m in _MARKUP.finditer(template):
        add(template[at : m.start()])
        at = m.end()
        kind = m[1].lower()
        if kind == "beginoptional":
            stack.append([])
        elif kind == "endoptional":
            if len(stack) < 2:
                raise ValueError("endOptional without beginOptional")
            part = stack.pop()
            stack[-1].append(part)
        else:
            bound = _BOUND.search(m[2])
            least = int(bound[1] or 0) if bound and bound[2] else int(bool(bound and bound[3] == "+"))
            stack[-1].append((least, int(bound[2]) if bound and bound[2] else None))
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    add(template[at:])
    return stack[0]


def compiled(label: str, template: str) -> Automaton:
    """The automaton of a template; a template needs at least one mandatory word."""
    out = Automaton(label, [], [], set(), set())

    def state(word: bytes | tuple[int, int | None]) -> int:
        out.words.append(word)
        out.after.append(set())
        return len(out.words) - 1

    def chain(items: list, ends: set[int], open_: bool) -> tuple[set[int], bool]:
        """Adds items after the states in ends; open_: nothing need stand before. Returns the new ends and openness."""
        for x in items:
            if isinstance(x, list):
                inner, inner_open = chain(x, set(ends), open_)
                ends, open_ = ends | inner, open_ or inner_open
            elif isinstance(x, tuple):
                new = state(x)
                link(ends, open_, new)
                ends, open_ = ({new}, False) if x[0] else (ends | {new}, open_)
            else:
                new = state(x)
                link(ends, open_, new)
                ends, open_ = {new}, False
        return ends, open_

    def link(ends: set[int], open_: bool, new: int) -> None:
        for i in ends:
            out.after[i].add(new)
        if open_ and isinstance(out.words[new], bytes):
            out.begin.add(new)

    items = _tree(template)
    out.final, empty = chain(items, set(), True)
    runs, run = [], []
    for x in [*items, None]:
        if isinstance(x, bytes):
            run.append(x)
        else:
            runs.append(run)
            run = []
    best = max(runs, key=lambda r: sum(map(len, r[:ANCHOR_WORDS])))
    if empty or not best:
        raise ValueError(f"a template needs mandatory words: {label}")
    out.anchor = best[:ANCHOR_WORDS]
    return out


class Scanner:
    """All phrases and templates of a scan."""

    def __init__(self, phrases, templates) -> None:
        self.base = [compiled(label, text) for text, label in phrases]
        self.more = [compiled(label, text) for label, text in templates]
        self.tests = {}
        for a in self.base + self.more:
            self.tests[tuple(a.anchor)] = re.compile(rb"(?<![0-9a-z\x80-\xff])" + GAP.join(map(re.escape, a.anchor)) + rb"(?![0-9a-z\x80-\xff])")

    def scan(self, text: bytes) -> tuple | None:
        """n_base, first_word, last_word, base labels, all labels, score; None if no anchor occurs."""
        held = {k for k, r in self.tests.items() if all(w in text for w in k) and r.search(text)}
        if not held:
            return None
        found = list(_WORD.finditer(text))
        words = [m[0] for m in found]
        joined = [False, *(not _SPACE.search(text, a.end(), b.start()) for a, b in zip(found, found[1:]))]
        spans = [m.span() for m in found]
        if not text.isascii():  # bytes to characters
            at = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
            spans = [(int(at[a]), int(at[b])) for a, b in spans]
        base = [(a.label, p) for a in self.base if tuple(a.anchor) in held for p in a.places(words, spans, joined)]
        more = [(a.label, p) for a in self.more if tuple(a.anchor) in held for p in a.places(words, spans, joined)]
        covered, reach = 0, -1
        for first, last in sorted(p for _, p in base + more):
            covered += max(0, last - max(first - 1, reach))
            reach = max(reach, last)
        starts = [p[0] for _, p in base]
        labels = sorted({x for x, _ in base + more})
        score = 0.5 + 0.5 * min(1.0, covered / len(words)) if labels else 0.0
        return len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for x, _ in base})), ",".join(labels), score


@lru_cache(4)
def scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(phrases, templates)


NONE = (0, None, None, "", "", 0.0)


def scan(docs: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of docs.

    score is 0 without a label, else 0.5 and half of the share of words that stand in matches.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = scanner(phrases, templates)
        for batch in batches:
            for a, b in groups_of(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), BATCH_BYTES):
                part = batch.slice(a, b - a)
                texts = encoded(part.column(1).to_pylist())
                n = _word_counts(texts)
                rows = [machine.scan(t) or NONE for t in texts]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(read, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _word_counts(texts: list[bytes]) -> np.ndarray:
    """Words of each text, over one array of all of them, or for long texts in pieces."""
    if sum(map(len, texts)) > 4 * BATCH_BYTES:
        return np.array([sum(1 for _ in _WORD.finditer(t)) for t in texts], np.int64)
    data = np.frombuffer(b" ".join(texts), np.uint8)
    starts, _ = word_spans(data, _IS_WORD)
    limits = np.cumsum([len(t) + 1 for t in texts])
    return np.diff(np.searchsorted(starts, limits), prepend=0).astype(np.int64)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))

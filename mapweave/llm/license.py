"""License scans with template markup compiled to token automata.

A template is a line of words with two kinds of regions: ``[...]`` is optional,
``<n>`` is replaceable by up to ``n`` words (none at all included) and may stand in an optional
region too. The rest is mandatory wording and must stand there exactly, word for word, so a
license text with a changed condition matches no more. A template is
compiled into states, one per word or replaceable region; reading a text keeps the
set of states alive, so every way to skip or fill a region is followed at once.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.
The anchor of a template is the longest of its first ``ANCHOR_WORDS`` mandatory words (of
equal ones the first). A template counts, for its label and for the score, only in texts that hold its anchor; texts without any
anchor are settled by one native expression, and only the others reach Python, whole.
``score`` is the largest share of a template's mandatory words that can be read in order from
some place on, 1 where a template or base phrase stands.

Defined cases: NULL and word-free texts have no words, no places and score 0;
places may overlap and all count; repeated rows get equal results; an empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import NON_ALNUM_RUN, UPPER, sql_words, with_package

# fixed values: the base phrases and their labels
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# fixed values: public license texts, with regions for what their users fill in
MIT_TEXT = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
files the software to deal in the software without restriction including without limitation the rights to use copy modify
merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished
to do so subject to the following conditions the above copyright notice and this permission notice
[including the next paragraph] shall be included in all copies or substantial portions of the software
the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall <12> be liable for any claim damages or
other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or
the use or other dealings in the software
"""
ISC_TEXT = """
permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted provided
that the above copyright notice and this permission notice appear in all copies the software is provided as is and <12>
disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no
event shall <12> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from
loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in
connection with the use or performance of this software
"""
BSD_TERMS = """
redistribution and use in source and binary forms with or without modification are permitted provided that the following
conditions are met [1] redistributions of source code must retain the above copyright notice this list of conditions and the
following disclaimer [2] redistributions in binary form must reproduce the above copyright notice this list of conditions and
the following disclaimer in the documentation and or other materials provided with the distribution
"""
BSD_NAMES = """
[3] neither the name of <20> nor the names of <8> contributors may be used to endorse or promote products derived from this
software without specific prior written permission
"""
BSD_DISCLAIMER = """
this software is provided by <20> as is and any express or implied warranties including but not limited to the implied
warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <20> be liable for any
direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute
goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether
in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even
if advised of the possibility of such damage
"""

# label, template
TEMPLATES = (
    ("mit", "under the mit [open source] license"),
    ("mit-text", MIT_TEXT),
    ("apache-2", "licensed under the apache [software] license [version] <1> 2 [0]"),
    ("bsd-2", f"{BSD_TERMS} {BSD_DISCLAIMER}"),
    ("bsd-3", f"{BSD_TERMS} {BSD_NAMES} {BSD_DISCLAIMER}"),
    ("isc", ISC_TEXT),
    ("gpl", "licensed under the gnu [lesser] general public license [as published by the free software foundation] [either] version <1>"),
    ("cc-by", "licensed under [a] [the] creative commons attribution [noncommercial] [sharealike] <2> [international] license"),
    ("cc-by-nc", "licensed under [a] [the] cc by nc [sa] <2>"),
    ("copyright", "copyright [c] <12> all rights reserved"),
    ("spdx", "spdx license identifier <1>"),
)

ANCHOR_WORDS = 8


@dataclass(frozen=True)
class State:
    word: str | None  # None: a replaceable region
    fill: int  # words a replaceable region may take
    skip_to: int | None  # state after the optional region that begins here
    mandatory: bool


@dataclass(frozen=True)
class Automaton:
    label: str
    states: tuple[State, ...]
    mandatory: int
    anchor: str

    def starts(self) -> set[str]:
        """Words with which the template can begin; a filled region before them needs no word of its own."""
        return {self.states[k].word for k, _ in self.closure({(0, 0): 0}) if k < len(self.states)} - {None}

    def closure(self, alive: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
        """States reachable without reading a word; the value is the number of mandatory words read."""
        todo = list(alive.items())
        while todo:
            (at, used), done = todo.pop()
            if at >= len(self.states):
                continue
            s = self.states[at]
            onward = [at + 1] if s.word is None else []
            if s.skip_to is not None:
                onward.append(s.skip_to)
            for n in onward:
                if alive.get((n, 0), -1) < done:
                    alive[(n, 0)] = done
                    todo.append(((n, 0), done))
        return alive

    def match(self, words: list[str], start: int) -> tuple[bool, float]:
        """Whether the template stands at ``start``, and the best share of its mandatory words read in order."""
        alive = self.closure({(0, 0): 0})
        best, at = 0, start
        while True:
            best = max(best, max(alive.values()))
            if any(k[0] == len(self.states) for k in alive):
                return True, 1.0
            if at >= len(words):
                break
            nxt: dict[tuple[int, int], int] = {}
            for (state, used), done in alive.items():
                s = self.states[state]
                if s.word is None:
                    if used < s.fill and nxt.get((state, used + 1), -1) < done:
                        nxt[(state, used + 1)] = done
                elif s.word == words[at]:
                    gained = done + s.mandatory
                    if nxt.get((state + 1, 0), -1) < gained:
                        nxt[(state + 1, 0)] = gained
            if not nxt:
                break
            alive = self.closure(nxt)
            at += 1
        return False, best / self.mandatory


def anchor_of(mandatory: list[str]) -> str:
    return max(mandatory[:ANCHOR_WORDS], key=len)


_MARKUP = re.compile(r"\[([^\[\]]+)\]|<(\d+)>|([^\s\[\]<>]+)|(\S)")


def compile_template(label: str, text: str) -> Automaton:
    """States of one template line. Optional regions do not nest.

    Broken markup, words that no text can hold and templates without mandatory words raise ``ValueError``.
    """
    states: list[State] = []

    def add(part: str, mandatory: bool) -> None:
        for optional, fill, word, wrong in _MARKUP.findall(part):
            if wrong or (optional and not mandatory) or (word and split_words(word) != [word]):
                raise ValueError(f"template {label!r}: cannot read {wrong or optional or word!r}")
            if optional:
                begin = len(states)
                add(optional, False)
                states[begin] = replace(states[begin], skip_to=len(states))
            else:
                states.append(State(word or None, int(fill or 0), None, mandatory and bool(word)))

    add(text, True)
    words = [s.word for s in states if s.mandatory]
    if not words:
        raise ValueError(f"template {label!r} has no mandatory words")
    return Automaton(label, tuple(states), len(words), anchor_of(words))


_SPLIT = re.compile(NON_ALNUM_RUN)
_LOWER = str.maketrans(UPPER, UPPER.lower())


def split_words(text: str) -> list[str]:
    return [w for w in _SPLIT.split(text.translate(_LOWER)) if w]


def scan_words(words: list[str], automata: list[Automaton], base=BASE) -> dict:
    """Base places, labels and score of one text."""
    at: dict[str, list[int]] = {}
    present = set(words)
    automata = [a for a in automata if a.anchor in present]
    starts = [a.starts() for a in automata]
    firsts = set().union(*starts, (p.split()[0] for p, _ in base))
    for k, w in enumerate(words):
        if w in firsts:
            at.setdefault(w, []).append(k)
    places, base_labels = [], set()
    for phrase, label in base:
        want = phrase.split()
        found = [k for k in at.get(want[0], ()) if words[k : k + len(want)] == want]
        places += found
        if found:
            base_labels.add(label)
    labels, score = set(base_labels), 1.0 if base_labels else 0.0
    for a, begins in zip(automata, starts, strict=True):
        for k in sorted(k for w in begins for k in at.get(w, ())):
            ok, share = a.match(words, k)
            score = max(score, share)
            if ok:
                labels.add(a.label)
                break
    return {
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": score,
    }


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ]
)


def _scan(batches: Iterable[pa.RecordBatch], templates) -> Iterator[pa.RecordBatch]:
    automata = [compile_template(*t) for t in templates]
    for batch in batches:
        rows = []
        for doc, n, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_words", "text")), strict=True):
            rows.append({"doc_id": doc, "n_words": n, **scan_words(split_words(text) if text is not None else [], automata)})
        yield pa.RecordBatch.from_pylist(rows, schema=_OUT)


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Digest columns per row of ``docs``. Bad templates raise ``ValueError`` before any row is read."""
    with_package(docs)
    anchors = sorted({compile_template(*t).anchor for t in templates} | {anchor_of(p.split()) for p, _ in BASE})
    # A-Z count as word characters here, so texts split alike before lower-casing
    letters = NON_ALNUM_RUN.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    edge = letters.rstrip("+").replace("\\", "\\\\")
    anchored = f"text RLIKE '(?i)(^|{edge})({'|'.join(anchors)})({edge}|$)'"
    ready = docs.selectExpr(
        "doc_id",
        f"CAST(size({sql_words("coalesce(text, '')", letters)}) AS bigint) AS n_words",
        f"CASE WHEN {anchored} THEN text END AS text",
    )
    return ready.mapInArrow(
        lambda b: _scan(b, templates),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )

"""License scans by template-markup matching.

A template is wording with markup: ``<<opt>> ... <</opt>>`` may be left out, ``<<var:n>>`` stands for up to
``n`` words of any kind. :func:`compile_template` turns it into a token automaton, whose states are places in the
wording; a text is accepted where every mandatory word matches exactly, in order. The scan
runs the automaton from each place where a first word stands, over whole texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_table, tidy

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MARKUP = re.compile(r"<<(/?opt|var:\d+)>>")

# Phrases whose places are counted, and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# License notices and texts in template markup (public wording), and their labels. Owners' names are
# replaceable, numbers of clauses may be left out, all other wording is mandatory up to the text's end.
_WARRANTY = ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
             "of merchantability fitness for a particular purpose and noninfringement in no event shall <<var:8>> be liable for any claim "
             "damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
             "software or the use or other dealings in the software")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met")
_BSD_CLAUSES = (" <<opt>>1<</opt>><<opt>>a<</opt>> redistributions of source code must retain the above copyright notice this list of "
                "conditions and the following disclaimer <<opt>>2<</opt>><<opt>>b<</opt>> redistributions in binary form must reproduce the "
                "above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
                "provided with the distribution ")
_BSD_NAMES = ("<<opt>>3<</opt>><<opt>>c<</opt>> neither the name of <<var:12>> nor the names of <<opt>>its<</opt>><<opt>>the<</opt>> "
              "contributors may be used to endorse or promote products derived from this software without specific prior written permission ")
_BSD_WARRANTY = ("this software is provided by <<var:12>> as is and any express or implied warranties including but not limited to the implied "
                 "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var:12>> be liable "
                 "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement "
                 "of substitute goods or services loss of use data or profits or business interruption however caused and on any theory "
                 "of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of "
                 "the use of this software even if advised of the possibility of such damage")
_MIT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
_ISC = ("permission to use copy modify and <<opt>>or<</opt>> distribute this software for any purpose with or without fee is hereby granted")
_UNLICENSE = "this is free and unencumbered software released into the public domain"
_APACHE = "licensed under the apache license version 2.0 the license you may not use this <<var:4>> except in compliance with the license"


def _gnu_header(name: str, version: str) -> str:
    return (f"this <<var:4>> is free software you can redistribute it and or modify it under the terms of the gnu {name} public license as "
            f"published by the free software foundation either version {version} of the license or at your option any later version "
            f"this <<var:4>> is distributed in the hope that it will be useful but without any warranty without even the implied warranty "
            f"of merchantability or fitness for a particular purpose see the gnu {name} public license for more details")


#: Labels that end so are only the first wording of a license: what follows was not read, or reads otherwise.
OPENING = "-opening"
TEMPLATES = [
    ("mit-notice", "<<opt>>this <<opt>>work<</opt>><<opt>>software<</opt>> is<</opt>> <<opt>>released<</opt>><<opt>>licensed<</opt>>"
                   "<<opt>>distributed<</opt>> under the <<opt>>terms of the<</opt>> mit license"),
    ("mit-opening", _MIT + "<<var:3>> to deal in <<var:3>> without restriction"),
    ("mit-text", _MIT + "software to deal in the software without restriction including without limitation the rights to use copy modify merge "
                 "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
                 "furnished to do so subject to the following conditions the above copyright notice and this permission notice "
                 "<<opt>>including the next paragraph<</opt>> shall be included in all copies or substantial portions of the software "
                 + _WARRANTY),
    ("apache-2.0-notice", "licensed under the apache license version 2.0 <<opt>>the license<</opt>>"),
    ("apache-2.0-opening", _APACHE),
    ("apache-2.0-header", _APACHE + " you may obtain a copy of the license at <<opt>>http<</opt>><<opt>>https<</opt>> www apache org licenses "
                          "license 2.0 <<opt>>txt<</opt>><<opt>>html<</opt>> unless required by applicable law or agreed to in writing software "
                          "distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
                          "either express or implied see the license for the specific language governing permissions and limitations "
                          "under the license"),
    ("gpl-3.0-notice", "<<opt>>this <<var:3>> is<</opt>> licensed under the <<opt>>terms of the<</opt>> gnu general public license version 3"),
    ("gpl-opening", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                    "<<opt>>lesser<</opt>> <<opt>>affero<</opt>> general public license as published by the free software foundation"),
    ("gpl-2.0-header", _gnu_header("general", "2")), ("gpl-3.0-header", _gnu_header("general", "3")),
    ("lgpl-2.1-header", _gnu_header("lesser general", "2.1")), ("lgpl-3.0-header", _gnu_header("lesser general", "3")),
    ("agpl-3.0-header", _gnu_header("affero general", "3")),
    ("cc-by-nc-4.0-notice", "<<opt>>this <<var:3>> is<</opt>> licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> cc by nc 4.0 <<opt>>license<</opt>>"),
    ("cc-by-4.0-notice", "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> creative commons attribution 4.0 international <<opt>>public<</opt>> license"),
    ("bsd-opening", _BSD),
    ("bsd-2-text", _BSD + _BSD_CLAUSES + _BSD_WARRANTY),
    ("bsd-3-text", _BSD + _BSD_CLAUSES + _BSD_NAMES + _BSD_WARRANTY),
    ("isc-opening", _ISC),
    ("isc-text", _ISC + " provided that the above copyright notice and this permission notice appear in all copies the software is provided as "
                 "is and <<var:8>> disclaims all warranties with regard to this software including all implied warranties of "
                 "merchantability and fitness in no event shall <<var:8>> be liable for any special direct indirect or consequential "
                 "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
                 "negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("unlicense-opening", _UNLICENSE),
    ("unlicense-text", _UNLICENSE + " anyone is free to copy modify publish use compile sell or distribute this software either in source code "
                       "form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that "
                       "recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the "
                       "software to the public domain we make this dedication for the benefit of the public at large and to the "
                       "detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in "
                       "perpetuity of all present and future rights to this software under copyright law " + _WARRANTY),
]


def words_of(text: str) -> list[str]:
    """A text's words: A-Z lower-cased, runs of a-z, 0-9 and anything beyond ASCII."""
    return WORD.findall(text.translate(LOWER) if not text.isascii() else text.lower())


@dataclass
class Automaton:
    """States are numbered; ``words[s]`` leads from s to its next state over that word, ``free[s]`` over any
    word, ``skips[s]`` without a word. The last state accepts."""
    label: str
    words: dict[int, tuple[str, int]] = field(default_factory=dict)
    free: dict[int, int] = field(default_factory=dict)
    skips: dict[int, list[int]] = field(default_factory=dict)
    last: int = 0
    starts: frozenset = frozenset()
    needed: tuple = ()

    def closure(self, states) -> set:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.skips.get(todo.pop(), ()):
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def match(self, words: list[str], at: int) -> int:
        """The end of the longest accepted run of words that begins at ``at``, or -1."""
        states, end = self.closure([0]), -1
        for i in range(at, len(words)):
            step = set()
            for s in states:
                known = self.words.get(s)
                if known is not None and known[0] == words[i]:
                    step.add(known[1])
                if s in self.free:
                    step.add(self.free[s])
            if not step:
                break
            states = self.closure(step)
            if self.last in states:
                end = i + 1
        return end


def compile_template(label: str, markup: str) -> Automaton:
    """Compile wording with optional and replaceable regions. Mandatory words must be at hand for a match;
    a template of optional or replaceable parts only is refused."""
    a, state, opened, depth_needed = Automaton(label), 0, [], []
    for i, part in enumerate(MARKUP.split(markup)):
        if i % 2 == 0:
            for word in words_of(part):
                a.words[state] = (word, state + 1)
                if not opened:
                    depth_needed.append(word)
                state += 1
        elif part == "opt":
            opened.append(state)
        elif part == "/opt":
            if not opened:
                raise ValueError(f"{label}: no region to close")
            start = opened.pop()
            # a fresh state, so that what follows the region cannot re-enter it
            a.skips.setdefault(state, []).append(state + 1)
            state += 1
            a.skips.setdefault(start, []).append(state)
        else:
            for _ in range(int(part[4:])):
                a.free[state] = state + 1
                a.skips.setdefault(state, []).append(state + 1)
                state += 1
    if opened:
        raise ValueError(f"{label}: a region is not closed")
    if not depth_needed:
        raise ValueError(f"{label}: no mandatory wording")
    a.last, a.needed = state, tuple(sorted(set(depth_needed), key=lambda w: (-len(w), w)))
    first = a.closure([0])
    if first & a.free.keys():
        raise ValueError(f"{label}: a template begins with a word of its own")
    a.starts = frozenset(a.words[s][0] for s in first if s in a.words)
    return a


def phrase_places(words: list[str], phrases=PHRASES) -> list[tuple[int, str]]:
    """``(start, label)`` of every place where a phrase's words stand in a row, overlapping ones too."""
    split = [(p.split(), label) for p, label in phrases]
    last = {p[-1] for p, _ in split}
    found = []
    for i, word in enumerate(words):
        if word in last:
            for p, label in split:
                start = i - len(p) + 1
                if start >= 0 and words[start:i + 1] == p:
                    found.append((start, label))
    return found


def scan(text: str, automata: list[Automaton], phrases=PHRASES) -> tuple:
    """``(n_words, n_base, first_word, last_word, base_labels, labels, score, spans)`` of one whole text.

    ``score`` is 1 where a template's whole wording is accepted, 0.75 where only a license's opening is, 0.5 where only a
    phrase is found, else 0; ``spans`` lists ``label:first word-end`` of accepted templates. An opening within an accepted
    whole text is not reported.
    """
    words = words_of(text)
    known = set(words)
    base = phrase_places(words, phrases) if any(p.split()[-1] in known for p, _ in phrases) else []
    spans = []
    for a in automata:
        if known.issuperset(a.needed):
            at = 0
            while at < len(words):
                end = a.match(words, at) if words[at] in a.starts else -1
                if end > 0:
                    spans.append((at, end, a.label))
                at = max(at + 1, end)
    whole = [x for x in spans if not x[2].endswith(OPENING)]
    spans = [x for x in spans if x in whole or not any(s <= x[0] and x[1] <= e for s, e, _ in whole)]
    starts = [s for s, _ in base]
    own, added = sorted({x for _, x in base}), {x for _, _, x in spans}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(own),
            ",".join(sorted({*own, *added})), 1.0 if whole else 0.75 if spans else 0.5 if base else 0.0,
            " ".join(f"{x}:{s}-{e}" for s, e, x in sorted(spans)))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans string")


def scan_licenses(df: DataFrame, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its phrases' places and the accepted templates (``spans``).

    A null text counts as empty: no words, no labels (empty strings), null places, score 0. Repeated rows are
    reported each, null ids stay null, an empty table gives an empty result, other columns are ignored.
    """
    automata = [compile_template(*t) for t in templates]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.string()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def compute(batches):
        for batch in batches:
            if batch.num_rows:
                found = zip(*(scan(t, automata, phrases) for t in batch.column(1).to_pylist()), strict=True)
                yield pa.record_batch([batch.column(0), *[pa.array(c, k) for c, k in zip(found, kinds[1:], strict=True)]], names=names)

    return id_table(df, id_col, text_col).mapInArrow(tidy(compute), SCHEMA)

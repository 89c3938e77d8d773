"""License scans: template markup compiled to token automata.

A template is license wording with two kinds of markup, as the public license
template format has them: ``<<beginOptional>> ... <<endOptional>>`` around words
that may be left out, and ``<<var;name="..";original="..";match="..">>`` for a
region that may be replaced (``match``: ``.+`` one word or more, ``.*`` any
number, ``.{a,b}`` from a to b words). It compiles to an automaton over words. A
text is accepted where the automaton runs through: the mandatory words, all of
them, in order and next to each other but for those regions.

Whole texts are scanned in one narrow pass. Each template has a necessary pair of
neighbouring mandatory words; hashes of word pairs find the texts that could
match, and only in those the automaton runs, from every word it can begin with.
Plain phrases (the base) are found by their hashes and compared word by word.

Defined results: null and empty texts have no words, no labels and score 0; null
or repeated ids and repeated rows give a result each; other columns are ignored.
Score: 1 if a template is accepted, else 0.5 with a base phrase, else 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.tables import table
from auric.llm.text import ALNUM, Lookup, runs, shingles, words

# Phrases of the base and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_BULLET = '<<var;name="bullet";original="1";match=".{0,1}">> '
_BSD_FIRST = ("Redistribution and use in source and binary forms, with or without modification, "
              "are permitted provided that the following conditions are met")
_BSD_CLAUSES = (
    f": {_BULLET}Redistributions of source code must retain the above copyright notice, this "
    f"list of conditions and the following disclaimer. {_BULLET}Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = (
    _BULLET + 'Neither the name of <<var;name="holder";original="the copyright holder";'
    'match=".{1,20}">> nor the names of its contributors may be used to endorse or promote '
    "products derived from this software without specific prior written permission. ")
_BSD_DISCLAIMER = (
    'This software is provided by <<var;name="holders";original="the copyright holders and '
    'contributors";match=".{1,20}">> "as is" and any express or implied warranties, including, '
    "but not limited to, the implied warranties of merchantability and fitness for a particular "
    'purpose are disclaimed. In no event shall <<var;name="liable";original="the copyright holder '
    'or contributors";match=".{1,20}">> be liable for any direct, indirect, incidental, special, '
    "exemplary, or consequential damages (including, but not limited to, procurement of "
    "substitute goods or services; loss of use, data, or profits; or business interruption) "
    "however caused and on any theory of liability, whether in contract, strict liability, or "
    "tort (including negligence or otherwise) arising in any way out of the use of this "
    "software, even if advised of the possibility of such damage.")
_ISC_FIRST = (
    "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this "
    "software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies")
_MIT_FIRST = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    '<<var;name="software";original="this software and associated documentation files";'
    'match=".{1,12}">> (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software")

# License texts, and notices that name a license, as templates (label, template).
TEMPLATES = [
    ("apache-2.0",
     "Apache License<<beginOptional>>, <<endOptional>> Version 2.0"),
    ("apache-2.0-notice",
     'Licensed under the Apache License, Version 2.0 (the "License"); you may not use '
     '<<var;name="subject";original="this file";match=".{1,6}">> except in compliance with '
     "the License."),
    ("gpl-2.0",
     "GNU General Public License<<beginOptional>> as published by the Free Software "
     "Foundation<<endOptional>><<beginOptional>>; either<<endOptional>> version 2"),
    ("gpl-3.0",
     "GNU General Public License<<beginOptional>> as published by the Free Software "
     "Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 3"),
    ("gpl-notice",
     '<<var;name="subject";original="This program";match=".{1,8}">> is free software'
     "<<beginOptional>>: you can redistribute it and/or modify it<<endOptional>> under the "
     "terms of the GNU General Public License"),
    ("mit-notice",
     "<<beginOptional>>is <<endOptional>>released under the MIT License"),
    ("mit", _MIT_FIRST),                           # the grant alone
    ("mit-text",
     _MIT_FIRST + ", and to permit persons to whom the Software is furnished to do so, subject "
     "to the following conditions: The above copyright notice and this permission notice"
     "<<beginOptional>> (including the next paragraph)<<endOptional>> shall be included in all "
     'copies or substantial portions of the Software. The Software is provided "as is", without '
     "warranty of any kind, express or implied, including but not limited to the warranties of "
     "merchantability, fitness for a particular purpose and noninfringement. In no event shall "
     '<<var;name="liable";original="the authors or copyright holders";match=".{1,20}">> be liable '
     "for any claim, damages or other liability, whether in an action of contract, tort or "
     "otherwise, arising from, out of or in connection with the Software or the use or other "
     "dealings in the Software."),
    ("isc-notice", _ISC_FIRST),
    ("isc",
     _ISC_FIRST + '. The software is provided "as is" and <<var;name="author";original="the '
     'author";match=".{1,20}">> disclaims all warranties with regard to this software including '
     "all implied warranties of merchantability and fitness. In no event shall "
     '<<var;name="liable";original="the author";match=".{1,20}">> be liable for any special, '
     "direct, indirect, or consequential damages or any damages whatsoever resulting from loss of "
     "use, data or profits, whether in an action of contract, negligence or other tortious "
     "action, arising out of or in connection with the use or performance of this software."),
    ("bsd-notice", _BSD_FIRST),                    # shared by the texts of the family
    ("bsd-2-clause", _BSD_FIRST + _BSD_CLAUSES + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD_FIRST + _BSD_CLAUSES + _BSD_NAMES + _BSD_DISCLAIMER),
    ("lgpl-notice", "GNU Lesser General Public License"),
    ("agpl-notice", "GNU Affero General Public License"),
    ("mpl-2.0-notice",
     'Mozilla Public License, <<var;name="v";original="v.";match=".{0,1}">> 2.0'),
    ("cc0-1.0-notice", "CC0 1.0"),
    ("cc-by-3.0",
     "<<beginOptional>>Creative Commons <<endOptional>>CC BY 3.0"),
    ("cc-by-4.0",
     "<<beginOptional>>Creative Commons <<endOptional>>CC BY 4.0"),
    ("cc-by-sa-4.0",
     "<<beginOptional>>Creative Commons <<endOptional>>CC BY<<beginOptional>>-<<endOptional>> "
     "SA 4.0"),
    *[(f"cc-{kind}-{version}".lower(),
       f"<<beginOptional>>Creative Commons <<endOptional>>CC {kind} {version}")
      for kind in ("BY-NC", "BY-NC-SA", "BY-NC-ND", "BY-ND") for version in ("3.0", "4.0")],
]

_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_MATCH = re.compile(r'match="\.(\+|\*|\{(\d+),(\d+)\})"')
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ANY = None


def split_words(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass
class Automaton:
    """States 0 .. ``accept``; ``step[s]`` maps a word (or _ANY) to next states,
    closed over the free moves."""

    label: str
    step: list[dict]
    accept: int
    starts: frozenset          # states before the first word
    anchor: tuple[str, ...]    # neighbouring mandatory words of every match

    def accepts_at(self, ws: list[str], begin: int) -> bool:
        now = self.starts
        for k in range(begin, len(ws)):
            if self.accept in now:
                return True
            now = self._next(now, ws[k])
            if not now:
                return False
        return self.accept in now

    def _next(self, now, word):
        out = set()
        for s in now:
            out |= self.step[s].get(word, frozenset()) | self.step[s].get(_ANY, frozenset())
        return frozenset(out)

    def accepts(self, ws: list[str]) -> bool:
        """One run over the words with a new start at each of them."""
        now = frozenset()
        for word in ws:
            now = self._next(now | self.starts, word)
            if self.accept in now:
                return True
        return False


def compile_template(label: str, template: str) -> Automaton:
    moves: list[list[tuple]] = [[]]           # state -> [(word | _ANY | "", target)]
    free: list[set[int]] = [set()]

    def new() -> int:
        moves.append([])
        free.append(set())
        return len(moves) - 1

    at, opened, mandatory, stretch = 0, [], [], []

    def close_stretch():
        mandatory.append(tuple(stretch))
        stretch.clear()

    pieces = _MARK.split(template)
    for k, piece in enumerate(pieces):
        if k % 2 == 0:
            for w in split_words(piece):
                nxt = new()
                moves[at].append((w, nxt))
                at = nxt
                if not opened:
                    stretch.append(w)
            continue
        close_stretch()
        if piece == "beginOptional":
            opened.append(at)
        elif piece == "endOptional":
            free[opened.pop()].add(at)
        else:
            m = _MATCH.search(piece)
            least, most = ((int(m[2]), int(m[3])) if m[2] else
                           (1 if m[1] == "+" else 0, None))
            for _ in range(least):
                nxt = new()
                moves[at].append((_ANY, nxt))
                at = nxt
            if most is None:
                moves[at].append((_ANY, at))
                nxt = new()                   # leave the loop
                free[at].add(nxt)
                at = nxt
            else:
                skip = [at]
                for _ in range(most - least):
                    nxt = new()
                    moves[at].append((_ANY, nxt))
                    at = nxt
                    skip.append(at)
                for s in skip[:-1]:
                    free[s].add(at)
    close_stretch()
    if opened:
        raise ValueError(f"template {label}: optional region without an end")

    def closure(s: int) -> set[int]:
        seen, todo = set(), [s]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += free[x]
        return seen

    step = []
    for s in range(len(moves)):
        by: dict = {}
        for w, target in moves[s]:
            by.setdefault(w, set()).update(closure(target))
        step.append({w: frozenset(x) for w, x in by.items()})
    longest = max(mandatory, key=len)
    if not longest:
        raise ValueError(f"template {label}: no mandatory words")
    return Automaton(label, step, at, frozenset(closure(0)), longest[:2])


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.phrases = [(tuple(split_words(p)), label) for p, label in phrases.items()]
        self.automata = [compile_template(*t) for t in templates]
        wanted: dict[int, dict[int, list]] = {}   # words -> hash -> entries
        for words_, entry in ([(p, ("base", k)) for k, (p, _) in enumerate(self.phrases)]
                              + [(a.anchor, ("auto", k)) for k, a in enumerate(self.automata)]):
            h = self._hash(words_)
            wanted.setdefault(len(words_), {}).setdefault(h, []).append((entry, words_))
        self.lookups = {n: (Lookup(np.array(list(by), np.uint64)), by)
                        for n, by in wanted.items()}

    @staticmethod
    def _hash(ws: tuple[str, ...]) -> int:
        data = np.frombuffer(" ".join(ws).encode(), np.uint8)
        return int(shingles(words(data, np.array([0, len(data)]), ALNUM), len(ws))[0][0])

    def scan(self, data: np.ndarray, off: np.ndarray):
        """Per row: words, (place, phrase) of base phrases, labels of automata."""
        w = words(data, off, ALNUM)
        rows = w.row
        base = [[] for _ in range(len(off) - 1)]
        maybe = [set() for _ in range(len(off) - 1)]
        for n, (lookup, by) in self.lookups.items():
            h, at = shingles(w, n)
            pos, key = lookup.find(h)
            for i, k in zip(at[pos].tolist(), key.tolist()):
                here = w.joined(i, i + n).decode()
                for (kind, which), ws in by[int(lookup.keys[k])]:
                    if " ".join(ws) == here:
                        r = int(rows[i])
                        if kind == "base":
                            base[r].append((i - int(w.first[r]), which))
                        else:
                            maybe[r].add(which)
        own = [set() for _ in range(len(off) - 1)]
        for r, which in enumerate(maybe):
            if which:
                ws = w.joined(int(w.first[r]), int(w.first[r + 1])).decode().split(" ")
                own[r] = {self.automata[k].label for k in which
                          if self.automata[k].accepts(ws)}
        return w.counts, base, own


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 phrases: dict[str, str] | None = None,
                 templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels,
    template_labels, labels, score."""
    scanner = Scanner(PHRASES if phrases is None else phrases,
                      TEMPLATES if templates is None else templates)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels",
             "template_labels", "labels", "score"]

    def run(batches):
        for b in batches:
            for lo, hi, data, off in runs(b.column(1)):
                n_words, base, own = scanner.scan(data, off)
                found = [{scanner.phrases[k][1] for _, k in x} for x in base]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo),
                    pa.array(n_words, pa.int64()),
                    pa.array([len(x) for x in base], pa.int64()),
                    pa.array([min(x)[0] if x else None for x in base], pa.int64()),
                    pa.array([max(x)[0] if x else None for x in base], pa.int64()),
                    pa.array([",".join(sorted(x)) for x in found]),
                    pa.array([",".join(sorted(x)) for x in own]),
                    pa.array([",".join(sorted(x | y)) for x, y in zip(found, own)]),
                    pa.array([1.0 if y else 0.5 if x else 0.0 for x, y in zip(found, own)]),
                ], names)

    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
            .mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, "
                             "last_word bigint, base_labels string, template_labels string, "
                             "labels string, score double"))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLE: dict[str, str] = {}

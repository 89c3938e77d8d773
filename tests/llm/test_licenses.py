import random
import re

import pytest

from auric.llm import licenses as m
from tests.llm.conftest import SF, edge_texts, multiset, plain_words, table


def base(t):
    w = plain_words(t)
    places = [(k, label) for p, label in m.PHRASES.items() for k in range(len(w))
              if w[k:k + len(p.split())] == p.split()]
    return (len(w), len(places), min(places)[0] if places else None,
            max(places)[0] if places else None, ",".join(sorted({x for _, x in places})))


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_base_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = m.op4_license_scan(spark, SF).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    automata = [m.compile_template(*t) for t in m.TEMPLATES]
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == base(texts[r.doc_id])
        own = {a.label for a in automata if a.accepts(plain_words(texts[r.doc_id]))}
        assert r.template_labels == ",".join(sorted(own))
        assert set(filter(None, r.labels.split(","))) == own | set(filter(
            None, r.base_labels.split(",")))
        assert r.score == (1.0 if own else 0.5 if r.n_base else 0.0)


@pytest.mark.parametrize("template, text, accepted", [
    ("a b c", "x a b c y", True),
    ("a b c", "a b x c", False),
    ("a<<beginOptional>> b<<endOptional>> c d", "a c d", True),
    ("a<<beginOptional>> b<<endOptional>> c d", "a b c d", True),
    ("a<<beginOptional>> b<<endOptional>> c d", "a b b c d", False),
    ("a<<beginOptional>> b<<beginOptional>> e<<endOptional>><<endOptional>> c d", "a b c d", True),
    ("a<<beginOptional>> b<<beginOptional>> e<<endOptional>><<endOptional>> c d", "a e c d", False),
    ('by <<var;name="n";original="X";match=".+">> all rights', "by some long name all rights", True),
    ('by <<var;name="n";original="X";match=".+">> all rights', "by all rights", False),
    ('by <<var;name="n";original="X";match=".*">> all rights', "by all rights", True),
    ('by <<var;name="n";original="X";match=".{1,2}">> all rights', "by a b all rights", True),
    ('by <<var;name="n";original="X";match=".{1,2}">> all rights', "by a b c all rights", False),
    ('<<var;name="n";original="X";match=".{1,2}">> is free', "it is free", True),
    ("a b a c", "a b a b a c", True),
])
def test_template_markup(template, text, accepted):
    a = m.compile_template("t", template)
    assert a.accepts(plain_words(text)) is accepted
    ws = plain_words(text)
    assert any(a.accepts_at(ws, k) for k in range(len(ws))) is accepted


def test_markup_errors():
    with pytest.raises(ValueError):
        m.compile_template("t", "a <<beginOptional>> b")
    with pytest.raises(ValueError):
        m.compile_template("t", "<<beginOptional>> b <<endOptional>>")


def test_edges(edge_docs, no_docs):
    rows = m.license_scan(edge_docs).collect()
    assert multiset((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows) == multiset(
        (i, *base(t)) for i, t in edge_texts())
    assert m.license_scan(no_docs).collect() == []


def test_long_text_and_whole_notice(spark):
    text = ("word " * 50_000 + "Permission is hereby granted, free of charge, to any person "
            "obtaining a copy of this font software and its docs (the \"Software\"), to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software")
    r, = m.license_scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()
    assert r.labels == "mit" and r.score == 1.0 and r.n_base == 0


CLAUSES = ["Redistribution and use in source and binary forms, with or without modification, are "
           "permitted provided that the following conditions are met:",
           "1. Redistributions of source code must retain the above copyright notice, this list "
           "of conditions and the following disclaimer.",
           "2. Redistributions in binary form must reproduce the above copyright notice, this "
           "list of conditions and the following disclaimer in the documentation and/or other "
           "materials provided with the distribution."]
ADVERT = ("3. All advertising materials mentioning features or use of this software must display "
          "the following acknowledgement: This product includes software developed by X.")
NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used "
         "to endorse or promote products derived from this software without specific prior written "
         "permission.")
DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
       "without fee is hereby granted, provided that the above copyright notice and this permission "
       "notice appear in all copies.")


@pytest.mark.parametrize("text, labels", [
    (" ".join([*CLAUSES, DISCLAIMER]), "bsd-2-clause,bsd-notice"),
    (" ".join([*CLAUSES, NAMES, DISCLAIMER]), "bsd-3-clause,bsd-notice"),
    (" ".join([*CLAUSES, ADVERT, NAMES.replace("3", "4"), DISCLAIMER]), "bsd-notice"),
    (CLAUSES[0], "bsd-notice"),
    (" ".join([*CLAUSES, DISCLAIMER.replace("STRICT LIABILITY", "X")]), "bsd-notice"),
    (ISC, "isc-notice"),
    (ISC + " Selling it is forbidden.", "isc-notice"),
    ("under CC BY-NC 4.0 or CC BY-NC-SA 4.0", "cc-by-nc-4.0,cc-by-nc-sa-4.0"),
    ("the GNU Lesser General Public License", "lgpl-notice"),
    ("Mozilla Public License, v. 2.0", "mpl-2.0-notice"),
])
def test_labels_of_whole_texts(text, labels):
    own = {a.label for a in (m.compile_template(*t) for t in m.TEMPLATES)
           if a.accepts(plain_words(text))}
    assert ",".join(sorted(own)) == labels


@pytest.mark.parametrize("label", ["mit-text", "isc", "bsd-2-clause", "bsd-3-clause"])
def test_every_mandatory_word_counts(label):
    """The original wording is accepted, and no longer when one of its last words changes."""
    template = dict(m.TEMPLATES)[label]
    text = re.sub('<<var;[^>]*?original="([^"]*)"[^>]*>>', r"\1", template)
    ws = plain_words(re.sub("<<(begin|end)Optional>>", "", text))
    a = m.compile_template(label, template)
    assert a.accepts(ws) and not a.accepts(ws[:-1]) and not a.accepts([*ws[:-9], "x", *ws[-8:]])


def as_pattern(template):
    """The template as an ordinary pattern over words that each end in a space."""
    out = []
    for k, piece in enumerate(m._MARK.split(template)):
        if k % 2 == 0:
            out += [re.escape(w) + " " for w in plain_words(piece)]
        elif piece == "beginOptional":
            out.append("(?:")
        elif piece == "endOptional":
            out.append(")?")
        else:
            match = re.search(r'match="\.(\+|\*|\{\d+,\d+\})"', piece)
            out.append(r"(?:\S+ )" + match[1])
    return re.compile("(?<= )" + "".join(out))


def test_automata_against_patterns(spark):
    """Every template over every given document, and over license texts with words left
    out, put in and changed."""
    rng = random.Random(6)
    patterns = [(label, as_pattern(t)) for label, t in m.TEMPLATES]
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").collect()]
    for k, (_, t) in enumerate(m.TEMPLATES):
        ws = plain_words(re.sub(r'<<var;[^>]*original="([^"]*)"[^>]*>>', r"\1", t)
                         .replace("<<beginOptional>>", " ").replace("<<endOptional>>", " "))
        for n in range(8):
            some = list(ws)
            for _ in range(n // 2):
                i = rng.randrange(len(some))
                some[i:i + 1] = rng.choice(([], ["other"], [some[i], "extra"], [some[i].upper()]))
            docs.append((10_000 + 10 * k + n, "before " * (n % 2) + " ".join(some) + " after" * n))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r.template_labels for r in m.license_scan(frame).collect()}
    hits = 0
    for i, t in docs:
        line = " " + "".join(w + " " for w in plain_words(t))
        want = sorted({label for label, p in patterns if p.search(line)})
        hits += bool(want)
        assert got[i] == ",".join(want)
    assert hits > 100

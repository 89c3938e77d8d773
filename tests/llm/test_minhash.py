import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from auric.llm import minhash as m
from auric.llm import text as t
from tests.llm.conftest import DOCS, SF, doc, edge_texts, multiset, plain_words, table


def weighted(text, size=5):
    w = plain_words(text)
    if len(w) < size:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[k:k + size]) for k in range(len(w) - size + 1))


def brute_classes(docs):
    """Partition of row numbers by links of weighted similarity 0.8 or more."""
    sets = [weighted(x) for _, x in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        near = {j for k in s for j in where[k]} if s else set(where[None])
        for j in near:
            both = sum((s & sets[j]).values())
            if not s or both >= 0.8 * sum((s | sets[j]).values()) - 1e-9:
                up[find(i)] = find(j)
        for k in s or [None]:
            where[k].append(i)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(i)
    return list(groups.values())


def expected(docs):
    out = Counter()
    for g in brute_classes(docs):
        ids = [docs[i][0] for i in g if docs[i][0] is not None]
        out.update((docs[i][0], min(ids, default=None), len(g)) for i in g)
    return out


def test_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    want = expected(docs)
    assert any(n > 1 for _, _, n in want)
    assert multiset(m.op10_dartminhash(spark, SF).collect()) == want


def test_edges(edge_docs, no_docs):
    assert multiset(m.near_duplicates(edge_docs).collect()) == expected(edge_texts())
    assert m.near_duplicates(no_docs).collect() == []


def chain(n, size=200, step=12):
    """Texts in which neighbours are alike and ends are not."""
    words = [f"c{k}" for k in range(size + n * step)]
    return [" ".join(words[k * step:k * step + size]) for k in range(n)]


def test_chains_hot_groups_and_unlike_texts(spark):
    rng = np.random.default_rng(2)
    docs = list(enumerate(chain(12)))
    first = [f"h{k}" for k in range(300)]
    for _ in range(150):                             # near copies of one text
        w = list(first)
        for k in rng.choice(300, 3, replace=False):
            w[k] = f"x{rng.integers(1 << 30)}"
        docs.append((len(docs), " ".join(w)))
    docs += [(len(docs) + k, " ".join(first)) for k in range(100)]
    for _ in range(40):                              # half of it only
        docs.append((len(docs), " ".join(first[:150] + [f"y{rng.integers(1 << 30)}"
                                                        for _ in range(150)])))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert multiset(m.near_duplicates(frame).collect()) == expected(docs)


def test_one_of_each_keeps_whole_rows(spark, edge_docs, no_docs):
    kept = m.one_of_each(edge_docs)
    rows = kept.collect()
    assert kept.columns == edge_docs.columns
    assert len(rows) == len(brute_classes(edge_texts()))
    every = multiset(doc(i, x) for i, x in edge_texts())
    assert all(every[tuple(r)] for r in rows)
    groups = brute_classes(edge_texts())
    texts = [{edge_texts()[i][1] for i in g} for g in groups]
    assert all(sum(r.text in g for r in rows) == 1 for g in texts)
    assert m.one_of_each(no_docs).collect() == []


def cells_of(*texts):
    (_, _, data, off), = t.runs(pa.array(texts, pa.string()))
    return m.weighted_cells(t.words(data, off), 5)


def test_cells_are_the_weighted_set():
    texts = ["a b c d e a b c d e a b c d e f", "a b c d e", "", "a b", "a b c d e a b c d e"]
    cell, row = cells_of(*texts)
    sets = [set(cell[row == k].tolist()) for k in range(len(texts))]
    for a in range(len(texts)):
        x = weighted(texts[a])
        assert len(sets[a]) == sum(x.values())
        for b in range(len(texts)):
            assert len(sets[a] & sets[b]) == sum((x & weighted(texts[b])).values())


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_agreement_is_the_similarity(share):
    n, k, trials = 400, 160, 40
    rng = np.random.default_rng(7)
    same = round(2 * n * share / (1 + share))
    hits = 0
    for _ in range(trials):
        x = rng.integers(1, 1 << 62, 2 * n - same).astype(np.uint64)
        cell = np.concatenate([x[:n], x[n - same:]])
        row = np.repeat([0, 1], [n, len(x) - n + same])
        sig = m.signatures(cell, row, 2, k)
        hits += (sig[0] == sig[1]).sum()
    true = same / (2 * n - same)
    assert abs(hits / (k * trials) - true) < 5 * math.sqrt(true * (1 - true) / (k * trials))


def test_signature_does_not_depend_on_neighbours_or_range():
    cell, row = cells_of("a b c d e f g", "x y z", "a b c d e f g " * 40)
    every = m.signatures(cell, row, 3, 160)
    assert (every != 0).all()
    for k in range(3):
        alone = m.signatures(cell[row == k], np.zeros((row == k).sum(), np.int64), 1, 160)
        assert (alone[0] == every[k]).all()
    far = m._darts(cell[row == 0], row[row == 0], np.array([4000.0]), 160, 1)
    assert (far[0] == every[0]).all()


def test_unlike_words_of_equal_hash_are_two_nodes(spark):
    """4096 words by the Thue-Morse sequence and their complement."""
    a, b = (" ".join(("one", "two")[bin(k).count("1") % 2 ^ flip] for k in range(4096))
            for flip in (0, 1))
    docs = spark.createDataFrame([doc(1, a), doc(2, b), doc(3, a.upper()), doc(4, b + "!")], DOCS)
    nd = m.NearDuplicates(docs, "doc_id", "text")
    nodes = {r._id: bytes(r.node) for r in nd.rows.collect()}
    assert nodes[1] == nodes[3] != nodes[2] == nodes[4]


def test_slim_edges_connect_the_same_nodes(spark):
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a in range(60) for b in rng.choice(100, rng.integers(0, 4))
             if a != b]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    slim = m.NearDuplicates._slim(frame)
    assert multiset(m.components(slim).collect()) == multiset(m.components(frame).collect())


def test_components(spark):
    edges = [(k, k - 1) for k in range(1, 30)] + [(100, 200), (200, 300), (400, 300), (7, 500)]
    got = m.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.n: r.c for r in got} == {**{k: 0 for k in range(30)}, 500: 0,
                                       100: 100, 200: 100, 300: 100, 400: 100}


def test_schema_of_extra_columns(spark):
    assert m.one_of_each(spark.createDataFrame([doc(1, "a"), doc(1, "a")], DOCS)).count() == 1


def test_no_join_goes_through_the_driver(spark, edge_docs, monkeypatch):
    """Bands, cells and pairs are taken for small by Spark, however many there are."""
    plans = []

    def planned(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return df

    written = m.materialize
    monkeypatch.setattr(m, "materialize", lambda df, name: written(planned(df, name), name))
    planned(m.near_duplicates(edge_docs), "rows of classes")
    planned(m.one_of_each(edge_docs), "one of each")
    joins = [(name, re.findall(r"\w+Join\b", plan)) for name, plan in plans]
    assert {"ranked", "buckets", "cells", "links", "labels", "members", "labelled"} <= {
        name for name, found in joins if found}
    assert all(found[:1] in ([], ["SortMergeJoin"]) for name, found in joins if name != "own")
    assert all(set(found) <= {"SortMergeJoin"} for name, found in joins
               if name not in ("own", "more"))       # these have a row for each cluster

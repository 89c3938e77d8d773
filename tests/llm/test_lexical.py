import math
from collections import Counter

import numpy as np
import pyarrow as pa

from auric.llm import lexical
from auric.llm.text import ALNUM, runs, words
from tests.llm.conftest import DOCS, doc, edge_texts, plain_words, table


def brute(docs, items, k=10):
    bags = [(i, Counter(plain_words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        want = Counter(plain_words(text))
        scores = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n // length
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in want.items() if b[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s)
                for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()),
                  key=str)


def check(spark, docs, items, **options):
    bench = spark.createDataFrame(items, "item_id string, text string")
    frame = spark.createDataFrame([doc(i, t) for i, t in docs], DOCS).repartition(3)
    assert rows(lexical.ranked(frame, bench, **options)) == brute(
        docs, items, options.get("k", 10))


ITEMS = [("a", "w1 und3 W2 w2 spam"), ("b", "MIT License, one more word"), ("c", "é 漢字 w7"),
         ("d", None), ("e", "..."), ("f", "no such term zzzz"), ("a", "w1 und3 W2 w2 spam"),
         ("a", "another text of a: und1"), (None, "w5 und5")]


def test_edges(spark):
    check(spark, edge_texts(), ITEMS)


def test_classes_ties_and_copies(spark):
    """Many members of a class, equal scores in different classes, repeated rows."""
    docs = [(1000 - k, "und3 w1 filler") for k in range(40)]
    docs += [(k, f"und3 w1 other{k}") for k in range(500, 530)]      # equal vector and m
    docs += [(7, "und3 w1 filler")] * 3 + [(None, "und3 w1 filler"), (8, "und3 und3 w1 a b c")]
    docs += [(k, f"x{k} und{k % 4}") for k in range(2000, 2050)]
    check(spark, docs, ITEMS)
    check(spark, docs, ITEMS, k=3)


def test_blocks_of_any_size_agree(spark):
    check(spark, edge_texts(), ITEMS, block_items=1, block_terms=2)


def test_given_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    items = [(str(r["item_id"]), r["text"]) for r in table(spark, "benchmark").collect()]
    check(spark, docs, items)


def test_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    none = spark.createDataFrame([], DOCS)
    assert rows(lexical.ranked(none, bench)) == []
    some = spark.createDataFrame([doc(1, "w1"), doc(2, None)], DOCS)
    assert rows(lexical.ranked(some, bench.limit(0))) == []
    assert lexical.ranked(none, bench).columns == ["item_id", "rank", "doc_id", "score"]


def thue_morse(n):
    bits = np.array([bin(i).count("1") & 1 for i in range(n)])
    return bytes(np.where(bits, 98, 97).astype(np.uint8)), bytes(np.where(bits, 97, 98).astype(np.uint8))


def test_words_of_equal_hash_are_told_apart():
    """Two different words whose hashes agree: only the one that is a term is found."""
    a, b = thue_morse(4096)
    text = (a + b"x " + b"x " + b).decode()
    for lo, hi, data, off in runs(pa.array([text, a.decode().upper(), b.decode()])):
        w = words(data, off, ALNUM)
        word, term = lexical.Vocabulary([a]).find(w)
        assert word.tolist() == [3]
        both = lexical.Vocabulary([a, b])
        word, term = both.find(w)
        assert sorted((i, both.terms[t]) for i, t in zip(word.tolist(), term.tolist())) == [
            (2, b), (3, a), (4, b)]


def test_class_is_scored_once(spark):
    """Copies reach the scorer as one row with at most k members."""
    docs = spark.createDataFrame([doc(i, "w1 w2 w2") for i in range(300)] + [doc(999, "w1")], DOCS)
    bench = spark.createDataFrame([("a", "w2 w1")], "item_id string, text string")
    out = lexical.ranked(docs, bench)
    assert [r["doc_id"] for r in out.orderBy("rank").collect()] == list(range(10))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan

import hashlib

from auric.llm import decontam as m
from tests.llm.conftest import doc, DOCS, edge_texts, multiset, plain_words, table


def brute(docs, items, window=10):
    found = {}
    for i, t in items:
        w = plain_words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n else ():
            found.setdefault(tuple(w[k:k + n]), set()).update([] if i is None else [str(i)])
    sizes = {len(k) for k in found}
    for d, t in docs:
        w = plain_words(t)
        hit, names = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in found:
                    hit.update(range(k, k + n))
                    names |= found[tuple(w[k:k + n])]
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        yield d, len(w), len(hit), len(names), sha, bool(hit)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_against_brute_force(spark):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    want = multiset(brute([(r.doc_id, r.text) for r in docs.collect()],
                          [(r.item_id, r.text) for r in items.collect()]))
    assert any(k[-1] for k in want)
    assert multiset(m.contamination(docs, items).select(COLUMNS).collect()) == want
    small = m.contamination(docs, items, block_bytes=60_000)     # several blocks
    assert multiset(small.select(COLUMNS).collect()) == want


ITEMS = [(10, "one"), (9, "w0 und0 w1 und1 w2 und2 w3 und3 w4 und4 w5 und5"), (None, "w8 und1 w9"),
         (8, None), (7, ""), (6, "spam " * 14), (9, "spam spam"), (5, "é ß"), (5, "é ß")]


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = multiset(brute(edge_texts(), ITEMS))
    assert multiset(m.contamination(edge_docs, items).select(COLUMNS).collect()) == want
    blocks = m.contamination(edge_docs, items, block_bytes=400)
    assert multiset(blocks.select(COLUMNS).collect()) == want
    assert m.contamination(no_docs, items).collect() == []
    none = m.contamination(edge_docs, items.limit(0)).collect()
    assert len(none) == len(edge_texts()) and not any(r.contaminated for r in none)


def test_blocks_keep_to_their_size(spark):
    """One item far larger than a block: its windows lie in several, none over the bound."""
    text = " ".join(f"w{k}" for k in range(3000))
    items = spark.createDataFrame([(1, text), (2, "w5 w6 w7"), (None, text)],
                                  "item_id bigint, text string")
    parts = list(m._blocks(items, "item_id", "text", 10, 60_000))
    assert len(parts) > 3
    for w in parts:
        assert sum(len(t) + 80 + sum(len(i) + 8 for i in own)
                   for t, own in zip(w.text, w.items)) <= 60_000
    whole = {(t, tuple(i)) for w in parts for t, i in zip(w.text, w.items)}
    one = m.build_windows([("1", text), ("2", "w5 w6 w7"), (None, text)], 10)
    assert whole == {(t, tuple(i)) for t, i in zip(one.text, one.items)}


def test_clean_rows_keep_all_columns(spark, edge_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = m.without_contaminated(edge_docs, items)
    want = multiset(doc(i, t) for (i, t), r in zip(edge_texts(), brute(edge_texts(), ITEMS))
                    if not r[-1])
    assert kept.columns == edge_docs.columns and multiset(kept.collect()) == want


def test_rarest_shingle_is_the_prefix(spark):
    w = m.build_windows([("1", "a b c d e")], 10)
    h, _, off, _ = w.shingle_table(3)
    counts = {int(x): n for x, n in zip(h.view("int64"), (5, 1, 5))}
    p = m.Prefixes(w, 3, counts)
    lookup, _, _, offsets = p.by_size[3]
    assert offsets.tolist() == [1] and lookup.keys.tolist() == [int(h[1])]


def test_schema_of_an_empty_documents_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert m.without_contaminated(docs, table(spark, "benchmark")).collect() == []

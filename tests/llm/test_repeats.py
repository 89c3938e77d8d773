import hashlib
import random

import numpy as np
import pytest

from auric.llm import repeats
from auric.llm.run_index import END, RunIndex
from tests.llm.conftest import DOCS, doc, edge_texts, table

SHORT = {"length": 12, "seed": 5}


def brute(docs, length=50):
    least = {}
    raws = [(i, (t or "").encode()) for i, t in docs]
    for i, raw in raws:
        for p in range(len(raw) - length + 1 if i is not None else 0):
            w = raw[p:p + length]
            least[w] = min(i, least.get(w, i))
    out = []
    for i, raw in raws:
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1 if i is not None else 0):
            if least[raw[p:p + length]] < i:
                gone[p:p + length] = [True] * length
        spans = sum(g and not h for g, h in zip(gone, [False] + gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"],
                    hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()), key=str)


def check(spark, docs, **options):
    frame = spark.createDataFrame([doc(i, t) for i, t in docs], DOCS).repartition(3)
    assert result(repeats.without_repeats(frame, **options)) == brute(
        docs, options.get("length", 50))


def test_matching_statistics_against_brute_force():
    rng = random.Random(3)
    for letters, many, longest in (("ab", 12, 40), ("abcd", 30, 60), ("a", 6, 30)):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))
                 for _ in range(many)]
        texts += [t[3:] + t[:9] for t in texts]
        data = np.frombuffer(b"".join(t.encode() + bytes([END]) for t in texts), np.uint8)
        index = RunIndex(data, 8)
        raw = data.tobytes()
        order = sorted(range(len(raw)), key=lambda p: raw[p:])
        assert index._order.tolist() == order
        patterns = ["".join(rng.choice(letters + "z") for _ in range(rng.randint(1, 50)))
                    for _ in range(40)] + texts[:5]
        flat = np.frombuffer("".join(patterns).encode(), np.uint8)
        size = np.array([len(p) for p in patterns])
        first = np.cumsum(size) - size
        length, row = index.matching_statistics(flat, first, size)
        for p, f in zip(patterns, first.tolist()):
            for k in range(len(p)):
                want = max(n for n in range(len(p) - k + 1) if p[k:k + n].encode() in raw)
                assert length[f + k] == want
                at = order[row[f + k]]
                assert raw[at:at + want] == p[k:k + want].encode()


def test_runs_follow_what_is_new():
    """Fifty copies with small changes: far fewer runs than letters."""
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = [base[:k * 7] + "#" + base[k * 7:] for k in range(50)]
    data = np.frombuffer(b"".join(t.encode() + bytes([END]) for t in texts), np.uint8)
    assert RunIndex(data, 50).runs < len(data) / 8


def random_docs(seed, many=40):
    rng = random.Random(seed)
    words = ["ab", "ba", "aab", "é", "c d", "xyz\n", "\x00"]
    base = ["".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(many)]
    shared = "".join(rng.choice(words) for _ in range(60))
    docs = []
    for k, t in enumerate(base):
        cut = rng.randrange(len(t) + 1)
        part = shared[rng.randrange(30):][:rng.randint(5, 80)] if rng.random() < .6 else ""
        docs.append((rng.randint(-5, 60), t[:cut] + part + t[cut:]))
        if rng.random() < .3:
            docs.append((rng.choice([docs[-1][0], k + 100, None]), docs[-1][1]))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    check(spark, random_docs(seed), **SHORT)


def test_hot_seeds_and_small_indexes(spark):
    """Every shared seed counts as hot; tiny indexes."""
    docs = random_docs(7)
    check(spark, docs, hot=1, **SHORT)
    check(spark, docs, hot=4, index_bytes=64, **SHORT)


def test_edges(spark):
    docs = edge_texts() + [(20, "p" * 49), (21, "p" * 50), (22, "q" + "p" * 50 + "r"),
                           (23, "p" * 200), (19, "é" * 30), (24, "x" + "é" * 30 + "y" * 60)]
    check(spark, docs)


def test_passages_over_many_rows(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(55))
    docs = [(i, " ".join(word() for _ in range(30)) + " " + passage + " "
             + " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(120)]
    docs += [(500 + i, docs[i % 3][1]) for i in range(60)]
    check(spark, docs)
    check(spark, docs, hot=50)


def test_repeated_rows_are_looked_at_once_a_task(spark):
    """One id and text in most rows: each task hands on its seeds and segments once."""
    import pyarrow as pa
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(400))
    docs = [(7, text)] * 200 + [(3, text[100:300]), (9, text[50:350] + "x")]
    check(spark, docs)
    batch = pa.RecordBatch.from_arrays([pa.array([b"k" * 16] * 500), pa.array([text] * 500)],
                                       ["key", "t"])
    rows = [r for out in repeats._seed_rows(4, 50, 24)([batch]) for r in out.to_pylist()]
    assert not any(r["settled"] for r in rows)
    assert sum(len(r["keys"]) for r in rows) == 16 * len(rows)


def test_given_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    frame = table(spark, "documents")
    assert result(repeats.without_repeats(frame)) == brute(docs)


def test_empty_table(spark, no_docs):
    out = repeats.without_repeats(no_docs)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert out.count() == 0

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from auric.llm import filter_audit as fa
from auric.session import scratch_path
from tests.llm.conftest import DOCS, doc, edge_texts, table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1}
    ids = defaultdict(set)
    for r in docs:
        ids[r["text"] or ""].add(r["doc_id"])
    out = {}
    facts = []
    for r in docs:
        t, i = r["text"] or "", r["doc_id"]
        w = WORDS.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search("[#$%&*|]", t)),
             "E": i is not None and any(j is not None and j < i for j in ids[t])}
        facts.append((r["lang"] or "", {k for k in f if f[k]}, i is not None and i in good,
                      i is not None and i in toxic))
    total = Counter()
    for part in {x[0] for x in facts}:
        mine = [x for x in facts if x[0] == part]
        for p in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(p):
                gone = [x for x in left if f in x[1]]
                total[part, f] += len(gone)
                out[part, "".join(p), k + 1] = [
                    len(left) - len(gone), len(gone),
                    sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
                left = [x for x in left if f not in x[1]]
    for (part, order, k), v in out.items():
        v.append(total[part, order[k - 1]])
    return out


def result(df):
    return {(r["part"], r["filter_order"], r["step"]):
            [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                            "toxic_lost", "shapley")] for r in df.collect()}


def written(spark, rows, files, schema=DOCS):
    """The rows as so many Parquet files, in the order given."""
    path = scratch_path(spark, "audit-in")
    step = max(1, -(-len(rows) // files))
    for lo in range(0, max(len(rows), 1), step):
        (spark.createDataFrame(rows[lo:lo + step], schema).coalesce(1)
         .write.mode("append").parquet(path))
    return path


@pytest.mark.parametrize("newest_first", [False, True])
def test_retraction_over_batches(spark, newest_first):
    """Smaller ids arrive later: what was booked for the earlier ones is taken back."""
    docs = sorted(table(spark, "documents").collect(), key=lambda r: r["doc_id"],
                  reverse=newest_first)
    labels = table(spark, "labels")
    path = written(spark, docs, 5, table(spark, "documents").schema)
    got = result(fa.audit(spark, path, labels, batches=5, buckets=3))
    assert got == brute(docs, labels.collect())
    assert sum(v[1] for (_, o, k), v in got.items() if o[0] == "E" and k == 1) > 0


def test_edges(spark, labels):
    rows = [doc(i, t, lang=("en", None, "")[k % 3]) for k, (i, t) in enumerate(edge_texts())]
    path = written(spark, rows[::-1], 4)
    docs = spark.createDataFrame(rows, DOCS)
    out = fa.audit(spark, path, labels, batches=4, buckets=2)
    assert out.columns[:3] == ["part", "filter_order", "step"]
    assert result(out) == brute(docs.collect(), labels.collect())


def test_hot_text_is_summed_in_its_task(spark, monkeypatch):
    """One text in most rows: a task hands on one candidate of it, whatever its rows."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7] * 1000, pa.int64()), pa.array([b"x"] * 1000),
         pa.array(range(5, 1005), pa.int64()), pa.array(["en"] * 1000),
         pa.array([3] * 1000, pa.int32()), pa.array([1] * 1000, pa.int64())],
        ["bucket", "digest", "id", "part", "bits", "n"])
    rows = [r for out in fa._combine([batch]) for r in out.to_pylist()]
    assert sorted((r["id"] or 0, r["bits"], r["n"]) for r in rows) == [
        (0, 3 | fa.E_BIT, 999), (5, 3, 1)]


def test_empty_tables(spark, no_labels):
    path = written(spark, [], 1)
    assert fa.audit(spark, path, no_labels).count() == 0
    rows = [doc(1, "a b"), doc(0, "a b")]
    got = result(fa.audit(spark, written(spark, rows, 2), no_labels))
    assert got["", "EABCD", 1][:2] == [1, 1]
    assert len(got) == 600

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as p
from auric.llm.tables import materialize
from tests.llm.conftest import DOCS, SF, doc, edge_texts, multiset, plain_words, table
from tests.llm.test_decontam import brute
from tests.llm.test_minhash import brute_classes
from tests.llm.test_quality import measures
from tests.llm.test_secrets import base


def test_each_stage_on_its_input(spark):
    docs = table(spark, "documents")
    columns = docs.columns
    known = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    rows = {}
    for name, stage in p.STAGES:
        before = docs.collect()
        docs = materialize(stage(spark, docs, SF), "stage")
        rows[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns

    before, after = rows["quality_rules"]
    kept = {r.doc_id for r in after}
    assert not any(measures(r.text)[-1] for r in after)
    assert all(r.doc_id in kept for r in before
               if known.get(r.doc_id) == 1 and not measures(r.text)[-1])

    before, after = rows["near_duplicates"]
    groups = brute_classes([(r.doc_id, r.text) for r in before])
    kept = {r.doc_id for r in after}
    assert len(after) == len(groups)
    assert all(len(kept & {before[i].doc_id for i in g}) == 1 for g in groups)

    before, after = rows["decontamination"]
    dirty = {d for d, *_, hit in brute([(r.doc_id, r.text) for r in before], items) if hit}
    assert dirty and {r.doc_id for r in after} == {r.doc_id for r in before} - dirty

    before, after = rows["secret_scan"]
    assert len(before) == len(after) and not any(base(r.text)[1] for r in after)
    texts = {r.doc_id: r.text for r in after}
    assert all(texts[r.doc_id] == r.text for r in before if not base(r.text)[1]
               and "[SECRET]" not in texts[r.doc_id])
    assert all(r.n_chars == len(r.text) for r in after)

    assert {r.doc_id for r in rows["packing"][1]} == {r.doc_id for r in after}


def test_near_duplicates_are_not_joined_through_the_driver(spark):
    plan = p.near_duplicates(spark, table(spark, "documents"), SF)
    assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_run(spark):
    out = p.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_stages_take_edges(spark):
    """Nulls, repeats, empty and long texts through every stage, each with its result."""
    texts = edge_texts()
    docs = spark.createDataFrame([doc(i, x) for i, x in texts], DOCS).select(
        "doc_id", "text", "lang", "source", "n_chars", F.col("_t").alias("key"))
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    out = {name: stage(spark, docs, SF).collect() for name, stage in p.STAGES}
    assert {(r.doc_id, r.text) for r in out["quality_rules"]} <= {
        (i, x) for i, x in texts if not measures(x)[-1]}
    assert len(out["near_duplicates"]) == len(brute_classes(texts))
    assert multiset((r.doc_id, r.text) for r in out["decontamination"]) == multiset(
        (i, x) for (i, x), hit in zip(texts, brute(texts, items)) if not hit[-1])
    assert Counter(r.doc_id for r in out["secret_scan"]) == Counter(i for i, _ in texts)
    assert all(r.text is None or not base(r.text)[1] for r in out["secret_scan"])
    assert sum(r.text is None for r in out["secret_scan"]) == sum(x is None for _, x in texts)
    packed = Counter((r.doc_id, r.piece) for r in out["packing"])
    assert Counter({i: n for (i, k), n in packed.items() if k == 0}) == Counter(
        i for i, _ in texts)
    assert all(r.key == "x" for name in list(out)[:-1] for r in out[name])


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in p.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
        assert name == "packing" or out.columns == docs.columns


def test_words_helper():
    assert plain_words("A-b É") == ["a", "b", "É"]

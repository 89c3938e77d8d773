"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
All but the last return the columns of ``documents``; the last returns the pieces and
where they are packed. Between stages the rows are written as Parquet to the shared
checkpoint folder and read again, so a lost executor costs at most one stage's tasks.

1. quality rules        documents that the rules reject go
2. near-duplicates      one document of each class stays
3. decontamination      documents that hold a window of a benchmark item go
4. secret scan          found secrets are replaced by a mark; every document stays
5. packing              best-two-fit of the token pieces into sequences

Defined results: null and empty texts fail the rules and go with stage 1 (a stage that is
given some keeps one row of them all as near-duplicates, never finds them contaminated,
leaves them as they are, and packs each as the end mark alone); null ids are kept as they
are and are never trusted; repeated rows are one class, of which one row stays; very long
texts are worked on whole; an empty table gives an empty result; columns beside those of
``documents`` are carried through to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm import decontam, minhash, packing, quality_rules, secrets
from auric.llm.tables import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep, all columns; null and empty texts go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, all columns; rows without words are one class."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no window of an item occurs in, all columns."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets replaced by ``[SECRET]`` and n_chars counted anew."""
    ratios = secrets.fit(secrets.ordinary_texts(docs, table(spark, sf_dir, "labels")))
    out = secrets.redacted(docs, ratios)
    return (out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
            if "n_chars" in docs.columns else out)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document and where it is packed."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# hashed models, near-duplicate classes and token ids are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs

"""Operations of a training-data pipeline. Nothing else in the library imports
this subpackage; ``QUERIES`` and ``ORACLE`` are what it registers."""

from __future__ import annotations

from importlib import import_module

MODULES = ("classifier", "decontam", "filter_audit", "html_text", "lexical", "licenses",
           "minhash", "packing", "quality_rules", "repeats", "secrets", "token_counts", "warc")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"auric.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)

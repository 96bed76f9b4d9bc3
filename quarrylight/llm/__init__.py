"""Operations of a training-data pipeline: one module for each, one registered query for each."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query name -> module of this subpackage that defines a function of that name.
MODULES = {
    "op1_bpe": "bpe",
    "op2_token_counts": "token_counts",
    "op3_toxicity": "toxicity",
    "op4_pii": "pii",
    "op5_packing": "packing",
    "op6_vector_links": "vector_links",
    "op7_warc": "warc",
    "op8_minhash": "minhash",
    "op9_extraction": "extraction",
    "op10_exact_dedup": "exact_dedup",
    "op11_decontamination": "decontamination",
    "op12_whitening": "whitening",
    "op13_vector_codes": "vector_codes",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"{__name__}.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"{__name__}.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}

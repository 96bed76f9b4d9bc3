"""JSON in one form: keys in order, no blanks, so that equal values have equal texts and hashes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_DUMP = {"ensure_ascii": False, "sort_keys": True}


def _each(text: pd.Series, of) -> pd.Series:
    def one(t: str | None) -> str | None:
        try:
            return None if t is None else of(json.loads(t))
        except ValueError:
            return None

    return text.map(one)


def canonical_json(text: Column) -> Column:
    """JSON text with the keys of every object in order and without blanks; null for what is no JSON."""

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return _each(t, lambda v: json.dumps(v, separators=(",", ":"), **_DUMP))

    return run(text)


def stable_hash(text: Column, length: int = 64) -> Column:
    """The first hex digits of the SHA-256 of canonical JSON."""
    return F.substring(F.sha2(canonical_json(text), 256), 1, length)


def scalar_metadata(text: Column) -> Column:
    """A JSON object as one with scalar values only: nulls go, lists and objects become their JSON text; null for what is no object."""

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        plain = lambda v: v if isinstance(v, (str, int, float, bool)) else json.dumps(v, **_DUMP)
        return _each(t, lambda v: json.dumps({k: plain(x) for k, x in v.items() if x is not None}, separators=(",", ":"), **_DUMP) if isinstance(v, dict) else None)

    return run(text)

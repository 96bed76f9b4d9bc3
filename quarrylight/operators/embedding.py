"""Text embeddings: what defines an embedder, a hashing embedder that needs no model, and its use as a column."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that are encoded at once in a task.
AT_ONCE = 2048


@dataclass(frozen=True)
class Embedder:
    """A function from texts to the rows of a matrix, with the settings that make its vectors comparable.

    ``settings`` must hold all that changes vectors (model, revision, prompts, normalisation) and nothing secret.
    """

    name: str
    dimensions: int
    settings: dict = field(hash=False)
    encode: Callable[[list[str]], np.ndarray] = field(compare=False, hash=False, repr=False)

    def contract(self) -> dict:
        return {"name": self.name, "dimensions": self.dimensions, "settings": self.settings}

    def fingerprint(self) -> str:
        """16 hex digits that change with the contract only."""
        return hashlib.sha256(json.dumps(self.contract(), sort_keys=True, ensure_ascii=True, default=str).encode()).hexdigest()[:16]


_TOKEN = re.compile(r"[a-z0-9_]+|[一-鿿]+")


@lru_cache(maxsize=200_000)
def _bucket(token: str, dimensions: int) -> int:
    return int(hashlib.md5(token.encode(), usedforsecurity=False).hexdigest()[:8], 16) % dimensions


def hashing(dimensions: int = 256) -> Embedder:
    """Counts of a text's lower-case tokens in hashed places, scaled to unit length; texts without tokens are zero."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions))
        for row, text in zip(out, texts):
            places = [_bucket(t, dimensions) for t in _TOKEN.findall((text or "").lower())]
            if places:
                row += np.bincount(places, minlength=dimensions)
        return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-300)

    return Embedder("hashed-counts", dimensions, {"tokens": _TOKEN.pattern, "hash": "md5", "normalised": True}, encode)


def embedded(text: Column, embedder: Embedder) -> Column:
    """The vector of each text, as doubles; a null text counts as empty."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            given = texts.fillna("").tolist()
            rows = [embedder.encode(given[k : k + AT_ONCE]) for k in range(0, len(given), AT_ONCE)]
            yield pd.Series([v for part in rows for v in np.asarray(part, np.float64)])

    return run(text)


def neighbour_similarity(texts: Column, embedder: Embedder) -> Column:
    """For an array of texts: the cosine of each with the next one, one number fewer than texts. A zero vector is like nothing (0).

    Long arrays are encoded piece by piece; the last vector of a piece is carried over.
    """

    def of(given: list[str]) -> np.ndarray:
        out, last = [], None
        for k in range(0, len(given), AT_ONCE):
            x = np.asarray(embedder.encode(list(given[k : k + AT_ONCE])), np.float64)
            x = x if last is None else np.concatenate([last, x])
            norms = np.sqrt((x * x).sum(1))
            out.append((x[:-1] * x[1:]).sum(1) / np.maximum(norms[:-1] * norms[1:], 1e-300))
            last = x[-1:]
        return np.concatenate(out) if out else np.zeros(0)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([None if r is None else of(r) for r in rows])

    return run(texts)

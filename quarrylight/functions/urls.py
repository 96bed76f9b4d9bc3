"""Addresses: references made absolute, and rows apart whose address is none."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def absolute(reference: str, base: str) -> str | None:
    """A reference on a page as an http address without fragment, or None."""
    try:
        parts = urlsplit(urljoin(base, reference.strip()))
    except ValueError:
        return None
    return urlunsplit(parts._replace(fragment="")) if parts.scheme in ("http", "https") and parts.netloc else None


def host(url: str) -> str:
    try:
        return (urlsplit(url).hostname or "").lower()
    except ValueError:
        return ""


def resolved(references: Column, base: Column) -> Column:
    """An array of references, each as array<struct<url, internal>>: absolute, distinct, in order; what is no http address is left out."""

    @F.pandas_udf("array<struct<url: string, internal: boolean>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for lists, bases in batches:
            out = []
            for refs, b in zip(lists, bases):
                urls = dict.fromkeys(u for r in (() if refs is None else refs) if r is not None and (u := absolute(r, b or "")))
                home = host(b or "")
                out.append([{"url": u, "internal": host(u) == home} for u in urls])
            yield pd.Series(out)

    return run(references, base)


def http_only(rows: DataFrame, url_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their address trimmed, rows whose address is not an absolute http one)."""
    trimmed = F.trim(F.regexp_replace(F.col(url_col), r"^\s+|\s+$", ""))
    good = F.coalesce(trimmed.rlike(r"(?i)^https?://[^/?#]"), F.lit(False))
    return rows.where(good).withColumn(url_col, trimmed), rows.where(~good)

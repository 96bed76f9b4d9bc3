"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie end to end in one array of symbols with an offset for each. In each round
every sequence that can still merge finds the lowest rank among its neighbouring pairs and merges all pairs of that
rank at once; what is left at the end is counted. Ranks grow along every chain of merges (checked when the file is
read), so pairs of the lowest rank can't be overtaken by pairs that their merges make.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); rows repeat as in the input; an empty table gives an
empty result; input columns besides the two named are neither read nor returned.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank_segments, documents, text_batches, text_or_empty


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class MergeTable:
    """Merges of a byte-level BPE file as arrays: pair keys in order, their ranks and the symbols that they make."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"] if not t["normalized"]]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([vocab["".join(m)] for m in merges], np.int64)
        born = np.full(max(vocab.values()) + 1, -1, np.int64)
        born[made] = np.arange(len(merges))
        if len(set(made.tolist())) != len(made) or (np.maximum(born[left], born[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        self.width = np.int64(len(born))
        keys = left * self.width + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.none = np.int64(len(merges))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        live = np.flatnonzero(lengths > 1)
        keep = np.repeat(lengths > 1, lengths)
        symbols, sizes = symbols[keep], lengths[live]
        ranks = None
        while len(live):
            ends = np.cumsum(sizes)
            starts = ends - sizes
            if ranks is None:  # the rank of the pair that starts at each symbol; none at a sequence's last one
                ranks = np.full(len(symbols), self.none)
                ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
                ranks[ends - 1] = self.none
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == self.none
            if done.any():
                out[live[done]] = sizes[done]
                keep = np.repeat(~done, sizes)
                symbols, ranks = symbols[keep], ranks[keep]
                live, sizes, lowest = live[~done], sizes[~done], lowest[~done]
                if not len(live):
                    break
            owner = np.repeat(np.arange(len(live)), sizes)
            hit = np.flatnonzero(ranks == lowest[owner])
            # of pairs that overlap (as in aaa), every second one of a run merges, from the left
            first = np.r_[True, (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])]
            run_start = hit[np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))]
            hit = hit[(hit - run_start) % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            kept_at = np.cumsum(keep) - 1
            sizes = sizes - np.bincount(owner[hit], minlength=len(live))
            symbols, ranks = symbols[keep], ranks[keep]
            at = kept_at[hit]
            last = np.zeros(len(symbols) + 1, bool)
            last[np.cumsum(sizes) - 1] = True
            redo = np.unique(np.r_[at, at[at > 0] - 1])
            redo_last = last[redo]
            ranks[redo[redo_last]] = self.none
            inner = redo[~redo_last]
            ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        return out


class TokenCounter:
    """Counts of whole texts; keeps the counts of recent pre-tokens and segments, at most ``cache`` of each."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, cache: int = 300_000):
        self.table, self.pattern, self.cache = MergeTable(path), regex.compile(pattern), cache
        self.special = re.compile("|".join(map(re.escape, self.table.special))) if self.table.special else None
        self._pieces: dict[str, int] = {}
        self._segments: dict[str, int] = {}

    def _split(self, text: str) -> tuple[list[str], int]:
        """Parts between special strings, and how many of those there are; each is one token."""
        if self.special is None or not self.special.search(text):
            return [text], 0
        parts = self.special.split(text)
        return parts, len(parts) - 1

    def counts(self, texts: list[str]) -> list[int]:
        known = self._segments
        if len(known) > self.cache:
            known.clear()
        split = []
        for text in texts:
            parts, extra = self._split(text)
            segments: list[str] = []
            for part in parts:
                found = blank_segments(part)
                segments.extend([part] if found is None else found)
            split.append((segments, extra))
        new = {s for segments, _ in split for s in segments if s not in known}
        pieces = {s: self.pattern.findall(s) for s in new}
        if len(self._pieces) > self.cache:
            self._pieces.clear()
        unseen = list({p for found in pieces.values() for p in found if p not in self._pieces})
        for at in range(0, len(unseen), 50_000):
            part = unseen[at : at + 50_000]
            self._pieces.update(zip(part, self.table.counts([p.encode() for p in part]).tolist()))
        count = self._pieces.__getitem__
        for s, found in pieces.items():
            known[s] = sum(map(count, found))
        return [sum(map(known.__getitem__, segments)) + extra for segments, extra in split]


@lru_cache(maxsize=2)
def token_counter(path: str, pattern: str) -> TokenCounter:
    return TokenCounter(path, pattern)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per text: (id, n_bytes, n_tokens, over_limit: n_tokens > limit). Narrow: one pass over the scan, no shuffle."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path, pattern)
        for b in text_batches(batches):
            n = pa.array(counter.counts(b.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], names=[id_col, "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)
    counted = docs.select(F.col(id_col), text.alias("__t"), F.octet_length(text).cast("long").alias("__n")).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))

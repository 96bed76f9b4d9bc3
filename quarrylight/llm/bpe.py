"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For each prefix of a byte string there is exactly one token that the encoding of that prefix can end with.
The table ``last[i]`` holds it: among the tokens that end at i, it is the one that keeps a boundary with
``last[i - len(token)]``. Encoding is a walk back from the end. Since ``last[i]`` depends on earlier bytes only,
bytes can be appended at the cost of the new ones, and after an edit only the entries near it are computed anew.

Defined cases: a null text counts as empty and gives no ids; ids, doc_ids and rows repeat as they do in the
input; an empty table gives an empty result; input columns besides the two named are neither read nor returned.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank_segments, documents, text_batches, text_or_empty

_NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes, of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(piece: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[bytes]:
    """The parts that merging the lowest-ranked neighbours leaves, using only ranks under ``below``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class PrefixEncoder:
    """Encodes pre-tokens (pieces) of one vocabulary.

    ranks: token bytes to id, all single bytes among them. memo: the most boundary decisions kept.
    """

    def __init__(self, ranks: dict[bytes, int], memo: int = 400_000):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._memo, self._memo_limit = {}, memo
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._left: dict[int, tuple] = {}
        self._right: dict[int, tuple] = {}
        self.longest = max(map(len, ranks))
        #: The token of these bytes, or -1 where they are only the end of one.
        self._tails: dict[bytes, int] = {token[k:]: -1 for token in ranks for k in range(len(token))} | ranks

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a byte; () if its bytes don't merge into it."""
        found = self._halves.get(token, 0)
        if found == 0:
            text = self.tokens[token]
            if len(text) == 1:
                found = None
            else:
                parts = merged(text, self.ranks, token)
                found = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else ()
            self._halves[token] = found
        return found

    def _spine(self, token: int, side: int) -> tuple:
        """(token, rank at which it ends) from the outermost byte on that side up to the whole token."""
        known = self._left if side == 0 else self._right
        if token not in known:
            out, at, ends = [], token, _NEVER
            while True:
                out.append((at, ends))
                pair = self.halves(at)
                if not pair:
                    break
                at, ends = pair[side], at
            known[token] = tuple(reversed(out))
        return known[token]

    def keeps_boundary(self, first: int, second: int) -> bool:
        """Whether first and second, side by side, stay apart: replays both tokens' merges by rank and looks for one across."""
        key = first << 20 | second
        kept = self._memo.get(key)
        if kept is None:
            a, b, i, j, kept = self._spine(first, 1), self._spine(second, 0), 0, 0, self.halves(second) != ()
            tokens, ranks = self.tokens, self.ranks
            while kept:
                (left, left_ends), (right, right_ends) = a[i], b[j]
                across = ranks.get(tokens[left] + tokens[right])
                if across is not None and across < left_ends and across <= right_ends:
                    kept = False
                    break
                if left_ends == _NEVER and right_ends == _NEVER:
                    break
                if left_ends <= right_ends:
                    i += 1
                else:
                    j += 1
            if len(self._memo) >= self._memo_limit:
                self._memo.clear()
            self._memo[key] = kept
        return kept

    def extend(self, piece: bytes, last: list[int], upto: int | None = None) -> None:
        """Continues the table of last tokens over piece; last[k] belongs to the prefix of k + 1 bytes."""
        tails, memo, keeps = self._tails, self._memo, self.keeps_boundary
        for end in range(len(last) + 1, (len(piece) if upto is None else upto) + 1):
            found, start = [], end - 1
            while start >= 0:  # backwards for as long as some token ends with these bytes
                token = tails.get(piece[start:end])
                if token is None:
                    break
                if token >= 0:
                    found.append((start, token))
                start -= 1
            while found:
                start, token = found.pop()
                if start == 0:
                    if self.halves(token) != ():
                        last.append(token)
                        break
                else:
                    kept = memo.get(last[start - 1] << 20 | token)
                    if kept or kept is None and keeps(last[start - 1], token):
                        last.append(token)
                        break
            else:
                raise ValueError("no token ends here; the vocabulary lacks single bytes")

    def walk_back(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. A piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(piece, last)
        return self.walk_back(last)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EditableText:
    """A text whose encoding follows appends and edits. Pieces away from a change keep their tables of last tokens."""

    #: A match of the pattern depends on at most so many characters after its start ('re, 've, 'll) or one after its end.
    AHEAD = 3

    def __init__(self, encoder: PrefixEncoder, pattern: str = public_tokenizers.PATTERN, text: str = ""):
        self.encoder, self.pattern = encoder, regex.compile(pattern)
        self.text, self.pieces = "", []  # pieces: [start, piece, bytes, last]
        self.computed = 0
        self.edit(0, 0, text)

    def _table(self, piece: str, near: list | None) -> list:
        """The piece's bytes and table; what it shares with ``near`` at the front, or at the back once tables agree again, is taken over."""
        raw, last = piece.encode(), []
        old_raw, old = (near[2], near[3]) if near else (b"", [])
        same = 0
        while same < min(len(raw), len(old_raw)) and raw[same] == old_raw[same]:
            same += 1
        last = old[:same]
        tail, k = 0, min(len(raw), len(old_raw)) - same
        while tail < k and raw[-1 - tail] == old_raw[-1 - tail]:
            tail += 1
        shift, agree = len(old_raw) - len(raw), 0
        while len(last) < len(raw):
            self.encoder.extend(raw, last, len(last) + 1)
            self.computed += 1
            at = len(last) - 1
            in_tail = at >= len(raw) - tail
            agree = agree + 1 if in_tail and last[at] == old[at + shift] else 0
            if agree >= self.encoder.longest:
                last += old[len(last) + shift :]
        return [raw, last]

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces text[start:end] by new."""
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        kept = [p for p in self.pieces if max(p[0] + len(p[1]) + 1, p[0] + self.AHEAD) <= start]
        later = {p[0] + shift: k for k, p in enumerate(self.pieces) if p[0] >= end}
        at = kept[-1][0] + len(kept[-1][1]) if kept else 0
        old = self.pieces[len(kept) :]
        out, used = kept, 0
        for m in self.pattern.finditer(self.text, at):
            if m.start() >= start + len(new) and m.start() in later:
                out = out + [[p[0] + shift, *p[1:]] for p in self.pieces[later[m.start()] :]]
                break
            near = old[used] if used < len(old) else None
            out.append([m.start(), m.group(), *self._table(m.group(), near)])
            used += 1
        self.pieces = out

    def ids(self) -> list[int]:
        whole = self.encoder.ranks
        return [i for _, _, raw, last in self.pieces for i in ([whole[raw]] if raw in whole else self.encoder.walk_back(last))]


class TextEncoder:
    """Encodes and decodes whole texts, with bounded caches of pieces and of blank-separated segments.

    New pieces of a batch are taken in byte order, so that each keeps the table entries of the prefix it shares
    with the one before and is an append to it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, cache: int = 300_000):
        self.encoder = PrefixEncoder(ranks)
        self.pattern = regex.compile(pattern)
        self.cache = cache
        self._pieces: dict[str, bytes] = {}
        self._segments: dict[str, bytes] = {}
        self._old_pieces: dict[str, bytes] = {}

    def _learn(self, segments: set[str]) -> None:
        """Fills the caches for segments that aren't in them."""
        if len(self._pieces) > self.cache:  # what is asked for again comes back from the older generation
            self._old_pieces, self._pieces = self._pieces, {}
        if len(self._segments) > self.cache:
            self._segments.clear()
        segments = {s for s in segments if s not in self._segments}
        split = {s: self.pattern.findall(s) for s in segments}
        known = self._pieces
        unseen = {p for found in split.values() for p in found if p not in known}
        back = unseen & self._old_pieces.keys()
        known.update((p, self._old_pieces[p]) for p in back)
        new = sorted((p.encode(), p) for p in unseen - back)
        encoder, before, last = self.encoder, b"", []
        for raw, piece in new:
            whole = encoder.ranks.get(raw)
            if whole is None:
                same, k = 0, min(len(raw), len(before))
                while same < k and raw[same] == before[same]:
                    same += 1
                del last[same:]
                encoder.extend(raw, last)
                before = raw
                ids = encoder.walk_back(last)
            else:
                ids = [whole]
            known[piece] = struct.pack(f"<{len(ids)}I", *ids)
        for s, found in split.items():
            self._segments[s] = b"".join(map(known.__getitem__, found))

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [blank_segments(t) for t in texts]
        split = [[t] if s is None else s for t, s in zip(texts, split)]
        self._learn(set().union(*split))
        for segments in split:
            yield b"".join(map(self._segments.__getitem__, segments))

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))

    def decode(self, ids: bytes) -> bytes:
        return self.encoder.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder a worker process; files of vocabularies are read where the work runs."""
    return TextEncoder(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Token ids of every text: (id, ids array<int>), one row for each input row."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = text_encoder(path, pattern)
        for b in text_batches(batches, 500):
            ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in enc.encode_many(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("__t")).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Bytes of every list of ids: (id, decoded binary); a null list gives no bytes."""
    kind = tokens.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = text_encoder(path, pattern)
        for b in text_batches(batches, 500):
            out = [enc.encoder.decode(ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    return tokens.select(F.col(id_col), F.col(ids_col).alias("__i")).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, decoded binary")


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encodes each text, decodes its ids and returns digests of both instead of the ids, so that nothing wide leaves the task.

    Narrow: one pass over the scan, no shuffle.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = text_encoder(path, pattern)
        for b in text_batches(batches, 1000):
            n, ids_sha, text_sha = [], [], []
            for ids in enc.encode_many(b.column(1).to_pylist()):
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"`{id_col}` {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("__t")).mapInArrow(run, schema)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))

"""Best-fit packing with certified bounds.

Documents become token pieces of at most ``capacity`` tokens. Pieces are dealt by a hash over partitions of bounded
size; each packs its own by best-fit decreasing and compares its number of bins with a lower bound from dual-feasible
functions. Partitions that reach their bound are certified and give up only their emptiest bin, the others all bins
with gaps; the pieces of those bins are exchanged, dealt over fewer partitions and packed by best-fit decreasing again.
A repacked group is taken over only if it needs fewer bins. This ends when the whole reaches the bound of all pieces,
when one group is left, or after ``rounds``.

Defined cases: a null text counts as empty and gives one piece, the end mark; rows that repeat are packed as often as
they occur; an empty table gives an empty result; input columns besides the two named are neither read nor returned.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, materialize, text_batches, text_or_empty

CAPACITY = 2048
GROUP_PIECES = 50_000


#: A comma or full stop after a letter or digit is a pre-token of its own; after anything else it may be part of one.
_JOINED = re.compile(r"[,.] (?<=[^\w ]..|_..)")


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of values that begin at starts, end to end."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class KnownWords:
    """A number for each word; the ids of all words lie end to end in one array."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def find(self, words: list[str]) -> np.ndarray:
        """The words' numbers, -1 where one is not known."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words with these numbers, end to end, and how many each has."""
        starts = self.ends[numbers]
        lengths = self.ends[numbers + 1] - starts
        return ragged(self.ids, starts, lengths), lengths


class WordIds:
    """Ids of whole texts by a tokenizers file whose pre-tokens never hold white space.

    The distinct words of some texts are looked up once; words are encoded once as long as they stay in the cache; the
    ids of a text are those of its words, joined. Texts are lower-cased first, as the file's normaliser does character
    by character, except where a capital sigma (whose lower case Python takes from its place in the word) or the look
    of a special string forbids it.

    New words are encoded many at a time, with blanks between. Words of letters only are one pre-token each, so they
    end where an id with the end-of-word suffix stands. Between other words goes a sign that is one id and that none of
    them holds. Where the ends found don't number the words, these are encoded one by one.
    """

    SIGN = "\u25a0"

    def __init__(self, path: str, cache: int = 250_000, chars: int = 4_000_000):
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.cache, self.chars = cache, chars
        self._young, self._old = KnownWords(), KnownWords()
        vocab, suffix = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self._ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self._ends_word[[k for w, k in vocab.items() if suffix and w.endswith(suffix)]] = True
        sign = self._ids(self.SIGN)
        self._sign = int(sign[0]) if len(sign) == 1 else -1

    def _words(self, text: str) -> str:
        """The text with blanks between its words."""
        if "\u03a3" in text or "<|" in text:
            return text
        text = text.lower().replace("\n", " ")
        if not _JOINED.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        known = self._young
        letters = [w for w in words if w.isalpha()]
        ids = self._ids(" ".join(letters))
        ends = np.flatnonzero(self._ends_word[ids])
        if len(ends) == len(letters):
            known.add(letters, ids, np.diff(ends, prepend=-1))
        others = [w for w in words if w not in known.number and self.SIGN not in w]
        ids = self._ids("".join(f"{w} {self.SIGN} " for w in others))
        ends = np.flatnonzero(ids == self._sign)
        if len(ends) == len(others):
            known.add(others, np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)
        alone = [w for w in words if w not in known.number]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
        known.add(alone, np.fromiter(chain.from_iterable(found), "<u4"), np.array(list(map(len, found)), np.int64))

    def _numbers(self, words: np.ndarray) -> np.ndarray:
        """Numbers of distinct words among the young ones; what is asked for again comes back from the older generation."""
        if len(self._young.number) > self.cache:
            self._old, self._young = self._young, KnownWords()
        found = self._young.find(words)
        at = np.flatnonzero(found < 0)
        if len(at):
            missing = words[at]
            old = self._old.find(missing)
            self._young.add(missing[old >= 0].tolist(), *self._old.take(old[old >= 0]))
            self._learn(missing[old < 0].tolist())
            found[at] = self._young.find(missing)
        return found

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out, part, chars = [], [], 0
        for text in texts:
            part.append(self._words(text))
            chars += len(text)
            if chars > self.chars:  # what is held of the words at once stays small where texts are long
                out += self._encode(part)
                part, chars = [], 0
        return out + self._encode(part)

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        numbers, which = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False)), coded.indices.to_numpy()
        of_words, lengths = self._young.take(numbers)
        ids = ragged(of_words, (np.cumsum(lengths) - lengths)[which], lengths[which])
        at = np.concatenate([[0], np.cumsum(lengths[which])])[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task for each core
    return WordIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, uid, piece, start, length, ids_crc32[, ids]): each text's ids and the end mark, cut only where longer than capacity.

    uid tells input rows apart. Narrow: one pass over the scan; materialize before using uid twice.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "uid", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, uid, mark = word_ids(path), TaskContext.get().partitionId() << 40, np.array([end_id], "<u4").tobytes()
        for b in text_batches(batches, 500):
            rows, uids, numbers, starts, lengths, sums, ids = [], [], [], [], [], [], []
            for k, encoded in enumerate(words.encode_many(b.column(1).to_pylist())):
                encoded += mark
                for n, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    part = encoded[at : at + 4 * capacity]
                    rows.append(k)
                    uids.append(uid)
                    numbers.append(n)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                uid += 1
            columns = [b.column(0).take(pa.array(rows, pa.int64())), pa.array(uids, pa.int64()), pa.array(numbers, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=names)

    schema = f"`{id_col}` {kind}, uid long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("__t")).mapInArrow(run, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing undercuts. counts[k]: pieces of length k, k from 0 to capacity.

    The largest of the bounds of two families of dual-feasible functions: one counts pieces over capacity - k as whole
    bins, drops those under k and leaves the rest; the other rounds (m + 1) * length down to multiples of capacity.
    """
    size = np.arange(capacity + 1)
    best = -(-int((counts * size).sum()) // capacity)
    number, total = np.cumsum(counts), np.cumsum(counts * size)
    k = np.arange(1, capacity // 2 + 1)
    whole = number[capacity] - number[capacity - k]
    middle = total[capacity - k] - total[k - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for m in range(1, 64):
        scaled = (m + 1) * size
        value = np.where(scaled % capacity == 0, size * m, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (m * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; lengths must not increase. Open bins are found by their gap in a bit set."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps, used = 0, 0
    for k, n in enumerate(lengths.tolist()):
        fitting = gaps >> n
        if fitting:
            gap = (fitting & -fitting).bit_length() - 1 + n
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, at, used = capacity, used, used + 1
        bins[k], offsets[k] = at, capacity - gap
        if gap > n:
            by_gap[gap - n].append(at)
            gaps |= 1 << (gap - n)
    return bins, offsets


def repack(rows: pd.DataFrame, base: int, capacity: int, last: bool) -> pd.DataFrame:
    """Packs the pieces of one group and marks the bins to be exchanged as open. Keeps the bins they came in unless fewer do."""
    rows = rows.sort_values(["length", "uid", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    bins, offsets = best_fit_decreasing(rows["length"].to_numpy(), capacity)
    before = rows["sequence_id"].to_numpy()
    n = int(bins.max()) + 1
    if (before < 0).any() or n < len(np.unique(before)):
        rows["sequence_id"], rows["offset"] = base + bins, offsets
    sequence, at = np.unique(rows["sequence_id"].to_numpy(), return_inverse=True)
    fill = np.bincount(at, rows["length"].to_numpy())
    if last:
        exchanged = np.zeros(len(sequence), bool)
    elif len(sequence) <= lower_bound(np.bincount(rows["length"].to_numpy(), minlength=capacity + 1), capacity):
        exchanged = np.arange(len(sequence)) == np.argmin(fill)
    else:
        exchanged = fill < capacity
    rows["open"] = exchanged[at]
    return rows


def _repacker(k: int, capacity: int, last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return repack(rows.drop(columns="__g"), (k << 56) + (int(key[0]) << 24), capacity, last)

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, rounds: int = 4, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (with columns uid, piece, length, and any others).

    Groups hold about ``group_pieces`` pieces however many there are; to the driver come only counts and the histogram
    of lengths (at most ``capacity`` rows).
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields) + ", sequence_id long, offset long, open boolean"
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    bound = lower_bound(counts, capacity)
    waiting = cut.withColumn("sequence_id", F.lit(-1).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    n, closed = int(counts.sum()), []
    for k in range(rounds + 1):
        groups = max(1, -(-n // group_pieces))
        last = k == rounds or k > 0 and groups == 1

        dealt = waiting.withColumn("__g", F.pmod(F.xxhash64("uid", "piece", F.lit(k)), F.lit(groups)))
        packed = materialize(dealt.groupBy("__g").applyInPandas(_repacker(k, capacity, last), schema), f"packed-{k}")
        if last:
            return _all(closed + [packed])
        done = sum(c.select("sequence_id").distinct().count() for c in closed) + packed.select("sequence_id").distinct().count()
        if done <= bound:
            return _all(closed + [packed])
        closed.append(packed.where("not open"))
        waiting = packed.where("open").drop("open")
        n = waiting.count()
        if n == 0:
            return _all(closed)
    raise AssertionError("unreachable")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("open")


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every text."""
    cut = materialize(pieces(docs, path or public_tokenizers.path("word_bpe_49k.json"), capacity, id_col=id_col, text_col=text_col), "pieces")
    return pack(cut, capacity).select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir))

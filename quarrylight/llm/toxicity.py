"""Toxicity by bags of subword embeddings, averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (and of itself), all kept in one hashed table; a
window's vector is the mean of its words (of at least half a window; zero vectors fill shorter ones); a linear softmax
turns that into two classes. Table and softmax are trained together in numpy. A document is toxic if any of its windows
is, so its score is 1 - prod(1 - p(window)), and the training loss is that of the document's label. Misspelt words share
n-grams, hence vectors, with words seen in training. With ``window=0`` a document is one bag, averaged whole, and its
score the plain softmax: a few toxic words then weigh the less the longer the text (README has figures of both).

Training takes a bounded sample of labelled rows (``sample_rows`` of each class, texts of at most ``sample_chars``
characters, chosen by a hash of the id); only these reach the driver. Scoring covers every row and its whole text.

Defined cases: a null or empty text has one window without words and so the score of the softmax's bias; labels that
are null are ignored and of repeated ones the largest counts; without a labelled row of either class every score is 0;
rows that repeat get the same score each; very long texts are scored whole, their windows one after the other; an empty
table gives an empty result; input columns besides the two named are neither read nor returned by ``score`` and all
returned unchanged by ``reject``, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, renamed, text_batches, text_or_empty

EDGES = ".,;:!?\"'()[]{}<>*_-"


@dataclass(frozen=True)
class Shape:
    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    window: int = 16
    fewest: int = 4
    steps: int = 80
    rate: float = 2.0
    damping: float = 0.05
    seed: int = 7


def subwords(words: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams (between edge marks) and of the words themselves, with each one's word; by n, then word.

    Hashes are polynomials over code points, computed for all words at once.
    """
    marked = [f"<{w.strip(EDGES)}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(marked)), sizes)
    base, spread = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(sizes.max()), base, np.uint64)])
    hashes, owners = [np.add.reduceat(codes * powers[np.arange(len(codes)) - starts[owner]], starts)], [np.arange(len(marked))]
    for n in range(shape.shortest, shape.longest + 1):
        count = len(codes) - n + 1
        if count < 1:
            break
        h = codes[:count].copy()
        for k in range(1, n):
            h = h * base + codes[k : k + count]
        inside = owner[:count] == owner[n - 1 :]
        hashes.append(h[inside] + np.uint64(n))
        owners.append(owner[:count][inside])
    mixed = (np.concatenate(hashes) * spread) >> np.uint64(40)
    return (mixed % np.uint64(shape.buckets)).astype(np.int64), np.concatenate(owners)


def bag(text: str) -> list[str]:
    """Distinct words in the order of their first use: repeating a word can't raise or lower a score."""
    return list(dict.fromkeys(text.lower().split()))


def windows(n_words: int, window: int) -> np.ndarray:
    """First word of each window: as many windows of nearly equal size as come closest to ``window`` words each."""
    n = max(1, round(n_words / window)) if window else 1
    return (np.arange(n) * n_words) // n


@dataclass
class SubwordModel:
    shape: Shape
    table: np.ndarray  # buckets x dim
    softmax: np.ndarray  # dim x 2
    bias: np.ndarray  # 2

    def margins(self) -> tuple[np.ndarray, float]:
        """What the linear softmax makes of each table row (class 1 less class 0), and of the bias."""
        return (self.table @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def fit(texts: list[str], toxic: list[int], shape: Shape = Shape()) -> SubwordModel | None:
    """Trains table and softmax together on all rows given; None unless both classes occur.

    Gradient descent with momentum; each parameter's step is divided by its gradient's usual size plus ``damping``
    times the largest one of its block, so that n-grams of few documents can't move as far as those that set the
    classes apart in many. N-grams in fewer than ``fewest`` documents stay zero.
    """
    y = np.array(toxic, bool)
    if not y.any() or y.all():
        return None
    vocabulary: dict[str, int] = {}
    tokens, firsts, docs, at = [], [], [], 0
    for k, text in enumerate(texts):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in bag(text)]
        if not ids:
            continue
        tokens.append(np.array(ids, np.int32))
        first = windows(len(ids), shape.window) + at
        firsts.append(first)
        docs.append(np.full(len(first), k))
        at += len(ids)
    if not tokens:
        return None
    tokens, firsts, docs = map(np.concatenate, (tokens, firsts, docs))
    sizes = np.diff(np.r_[firsts, len(tokens)])
    divide = np.maximum(sizes, shape.window // 2)
    grams, owners = subwords(list(vocabulary), shape)
    order = np.argsort(owners, kind="stable")
    grams, n_grams = grams[order].astype(np.int32), np.bincount(owners, minlength=len(vocabulary))
    gram_starts = np.cumsum(n_grams) - n_grams
    del owners, order
    rng = np.random.default_rng(shape.seed)
    in_docs = np.zeros(shape.buckets, np.int64)
    word_docs = np.unique(np.stack([tokens, np.repeat(docs, sizes)]), axis=1)[0]
    np.add.at(in_docs, grams, np.repeat(np.bincount(word_docs, minlength=len(n_grams)), n_grams))
    trained = in_docs >= shape.fewest
    table = rng.normal(0, 0.01, (shape.buckets, shape.dim)) * trained[:, None]
    softmax = rng.normal(0, 0.5, (shape.dim, 2))
    bias = np.array([2.0, -2.0])
    params = [table, softmax, bias]
    moments, rates = [(np.zeros_like(p), np.zeros_like(p)) for p in params], [shape.rate, 0.02, 0.05]
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    for step in range(1, shape.steps + 1):
        delta = softmax[:, 1] - softmax[:, 0]
        of_gram = table @ delta
        of_word = np.add.reduceat(of_gram[grams], gram_starts) / n_grams
        margin = np.add.reduceat(of_word[tokens], firsts) / divide + bias[1] - bias[0]
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        none = np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y))  # log of the chance that no window is toxic
        clean = np.exp(none)
        up = np.where(y, -clean / np.maximum(1 - clean, 1e-9), 1.0) * weight  # d loss / d none, negated
        g_window = p * up[docs]
        g_word = np.bincount(tokens, np.repeat(g_window / divide, sizes), len(n_grams)) / n_grams
        g_gram = np.bincount(grams, np.repeat(g_word, n_grams), shape.buckets) * trained
        g_delta = table.T @ g_gram
        grads = [np.outer(g_gram, delta), np.stack([-g_delta, g_delta], 1), np.array([-1.0, 1.0]) * g_window.sum()]
        ease = min(1.0, 2 * (1 - step / (shape.steps + 1)))
        for param, grad, (m, v), rate in zip(params, grads, moments, rates):
            m += 0.2 * (grad - m)
            v += 0.1 * (grad * grad - v)
            size = np.sqrt(v)
            param -= rate * ease * m / (size + shape.damping * size.max() + 1e-15)
    return SubwordModel(shape, table, softmax, bias)


class Scorer:
    """Scores whole texts; keeps the margins of recent words, at most ``cache`` in each of two generations."""

    def __init__(self, of_gram: np.ndarray, bias: float, shape: Shape, cache: int = 60_000):
        self.of_gram, self.bias, self.shape, self.cache = of_gram.astype(np.float64), bias, shape, cache
        self._young: dict[str, float] = {}
        self._old: dict[str, float] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self._young) > self.cache:
            self._old, self._young = self._young, {}
        young = self._young
        new = [w for w in words if w not in young]
        unseen = []
        for w in new:
            if w in self._old:
                young[w] = self._old[w]
            else:
                unseen.append(w)
        if unseen:
            grams, owners = subwords(unseen, self.shape)
            total = np.bincount(owners, self.of_gram[grams], len(unseen))
            young.update(zip(unseen, (total / np.bincount(owners, minlength=len(unseen))).tolist()))

    def scores(self, texts: list[str]) -> list[float]:
        split = [bag(t) for t in texts]
        self._learn(set().union(*split) if split else set())
        lookup, out = self._young.__getitem__, []
        for words in split:
            if words:
                first = windows(len(words), self.shape.window)
                of_word = np.fromiter(map(lookup, words), np.float64, len(words))
                margin = np.add.reduceat(of_word, first) / np.maximum(np.diff(np.r_[first, len(words)]), self.shape.window // 2) + self.bias
            else:
                margin = np.array([self.bias])
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            out.append(float(1 - np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())))
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int, sample_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``sample_rows`` labelled rows of each class that aren't held out: (text, toxic).

    The ids are chosen from the narrow labels first; at most 4 * sample_rows of them are broadcast to the scan of texts.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max("toxic").cast("int").alias("__toxic"))
    order = [F.xxhash64(F.col(id_col)), F.col(id_col)]
    picked = [known.where(F.col("__toxic") == c).orderBy(*order).limit(2 * sample_rows) for c in (0, 1)]
    text = docs.select(F.col(id_col), text_or_empty(text_col).alias("__t")).where(F.length("__t") <= sample_chars)
    found = text.join(F.broadcast(picked[0].union(picked[1])), id_col)
    parts = [found.where(F.col("__toxic") == c).orderBy(*order, "__t").limit(sample_rows) for c in (0, 1)]
    return parts[0].union(parts[1]).select(F.col("__t").alias("text"), F.col("__toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, sample_chars: int = 20_000, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text") -> SubwordModel | None:
    rows = training_rows(docs, labels, sample_rows, sample_chars, id_col, text_col).collect()
    return fit([r.text for r in rows], [r.toxic for r in rows], shape)


def score(docs: DataFrame, model: SubwordModel | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, score_col: str = "score", flag_col: str = "predicted") -> DataFrame:
    """(id or the columns in keep, score, predicted) for every row. Narrow: one pass over the scan; the broadcast model has a fixed size."""
    columns = [id_col] if keep is None else keep
    field = {f.name: f for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {field[c].dataType.simpleString()}" for c in columns)
    names = [f"c{k}" for k in range(len(columns))]
    narrow = docs.select(*[F.col(c).alias(n) for c, n in zip(columns, names)], text_or_empty(text_col).alias("__t"))
    if model is None:
        out = narrow.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], F.lit(0.0).alias(score_col))
    else:
        of_gram, bias = model.margins()
        shared = docs.sparkSession.sparkContext.broadcast((of_gram, bias, model.shape))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(*shared.value)
            for b in text_batches(batches, 500):
                out = pa.array(scorer.scores(b.column(len(columns)).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns[: len(columns)], out], names=[*columns, score_col])

        out = narrow.mapInArrow(run, f"{schema}, `{score_col}` double")
    return out.withColumn(flag_col, (F.col(score_col) >= threshold).cast("int"))


def reject(docs: DataFrame, model: SubwordModel | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that score under the threshold, with all their columns."""
    columns, plain = docs.columns, renamed(docs)
    id_, text = plain.columns[columns.index(id_col)], plain.columns[columns.index(text_col)]
    scored = score(plain, model, threshold, id_, text, keep=plain.columns, score_col="__score", flag_col="__toxic")
    return scored.where("__toxic = 0").select(*plain.columns).toDF(*columns)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""Lexical ranking: corpus statistics and BM25 for a stated set of queries, in two passes over the documents.

The queries' terms are counted and go to the tasks; documents stay where they are. The first pass counts how many
documents have each of those terms, and all documents and tokens. The second counts terms inside each document, scores a
batch of documents against all queries as one matrix product, and returns a task's best rows of each query. Only those
are shuffled. Query sets of more than PASS terms are asked in several passes.

Where every term adds to a score (with plus) and neither groups nor routes matter, only terms that many documents and many
queries have are multiplied, in single precision; the others are added posting by posting. Rows that come near a query's best so
far are then scored in double precision. A task keeps those best rows and numbers queries; their ids come last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

K1, B, DELTA, EPSILON = 1.5, 0.75, 1.0, 0.25
EMPTY = "_empty_"
#: Most (query, term) rows that one pass asks for; most cells (documents x tokens) and queries of a matrix in a task.
PASS, CELLS = 2_000_000, 8_000_000
ITEMS = 256
#: Most documents and tokens of a batch; (document, query) cells that are worth a task of their own; share of cells that a term
#: must have to be multiplied, and most such terms; how far single precision may be off, as a share.
ROWS, TOKENS = 4096, 2_000_000
TASK_CELLS = 400_000_000
HOT_SHARE, HOT = 0.002, 512
SLACK = 1e-4


def with_tokens(docs: DataFrame, tokens: Column) -> DataFrame:
    """Adds tokens; documents without any hold one mark, which counts in lengths and totals."""
    return docs.withColumn("tokens", F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(EMPTY))))


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, df, cf) of all terms: documents that have it, and its occurrences. Tasks add up before the one shuffle, on the term."""
    has = docs.select(F.explode(F.array_distinct("tokens")).alias("term"), F.lit(1).alias("d"), F.lit(0).alias("c"))
    all_ = docs.select(F.explode("tokens").alias("term"), F.lit(0).alias("d"), F.lit(1).alias("c"))
    return has.unionByName(all_).groupBy("term").agg(F.sum("d").alias("df"), F.sum("c").alias("cf"))


def query_terms(queries: DataFrame, tokens: Column, id_col: str = "item_id") -> DataFrame:
    """(id, term, qf): tokens that a query repeats count as often."""
    return queries.select(id_col, F.explode(tokens).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("qf"))


@dataclass
class Asked:
    """Queries of one pass: ids, terms, and postings (term, query, qf) in the order of terms."""

    ids: pa.Array
    terms: pa.Array
    term: np.ndarray
    query: np.ndarray
    qf: np.ndarray


def passes(terms: DataFrame, query_col: str) -> Iterator[Asked]:
    """The query set as passes of bounded size; a query's terms are all in one pass."""
    n = max(1, -(-terms.count() // PASS))
    for k in range(n):
        part = terms if n == 1 else terms.where(F.pmod(F.xxhash64(query_col), F.lit(n)) == k)
        each = part.groupBy(query_col).agg(F.collect_list(F.struct("term", F.col("qf").cast("double").alias("qf"))).alias("of"))  # a query's id comes once
        table = each.toArrow().combine_chunks()
        if table.num_rows:
            lists = table.column("of").combine_chunks()
            words = lists.flatten().field("term").dictionary_encode()
            term, query = words.indices.to_numpy(), np.repeat(np.arange(len(lists), dtype=np.int32), pc.list_value_length(lists).to_numpy())
            order = np.lexsort((query, term))
            yield Asked(table.column(query_col).combine_chunks(), words.dictionary, term[order], query[order], lists.flatten().field("qf").to_numpy()[order])


def _batches(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose documents times tokens, in the lists at column ``at``, stay within CELLS; or one document."""
    for b in batches:
        ends = b.column(at).offsets.to_numpy().astype(np.int64)
        start = 0
        while start < b.num_rows:
            cells = (ends[start + 1 :] - ends[start]) * np.arange(1, b.num_rows - start + 1)
            n = max(1, int(np.searchsorted(cells, CELLS, "right")))
            yield b.slice(start, n)
            start += n


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches of at most ROWS documents and TOKENS tokens, in the lists at column ``at``; or one document."""
    for b in batches:
        ends, start = b.column(at).offsets.to_numpy().astype(np.int64), 0
        while start < b.num_rows:
            n = max(1, min(ROWS, int(np.searchsorted(ends[start + 1 :], ends[start] + TOKENS, "right"))))
            yield b.slice(start, n)
            start += n


def _matched(lists: pa.ListArray, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences) of queried terms in each list, and the lists' lengths."""
    sizes = np.diff(lists.offsets.to_numpy())
    codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=terms), -1).to_numpy()
    rows = np.repeat(np.arange(len(sizes)), sizes)
    known = codes >= 0
    keys, tf = np.unique(rows[known].astype(np.int64) * len(terms) + codes[known], return_counts=True)
    return keys // len(terms), keys % len(terms), tf, sizes


def statistics(docs: DataFrame, asked: Asked) -> tuple[int, float, np.ndarray]:
    """(documents, mean length, document frequency of each asked term). A task returns one row for each term it has met."""
    shared = docs.sparkSession.sparkContext.broadcast(asked.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        df, n, tokens = np.zeros(len(terms), np.int64), 0, 0
        for b in _slices(batches, 0):
            _, term, _, sizes = _matched(b.column(0), terms)
            df += np.bincount(term, minlength=len(terms))
            n, tokens = n + len(sizes), tokens + int(sizes.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, some]), pa.array(np.r_[n, tokens, df[some]])], names=["term", "c"])

    found = {r["term"]: r["c"] for r in docs.select("tokens").mapInArrow(run, "term long, c long").groupBy("term").agg(F.sum("c").alias("c")).collect()}
    n, tokens = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(len(asked.terms))
    df[list(found)] = list(found.values())
    return n, tokens / n if n else 0.0, df


def plus_idf(n: int, df: np.ndarray) -> np.ndarray:
    return np.where(df > 0, np.log((n + 1) / np.maximum(df, 1)), 0.0)


def okapi_idf(docs: DataFrame, n: int, df: np.ndarray) -> np.ndarray:
    """Negative values are replaced by a share of the mean over all terms of the corpus, one aggregate over their frequencies."""
    each = docs.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    mean = each.agg(F.avg(F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("m")).first()["m"] or 0.0
    raw = np.log(n - df + 0.5) - np.log(df + 0.5)
    return np.where(df > 0, np.where(raw < 0, EPSILON * mean, raw), 0.0)


def search(docs: DataFrame, terms: DataFrame, plus: bool, k: int, query_col: str = "item_id", id_cols: tuple[str, ...] = ("doc_id",), group_col: str | None = None, allowed_col: str | None = None, routes: DataFrame | None = None) -> DataFrame:
    """(query, ids, group, score): rows of documents that share a term with the query, k of the best of each query and task at least.

    docs: id_cols (numbers), tokens, maybe a group and whether a document may be found (it counts in the statistics
    anyhow). With a group: k of the best of each query, group and task. Rows are ordered by scores
    rounded to 6 places, of equal ones the smaller ids come first; the scores themselves come back as they are. With plus, a term that a document lacks still counts delta * idf. With routes (query,
    id), a query that occurs there finds only documents that it is routed to.
    """
    spark, out = docs.sparkSession, None
    extra = [c for c in (group_col,) if c and c not in id_cols]
    columns = [*id_cols, *extra]
    kinds = {c: docs.schema[c].dataType.simpleString() for c in columns}
    query_kind = terms.schema[query_col].dataType
    schema = f"`{query_col}` {query_kind.simpleString()}, " + ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", score double"
    routed: set = set()
    if routes is not None:  # at most as many routed queries as queries, and so long lists of them
        routed = {r[0] for r in routes.select(query_col).distinct().collect()}
        by_doc = routes.groupBy(id_cols[0]).agg(F.collect_set(query_col).alias("__to"))
        docs = docs.join(by_doc, id_cols[0], "left")
    to = F.col("__to") if routes is not None else F.lit(None).cast(ArrayType(query_kind))
    given = docs.select(*columns, "tokens", (F.col(allowed_col) if allowed_col else F.lit(True)).alias("__may"), to.alias("__to"))
    at, may, ids_at = len(columns), len(columns) + 1, range(len(id_cols))
    for asked in passes(terms, query_col):
        n, mean, df = statistics(docs, asked)
        idf = plus_idf(n, df) if plus else okapi_idf(docs, n, df)
        base = np.bincount(asked.query, asked.qf * DELTA * idf[asked.term] * plus, len(asked.ids))
        shared = spark.sparkContext.broadcast((asked, idf, mean, base))
        if plus and group_col is None and routes is None:
            tasks = min(-(-n * len(asked.ids) // TASK_CELLS), 8 * spark.sparkContext.defaultParallelism)
            dealt = given.drop("__to").repartition(tasks) if tasks > 1 else given.drop("__to")
            found = _all_plus(dealt, shared, k, query_col, query_kind, id_cols, schema)
            out = found if out is None else out.unionByName(found)
            continue

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, idf, mean, base = shared.value
            words = asked.terms
            number = {x: k for k, x in enumerate(asked.ids.to_pylist())} if routed else {}
            free = np.ones(len(asked.ids), bool)
            free[[number[x] for x in routed if x in number]] = False
            first = np.searchsorted(asked.term, np.arange(len(words) + 1))
            for b in _batches(batches, at):
                row, term, tf, sizes = _matched(b.column(at), words)
                keep = b.column(may).to_numpy(zero_copy_only=False)[row]
                row, term, tf = row[keep], term[keep], tf[keep]
                if not len(row):
                    continue
                here, row = np.unique(row, return_inverse=True)
                there, term = np.unique(term, return_inverse=True)
                weight, has = np.zeros((len(here), len(there))), np.zeros((len(here), len(there)), np.float32)
                weight[row, term] = idf[there[term]] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[here[row]] / mean))
                has[row, term] = 1
                n_postings = first[there + 1] - first[there]
                local = np.repeat(np.arange(len(there)), n_postings)
                posting = np.repeat(first[there] - (np.cumsum(n_postings) - n_postings), n_postings) + np.arange(len(local))
                ids = [b.column(c).to_numpy(zero_copy_only=False)[here] for c in ids_at]
                group = np.unique(b.column(columns.index(group_col)).take(pa.array(here)).to_pandas().astype(str), return_inverse=True)[1] if group_col else np.zeros(len(here), int)
                reach = None
                if routed:  # which documents each query may find
                    reach = np.tile(free, (len(here), 1))
                    for d, items in enumerate(b.column(may + 1).take(pa.array(here)).to_pylist()):
                        reach[d, [number[x] for x in items or () if x in number]] = True
                for begin in range(0, len(asked.ids), ITEMS):
                    mine = (asked.query[posting] >= begin) & (asked.query[posting] < begin + ITEMS)
                    if not mine.any():
                        continue
                    table, told = np.zeros((len(there), ITEMS)), np.zeros((len(there), ITEMS), np.float32)
                    table[local[mine], asked.query[posting[mine]] - begin] = asked.qf[posting[mine]]
                    told[local[mine], asked.query[posting[mine]] - begin] = 1
                    met = has @ told > 0
                    if reach is not None:
                        met[:, : reach.shape[1] - begin] &= reach[:, begin : begin + ITEMS]
                    d, q = np.nonzero(met)
                    if not len(d):  # routes may leave none
                        continue
                    score = (weight @ table)[d, q] + base[np.minimum(begin + q, len(base) - 1)]
                    order = np.lexsort((*(i[d] for i in reversed(ids)), -np.round(score, 6), group[d], q))
                    d, q, score = d[order], q[order], score[order]
                    new = np.r_[True, (q[1:] != q[:-1]) | (group[d][1:] != group[d][:-1])]
                    nth = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
                    best = nth < k
                    d, q, score = pa.array(here[d[best]]), pa.array(q[best] + begin), score[best]
                    yield pa.RecordBatch.from_arrays([asked.ids.take(q), *(b.column(c).take(d) for c in range(len(columns))), pa.array(score)], names=[query_col, *columns, "score"])

        found = given.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _first_copies(ids: list[np.ndarray], row: np.ndarray, keys: np.ndarray, tf: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Whether each document is among the first k, by ids, of those with the same terms, occurrences and length: others can't be among the k best."""
    starts, kept, seen = np.searchsorted(row, np.arange(len(sizes) + 1)), np.zeros(len(sizes), bool), {}
    for d in np.lexsort(ids[::-1]):
        part = slice(starts[d], starts[d + 1])
        same = (keys[part].tobytes(), tf[part].tobytes(), int(sizes[d]))
        seen[same] = nth = seen.get(same, 0) + 1
        kept[d] = nth <= k
    return kept


def _best_first(rows: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of rows (query, ids, score) the k best of each query, in order."""
    query, *ids, score = rows
    order = np.lexsort((*reversed(ids), -np.round(score, 6), query))
    query = query[order]
    nth = np.arange(len(query)) - np.searchsorted(query, query)
    return [c[order[nth < k]] for c in rows]


def _all_plus(docs: DataFrame, shared, k: int, query_col: str, query_kind, id_cols: tuple[str, ...], schema: str) -> DataFrame:
    """The k best (query, ids, score) of each query, where all weights are positive. docs: ids, tokens, may."""
    at, n_ids = len(id_cols), len(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, idf, mean, base = shared.value
        n_terms, n_queries = len(asked.terms), len(asked.ids)
        order = np.lexsort((asked.term, asked.query))
        term_q, query_q, qf_q = asked.term[order], asked.query[order], asked.qf[order]
        first, askers = np.searchsorted(query_q, np.arange(n_queries + 1)), np.bincount(term_q, minlength=n_terms)
        least, best = np.zeros(n_queries), None  # what a query's k-th best row so far has without its base
        for b in _slices(batches, at):
            row, term, tf, sizes = _matched(b.column(at), asked.terms)
            ids = [b.column(c).to_numpy(zero_copy_only=False) for c in range(n_ids)]
            may = b.column(at + 1).to_numpy(zero_copy_only=False)[row]
            row, term, tf = row[may], term[may], tf[may]
            may = _first_copies(ids, row, term, tf, sizes, k)[row]
            row, term, tf = row[may], term[may], tf[may]
            weight, keys, n_docs = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[row] / mean)), row * n_terms + term, b.num_rows
            if not len(row):
                continue
            there = np.bincount(term, minlength=n_terms)
            hot = np.flatnonzero(there * askers > HOT_SHARE * n_docs * n_queries)
            if len(hot) > HOT:
                hot = hot[np.argsort(-(there * askers)[hot], kind="stable")[:HOT]]
            place = np.full(n_terms, -1)
            place[hot] = np.arange(len(hot))
            is_hot = place[term] >= 0
            dense = np.zeros((len(hot), n_docs), np.float32)
            dense[place[term[is_hot]], row[is_hot]] = weight[is_hot]
            there[hot] = 0
            start, rest = np.cumsum(there) - there, np.flatnonzero(~is_hot)
            rest = rest[np.argsort(term[rest], kind="stable")]
            rest_row, rest_weight = row[rest], weight[rest].astype(np.float32)
            new: list[list[np.ndarray]] = []
            for begin in range(0, n_queries, ITEMS):
                end = min(begin + ITEMS, n_queries)
                t, q, qf = (c[first[begin] : first[end]] for c in (term_q, query_q, qf_q))
                q, h = q - begin, place[t]
                table = np.zeros((end - begin, len(hot)), np.float32)
                table[q[h >= 0], h[h >= 0]] = qf[h >= 0]
                score = table @ dense
                few = there[t] > 0
                n = there[t[few]]
                posting = np.repeat(start[t[few]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                np.add.at(score.reshape(-1), np.repeat(q[few].astype(np.int64) * n_docs, n) + rest_row[posting], np.repeat(qf[few].astype(np.float32), n) * rest_weight[posting])
                top, bound = score.max(1), least[begin:end]
                near = np.flatnonzero((top > 0) & (top >= bound - SLACK * (1 + bound)))
                if not len(near):
                    continue
                score = score[near]
                nth = top[near] if k == 1 else np.partition(score, -k, 1)[:, -k] if k < n_docs else np.zeros(len(near))
                level = np.maximum(bound[near], nth)
                at_q, d = np.nonzero((score > 0) & (score >= (level - SLACK * (1 + level))[:, None]))
                at_q = near[at_q] + begin
                n = first[at_q + 1] - first[at_q]  # all terms of these queries, looked up in these documents
                pair = np.repeat(np.arange(len(d)), n)
                posting = np.repeat(first[at_q] - (np.cumsum(n) - n), n) + np.arange(len(pair))
                want = d[pair] * n_terms + term_q[posting]
                place_of = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                found = keys[place_of] == want
                exact = np.bincount(pair[found], qf_q[posting[found]] * weight[place_of[found]], len(d))
                new.append([at_q, *(i[d] for i in ids), exact + base[at_q]])
            if new:
                rows = [np.concatenate(c) for c in zip(*new)]
                best = _best_first(rows if best is None else [np.concatenate(c) for c in zip(best, rows)], k)
                last = np.flatnonzero(np.r_[best[0][1:] != best[0][:-1], True])
                last = last[np.bincount(best[0], minlength=n_queries)[best[0][last]] == k]
                least[best[0][last]] = best[-1][last] - base[best[0][last]]
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], names=["__q", *id_cols, "score"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([shared.value[0].ids.take(b.column(0)), *b.columns[1:]], names=[query_col, *id_cols, "score"])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_cols]
    found = docs.mapInArrow(run, ", ".join(["__q long", *kinds, "score double"]))
    return top_k(found, k, "__q", id_cols).drop("rank").mapInArrow(named, schema)


def top_k(scored: DataFrame, k: int, query_col: str = "item_id", id_col: str | tuple[str, ...] = "doc_id", score_col: str = "score", places: int = 6) -> DataFrame:
    """Adds rank (from 1) by rounded score, then id; keeps k a query. Spark cuts each task's rows to k before the shuffle."""
    ids = (id_col,) if isinstance(id_col, str) else id_col
    order = Window.partitionBy(query_col).orderBy(F.round(score_col, places).desc(), *ids)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def diversified(ranked: DataFrame, group_col: str, cap: int, k: int, query_col: str = "item_id") -> DataFrame:
    """The first ``cap`` hits of each group keep their order, the others come after them; then the first k."""
    nth = F.row_number().over(Window.partitionBy(query_col, group_col).orderBy("rank"))
    order = Window.partitionBy(query_col).orderBy(F.col("__nth") > cap, "rank")
    return ranked.withColumn("__nth", nth).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("__nth")


def diverse_top(scored: DataFrame, group_col: str, cap: int, k: int, query_col: str = "item_id", id_cols: tuple[str, ...] = ("doc_id",), score_col: str = "score") -> DataFrame:
    """diversified() over all of a query's scored rows, in the order of top_k(), without ranking them all.

    Among the k are at most k of a group's rows beyond its first ``cap``, so its best cap + k decide; Spark cuts each
    task's rows to those before the shuffle.
    """
    best = [F.round(score_col, 6).desc(), *id_cols]
    nth = F.row_number().over(Window.partitionBy(query_col, group_col).orderBy(*best))
    first = scored.withColumn("__nth", nth).where(F.col("__nth") <= cap + k)
    order = Window.partitionBy(query_col).orderBy(F.col("__nth") > cap, *best)
    return first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("__nth")


def router(descriptors: DataFrame, terms: DataFrame, share: float = 0.8, query_col: str = "item_id", group_col: str = "source") -> DataFrame:
    """Groups that a query's distinctive terms point to: (query, group, score) with score at least ``share`` of the best.

    descriptors: distinct (group, term). A term is distinctive if at most a third of the groups (one at least) have it.
    """
    n = descriptors.select(group_col).distinct().agg(F.count("*").alias("n"))
    df = descriptors.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n))
    weight = F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1
    rare = df.where((F.col("n") >= 2) & (F.col("df") <= F.greatest(F.lit(1), F.floor(F.col("n") / 3)))).select("term", weight.alias("w"))
    hits = terms.select(query_col, "term").join(rare, "term").join(descriptors, "term").groupBy(query_col, group_col).agg(F.sum("w").alias("score"))
    best = F.max("score").over(Window.partitionBy(query_col))
    return hits.withColumn("best", best).where((F.col("best") > 0) & (F.round("score", 6) >= F.round(share * F.col("best"), 6))).drop("best")

"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification, exact confirmation.

Documents with equal shingle sets form a class from the start. Signatures of classes are cut into bands; classes that
share a band are candidates. Their signatures are compared batch by batch, and a pair is dropped as soon as the
posterior probability that its similarity reaches the threshold falls under the chosen miss probability. What survives
is confirmed on the full sets of 64-bit shingle hashes.

A bucket's pairs are never listed. First its members are compared with one pivot each round, a number of pairs linear
in the members; the links found join most of a group of near copies into one component. Only buckets that still hold
several components go on, and there only pairs between different components count: members outside the bucket's
largest component are compared with all members in blocks, inside tasks, each pair in the first band it shares. Of the
pairs that survive, a task returns the few best for each member, and which members had more; once those are confirmed
and joined, members with more in buckets that are still divided are compared again, this time with their full sets in
the task, which confirms all surviving pairs between components and returns the links that join them. Links inside a
component can't change the result, so what is left out is exactly what needs no look.

Signatures are shuffled for classes that share a bucket only, which a bit table of fixed size tells the scan; tables of
signatures and sets are deleted as soon as nothing reads them. Classes are named by numbers.

Defined cases: texts that are null, empty or blank have no shingles and are linked with nothing (kept, each on its
own); texts with fewer words than a shingle have one shingle, the whole sequence; of rows that repeat id and words one
is kept; null ids come last in the order and never name a component that has another id; an empty table gives an empty
result; input columns besides the two named are neither read nor returned by ``groups``, and all returned unchanged by
``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BITS, bit_of, bit_table, documents, drop_table, materialize, renamed, spread_join, text_batches, text_or_empty, with_bit
from .components import components
from .exact_dedup import is_small


@dataclass(frozen=True)
class Rule:
    """Links sets with 100 * intersection >= percent * union."""

    words: int = 3
    percent: int = 85
    hashes: int = 100
    rows: int = 5
    batch: int = 20
    miss: float = 1e-6
    stars: int = 1
    block: int = 1024
    best: int = 4

    @property
    def bands(self) -> int:
        return self.hashes // self.rows


#: What stages take where no contract says otherwise. Chance that all bands miss a pair at the threshold: 2e-6, and 8e-6 for Rule().
FIVE_WORDS = Rule(words=5, percent=80, rows=4)

_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. bytes.lower and bytes.split know ASCII letters and white space only."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def _salts(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(1, 1 << 63, hashes, np.uint64) * _U(2) + _U(1), rng.integers(0, 1 << 63, hashes, np.uint64)


def signatures(sets: list[np.ndarray], rule: Rule) -> np.ndarray:
    """MinHash signatures (uint32) of non-empty sets, all at once."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), rule.hashes), np.uint32)
    for k, (a, b) in enumerate(zip(*_salts(rule.hashes))):
        out[:, k] = np.minimum.reduceat((flat * a + b) >> _U(32), starts)
    return out


def band_keys(sigs: np.ndarray, rule: Rule) -> np.ndarray:
    """One key for each band; keys of different bands never meet but by chance."""
    parts = sigs[:, : rule.bands * rule.rows].reshape(len(sigs), rule.bands, rule.rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, rule.bands + 1, dtype=np.uint64), (len(sigs), rule.bands)).copy()
    for k in range(rule.rows):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def least_matches(rule: Rule) -> list[tuple[int, int]]:
    """(hashes compared, matches needed to go on) after each batch.

    Uniform prior: after m matches in n the similarity is Beta(m + 1, n - m + 1); below the needed m, the chance that it
    reaches the threshold is under ``miss``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    above, out = s >= rule.percent / 100, []
    for n in range(rule.batch, rule.hashes + 1, rule.batch):
        for m in range(n + 1):
            logs = m * np.log(s) + (n - m) * np.log1p(-s)
            density = np.exp(logs - logs.max())
            if density[above].sum() / density.sum() >= rule.miss:
                break
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, rule: Rule, plan: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the row pairs (a[i], b[i]) of signatures that no batch has pruned."""
    left, matches, before = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, needed in plan:
        matches = matches + (a[left, before:n] == b[left, before:n]).sum(1)
        keep = matches >= needed
        left, matches, before = left[keep], matches[keep], n
    return left


def sketches(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """(id, n, fp, sig, keys) of every row; fp, sig and keys are null without shingles. Narrow: one pass over the scan."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, 200):
            sets = [shingle_set(t, rule.words) for t in b.column(1).to_pylist()]
            full = [k for k, s in enumerate(sets) if len(s)]
            fp, sig, keys = ([None] * len(sets) for _ in range(3))
            if full:
                sigs = signatures([sets[k] for k in full], rule)
                for k, one, bands in zip(full, sigs, band_keys(sigs, rule)):
                    fp[k], sig[k], keys[k] = _digest(sets[k].tobytes()), one.tobytes(), bands
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, pa.array(fp, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "fp", "sig", "keys"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).mapInArrow(run, f"id {kind}, n long, fp binary, sig binary, keys array<long>")


def class_table(sketch: DataFrame) -> DataFrame:
    """(cls, fp, rep, size, n, sig, keys): classes of equal sets with a number, their smallest id and the number of their rows.

    A bit table of the digests that recur tells the scan which rows are open; all others are classes as they stand and
    aren't shuffled. Once written, the numbers are fixed; what follows names classes by them.
    """
    full = sketch.where("fp is not null")
    again = materialize(bit_table(full.groupBy("fp").count().where("count > 1"), bit_of("fp")), "near-again")
    marked = with_bit(full, again, "again", "fp")
    alone = marked.where("not again").select("fp", F.col("id").alias("rep"), F.lit(1).cast("long").alias("size"), "n", "sig", "keys")
    shared = marked.where("again").groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"), F.any_value("keys").alias("keys"))
    return alone.unionByName(shared).select(F.monotonically_increasing_id().alias("cls"), "*")


def sharing(classes: DataFrame, shared: DataFrame) -> DataFrame:
    """(cls, fp, rep, n, sig, keys) of the classes that may be in a bucket with others, with the keys of those buckets only.

    The scan asks a bit table of fixed size for each key, so a class without such keys goes nowhere. A bit that another
    key has set keeps a key in vain, which the join with the buckets drops.
    """
    table = bytearray(BITS // 8)
    for bucket, bits in bit_table(shared, F.pmod("key", F.lit(BITS))).toLocalIterator():
        table[(bucket - 1) * len(bits) : bucket * len(bits)] = bits
    sent = classes.sparkSession.sparkContext.broadcast(bytes(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(5).flatten().to_numpy().reshape(b.num_rows, -1)
            at = keys & (BITS - 1)
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            some = np.flatnonzero(hit.any(1))
            kept = pa.ListArray.from_arrays(np.r_[0, np.cumsum(hit[some].sum(1))].astype(np.int32), pa.array(keys[hit]))
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(some)) for k in range(5)), kept], names=["cls", "fp", "rep", "n", "sig", "keys"])

    wide = classes.select("cls", "fp", "rep", "n", "sig", "keys")
    out = materialize(wide.mapInArrow(run, wide.schema), "sharing")
    sent.destroy()
    return out


def _matrix(column: pa.Array, rule: Rule) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), rule.hashes)


def prune(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Of pairs (a, b) of classes, those whose sizes and signatures leave the threshold possible."""
    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("na", "nb") >= rule.percent * F.greatest("na", "nb"))

    plan = least_matches(rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                kept = survivors(_matrix(x.column(2), rule), _matrix(x.column(3), rule), rule, plan)
                yield pa.RecordBatch.from_arrays([x.column(0).take(pa.array(kept)), x.column(1).take(pa.array(kept))], names=["a", "b"])

    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _linked(a: np.ndarray, b: np.ndarray, rule: Rule) -> bool:
    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * both >= rule.percent * (len(a) + len(b) - both)


def full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """(cls, s): the full sets of the classes in wanted.

    Made once from one document of each class; a document whose set isn't the class's is passed over (rows may share an
    id). Where the ids are too many to broadcast, a bit table of them picks the texts that are shuffled.
    """
    wanted = materialize(wanted.distinct().join(classes.select("cls", "fp", "rep"), "cls"), "wanted")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    if is_small(wanted):
        near = F.broadcast(wanted)
    else:
        texts, near = with_bit(texts, materialize(bit_table(wanted, bit_of("rep")), "wanted-bits"), "wanted", "id").where("wanted").drop("wanted"), wanted
    texts = texts.join(near, F.col("id").eqNullSafe(F.col("rep"))).select("cls", "fp", "t")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, 200):
            out = []
            for cls, fp, t in zip(*(b.column(k).to_pylist() for k in range(3))):
                raw = shingle_set(t, rule.words).tobytes()
                if _digest(raw) == fp:
                    out.append((cls, raw))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.binary()))], names=["cls", "s"])

    return materialize(texts.mapInArrow(make, "cls long, s binary"), "sets")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """Of pairs (a, b) of classes, those whose full sets are linked."""
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("cls")), classes, docs, rule, id_col, text_col)
    side = lambda x: sets.select(F.col("cls").alias(x), F.col("s").alias(f"s{x}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in text_batches(batches, 500):
            sides = zip(x.column(2).to_pylist(), x.column(3).to_pylist())
            at = pa.array([k for k, (a, b) in enumerate(sides) if _linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), rule)], pa.int64())
            yield pa.RecordBatch.from_arrays([x.column(0).take(at), x.column(1).take(at)], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    confirmed = materialize(both.mapInArrow(check, "a long, b long"), "confirmed")
    drop_table(sets)
    return confirmed


def _blocks(members: DataFrame, rule: Rule) -> DataFrame:
    """(key, cls, comp, n, carried..., u, v, i, j) of undecided buckets, dealt into block pairs.

    Members outside the bucket's largest component form side u, all members side v; each side is cut into blocks by a
    hash, and each block goes to the tasks of all blocks of the other side. A member of both sides of a block pair goes
    there once.
    """
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("c"))
    per = sizes.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m"))
    sided = members.join(per, "key").withColumn("outside", F.col("comp") != F.col("top.comp"))
    cut = lambda c: F.greatest(F.lit(1), F.ceil(c / rule.block)).cast("int")
    sided = sided.withColumn("nu", cut(F.col("m") - F.col("top.c"))).withColumn("nv", cut(F.col("m")))
    spread = lambda c: F.pmod(F.xxhash64("cls", "key"), c).cast("int")
    sided = sided.withColumn("iu", spread(F.col("nu"))).withColumn("jv", spread(F.col("nv")))
    carried = [c for c in members.columns if c not in ("key", "cls", "comp", "n")]
    side = lambda rows, u, v: rows.select("key", "cls", "comp", "n", *carried, u.alias("u"), v.alias("v"), "i", "j")
    us = sided.where("outside").withColumn("i", F.col("iu")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)))
    vs = sided.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nu") - 1))).withColumn("j", F.col("jv")).where("not outside or i <> iu")
    return side(us, F.lit(True), F.col("j") == F.col("jv")).unionByName(side(vs, F.lit(False), F.lit(True)))


class _Joined:
    """Union-find over row numbers."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x


def _across(rule: Rule, exact: bool):
    """Compares the two sides of each block pair. Rows come sorted by (key, i, j); a block pair may span batches.

    Rows out are (key, a, b). Not exact: the best surviving pairs of each member outside, and (key, a, null) for each
    member of a surviving pair that isn't among them. Exact, with sets in the rows: confirmed links between components, as many as join them.
    """
    plan, step = least_matches(rule), 20_000

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, i, j = (rows.column(c).to_numpy() for c in ("key", "i", "j"))
        sides, n = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v")], rows.column("n").to_numpy()
        comp = rows.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        sig, cls = _matrix(rows.column("sig"), rule), rows.column("cls").combine_chunks()
        keys = band_keys(sig, rule)
        sets = rows.column("s") if exact else None
        ends = np.r_[np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1, len(key)]
        left, right, waiting = [], [], 0

        def batch(a: np.ndarray, b: np.ndarray | None, at: np.ndarray) -> pa.RecordBatch:
            other = pa.nulls(len(a), pa.int64()) if b is None else cls.take(pa.array(b))
            return pa.RecordBatch.from_arrays([pa.array(key[at]), cls.take(pa.array(a)), other], names=["key", "a", "b"])

        def flush() -> Iterator[pa.RecordBatch]:
            a, b = np.concatenate(left), np.concatenate(right)
            kept = survivors(sig[a], sig[b], rule, plan)
            a, b = a[kept], b[kept]
            shared = keys[a] == keys[b]  # the pair belongs to the first band that it shares
            mine = keys[a, shared.argmax(1)] == key[a]
            a, b = a[mine], b[mine]
            order = np.lexsort((-(sig[a] == sig[b]).sum(1), a)) if len(a) else np.zeros(0, int)
            a, b = a[order], b[order]
            if not exact:
                nth = np.arange(len(a)) - np.maximum.accumulate(np.where(np.r_[True, a[1:] != a[:-1]], np.arange(len(a)), 0)) if len(a) else order
                few = nth < rule.best
                yield batch(a[few], b[few], a[few])
                more = np.unique(np.r_[a[~few], b[~few]])
                yield batch(more, None, more)
                return
            joined, made, known = _Joined(), [], {}
            for x, y in zip(a.tolist(), b.tolist()):
                p, q = joined.root(int(comp[x])), joined.root(int(comp[y]))
                if p == q:
                    continue
                for r in (x, y):
                    if r not in known:
                        known[r] = np.frombuffer(sets[r].as_py(), np.uint64)
                if _linked(known[x], known[y], rule):
                    joined.up[p] = q
                    made.append((x, y))
            if made:
                x, y = np.array(made).T
                yield batch(x, y, x)

        for start, end in zip(np.r_[0, ends[:-1]], ends):
            us, vs = (start + np.flatnonzero(x[start:end]) for x in sides)
            for k in range(0, len(us), max(1, step // max(1, len(vs)))):
                part = us[k : k + max(1, step // max(1, len(vs)))]
                a, b = np.repeat(part, len(vs)), np.tile(vs, len(part))
                keep = (comp[a] != comp[b]) & (100 * np.minimum(n[a], n[b]) >= rule.percent * np.maximum(n[a], n[b]))
                left.append(a[keep])
                right.append(b[keep])
                waiting += int(keep.sum())
                if waiting >= step:
                    yield from flush()
                    left, right, waiting = [], [], 0
        if waiting:
            yield from flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for b in batches:
            if not b.num_rows:
                continue
            rows = pa.Table.from_batches([b]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([b])])
            at = [rows.column(c).to_numpy() for c in ("key", "i", "j")]
            last = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in at]))
            cut = int(last[-1]) + 1 if len(last) else 0
            carry = rows.slice(cut)
            if cut:
                yield from compare(rows.slice(0, cut))
        if carry is not None:
            yield from compare(carry)

    return run


def _compared(members: DataFrame, rule: Rule, exact: bool, name: str) -> DataFrame:
    blocks = _blocks(members, rule).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return materialize(blocks.mapInArrow(_across(rule, exact), "key long, a long, b long"), name)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _with_components(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Adds each member's component and keeps the buckets that hold several."""
    named = members.join(comps.select(F.col("a").alias("cls"), F.col("b").alias("c")), "cls", "left").select("key", "cls", F.coalesce("c", "cls").alias("comp"))
    several = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    return named.join(several, "key", "left_semi")


def links(docs: DataFrame, wide: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """Components of classes: (a, b) as components() gives them. The table of classes is dropped as soon as those that share a bucket are known."""
    banded = wide.select(F.explode("keys").alias("key"))
    shared = materialize(banded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    classes = sharing(wide, shared)
    drop_table(wide)
    members = materialize(spread_join(classes.select("cls", F.explode("keys").alias("key")), shared, ["key"], "m").select("key", "cls"), "members")
    light = classes.select("cls", "n", "sig")
    comps, open_ = None, members.withColumn("comp", F.col("cls"))
    for k in range(rule.stars):
        least = F.min_by("cls", F.xxhash64("cls", F.lit(k))).alias("pivot")
        pool = open_
        if k:  # the pivot of a later round comes from outside the bucket's largest component
            sizes = open_.groupBy("key", "comp").count()
            top = sizes.groupBy("key").agg(F.max_by("comp", F.struct("count", "comp")).alias("top"))
            pool = open_.join(top, "key").where("comp <> top")
        pivots = materialize(pool.groupBy("key").agg(least), "pivots")  # a table of its own: a skewed join without a grouping can be split
        pairs = _ordered(open_.join(pivots, "key").select(F.col("cls").alias("a"), F.col("pivot").alias("b")))
        kept = materialize(prune(pairs, light, rule), "survivors")
        comps = _joined_by(comps, confirm(kept, classes, docs, rule, id_col, text_col))
        open_ = materialize(_with_components(members, comps), "open")
        if open_.isEmpty():
            return comps
    near = _compared(open_.join(light, "cls"), rule, False, "near")
    best = materialize(_ordered(near.where("b is not null")), "best")
    comps = _joined_by(comps, confirm(best, classes, docs, rule, id_col, text_col))
    flagged = near.where("b is null").select("key", F.col("a").alias("cls")).distinct()
    open_ = materialize(_with_components(flagged, comps), "open")
    if not open_.isEmpty():
        sets = full_sets(open_.select("cls"), classes, docs, rule, id_col, text_col)
        more = _compared(open_.join(light, "cls").join(sets.dropDuplicates(["cls"]), "cls"), rule, True, "rest")
        drop_table(sets)
        comps = _joined_by(comps, more.select("a", "b"))
    return comps


def _joined_by(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links."""
    if comps is None:
        return components(links)
    return comps if links.isEmpty() else components(comps.unionByName(links))


def groups(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row for each input row."""
    sketch = materialize(sketches(docs, rule, id_col, text_col), "sketch")
    wide = materialize(class_table(sketch), "classes")
    rows = materialize(sketch.groupBy("id", "n", "fp").agg(F.count("*").cast("int").alias("m")), "near-rows")
    classes = materialize(wide.select("cls", "fp", "rep", "size"), "class-names")
    drop_table(sketch)  # signatures are held once, and only until it is known which of them are needed
    comps = links(docs, wide, rule, id_col, text_col)
    named = classes.join(comps.select(F.col("a").alias("cls"), F.col("b").alias("root")), "cls", "left").select("fp", "rep", "size", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    sized = materialize(named.join(least, "root").select("fp", "component_id", "size"), "of-class")
    joined = spread_join(rows, sized, ["fp"], "size", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("m"))))
    component = F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component_id"))
    kept = F.col("fp").isNull() | (F.col("id").eqNullSafe(component) & (F.col("copy") == 1))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def deduplicate(docs: DataFrame, rule: Rule = FIVE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: one document of each component.

    An id stays if one of its rows does; where an id repeats, rows that repeat id and text are reduced to one.
    """
    columns, plain = docs.columns, renamed(docs)
    id_, text = plain.columns[columns.index(id_col)], plain.columns[columns.index(text_col)]
    decided = materialize(groups(plain, rule, id_, text).groupBy(F.col(id_).alias("__id")).agg(F.max("kept").alias("__stays"), F.count("*").alias("__m")), "near-decided")
    left = _without(plain, decided.where("not __stays").select("__id"), id_)
    return (left.dropDuplicates([id_, text]) if not decided.where("__stays and __m > 1").isEmpty() else left).toDF(*columns)


def _without(rows: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id isn't in gone. Where that is too long to broadcast, only rows whose bit it sets are shuffled."""
    here = F.col(id_col).eqNullSafe(F.col("__id"))
    if is_small(gone):
        return rows.join(F.broadcast(gone), here, "left_anti")
    marked = with_bit(rows, materialize(bit_table(gone, bit_of("__id")), "gone-bits"), "__marked", id_col)
    return marked.where("not __marked").unionByName(marked.where("__marked").join(gone, here, "left_anti")).select(*rows.columns)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir))


ORACLE_SQL = None

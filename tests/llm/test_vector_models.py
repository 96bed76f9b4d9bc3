"""Whitening and vector codes against plain numpy, on odd rows too."""

import collections
import hashlib

import numpy as np
import pytest

from quarrylight.llm import vector_codes, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, n int, v string, x string, code string, error double, i int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "v", "x", "c", 0.5, 2) for i, v, label in rows], SCHEMA)


def kept(rows):
    return [(i, v, label) for i, v, label in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]


def odd_rows(width, n=300, seed=4):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(width, width)) / 4
    rows = [(int(k), [float(c) for c in rng.normal(size=width) @ mix], int(rng.integers(0, 3)) if k % 7 else None) for k in range(n)]
    rows += [(n + k, rows[5][1], 1) for k in range(n // 2)]  # one vector holds a third of all rows
    rows += [(3, rows[9][1], 2), (None, rows[8][1], None), (n * 2, None, 1), (n * 2 + 1, [None] * width, 1), (n * 2 + 2, [float("nan")] * width, 1), (n * 2 + 3, [float("inf")] + [0.0] * (width - 1), None)]
    return rows + [(n * 2 + 4, [], 0), (n * 2 + 5, [0.25], 0), (n * 2 + 6, [-0.0] * width, 0)]


def whole(vectors, width):
    return np.array([[int(np.floor(256 * c)) for c in v] + [0] * (width - len(v)) for v in vectors], np.int64).reshape(-1, width)


def test_whitening_matches_plain_eigenvectors(spark):
    rows = odd_rows(12)
    good = kept(rows)
    x = whole([v for _, v, _ in good], 12)
    listed = np.unique(x, axis=0)
    n, s = len(listed), listed.sum(0)
    c = listed - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    got = collections.defaultdict(list)
    for r in whitening.whiten(frame(spark, rows).repartition(7)).collect():
        got[r.vec_id, r.deviation].append(r)
    want = collections.Counter((good[k][0], int(((n * x[k] - s) ** 2).sum())) for k in range(len(good)))
    assert {k: len(v) for k, v in got.items()} == {k: 4 * v for k, v in want.items()}
    scores = (x - s / n) @ vectors / np.sqrt(values)
    for k, (vec_id, _, _) in enumerate(good):
        for r in got[vec_id, int(((n * x[k] - s) ** 2).sum())]:
            assert r.n == n and abs(abs(r.whitened) - abs(scores[k, r.component - 1])) < 1e-9
            assert abs(r.explained - values[r.component - 1] / (c * c).sum() * n) < 1e-12 and r.identity_error < 1e-9
    one = {r.component: r.whitened for r in got[0, int(((n * x[0] - s) ** 2).sum())]}
    two = {r.component: r.whitened for r in got[1, int(((n * x[1] - s) ** 2).sum())]}
    for j in range(4):  # one sign for all rows
        assert np.sign(one[j + 1] * two[j + 1]) == np.sign(scores[0, j] * scores[1, j])


def test_whitening_of_degenerate_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 1), (2, [], 1)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0], 1)] * 3)).count() == 0
    got = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (2, [2.0, 4.0], 1)])).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in got) == [(1, 1, 2), (2, 1, 2), (2, 1, 2)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12 for r in got)
    big = whitening.whiten(frame(spark, [(1, [1e300, 2.0], 1), (2, [-1e300, 4.0], 1), (3, [3e8, 1.0], 1)])).collect()
    assert {r.vec_id: r.deviation for r in big if r.component == 1}[1] is None and len(big) >= 3


@pytest.mark.parametrize("width", [1, 2, 5, 40])
def test_eigenvalues_keep_small_ones(width):
    rng = np.random.default_rng(width)
    a = rng.normal(size=(400, width)) * 10.0 ** -np.arange(width).clip(0, 5)
    values, vectors = whitening.eigen(a.T @ a)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(values, want, rtol=1e-6, atol=0) and np.abs(vectors.T @ vectors - np.eye(width)).max() < 1e-12
    order, low = whitening.pivoted_cholesky(a.T @ a)
    assert np.allclose(low @ low.T, (a.T @ a)[order][:, order], rtol=1e-12) and (np.diff(low.diagonal()) <= 1e-12).all()


def plain_codes(rows, width, parts=16, entries=64):
    good = sorted(kept(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    full = max(1, -(-width // parts)) * parts
    x = whole([v for _, v, _ in good], full).reshape(len(good), parts, full // parts)
    books = x[:entries].transpose(1, 0, 2).copy()
    nearest = lambda k: ((x[:, k, None] - books[k][None]) ** 2).sum(2)
    for _ in range(2):
        for k in range(parts):
            to = nearest(k).argmin(1)
            for e in set(to.tolist()):
                books[k, e] = np.floor_divide(x[to == e, k].sum(0), (to == e).sum())
    codes, errors = [""] * len(good), np.zeros(len(good), np.int64)
    for k in range(parts):
        d = nearest(k)
        codes = [c + f"{e:02x}" for c, e in zip(codes, d.argmin(1))]
        errors += d.min(1)
    by_label = collections.Counter()
    for (_, _, label), e in zip(good, errors):
        by_label[label] += int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return collections.Counter((i, c, int(e), by_label[label], digest) for (i, _, label), c, e in zip(good, codes, errors))


@pytest.mark.parametrize("width,n", [(64, 400), (18, 120), (16, 20)])
def test_codes_match_a_plain_search(spark, width, n):
    rows = odd_rows(width, n)
    got = collections.Counter(tuple(r) for r in vector_codes.vector_codes(frame(spark, rows).repartition(5), block=100, leaf=6).collect())
    assert got == plain_codes(rows, width)


def test_codes_of_small_and_empty_tables(spark):
    assert vector_codes.vector_codes(frame(spark, [])).count() == 0
    rows = [(1, [1.0] * 16, None), (2, [1.0] * 16, None), (3, [-1.0] * 16, 1), (4, [], 1), (5, None, 1)]
    assert collections.Counter(tuple(r) for r in vector_codes.vector_codes(frame(spark, rows)).collect()) == plain_codes(rows, 16)
    rows = [(1, [], None), (2, [], 3)]
    assert collections.Counter(tuple(r) for r in vector_codes.vector_codes(frame(spark, rows)).collect()) == plain_codes(rows, 0)


def test_trees_give_the_nearest_entries_and_their_sums():
    rng = np.random.default_rng(8)
    for case in range(20):
        q, n = int(rng.integers(1, 6)), int(rng.integers(1, 700))
        x = rng.integers(-40, 40, (n, q)) if case % 3 else rng.integers(-2, 2, (n, q))
        x = x * 3_000_000 if case % 5 == 0 else x
        e = x[rng.integers(0, n, min(n, 64))]
        tree = vector_codes.build_tree(x, leaf=int(rng.integers(1, 50)))
        entry, sums, counts = vector_codes.owners(tree, e)
        want = ((x[:, None] - e[None]) ** 2).sum(2).argmin(1)
        total = np.zeros_like(e)
        np.add.at(total, want, x)
        assert (entry[tree.row_of] == want).all() and (sums == total).all() and (counts == np.bincount(want, minlength=len(e))).all()
        assert (tree.weight[tree.left >= 0] == tree.weight[tree.left[tree.left >= 0]] + tree.weight[tree.right[tree.left >= 0]]).all()


def test_most_balls_are_owned_before_their_leaves():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (64, 4))
    x = centres[rng.integers(0, 64, 4096)] + rng.integers(-20, 20, (4096, 4))
    tree, seen = vector_codes.build_tree(x), []
    tree.left = np.where(tree.left < 0, -1, tree.left)

    class Counted(np.ndarray):
        def __getitem__(self, key):
            seen.append(key) if isinstance(key, slice) else None
            return super().__getitem__(key)

    tree.points = tree.points.view(Counted)
    vector_codes.owners(tree, centres)
    assert sum(k.stop - k.start for k in seen) < 0.5 * len(tree.points)

"""Vector links where nearly every vector has a label of its own."""

import collections

from quarrylight.llm import vector_links


def test_labels_of_one_vector_each(spark):
    rows = [(k, [1.0, 0.001 * (k % 7)], f"label{k}") for k in range(12_000)] + [(12_000, [1.0, 0.5], "label5"), (12_001, [1.0, 0.0051], "label5")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").coalesce(2)
    got = {r.vec_id: r for r in vector_links.link_vectors(vectors, 0.93).where("n_links > 0").collect()}
    assert {k: (r.n_links, r.component_id) for k, r in got.items()} == {5: (1, 5), 12_001: (1, 5)}


def test_more_labels_than_a_partition_once_had_numbers(spark):
    """16,000 labels in three partitions, some with links inside; and ids that repeat with other vectors and labels."""
    rows = [(k, [1.0, 0.001 * (k % 7), 0.0], k) for k in range(16_000)]
    rows += [(20_000 + k, [1.0, 0.001 * (k % 7), 0.01 * (k % 3)], k) for k in range(0, 16_000, 4)]
    rows += [(5, [0.0, 1.0, 0.0], 1), (30_000, [0.0, 1.0, 0.01], 1), (30_001, [0.0, 1.0, 0.02], 2), (5, [0.0, 1.0, 0.0], 2), (30_002, [0.0, 1.0, 0.03], 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(3)
    got = collections.Counter((r.vec_id, r.n_links, r.component_id) for r in vector_links.link_vectors(vectors, 0.93).collect())
    want = collections.Counter((k, int(k % 4 == 0), k) for k in range(16_000)) + collections.Counter((20_000 + k, 1, k) for k in range(0, 16_000, 4))
    want += collections.Counter([(5, 1, 5), (30_000, 1, 5), (30_001, 2, 5), (5, 2, 5), (30_002, 2, 5)])
    assert got == want

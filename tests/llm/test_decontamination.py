"""Decontamination against a plain search for every window, on odd rows, short items and hot passages."""

import collections
import hashlib
import random
import re

from pyspark.sql import functions as F

from quarrylight.llm import decontamination

CLASH = "doc_id long, text string, row long, n int, at int, window string, bucket long, bits long, item string, k string"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words_of(text)
        n = min(width, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[at : at + n])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return collections.Counter(out)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 7, 8, 9, "w", 1, 2, "i", "k") for i, t in docs], CLASH)
    b = spark.createDataFrame(items, "item_id long, text string")
    return collections.Counter(tuple(r) for r in decontamination.contamination(d, b, **kw).collect())


def test_odd_rows_match_a_plain_search(spark):
    rng = random.Random(3)
    vocabulary = ["a", "B", "été", "日本", "x1", "İ", "É", "the", "of"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "_", "--"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 3, 5, 8, 9, 10, 11, 30]))) for k in range(40)] + [(3, text(12)), (None, text(15)), (None, None), (99, ""), (100, " .,")]
    docs = [(k, text(rng.randint(0, 60)) + (rng.choice(items)[1] or "") + " " + text(rng.randint(0, 5))) for k in range(60)]
    docs += [(None, None), (7, ""), (7, " -- "), (8, items[0][1]), (8, items[0][1]), (9, "a " * 3000), (10, "A" * 50_000)]
    assert run(spark, docs, items) == brute(docs, items)
    long_items = [(k, t) for k, t in items if len(words_of(t)) >= 10]
    assert run(spark, docs, long_items) == brute(docs, long_items)
    assert run(spark, docs, long_items, width=4, kgram=2) == brute(docs, long_items, 4)


def test_empty_tables(spark):
    docs = [(1, "some words here"), (2, None)]
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, docs, [(1, None)]) == brute(docs, [])
    assert run(spark, [], [(1, "some words")]) == collections.Counter()


def test_a_passage_of_many_items_in_many_documents(spark):
    shared = "one passage that a third of all rows and all items hold in common here"
    items = [(k, f"{shared} and item {k}") for k in range(300)]
    docs = [(k, f"document {k} {shared if k % 3 else 'nothing'} ends {k}") for k in range(3000)]
    got = run(spark, docs, items)
    assert got == brute(docs, items)


def test_no_python_runs_on_executors(spark, sf):
    plan = decontamination.op11_decontamination(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    passed = decontamination.contamination(spark.range(5).select(F.col("id").alias("doc_id"), F.lit("w").alias("text")), spark.createDataFrame([], "item_id long, text string"))
    assert passed.count() == 5

"""Search over whole passages and whole rankings, on small tables."""

import math
import random
from collections import Counter

import pytest

from quarrylight.jobs import search
from quarrylight.operators import lexical

ASKED = " ".join(f"w{k}" for k in range(1, 15))


def tables(spark, path, docs, passages):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def long_passage(spark, tmp_path_factory):
    docs = [(1, "w1 w2 other", "en", "a"), (2, "w13 w14 w14", "en", "b"), (3, "w14 more words here", "en", "c"), (4, "nothing", "en", "d"), (5, ASKED.replace("w14", "x"), "en", "a"), (6, "", "en", "e")]
    return docs, tables(spark, tmp_path_factory.mktemp("long"), docs, [ASKED, "w1 w1 w14"])


def test_all_tokens_of_a_passage_are_asked(spark, long_passage):
    docs, sf = long_passage
    tokens = {d: t.split() or ["_empty_"] for d, t, *_ in docs}
    df, mean = Counter(t for ts in tokens.values() for t in set(ts)), sum(map(len, tokens.values())) / len(tokens)
    want = set()
    for item, passage in enumerate((ASKED, "w1 w1 w14")):
        asked = [t for t in passage.split() if t in df]
        idf = {t: math.log((len(tokens) + 1) / df[t]) for t in asked}
        for d, ts in tokens.items():
            if set(ts) & set(asked):
                want.add((item, d, round(sum(idf[t] * (1 + ts.count(t) * 2.5 / (ts.count(t) + 1.5 * (0.25 + 0.75 * len(ts) / mean))) for t in asked), 6)))
    assert {(r.item_id, r.doc_id, r.score) for r in search.bm25_plus_topk(spark, sf).collect()} == want


def test_later_terms_count_in_routes_and_hits(spark, long_passage):
    _, sf = long_passage
    hits = {r.item_id: r.hit for r in search.eval_term_hit(spark, sf).collect()}
    assert hits == {0: False, 1: False}
    assert {r.doc_id for r in search.bm25_okapi_topk(spark, sf).where("item_id = 0").collect()} == {1, 2, 3, 5}
    assert {r.doc_id for r in search.routed_bm25_topk(spark, sf).where("item_id = 0").collect()} == {1, 2, 3, 5}


def test_router_sees_later_terms(spark, tmp_path):
    titles = ("plain words", "w14 words", "plain text", "some text", "some other", "more")
    sf = tables(spark, tmp_path, [(1, "x", "en", "a")], [ASKED])
    spark.createDataFrame([(k, f"http://h/{k}", f"<title>{t}</title><p>w1 body of {t}") for k, t in enumerate(titles)], "page_id long, url string, html string").write.parquet(f"{sf}/pages.parquet")
    assert [r.page_id for r in search.doc_router(spark, sf).collect()] == [1]
    assert [r.page_id for r in search.lexical_search(spark, sf).collect()] == [1]


def test_no_group_fills_the_places_of_others(spark, tmp_path):
    docs = [(k, "w1 " * 40 + "pad " * k, "en", "hot") for k in range(1, 31)] + [(k, "w1 " + "pad " * 30 * k, "en", f"s{k}") for k in (50, 51, 52)]
    sf = tables(spark, tmp_path / "a", docs, ["w1"])
    got = search.diversified_topk(spark, sf).orderBy("place").collect()
    assert [r.doc_id for r in got] == [1, 2, 50, 51, 52, 3] and [r.place for r in got] == [1, 2, 3, 4, 5, 6]
    docs = [(1, "\n".join("w1 w1 w1 w1" for _ in range(500)), "en", "a"), (2, "w1 " + "pad " * 80, "en", "a"), (3, "w1 " + "pad " * 90, "en", "a"), (4, "pad", "en", "a")]
    got = search.product_search(spark, tables(spark, tmp_path / "b", docs, ["w1"])).orderBy("place").collect()
    assert [r.doc_id for r in got] == [1, 1, 2, 3, 1, 1]


def test_passes_blocks_and_slices_change_nothing(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    docs = [(k, [rng.choice(words) for _ in range(rng.randint(1, 30))], f"s{k % 4}", k % 3 != 0) for k in range(300)]
    docs = spark.createDataFrame(docs, "doc_id long, tokens array<string>, source string, may boolean").repartition(3)
    asked = [(q, t, 1 + len(t) % 2) for q in range(11) for t in sorted({rng.choice(words) for _ in range(6)})]
    terms = spark.createDataFrame([*asked, (50, "unknown", 1)], "item_id long, term string, qf long")
    routes = spark.createDataFrame([(q, d) for q in (1, 2) for d in range(0, 300, 7)], "item_id long, doc_id long")

    plain = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)  # noqa: E731  scores come back unrounded

    def everything():
        out = []
        for plus in (True, False):
            found = lexical.search(docs, terms, plus, 5, group_col="source", allowed_col="may")
            out.append(plain(lexical.diverse_top(found, "source", 2, 3).collect()))
            out.append(plain(lexical.top_k(lexical.search(docs, terms, plus, 4, routes=routes), 4).collect()))
        return out

    whole = everything()
    assert {r[1] for r in whole[1] if r[0] in (1, 2)} <= set(range(0, 300, 7)) and all(r[1] % 3 for r in whole[0]) and {r[0] for r in whole[1]} == set(range(11))
    for name, value in (("PASS", 20), ("ITEMS", 3), ("CELLS", 60)):
        monkeypatch.setattr(lexical, name, value)
    assert everything() == whole


def of_pages(spark, path):
    """Two batches a task: in the first a passage meets only a page that it isn't routed to, in the second the page that it is."""
    titles = ("plain words", "some text", "some other", "more", "unheard words")
    sf = tables(spark, path, [(1, "x", "en", "a")], ["unheard w1"])
    rows = [(k, f"http://h/{k}", f"<title>{t}</title><p>w1 body {k}") for k, t in enumerate(titles)] + [(k, f"http://h/{k}", "<title>other</title><p>nothing") for k in range(5, 20)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{sf}/pages.parquet")
    spark.createDataFrame([(k, [1.0, float(k)], 0) for k in range(20)], "vec_id long, embedding array<double>, label long").write.parquet(f"{sf}/embeddings.parquet")
    return sf


@pytest.fixture
def batches_of_one(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    yield
    spark.conf.set(key, before)


def test_batches_in_which_routes_leave_nothing(spark, tmp_path, batches_of_one):
    assert [(r.item_id, r.page_id, r["rank"]) for r in search.lexical_search(spark, of_pages(spark, tmp_path)).collect()] == [(0, 4, 1)]


def test_fusion_where_routes_leave_nothing_in_a_batch(spark, tmp_path, batches_of_one):
    assert [(r.page_id, r.dense_rank, r.lexical_rank, r.metadata_routed) for r in search.routed_fusion(spark, of_pages(spark, tmp_path)).collect()] == [(4, 1, 1, True)]


def by_hand(docs, asked, k):
    """(query, doc) -> score of the k best allowed documents of each query. docs: (id, tokens, may); asked: {query: {term: qf}}."""
    n, mean, df, out = len(docs), sum(len(t) for _, t, _ in docs) / len(docs), Counter(t for _, ts, _ in docs for t in set(ts)), {}
    for q, terms in asked.items():
        idf = {t: math.log((n + 1) / df[t]) for t in terms if df[t]}
        scored = []
        for d, ts, may in docs:
            tf = Counter(t for t in ts if t in idf)
            if may and tf:
                scored.append((-round(sum(terms[t] * idf[t] * (1 + c) for t, c in ((t, tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(ts) / mean))) for t in idf)), 6), d))
        out |= {(q, d): -s for s, d in sorted(scored)[:k]}
    return out


def test_many_queries_with_frequent_and_rare_terms_and_copies(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(5000)]
    docs = [(k, [rng.choice(words) for _ in range(rng.randint(1, 60))], k % 4 != 1) for k in range(400)]
    docs += [(1000 + k, docs[k % 3][1], k % 3 != 0) for k in range(60)] + [(2000, ["alone"], True), (2001, ["_empty_"], True)]
    asked = {f"q {q}": Counter(rng.choice(words) for _ in range(rng.randint(1, 25))) for q in range(700)} | {"q of none": Counter(["unheard"]), "q one": Counter(["alone"])}
    frame = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, tokens array<string>, may boolean").repartition(3)
    terms = spark.createDataFrame([(q, t, n) for q, ts in asked.items() for t, n in ts.items()], "key string, term string, qf long")
    for k in (1, 3, 20):
        got = lexical.top_k(lexical.search(frame, terms, True, k, query_col="key", allowed_col="may"), k, query_col="key").collect()
        assert {(r.key, r.doc_id): round(r.score, 6) for r in got} == pytest.approx(by_hand(docs, asked, k), abs=2e-6)
    whole = {(r.key, r.doc_id, round(r.score, 6)) for r in got}
    for name, value in (("PASS", 3000), ("ITEMS", 100), ("HOT", 3), ("TASK_CELLS", 50_000), ("HOT_SHARE", 0.0)):
        monkeypatch.setattr(lexical, name, value)
    assert {(r.key, r.doc_id, round(r.score, 6)) for r in lexical.top_k(lexical.search(frame, terms, True, 20, query_col="key", allowed_col="may"), 20, query_col="key").collect()} == whole


def test_a_task_returns_each_query_once_not_once_a_batch(spark, batches_of_one):
    docs = spark.createDataFrame([(k, ["w1", f"w{k}"]) for k in range(50)], "doc_id long, tokens array<string>").coalesce(1)
    terms = spark.createDataFrame([(q, "w1", 1) for q in range(20)], "item_id long, term string, qf long")
    assert lexical.search(docs, terms, True, 1).count() == 20

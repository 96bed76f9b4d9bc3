"""Operators against brute force, other libraries and defined edge cases, on small tables."""

import base64
import collections
import gzip
import hashlib
import os
import random
import re
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest

from quarrylight.llm import bpe, components, exact_dedup, extraction, minhash, packing, pii, token_counts, toxicity, vector_links, warc

DOCS = "doc_id long, text string, n_tokens string, score string, kept string, uid string, id string"
LONG = "word " * 30_000


def table(spark, rows):
    """Documents with extra columns whose names clash with what operators return or use."""
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t in rows], DOCS)


EDGES = [(1, None), (2, ""), (3, "   "), (4, LONG), (5, "a b c d"), (6, "a b c d"), (5, "a b c d"), (None, "x"), (7, "été 日本 \n\t ok"), (8, "one")]


def test_bpe_matches_library(spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = bpe.encoding_digests(table(spark, EDGES), path).collect()
    want = []
    for i, t in EDGES:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert bpe.encoding_digests(table(spark, []), path).count() == 0
    tokens = bpe.encode(table(spark, EDGES), path)
    back = bpe.decode(tokens, path).collect()
    assert collections.Counter((r.doc_id, bytes(r.decoded).decode()) for r in back) == collections.Counter((i, t or "") for i, t in EDGES)


def test_bpe_edits_follow_the_text():
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, rng = bpe.PrefixEncoder(ranks), random.Random(5)
    parts = ["ab", "  ", "\n", "é", "日本", "'s", "'re", " ", "a", "12", "==", " the", "ing", "x" * 40]
    for _ in range(60):
        text = bpe.EditableText(encoder, text="".join(rng.choice(parts) for _ in range(rng.randint(0, 25))))
        for _ in range(5):
            i = rng.randint(0, len(text.text))
            text.edit(i, min(len(text.text), i + rng.randint(0, 5)), "".join(rng.choice(parts) for _ in range(rng.randint(0, 3))))
            text.append(rng.choice(parts))
            assert text.ids() == enc.encode_ordinary(text.text)
    long = bpe.EditableText(encoder, text="".join(rng.choice("abcdefgh") for _ in range(4000)))
    before = long.computed
    long.edit(2000, 2001, "zz")
    assert long.computed - before < 400


def test_token_counts_match_library(spark):
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    rows = EDGES + [(20, "a <|endoftext|> b<|endoftext|>"), (21, "aaaaaaa" * 50), (22, "tok " * 600)]
    got = token_counts.count_tokens(table(spark, rows), path).collect()
    n = [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    want = [(i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(rows, n)]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert token_counts.count_tokens(table(spark, []), path).count() == 0


def test_toxicity_learns_subwords(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(("ka", "lo", "mi", "te", "ru")) for _ in range(3))
    texts, toxic = [], []
    for k in range(600):
        words = [word() for _ in range(rng.randint(20, 120))]
        if k % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(("grumpf", "Grumpfs,", "snarlix", "snarlixes"))
        texts.append(" ".join(words))
        toxic.append(int(k % 3 == 0))
    model = toxicity.fit(texts[:450], toxic[:450])
    scorer = toxicity.Scorer(*model.margins(), model.shape)
    held = [int(s >= 0.3) for s in scorer.scores(texts[450:])]
    assert np.mean([a == b for a, b in zip(held, toxic[450:])]) > 0.97
    plain, misspelt = scorer.scores([texts[1], texts[1] + " grumpfff"])
    assert misspelt > plain and scorer.scores(["", "  "])[0] < 0.3
    got = toxicity.score(table(spark, EDGES), model)
    assert got.count() == len(EDGES) and got.columns == ["doc_id", "score", "predicted"]
    assert toxicity.score(table(spark, EDGES), None).where("score <> 0").count() == 0
    assert toxicity.reject(table(spark, EDGES), model).columns == table(spark, EDGES).columns
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(table(spark, EDGES), labels) is None


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op3_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "toxic").collect()
    toxic, clean = ([r.score for r in got if r.toxic == c] for c in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean]) > 0.93


def test_pii_base_spans_are_the_patterns():
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")

    def plain(text):
        out = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text):
                digits = re.sub("[^0-9]", "", m.group())
                if k == 1 and any(int(x) > 255 for x in m.group().split(".")) or k == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)) or k == 3 and not 9 <= len(digits) <= 15:
                    continue
                out.append((k, *m.span()))
        return out

    rng = random.Random(2)
    parts = ["a", "@", "b.c", ".", "1", "22", "+1", "-", " ", "(", ")", "4111 1111 1111 1111", "é", "%", "x@y.z", "..", "10.0.0.1", "0300", "_"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text


def test_pii_model_adds_spans_and_keeps_base(spark):
    model, rng, hit, wrong, missed = pii.trained(), random.Random(123), 0, 0, 0
    for _ in range(200):
        text, marks = "", set()
        for part, label in pii._sentence(rng):
            text += " " if text else ""
            if label:
                marks.add((label - 1, len(text), len(text) + len(part)))
            text += part
        base, spans = pii.all_spans(text, model)
        assert set(base) <= set(spans)
        hit, wrong, missed = hit + len(set(spans) & marks), wrong + len(set(spans) - marks), missed + len(marks - set(spans))
    assert hit / (hit + wrong) > 0.85 and hit / (hit + missed) > 0.85
    rows = EDGES + [(30, "mail bob (at) example (dot) org or a@b.cd now"), (31, "1" * 50_000), (32, "call (456) 555-2186 now")]
    got = {r.doc_id: r for r in pii.find(table(spark, rows)).collect()}
    assert got[30].n_email == 1 and got[30].spans.count("email:") == 2 and got[1].spans == ""
    assert "phone:" in got[32].spans
    red = {r.doc_id: r.text for r in pii.redact(table(spark, rows)).collect()}
    assert red[1] is None and red[30] == "mail [EMAIL] or [EMAIL] now" and red[32] == "call [PHONE] now"
    assert pii.find(table(spark, [])).count() == 0


def test_packing_is_whole_and_tight(spark):
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = EDGES + [(40 + k, "tok, The word. " * (37 * k % 300)) for k in range(60)]
    got = packing.packed_documents(table(spark, rows)).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4").tobytes()
            want[i, k, at, len(part) // 4, zlib.crc32(part)] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    counts = np.bincount([r.length for r in got], minlength=2049)
    assert len(by) == packing.lower_bound(counts, 2048)
    assert packing.packed_documents(table(spark, [])).count() == 0


def test_new_words_are_encoded_many_at_a_time():
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeghinorstuäéñß", k=rng.randint(1, 12))) for _ in range(3000)]
    words = [w + rng.choice(["", "", "", "&&&", ".%%%", "'s", "7"]) for w in words]
    odd = ["\u25a0", "a\u25a0b", "\u25a0\u25a0", "\u0301x", "e\u0301", "\u1161\u1100", "\u0130\u03a3", "\t", "\u00a0", "x\u3000y", "\u2028.", "<|endoftext|>", "<|", "</w>", "x</w>", "\u2167", "\u4e2d\u6587", "\U0001f600", "\U00010d50", "\u1c89", "\x00", "_,", "!, ", "", "it's", "\u03c2\u03a3"]
    texts = [" ".join(words[k : k + 100]) for k in range(0, 3000, 100)]
    mixed = ["", " ", "\n\n"] + [" ".join(rng.choices(odd + words[:20], k=rng.randint(1, 12))) for _ in range(300)]
    encoder = packing.WordIds(path, cache=400, chars=3000)
    for _ in range(2):  # words come back from the older generation or are learnt again
        for some in (texts, mixed):
            want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
            assert encoder.encode_many(some) == want
    assert encoder.encode_many([]) == []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.asked = tokenizer, 0

        def encode_batch_fast(self, some, **options):
            self.asked += len(some)
            return self.tokenizer.encode_batch_fast(some, **options)

    encoder = packing.WordIds(path)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    encoder.encode_many(texts)
    assert counted.asked <= 3  # not one call's overhead for each of 3000 words


def test_packing_rounds_only_improve(spark):
    rng = random.Random(3)
    rows = [(k, k, 0, rng.randint(1, 1500)) for k in range(3000)]
    cut = spark.createDataFrame(rows, "doc_id long, uid long, piece int, length long")
    packed = packing.pack(cut, group_pieces=300).collect()
    fill = collections.Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    bound = packing.lower_bound(np.bincount([r[3] for r in rows], minlength=2049), 2048)
    assert len(packed) == 3000 and max(fill.values()) <= 2048 and len(fill) <= bound * 1.02


def test_lower_bound_never_exceeds_best_packing():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 14))), reverse=True)
        bins, _ = packing.best_fit_decreasing(np.array(lengths), 20)
        assert packing.lower_bound(np.bincount(lengths, minlength=21), 20) <= bins.max() + 1


def test_vector_links_match_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(12, 8))
    rows = [(int(k), [float(x) for x in base[k % 12] + rng.normal(size=8) * 0.12], int(k % 3)) for k in range(150)]
    rows += [(200, rows[0][1], rows[0][2]), (201, rows[0][1], None), (202, None, 1), (203, [0.0] * 8, 1), (204, [float("nan")] * 8, 1), (205, [1.0, None], 1), (206, [1.0, 2.0], 1), (207, [], 1), (None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid string")
    f32 = lambda v: np.array(v, np.float32).astype(float)
    good = [(i, f32(v), c) for i, v, c in rows if i is not None and c is not None and v and None not in v and np.isfinite(f32(v)).all() and f32(v).any()]
    near = collections.defaultdict(set)
    for i, v, c in good:
        for j, w, d in good:
            if i != j and c == d and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                near[i].add(j)
    want = {}
    for i, *_ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        want[i] = (len(near[i]), min(seen) if i is not None else None)
    for block in (8, 1024):
        got = vector_links.link_vectors(df, block=block).collect()
        assert len(got) == len(rows) and {r.vec_id: (r.n_links, r.component_id) for r in got} == want
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert vector_links.link_vectors(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (5, 5), (101, 102), (None, 3)]
    got = {r.a: r.b for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100, 102: 100}


def test_warc_round_trip(spark):
    rows = [(3, "http://a/3", "<p>x</p>"), (1, "http://a/1", "<p>x</p>"), (2, None, None), (4, "u", ""), (5, "u", "é\r\n\r\ny"), (1, "http://a/1", "<p>x</p>"), (None, "n", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, header string")
    path = tempfile.mkdtemp() + "/w"
    warc.write(pages, path)
    got = warc.read_index(spark, path).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == collections.Counter((i, len((t or "").encode()), digest(t)) for i, _, t in rows)
    kinds = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kinds == collections.Counter([(1, "response", None), (1, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None), (4, "revisit", 2), (5, "response", None)])
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    to = path + "-files"
    warc.export(spark, path, to)
    data = b"".join(gzip.open(f"{to}/{f}").read() for f in os.listdir(to) if f.endswith(".gz"))
    found = collections.Counter()
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        n = int(re.search(rb"Content-Length: (\d+)", head).group(1))
        kind = re.search(rb"WARC-Type: (\w+)", head).group(1).decode()
        assert rest[n : n + 4] == b"\r\n\r\n"
        found[kind, rest[:n].decode()] += 1
        assert not n or int(re.search(rb"Content-Length: (\d+)", rest).group(1)) == n - rest.index(b"\r\n\r\n") - 4
        data = rest[n + 4 :]
    block = lambda t: f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(t.encode())}\r\n\r\n{t}"
    assert found == collections.Counter({("response", block("<p>x</p>")): 1, ("revisit", ""): 4, ("response", block("")): 1, ("response", block("é\r\n\r\ny")): 1})
    all_responses = tempfile.mkdtemp() + "/w"
    warc.write(pages, all_responses, min_bytes=100)
    assert warc.read_index(spark, all_responses).where("record_type <> 'response'").count() == 0
    empty = tempfile.mkdtemp() + "/w"
    warc.write(pages.limit(0), empty)
    assert warc.read_index(spark, empty).count() == 0


def brute_groups(rows, words, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        k = min(words, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return collections.Counter((i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def near_rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows, n = list(EDGES), 100
    for _ in range(25):
        base = [word() for _ in range(rng.randint(30, 150))]
        for _ in range(rng.randint(1, 8)):
            copy = [word() if rng.random() < rng.choice((0.0, 0.01, 0.03, 0.06)) else w for w in base]
            rows.append((n, " ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [minhash.Rule(), minhash.FIVE_WORDS, minhash.Rule(stars=2, block=4), minhash.Rule(stars=1, block=4, best=1)])
def test_near_duplicates_match_brute_force(spark, rule):
    rows = near_rows()
    got = minhash.groups(table(spark, rows), rule).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, rule.words, rule.percent)
    kept = collections.Counter(r.component_id for r in got if r.kept and r.n_shingles)
    assert set(kept.values()) == {1} and set(kept) == {r.component_id for r in got if r.n_shingles}
    assert minhash.groups(table(spark, []), rule).count() == 0


def test_near_deduplicate_keeps_one_of_each(spark):
    rows = near_rows()
    out = minhash.deduplicate(table(spark, rows))
    assert out.columns == table(spark, []).columns
    kept = {i for i, _, c in brute_groups(rows, 5, 80) if i == c}
    got = [r.doc_id for r in out.select("doc_id").collect()]
    assert set(got) - {None} == kept - {None} and len(got) == len(set(got))


def test_exact_groups_match_brute_force(spark):
    rows = EDGES + [(9, " a\tb  c \n d"), (10, "a  b c d"), (11, "\x0b")]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    by = collections.defaultdict(list)
    for i, t in rows:
        by[norm(t)].append(i)
    want = collections.Counter((i, min((x for x in by[norm(t)] if x is not None), default=None), len(by[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)
    got = exact_dedup.groups(table(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == collections.Counter(hashlib.sha256(t.encode()).hexdigest() for t in by)
    out = exact_dedup.deduplicate(table(spark, rows))
    assert out.count() == len(by) and out.columns == table(spark, []).columns
    assert exact_dedup.groups(table(spark, [])).count() == 0 and exact_dedup.deduplicate(table(spark, [])).count() == 0


def test_extraction_on_labelled_and_odd_pages(spark):
    model, rng, wrong, total = extraction.trained(), random.Random(55), 0, 0
    for _ in range(150):
        page, labels = extraction.labelled_page(rng)
        found = extraction.blocks(page)
        assert len(found) == len(labels)
        wrong += sum(a != b for a, b in zip(model.decode(found), labels))
        total += len(labels)
    assert wrong / total < 0.01
    article = "<article><h1>T &amp; U</h1><p>One <b>bo</b>ld&nbsp; line.<br>Two\n lines here.</p><script>var a='</p>';</script></article>"
    page = f"<html><head><title>no</title><style>p{{}}</style></head><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav>{article}<footer>&copy; x</footer>"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<!-- only"), (5, "u", "<div>" * 5000), (6, "u", "<" * 5000), (1, "u", page)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in extraction.extract(pages).collect())
    text = "T & U One bold line. Two lines here."
    assert got[1, text, len(text)] == 2 and got[2, "", 0] == got[3, "", 0] == got[4, "", 0] == got[5, "", 0] == 1
    assert extraction.extract(pages.limit(0)).count() == 0


def test_extraction_of_given_pages(spark):
    import html as h

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        inner = re.sub(r"</?b>", "", inner)
        assert got[r.page_id] == " ".join(h.unescape(re.sub("<[^>]*>", " ", inner)).split())

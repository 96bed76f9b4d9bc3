"""Ancestors count however deep a text lies."""

import random
import time

from quarrylight.llm import extraction


def test_text_many_levels_below_its_section():
    model = extraction.trained()
    prose = "The ver unde mo listan quever the on. Enla reverun the osté staver io cheun."
    for levels in (0, 8, 14, 20):
        down, up = "<div>" * levels, "</div>" * levels
        page = f"<html><body><div class='page'><nav class='menu'>{down}<p><a href='/x'>Mo re</a></p>{up}</nav><article>{down}<p>{prose}</p><p>{prose}</p>{up}</article>"
        page += f"<section class='comments'>{down}<p>{prose}</p><p>{prose}</p>{up}</section><aside class='sidebar'>{down}<p>{prose}</p>{up}</aside></div></body></html>"
        assert extraction.main_text(page, model) == f"{prose} {prose}", levels


def test_generated_pages_are_also_deep():
    model, rng, wrong, total, deep = extraction.trained(), random.Random(99), 0, 0, 0
    for _ in range(300):
        page, labels = extraction.labelled_page(rng)
        found = extraction.blocks(page)
        assert len(found) == len(labels)
        if max(b.path.depth for b in found) > 12:
            deep += 1
            wrong, total = wrong + sum(a != b for a, b in zip(model.decode(found), labels)), total + len(labels)
    assert deep > 30 and wrong / total < 0.02


def test_nested_texts_cost_linear_time():
    model, began = extraction.trained(), time.process_time()
    extraction.main_text("".join(f"<div class='c{k} n{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}'>text {k}" for k in range(15_000)), model)
    assert time.process_time() - began < 10


def test_quotes_in_tags_and_short_comments_lose_nothing():
    model = extraction.trained()
    prose = ["The ver unde mo listan quever the on.", "Enla reverun the osté staver io cheun.", "Mo li un de io cheun the last one."]
    plain = "".join(f"<p>{p}</p>" for p in prose)
    assert extraction.main_text(f"<body><article>{plain}</article>", model) == " ".join(prose)
    for odd in ("<img alt=Tom's src=a.png>", "<hr o'clock>", '<img alt=5"tall>', "<!-->", "<!--->", "<!-- a > b -->", "<!-- x --!>", "<img alt='a > b' x=\"c > d\">", "<hr x = 'a>b'>", "<img a=\"it's\">"):
        page = f"<body><article><p>{prose[0]}</p>{odd}<p>{prose[1]}</p><p>{prose[2]}</p></article>"
        assert extraction.main_text(page, model) == " ".join(prose), odd
    assert [b.text for b in extraction.blocks("<p>a<p title=\"never closed > b")] == ["a"]


def test_deep_pages_cost_linear_time():
    model = extraction.trained()
    for tag, n in (("<div>x", 50_000), ("<div>", 50_000), ("unknown names", 0), ("</i></b></section>", 50_000), ("<p>x<b1>", 50_000)):
        page = "".join(f"<x{k}>y" for k in range(50_000)) if not n else tag * n
        began = time.process_time()
        extraction.main_text(page, model)
        assert time.process_time() - began < 5, tag


PROSE = ["The ver unde mo listan quever the on, and io re staver.", "Enla reverun the osté staver io cheun listan.", "Mo li un de io cheun the last one of ver unde."]


def test_valid_pages_without_optional_tags_keep_their_text():
    model = extraction.trained()
    paragraphs = "".join(f"<p>{p}</p>" for p in PROSE)
    for head in ("<html><head><title>x</title><body>", "<head><meta charset=utf-8><title>x</title>", "<title>x</title>", "<html><head><title>x<body>", "<head><title>x</title><style>p{}</style><script>1<2</script>", "<head><noscript><link href=a></noscript><body>"):
        assert extraction.main_text(f"{head}<article>{paragraphs}</article>", model) == " ".join(PROSE), head
    for odd in ("<noscript>", "<object data=x>", "<video src=x>", "<button>", "<svg>", "<select>"):
        page = f"<body><article><p>{PROSE[0]}</p>{odd}<p>{PROSE[1]}</p><p>{PROSE[2]}</p></article>"
        assert extraction.main_text(page, model) == " ".join(PROSE), odd
    assert [b.text for b in extraction.blocks("<noscript>a</noscript><p>b<noscript>c")] == ["b", "c"]
    assert [b.text for b in extraction.blocks("<p>a<textarea>b</textarea> c<textarea>d")] == ["a c"]
    assert [b.text for b in extraction.blocks("<head><title>x</title>loose<p>y</p>")] == ["y"]


def test_formulas_stay_in_their_paragraph():
    model = extraction.trained()
    page = f"<body><article><p>{PROSE[0]}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be the ver.</p><p>{PROSE[1]}</p></article>"
    assert extraction.main_text(page, model) == f"{PROSE[0]} Let x=2 be the ver. {PROSE[1]}"


def test_prose_in_plain_divs():
    model = extraction.trained()
    long = [" ".join(PROSE), " ".join(reversed(PROSE))]
    for page in ("<body>{}</body>", "<body><div>{}</div></body>", "<body><nav class=menu><ul><li><a href=/a>Mo re</a></ul></nav><div>{}</div><footer>© All rights reserved</footer>"):
        assert extraction.main_text(page.format("".join(f"<div>{p}</div>" for p in long)), model) == " ".join(long), page


def test_viterbi_finds_the_best_labelling_of_all():
    import itertools

    model, rng = extraction.trained(), random.Random(8)
    for _ in range(40):
        found = extraction.blocks(extraction.labelled_page(rng)[0])[:9]
        best = model.decode(found)
        if not found:
            continue
        scores = {labels: total(model, found, labels) for labels in itertools.product((0, 1), repeat=len(found))}
        assert abs(scores[tuple(map(int, best))] - max(scores.values())) < 1e-9


def total(model, found, labels):
    known = {}
    scores = [model.score(b, known) for b in found]
    return model.start[labels[0]] + sum(s * y for s, y in zip(scores, labels)) + sum(model.transitions[a, b] for a, b in zip(labels, labels[1:]))

"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read once into leaf blocks: runs of text between block-level tags, with the tags, classes, ids and roles of
their ancestors and the share of linked characters. Features of ancestors and text score each block, transitions score
neighbours, and Viterbi decoding picks content or not for all blocks of a page together. The model is trained by
conditional likelihood on labelled pages that a seeded generator writes: many layouts of articles among menus, headers,
footers, sidebars, notices, adverts, forms and comments.

Scripts, styles, comments, markup and what browsers never show as text are no blocks. Character references are decoded,
white space inside a block becomes one blank, and content blocks are joined in page order by one blank.

Defined cases: html that is null, empty or without content gives an empty text; unclosed tags, comments, scripts and
styles run to the end of the page, but elements that never show and have no end tag in the rest of the page hide nothing,
a head ends at the first tag that can't stand in it, and a title without an end runs to the body or else to the next tag;
quotes in a tag count only after an equals sign, ``<!-->`` and ``<!--->`` are whole comments; pages
of any length and depth are read in time linear in their length; rows repeat as in the input; an empty table gives an
empty result; input columns besides those named are neither read nor returned.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_batches, text_or_empty

WEIGHTS = 1 << 14
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mrow mtext mspace mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
NEVER = frozenset("head noscript template svg iframe object select option button datalist canvas audio video".split())
#: What a head may hold; any other tag ends it, since its own end tag may be left out.
IN_HEAD = frozenset("meta link title style script base noscript template head html".split())
#: An opening tag ends open elements of these names, up to the nearest of the second set.
IMPLIED = {
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
}
_CLOSES_P = (frozenset({"p"}), frozenset({"div", "article", "section", "main", "td", "li", "body", "blockquote", "aside", "form"}))

#: Quotes hold a value only directly after an equals sign; elsewhere in a tag they are characters like others.
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]{2,}")
_RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in RAW}
_BODY = re.compile(r"<body\b", re.I)
_ENDS = {t: re.compile(rf"</{t}\b", re.I) for t in NEVER}


class Path:
    """An open element: its tag, the element around it, its depth, whether a class, id or role names it, and the buckets that it adds to those of its ancestors."""

    __slots__ = ("depth", "named", "new", "outer", "tag")

    def __init__(self, tag: str, outer: Path | None, new: tuple[int, ...], named: bool):
        self.tag, self.outer, self.new, self.named = tag, outer, new, named
        self.depth = outer.depth + 1 if outer else 1


class Block:
    """path: its innermost ancestor; text: decoded, white space collapsed; linked: share in links."""

    __slots__ = ("linked", "path", "text")

    def __init__(self, path: Path | None, text: str, linked: float):
        self.path, self.text, self.linked = path, text, linked


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) % WEIGHTS


@lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> tuple[int, ...]:
    """Buckets of an element's tag and of the words of its class, id and role."""
    words = {w.lower() for m in _NAMES.finditer(attributes) for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", next(filter(None, m.groups()), "")))}
    return tuple(sorted({_hash(f) for f in (f"in:{tag}", *(f"name:{w}" for w in words), *(f"stem:{w[:4]}" for w in words))}))


@lru_cache(maxsize=20_000)
def _pair(outer: str, inner: str) -> int:
    return _hash(f"pair:{outer}>{inner}")


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    stack: list[Path] = []
    seen: set[int] = set()  # buckets of the open elements
    opened: dict[str, int] = {}  # open elements by name: a name that isn't open is never searched for
    text: list[str] = []
    linked, link, hidden, at = 0, 0, 0, 0

    def add(raw: str) -> None:
        nonlocal linked
        if hidden == 0 and raw:
            text.append(raw)
            if link:
                linked += len(raw)

    def flush() -> None:
        nonlocal linked
        if text:
            whole = "".join(text)
            clean = " ".join(html.unescape(whole).split())
            if clean:
                out.append(Block(stack[-1] if stack else None, clean, linked / len(whole)))
            text.clear()
        linked = 0

    def pop_to(k: int) -> None:
        nonlocal hidden
        for element in stack[k:]:
            hidden -= element.tag in NEVER
            opened[element.tag] -= 1
            seen.difference_update(element.new)
        del stack[k:]

    def push(tag: str, attributes: str) -> None:
        nonlocal hidden
        outer = stack[-1] if stack else None
        buckets = {*_element(tag, attributes), _pair(outer.tag, tag)} if outer else {*_element(tag, attributes)}
        stack.append(Path(tag, outer, tuple(buckets - seen), _NAMES.search(attributes) is not None))
        seen.update(buckets)
        opened[tag] = opened.get(tag, 0) + 1
        hidden += tag in NEVER

    last_end: dict[str, int] = {}

    def ends_later(tag: str) -> bool:
        """Whether an end tag of that name follows; the last one of the page is looked for once."""
        if tag not in last_end:
            last_end[tag] = max((x.start() for x in _ENDS[tag].finditer(page)), default=-1)
        return last_end[tag] >= at

    m = _TAG.search(page, 0)
    while m:
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag:
            tag, closing = tag.lower(), m.group(1)
            if not closing and opened.get("head") and tag not in IN_HEAD:
                pop_to(next(k for k, element in enumerate(stack) if element.tag == "head"))
            if tag in RAW:
                if not closing:
                    end = _RAW_END[tag].search(page, at)
                    if end is not None:
                        at = page.find(">", end.end()) + 1 or len(page)
                    elif tag in ("script", "style"):
                        at = len(page)
                    else:  # of a title without an end only what stands before the next tag, or the body, is lost
                        body = _BODY.search(page, at)
                        at = body.start() if body else page.find("<", at) if "<" in page[at:] else len(page)
            elif tag == "a":
                link = 0 if closing else 1
            elif tag == "br":
                add(" ")
            elif tag in INLINE:
                pass
            elif tag in VOID:
                if tag not in ("img", "input"):
                    flush()
            else:
                flush()
                if closing and not opened.get(tag):
                    pass
                elif closing:
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k].tag == tag:
                            pop_to(k)
                            break
                else:
                    ends, bounds = IMPLIED.get(tag, _CLOSES_P)
                    left = sum(opened.get(t, 0) for t in ends)
                    if left:
                        cut = len(stack)
                        for k in range(len(stack) - 1, -1, -1):
                            if stack[k].tag in bounds:
                                break
                            if stack[k].tag in ends:
                                cut, left = k, left - 1
                                if not left:
                                    break
                        pop_to(cut)
                    if not m.group(3).endswith("/") and (tag not in NEVER or tag == "head" or ends_later(tag)):
                        push(tag, m.group(3))
        m = _TAG.search(page, at)
    add(page[at:])
    flush()
    return out


# ---- features and model --------------------------------------------------------------------------------------------

CUES = re.compile(r"cookie|consent|privacy|newsletter|subscri|sign (?:in|up)|log ?in|copyright|rights reserved|©|advert|sponsor|share|tweet|comment|repl(?:y|ies)|related|read more|previous|next|posted|menu|search|terms|contact", re.I)


@lru_cache(maxsize=20_000)
def _own(tag: str, depth: int, named: bool) -> tuple[int, int]:
    return _hash(f"own:{tag}:{named}"), _hash(f"depth:{depth}")


def own_features(path: Path | None) -> tuple[int, int]:
    return _own(path.tag, min(path.depth, 6), path.named) if path else _own("none", 0, False)


def path_features(path: Path | None) -> set[int]:
    """Buckets of a block's place: its own element and names, tags and pairs of all its ancestors."""
    found = {*own_features(path)}
    while path:
        found.update(path.new)
        path = path.outer
    return found


def text_features(block: Block) -> list[int]:
    text = block.text
    n = len(text)
    found = [f"len:{n.bit_length()}", f"linked:{int(block.linked * 4)}:{n > 40}", f"ends:{text[-1] if text[-1] in '.!?:;,' else 'a'}", f"stops:{min(text.count('. '), 3)}"]
    if n < 200:
        found.extend(f"cue:{c.lower()}" for c in set(CUES.findall(text)))
    return [_hash(f) for f in found]


class ChainModel:
    """A weight for each feature (content against not) and scores of neighbouring labels."""

    def __init__(self):
        self.weights, self.transitions, self.start = np.zeros(WEIGHTS), np.zeros((2, 2)), np.zeros(2)

    def __getstate__(self):
        return self.weights, self.transitions, self.start

    def __setstate__(self, state):
        self.weights, self.transitions, self.start = state

    def score(self, block: Block, known: dict[Path | None, float]) -> float:
        """known: sums over the paths of a page, each from that of the element around it, so deep pages cost no more a tag."""
        weight, path, above = self.weights.item, block.path, []
        while path and path not in known:
            above.append(path)
            path = path.outer
        total = known[path] if path else 0.0
        for path in reversed(above):
            total = known[path] = total + sum(map(weight, path.new))
        return total + sum(map(weight, own_features(block.path))) + sum(map(weight, text_features(block)))

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi over the blocks of a page."""
        if not page:
            return []
        known: dict[Path | None, float] = {}
        (t00, t01), (t10, t11) = self.transitions.tolist()
        a, b = float(self.start[0]), float(self.start[1]) + self.score(page[0], known)
        back = []
        for block in page[1:]:
            s = self.score(block, known)
            back.append((a + t00 < b + t10, a + t01 < b + t11))
            a, b = max(a + t00, b + t10), max(a + t01, b + t11) + s
        label, out = b > a, []
        for pair in reversed(back):
            out.append(label)
            label = pair[label]
        out.append(label)
        return out[::-1]

    def learn(self, features: list[np.ndarray], labels: np.ndarray, rate: float) -> None:
        """One ascent step on the log-likelihood of a page's labels, by forward-backward."""
        n = len(features)
        s = np.zeros((n, 2))
        s[:, 1] = [self.weights[f].sum() for f in features]
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = self.start + s[0]
        for k in range(1, n):
            forward[k] = np.logaddexp(*(forward[k - 1][:, None] + self.transitions)) + s[k]
        for k in range(n - 2, -1, -1):
            backward[k] = np.logaddexp(*(self.transitions + s[k + 1] + backward[k + 1]).T)
        z = np.logaddexp(*forward[-1])
        p = np.exp(forward + backward - z)
        for f, d in zip(features, labels - p[:, 1]):
            if abs(d) > 1e-4:
                self.weights[f] += rate * d
        self.start += 0.1 * rate * (np.eye(2)[labels[0]] - p[0])
        for k in range(1, n):
            both = np.exp(forward[k - 1][:, None] + self.transitions + s[k] + backward[k] - z)
            both[labels[k - 1], labels[k]] -= 1
            self.transitions -= 0.1 * rate * both


# ---- labelled pages ------------------------------------------------------------------------------------------------

_SYLLABLES = "an er th on re mo li sta ver que un de io che ung en la os té ção".split()


def labelled_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page and the label of each of its leaf blocks."""
    parts: list[str] = []
    labels: list[bool] = []
    word = lambda: "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: words(4, 18).capitalize() + rng.choice(".....!?")

    deep = rng.randint(8, 20) if rng.random() < 0.2 else 0

    def block(tag: str, content: str, label: bool, attributes: str = "") -> None:
        if deep and rng.random() < 0.7:
            opened, closed = rng.choice((("<div>" * deep, "</div>" * deep), ("<table><tbody><tr><td>" * (deep // 4), "</td></tr></tbody></table>" * (deep // 4))))
            inside = bool(attributes) and tag != "p"
            parts.append(f"<{tag}{attributes}>{opened}{content}{closed}</{tag}>" if inside else f"{opened}<{tag}{attributes}>{content}</{tag}>{closed}")
            labels.append(label)
            return
        parts.append(f"<{tag}{attributes}>{content}" + ("" if tag in ("p", "li") and rng.random() < 0.2 else f"</{tag}>"))
        labels.append(label)

    def named(names: str) -> str:
        n = rng.choice(names.split())
        n = rng.choice((n, f"{n}-{word()}", f"{word()} {n}", f"{n}-box", f"main-{n}" if rng.random() < 0.1 else n))
        return f' {rng.choice(("class", "id", "class"))}="{n}"'

    def menu(tag: str, attributes: str = "") -> None:
        parts.append(f"<{tag}{attributes}><ul>")
        for _ in range(rng.randint(2, 7)):
            block("li", f'<a href="/{word()}">{words(1, 3)}</a>', False)
        parts.append(f"</ul></{tag}>")

    def box(tag: str, attributes: str, low: int = 1, high: int = 3, cue: str = "") -> None:
        if rng.random() < 0.4:
            parts.append(f"<{tag}{attributes}>")
            for _ in range(rng.randint(low, high)):
                text = rng.choice((sentence(), words(1, 5), f'<a href="#">{words(1, 6)}</a>', sentence() + " " + sentence()))
                block(rng.choice(("p", "div", "h3", "li")), rng.choice((text, f"{cue} {text}")), False)
            parts.append(f"</{tag}>")
        else:
            block(tag, rng.choice((sentence(), words(2, 6), " ".join(sentence() for _ in range(rng.randint(2, 6))), f'{cue} {words(1, 5)} <a href="#">{words(1, 3)}</a>', cue or words(1, 3))), False, attributes)

    boilerplate = [
        lambda: menu("nav", named("nav menu navbar breadcrumb")),
        lambda: menu("div", named("menu navigation nav toolbar breadcrumbs")),
        lambda: box("header", named("header top masthead banner"), cue=word()),
        lambda: box("div", named("header site-header masthead branding topbar")),
        lambda: box("div", named("ad ads advert advertisement sponsored promo banner"), cue="Sponsored"),
        lambda: box("aside", named("sidebar related widget"), cue="Related"),
        lambda: box("div", named("sidebar rail widget related recommended popular"), cue="Read more"),
        lambda: box("div", named("cookie consent notice gdpr alert popup modal newsletter subscribe"), cue="We use cookies."),
        lambda: box("form", named("search login form newsletter"), cue="Search"),
        lambda: box("div", named("share social sharing tools"), cue="Share"),
    ]
    inside = [
        lambda: box("div", named("ad ads advert advertisement promo sponsored"), cue="Advertisement"),
        lambda: box("aside", named("related pullout sidebar"), cue="Related"),
        lambda: box("div", named("share social sharing"), cue="Share"),
        lambda: box("form", named("newsletter subscribe"), cue="Subscribe"),
        lambda: menu("nav", named("toc pagination")),
    ]

    def comments() -> None:
        parts.append(f"<{(t := rng.choice(('section', 'div')))}{named('comments comment-list responses discussion replies')}>")
        if rng.random() < 0.5:
            block("h2", f"{rng.randint(1, 30)} comments", False)
        for _ in range(rng.randint(1, 4)):
            block(rng.choice(("p", "div", "li")), " ".join(sentence() for _ in range(rng.randint(1, 3))), False, rng.choice(("", named("comment reply"))))
        parts.append(f"</{t}>")

    def article() -> None:
        tag, attributes = rng.choice((("article", ""), ("article", ""), ("article", named("post article entry")), ("main", ""), ("div", named("content article-body post entry story main-content")), ("div", ' role="main"'), ("section", named("article content story")))) if rng.random() < 0.9 else rng.choice((("div", ""), ("", "")))
        wrap = rng.random() < 0.3 if tag else False
        bare = tag in ("", "div") and not attributes  # prose in plain divs or straight in the body
        parts.append(f"<main{rng.choice(('', ' id=\"main\"'))}>" * wrap + f"<{tag}{attributes}>" * bool(tag))
        if rng.random() < 0.8:
            block("h1", words(2, 9).capitalize() + rng.choice(("", ".")), True)
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            text = " ".join(sentence() for _ in range(rng.randint(1, 6)))
            if kind < 0.7:
                block("div" if bare and rng.random() < 0.5 else "p", rng.choice((text, f"<b>{text}", text.replace(" ", f' <a href="/x">{word()}</a> ', 1), word() + ".")), True)
            elif kind < 0.78:
                block(rng.choice(("h2", "h3")), words(1, 6).capitalize(), True)
            elif kind < 0.84:
                parts.append("<ul>")
                for _ in range(rng.randint(1, 4)):
                    block("li", rng.choice((sentence(), words(1, 4))), True)
                parts.append("</ul>")
            elif kind < 0.88:
                block("blockquote", text, True)
            elif kind < 0.91:
                block("pre", text, True)
            elif kind < 0.94:
                parts.append("<table><tr>")
                for _ in range(rng.randint(1, 4)):
                    block("td", words(1, 3), True)
                parts.append("</tr></table>")
            else:
                rng.choice(inside)()
        if rng.random() < 0.15:
            comments()
        parts.append(f"</{tag}>" * bool(tag) + "</main>" * wrap)

    shell = rng.randint(0, 4) if deep else 0
    parts.append("<!DOCTYPE html><html><head><title>x</title></head><body>" + "<div>" * shell)
    for _ in range(rng.choice((0, 1, 2, 3, 4, 4))):
        rng.choice(boilerplate)()
    article()
    if rng.random() < 0.3:
        comments()
    for _ in range(rng.randint(0, 3)):
        rng.choice(boilerplate)()
    if rng.random() < 0.85:
        box("footer", rng.choice(("", named("footer bottom"))), cue="© All rights reserved") if rng.random() < 0.8 else box("div", named("footer copyright bottom legal"), cue="©")
    parts.append("</div>" * shell)
    return "".join(parts), labels


@lru_cache(maxsize=1)
def trained(pages: int = 500, epochs: int = 8, seed: int = 9) -> ChainModel:
    """The model, trained on as many labelled pages; made once, on the driver."""
    rng, model, rows = random.Random(seed), ChainModel(), []
    for _ in range(pages):
        page, labels = labelled_page(rng)
        found = blocks(page)
        if found and len(found) == len(labels):
            rows.append(([np.array(sorted({*path_features(b.path), *text_features(b)})) for b in found], np.array(labels, int)))
    for epoch in range(epochs):
        rng.shuffle(rows)
        for features, labels in rows:
            model.learn(features, labels, 0.3 / (1 + epoch))
    return model


def main_text(page: str, model: ChainModel) -> str:
    found = blocks(page)
    return " ".join(b.text for b, content in zip(found, model.decode(found)) if content)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page. Narrow: one pass over the scan, no shuffle; the broadcast model has a fixed size."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    shared = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in text_batches(batches, 500):
            texts = [main_text(h, model) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    schema = f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long"
    return pages.select(F.col(id_col), F.col(url_col), text_or_empty(html_col).alias("__h")).mapInArrow(run, schema)


def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE_SQL = None

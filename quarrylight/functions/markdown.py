"""Html as Markdown: a transducer that keeps one frame for each open element and needs no tree, so depth costs no stack.

A frame gathers finished blocks and a line of inline text. When an element ends, what it gathered becomes text of the
frame around it: a marked line, a list with indented items, a quotation, a fence or a table. Links and images get absolute
addresses.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylight.functions.urls import absolute

#: Elements by what they do.
HIDDEN = frozenset("head script style noscript template".split())
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "s": "~~", "del": "~~", "strike": "~~", "code": "`", "kbd": "`", "samp": "`"}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
WITHIN = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
#: Lists and quotations in one another beyond which no more marks and indents are added, so that text grows with the page only.
DEEPEST = 30
_SPECIAL = re.compile(r"([\\*_`\[\]])")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class _Frame:
    __slots__ = ("attributes", "blocks", "inline", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.blocks, self.inline = tag, attributes, deque(), []


def _line(parts: list[str]) -> str:
    """Inline parts as trimmed text; of blanks that meet one stays, a hard break eats those around it."""
    text = re.sub(r" *\x00 *", "\x00", re.sub(r" {2,}", " ", "".join(parts))).strip(" \x00")
    return text.replace("\x00", "  \n")


class _Writer(HTMLParser):
    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.stack, self.hidden, self.fenced, self.opened = base, [_Frame("", {})], 0, 0, Counter()

    # what happens to text

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        top = self.stack[-1]
        if self.fenced:
            top.inline.append(data)
        elif any(f.tag in ("code", "kbd", "samp") for f in self.stack[-4:]):
            top.inline.append(_SPACE.sub(" ", data))
        else:
            top.inline.append(_SPECIAL.sub(r"\\\1", _SPACE.sub(" ", data)))

    def _flush(self, frame: _Frame) -> None:
        """Inline text of a frame becomes a block of its own."""
        text = _line(frame.inline)
        frame.inline = []
        if text:
            frame.blocks.append(("text", text))

    def _open_inline(self) -> None:
        """A block begins: inline elements that are open end before it."""
        while self.stack[-1].tag in INLINE:
            self._end(len(self.stack) - 1)
        self._flush(self.stack[-1])

    # what happens at tags

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        attributes = {k: v or "" for k, v in reversed(attrs)}
        if self.hidden:
            self.hidden += tag == self.hiding
            return
        if tag in HIDDEN:
            if tag == "head":
                return  # what it holds is hidden itself, or shows
            self.hidden, self.hiding = 1, tag
        elif tag == "title":
            self.hidden, self.hiding = 1, tag
        elif tag == "br":
            self.stack[-1].inline.append("\n" if self.fenced else "\x00")
        elif tag == "img":
            src = absolute(attributes.get("src", ""), self.base) if attributes.get("src") else None
            alt = _SPACE.sub(" ", attributes.get("alt", "")).strip()
            self.stack[-1].inline.append(f"![{alt}]({src}{_title(attributes)})" if src else alt)
        elif tag == "hr":
            self._open_inline()
            self.stack[-1].blocks.append(("text", "---"))
        elif tag in VOID:
            pass
        elif tag in INLINE:
            self._push(tag, attributes)
        else:
            self._close_implied(tag)
            self._open_inline()
            self.fenced += tag == "pre"
            self._push(tag, attributes)

    def _push(self, tag: str, attributes: dict[str, str]) -> None:
        self.stack.append(_Frame(tag, attributes))
        self.opened[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            self.hidden -= tag == self.hiding
            return
        if not self.opened[tag]:
            return
        at = next(k for k in range(len(self.stack) - 1, 0, -1) if self.stack[k].tag == tag)
        while len(self.stack) > at:
            self._end(len(self.stack) - 1)

    def _close_implied(self, tag: str) -> None:
        """Ends elements that the start of another one ends, up to the list or table around them."""
        ends, bounds = ENDS.get(tag, {"p"}), WITHIN.get(tag, {"div", "article", "section", "main", "body", "blockquote", "aside", "form", "li", "td", "th", "dd", "nav"})
        at, left, k = None, sum(self.opened[t] for t in ends), len(self.stack) - 1
        while left and k and (self.stack[k].tag in ends or self.stack[k].tag not in bounds):
            if self.stack[k].tag in ends:
                at, left = k, left - 1
            k -= 1
        while at is not None and len(self.stack) > at:
            self._end(len(self.stack) - 1)

    def _end(self, at: int) -> None:
        frame = self.stack.pop(at)
        self.opened[frame.tag] -= 1
        outer = self.stack[-1]
        if frame.tag in INLINE:
            outer.inline.append(self._marked(frame))
            return
        if frame.tag == "pre":
            self.fenced -= 1
            text = "".join(frame.inline).strip("\n")
            fence = "`" * max(3, 1 + max((len(m) for m in re.findall(r"`+", text)), default=0))
            frame.blocks.append(("text", f"{fence}\n{text}\n{fence}"))
            frame.inline = []
        self._flush(frame)
        blocks = self._blocks(frame)
        if len(blocks) > len(outer.blocks):  # the shorter side is moved
            blocks = deque(blocks) if blocks is not frame.blocks else blocks
            blocks.extendleft(reversed(outer.blocks))
            outer.blocks = blocks
        else:
            outer.blocks.extend(blocks)

    def _marked(self, frame: _Frame) -> str:
        raw = "".join(frame.inline)
        if self.fenced:
            return raw
        text = raw.strip(" \x00")
        left, right = raw[: len(raw) - len(raw.lstrip(" \x00"))], raw[len(raw.rstrip(" \x00")) :] if text else ""
        if frame.tag == "a":
            url = absolute(frame.attributes.get("href", ""), self.base) if frame.attributes.get("href") else None
            if url and text:
                text = f"<{url}>" if text == url else f"[{text}]({url}{_title(frame.attributes)})"
        elif frame.tag in MARKS and text:
            mark = MARKS[frame.tag]
            mark = "`" * (1 + max((len(m) for m in re.findall(r"`+", text)), default=0)) if mark == "`" else mark
            text = f"{mark}{text}{mark}"
        return left + text + right

    def _blocks(self, frame: _Frame) -> list[tuple[str, str]] | deque[tuple[str, str]]:
        """Blocks that an ended element leaves to the one around it: (kind, text)."""
        tag, blocks = frame.tag, frame.blocks
        if tag in ("li", "ul", "ol", "blockquote", "td", "th", "tr", "table") and sum(self.opened[t] for t in ("ul", "ol", "blockquote", "table")) > DEEPEST:
            return blocks
        if re.fullmatch("h[1-6]", tag):
            text = " ".join(t for _, t in blocks).replace("  \n", " ").replace("\n", " ")
            return [("text", f"{'#' * int(tag[1])} {text}")] if text else []
        if tag == "li":
            return [("item", _joined(blocks, tight=True))] if blocks else []
        if tag in ("ul", "ol"):
            start = frame.attributes.get("start", "1")
            number = int(start) if start.lstrip("-").isdigit() else 1
            lines, loose = [], []
            for kind, text in blocks:
                if kind != "item":
                    loose.append((kind, text))
                    continue
                bullet = "- " if tag == "ul" else f"{number}. "
                number += 1
                lines.append(bullet + text.replace("\n", "\n" + " " * len(bullet)))
            return loose + ([("list", "\n".join(re.sub(r"(?m)^ +$", "", x) for x in lines))] if lines else [])
        if tag == "blockquote":
            text = _joined(blocks)
            return [("text", re.sub(r"(?m)^(?=.)", "> ", text).replace("\n\n", "\n>\n"))] if text else []
        if tag in ("td", "th"):
            return [("cell", " ".join(t for _, t in blocks).replace("  \n", " ").replace("\n", " ").replace("|", "\\|"))]
        if tag == "tr":
            cells = [t for kind, t in blocks if kind == "cell"]
            return [b for b in blocks if b[0] != "cell"] + ([("row", f"| {' | '.join(cells)} |")] if cells else [])
        if tag == "table":
            rows = [t for kind, t in blocks if kind == "row"]
            if rows:
                width = len(re.findall(r"(?<!\\)\|", rows[0])) - 1
                rows.insert(1, f"|{' --- |' * width}")
            return [(("text"), t) for kind, t in blocks if kind != "row"] + ([("text", "\n".join(rows))] if rows else [])
        return blocks

    def markdown(self) -> str:
        while len(self.stack) > 1:
            self._end(len(self.stack) - 1)
        self._flush(self.stack[0])
        text = _joined(self.stack[0].blocks).strip()
        return text + "\n" if text else ""


def _title(attributes: dict[str, str]) -> str:
    title = _SPACE.sub(" ", attributes.get("title", "")).strip().replace('"', '\\"')
    return f' "{title}"' if title else ""


def _joined(blocks: deque[tuple[str, str]], tight: bool = False) -> str:
    """Blocks with an empty line between them; tight: a list follows its line at once."""
    out: list[str] = []
    for kind, text in blocks:
        out += [("\n" if tight and kind == "list" else "\n\n") * bool(out), text]
    return "".join(out)


def of_html(html: str | None, base: str | None = None) -> str:
    """The Markdown of a page or a part of one; empty, or ended by one line break."""
    writer = _Writer(base or "")
    writer.feed(html or "")
    writer.close()
    return writer.markdown()


def markdown(html: Column, base: Column) -> Column:
    """The same for columns; a null page gives an empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages, bases in batches:
            yield pd.Series([of_html(p, b) for p, b in zip(pages, bases)])

    return run(html, base)

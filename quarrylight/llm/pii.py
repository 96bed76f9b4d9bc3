"""Personal data by fixed base patterns and a semi-Markov conditional random field.

The base spans of a text always stay. What is left around digits and written-out at signs goes to a semi-Markov model:
candidate segments of at most LONGEST tokens, of a form that an entity can have, are scored by features of the whole
span (shape, digits, checksums, separators, neighbours), label transitions are scored too, and dynamic programming over
bounded entities chooses boundaries and types together. Tokens that no candidate covers are segments of their own, so
its work is linear in the text. The model is trained by conditional likelihood on sentences that a seeded generator
writes and marks, half of them with numbers and places that are no personal data; sentences written by hand test it.

Defined cases: a null or empty text has no spans; positions are code points, ends exclusive; rows repeat as in the
input; an empty table gives an empty result; input columns besides the two named are neither read nor returned by
``find`` and all returned by ``redact``, where a null text stays null.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, text_batches, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Label 0 is no personal data, label k + 1 is KINDS[k].
LABELS = 1 + len(KINDS)
LONGEST = 20
WEIGHTS = 1 << 15
AROUND = 96

Span = tuple[int, int, int]  # kind, start, end

# The contract's patterns; possessive where nothing can be given back, and never started inside a run that has failed.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The email pattern, from each at sign outwards: linear also where long runs hold none."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The contract's spans by kind and start."""
    out: list[Span] = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out.extend((1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((3, *m.span()))
    return out


# ---- candidate segments -------------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
_TRIGGER = re.compile(r"[0-9]|@|[(\[{]\s?at\s?[)\]}]|\b(?P<word>at)\b", re.I)
_AT = re.compile(r"@|[(\[{]\s?at\s?[)\]}]|\bat\b", re.I)
_DOT = re.compile(r"\w\.\w|\w\s\.\s\w|[(\[{]\s?(?:dot|\.)\s?[)\]}]|\bdot\b", re.I)
#: What an address or a dotted quad is made of, whatever stands for at sign and dots.
_ATS = r"(?:\s?@\s?|\s?[(\[{]\s?at\s?[)\]}]\s?|\sat\s)"
_DOTS = r"(?:\s?\.\s?|\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\sdot\s)"
_ADDRESS = re.compile(rf"[\w+%-]+(?:{_DOTS}[\w+%-]+)*{_ATS}[\w-]+(?:{_DOTS}[\w-]+)*{_DOTS}[^\W\d_]{{2,}}", re.I)
_QUAD = re.compile(rf"\d{{1,3}}(?:{_DOTS}\d{{1,3}}){{3}}", re.I)
_WORDS = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"[\w-]+")


def _shape(text: str) -> str:
    """Words become a, numbers the count of their digits."""
    return re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 9)), _WORDS.sub("a", text))


def _known(word: str) -> str:
    """A word that makes a place of what follows, or any name: names themselves are no feature, so that unseen ones count alike."""
    return word.lower() if word.lower() in PLACES else "name"


def regions(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Parts around digits and at signs, also written out where a dot is near, that no base span covers; base spans bound them."""
    if not _TRIGGER.search(text):
        return []
    blocks = sorted((s, e) for _, s, e in taken)
    out: list[list[int]] = []
    k = 0
    for m in _TRIGGER.finditer(text):
        at = m.start()
        while k < len(blocks) and blocks[k][1] <= at:
            k += 1
        if k < len(blocks) and blocks[k][0] <= at:
            continue
        low = blocks[k - 1][1] if k else 0
        high = blocks[k][0] if k < len(blocks) else len(text)
        start, end = max(low, at - AROUND), min(high, m.end() + AROUND)
        if m["word"] and not _DOT.search(text, start, end):
            continue  # the common word
        if out and start <= out[-1][1] and low <= out[-1][0]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _bucket(label: int, feature: str) -> int:
    return zlib.crc32(f"{label}|{feature}".encode()) % WEIGHTS


class Lattice:
    """Tokens of a region and its candidate segments: (first token, past last token, label, feature buckets)."""

    def __init__(self, text: str, start: int, end: int):
        self.tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
        # a token that the region's edge has cut is no place for an entity to begin or end
        self.segments: list[tuple[int, int, int, list[int]]] = []
        tokens, n = self.tokens, len(self.tokens)
        for i, (s, e) in enumerate(tokens):
            word = text[s:e]
            kind = "d" if word[0].isdigit() else "a" if word[0].isalpha() else word
            self.segments.append((i, i + 1, 0, [_bucket(0, "bias"), _bucket(0, f"k:{kind}:{min(len(word), 9)}")]))
        for i in range(n):
            s = tokens[i][0]
            if not (text[s].isalnum() or text[s] in "+("):
                continue
            digits = 0
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                s2, e = tokens[j - 1]
                if j > i + 1 and s2 - tokens[j - 2][1] > 1:
                    break  # more than one white-space character
                digits += e - s2 if text[s2] in "0123456789" else 0
                if not text[e - 1].isalnum():
                    continue
                span = text[s:e]
                at = bool(_AT.search(span)) and bool(_DOT.search(span))
                if (digits < 4 and not at) or s and text[s - 1].isalnum() or e < len(text) and text[e].isalnum():
                    continue
                labels = self._possible(span, digits, at)
                if labels:
                    features = self._features(text, s, e, span, digits, j - i, at)
                    for label in labels:
                        self.segments.append((i, j, label, [_bucket(label, f) for f in features]))

    @staticmethod
    def _possible(span: str, digits: int, at: bool) -> list[int]:
        """Labels that the span's own content allows; the weights decide among them and against none."""
        out = [1] if at and _ADDRESS.fullmatch(span) else []
        if 4 <= digits <= 12 and _QUAD.fullmatch(span) and all(int(x) <= 255 for x in re.findall("[0-9]+", span)):
            out.append(2)
        if digits < 9 or re.search(r"[^\W\d_]", span):
            return out
        if 13 <= digits <= 19 and luhn("".join(re.findall("[0-9]+", span))):
            out.append(3)
        if digits <= 15:
            out.append(4)
        return out

    @staticmethod
    def _features(text: str, s: int, e: int, span: str, digits: int, n: int, at: bool) -> list[str]:
        numbers = re.findall("[0-9]+", span)
        letters = re.findall(r"[^\W\d_]+", span)
        octets = len(numbers) == 4 and all(int(x[:4]) <= 255 for x in numbers)
        before = re.search(r"(\w*)\W{0,2}$", text[max(0, s - 16) : s])
        between = re.split("[0-9]+", span)[1:-1]
        sizes = [len(x) for x in numbers]
        local = _AT.split(span, maxsplit=1)[0] if at else ""
        names = _WORDS.findall(local)
        touching = (s > 0 and not text[s - 1].isspace() and text[s - 1] not in "(\"'<:=,") * 2 + (e < len(text) and (text[e].isalnum() or text[e] in "=/_@"))
        return [
            "bias",
            f"shape:{_shape(span)[:24]}",
            f"digits:{min(digits, 20)}:{bool(letters)}",
            f"tokens:{n}:{at}",
            f"luhn:{13 <= digits <= 19 and not letters and luhn(''.join(numbers))}:{13 <= digits <= 19}",
            f"octets:{octets}",
            f"at:{at}:{len(letters) >= 3}",
            f"before:{before.group(1).lower() if before else ''}",
            f"touch:{touching}",
            "sep:" + "".join(sorted(set(re.sub(r"[\w]", "", span)))),
            f"end:{letters[-1].lower() if letters and at else ''}",
            f"between:{'|'.join(dict.fromkeys(between))[:24]}:{len(between)}",
            f"groups:{'-'.join(map(str, sizes[:8]))}",
            f"book:{numbers[0] in ('978', '979') if numbers else False}:{digits == 13}",
            f"thousands:{len(sizes) > 2 and sizes[0] <= 3 and set(sizes[1:]) == {3} and set(between) <= {',', '.'}}",
            f"local:{_known(names[0]) if len(names) == 1 else len(names)}:{bool(re.search('[0-9._-]', local))}" if at else "local:none",
            f"thing:{before.group(1).lower() in THINGS if before else False}:{_known(names[0]) if len(names) == 1 else len(names)}" if at else "thing:none",
            f"cue:{not CONTACT.isdisjoint(_WORD.findall(text[max(0, s - 48) : s].lower()))}:{_known(names[0]) == 'name' if names else False}" if at else "cue:none",
            f"provider:{not PROVIDERS.isdisjoint(w.lower() for w in letters)}" if at else "provider:none",
            f"host:{any(w.lower() == 'www' for w in letters)}:{'@' in span}:{bool(re.search(r'[(\[{]', span))}:{bool(re.search(r'(?i)\bdot\b', span))}" if at else "host:none",
            f"spaced:{any(c.isspace() for c in local)}:{len(re.findall(r'(?i)\bdot\b', local))}" if at else "spaced:none",
            f"first:{span[0] if not span[0].isalnum() else 'd' if span[0].isdigit() else 'a'}:{span.count('(') == span.count(')')}",
        ]


class SemiMarkov:
    """Segment weights and label transitions; exact inference over all segmentations."""

    def __init__(self):
        self.weights = np.zeros(WEIGHTS)
        self.transitions = np.zeros((LABELS, LABELS))

    def _by_end(self, lattice: Lattice) -> tuple[np.ndarray, list[list[int]]]:
        flat = np.fromiter((x for *_, f in lattice.segments for x in f), np.int64)
        sizes = np.fromiter((len(f) for *_, f in lattice.segments), np.int64)
        scores = np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes)
        ends: list[list[int]] = [[] for _ in range(len(lattice.tokens) + 1)]
        for k, (_, j, _, _) in enumerate(lattice.segments):
            ends[j].append(k)
        return scores, ends

    def best(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """(kind, first token, past last token) of the entities of the best segmentation."""
        scores, ends = self._by_end(lattice)
        n = len(lattice.tokens)
        value = np.full((n + 1, LABELS), -np.inf)
        value[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            for k in ends[j]:
                i, _, y, _ = lattice.segments[k]
                come = value[i] + self.transitions[:, y]
                p = int(come.argmax())
                if come[p] + scores[k] > value[j, y]:
                    value[j, y] = come[p] + scores[k]
                    back[j, y] = (i, p)
        out, j, y = [], n, int(value[n].argmax())
        while j:
            i, p = back[j, y]
            if y:
                out.append((y - 1, i, j))
            j, y = i, p
        return out[::-1]

    def learn(self, lattice: Lattice, gold: set[tuple[int, int, int]], rate: float) -> float:
        """One ascent step on the log-likelihood of the gold entities (label, first, past last); returns the largest error of a segment."""
        scores, ends = self._by_end(lattice)
        n, segments = len(lattice.tokens), lattice.segments
        forward, backward = np.full((n + 1, LABELS), -np.inf), np.full((n + 1, LABELS), -np.inf)
        forward[0, 0] = 0
        for j in range(1, n + 1):
            for k in ends[j]:
                i, _, y, _ = segments[k]
                forward[j, y] = np.logaddexp(forward[j, y], np.logaddexp.reduce(forward[i] + self.transitions[:, y]) + scores[k])
        backward[n] = 0
        for j in range(n, 0, -1):
            for k in ends[j]:
                i, _, y, _ = segments[k]
                backward[i] = np.logaddexp(backward[i], self.transitions[:, y] + scores[k] + backward[j, y])
        whole = backward[0, 0]
        change: dict[int, float] = {}
        worst = 0.0
        steps = np.zeros_like(self.transitions)
        inside = {t for y, i, j in gold for t in range(i, j)}
        order = {0: 0}
        for y, i, j in gold:
            order[j] = y
        for k, (i, j, y, features) in enumerate(segments):
            share = np.exp(forward[i] + self.transitions[:, y] + scores[k] + backward[j, y] - whole)
            steps[:, y] -= share
            hit = (y, i, j) in gold if y else i not in inside
            if hit:
                steps[order.get(i, 0), y] += 1
            d = hit - share.sum()
            if abs(d) > 1e-6:
                worst = max(worst, abs(d))
                for f in features:
                    change[f] = change.get(f, 0.0) + d
        if change:
            self.weights[list(change)] += rate * np.array(list(change.values()))
        self.transitions += 0.1 * rate * steps
        return worst


# ---- training sentences -------------------------------------------------------------------------------------------

#: Words before "at" and a host that make a place of it, not an address; and words that make the next one a thing.
PLACES = """look looking meet met see visit found find posted available hosted based read listen work works working study arrive arrived stop stay live
lives download downloads online sold shown listed published more details here us it them starts ends aimed order orders buy page site server error file docs prices
tickets news shop store deals offers reviews blog forum wiki help archive mirror demo map maps jobs careers events program programs people friends team staff office
school home desk anyone everyone someone engineer manager editor writer developer researcher professor student director intern employee ceo
website webpage copy copies code source sources data paper papers video videos article articles documentation guide information info register registered
apply join watch stream play free now today again directly check checked started worked employed""".split()
THINGS = ("the", "a", "an", "our", "your", "their", "its", "this", "that", "these", "some", "all", "any", "of", "new", "more", "many", "every", "and", "for", "le", "la", "les", "der", "die", "das", "el", "los")
#: Words that tell of an address some way before it; hosts that give addresses to anybody.
CONTACT = frozenset("mail email e-mail mails emails address addresses contact write writes wrote reach send sends ask asked reply kontakt schreiben schreib adresse courriel écrivez écrire correo escriba escríbame escribir dirección".split())
PROVIDERS = frozenset("gmail googlemail hotmail outlook yahoo live msn icloud aol gmx web mail proton protonmail laposte orange free t-online freenet".split())
ADDRESSING = ("write to", "mail", "email", "contact", "reach me as", "my mail is", "my address is", "address:", "send it to", "ask", "e-mail:", "Kontakt:", "escriba a", "écrivez à", "reach us under", "mail me:", "please send it to", "questions to", "contact me:")
#: Words that lead to an address, number or card; and to numbers that are none.
LEADS = ("call", "tel", "phone:", "mail", "contact", "write to", "e-mail", "reach", "mobile", "fax", "tél.", "telefon", "teléfono", "ip", "host", "server", "card", "visa", "no.", "from", "pay with", "at", "email me:", "ask")
COUNTS = ("isbn", "order", "ref", "invoice", "version", "sum", "total", "population", "date", "on", "serial", "ssn", "since", "page", "score", "section", "about", "paid", "tracking", "the")


def _sentence(rng: random.Random) -> list[tuple[str, int]]:
    """(text, label) parts of one sentence; written-out, bracketed, dotted and spaced forms, and numbers that are none."""
    word = lambda: "".join(rng.choice(("an", "er", "th", "on", "re", "mo", "li", "sta", "ver", "que", "un", "de", "io")) for _ in range(rng.randint(1, 4)))
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    end = lambda: rng.choice(("com", "org", "net", "de", "fr", "es", "io", "info", "co.uk", "edu"))

    def card(good: bool) -> str:
        body = rng.choice("3456") + d(14)
        last = next(c for c in "0123456789" if luhn(body + c) == good)
        return body + last

    def email() -> str:
        at, dot = rng.choice(((" at ", " dot "), (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " dot "), ("(at)", "."), (" AT ", " DOT "), (" (at) ", "."), (" @ ", " . "), ("{at}", "{dot}")) + ((" at ", "."),) * 8)
        joint = rng.choice((".", "_", "-", dot if dot != " . " else ".", dot if dot != " . " else "."))
        user = word() + rng.choice(("", "", "", joint + word(), d(2), joint + d(2), joint + rng.choice("abcdefg") + joint + word() if rng.random() < 0.3 else ""))
        user = user.capitalize() if rng.random() < 0.15 else user
        host = rng.choice(("mail" + d(1), word(), word(), word() + "-" + word(), rng.choice(sorted(PROVIDERS)))) + dot + rng.choice(("", "", "example" + dot))
        return user + at + host + end().replace(".", dot)

    def phone() -> str:
        a, b, c = d(3), d(3), d(4)
        return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"001 {a} {b} {c}", f"1 ({a}) {b}-{c}", f"0{d(3)} {d(7)}", f"00{d(2)} {d(3)} {d(7)}", f"{a} {b} {c}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"({a}) {b} {c}", f"0{d(3)}-{d(7)}", f"0{d(2)}/{d(7)}", f"9{d(2)} {d(3)} {d(3)}"))

    def ip() -> str:
        sep = rng.choice((" . ", "[.]", "(.)", " dot ", "[dot]", ". "))
        return sep.join(str(rng.randint(0, rng.choice((9, 255, 255)))) for _ in range(4))

    def clock() -> str:
        return f"{rng.randint(0, 23):02}:{d(2)}" + rng.choice(("", f":{d(2)}", f":{d(2)}.{d(3)}"))

    def date() -> str:
        y, m, n = rng.randint(1900, 2035), rng.randint(1, 12), rng.randint(1, 28)
        return rng.choice((f"{y}-{m:02}-{n:02}", f"{n:02}.{m:02}.{y}", f"{n}/{m}/{y}", f"{m:02}/{n:02}/{y % 100:02}", f"{n:02}", f"{y}/{m:02}/{n:02}", f"{n}. {m}. {y}", f"{n:02}-{m:02}-{y}"))

    def no_entity() -> str:
        return rng.choice(
            (
                lambda: str(rng.randint(1900, 2030)),
                date,
                lambda: f"{date()}{rng.choice((' ', 'T', ', ', ' um ', ' at '))}{clock()}",
                lambda: f"{date()} {clock()}",
                lambda: f"{date()} {rng.choice(('-', 'to', '–', 'bis'))} {date()}",
                lambda: f"{rng.choice(('978', '979'))}-{d(1)}-{d(2)}-{d(6)}-{d(1)}",
                lambda: f"{rng.choice(('978', '979'))}{rng.choice(('-', ' ', ''))}{d(10)}",
                lambda: f"{d(1)}-{d(2)}-{d(6)}-{rng.choice((d(1), 'X'))}",
                lambda: f"{d(3)}-{d(2)}-{d(4)}",
                lambda: f"{d(3)}-{d(2)}-{d(4)}",
                lambda: rng.choice(",.").join((str(rng.randint(1, 999)), *(d(3) for _ in range(rng.randint(1, 4))))),
                lambda: rng.choice(",.").join((str(rng.randint(1, 999)), d(3), d(3))),
                lambda: f"{d(1)}.{d(1)}.{d(1)}",
                lambda: f"{d(1)},{d(3)}.{d(2)}",
                lambda: f"{d(rng.randint(1, 3))}{rng.choice('.,')}{d(rng.randint(8, 16))}",
                lambda: "-".join(d(1) for _ in range(rng.randint(3, 6))),
                lambda: ", ".join(str(rng.randint(0, 255)) for _ in range(rng.randint(3, 6))),
                lambda: f"{d(2)}.{d(4)}, {d(1)}.{d(4)}",
                lambda: f"{d(2)}:{d(2)}:{d(2)}:{d(2)}",
                lambda: f"password={d(9)}{word()}{d(6)}",
                lambda: f'token="{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"',
                lambda: d(rng.randint(1, 12)),
                lambda: card(False),
                lambda: f"{card(False)[:4]} {d(4)} {d(4)} {d(3)}",
                lambda: d(rng.randint(15, 24)),
                lambda: f"at {word()} the {word()}.",
                lambda: f"{rng.choice(PLACES)} at {rng.choice(('', '', 'www.'))}{word()}.{end()}",
                lambda: f"{rng.choice(PLACES)} at {rng.choice(('', '', 'www.'))}{word()}.{end()}",
                lambda: f"{rng.choice(PLACES)} at {word()}.{end()}",
                lambda: f"{rng.choice(THINGS)} {word()} at {rng.choice(('', '', 'www.'))}{word()}.{end()}",
                lambda: f"{rng.choice(THINGS)} {word()} at {word()}.{end()}",
                lambda: f"{word()} at www.{word()}.{end()}",
                lambda: f"{rng.choice(PLACES)} at {word()} dot {word()}",
                lambda: f"version {d(1)}.{d(2)}",
                lambda: f"id {d(6)}-{d(4)}",
                lambda: f"{d(4)}-{d(4)}-{d(2)}",
                lambda: f"{d(2)} {d(3)} {word()} {d(4)}",
                lambda: f"key {''.join(rng.choice('ABCDEFGHJK0123456789') for _ in range(20))}",
                lambda: f"{rng.choice(('DE', 'FR', 'GB'))}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}",
                lambda: f"{d(5)} {word()}",
                lambda: f"{rng.randint(1, 99)} x {rng.randint(1, 99)} x {rng.randint(100, 999)} mm",
            )
        )()

    def cut_card() -> str:
        c = card(True)
        if rng.random() < 0.25:
            return c + " "  # beside another number, which hides it from the base pattern
        return rng.choice((".", "/", "/ ", " . ", "_")).join((c[:4], c[4:8], c[8:12], c[12:]))

    makers = ((1, email), (2, ip), (3, cut_card), (4, phone))
    parts: list[tuple[str, int]] = [(" ".join(word() for _ in range(rng.randint(1, 4))), 0)]
    for _ in range(rng.randint(1, 2)):
        if rng.random() < 0.45:
            label, make = rng.choice(makers)
            if label == 1 and rng.random() < 0.7:
                parts.append((rng.choice(ADDRESSING), 0))
            elif rng.random() < 0.5:
                parts.append((rng.choice(LEADS), 0))
            made = make()
            parts.append((made.strip(), label))
            if made.endswith(" "):
                parts.append((card(False) if rng.random() < 0.7 else d(16), 0))
        else:
            if rng.random() < 0.4:
                parts.append((rng.choice(COUNTS), 0))
            parts.append((no_entity(), 0))
        parts.append((" ".join(word() for _ in range(rng.randint(1, 4))) + rng.choice(("", ".", ",")), 0))
    return parts


@lru_cache(maxsize=1)
def trained(sentences: int = 2400, epochs: int = 6, seed: int = 4) -> SemiMarkov:
    """The model, trained on as many generated sentences; made once, on the driver. Weights are the mean over the later half of the epochs."""
    rng, model, rows = random.Random(seed), SemiMarkov(), []
    for _ in range(sentences):
        text, marks = "", []
        for part, label in _sentence(rng):
            text += " " if text else ""
            if label:
                marks.append((label, len(text), len(text) + len(part)))
            text += part
        lattice = Lattice(text, 0, len(text))
        if len(lattice.segments) == len(lattice.tokens):
            continue  # no candidate, nothing to learn
        first, past = {s: k for k, (s, _) in enumerate(lattice.tokens)}, {e: k + 1 for k, (_, e) in enumerate(lattice.tokens)}
        gold = {(y, first[s], past[e]) for y, s, e in marks if s in first and e in past}
        there = {(y, i, j) for i, j, y, _ in lattice.segments}
        if gold <= there:
            rows.append([lattice, gold, 1.0])
    weights, transitions, counted = np.zeros_like(model.weights), np.zeros_like(model.transitions), 0
    for epoch in range(epochs):
        rng.shuffle(rows)
        for row in rows:
            if row[2] > 0.02 or rng.random() < 0.2:  # what is learnt well is looked at again now and then
                row[2] = model.learn(row[0], row[1], 0.3 / (1 + epoch))
        if epoch >= epochs // 2:
            weights, transitions, counted = weights + model.weights, transitions + model.transitions, counted + 1
    model.weights, model.transitions = weights / counted, transitions / counted
    return model


def added_spans(text: str, taken: list[Span], model: SemiMarkov) -> list[Span]:
    out = []
    for start, end in regions(text, taken):
        lattice = Lattice(text, start, end)
        if len(lattice.segments) > len(lattice.tokens):
            out.extend((kind, lattice.tokens[i][0], lattice.tokens[j - 1][1]) for kind, i, j in model.best(lattice))
    return out


def all_spans(text: str, model: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), by kind and start."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, model))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone of base spans, base_sha256, spans: all). Narrow: one pass over the scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in text_batches(batches):
            counts, sums, lists = [[] for _ in KINDS], [], []
            for text in b.column(1).to_pylist():
                base, spans = all_spans(text, model)
                for k, out in enumerate(counts):
                    out.append(sum(s[0] == k for s in base))
                sums.append(hashlib.sha256(listed(base).encode()).hexdigest())
                lists.append(listed(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums, pa.string()), pa.array(lists, pa.string())], names=names)

    schema = f"`{id_col}` {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("__t")).mapInArrow(run, schema)


def redacted(text: str, model: SemiMarkov) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the parts are covered once."""
    spans = sorted((s, e, k) for k, s, e in all_spans(text, model)[1])
    out, done = [], 0
    for s, e, k in spans:
        if s >= done:
            out += [text[done:s], f"[{KINDS[k].upper()}]"]
        done = max(done, e)
    return "".join(out) + text[done:] if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of docs with spans of the text replaced."""
    at = docs.columns.index(text_col)

    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in text_batches(batches):
            texts = [None if t is None else redacted(t, model) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(b.columns)], names=b.schema.names)

    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, docs.withColumn(text_col, F.col(text_col).cast("string")).schema)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir))


ORACLE_SQL = None

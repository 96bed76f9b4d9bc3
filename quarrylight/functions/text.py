"""Column builders for text: tokenisers, line windows, normalisers and hashes. All stay inside the JVM but lexical_tokens."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Token patterns and character ranges.
WORD_PATTERN = r"[a-zA-Z0-9_]+|[\x{4e00}-\x{9fff}]+"
JOINERS, FEW_JOINERS = "._+#/-", "._/-"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
LETTER = r"[A-Za-z\x{4e00}-\x{9fff}]"
HEADING = r"(?m)^#{1,3}\s+(.+)$"
WORD_OR_IDEOGRAM = r"[\x{4e00}-\x{9fff}]|[\p{L}\p{N}_]+"
LINE_CHARS = 300
WINDOW_LINES = 24
WINDOW_STEP = 16


def _grams(token: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(token) - (n - 1)), lambda i: F.substring(token, i, F.lit(n)))


def word_tokens(text: Column) -> Column:
    """Lower-cased ASCII words; runs of ideographs as overlapping pairs, single ones as they are."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    return F.when(~text.rlike(r"[\x{4e00}-\x{9fff}]"), found).otherwise(_with_pairs(found))


def _with_pairs(found: Column) -> Column:
    return F.flatten(F.transform(found, lambda t: F.when(t.rlike(r"^[\x{4e00}-\x{9fff}]{2,}$"), _grams(t, 2)).otherwise(F.array(t))))


def blank_tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")


def _fold(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


def folded(text: Column) -> Column:
    """NFKC and case folding, which no built-in does."""
    return F.pandas_udf(_fold, "string")(text)


def lexical_tokens(folded_text: Column, joiners: str = JOINERS) -> Column:
    """Words with inner joiners; runs of ideographs as all pairs, then all triples. Takes text that folded() has made; with FEW_JOINERS plus
    and hash signs part words."""
    found = F.regexp_extract_all(folded_text, F.lit(rf"[a-z0-9]+(?:[{joiners}][a-z0-9]+)*|[\x{{3400}}-\x{{9fff}}]+"), F.lit(0))
    run = r"^[\x{3400}-\x{9fff}]+$"
    many = lambda t: F.when(F.length(t) >= 3, F.concat(_grams(t, 2), _grams(t, 3))).otherwise(_grams(t, 2))
    return F.flatten(F.transform(found, lambda t: F.when(t.rlike(run) & (F.length(t) > 1), many(t)).otherwise(F.array(t))))


def lines(text: Column) -> Column:
    """Lines without their breaks; a break at the end opens no line."""
    kept = lambda s: F.when(F.element_at(s, -1) == "", F.slice(s, 1, F.size(s) - 1)).otherwise(s)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.flatten(F.transform(F.array(F.split(text, LINE_BREAK)), kept)))


def bounded_lines(text: Column, chars: int = LINE_CHARS) -> Column:
    """Lines cut into pieces of at most so many characters; an empty line stays."""
    pieces = lambda line: F.transform(F.sequence(F.lit(0), F.greatest(F.length(line) - 1, F.lit(0)), F.lit(chars)), lambda k: F.substring(line, k + 1, F.lit(chars)))
    return F.flatten(F.transform(lines(text), pieces))


def line_windows(bounded: Column, size: int = WINDOW_LINES, step: int = WINDOW_STEP) -> Column:
    """array<struct<start_line, lines>>: overlapping windows; start_line counts from 1."""
    starts = lambda b: F.when(F.size(b) > 0, F.sequence(F.lit(0), F.size(b) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    cut = lambda b: F.transform(starts(b), lambda s: F.struct((s + 1).alias("start_line"), F.slice(b, s + 1, F.lit(size)).alias("lines")))
    return F.flatten(F.transform(F.array(bounded), cut))  # lines are named once, so that they are cut once


def windowed_tokens(bounded: Column, size: int = WINDOW_LINES, step: int = WINDOW_STEP) -> Column:
    """array<struct<start_line, lettered, tokens>>: the windows of line_windows() with their word tokens; a line is tokenised once."""
    told = F.transform(bounded, lambda line: F.struct(line.rlike(LETTER).alias("lettered"), word_tokens(line).alias("tokens")))
    starts = F.when(F.size(bounded) > 0, F.sequence(F.lit(0), F.size(bounded) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    part = lambda lines: lambda s: F.slice(lines, s + 1, F.lit(size))
    whole = lambda lines: F.transform(starts, lambda s: F.struct((s + 1).alias("start_line"), F.exists(part(lines)(s), lambda x: x["lettered"]).alias("lettered"), F.flatten(F.transform(part(lines)(s), lambda x: x["tokens"])).alias("tokens")))
    return F.flatten(F.transform(F.array(told), whole))


def sentences(text: Column) -> Column:
    """Pieces after each end mark or line break, trimmed, without blank ones."""
    pieces = F.regexp_extract_all(text, F.lit(r"[^。！？.!?\n]*[。！？.!?\n]|[^。！？.!?\n]+$"), F.lit(0))
    return F.filter(F.transform(pieces, lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), lambda s: s != "")


def clean(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def truncated(text: Column, n: int) -> Column:
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, n - 1)), F.lit("...")))


def normal_markdown(text: Column) -> Column:
    return F.concat(F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"^\s+|\s+$", ""), F.lit("\n"))


def headings(markdown: Column) -> Column:
    """Distinct headings of the first three levels, without the links in them."""
    plain = lambda h: F.regexp_replace(F.regexp_replace(h, r"\s*\[[^\]]*\]\([^)]*\)", ""), r"^\s+|\s+$", "")
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(markdown, F.lit(HEADING), F.lit(1)), plain), lambda h: h != ""))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD_OR_IDEOGRAM), F.lit(0)))


def url_slug(url: Column, longest: int = 100) -> Column:
    """Host, path and query of an address as a file name: each other character becomes a low line; page if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    place, query = F.regexp_extract(bare, r"^[^?]*", 0), F.regexp_extract(bare, r"\?(.+)$", 1)
    raw = F.concat(F.regexp_replace(place, r"^/+|/+$", ""), F.when(query != "", F.concat(F.lit("_"), query)).otherwise(""))
    name = F.regexp_replace(F.regexp_replace(raw, r"[^\p{L}\p{N}._-]", "_"), r"^[._-]+|[._-]+$", "")
    return F.substring(F.when(name == "", "page").otherwise(name), 1, longest)


def lookup_text(folded_text: Column) -> Column:
    """What names are compared by: unit and spelling variants unified, everything but letters, digits and ideographs dropped."""
    t = F.regexp_replace(folded_text, r"(\d+)\s*kv", "$1千伏")
    return F.regexp_replace(F.regexp_replace(t, "签订", "签定"), r"[^0-9a-z\x{3400}-\x{9fff}]", "")


def short_hash(text: Column, n: int) -> Column:
    return F.substring(F.sha2(text, 256), 1, n)


def normalized_dates(text: Column) -> Column:
    """Distinct ISO dates of year, month, day written with ideographs, dashes or slashes."""
    pattern = r"\d{4}(?:年\d{1,2}月\d{1,2}日|-\d{1,2}-\d{1,2}|/\d{1,2}/\d{1,2})"
    part = lambda d, k, n: F.lpad(F.element_at(F.regexp_extract_all(d, F.lit(r"\d+"), F.lit(0)), k), n, "0")
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda d: F.concat_ws("-", part(d, 1, 4), part(d, 2, 2), part(d, 3, 2))))


def clock(seconds: Column) -> Column:
    """HH:MM:SS.ss, with the carry of rounding."""
    hundredths = F.round(seconds * 100).cast("long")
    whole = F.floor(hundredths / 100)
    return F.format_string("%02d:%02d:%02d.%02d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60, hundredths % 100)


def subtitle_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm, with the carry of rounding."""
    ms = F.round(seconds * 1000).cast("long")
    whole = F.floor(ms / 1000)
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60, ms % 1000)


def numbered(lines_: Column, first: Column | int = 1) -> Column:
    """Lines as one text, each led by its number."""
    start = F.lit(first) if isinstance(first, int) else first
    return F.array_join(F.transform(lines_, lambda line, k: F.concat((start + k).cast("string"), F.lit(": "), line)), "\n")

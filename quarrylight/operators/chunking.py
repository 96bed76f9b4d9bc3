"""Chunkers that carry state through a text, as pandas UDFs; what needs none is in functions.text."""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Separators from coarse to fine; the first ones with whether a piece keeps the separator at its end.
PLAIN = (("\n\n", False), ("\n", False), ("。", True), (".", True), ("！", True), ("!", True), ("？", True), ("?", True), ("；", True), (";", True), ("，", True), (",", True), (" ", False), ("", False))
MERGED = ("\n\n", "\n", "。", "；", "！", "？", "，", "、", " ", "")
PAGED = ("\n\n", "\n", "。", ". ", " ", "")
END_MARKS = "。！？!?；;，,"


def split_plain(text: str, size: int, separators: tuple[tuple[str, bool], ...] = PLAIN) -> list[str]:
    """Pieces of at most ``size``: by the first separator that gives several, finer ones within; never merged again."""
    if len(text) <= size:
        return [text] if text else []
    for k, (mark, kept) in enumerate(separators):
        if mark == "":
            return list(text)
        pieces = [p for p in re.split(f"(?<={re.escape(mark)})" if kept else re.escape(mark), text) if p]
        if len(pieces) > 1:
            return [q for p in pieces for q in split_plain(p, size, separators[k + 1 :])]
    return [text[i : i + size] for i in range(0, len(text), size)]


def recursive(text: str, size: int = 512, overlap: int = 64) -> list[str]:
    """Pieces, each led by the last ``overlap`` characters of the one before."""
    pieces = [p for p in map(str.strip, split_plain(re.sub(r"[ \t]+", " ", text), size)) if p] if text.strip() else []
    return [(pieces[k - 1][-overlap:] if k and overlap else "") + p for k, p in enumerate(pieces)]


def _pieces(text: str, mark: str, side: str) -> list[str]:
    """The text cut at a mark, which stays at the end of the piece before or at the start of the piece after it."""
    if mark == "":
        return list(text)
    parts = text.split(mark)
    kept = [p + mark for p in parts[:-1]] + parts[-1:] if side == "end" else parts[:1] + [mark + p for p in parts[1:]]
    return [p for p in kept if p]


def _packed(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Runs of pieces up to ``size``, each led by what fits of the run before in ``overlap``; trimmed, blank ones dropped."""
    out, run, total = [], [], 0
    for p in pieces:
        if run and total + len(p) > size:
            out.append("".join(run))
            while run and (total > overlap or total + len(p) > size):
                total -= len(run.pop(0))
        run.append(p)
        total += len(p)
    out.append("".join(run))
    return [c for c in map(str.strip, out) if c]


def merging(text: str, size: int = 872, overlap: int = 160, separators: tuple[str, ...] = MERGED, side: str = "end") -> list[tuple[int, str]]:
    """(start, chunk): runs of pieces under ``size`` are packed together; a longer piece is cut by finer separators on its own.

    Nothing is packed across such a piece. start is where the chunk is found, from the least place it can have.
    """

    def cut(part: str, marks: tuple[str, ...]) -> list[str]:
        k = next((k for k, m in enumerate(marks) if m in part), len(marks) - 1)
        out, run = [], []
        for p in _pieces(part, marks[k], side):
            if len(p) < size:
                run.append(p)
                continue
            out += _packed(run, size, overlap)
            run = []
            out += cut(p, marks[k + 1 :]) if k + 1 < len(marks) else [p]
        return out + _packed(run, size, overlap)

    found, at, before = [], 0, 0
    for c in cut(text, separators):
        at = text.find(c, max(0, at + before - overlap))
        before = len(c)
        found.append((at, c))
    return found


def chunk(docs: DataFrame, mode: str = "recursive", size: int = 512, overlap: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, chunk_index, start, chunk) of every text; mode recursive (start is null), merging or paged (separators of pages)."""

    def one(text: str) -> list[tuple[int | None, str]]:
        if mode == "recursive":
            return [(None, c) for c in recursive(text, size, overlap)]
        return merging(text, size, overlap) if mode == "merging" else merging(text, size, overlap, PAGED, "start")

    @F.pandas_udf("array<struct<start: int, chunk: string>>")
    def cut(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [{"start": s, "chunk": c} for s, c in one(t or "")])

    return docs.select(id_col, F.posexplode(cut(F.col(text_col))).alias("chunk_index", "c")).select(id_col, "chunk_index", F.col("c.start").alias("start"), F.col("c.chunk").alias("chunk"))


def subtitle_pieces(text: str, most: int) -> list[str]:
    """A transcript segment in pieces of at most ``most`` characters: as many whole parts as fit, a part running to an end mark; a longer part is cut hard on its own."""
    if len(text) <= most:
        return [text]
    parts = [text[m.start() : m.end() + 1].strip() for m in re.finditer(f"[^{END_MARKS}]+", text)] or [text]
    reach, pieces, k = [0, *accumulate(map(len, parts))], [], 0
    while k < len(parts):
        fit = max(bisect_right(reach, reach[k] + most) - 1, k + 1)  # parts k to fit make one piece
        whole = "".join(parts[k:fit])
        pieces += [whole[i : i + most] for i in range(0, len(whole), most)]
        k = fit
    return pieces

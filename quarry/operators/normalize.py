"""Rewrites of markdown bodies, one document at a time, as Arrow-batched UDFs.

Each rewrite is a plain function of a text (tested as such); udf() gives it to Spark. A document
that a rewrite fails on keeps its text and names the error.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Callable
from itertools import zip_longest

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HEADING = re.compile(r"^(#{1,6})[ \t]+(\S.*)$")
FENCE = re.compile(r"^ {0,3}(```|~~~)")
LEADER = re.compile(r"\s*\.{4,}\s*[0-9ivxlc]*\s*$")
COMMENT = re.compile(r"\s*<!--.*-->\s*")
BLANKS = re.compile(r"\n{3,}")
GAP = re.compile(r"\n[ \t]*\n")
#: Characters: where packing aims, and what no chunk may pass.
TARGET, HARD = 4000, 8000


def fence_mask(lines: list[str]) -> np.ndarray:
    """For each line, whether it is a fence or lies between two: the number of fences up to it is odd, or it is one."""
    mask = np.zeros(len(lines), bool)
    marks = [i for i, x in enumerate(lines) if ("```" in x or "~~~" in x) and FENCE.match(x)]
    for a, b in zip_longest(marks[::2], marks[1::2], fillvalue=len(lines) - 1):
        mask[a : b + 1] = True
    return mask


def _outside_fences(body: str, change: Callable[[str], str]) -> str:
    lines = body.split("\n")
    return "\n".join(line if fenced else change(line) for line, fenced in zip(lines, fence_mask(lines).tolist(), strict=True))


def heading_lines(lines: list[str]) -> list[tuple[int, re.Match]]:
    """The lines that are headings, with what they say; a line is within a fence if the fences above it are odd in number."""
    found = [(i, m) for i, x in enumerate(lines) if x[:1] == "#" and (m := HEADING.match(x))]
    marks = [i for i, x in enumerate(lines) if ("```" in x or "~~~" in x) and FENCE.match(x)] if found else []
    return [(i, m) for i, m in found if bisect(marks, i) % 2 == 0] if marks else found


def heading_levels(lines: list[str]) -> np.ndarray:
    """The level of each line's heading, 0 where it is none."""
    levels = np.zeros(len(lines), np.int64)
    for i, m in heading_lines(lines):
        levels[i] = len(m[1])
    return levels


def infer_heading_levels(body: str) -> str:
    """Levels without gaps: a heading is at most one below the one it stands under; the order of levels stays.

    The new level counts the open headings: for each level the last heading of it is open if none of its level or
    a smaller one came after it."""
    lines = body.split("\n")
    levels = heading_levels(lines).tolist()
    at = [i for i, n in enumerate(levels) if n]
    if not at:
        return body
    shallowest = min(levels[i] for i in at)
    open_: list[int] = []  # levels of the headings that the present one stands under, and its own
    for k in at:
        level = levels[k]
        while open_ and open_[-1] >= level:
            open_.pop()
        open_.append(level)
        lines[k] = "#" * min(6, shallowest + len(open_) - 1) + " " + HEADING.match(lines[k])[2]
    return "\n".join(lines)


def trim_heading_leaders(body: str) -> str:
    """Headings without dotted leaders and page numbers behind."""
    return _outside_fences(body, lambda x: LEADER.sub("", x) if HEADING.match(x) else x) if "...." in body else body


def strip_artifacts(body: str) -> str:
    """Without comment lines; runs of blank lines are one."""
    kept = "\n".join(x for x in body.split("\n") if not COMMENT.fullmatch(x)) if "<!--" in body else body
    return BLANKS.sub("\n\n", kept)


def decode_entities(body: str) -> str:
    """One level of character references, outside fences."""
    return _outside_fences(body, html.unescape) if "&" in body else body


def blocks(text: str) -> list[str]:
    """Blocks parted by blank lines; a fence and all in it are one block. A block is a run of lines between
    blank lines outside fences, found from the lines' mask."""
    lines = text.split("\n")
    gap = ~fence_mask(lines) & np.fromiter((not x.strip() for x in lines), bool, len(lines))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    return ["\n".join(lines[a:b]) for a, b in edge.reshape(-1, 2).tolist()]


def pieces(block: str, limit: int) -> list[str]:
    """A block in pieces of at most limit characters, each ending at the last line end that fits, else at the limit."""
    out, start = [], 0
    while len(block) - start > limit:
        line_end = block.rfind("\n", start, start + limit + 1)
        stop = line_end if line_end > start else start + limit
        out.append(block[start:stop])
        start = stop + (stop == line_end)
    return [x for x in (*out, block[start:]) if x]


def split_oversized(text: str, target: int = TARGET, hard: int = HARD) -> list[str]:
    """A text longer than ``hard`` in chunks of blocks of about ``target``, each beginning with the last block of the one before.

    Blocks lie one after another at known offsets; a chunk is the longest range of them from its first on that stays
    within the target, and the next one begins with its last block unless that would carry it past ``hard``."""
    if len(text) <= hard:
        return [text]
    parts = [p for b in blocks(text) for p in pieces(b, target)]
    at = np.concatenate(([0], np.cumsum([len(p) + 2 for p in parts])))  # offsets, blocks parted by two characters
    out, first, fresh = [], 0, 0  # fresh: the first block that no chunk holds yet
    while fresh < len(parts):
        last = max(fresh, int(np.searchsorted(at, at[first] + target + 2, "right")) - 2)
        out.append("\n\n".join(parts[first : last + 1]))
        fresh = last + 1
        # One block of overlap, where the chunk had more than that and the next block fits beside it.
        keep = last > first and fresh < len(parts) and at[fresh + 1] - at[last] - 2 <= hard
        first = last if keep else fresh
    return out


def subtract_phrases(body: str, phrases: frozenset[str]) -> str:
    """Without the blocks that are, but for case and white space, a known phrase."""
    key = lambda b: re.sub(r"\s+", " ", b).strip().lower()
    return "\n\n".join(b for b in GAP.split(body) if not phrases or key(b) not in phrases)


def table_blocks(body: str, rows: int = 10, columns: int = 8) -> list[list[list[str]]]:
    """Pipe tables large enough to stand on their own: at least so many rows or columns."""
    found, now = [], []
    for line in [*body.split("\n"), ""]:
        if line.strip().startswith("|"):
            cells = [c.strip() for c in re.split(r"(?<!\\)\|", line.strip().strip("|"))]
            if not all(re.fullmatch(r":?-+:?", c) for c in cells):
                now.append(cells)
        elif now:
            if len(now) >= rows or max(map(len, now)) >= columns:
                found.append(now)
            now = []
    return found


def udf(rewrite: Callable[[str], str]) -> Callable[[Column], Column]:
    """A rewrite as a Column function giving struct(text, error)."""

    @F.pandas_udf("text string, error string")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            try:
                out.append((None if t is None else rewrite(t), None))
            except Exception as e:  # the document is kept and named; the batch goes on
                out.append((t, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["text", "error"])

    return run


def normalize_body(body: str) -> str:
    """All rewrites in order; doing it again changes nothing."""
    for step in (strip_artifacts, trim_heading_leaders, infer_heading_levels):
        body = step(body)
    return body

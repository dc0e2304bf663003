"""Oversized texts cut at natural boundaries, with overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: From the coarsest boundary to the finest: a cut falls at the end of each match.
HIERARCHY = (
    ("section", re.compile(r"\f|\n{3,}|\n(?=\s*(?:第[一二三四五六七八九十百零〇\d]+[章节部]|[一二三四五六七八九十]+、|#{1,6}\s|(?:Section|Chapter|Part|Item)\s+\w+))")),
    ("paragraph", re.compile(r"\n[^\S\n]*\n\s*|\n")),
    ("sentence", re.compile(r"[。！？；…]+[”’」』）》]*|[.!?;]+[\"')\]]*\s+")),
    ("word", re.compile(r"[\W_]+")),
)
NAMES = tuple(n for n, _ in HIERARCHY) + ("character",)
_JOINED = re.compile(r"[̀-ͯ‍️゙゚]")


def cut_points(text: str, limit: int, overlap: int) -> tuple[list[tuple[int, int]], bool]:
    """``(cuts, forced)``: ends of the segments as (position, index into NAMES), in order.

    Each segment is at most ``limit - overlap`` long, so that a piece can hold the overlap and one
    segment at least. A segment is cut on the next finer level only if it is too long. ``forced``
    tells that an unbroken run of letters and digits was longer than ``limit``.
    """
    room = limit - overlap
    forced = False
    cuts: list[tuple[int, int]] = []
    stack = [(0, len(text), 0, 0)]  # start, end, level to cut on, level of the cut at the end
    while stack:
        a, b, level, own = stack.pop()
        if b - a <= room:
            cuts.append((b, own))
            continue
        if level == len(HIERARCHY):
            forced = forced or (b - a > limit and not HIERARCHY[-1][1].match(text, a))
            last = a
            while b - last > room:
                at = last + room
                while at - last > 1 and _JOINED.match(text[at]):
                    at -= 1
                last = last + room if _JOINED.match(text[at]) else at
                cuts.append((last, level))
            cuts.append((b, own))
            continue
        ends = [m.end() for m in HIERARCHY[level][1].finditer(text, a, b) if a < m.end() < b]
        if level == len(HIERARCHY) - 1:
            ends = sorted({*ends, *(m.start() for m in HIERARCHY[level][1].finditer(text, a, b) if a < m.start() < b)})
        edges = [a, *ends, b]
        for i in range(len(edges) - 2, -1, -1):
            stack.append((edges[i], edges[i + 1], level + 1, own if i == len(edges) - 2 else level))
    return cuts, forced


def pieces_of(text: str, limit: int, overlap: int) -> tuple[list[tuple[int, int, int]], bool]:
    """``(pieces, forced)``: (start, end, index into NAMES of the cut at the end; -1 at the text's end)."""
    if len(text) <= limit:
        return [(0, len(text), -1)], False
    cuts, forced = cut_points(text, limit, overlap)
    out, start, i = [], 0, 0
    while True:
        if start + limit >= len(text):
            out.append((start, len(text), -1))
            return out, forced
        done = out[-1][1] if out else 0
        while i + 1 < len(cuts) and cuts[i + 1][0] <= start + limit:
            i += 1
        end, level = cuts[i]
        if end <= done:  # can't happen while every segment fits beside the overlap
            raise AssertionError("no segment fits")
        out.append((start, end, level))
        start = end - overlap


def split_texts(df: DataFrame, *, key: str, text: str, limit: int = 2000, overlap: int = 150) -> DataFrame:
    """One row per piece: key, piece_no, start, end, boundary, n_chars (of the text), forced, piece.

    Positions count code points. Pieces hold at most ``limit`` of them, each begins ``overlap``
    before the end of the one before, and without those overlaps they join to the text exactly.
    Cuts fall on sections, paragraphs, sentences, words and, where a run of letters and digits
    leaves no other way, between characters; ``boundary`` names the cut at the piece's end (``end``
    at the text's end). Lengths are measured, stated ones ignored.

    Texts within the limit come as one piece. Null and empty texts have no piece. Rows with equal
    or null keys are cut each by itself. Other columns are ignored. No shuffle: one pass of Arrow
    batches, and memory for one batch.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, cols = [], ([], [], [], [], [], [], [])
            for row, t in enumerate(batch.column(1).to_pylist()):
                if not t:
                    continue
                pieces, forced = pieces_of(t, limit, overlap)
                for no, (a, b, level) in enumerate(pieces):
                    src.append(row)
                    for c, v in zip(cols, (no, a, b, NAMES[level] if level >= 0 else "end", len(t), int(forced), t[a:b]), strict=True):
                        c.append(v)
            keys = batch.column(0).take(pa.array(src, pa.int64()))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["k", "piece_no", "start", "end", "boundary", "n_chars", "forced", "piece"])

    schema = f"k {kind}, piece_no int, start bigint, end bigint, boundary string, n_chars bigint, forced int, piece string"
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema).withColumnRenamed("k", key)

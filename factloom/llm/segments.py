"""Oversized texts cut into pieces under a limit, at natural boundaries, with overlap.

Lexical cohesion: at every possible cut the words of the block before are compared with
those of the block after; a valley of this similarity marks a change of topic. The text is
walked from window to window, and in every window the cut is made at the deepest valley
among the boundaries that the walk may use. The first walk uses paragraphs only; where a
window holds none, the walk fails and the next one may use the next kind as well, up to
words. The kind with which the walk reaches the end is the text's cut level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 4000, 200
#: Words in each of the two blocks that are compared.
BLOCK_WORDS = 60
#: A piece is at least this share of the limit where boundaries allow it.
LEAST_SHARE = 0.5
#: Similarities are computed for so many words at a time.
SLAB = 4096
LEVELS = ("paragraph", "line", "sentence", "word")

# Abbreviations that end in a full stop inside a sentence, in lower case.
ABBREVIATIONS = frozenset(
    """no nos nr num núm art abs abb approx aprox ca circa env mr mrs ms dr prof hon rev st sr sra srta mme mlle
    inc corp ltd co plc bros dept div est fig figs eq ref vol vols ed eds pp pg pág vs etc cf al viz incl excl inkl
    exkl bzw usw evtl ggf sog vgl tsd mio mrd mill bn mn e.g i.e z.b d.h u.a u.u s.o p.ej p.ex ej u.s u.k n.v s.a
    jan feb mar apr jun jul aug sep sept oct nov dec okt dez mon tue wed thu fri sat sun max min avg tel ext""".split()
)

_SENTENCE = re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？｡]+[\"'”’」』）]*")
_BEFORE = re.compile(r"[^\s(\[\"'“„«]*$")
# Characters that end a line; CR LF is one end.
BREAKS = "\r\n\u2028\u2029\x85"

_SPACE, _BREAK, _WORD, _IDEOGRAPH = 1, 2, 4, 8


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: which kinds of character it is, and its lower case."""
    kind, lower = np.zeros(0x110000, dtype=np.uint8), np.arange(0x110000, dtype=np.uint64)
    for c in range(0x20000):
        char = chr(c)
        kind[c] = (_SPACE if char.isspace() else 0) | (_BREAK if char in BREAKS else 0) | (_WORD if char.isalnum() else 0)
        if len(char.lower()) == 1:
            lower[c] = ord(char.lower())
    kind[0x20000:0x32000] = _WORD
    kind[0x3040:0x3100] = kind[0x4E00:0xA000] = _WORD | _IDEOGRAPH
    return kind, lower


def code_points(text: str) -> np.ndarray:
    """The characters of a text as numbers."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def cuts_of(text: str, points: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions and levels of all natural cuts; a cut stands after its separator and has its coarsest level."""
    points = code_points(text) if points is None else points
    kind = _tables()[0][points]
    blank = np.concatenate([[False], (kind & _SPACE) > 0, [False]])
    opens, closes = np.flatnonzero(~blank[:-1] & blank[1:]), np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(kind & _BREAK)
    ends = ends[~((points[ends] == 13) & (np.append(points, 0)[ends + 1] == 10))] + 1
    # White space with two line ends in it holds a blank line.
    several = np.searchsorted(ends, closes, side="right") - np.searchsorted(ends, opens, side="right") >= 2
    sentences = []
    for m in _SENTENCE.finditer(text):
        start, end = m.span()
        if text[start] == "." and text[start + 1 : start + 2] != ".":
            word = _BEFORE.search(text[max(0, start - 24) : start]).group().lower()
            if word in ABBREVIATIONS or (len(word) == 1 and word.isalpha()):
                continue
        sentences.append(end)
    stops = np.array(sentences, dtype=np.int64)
    # White space behind the end of a sentence belongs to it.
    at = np.searchsorted(opens, stops)
    after = np.append(opens, -1)[at] == stops
    stops = np.where(after, np.append(closes, 0)[at], stops)
    kinds = [closes[several], ends, stops, closes]
    # Kinds come in order, so the first of equal positions has the coarsest level.
    positions, first = np.unique(np.concatenate(kinds), return_index=True)
    levels = np.repeat(np.arange(4), [len(k) for k in kinds])[first]
    inside = (positions > 0) & (positions < len(points))
    return positions[inside], levels[inside]


def boundaries(text: str) -> list[tuple[int, int]]:
    """``cuts_of`` as a list of (position, level)."""
    return list(zip(*(x.tolist() for x in cuts_of(text))))


def word_ids(text: str, points: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and a number for each word, equal for equal words in any case.

    A word is a run of letters and digits, or up to two ideographs in a row. Its number is a
    64-bit sum over its characters with the powers of an odd factor.
    """
    points = code_points(text) if points is None else points
    kinds, lower = _tables()
    kind = kinds[points] & (_WORD | _IDEOGRAPH)
    run = np.flatnonzero(np.diff(kind, prepend=np.uint8(255)))
    # Where each character stands in its run; ideographs start anew after two.
    place = np.arange(len(points)) - np.repeat(run, np.diff(np.append(run, len(points))))
    place = np.where(kind & _IDEOGRAPH, place % 2, place)
    starts = np.flatnonzero((place == 0) & (kind > 0))
    if not len(starts):
        return starts, starts
    powers = np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    value = np.where(kind > 0, (lower[points] + np.uint64(1)) * np.cumprod(powers)[place], np.uint64(0))
    return starts, np.add.reduceat(value, starts).view(np.int64)


def similarities(words: np.ndarray, gaps: np.ndarray, block: int = BLOCK_WORDS) -> np.ndarray:
    """The cosine of the word counts of the ``block`` words before each gap and of those after it (fewer at the ends).

    Equal words are counted by their distance: two words ``d`` apart that are equal add to
    the product of the blocks between which the gap lies, and to the norm of a block that
    holds both. Sums along the text of these equalities serve all gaps; the counts are exact.
    """
    out = np.zeros(len(gaps))
    for at in range(0, len(gaps), SLAB):
        part = gaps[at : at + SLAB]
        # Gaps far apart are looked at in groups, so that a slab of words stays small.
        for lo in np.unique(part // SLAB) * SLAB:
            here = np.flatnonzero((part >= lo) & (part < lo + SLAB))
            a, b = max(0, lo - block), min(len(words), lo + SLAB + block)
            out[at + here] = _cosines(words[a:b], part[here] - a, block)
    return out


def _cosines(words: np.ndarray, gaps: np.ndarray, block: int) -> np.ndarray:
    n = len(words)
    ahead = np.lib.stride_tricks.sliding_window_view(np.append(words, np.full(2 * block, -1)), 2 * block)[:n]
    sums = np.zeros((n + 1, 2 * block - 1), dtype=np.int32)
    np.cumsum(ahead[:, 1:] == words[:, None], axis=0, out=sums[1:])
    far = np.arange(1, 2 * block)
    g, low, high = gaps[:, None], np.maximum(gaps - block, 0)[:, None], np.minimum(gaps + block, n)[:, None]

    def pairs(first: np.ndarray, last: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Equal pairs (i, i + d) with i from first to before last, over all d."""
        last = np.maximum(last, first)
        return (sums[last, d - 1] - sums[first, d - 1]).sum(1, dtype=np.int64)

    product = pairs(np.maximum(low, g - far), np.minimum(g, high - far).clip(0), far)
    near = far[: block - 1]
    left = (g - low)[:, 0] + 2 * pairs(np.broadcast_to(low, (len(gaps), block - 1)), (g - near).clip(0), near)
    right = (high - g)[:, 0] + 2 * pairs(np.broadcast_to(g, (len(gaps), block - 1)), (high - near).clip(0), near)
    norm = np.sqrt(left.astype(np.float64) * right)
    return np.divide(product, norm, out=np.zeros(len(gaps)), where=norm > 0)


def valley_depths(similar: np.ndarray) -> np.ndarray:
    """How deep the valley at each position is: the rise to the nearest peak on the left plus that on the right."""
    depth = np.zeros(len(similar))
    for step in (1, -1):
        s = similar[::step].tolist()
        # Height of the hill climbed from each valley towards one side, as far as it keeps rising.
        peak = s[:1]
        for i in range(1, len(s)):
            peak.append(max(s[i], peak[-1]) if s[i - 1] >= s[i] else s[i])
        depth += (np.array(peak) - np.array(s))[::step]
    return depth


class _Valleys:
    """Valley depths of a text: of all cuts between sentences or coarser at once, between words only where a window asks."""

    def __init__(self, text: str):
        points = code_points(text)
        self.positions, self.levels = positions, levels = cuts_of(text, points)
        self.starts, self.words = word_ids(text, points)
        self.depths = np.zeros(len(positions))
        coarse = np.flatnonzero(levels <= 2)
        self.depths[coarse] = self._of(coarse)

    def _of(self, at: np.ndarray) -> np.ndarray:
        if not len(self.words) or not len(at):
            return np.zeros(len(at))
        gaps = np.searchsorted(self.starts, self.positions[at])
        # Only the words that the blocks of these cuts reach.
        lo, hi = max(0, int(gaps[0]) - BLOCK_WORDS), min(len(self.words), int(gaps[-1]) + BLOCK_WORDS)
        return valley_depths(similarities(self.words[lo:hi], gaps - lo))

    def deepest(self, i: int, j: int, kind: int) -> int | None:
        """Among the cuts i to j of the given kind or coarser the deepest valley, the last of equals; cuts between words only where there is no other."""
        at = i + np.flatnonzero(self.levels[i:j] <= min(kind, 2))
        depths = self.depths[at]
        if not len(at) and kind == 3:
            at = np.arange(i, j)
            depths = self._of(at)
        return int(at[depths >= depths.max() - 1e-12][-1]) if len(at) else None


def walk(length: int, valleys: _Valleys, kind: int, limit: int, overlap: int) -> list[tuple[int, str]] | None:
    """The cuts (position, kind) made with boundaries of a kind and those before; None where a window has no such boundary.

    A cut leaves room for the overlap where there is a boundary that does. With kind 4 a
    window without any boundary is cut at its end, so that walk always gets through.
    """
    positions, cuts, fresh = valleys.positions, [], 0
    while True:
        reach = limit - (overlap if fresh else 0)
        if length - fresh <= reach:
            return cuts
        chosen = None
        # First with room for the overlap and at least the least share, then shorter, then without that room.
        for lo, hi in ((fresh + int(limit * LEAST_SHARE), fresh + reach), (fresh + 1, fresh + reach), (fresh + reach + 1, fresh + limit)):
            i, j = np.searchsorted(positions, [max(lo, fresh + 1), hi + 1])
            chosen = valleys.deepest(int(i), int(j), min(kind, 3)) if i < j else None
            if chosen is not None:
                break
        if chosen is not None:
            cuts.append((int(positions[chosen]), LEVELS[valleys.levels[chosen]]))
        elif length - fresh <= limit:
            return cuts  # the rest fits with less overlap
        elif kind < 4:
            return None
        else:
            cuts.append((fresh + reach, "none"))
        fresh = cuts[-1][0]


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[str, list[tuple[int, int, int, str]]]:
    """``(cut_level, pieces)`` of an oversized text; a piece is (start, new content's start, end, kind of the cut at its end).

    Every walk passes a stretch between two boundaries it may use only if the stretch is
    within the limit. So the first kind whose walk gets through is the first for which
    cutting everywhere leaves no stretch over the limit.
    """
    valleys = _Valleys(text)
    positions, levels = valleys.positions, valleys.levels
    for kind in range(5):
        cuts = walk(len(text), valleys, kind, limit, overlap)
        if cuts is not None:
            break
    pieces, fresh = [], 0
    for end, name in [*cuts, (len(text), "end")]:
        begin = max(fresh - overlap, end - limit, 0) if fresh else 0
        # The overlap starts at the first boundary within its reach, a sentence's before a word's.
        i, j = np.searchsorted(positions, [begin, fresh - overlap // 10])
        if fresh and i < j:
            at = i + np.flatnonzero(levels[i:j] == levels[i:j].min())
            begin = int(positions[at[0]])
        pieces.append((begin, fresh, end, name))
        fresh = end
    return (*LEVELS, "none")[kind], pieces


_SCHEMA = "section_key bigint, n_chars int, cut_level string, piece int, start int, fresh_start int, end int, cut_kind string, text string"


def segment(sections: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Pieces of every section's text.

    ``section_key, n_chars, cut_level, piece, start, fresh_start, end, cut_kind, text``.
    A text within the limit is one piece and has no ``cut_level``; null texts give no
    row, empty ones one empty piece. Every piece has at most ``limit`` characters; from
    the second on it repeats ``start`` to ``fresh_start``, at most ``overlap``, of the one
    before. The pieces' fresh parts put together are the text. Positions count Unicode
    characters. Without ``with_text`` the text column is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["section_key", "n_chars", "cut_level", "piece", "start", "fresh_start", "end", "cut_kind", "text"]
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, rows = batch.slice(at, 512), []
                for key, text in zip(part["section_key"].to_pylist(), part["text_content"].to_pylist()):
                    level, pieces = (None, [(0, 0, len(text), "end")]) if len(text) <= limit else cut(text, limit, overlap)
                    rows += [(key, len(text), level, i, a, f, b, kind, text[a:b] if with_text else None) for i, (a, f, b, kind) in enumerate(pieces)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return sections.where(F.col("text_content").isNotNull()).select("section_key", "text_content").mapInArrow(run, _SCHEMA)


def oversized(sections: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(section_key, cut_level) of the sections over the limit, as the segmentation cut them."""
    long = sections.where(F.length("text_content") > limit)
    return segment(long, limit, with_text=False).where("piece = 0").select("section_key", "cut_level")

"""Exact token counts under a public byte-level BPE vocabulary, in vectorized batches.

Byte-level BPE first splits a text by a fixed pattern and then merges bytes within each
part, so the number of tokens of a part depends on the part alone. A whole Arrow batch is
split at once with array operations on its UTF-8 bytes, the parts are dictionary-encoded,
and only parts that a worker has not met before go through the tokenizer, which is loaded
once per worker. The counts are those of the tokenizer, text by text.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The default vocabulary: a file of ranks, one ``base64 rank`` per line.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The split pattern of this family of vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Parts whose counts a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: Bytes of text that are split at a time.
CHUNK_BYTES = 8_000_000

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


class _Worker:
    """What one Python worker keeps: the tokenizer, the counts of known parts, the classes of characters."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}
        self.classes = _classes()


def _classes() -> np.ndarray:
    """The class of every code point under the split pattern, as its regular expression engine sees it."""
    import regex

    table = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, every):
            table[[ord(c) for c in m.group()]] = kind
    return table


def worker(path: str) -> _Worker:
    """The worker's state for a vocabulary; kept on the interpreter, so it outlives single tasks."""
    kept = sys.__dict__.setdefault("_factloom_tokenizers", {})
    if path not in kept:
        kept[path] = _Worker(path)
    return kept[path]


def _byte_classes(data: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte the class of its character, and whether it begins one."""
    lead = (data & 0xC0) != 0x80
    kind = classes[:128][np.minimum(data, 127)]
    multi = np.flatnonzero(data >= 0xC0)
    if len(multi):
        b0 = data[multi].astype(np.uint32)
        at = lambda i: data[np.minimum(multi + i, len(data) - 1)].astype(np.uint32) & 0x3F
        two, three, four = b0 < 0xE0, (b0 >= 0xE0) & (b0 < 0xF0), b0 >= 0xF0
        point = np.where(two, (b0 & 0x1F) << 6 | at(1), 0)
        point = np.where(three, (b0 & 0x0F) << 12 | at(1) << 6 | at(2), point)
        point = np.where(four, (b0 & 0x07) << 18 | at(1) << 12 | at(2) << 6 | at(3), point)
        kind[multi] = classes[np.minimum(point, 0x10FFFF)]
        # Following bytes belong to the character before them.
        for i in (1, 2, 3):
            rows = multi if i == 1 else multi[(three | four) if i == 2 else four]
            rows = rows[rows + i < len(data)]
            kind[rows + i] = kind[rows]
    return kind, lead


def part_starts(data: np.ndarray, text_starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions at which the parts of the texts begin; ``text_starts`` are those of the (non-empty) texts."""
    n = len(data)
    kind, lead = _byte_classes(data, classes)
    first = np.zeros(n, dtype=bool)
    first[text_starts] = True
    before = np.empty(n, dtype=np.uint8)
    before[0], before[1:] = 0, kind[:-1]
    before[first] = 0
    change = (kind != before) & lead
    start = change | first
    # White space before something else: its last character parts from the run, and a blank joins what follows.
    after_space = np.flatnonzero(start & (kind != SPACE) & (before == SPACE))
    if len(after_space):
        last = after_space - 1
        while True:  # the last white space character may have several bytes
            inner = ~lead[last]
            if not inner.any():
                break
            last = last - inner
        start[last] = True
        blank = data[last] == 0x20
        start[after_space[blank]] = False
    # Contractions: an apostrophe that begins a part, with 's 't 'm 'd 're 've 'll right behind it.
    quote = np.flatnonzero((data == 0x27) & start)
    if len(quote):
        pad = np.append(data, [0, 0, 0])
        same = np.append(first, [True, True, True])
        one, two = pad[quote + 1], pad[quote + 2]
        near, far = ~same[quote + 1], ~same[quote + 1] & ~same[quote + 2]
        short = near & np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
        long = far & (((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C)))
        for rows, size in ((quote[short], 2), (quote[long & ~short], 3)):
            start[rows + 1] = False
            end = rows + size
            end = end[end < n]
            start[end] = True
            # A blank that ends the contraction's part joins what follows as before: only a new part begins here.
    return np.flatnonzero(start)


def count_tokens(texts: pa.Array, state: _Worker) -> np.ndarray:
    """The number of tokens of each text; 0 for null and empty ones."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    n = len(texts)
    counts = np.zeros(n, dtype=np.int64)
    if not n:
        return counts
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    if texts.buffers()[2] is None:
        return counts
    lengths = np.diff(offsets)
    filled = np.flatnonzero(lengths)
    at = 0
    while at < len(filled):
        total = np.cumsum(lengths[filled[at : at + 65536]])
        take = max(1, int(np.searchsorted(total, CHUNK_BYTES, side="right")))
        rows = filled[at : at + take]
        lo, hi = int(offsets[rows[0]]), int(offsets[rows[-1]] + lengths[rows[-1]])
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[lo:hi]
        text_starts = (offsets[rows] - lo).astype(np.int64)
        starts = part_starts(data, text_starts, state.classes)
        edges = pa.py_buffer(np.append(starts, len(data)).astype(np.int32).tobytes())
        parts = pa.StringArray.from_buffers(len(starts), edges, pa.py_buffer(data)).dictionary_encode()
        sizes = _sizes(parts.dictionary.to_pylist(), state)[np.asarray(parts.indices)]
        run = np.append(0, np.cumsum(sizes))
        first = np.searchsorted(starts, text_starts)
        counts[rows] = run[np.append(first[1:], len(starts))] - run[first]
        at += take
    return counts


def _sizes(parts: list[str], state: _Worker) -> np.ndarray:
    known = state.known
    if len(known) > REMEMBERED:
        known.clear()
    encode = state.encoding.encode_ordinary
    out = np.empty(len(parts), dtype=np.int64)
    for i, part in enumerate(parts):
        size = known.get(part)
        if size is None:
            size = len(encode(part))
            if len(part) < 64:
                known[part] = size
        out[i] = size
    return out


def with_tokens(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens``, the exact count for the column ``text`` (0 for null or empty)."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ddl = ", ".join(f"`{c}` {fields[c]}" for c in keep) + ", n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker(vocabulary)
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(count_tokens(batch.column(len(keep)), state))], names=[*keep, "n_tokens"])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, ddl)

"""Scores for abusive, threatening, hateful and sexually explicit language.

A factorization machine over hashed terms: besides a weight per term it learns a vector
per term, and the inner products of the vectors of the terms in one stretch of text give
the weight of their meeting - an insult with an address, a group with a verb of violence -
that weights of single terms miss. A text is cut into sentences; its score is that of its
worst sentence.

Terms are read behind common masks: look-alike letters, digits and signs for letters,
stretched, spaced and dotted spelling, invisible characters and stars. The model is
trained on the texts that reviewers labelled (a label speaks for a whole text, so the
sentence it is about is found by turns of scoring and training) together with the fixed
sentences of ``seeds``, which give it a start in every language. Texts without a label
play no part in training; all texts are scored whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import seeds
from factloom.session import small

#: Hash buckets, latent factors, longest stretch of words or ideographs that is scored as one sentence.
BUCKETS, FACTORS, LONGEST = 1 << 16, 8, 32
#: Longer stretches are scored in windows of LONGEST that begin this far apart.
STRIDE = LONGEST // 2
#: Terms in a window, at most: an ideograph brings the pair with the next one along.
WIDTH = 2 * LONGEST
#: Labelled documents used for training, at most: the first by a hash of their id.
LABELLED_LIMIT = 10_000
ROUNDS, EPOCHS, RATE, DECAY = 3, 12, 0.12, 3e-5
#: The worst sentence of an offensive text below it (before the logistic function) is not held against it.
DOUBTFUL = 0.0
#: A document is offensive when the probability of its worst sentence is at least this.
THRESHOLD = 0.4
CHUNK_BYTES = 8_000_000
#: Term spellings that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 2_000_000

NOTHING = 0  # the bucket of terms that say nothing (numbers, marks)

# Letters that look like Latin ones, and digits and signs used for letters.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһкмтвнԛԝαοερτυνικ", "aeopcyxijsdhkmtbhqwaoeptuvik")
LEET = str.maketrans("013457@$€+!|", "oieastasetil")
INVISIBLE = dict.fromkeys(map(ord, "\u200b\u200c\u200d\u2060\ufeff\u00ad\u200e\u200f"))


def bucket(term: str) -> int:
    """The bucket of a term, never that of nothing."""
    return zlib.crc32(term.encode("utf-8", "replace")) % (BUCKETS - 1) + 1


def _squeeze(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


def _bare(word: str) -> str:
    """Lower case, without look-alikes, signs for letters, invisible characters and accents."""
    word = unicodedata.normalize("NFKC", word.translate(INVISIBLE)).lower().translate(LOOKALIKES)
    if any(c in "013457@$€+!|" for c in word) and any(c.isalpha() for c in word):
        word = word.translate(LEET)
    word = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c)).replace("ß", "ss")
    return word.strip("'’_")


def plain(word: str) -> str:
    """A word as compared: bare, without a plural s; a stretched strong word as the word itself."""
    word = _bare(word)
    short = re.sub(r"(.)\1{2,}", r"\1", word)
    if short != word:
        for form in (short, short[:-1] if short.endswith("s") else short):
            if _squeeze(form) in SQUEEZED:
                return SQUEEZED[_squeeze(form)]
        word = short
    return word[:-1] if len(word) > 4 and word.endswith("s") and not word.endswith("ss") else word


SQUEEZED: dict[str, str] = {}
#: Strong words by their plain form; stars and spaced letters are resolved against them.
STRONG = frozenset(plain(w) for w in seeds.STRONG_WORDS)
SQUEEZED.update({_squeeze(_bare(w)): plain(w) for w in reversed(seeds.STRONG_WORDS)})


def _starred(word: str) -> str | None:
    """The strong word that a starred spelling stands for: same length, same letters where there are any."""
    core = word.translate(INVISIBLE).lower().translate(LOOKALIKES)
    if "*" not in core or not any(c.isalpha() for c in core):
        return None
    for tail in (core, core[:-1] if core.endswith("s") else core):
        pattern = re.compile("".join("." if c == "*" else re.escape(c) for c in tail))
        for strong in seeds.STRONG_WORDS:
            if len(strong) == len(tail) and pattern.fullmatch(strong):
                return plain(strong)
    return "<starred>" if core.count("*") >= 2 and core[0] != "*" else None


def term(word: str) -> int:
    """The bucket of one written word."""
    if "*" in word:
        found = _starred(word)
        return bucket(found) if found else NOTHING
    text = plain(word)
    return bucket(text) if any(c.isalpha() for c in text) else NOTHING


def spaced(letters: str) -> list[int]:
    """The buckets of strong words spelled with letters apart; a mark where none is found."""
    text = plain(letters)
    found = [w for w in STRONG if len(w) > 3 and w in text]
    best = [w for w in found if not any(w != v and w in v for v in found)]
    return [bucket(w) for w in best] or [bucket("<spaced>")]


WORD, IDEOGRAPH, SPACE, STOP, OTHER = 1, 2, 3, 4, 5


def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x30000):
        if 0xD800 <= c < 0xE000:
            continue
        kind = unicodedata.category(chr(c))
        if kind[0] in "LMN" or c in INVISIBLE:
            table[c] = WORD
        elif kind[0] == "Z" or c in (9, 11, 12):
            table[c] = SPACE
    table[0x3041:0x3100] = table[0x3400:0xA000] = table[0xF900:0xFB00] = IDEOGRAPH
    for c in "@$*€":
        table[ord(c)] = WORD
    for c in "\n\r!?。！？…;":
        table[ord(c)] = STOP
    table[ord(".")] = STOP
    return table


class _Worker:
    def __init__(self):
        self.classes, self.known = _classes(), {}


def _worker() -> _Worker:
    kept = sys.__dict__.setdefault("_factloom_abuse", {})
    if "state" not in kept:
        kept["state"] = _Worker()
    return kept["state"]


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which characters begin, and their code points."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.uint32)
    multi = np.flatnonzero(point >= 0xC0)
    if len(multi):
        b0, base = point[multi], lead[multi]
        at = lambda i: data[np.minimum(base + i, len(data) - 1)].astype(np.uint32) & 0x3F
        value = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | at(1), 0)
        value = np.where((b0 >= 0xE0) & (b0 < 0xF0), (b0 & 0x0F) << 12 | at(1) << 6 | at(2), value)
        value = np.where(b0 >= 0xF0, (b0 & 0x07) << 18 | at(1) << 12 | at(2) << 6 | at(3), value)
        point[multi] = np.minimum(value, 0x10FFFF)
    return lead, point


def sentences(texts: pa.Array, state: _Worker) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(terms, starts, text)``: the buckets of all sentences, where each sentence starts among them, and the text each is from.

    A sentence of more than LONGEST words or ideographs becomes overlapping windows, whose
    shared terms are repeated: what is at most STRIDE apart meets in some window.
    Texts must not be null. Sentences without terms are left out.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    empty = np.zeros(0, dtype=np.int64)
    if texts.buffers()[2] is None or offsets[-1] == offsets[0]:
        return empty, empty, empty
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    lead, point = _points(data)
    kind = state.classes[point]
    text_start = np.searchsorted(lead, (offsets[:-1] - offsets[0])[np.diff(offsets) > 0])
    first = np.zeros(len(lead), dtype=bool)
    first[text_start] = True
    # A full stop ends a sentence only before white space or at the end of its text.
    after = np.empty(len(lead), dtype=np.uint8)
    after[:-1], after[-1] = kind[1:], SPACE
    after[np.flatnonzero(first)[1:] - 1] = SPACE
    dot = (point == 0x2E) & (after != SPACE) & (after != STOP)
    kind = np.where(dot, OTHER, kind)
    change = np.empty(len(lead), dtype=bool)
    change[0], change[1:] = True, kind[1:] != kind[:-1]
    begin = np.flatnonzero(change | first | (kind == IDEOGRAPH))
    what = kind[begin]
    is_term = (what == WORD) | (what == IDEOGRAPH)
    # Sentence number of every run: it grows at stops and at texts.
    sentence = np.cumsum((what == STOP) | first[begin])
    length = np.diff(np.append(begin, len(lead)))
    rows = np.flatnonzero(is_term)
    if not len(rows):
        return empty, empty, empty
    at = begin[rows]
    edges = np.empty(len(rows) * 2, dtype=np.int64)
    edges[0::2] = lead[at]
    stop = begin[rows] + length[rows]
    edges[1::2] = np.append(lead, len(data))[stop]
    # Terms and the gaps between them as one string array; every second entry is a term.
    gaps = pa.py_buffer(np.append(edges, len(data)).astype(np.int32).tobytes())
    pieces = pa.StringArray.from_buffers(len(edges), gaps, pa.py_buffer(data))
    words = pieces.take(pa.array(np.arange(0, len(edges), 2)))
    coded = words.dictionary_encode()
    known, ids = state.known, np.empty(len(coded.dictionary), dtype=np.int64)
    if len(known) > REMEMBERED:
        known.clear()
    for i, word in enumerate(coded.dictionary.to_pylist()):
        value = known.get(word)
        if value is None:
            value = term(word)
            if len(word) < 40:
                known[word] = value
        ids[i] = value
    terms = ids[np.asarray(coded.indices)]
    number = sentence[rows]
    # Letters written apart: runs of at least four single letters, close together.
    single = (length[rows] == 1) & (what[rows] == WORD)
    next_to = np.zeros(len(rows), dtype=bool)
    next_to[1:] = single[1:] & single[:-1] & (number[1:] == number[:-1]) & (at[1:] - at[:-1] <= 3)
    run_start = np.flatnonzero(single & ~next_to)
    if len(run_start):
        ends = np.flatnonzero(single & ~np.append(next_to[1:], False)) + 1
        for a, b in zip(run_start, ends):
            if b - a >= 4:
                letters = "".join(map(chr, point[at[a:b]]))
                if letters.isalpha() or any(c.isalpha() for c in letters):
                    found = spaced(letters)[: b - a]
                    terms[a:b] = NOTHING
                    terms[a : a + len(found)] = found
    # Neighbouring ideographs also count as pairs, which come after the sentence's terms.
    pair = np.flatnonzero((what[rows][1:] == IDEOGRAPH) & (what[rows][:-1] == IDEOGRAPH) & (number[1:] == number[:-1]) & (at[1:] - at[:-1] == 1))
    if len(pair):
        mixed = (terms[pair] * 40503 + terms[pair + 1] * 30011) % (BUCKETS - 1) + 1
        terms, number = np.concatenate([terms, mixed]), np.concatenate([number, number[pair]])
        where = np.concatenate([at, at[pair]])
        # A pair takes no room of its own beside its first ideograph.
        room = np.ones(len(terms), dtype=np.int64)
        room[len(at) :] = terms[pair] == NOTHING
        order = np.lexsort((where, number)) if len(pair) else slice(None)
        terms, number, where, room = terms[order], number[order], where[order], room[order]
    else:
        where, room = at, np.ones(len(terms), dtype=np.int64)
    keep = terms != NOTHING
    terms, number, where, room = terms[keep], number[keep], where[keep], room[keep]
    if not len(terms):
        return empty, empty, empty
    # Long stretches without a stop become windows, so that chance meetings do not add up.
    new = np.empty(len(terms), dtype=bool)
    new[0], new[1:] = True, number[1:] != number[:-1]
    first_term = np.flatnonzero(new)
    past = np.append(first_term[1:], len(terms))
    used = np.cumsum(room)
    before = used[first_term] - room[first_term]
    size = used[past - 1] - before
    windows = 1 + np.maximum(0, -(-(size - LONGEST) // STRIDE))
    owner = np.repeat(np.arange(len(first_term)), windows)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
    low = np.searchsorted(used, before[owner] + offset + 1)
    high = np.minimum(np.searchsorted(used, before[owner] + offset + LONGEST, side="right"), past[owner])
    starts = np.cumsum(high - low) - (high - low)
    taken = np.repeat(low - starts, high - low) + np.arange(int((high - low).sum()))
    terms, where = terms[taken], where[taken]
    nonempty = np.flatnonzero(np.diff(offsets) > 0)
    text = nonempty[np.searchsorted(text_start, where[starts], side="right") - 1]
    return terms, starts, text


def pairwise(terms: np.ndarray, starts: np.ndarray, model: dict) -> np.ndarray:
    """The machine's output per sentence: bias, weights, and inner products of all pairs of terms."""
    v = model["v"][terms]
    sums = np.add.reduceat(v, starts, axis=0)
    squares = np.add.reduceat(model["vv"][terms], starts)
    return model["b"] + np.add.reduceat(model["w"][terms], starts) + 0.5 * ((sums * sums).sum(1) - squares)


def _padded(terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sentences as rows of buckets, filled up with nothing."""
    ends = np.append(starts[1:], len(terms))
    place = np.arange(len(terms)) - np.repeat(starts, ends - starts)
    out = np.zeros((len(starts), WIDTH), dtype=np.uint16)
    out[np.repeat(np.arange(len(starts)), ends - starts), place] = terms
    return out


def train(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int = 7, pairs: bool = True) -> dict:
    """Fit the machine to padded sentences by AdaGrad on the weighted logistic loss; without ``pairs`` additive weights only, for comparison."""
    rng = np.random.default_rng(seed)
    # Vectors of zero stay zero.
    w, v, b = np.zeros(BUCKETS), rng.normal(0, 0.05 if pairs else 0.0, (BUCKETS, FACTORS)), -2.0
    v[NOTHING] = 0.0
    gw, gv, gb = np.full(BUCKETS, 0.1), np.full((BUCKETS, FACTORS), 0.1), 0.1
    batch = 256
    length = (rows != NOTHING).sum(1)
    for _ in range(EPOCHS):
        # Batches of like length keep the rows dense; their order is random.
        order = np.lexsort((rng.random(len(rows)), length))
        for lo in rng.permutation(np.arange(0, len(order), batch)):
            pick = order[lo : lo + batch]
            x = rows[pick][:, : max(1, int(length[pick].max()))].astype(np.int64)
            there = (x != NOTHING)[:, :, None]
            vx = v[x] * there
            total = vx.sum(1)
            score = b + w[x].sum(1) + 0.5 * ((total * total).sum(1) - (vx * vx).sum((1, 2)))
            error = weights[pick] * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[pick])
            flat = x.ravel()
            by = np.argsort(flat, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(flat[by]) != 0))
            touched = flat[by][edges]
            slope = (error[:, None, None] * (total[:, None, :] - vx) * there).reshape(-1, FACTORS)
            step_w = np.add.reduceat(np.repeat(error, x.shape[1])[by], edges) / batch + DECAY * w[touched]
            step_v = np.add.reduceat(slope[by], edges, axis=0) / batch + DECAY * v[touched]
            gw[touched] += step_w**2 * batch
            gv[touched] += step_v**2 * batch
            w[touched] -= RATE * 16 * step_w / np.sqrt(gw[touched])
            v[touched] -= RATE * 8 * step_v / np.sqrt(gv[touched])
            step = error.sum() / batch
            gb += step * step * batch
            b -= RATE * step / np.sqrt(gb)
            w[NOTHING], v[NOTHING] = 0.0, 0.0
    v32 = v.astype(np.float32)
    return {"w": w.astype(np.float32), "v": v32, "vv": (v32 * v32).sum(1), "b": np.float32(b)}


def _seed_rows(state: _Worker) -> tuple[np.ndarray, np.ndarray]:
    texts, labels = seeds.sentences()
    terms, starts, text = sentences(pa.array(texts), state)
    return _padded(terms, starts), np.array(labels)[text]


def _frequency(bags: list[np.ndarray]) -> np.ndarray:
    count = np.zeros(BUCKETS)
    for rows in bags:
        count[np.unique(rows)] += 1
    return count


def fit(bags: list[tuple[int, np.ndarray]], pairs: bool = True) -> dict:
    """Train on seeds and on labelled texts, each given as (label, padded sentences).

    Every round scores the sentences of the texts labelled offensive, takes the worst one
    of each as the offensive one, and trains on those, the seeds, and all sentences of the
    texts labelled harmless.
    """
    state = _worker()
    rows, labels = _seed_rows(state)
    weights = np.where(labels == 1, 1.0, 1.5)
    good, bad = ([r for y, r in bags if y == label and len(r)] for label in (0, 1))
    harmless, times = np.unique(np.concatenate(good), axis=0, return_counts=True) if good else (np.zeros((0, WIDTH), dtype=np.uint16), np.zeros(0))
    # What many harmless texts say counts for more, by the logarithm.
    much = 1 + np.log(np.maximum(times, 1))
    held = {r.tobytes() for r in harmless}
    # Terms much more frequent in offensive texts than in harmless ones help the first choice.
    odds = np.log((_frequency(bad) + 0.5) / (len(bad) + 1.0)) - np.log((_frequency(good) + 0.5) / (len(good) + 1.0))
    odds[NOTHING] = 0.0
    model = train(np.concatenate([rows, harmless]), np.concatenate([labels, np.zeros(len(harmless))]), np.concatenate([weights, 0.3 * much]), pairs=pairs)
    for turn in range(ROUNDS if bad or good else 0):
        taken = []
        for r in bad:
            score = _score_rows(r, model)
            if turn == 0:
                counts = np.maximum((r != NOTHING).sum(1), 1)
                score = score + 2.0 * (np.maximum(odds[r], 0) * (r != NOTHING)).sum(1) / np.sqrt(counts)
            for i in np.argsort(-score):
                if r[i].tobytes() not in held:
                    if turn == 0 or score[i] > DOUBTFUL:
                        taken.append(r[i])
                    break
        parts = [(rows, labels, weights), (harmless, 0.0, much), (np.array(taken, dtype=np.uint16).reshape(-1, WIDTH), 1.0, 2.0)]
        x = np.concatenate([p[0] for p in parts])
        y = np.concatenate([np.broadcast_to(p[1], len(p[0])) for p in parts])
        g = np.concatenate([np.broadcast_to(p[2], len(p[0])) for p in parts])
        model = train(x, y, g, seed=7 + turn, pairs=pairs)
    return model


def _score_rows(rows: np.ndarray, model: dict) -> np.ndarray:
    out = np.empty(len(rows))
    for lo in range(0, len(rows), 20_000):
        part = rows[lo : lo + 20_000].astype(np.int64)
        v = model["v"][part]
        total = v.sum(1)
        out[lo : lo + len(part)] = model["b"] + model["w"][part].sum(1) + 0.5 * ((total * total).sum(1) - model["vv"][part].sum(1))
    return out


def opinions(labels: DataFrame) -> DataFrame:
    """``doc_id, label``: what most reviewers say; null opinions and ties say nothing, each reviewer counts once (the latest)."""
    latest = labels.where("offensive in (0, 1) and doc_id is not null").groupBy("doc_id", "reviewer")
    latest = latest.agg(F.max_by("offensive", F.struct("reviewed_at", "label_id")).alias("offensive"))
    share = latest.groupBy("doc_id").agg(F.avg("offensive").alias("share"))
    return share.where("share <> 0.5").select("doc_id", F.when(F.col("share") > 0.5, 1).otherwise(0).alias("label"))


def labelled_bags(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_LIMIT, keep=None) -> list[tuple[int, np.ndarray]]:
    """(label, all its padded sentences) of at most ``limit`` labelled documents; the texts are cut up where they are.

    ``keep`` restricts the labelled documents, for tests on the others.
    """
    said = opinions(labels)
    said = (said if keep is None else said.where(keep)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    joined = documents.select("doc_id", "text").where("text is not null and text <> ''").join(small(said), "doc_id").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _worker()
        for batch in batches:
            terms, starts, text = sentences(batch["text"], state)
            rows = _padded(terms, starts)
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            out = [np.unique(rows[lo:hi], axis=0).tobytes() for lo, hi in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([batch["label"].cast(pa.int32()), pa.array(out, pa.binary())], names=["label", "rows"])

    found = joined.mapInArrow(run, "label int, rows binary").collect()
    bags = [(r["label"], np.frombuffer(bytes(r["rows"]), dtype=np.uint16).reshape(-1, WIDTH)) for r in found]
    # The order of a collected result is chance; training must not depend on it.
    return sorted(bags, key=lambda b: (b[0], zlib.crc32(b[1].tobytes()), len(b[1])))


def score_documents(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_LIMIT, model: dict | None = None) -> DataFrame:
    """``doc_id, source, score, offensive`` for every document.

    ``score`` is the probability of the worst sentence, 0 for null and empty texts, which
    are not offensive. Without labels the fixed sentences alone train the model. A model
    that ``fit`` has made may be given.
    """
    model = documents.sparkSession.sparkContext.broadcast(model or fit(labelled_bags(documents, labels, limit)))
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, known = _worker(), model.value
        for batch in batches:
            texts = pc.fill_null(batch["text"], "")
            sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
            score = np.full(len(texts), -np.inf)
            lo = 0
            while lo < len(texts):
                hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), CHUNK_BYTES, side="right")))
                terms, starts, text = sentences(texts.slice(lo, hi - lo), state)
                if len(starts):
                    np.maximum.at(score, lo + text, pairwise(terms, starts, known))
                lo = hi
            probability = 1 / (1 + np.exp(-np.clip(score, -40, 40)))
            probability[np.isneginf(score)] = 0.0
            columns = [batch["doc_id"], batch["source"], pa.array(np.round(probability, 6)), pa.array(probability >= THRESHOLD)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "score", "offensive"])

    return documents.select("doc_id", "source", "text").mapInArrow(run, f"doc_id {kind}, source string, score double, offensive boolean")


def rates(scored: DataFrame) -> DataFrame:
    """Per source: documents, offensive ones and their share."""
    n, bad = F.count("*"), F.count_if("offensive")
    return scored.groupBy("source").agg(n.alias("n_docs"), bad.alias("n_offensive"), (bad / n).alias("rate"), F.avg("score").alias("mean_score"))


#: Labelled documents that a test on the others is trained on, as a share.
TRAINED_SHARE = 0.6


def held_out(documents: DataFrame, labels: DataFrame, pairs: bool = True) -> DataFrame:
    """Trained on a share of the labelled documents, tried on the others: per language (null: all) ``n, label_positive, found, both, precision, recall``.

    Which documents are held out goes by a hash of the id. The labels are taken as they
    are, wrong ones included. Without ``pairs`` additive weights are tried instead.
    """
    trained = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(1000)) < int(1000 * TRAINED_SHARE)
    model = fit(labelled_bags(documents, labels, keep=trained), pairs)
    rest = opinions(labels).where(~trained)
    texts = documents.join(small(rest.select("doc_id")), "doc_id", "left_semi")
    scored = score_documents(texts, labels, model=model).join(rest, "doc_id").join(texts.select("doc_id", F.coalesce(F.lower(F.substring(F.trim("lang"), 1, 2)), F.lit("und")).alias("lang")), "doc_id")
    n, hit = F.count("*"), F.count_if(F.col("offensive") & (F.col("label") == 1))
    said, found = F.sum("label"), F.count_if("offensive")
    return scored.rollup("lang").agg(n.alias("n"), said.alias("label_positive"), found.alias("found"), hit.alias("both"), F.try_divide(hit, found).alias("precision"), F.try_divide(hit, said).alias("recall"))

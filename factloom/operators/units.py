"""Quantities in different units brought to the common unit of their kind.

Every fact states a figure together with pieces of a declaration: a unit reference, a
power of ten, a caption over the column, words beside the figure. ``declared`` reads
them with Column expressions. Which reading - unit and power of ten - a fact gets is decoded
by a hidden Markov model:

* a *device* is the series of facts of one concept in one filing, in document order; the
  facts are the observations, the reading is the hidden state;
* emission costs favour the declared reading; other readings that the declaration admits
  cost little: units and kinds it leaves open, one of two powers of ten it states twice, the
  unit of the concept's type where the unit named is of another kind. Readings that
  contradict a plain declaration (a slip of three or six decades) cost much;
* transition costs are the jumps of the logarithm of the quantity against a level that
  is taken to be smooth, bounded so that a plain contradiction is not explained away.

Viterbi picks the cheapest path, and the quantity is that of the reading picked. Only a
decoded slip does not rewrite what the fact plainly states: it is returned beside the
quantity (``slip_decades``) for review.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.let import let
from factloom.functions.numbers import lookup, read_figure
from factloom.session import durable, small

# Unit -> (kind, factor to the common unit, offset added after it).
UNITS = {
    "usd": ("money", 1.0, 0.0), "eur": ("money", 1.0, 0.0),
    "usdpershare": ("pershare", 1.0, 0.0), "centpershare": ("pershare", 0.01, 0.0),
    "shares": ("shares", 1.0, 0.0),
    "pure": ("ratio", 1.0, 0.0), "percent": ("ratio", 0.01, 0.0), "bps": ("ratio", 0.0001, 0.0),
    "sqm": ("area", 1.0, 0.0), "sqft": ("area", 0.09290304, 0.0), "acre": ("area", 4046.8564224, 0.0), "ha": ("area", 10000.0, 0.0),
    "kwh": ("energy", 1.0, 0.0), "mwh": ("energy", 1e3, 0.0), "gwh": ("energy", 1e6, 0.0),
    "gj": ("energy", 1 / 0.0036, 0.0), "mmbtu": ("energy", 293.07107017, 0.0),
    "kg": ("mass", 1.0, 0.0), "t": ("mass", 1000.0, 0.0), "lb": ("mass", 0.45359237, 0.0), "ust": ("mass", 907.18474, 0.0),
    "bbl": ("volume", 1.0, 0.0), "gal": ("volume", 1 / 42, 0.0), "m3": ("volume", 1 / 0.158987294928, 0.0),
    "km": ("length", 1.0, 0.0), "mi": ("length", 1.609344, 0.0),
    "c": ("temperature", 1.0, 0.0), "f": ("temperature", 5 / 9, -160 / 9),
    "count": ("count", 1.0, 0.0),
}

# Spellings of unit identifiers and measures, without prefix, in lower case.
UNIT_NAMES = {
    "usd": "usd", "eur": "eur", "shares": "shares", "share": "shares",
    "usd/shares": "usdpershare", "usdpershare": "usdpershare", "usd_per_share": "usdpershare", "eur/shares": "usdpershare",
    "pure": "pure", "number": "pure", "employee": "pure", "percent": "percent", "pct": "percent", "%": "percent",
    "bps": "bps", "basispoint": "bps", "bp": "bps",
    "sqm": "sqm", "m2": "sqm", "squaremeters": "sqm", "squaremetres": "sqm", "sqft": "sqft", "ft2": "sqft", "squarefeet": "sqft",
    "acre": "acre", "ac": "acre", "ha": "ha", "hectare": "ha",
    "kwh": "kwh", "mwh": "mwh", "gwh": "gwh", "gj": "gj", "mmbtu": "mmbtu",
    "kg": "kg", "kgm": "kg", "t": "t", "tonne": "t", "lb": "lb", "lbs": "lb", "ust": "ust", "shortton": "ust",
    "bbl": "bbl", "barrel": "bbl", "gal": "gal", "usgallon": "gal", "m3": "m3", "cbm": "m3",
    "km": "km", "kilometre": "km", "kilometer": "km", "mi": "mi", "mile": "mi",
    "c": "c", "celsius": "c", "degc": "c", "f": "f", "fahrenheit": "f", "degf": "f",
}

# The kind of quantity that a concept's declared type stands for.
TYPE_KINDS = {
    "monetary": "money", "perShare": "pershare", "shares": "shares", "percent": "ratio", "pure": "ratio", "decimal": "ratio",
    "integer": "count", "area": "area", "energy": "energy", "mass": "mass", "volume": "volume", "length": "length",
    "temperature": "temperature",
}

#: Kinds whose figures need no unit beside them: the common unit is then meant.
BARE_KINDS = {"money": "usd", "pershare": "usdpershare", "shares": "shares", "ratio": "pure", "count": "count"}

KINDS = list(dict.fromkeys(k for k, _, _ in UNITS.values()))
UNIT_LIST = list(UNITS)
#: Readings per fact: the declared one, up to five that an open declaration admits, the other one of a double declaration, four slips.
SLIPS = (-6, -3, 3, 6)
OPEN = 5
#: Costs in the model, as negative log likelihoods.
OPEN_COST, OTHER_COST, SLIP_COST, JUMP_WEIGHT, JUMP_CAP = 0.05, 0.3, 3.0, 4.0, 2.0
#: Facts of one device are decoded in blocks of this many document positions, and those of one block in parts of so many rows at most.
BLOCK, PART = 4096, 16384


def _code(unit: str) -> Column:
    return F.lit(UNIT_LIST.index(unit))


def unit_of(name: Column) -> Column:
    """A unit reference or measure in any spelling to its place in ``UNITS``; null when opaque or unknown."""
    bare = F.regexp_replace(F.lower(F.trim(name)), r"^u_|[a-z0-9-]+:", "")
    return lookup({spelling: UNIT_LIST.index(unit) for spelling, unit in UNIT_NAMES.items()}, bare)


def _kind_of(unit: Column) -> Column:
    """The place in ``KINDS`` of the kind of a unit given by its place."""
    return F.get(F.array(*[F.lit(KINDS.index(kind)) for kind, _, _ in UNITS.values()]), unit)


def _power(phrase: Column) -> Column:
    return (
        F.when(phrase.rlike(r"thousand|000s|\bk\b"), 3).when(phrase.rlike(r"million|\bmm\b"), 6).when(phrase.rlike(r"billion|\bbn\b"), 9)
    )


def caption_powers(caption: Column) -> Column:
    """``struct<money, shares, pershare>``: powers of ten a caption states for each kind, null where it is silent.

    A caption that names kinds speaks for those only ("shares in Thousands, $ in
    Millions"); one that names none speaks for all but those it excepts.
    """
    text = F.lower(F.trim(caption))
    excepted = F.regexp_extract(text, r"\b(?:except|excluding|other than)\b(.*)$", 1)
    body = F.trim(F.regexp_replace(text, r"\b(?:except|excluding|other than)\b.*$", ""))
    # A phrase is a run up to a comma, or "$ in ..." after another currency mark.
    body = F.regexp_replace(body, r"(usd \(\$\)) +(?=\S)", "$1, ")
    money, shares = r"\$|dollar|usd|eur|€|currency", r"\bshares?\b(?! data| amount)"

    def build(phrases: Column) -> Column:
        powered = lambda test: F.get(F.transform(F.filter(phrases, lambda p: test(p) & _power(p).isNotNull()), _power), F.lit(0))
        names_any = F.exists(phrases, lambda p: p.rlike(f"{money}|{shares}") & _power(p).isNotNull())
        general = F.when(~names_any, powered(lambda p: F.lit(True)))
        no_shares = excepted.rlike(r"^\W*(?:number of )?shares?\b") | excepted.rlike(r"\bshare (?:counts?|numbers?)")
        return F.struct(
            F.coalesce(powered(lambda p: p.rlike(money) & ~p.rlike(r"\bshares?\b")), general).alias("money"),
            F.when(~no_shares, F.coalesce(powered(lambda p: p.rlike(shares)), general)).alias("shares"),
            F.when(~excepted.rlike("per.share"), general).alias("pershare"),
        )

    return F.when(caption.isNotNull(), let(F.split(body, r"\s*[,;]\s*| and "), build))


def concept_names(concepts: DataFrame) -> DataFrame:
    """(key, concept, type): every ``name`` and every ``concept_id`` as a key of its concept's name."""
    kind = F.regexp_extract("type_name", r"([A-Za-z]+?)ItemType$", 1)
    base = concepts.where(F.col("name").isNotNull())
    keys = base.select(F.col("name").alias("key"), F.col("name").alias("concept"), kind.alias("type"), F.lit(0).alias("rank")).unionByName(
        base.where(F.col("concept_id").isNotNull()).select(F.col("concept_id").alias("key"), F.col("name").alias("concept"), kind.alias("type"), F.lit(1).alias("rank"))
    )
    best = F.min(F.struct("rank", "concept", "type")).alias("best")
    return keys.groupBy("key").agg(best).select("key", "best.concept", "best.type")


def declared(facts: DataFrame, units: DataFrame, concepts: DataFrame, keys=None) -> DataFrame:
    """Facts with what they declare.

    Returns ``fact_id, <keys>, device, pos, figure, kind, unit, exponent, money_exponent,
    share_exponent, other_unit, other_exponent`` for every fact that states a readable number
    and is not of a text, date or boolean type. ``kind`` and ``unit`` are places in ``KINDS``
    and ``UNITS``, null where the fact leaves them open; the ``other_`` ones are null unless
    the declaration says two things. Unit references are looked up in ``units`` within the
    filing, else read themselves. ``keys`` makes columns out of filing, context and concept;
    without it these three are the keys. Null or unreadable values give no row; repeated
    facts and units are harmless.
    """
    names = small(concept_names(concepts))
    # Measures are read once per unit, not once per fact.
    measures = units.where("filing_id is not null and unit_id is not null").groupBy("filing_id", "unit_id").agg(F.min("measure").alias("measure"))
    measures = measures.select(F.col("filing_id").alias("m_filing"), F.col("unit_id").alias("m_unit"), unit_of(F.col("measure")).alias("m_code")).where("m_code is not null")
    # As a generator the figure is read once; a filter on it would read it again.
    figures = F.inline(F.filter(F.array(read_figure(F.col("value"))), lambda r: r["figure"].isNotNull())).alias("read_figure", "read_exponent", "read_unit")
    f = facts.select("fact_id", "filing_id", "contextref", "name", "pos", "unitref", "scale", "caption", figures).join(names, F.col("name") == F.col("key"), "left")
    f = f.where(F.col("type").isNull() | F.col("type").isin(*TYPE_KINDS)).withColumn("concept", F.coalesce("concept", "name"))
    word, scale = F.col("read_exponent"), F.col("scale").try_cast("int")
    # A scale attribute or a scale word is the fact's own; a caption speaks where neither does.
    silent = F.col("scale").isNull() & (word == 0)
    kept = keys(F.col("filing_id"), F.col("contextref"), F.col("concept")) if keys else [F.col("contextref"), F.col("concept")]
    # What the join of the units does not need of the texts stays behind.
    f = f.select(
        "fact_id", "filing_id", "unitref", *kept, F.xxhash64("filing_id", "concept").alias("device"), "pos", F.col("read_figure").alias("figure"),
        lookup({u: i for i, u in enumerate(UNIT_LIST)}, F.col("read_unit")).alias("written"), lookup({t: KINDS.index(k) for t, k in TYPE_KINDS.items()}, F.col("type")).alias("type_kind"),
        (F.coalesce(scale, F.lit(0)) + word).alias("stated"), F.when((scale != 0) & (word != 0), F.greatest(scale, word)).alias("other_exponent"),
        F.when(silent, caption_powers(F.col("caption"))).alias("caps"),
    )
    f = f.join(measures, (F.col("filing_id") == F.col("m_filing")) & (F.col("unitref") == F.col("m_unit")), "left")
    own, type_kind = F.coalesce("written", "m_code", unit_of(F.col("unitref"))), F.col("type_kind")
    of = lambda kind: F.lit(KINDS.index(kind))
    # A bare number of a counted type is a count; a currency beside a per-share figure is per share.
    own = F.when((type_kind == of("pershare")) & (_kind_of(own) == of("money")), _code("usdpershare")).when((type_kind == of("count")) & (own == _code("pure")), _code("count")).otherwise(own)
    f = f.withColumn("own", own).withColumn("kind", F.coalesce(_kind_of(F.col("own")), type_kind))
    bare = lookup({KINDS.index(k): UNIT_LIST.index(u) for k, u in BARE_KINDS.items()}, F.col("kind"))
    common = F.get(F.array(*[_code(next(u for u in UNIT_LIST if UNITS[u][:2] == (k, 1.0))) for k in KINDS]), type_kind)
    by_kind = F.when(F.col("kind") == of("money"), F.col("caps.money")).when(F.col("kind") == of("shares"), F.col("caps.shares")).when(F.col("kind") == of("pershare"), F.col("caps.pershare"))
    return f.select(
        "fact_id", *(["filing_id"] if not keys else []), *[c for c in f.columns if c not in ("filing_id",) and c in _KEY_NAMES], "device", "pos", "figure",
        F.col("kind").cast("tinyint"), F.coalesce("own", bare).cast("tinyint").alias("unit"), (F.col("stated") + F.coalesce(by_kind, F.lit(0))).alias("exponent"),
        F.col("caps.money").cast("tinyint").alias("money_exponent"), F.col("caps.shares").cast("tinyint").alias("share_exponent"),
        F.when(F.col("kind") != type_kind, common).cast("tinyint").alias("other_unit"), "other_exponent",
    )


_KEY_NAMES = ("contextref", "concept", "k1", "k2", "whole")
_TEXT = [("filing_id", pa.string()), ("contextref", pa.string()), ("concept", pa.string())]
_OUT = pa.schema([("fact_id", pa.int64()), *_TEXT, ("figure", pa.float64()), ("kind", pa.string()), ("unit", pa.string()), ("quantity", pa.float64()), ("slip_decades", pa.int32())])
OUT_DDL = "fact_id bigint, filing_id string, contextref string, concept string, figure double, kind string, unit string, quantity double, slip_decades int"


def _readings() -> dict[int, list[int]]:
    """For each kind code, the units an undeclared fact of that kind may be in; -1: of no known kind."""
    by: dict[int, list[int]] = {k: [i for i, u in enumerate(UNIT_LIST) if UNITS[u][0] == kind][:OPEN] for k, kind in enumerate(KINDS)}
    by[-1] = [UNIT_LIST.index(u) for u in ("usd", "shares", "count")]
    return by


def viterbi(level: np.ndarray, cost: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The cheapest state per row.

    ``level`` and ``cost`` are rows x states (an infinite cost closes a state); rows of a
    device are adjacent and ``starts`` marks their first rows. All devices advance
    together, one step at a time, so the loop is as long as the longest device.
    """
    n, states = cost.shape
    if not n:
        return np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(starts)
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    total, back = cost.copy(), np.zeros((n, states), dtype=np.int8)
    for step in range(1, int(length[0])):
        rows = first[: np.searchsorted(-length, -step, side="left")] + step
        jump = np.minimum(JUMP_WEIGHT * np.abs(level[rows, None, :] - level[rows - 1, :, None]), JUMP_CAP)
        via = total[rows - 1, :, None] + jump
        back[rows] = best = via.argmin(axis=1)
        total[rows] += np.take_along_axis(via, best[:, None, :].astype(np.int64), axis=1)[:, 0]
    path = np.zeros(n, dtype=np.int64)
    last = first + length - 1
    path[last] = total[last].argmin(axis=1)
    for step in range(int(length[0]) - 1, 0, -1):
        rows = first[: np.searchsorted(-length, -step, side="left")] + step
        path[rows - 1] = back[rows, path[rows]]
    return path


def _numbers(table: pa.Table, column: str, fill=0) -> np.ndarray:
    return pc.fill_null(table[column].combine_chunks(), fill).to_numpy(zero_copy_only=False)


def decode(table: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit or -1, quantity, slip in decades) per row of a table sorted by device; ``starts`` marks where devices begin."""
    n = table.num_rows
    figure, exponent = _numbers(table, "figure"), _numbers(table, "exponent").astype(np.float64)
    kind, unit = _numbers(table, "kind", -1).astype(np.int64), _numbers(table, "unit", -1).astype(np.int64)
    factor, offset = (np.array([UNITS[u][i] for u in UNIT_LIST]) for i in (1, 2))
    states = 2 + OPEN + len(SLIPS)
    reading = np.full((n, states), -1)
    power = np.repeat(exponent[:, None], states, axis=1)
    cost = np.full((n, states), np.inf)
    known = unit >= 0
    reading[known, 0], cost[known, 0] = unit[known], 0.0
    for k, admitted in _readings().items():
        rows = np.flatnonzero(~known & (kind == k))
        for i, u in enumerate(admitted):
            reading[rows, 1 + i], cost[rows, 1 + i] = u, OPEN_COST * (i + 1)
    free = ~known & (kind < 0)
    money, share = _numbers(table, "money_exponent", -99), _numbers(table, "share_exponent", -99)
    for column, said in ((1, money), (2, share)):
        rows = np.flatnonzero(free & (said > -99))
        power[rows, column] += said[rows]
        cost[rows, column] = 0.0
    # A declaration that says two things: the other power, or the unit of the concept's type.
    other_unit, other_power = _numbers(table, "other_unit", -1).astype(np.int64), _numbers(table, "other_exponent", -99)
    rows = np.flatnonzero(known & ((other_unit >= 0) | (other_power > -99)))
    reading[rows, 1 + OPEN] = np.where(other_unit[rows] >= 0, other_unit[rows], unit[rows])
    power[rows, 1 + OPEN] = np.where(other_power[rows] > -99, other_power[rows], power[rows, 1 + OPEN])
    cost[rows, 1 + OPEN] = OTHER_COST
    for i, decades in enumerate(SLIPS):
        at = 2 + OPEN + i
        reading[known, at], cost[known, at] = unit[known], SLIP_COST * (1 if abs(decades) == 3 else 1.5)
        power[:, at] += decades
    safe = np.maximum(reading, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        quantity = figure[:, None] * 10.0**power * factor[safe] + offset[safe]
        size = np.abs(quantity)
        level = np.where(size > 0, np.log10(np.maximum(size, 1e-300)), 0.0)
    path = viterbi(np.nan_to_num(level, posinf=300.0), cost, starts)
    slipped = path > 1 + OPEN
    chosen, rows = np.where(slipped, 0, path), np.arange(n)
    slip = np.where(slipped, np.array((0,) * (2 + OPEN) + SLIPS)[path], 0).astype(np.int32)
    return reading[rows, chosen], quantity[rows, chosen], slip


def _texts(table: pa.Table, starts: np.ndarray) -> pa.Table:
    """The decoded facts with their keys as texts."""
    unit, quantity, slip = decode(table, starts)
    names = pa.array(UNIT_LIST).take(pa.array(unit, mask=unit < 0))
    kinds = pa.array([UNITS[u][0] for u in UNIT_LIST]).take(pa.array(unit, mask=unit < 0))
    columns = [table[c].combine_chunks() for c in ("fact_id", "filing_id", "contextref", "concept", "figure")]
    columns += [kinds, names, pa.array(quantity, mask=unit < 0), pa.array(slip)]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


_PAIRED = pa.schema([("fact_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("figure", pa.float64()), ("quantity", pa.float64())])


def _restatable(table: pa.Table, starts: np.ndarray) -> pa.Table:
    """The decoded facts that may state the quantity of another one.

    The facts of a context in order of quantity fall into runs without a step of more than
    the tolerance; those of a run with one figure only have no partner in this table. They
    are left out where the table holds the whole device (``whole``).
    """
    unit, quantity, _ = decode(table, starts)
    k1, k2, figure = _numbers(table, "k1"), _numbers(table, "k2"), _numbers(table, "figure")
    rows = np.flatnonzero((unit >= 0) & ~np.isnan(quantity) & ~np.asarray(table["k1"].is_null().to_numpy(), dtype=bool))
    rows = rows[np.lexsort((quantity[rows], k2[rows], k1[rows]))]
    if len(rows):
        q, size = quantity[rows], np.abs(quantity[rows])
        # A little more than the tolerance, for what counts as zero.
        step = np.abs(q[1:] - q[:-1]) > 1.01 * TOLERANCE * np.maximum(size[1:], size[:-1]) + 1e-8
        new = np.append(True, step | (k1[rows][1:] != k1[rows][:-1]) | (k2[rows][1:] != k2[rows][:-1]))
        first = np.flatnonzero(new)
        several = np.minimum.reduceat(figure[rows], first) < np.maximum.reduceat(figure[rows], first)
        rows = rows[np.repeat(several, np.diff(np.append(first, len(rows)))) | ~_numbers(table, "whole", False)[rows]]
    taken = table.select(["fact_id", "k1", "k2", "figure"]).take(pa.array(rows)).append_column("quantity", pa.array(quantity[rows]))
    return taken.combine_chunks().cast(_PAIRED)


def _stream(work):
    """Apply ``work(table, starts)`` batch by batch to rows sorted by device and block.

    Rows of a block that may go on in the next batch wait for it, but never more than PART:
    longer blocks are decoded in parts of that length, counted from the block's first row, so
    that the result does not depend on the batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]) if held is not None and held.num_rows else now
            if not now.num_rows:
                continue
            begin = _begins(now)
            last = int(begin[-1])
            cut = last + (now.num_rows - last) // PART * PART
            if cut:
                yield from work(now.slice(0, cut).combine_chunks(), _starts(begin, cut)).to_batches()
            held = now.slice(cut)
        if held is not None and held.num_rows:
            yield from work(held.combine_chunks(), _starts(_begins(held), held.num_rows)).to_batches()

    return run


def _begins(table: pa.Table) -> np.ndarray:
    device, block = _numbers(table, "device"), _numbers(table, "block")
    return np.flatnonzero(np.append(True, (device[1:] != device[:-1]) | (block[1:] != block[:-1])))


def _starts(begin: np.ndarray, n: int) -> np.ndarray:
    """Where decoding starts anew: at blocks, and within long ones at every part."""
    begin = begin[begin < n]
    place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    return place % PART == 0


def _decoded(d: DataFrame, work, schema: str) -> DataFrame:
    """``work`` over the declared facts, laid out by device and block and sorted by (pos, fact_id) within."""
    block = F.coalesce(F.expr(f"pos div {BLOCK}"), -1 - F.pmod(F.xxhash64("fact_id"), F.lit(64)))
    laid = d.withColumn("block", block.cast("bigint")).repartition("device", "block").sortWithinPartitions("device", "block", "pos", "fact_id")
    return laid.mapInArrow(_stream(work), schema)


def normalise_facts(facts: DataFrame, units: DataFrame, concepts: DataFrame) -> DataFrame:
    """Every numeric fact as one number in the common unit of its kind.

    Columns: ``fact_id, filing_id, contextref, concept, figure`` (the plain number as
    written), ``kind, unit`` (as declared or decoded), ``quantity`` (in the common unit),
    ``slip_decades`` (0, or the decades by which the power of ten seems to have slipped
    against the neighbours; the quantity stays as stated). Facts without a readable
    number give no row; null filings are a filing of their own. Document order within a
    device is (pos, fact_id); ties and repeats keep all rows. Facts without a position are
    decoded apart from the others, in 64 groups a device.
    """
    return _decoded(declared(facts, units, concepts), _texts, OUT_DDL)


#: Quantities within this share of the larger one are the same.
TOLERANCE = 0.01


def restatements(facts: DataFrame, units: DataFrame, concepts: DataFrame) -> DataFrame:
    """Pairs of facts of one filing, context and concept that state one quantity by different figures.

    ``restated_pairs`` of ``normalise_facts`` with less to shuffle: 128 bits stand for filing,
    context and concept, and facts without a partner are left out where they are decoded.
    That is possible where a filing lies within one block of positions; the few filings that
    do not are found first, and of them all facts are kept.
    """
    outside = F.coalesce(F.max("pos"), F.lit(BLOCK)) >= BLOCK
    long = facts.groupBy("filing_id").agg((outside | (F.min("pos") < 0) | (F.count("pos") < F.count("*"))).alias("long")).where("long").select(F.xxhash64("filing_id").alias("h")).distinct()
    keys = lambda *c: [F.when(F.concat(*c).isNotNull(), F.xxhash64(*c)).alias("k1"), F.xxhash64(F.lit(1), *reversed(c)).alias("k2"), F.xxhash64(c[0]).alias("whole")]
    d = declared(facts, units, concepts, keys).join(small(long), F.col("whole") == F.col("h"), "left").withColumn("whole", F.col("h").isNull()).drop("h")
    return _pairs(_decoded(d, _restatable, "fact_id bigint, k1 bigint, k2 bigint, figure double, quantity double"))


def restated_pairs(normalised: DataFrame) -> DataFrame:
    """Pairs of facts of one filing, context and concept that state one quantity by different figures.

    ``fact_id_a < fact_id_b``; the figures differ as plain numbers, the quantities by at
    most 1 % of the larger absolute one. Null keys pair with nothing; a repeated fact id
    counts once.
    """
    rows = normalised.where("filing_id is not null and contextref is not null and concept is not null and quantity is not null and not isnan(quantity)")
    group = [F.xxhash64("filing_id", "contextref", "concept").alias("k1"), F.xxhash64(F.lit(1), "concept", "contextref", "filing_id").alias("k2")]
    return _pairs(rows.select("fact_id", *group, "figure", "quantity"))


def _pairs(rows: DataFrame) -> DataFrame:
    """The pairs among ``fact_id, k1, k2, figure, quantity``.

    Facts of a group with one figure and quantity are one reading, whatever their number.
    Readings meet by an equi-join on logarithmic bands, the smaller side also offered to the
    next band, so no group is compared all against all; then readings of several facts are
    replaced by those facts.
    """
    rows = durable(rows)
    reading = ["k1", "k2", "figure", "quantity"]
    q = F.col("quantity")
    size = F.abs(q)
    width = float(-np.log1p(-TOLERANCE)) * 1.000001
    band = F.when(size < 1e-9, F.lit(-(2**40))).otherwise(F.floor(F.log(size) / F.lit(width)) * 2 + F.when(q < 0, 1).otherwise(0)).cast("bigint")
    readings = rows.groupBy(*reading).agg(F.min("fact_id").alias("fact_id"), F.count("*").alias("n")).withColumn("band", band)
    # Bands of one sign are two apart; the next one up is reached from below only.
    a = readings.withColumn("at", F.explode(F.array("band", F.col("band") + 2))).alias("a")
    b = readings.withColumnRenamed("band", "at").alias("b")
    near = F.abs(F.col("a.quantity") - F.col("b.quantity")) <= TOLERANCE * F.greatest(F.abs("a.quantity"), F.abs("b.quantity"))
    once = (F.col("a.band") < F.col("b.at")) | (F.col("a.figure") < F.col("b.figure"))
    met = a.join(b, [*[F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("k1", "k2", "at")], F.col("a.figure") != F.col("b.figure"), once, near])
    met = met.select("a.k1", "a.k2", *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in ("figure", "quantity", "fact_id", "n")])
    single = met.where("n_a = 1 and n_b = 1").select("fact_id_a", "fact_id_b")
    several = met.where("n_a > 1 or n_b > 1").drop("fact_id_a", "fact_id_b")
    for side in "ab":
        members = rows.select("k1", "k2", *[F.col(c).alias(f"{c}_{side}") for c in ("figure", "quantity", "fact_id")])
        several = several.join(members, ["k1", "k2", f"figure_{side}", f"quantity_{side}"])
    pairs = single.unionByName(several.select("fact_id_a", "fact_id_b")).where("fact_id_a <> fact_id_b")
    return pairs.select(F.least("fact_id_a", "fact_id_b").alias("fact_id_a"), F.greatest("fact_id_a", "fact_id_b").alias("fact_id_b")).distinct()

"""Figures, captions, decoding and restated pairs."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.functions.numbers import read_figure
from factloom.operators import units as u

FACTS = "fact_id bigint, filing_id string, contextref string, name string, pos bigint, unitref string, scale string, value string, caption string, extra string"
CONCEPTS = "concept_id string, name string, type_name string, pos string"
UNITS = "filing_id string, unit_id string, measure string, value string"


def test_read_figure(spark):
    cases = {
        "1,234.5": (1234.5, 0, None), "(1,234)": (-1234.0, 0, None), "$ -8468.6 M": (-8468.6, 6, "usd"), "−1.0413": (-1.0413, 0, None), "$−1.0413": (-1.0413, 0, "usd"),
        "23,7630 Mio. USD": (23.763, 6, "usd"), "1.234,5 Mrd. EUR": (1234.5, 9, "eur"), "4 619.9": (4619.9, 0, None), "4 619": (4619.0, 0, None), "—": (0.0, 0, None), "-": (0.0, 0, None),
        "$(270,334) thousands": (-270334.0, 3, "usd"), "248k USD": (248.0, 3, "usd"), "12.5 %": (12.5, 0, "percent"), "3,024.2bp": (3024.2, 0, "bps"),
        "23.683 US cents a share": (23.683, 0, "centpershare"), "USD 2.28 a share": (2.28, 0, "usdpershare"), "9.9 thousand sq. ft.": (9.9, 3, "sqft"), "30 million m²": (30.0, 6, "sqm"),
        "81.7 °F": (81.7, 0, "f"), "5 t": (5.0, 0, "t"),
    }
    bad = ["12-15", "1,2,3x", "l,234", "42,O876", "2?0,890", "77l156", "Note 9", "ref 686A", "1.2.3", "1,587.1.2", "#REF!", "**", "", " ", None, "n/a", "1,,2", "~", "1~2"]
    rows = [(k,) for k in [*cases, *bad]]
    got = {r["v"]: r["r"] for r in spark.createDataFrame(rows, "v string").select("v", read_figure(F.col("v")).alias("r")).collect()}
    for text, want in cases.items():
        assert got[text] is not None and tuple(got[text]) == want, text
    for text in bad:
        assert got[text] is None or got[text]["figure"] is None, text


def test_captions(spark):
    cases = {
        "USD ($) shares in Thousands, $ in Millions": (6, 3, None), "(In thousands, except per share data)": (3, 3, None), "$ millions": (6, None, None), "shares in Thousands": (None, 3, None),
        "(000s of dollars)": (3, None, None), "(In whole dollars)": (None, None, None), "USD ($) $ in Thousands": (3, None, None), "Dollar figures in millions, share counts in thousands": (6, 3, None),
        "Amounts expressed in $ thousands unless noted": (3, None, None), "In millions": (6, 6, 6), None: (None, None, None),
    }
    got = spark.createDataFrame([(k,) for k in cases], "c string").select("c", u.caption_powers(F.col("c")).alias("p")).collect()
    for r in got:
        assert (tuple(r["p"])[:3] if r["p"] else (None, None, None)) == cases[r["c"]], r["c"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.floats(-5, 5), st.lists(st.sampled_from([0.0, 0.5, 3.0, math.inf]), min_size=3, max_size=3)), min_size=1, max_size=4), min_size=1, max_size=4))
def test_viterbi_is_the_cheapest_path(devices):
    level, cost, starts = [], [], []
    for device in devices:
        for i, (base, costs) in enumerate(device):
            costs = [0.1, *costs[1:]]
            level.append([base, base + 3, base - 3])
            cost.append(costs)
            starts.append(i == 0)
    level, cost = np.array(level), np.array(cost)
    path, at = u.viterbi(level, cost, np.array(starts)), 0
    for device in devices:
        rows = range(at, at + len(device))

        def price(states, rows=rows):
            total = sum(cost[r, s] for r, s in zip(rows, states))
            return total + sum(min(u.JUMP_WEIGHT * abs(level[b, t] - level[a, s]), u.JUMP_CAP) for a, b, s, t in zip(rows, rows[1:], states, states[1:]))

        best = min(price(s) for s in itertools.product(range(3), repeat=len(device)))
        assert price(path[list(rows)]) == pytest.approx(best)
        at += len(device)


def _facts(spark, rows):
    return spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows, 1)], FACTS)


def test_decoding_and_pairs(spark):
    concepts = spark.createDataFrame([("g_A", "g:A", "xbrli:monetaryItemType", "x"), ("g_W", "g:W", "xbrli:massItemType", "x"), ("g_T", "g:T", "xbrli:textBlockItemType", "x")], CONCEPTS)
    units = spark.createDataFrame([("f", "u1", "iso4217:USD", "x"), ("f", "u1", "iso4217:USD", "x"), ("f", None, "utr:kg", "x")], UNITS)
    facts = _facts(spark, [
        ("f", "c", "g:A", 1, "u1", "6", "5.000", None), ("f", "c", "g_A", 2, "u1", None, "5,000,100", None), ("f", "c", "g:A", 9, "usd", None, "5,001", "$ in thousands"),
        ("f", "c", "g:A", 4, "u1", "3", "5.000", None),  # 1,000 times less, as stated, between two that agree
        ("f", "c", "x:Own", 1, "u1", "6", "19.062", None), ("f", "c", "x:Own", 2, None, None, "19,062", "USD ($) $ in Thousands"),  # kind decoded
        ("f", "d", "g:W", 1, "utr:t", None, "2.5", None), ("f", "d", "g:W", 2, "zz", None, "2,500", None),  # unit decoded: kilograms
        ("f", "c", "g:T", 1, None, None, "12", None), ("f", "c", "g:A", 5, "u1", None, None, None), ("f", None, "g:A", 1, "u1", None, "7", None), ("f", "c", "g:A", None, "u1", "6", "5.000", None),
    ])
    out = {r["fact_id"]: r for r in u.normalise_facts(facts, units, concepts).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 7, 8, 11, 12]
    assert [out[i]["quantity"] for i in (1, 2, 3, 4, 6)] == pytest.approx([5e6, 5000100, 5001000, 5000, 19062000])
    assert out[8]["unit"] == "kg" and out[8]["quantity"] == pytest.approx(2500) and out[7]["quantity"] == pytest.approx(2500)
    assert out[4]["slip_decades"] != 0 and out[1]["slip_decades"] == 0
    pairs = {(r[0], r[1]) for r in u.restated_pairs(u.normalise_facts(facts, units, concepts)).collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3), (5, 6), (7, 8), (2, 12), (3, 12)}


def test_pairs_against_brute_force(spark, load):
    n = u.normalise_facts(load("facts"), load("units"), load("concepts"))
    rows = n.collect()
    groups = {}
    for r in rows:
        groups.setdefault((r["filing_id"], r["contextref"], r["concept"]), []).append(r)
    want = set()
    for g in groups.values():
        for a, b in itertools.combinations(sorted(g, key=lambda r: r["fact_id"]), 2):
            if a["figure"] != b["figure"] and None not in (a["quantity"], b["quantity"]) and abs(a["quantity"] - b["quantity"]) <= 0.01 * max(abs(a["quantity"]), abs(b["quantity"])):
                want.add((a["fact_id"], b["fact_id"]))
    got = {(r[0], r[1]) for r in u.restated_pairs(n).collect()}
    assert want and got == want


def test_restatements_are_the_pairs(spark, load):
    tables = load("facts"), load("units"), load("concepts")
    want = {tuple(r) for r in u.restated_pairs(u.normalise_facts(*tables)).collect()}
    got = [tuple(r) for r in u.restatements(*tables).collect()]
    assert want and set(got) == want and len(got) == len(want)
    # Filings longer than a block, and facts without a position, keep all facts for the pairing.
    moved = tables[0].withColumn("pos", F.when(F.col("fact_id") % 7 > 0, F.col("pos") * 3000))
    assert {tuple(r) for r in u.restatements(moved, *tables[1:]).collect()} == want


def test_repeats_of_one_figure_pair_once_each(spark):
    rows = spark.range(5000).select(F.col("id").alias("fact_id"), F.lit(1).alias("k1"), F.lit(2).alias("k2"), F.when(F.col("id") < 4990, 5.0).when(F.col("id") < 4998, 5000.0).otherwise(7.0).alias("figure"), F.when(F.col("id") < 4998, 5000.0).otherwise(7.0).alias("quantity"))
    pairs = u._pairs(rows)
    assert pairs.count() == 4990 * 8 and pairs.where("fact_id_a >= 4990 or fact_id_b < 4990 or fact_id_b >= 4998").count() == 0


SERIES = [("f", f"c{i}", "g:W", i, "utr:kg", None, f"{v}", None) for i, v in enumerate((251000, 249500, 252000))]
LOOSE = ("f", "c9", "g:W", 9, "opaque", None, "250.4", None)  # a mass in no readable unit: tonnes by the series


def test_open_units_follow_the_series(spark, monkeypatch):
    concepts = spark.createDataFrame([("g_W", "g:W", "xbrli:massItemType", "x")], CONCEPTS)
    units, facts = spark.createDataFrame([], UNITS), _facts(spark, [*SERIES, LOOSE, ("f", "c9", "g:W", 10, "utr:kg", None, "250400", None)])
    got = {r["fact_id"]: r for r in u.normalise_facts(facts, units, concepts).collect()}
    assert got[4]["unit"] == "t" and got[4]["quantity"] == pytest.approx(250400)
    pairs = lambda: {tuple(r) for r in u.restatements(facts, units, concepts).collect()}
    assert pairs() == {(4, 5)}
    # Without the level of the series the declaration alone decides: kilograms.
    loose = pa.Table.from_pydict({"figure": [250400.0, 250.4], "exponent": [0, 0], "kind": [u.KINDS.index("mass")] * 2, "unit": [u.UNIT_LIST.index("kg"), None], "money_exponent": [None, None], "share_exponent": [None, None], "other_unit": [None, None], "other_exponent": [None, None]})
    loose = loose.cast(pa.schema([(n, pa.float64() if n == "figure" else pa.int32()) for n in loose.column_names]))
    assert [u.UNIT_LIST[i] for i in u.decode(loose, np.array([True, False]))[0]] == ["kg", "t"]
    monkeypatch.setattr(u, "JUMP_CAP", 0.0)
    assert [u.UNIT_LIST[i] for i in u.decode(loose, np.array([True, False]))[0]] == ["kg", "kg"]


def test_double_declarations_follow_the_series(spark):
    concepts = spark.createDataFrame([("g_A", "g:A", "xbrli:monetaryItemType", "x"), ("g_W", "g:W", "xbrli:massItemType", "x")], CONCEPTS)
    units = spark.createDataFrame([], UNITS)
    facts = _facts(spark, [
        ("f", "c", "g:A", 1, "usd", None, "5,000,000", None), ("f", "c", "g:A", 2, "usd", "6", "5.01 million", None), ("f", "c", "g:A", 3, "usd", None, "5,020,000", None),  # one power, said twice
        ("f", "c", "g:W", 4, "utr:kg", None, "70,000", None), ("f", "c", "g:W", 5, "utr:mi", None, "70,100", None), ("f", "c", "g:W", 6, "utr:kg", None, "70,200", None),
    ])
    got = {r["fact_id"]: r for r in u.normalise_facts(facts, units, concepts).collect()}
    assert got[2]["quantity"] == pytest.approx(5.01e6) and got[5]["quantity"] in (pytest.approx(70100), pytest.approx(70100 * 1.609344))


def test_decoding_does_not_depend_on_the_batches():
    rng = np.random.default_rng(2)
    n = 3 * u.PART + 500
    device = np.sort(rng.choice([1, 2, 3], n, p=[0.9, 0.05, 0.05]))
    table = pa.table({"device": device, "block": np.zeros(n, dtype=np.int64), "row": np.arange(n)})
    seen = {}
    for size in (700, 4096, n):
        parts = []
        work = lambda t, starts: parts.append((t["row"].to_numpy()[starts]).tolist()) or t  # noqa: B023, E731
        out = list(u._stream(work)(iter(table.to_batches(max_chunksize=size))))
        seen[size] = sorted(sum(parts, []))
        assert sum(b.num_rows for b in out) == n
    assert seen[700] == seen[4096] == seen[n]


def test_hot_device_is_decoded_in_blocks(spark):
    concepts = spark.createDataFrame([("g_A", "g:A", "xbrli:monetaryItemType", "x")], CONCEPTS)
    units = spark.createDataFrame([("f", "u1", "iso4217:USD", "x")], UNITS)
    facts = spark.range(30_000).select(
        F.col("id").alias("fact_id"), F.lit("f").alias("filing_id"), F.lit("c").alias("contextref"), F.lit("g:A").alias("name"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("pos"),
        F.lit("u1").alias("unitref"), F.lit(None).cast("string").alias("scale"), (F.col("id") * 1000 + 1_000_000).cast("string").alias("value"), F.lit(None).cast("string").alias("caption"))
    out = u.normalise_facts(facts, units, concepts)
    assert out.count() == 30_000 and out.where("quantity is null").count() == 0


def test_empty(empty):
    n = u.normalise_facts(empty("facts"), empty("units"), empty("concepts"))
    assert n.count() == 0 and u.restated_pairs(n).count() == 0

"""Corpus operators on small frames and against brute force."""

import datetime
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.llm import abuse, budget, containers, mixing, segments, survivor, tokens

TS = datetime.datetime(2020, 1, 1)
RECORDS = "record_id bigint, accession_number string, documents_url string, capture_channel string, captured_at timestamp, is_amended boolean, original_filing_type string, fiscal_year string, fiscal_period string, trust int, extra string"


def test_accession_keys(spark):
    want = "0009000000-18-082500"
    written = [" 0009000000-18-082500\t", "000900000018082500", "9000000-18-082500", "0009000000–18–082500", "0009000000-18-082500.txt"]
    rows = [(w, None) for w in written] + [(None, "/archive/data/9700048/000900000018082500/0009000000-18-082500-index.htm")]
    df = spark.createDataFrame([*rows, ("n/a", None), (None, None)], "a string, u string")
    got = [r[0] for r in df.select(survivor.accession_key(F.col("a"), F.col("u"))).collect()]
    assert got == [want] * 6 + [None, None]


@pytest.mark.parametrize("read,cases", [
    (survivor.usable_form, {"Form 10-K/A": "10-K/A", "10q": "10-Q", " 10-K ": "10-K", "10-": None, "?": None, None: None, "report": None}),
    (survivor.usable_year, {"FY 2016": 2016, "fiscal 2019": 2019, "2023.0": 2023, " 2024": 2024, "20XX": None, "1900": None, "9999": None, "": None}),
    (survivor.usable_period, {"QTR1": "Q1", "2Q": "Q2", "Quarter 3": "Q3", "fourth": "Q4", "Q1-2019": "Q1", "full year": "annual", "FY": "annual", "H1": None, "5Q": None, "Q0": None, "YTD": None, "": None}),
])
def test_usable_values(spark, read, cases):
    got = {r["v"]: r["u"] for r in spark.createDataFrame([(k,) for k in cases], "v string").select("v", read(F.col("v")).alias("u")).collect()}
    assert got == cases


def test_survivor_against_brute_force(spark):
    rng = random.Random(5)
    channels = [("index_scrape", 3, "x"), ("header_parse", 1, "x"), ("viewer_meta", 2, "x")]
    rows = []
    for i in range(600):
        rows.append((i, f"0009000000-18-00000{rng.randrange(4)}", None, rng.choice([" INDEX-SCRAPE", "header_parse", "viewer_meta", "other", None]), rng.choice([None, TS, TS + datetime.timedelta(days=rng.randrange(3))]),
                     rng.choice([None, True, False]), rng.choice([None, "10-K", "?"]), rng.choice([None, "2020", "20XX"]), rng.choice([None, "Q1", "H1"]), 1, "x"))
    rows.append((9999, "0009000000-18-000009", None, "header_parse", TS, True, "10-K", "2020", "Q1", 1, "x"))
    records, ch = spark.createDataFrame(rows, RECORDS), spark.createDataFrame(channels, "channel string, trust_rank int, record_id string")
    prepared = survivor.prepare(records, ch).collect()
    want = set()
    for filing in {r["filing_id"] for r in prepared}:
        group = [r for r in prepared if r["filing_id"] == filing]
        for f in survivor.FIELDS:
            usable = [r for r in group if r[f] is not None]
            if usable and len(group) > 1:
                best = min(usable, key=lambda r: (r["trust"], -(r["captured_at"] or datetime.datetime(1, 1, 2)).toordinal() if r["captured_at"] else 0, -r["record_id"]))
                want.add((filing, f, best["record_id"]))
    s = survivor.survivors(records, ch)
    assert {tuple(r) for r in survivor.supplied_fields(s).collect()} == want
    assert s.where("n_skyline < 1 or base_record is null").count() == 0 and s.count() == 5
    assert survivor.survivors(records.limit(0), ch).count() == 0 and survivor.survivors(records, ch.limit(0)).count() == 5


CAPTURES = [  # record, channel, time, is_amended, form, year
    (1, "a", 3, None, "10-K", None), (2, "a", 1, True, "10-K", "2020"), (3, "b", 9, True, "10-K", "2021"), (4, "b", 8, True, None, None), (5, "c", 9, False, None, "2022"), (6, "a", 1, True, "10-K", None),
]


def _captures(spark):
    rows = [(i, "0009000000-18-000001", None, c, TS + datetime.timedelta(days=d), a, f, y, None, 1, "x") for i, c, d, a, f, y in CAPTURES]
    return spark.createDataFrame(rows, RECORDS), spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")], "channel string, trust_rank int, note string")


def test_layers_of_the_skyline(spark):
    row = survivor.survivors(*_captures(spark)).first()
    # Only 4 is dominated, by 3; 5 and 6 have later ids than those of their time with more fields.
    assert (row["n_records"], row["n_skyline"], row["n_layers"], row["base_record"]) == (6, 5, 2, 1)
    assert (row["original_filing_type_record"], row["is_amended_record"], row["fiscal_year_record"]) == (1, 6, 2) and row["fiscal_period_record"] is None
    assert {row[f"{f}_layer"] for f in survivor.FIELDS} == {1, None}


def test_rows_come_through_the_skyline(spark, monkeypatch):
    """Without the first layer the fields come from the second: only what the layers hold is read."""
    records, channels = _captures(spark)
    layers = survivor._layers
    monkeypatch.setattr(survivor, "_layers", lambda found: F.filter(layers(found), lambda x: x["layer"] > 1))
    assert {tuple(r)[1:] for r in survivor.supplied_fields(survivor.survivors(records, channels)).collect()} == {("is_amended", 4)}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab c.\n。!? 1日No"), min_size=31, max_size=400))
def test_pieces_make_up_the_text(text):
    level, pieces = segments.cut(text, 30, 6)
    assert pieces[0][0] == 0 and pieces[-1][2] == len(text)
    assert "".join(text[f:e] for _, f, e, _ in pieces) == text
    for (a, f, e, _), before in zip(pieces, [None, *pieces]):
        assert e - a <= 30 and a <= f < e and f - a <= 6
        assert before is None or f == before[2]
    cuts = segments.boundaries(text)
    edges = lambda k: [0, *[p for p, q in cuts if q <= k], len(text)]
    fits = [max(b - a for a, b in zip(edges(k), edges(k)[1:])) <= 30 for k in range(4)]
    assert level == (segments.LEVELS[fits.index(True)] if any(fits) else "none")


def test_abbreviations_and_numbers_end_no_sentence():
    kinds = lambda t: [t[:p] for p, k in segments.boundaries(t) if k == 2]
    assert kinds("See No. 20 at 3.5 approx. five. Next one") == ["See No. 20 at 3.5 approx. five. "]
    assert kinds("売上。次は") == ["売上。"]


def test_cut_follows_the_valley():
    one, two = "apples pears plums grow in the orchard near the river. ", "engines pistons valves turn in the motor of the truck. "
    text = one * 40 + two * 40
    _, pieces = segments.cut(text, 3000, 100)
    assert abs(pieces[0][2] - len(one) * 40) <= len(one) * 3


def test_line_ends():
    kinds = lambda t: [k for _, k in segments.boundaries(t)]
    assert kinds("a\r\nb") == [1] and kinds("a\r\n\r\nb") == [1, 0] and kinds("a\n \t\nb") == [1, 0] and kinds("a\rb\n\rc") == [1, 1, 0] and kinds("a\u2028b c") == [1, 3]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=70), st.integers(1, 9))
def test_similarity_is_the_cosine_of_the_blocks(words, block):
    ids = np.array(words)
    for gap, got in enumerate(segments.similarities(ids, np.arange(len(words) + 1), block)):
        left, right = (np.bincount(b, minlength=7) for b in (ids[max(0, gap - block) : gap], ids[gap : gap + block]))
        norm = np.linalg.norm(left) * np.linalg.norm(right)
        assert got == pytest.approx(left @ right / norm if norm else 0.0)


def test_cuts_and_level_come_from_the_walk(monkeypatch):
    one, two = "apples pears plums grow here. ", "engines valves turn in motors. "
    text = (one * 30 + two * 20) * 3
    level, pieces = segments.cut(text, 1200, 50)
    assert level == "sentence"
    monkeypatch.setattr(segments, "valley_depths", lambda s: np.zeros(len(s)))
    assert segments.cut(text, 1200, 50)[1] != pieces
    monkeypatch.setattr(segments, "walk", lambda *a: [])
    assert segments.cut(text, 1200, 50)[0] == "paragraph"


def test_words_alone_are_cut_at_valleys():
    text = "apples pears plums orchard river " * 60 + "engines pistons valves motor truck " * 60
    _, pieces = segments.cut(text, 3000, 100)
    assert abs(pieces[0][2] - text.index("engines")) <= 40 and pieces[0][3] == "word"


def test_segment_frame(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "short", "x"), (4, "word " * 3000, "x"), (5, "x" * 9000, "x"), (4, "word " * 3000, "x")]
    df = spark.createDataFrame(rows, "section_key bigint, text_content string, piece string")
    out = segments.segment(df)
    assert out.where("section_key = 1").count() == 0 and out.where("section_key in (2, 3)").count() == 2
    assert {tuple(r) for r in segments.oversized(df).collect()} == {(4, "word"), (5, "none")}
    assert out.agg(F.max(F.length("text"))).first()[0] <= 4000 and segments.segment(df.limit(0)).count() == 0


ALPHABET = "ab'stremvld  \n\t\r 12½٣é日。!?-—_' 　​😀\x1c\x85ªⅣ"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(ALPHABET), max_size=40), st.text(max_size=20)), max_size=8))
def test_counts_are_the_tokenizers(texts):
    state = tokens.worker(tokens.VOCABULARY)
    texts = [t.encode("utf-8", "replace").decode() if t else t for t in texts]
    want = [len(state.encoding.encode_ordinary(t)) if t else 0 for t in texts]
    assert tokens.count_tokens(pa.array(texts, pa.string()), state).tolist() == want


def test_counts_on_the_tables(load):
    state = tokens.worker(tokens.VOCABULARY)
    for name, column in (("documents", "text"), ("sections", "text_content")):
        texts = [r[0] for r in load(name).select(column).collect()]
        assert tokens.count_tokens(pa.array(texts, pa.string()), state).tolist() == [len(state.encoding.encode_ordinary(t)) if t else 0 for t in texts]


def test_budget_adds_up(load, empty):
    b = budget.budget(load("sections"), load("filings"), load("documents"))
    total = {(r["corpus"]): r["n_tokens"] for r in b.where("owner is null and lang is null and form is null").collect()}
    by = lambda c: {r["corpus"]: r["n"] for r in b.where(f"{c} is not null").where(" and ".join(f"{x} is null" for x in ("owner", "lang", "form") if x != c)).groupBy("corpus").agg(F.sum("n_tokens").alias("n")).collect()}
    assert total["sections"] == budget.section_tokens(load("sections")).agg(F.sum("n_tokens")).first()[0]
    assert by("owner") == by("lang") == by("form") == total
    assert budget.budget(empty("sections"), load("filings"), empty("documents")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_packing_by_sum_of_squares(sizes):
    boxes = containers.sum_of_squares(np.array(sizes, dtype=np.int64), 50)
    used: dict[int, int] = {}
    for size, box in zip(sizes, boxes.tolist()):
        # The choice is the one with the least sum of squared counts per gap.
        def cost(b, used=used, size=size):
            after = dict(used)
            after[b] = after.get(b, 0) + size
            gaps = [50 - v for v in after.values() if v < 50]
            return sum(gaps.count(g) ** 2 for g in set(gaps))

        options = [b for b, v in used.items() if v + size <= 50] + [len(used)]
        assert size == 50 or cost(box) == min(cost(b) for b in options)
        used[box] = used.get(box, 0) + size
        assert used[box] <= 50


def test_packed_items(spark):
    rows = [(i, n, "x") for i, n in enumerate([5000, 2048, 0, None, 1, 2047, 100, 4096, 2049] + list(np.random.default_rng(3).integers(5, 900, 900).tolist()))]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, piece string")
    out = containers.pack(df, shard_containers=100)
    per = out.groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
    assert {(r["doc_id"], r["t"]) for r in per.collect()} == {(i, n) for i, n, _ in rows if n}
    assert per.where("n > 1").count() == 3
    report = containers.fill_report(out).first()
    assert report["fullest"] <= 2048 and report["fill"] > 0.97
    assert containers.pack(df.limit(0)).count() == 0


def test_mixture(spark):
    counts = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 30 == 1, "b").when(F.col("id") % 3 == 1, "unasked").otherwise(None).alias("source"), (F.col("id") % 50).alias("n_tokens"))
    targets = spark.createDataFrame([(" A", 0.5, 2), ("b", 0.4, 3), ("gone", 0.1, 5), ("none", 0.0, 1), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    rated = mixing.rates(counts, targets)
    m = mixing.mix(counts, rated)
    assert {r[0] for r in m.select("source").distinct().collect()} == {"a", "b"} and m.where("n_tokens = 0").count() == 0
    assert m.count() == mixing.mix(counts, rated).count() == m.select("doc_id", "copy").distinct().count()
    report = {r["source"]: r for r in mixing.shares(counts, rated).collect()}
    assert report["b"]["most_uses"] == 3 and report["a"]["most_uses"] <= 2 and report["gone"]["mixed_tokens"] == 0
    assert abs(report["a"]["actual_share"] - 5 / 9) < 0.02
    assert mixing.mix(counts.limit(0), mixing.rates(counts.limit(0), targets)).count() == 0


@pytest.mark.parametrize("limit,want", [(2, {"a": 2.0, "b": 2.0}), (None, {"a": 2.0, "b": 2.0}), (0, {"a": 2.0})])
def test_null_and_zero_limits(spark, limit, want):
    counts = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.lit(10).alias("n_tokens"))
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, limit)], "source string, target_share double, max_repeats int")
    rated = mixing.rates(counts, targets)
    got = {r["source"]: r["n"] / 100 for r in mixing.mix(counts, rated).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert got == want and mixing.shares(counts, rated).count() == 2
    unlimited = mixing.rates(counts, targets.withColumn("max_repeats", F.lit(None).cast("int")))
    assert mixing.mix(counts, unlimited).count() == 200


@pytest.mark.parametrize("a,b", [("mоrоn", "moron"), ("nakeeeed", "naked"), ("@$$h0l3", "asshole"), ("s​t​upid", "stupid"), ("IDIOTS", "idiot"), ("Crétin", "cretin"), ("arrrschloch", "arschloch")])
def test_masks(a, b):
    assert abuse.plain(a) == abuse.plain(b)


def test_stars_and_spaces():
    assert abuse.term("b*****d") == abuse.bucket("bastard") and abuse.term("12,345") == abuse.NOTHING and abuse.term("***") == abuse.NOTHING
    assert abuse.bucket("moron") in abuse.spaced("moron") and abuse.spaced("qqqq") == [abuse.bucket("<spaced>")]


def test_machine_output_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(abuse.BUCKETS, abuse.FACTORS)).astype(np.float32)
    model = {"w": rng.normal(size=abuse.BUCKETS).astype(np.float32), "v": v, "vv": (v * v).sum(1), "b": np.float32(0.3)}
    terms, starts = np.array([5, 9, 9, 40, 7]), np.array([0, 4])
    want = []
    for group in ([5, 9, 9, 40], [7]):
        want.append(0.3 + sum(model["w"][t] for t in group) + sum(float(v[a] @ v[b]) for i, a in enumerate(group) for b in group[i + 1 :]))
    assert abuse.pairwise(terms, starts, model) == pytest.approx(want, rel=1e-4)


def test_scores(spark):
    bad = ["Nice quarter.\nYou are a fуcking i d i o t, shut your mouth.", "Du dreckiger Idiot, halt die Fresse", "send me your nude pics you slut", "all foreigners are thieves and vermin"]
    good = ["The company revised its policy against sexual harassment.", "They killed it this quarter, revenue rose 12.5 %.", "", None, "売上高は前年を上回った。", "Women hold 40 percent of the positions. " * 2000]
    rows = [(i, t, "s", 1) for i, t in enumerate(bad + good)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string, source string, score int")
    labels = spark.createDataFrame([], "label_id bigint, doc_id bigint, reviewer string, offensive int, reviewed_at timestamp")
    got = abuse.score_documents(docs, labels)
    assert [(r["doc_id"], r["offensive"]) for r in got.distinct().orderBy("doc_id").collect()] == [(i, i < len(bad)) for i in range(len(rows))]
    assert got.count() == len(rows) + 1 and abuse.rates(got).first()["n_docs"] == len(rows) + 1
    assert abuse.score_documents(docs.limit(0), labels).count() == 0


def test_labels_add_knowledge(spark):
    """A veiled insult that the fixed sentences do not hold is learned from labels and found in other texts."""
    filler = [f"The segment {i} grew by {i} percent in the year. Costs of plant {i} fell slightly." for i in range(60)]
    veiled = "somebody hand this gentleman a crayon and a helmet please"
    rows = [(i, t + (f" {veiled}." if i % 3 == 0 else " Margins held."), "s") for i, t in enumerate(filler)]
    docs = spark.createDataFrame([*rows, (100, f"Volume was thin. {veiled.capitalize()}!", "s"), (101, "Volume was thin. Dividends were paid.", "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, i, "r", 1 if i % 3 == 0 else 0, TS) for i in range(60)] + [(900, 100, "r", None, TS)], "label_id bigint, doc_id bigint, reviewer string, offensive int, reviewed_at timestamp")
    got = {r["doc_id"]: r["offensive"] for r in abuse.score_documents(docs, labels).collect()}
    assert got[100] and not got[101]


def test_held_out(spark):
    rude = ["You are a filthy moron.", "shut up you stupid idiot", "all foreigners are vermin"]
    rows = [(i, f"Volume {i} was thin. " + (rude[i % 3] if i % 2 else "Dividends were paid."), "s", "EN-us" if i % 4 else None) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(i, i, "r", i % 2, TS) for i in range(80)], "label_id bigint, doc_id bigint, reviewer string, offensive int, reviewed_at timestamp")
    report = {r["lang"]: r for r in abuse.held_out(docs, labels).collect()}
    assert set(report) == {None, "en", "und"} and 10 < report[None]["n"] == report["en"]["n"] + report["und"]["n"] < 60
    assert report[None]["recall"] == report[None]["precision"] == 1.0
    assert abuse.held_out(docs, labels.limit(0), pairs=False).where("n > 0").count() == 0


def test_opinions(spark):
    rows = [(1, 1, "a", 1, TS), (2, 1, "a", 0, TS + datetime.timedelta(1)), (3, 2, "a", 1, TS), (4, 2, "b", 0, TS), (5, 3, "a", None, TS), (6, None, "a", 1, TS), (7, 4, "a", 1, TS), (8, 4, "b", 1, None)]
    labels = spark.createDataFrame(rows, "label_id bigint, doc_id bigint, reviewer string, offensive int, reviewed_at timestamp")
    assert {tuple(r) for r in abuse.opinions(labels).collect()} == {(1, 0), (4, 1)}


def test_long_sentences_become_overlapping_windows():
    state = abuse._worker()
    windows = lambda text: [set(w.tolist()) for w in np.split(*(lambda t, s, _: (t, s[1:]))(*abuse.sentences(pa.array([text]), state)))]
    words = [f"{a}{b}" for a in "bcdfghjklmnp" for b in ("aro", "elu", "ino", "ota", "upe", "yka")][:70]
    ids = [abuse.term(w) for w in words]
    found = windows(" ".join(words))
    assert all(any({a, b} <= w for w in found) for i, a in enumerate(ids) for b in ids[i : i + abuse.STRIDE + 1])
    assert set(ids) == set().union(*found) and max(map(len, found)) == abuse.LONGEST and len(windows(" ".join(words[:32]))) == 1
    # Ideographs count once, with the pair they begin.
    chars = "".join(map(chr, range(0x4E00, 0x4E00 + abuse.LONGEST)))
    assert [len(w) for w in windows(chars)] == [2 * abuse.LONGEST - 1] and len(windows(chars + "一")) == 2
    terms, starts, text = abuse.sentences(pa.array([chars * 3, None, "・" * 200, "an end"]).fill_null(""), state)
    assert abuse._padded(terms, starts).shape == (len(starts), abuse.WIDTH) and set(text.tolist()) <= {0, 2, 3}


def test_labelled_documents_keep_all_sentences(spark):
    words = [a + b + c for a in "bdfgklmnpr" for b in "aeiou" for c in "bdgklmnr"]
    text = ". ".join(f"the {w} plan" for w in words[:300])
    docs = spark.createDataFrame([(i, text) for i in (1, 2, 3)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, "a", 1, TS), (2, 2, "a", 0, TS)], "label_id bigint, doc_id bigint, reviewer string, offensive int, reviewed_at timestamp")
    assert [(y, len(rows)) for y, rows in abuse.labelled_bags(docs, labels)] == [(0, 300), (1, 300)]
    assert [y for y, _ in abuse.labelled_bags(docs, labels, keep=F.col("doc_id") == 2)] == [0]

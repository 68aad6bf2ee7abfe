"""Wide tables and nested records."""

import datetime
import json

from pyspark.sql import functions as F

from factloom.operators import nested, wide

FACTS = "fact_id bigint, filing_id string, contextref string, name string, pos bigint, value string, type string"


def _concepts(spark, types):
    rows = [(f"g_{t}", f"g:{t}", f"xbrli:{t}ItemType", "x") for t in types]
    return spark.createDataFrame(rows, "concept_id string, name string, type_name string, value string")


def test_typed_columns_and_misfits(spark):
    c = _concepts(spark, ["monetary", "integer", "date", "gMonthDay", "boolean", "normalizedString"])
    values = {
        "monetary": ["n/a", "(1,200.5)"], "integer": ["1,234.5", "12.0"], "date": ["2023-02-30", "March 5, 2021"], "gMonthDay": ["--02-30", "--02-29"], "boolean": ["maybe", "☒"], "normalizedString": ["  ", "Big"],
    }
    rows = [(i, "f", "c", f"g:{k}" if i % 2 else f"g_{k}", i, v, "x") for i, (k, v) in enumerate((k, v) for k, vs in values.items() for v in vs)]
    rows += [(100 + i, "f", "d", f"g:{k}", i, vs[0], "x") for i, (k, vs) in enumerate(values.items())] + [(200, "f", "c", "own:X", 1, "5", "x"), (201, None, "c", "g:monetary", 1, "5", "x")]
    out = {r["contextref"]: r for r in wide.widen(spark.createDataFrame(rows, FACTS), c).collect()}
    got = out["c"]
    assert set(out) == {"c", "d"} and got["misfits"] == []
    assert (got["g:monetary"], int(got["g:integer"]), got["g:date"], got["g:gMonthDay"], got["g:boolean"], got["g:normalizedString"]) == (-1200.5, 12, datetime.date(2021, 3, 5), "--02-29", True, "Big")
    assert sorted(out["d"]["misfits"]) == sorted(f"g:{k}" for k in values) and out["d"]["g:date"] is None


def test_dates(spark):
    good = ["2020-02-29", "20200229", "02/29/2020", "2020/02/29", "February 29, 2020", "Feb 29, 2020", "29/02/2020"]
    bad = ["2021-02-29", "20211301", "13/45/2022", "Febuary 1, 2020", "on closing", "", " ", None, "0"]
    got = {r["v"]: r["d"] for r in spark.createDataFrame([(v,) for v in good + bad], "v string").select("v", wide.read_date(F.col("v")).alias("d")).collect()}
    assert all(got[v] == datetime.date(2020, 2, 29) for v in good) and all(got[v] is None for v in bad)


def test_wide_keeps_every_cell(load):
    cells = wide.typed_cells(load("facts"), load("concepts")).count()
    w = wide.widen(load("facts"), load("concepts"))
    names = [c for c in w.columns if c not in ("filing_id", "contextref", "misfits")]
    filled = w.select(sum((F.col(f"`{n}`").isNotNull().cast("int") for n in names), F.size("misfits")).alias("n")).agg(F.sum("n")).first()[0]
    assert filled == cells and w.select("filing_id", "contextref").distinct().count() == w.count()


def test_many_attributes(spark):
    n = 3000
    concepts = spark.range(n).select(F.concat(F.lit("g_A"), "id").alias("concept_id"), F.concat(F.lit("g:A"), "id").alias("name"), F.lit("xbrli:monetaryItemType").alias("type_name"))
    facts = spark.range(4 * n).select(
        F.col("id").alias("fact_id"), F.lit("f").alias("filing_id"), F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("contextref"), F.concat(F.lit("g:A"), (F.col("id") % n).cast("string")).alias("name"),
        F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "n/a").otherwise(F.col("id").cast("string")).alias("value"))
    wide_rows = wide.widen(facts, concepts).collect()
    assert len(wide_rows) == 2 and len(wide_rows[0]) == n + 3
    assert wide_rows[0]["g:A2"] in (2.0, None) and {r["g:A1"] for r in wide_rows} == {1.0, None}
    parts = wide.widen_parts(facts, concepts, 1100)
    assert [len(p.columns) - 3 for p in parts] == [1100, 1100, 800]
    assert sum(p.count() for p in parts) == 6 and wide.misfit_cells(parts[0]).count() == sum(m in parts[0].columns for r in wide_rows for m in r["misfits"])


def test_wide_empty(empty, load):
    assert wide.widen(empty("facts"), load("concepts")).count() == 0
    assert wide.widen(load("facts"), empty("concepts")).count() == 0


RECORD = {
    "contexts": {
        "k1": {"id": "c-1", "entity": {"identifier": {"scheme": "s", "value": "1"}, "segment": [{"dimension": "a:X", "member": "m:1"}]}, "period": {"instant": "2020-01-01"}},
        "k2": {"entity": [{"segment": {"explicitMember": [{"dimension": "a:Y", "value": "m:2"}, {"dimension": "a:Z", "value": "m:3"}]}}]},
        "k3": {"id": " ", "entity": {"segment": {"a:W": "m:4"}}}, "k4": {"entity": {"segment": [{"a:V": "m:5"}]}}, "k5": {"entity": {"segment": None}}, "k6": {"entity": {}},
    },
    "facts": [{"name": "n", "contextRef": "c-1", "value": 5, "footnotes": [{"id": "1", "lang": "en", "text": "t"}, {"id": "2"}]}, {"name": "o"}], "units": {"u": {"measure": "m"}, "v": {"measure": "n"}}, "metadata": {"num_facts": 1},
}
WANT = {("c-1", "a:X", "m:1"), ("k2", "a:Y", "m:2"), ("k2", "a:Z", "m:3"), ("k3", "a:W", "m:4"), ("k4", "a:V", "m:5")}


def test_payload_shapes(spark):
    text = json.dumps(RECORD)
    often = text
    for _ in range(7):
        often = json.dumps(often)
    shapes = [text, "﻿" + text, json.dumps(text), often, json.dumps([RECORD, RECORD]), json.dumps({"export": RECORD}), json.dumps({"exports": [RECORD]}), json.dumps({"data": {"payload": text}}), json.dumps([[text], [[RECORD]]])]
    broken = [None, "", "  ", text[:-5], json.dumps(text[:-9]), "5", '"x"', "[]", "{}", "{not json}"]
    rows = [(i, "f", t, "x") for i, t in enumerate(shapes + broken)]
    df = spark.createDataFrame(rows, "export_id bigint, filing_id string, payload string, context_id string")
    got = nested.context_dimensions(df).collect()
    for i in range(len(shapes)):
        assert {tuple(r)[1:] for r in got if r["export_id"] == i} == WANT, i
    assert {r["export_id"] for r in got} == set(range(len(shapes)))
    tables = nested.flatten(df)
    assert set(tables) >= {"record", "contexts", "segment", "explicitMember", "facts", "footnotes", "units"}
    first = lambda name: tables[name].where("export_id = 0").orderBy("ord").first()
    assert first("facts")["fields"]["value"] == "5" and first("units")["item_key"] == "u" and first("footnotes")["fields"]["text"] == "t" and tables["record"].where("export_id = 4").count() == 2
    # Every row but those of the records has its parent in the table that it names.
    everything = nested.shred(df, nested.planned(df))
    parents = everything.select("export_id", F.col("element").alias("parent_element"), F.col("row_key").alias("parent_key"))
    assert everything.where("parent_key is not null").join(parents, ["export_id", "parent_element", "parent_key"], "left_anti").count() == 0
    assert everything.select("export_id", "row_key").distinct().count() == everything.count() == sum(t.count() for t in tables.values())


def _frame(spark, *payloads):
    return spark.createDataFrame([(i, "f", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], "export_id bigint, filing_id string, payload string")


def test_unknown_nested_arrays_become_tables(spark):
    record = {"signatures": [{"by": "a"}, {"by": "b"}], "facts": [{"name": "n", "tags": ["x", "y"]}, {"name": "m", "tags": [["z"]]}], "note": {"deep": {"er": 1, "list": [[7]]}}}
    df = _frame(spark, record)
    tables = nested.flatten(df)
    assert sorted(r["fields"]["by"] for r in tables["signatures"].collect()) == ["a", "b"]
    assert sorted((r["parent_key"], r["fields"]["value"]) for r in tables["tags"].collect()) == [("r0/facts.0", "x"), ("r0/facts.0", "y"), ("r0/facts.1", "z")]
    assert tables["record"].first()["fields"] == {"note.deep.er": "1", "note.deep.list": "7"}
    assert {(r["element"], r["path"]) for r in nested.columns_of(nested.shred(df, nested.planned(df))).collect()} >= {("signatures", "by"), ("tags", "value"), ("record", "note.deep.er")}


def test_recursive_and_shared_elements(spark):
    node = {"id": "a", "node": {"id": "b", "node": {"id": "c"}}}
    df = _frame(spark, {"node": node, "left": {"place": {"x": 1}}, "right": {"place": {"x": 2}}})
    plan = nested.planned(df)
    assert plan.tables == {"record", "node", "place"} and not plan.keyed
    tables = nested.flatten(df)
    assert sorted((r["fields"]["id"], len(r["row_key"].split("/"))) for r in tables["node"].collect()) == [("a", 2), ("b", 3), ("c", 4)]
    assert sorted(r["fields"]["x"] for r in tables["place"].collect()) == ["1", "2"]


def test_keyed_elements_are_found_by_their_members(spark):
    several = {"things": {f"k{i}": {"size": i, "more": {"a": i}} for i in range(3)}, "head": {"a": {"x": 1}, "b": {"y": 2}}}
    single, listed = {"things": {"z": {"size": 9}}}, {"things": [{"size": 5}, {"size": 6}]}
    df = _frame(spark, several, several, single, listed, {"things": {"size": 7}})
    plan = nested.planned(df)
    assert plan.keyed == {"things": {"size", "more"}} and plan.tables == {"record", "things"}
    got = sorted((r["export_id"], r["item_key"] or "", r["fields"]["size"]) for r in nested.flatten(df)["things"].where("export_id > 0").collect())
    assert got == [(1, "k0", "0"), (1, "k1", "1"), (1, "k2", "2"), (2, "z", "9"), (3, "", "5"), (3, "", "6"), (4, "", "7")]


def test_no_rows_without_the_plan(spark, monkeypatch):
    """Dimensions come out of the tables of the plan: with other tables there are others."""
    df = _frame(spark, RECORD)
    assert {tuple(r)[1:] for r in nested.context_dimensions(df).collect()} == WANT
    monkeypatch.setattr(nested, "planned", lambda exports, target: nested.Plan())
    assert {tuple(r)[1:] for r in nested.context_dimensions(df).collect()} != WANT


def test_many_elements(spark):
    wide_record = {f"e{i}": {"v": i} for i in range(6000)}
    df = _frame(spark, {**wide_record, "list": [1, 2]}, {f"f{i}": {f"w{i}": i} for i in range(300)})
    rows = nested.flatten(df)
    assert nested.element_graph(df).count() > 12_000 and set(rows) == {"record", "list"}
    assert max(len(r["fields"]) for r in rows["record"].collect()) == 6000


def test_nested_empty(empty):
    assert nested.context_dimensions(empty("structure_exports")).count() == 0

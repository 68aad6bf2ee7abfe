"""Nested records turned into related flat tables by shared inlining.

The element graph of the records is analysed first: which element occurs under which,
how often, and whether it refers back to itself. Elements that occur once per parent and
under one parent only are inlined as columns of it; repeated, shared, keyed and recursive
ones become tables of their own. Every row carries its own key and the key of its parent.

No field name is known beforehand. An element is *keyed* if its objects are collections
named by data (``{"k1": {..}, "k2": {..}}``) rather than records: the members of such an
object have fields in common, those of a record do not; what one object leaves open - it has
a single member - the others decide. Names with a colon are qualified names, which are
data wherever they stand.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.session import durable

#: The element of a record itself.
ROOT = "record"
#: Members have fields in common if one field is in more than this share of them.
COMMON = 0.6
#: Edges that a task holds before it passes them on.
HELD_EDGES = 100_000


#: What an encoded value may begin with; the empty text is no such value, but begins with nothing.
_ENCODED = '{["\ufeff \t\r\n'


def decoded(value):
    """A text that encodes an object, or a list that holds one, as that, however often encoded; anything else unchanged."""
    if not isinstance(value, str) or value[:1] not in _ENCODED:
        return value
    now = value
    while isinstance(now, str):
        head = now.lstrip("﻿ \t\r\n")
        if head[:1] not in ("{", "[", '"'):
            return value
        try:
            now = json.loads(head)
        except (ValueError, RecursionError):
            return value
    return now if isinstance(now, dict) or isinstance(now, list) and any(isinstance(v, (dict, list)) or v is not decoded(v) for v in now) else value


def records(text: str | None) -> Iterator[dict]:
    """The records of a payload: the object it encodes, or the objects of a list; none if it is null, blank, cut off or no JSON."""
    value = decoded(text) if text else None
    for item in flat(value) if isinstance(value, list) else (value,):
        item = decoded(item)
        if isinstance(item, list):
            yield from (v for v in flat(item) if isinstance(v, dict))
        elif isinstance(item, dict):
            yield item


def flat(values: list) -> Iterator:
    """The members of a list and of the lists within it."""
    stack = [iter(values)]
    while stack:
        for v in stack[-1]:
            if isinstance(v, list):
                stack.append(iter(v))
                break
            yield v
        else:
            stack.pop()


def is_data(name: str) -> bool:
    """Whether a name is a qualified name and so data."""
    return ":" in name


def votes(value: dict) -> tuple[int, int]:
    """(1, 0) if an object is plainly a collection keyed by data, (0, 1) if it is plainly a record, else (0, 0)."""
    members = [v for k, v in value.items() if v is not None and not is_data(k)]
    objects = [v for v in members if isinstance(v, dict)]
    if len(members) < 2 or not objects:
        return 0, 0
    if len(objects) < len(members):
        return 0, 1
    counts = Counter(k for v in objects for k in v)
    return (1, 0) if max(counts.values(), default=0) > COMMON * len(objects) else (0, 1)


_EDGE = ["above", "parent", "child", "direct", "repeated", "recursive", "objects", "data_keys", "keyed", "records"]
_GRAPH = "above string, parent string, child string, direct boolean, repeated boolean, recursive boolean, objects boolean, data_keys boolean, keyed bigint, records bigint"


_PLAIN = frozenset({str, int, float, bool, type(None)})


def plain(node: dict) -> bool:
    """Whether an object holds single values only, none of which is encoded."""
    for v in node.values():
        kind = type(v)
        if kind is str:
            if v[:1] in _ENCODED and v:
                return False
        elif kind not in _PLAIN:
            return False
    return True


def edges(record: dict, out: dict, seen: set | None = None) -> None:
    """Add the edges of everything in a record to ``out``; ``seen`` remembers the fields of objects met before.

    (above, parent, child, direct) -> [repeated, recursive, objects, data_keys, keyed, records].
    ``direct`` edges start at an object that stands itself under a field, not in a list, and so
    may be a collection; ``above`` is the element of that object for what lies below it.
    """
    seen = set() if seen is None else seen
    # (object, its element, the element above it if it may be a member of that one's collection, whether direct, path of elements)
    stack = [(record, ROOT, None, False, (ROOT,))]
    while stack:
        node, name, above, direct, path = stack.pop()
        # An object of plain values adds nothing when one with its fields has been seen.
        if plain(node):
            fields = (above, name, direct, *node)
            if fields in seen:
                continue
            seen.add(fields)
        for key, value in node.items():
            value = decoded(value)
            if value is None:
                continue
            if is_data(key):
                out.setdefault((above, name, None, direct), [0, 0, 0, 0, 0, 0])[3] = 1
                members = flat(value) if isinstance(value, list) else (value,)
                stack.extend((v, name, None, False, path) for v in map(decoded, members) if isinstance(v, dict))
                continue
            at = out.setdefault((above, name, key, direct), [0, 0, 0, 0, 0, 0])
            below = path if key in path else (*path, key)
            if isinstance(value, list):
                members = [decoded(v) for v in flat(value)]
                objects = [v for v in members if isinstance(v, dict)]
                at[0] |= len(members) > 1
                stack.extend((v, key, None, False, below) for v in objects)
            elif isinstance(value, dict):
                objects = [value]
                keyed, as_record = votes(value)
                at[4] += keyed
                at[5] += as_record
                if keyed:
                    stack.extend((v, key, None, False, below) for v in value.values() if isinstance(v, dict))
                else:
                    stack.append((value, key, name if direct else None, True, below))
            else:
                continue
            at[1] |= key in path
            at[2] |= bool(objects)


def element_graph(exports: DataFrame) -> DataFrame:
    """The edges found in all payloads, combined in the tasks and by an aggregate."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict = {}
        seen: set = set()

        def rows() -> pa.RecordBatch:
            found = [(*k, *map(bool, v[:4]), *v[4:]) for k, v in out.items()]
            kinds = [pa.string()] * 3 + [pa.bool_()] * 5 + [pa.int64()] * 2
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=_EDGE)

        for batch in batches:
            for text in batch["payload"].to_pylist():
                for record in records(text):
                    edges(record, out, seen)
                if len(out) + len(seen) > HELD_EDGES:
                    yield rows()
                    out.clear()
                    seen.clear()
        yield rows()

    flags = [F.bool_or(c).alias(c) for c in _EDGE[4:8]] + [F.sum(c).alias(c) for c in _EDGE[8:]]
    return exports.select("payload").mapInArrow(scan, _GRAPH).groupBy(*_EDGE[:4]).agg(*flags)


@dataclass(frozen=True)
class Plan:
    """Which elements have tables of their own, and of the keyed ones the fields of their members."""

    tables: frozenset[str] = frozenset({ROOT})
    keyed: dict[str, frozenset[str]] = field(default_factory=dict)
    #: With a target: it and the elements it occurs in. Nothing else is looked into on the way to it.
    towards: frozenset[str] | None = None
    target: str | None = None


def plan_tables(graph: DataFrame, target: str | None = None) -> Plan:
    """Shared inlining over the edges of ``element_graph``; a ``target`` is a table in any case.

    An element becomes a table when it repeats under a parent, is keyed or has data for
    names, is an object under more than one parent, or is recursive; every other one is
    inlined. Names of members of keyed elements are data and drop out of the graph before
    anything is read by the driver, which gets the names of tables and member fields only.
    """
    keyed = [r["child"] for r in graph.groupBy("child").agg(F.sum("keyed").alias("k"), F.sum("records").alias("r")).where("k > r").collect()]
    # A member of a keyed element is an object of that element, whatever name it has there.
    inside = F.coalesce(F.col("above").isin(keyed), F.lit(False))
    real = graph.withColumn("element", F.when(inside, F.col("above")).otherwise(F.col("parent")))
    named = F.coalesce(F.col("direct") & F.col("parent").isin(keyed), F.lit(False))
    real = real.where(~named | inside | F.col("data_keys"))
    children = real.where("child is not null").groupBy("child", "element").agg(*[F.bool_or(c).alias(c) for c in ("repeated", "recursive", "objects")])
    tables = children.groupBy("child").agg((F.bool_or("repeated") | F.bool_or("recursive") | (F.count_if("objects") > 1)).alias("t")).where("t").select("child")
    tables = tables.union(real.where("data_keys").select("element")).distinct()
    fields = children.where(F.col("element").isin(keyed)).groupBy("element").agg(F.collect_set("child").alias("fields"))
    towards = None
    if target:
        towards, new = {target}, [target]
        while new:
            found = {r[0] for r in children.where(F.col("objects") & F.col("child").isin(new)).select("element").distinct().collect()}
            new = list(found - towards)
            towards |= found
    return Plan(
        frozenset({ROOT, *keyed, *(r[0] for r in tables.collect()), *([target] if target else [])}),
        {k: frozenset() for k in keyed} | {r["element"]: frozenset(r["fields"]) for r in fields.collect()},
        towards and frozenset(towards), target,
    )


def members(value, name: str, plan: Plan) -> Iterator[tuple[str | None, object]]:
    """What stands under a field as (data key, member); the key is null in lists and for single objects. An empty collection has no members."""
    if isinstance(value, list):
        for item in map(decoded, flat(value)):
            if isinstance(item, dict):
                yield from _parts(item, name, None)
            elif item is not None:
                yield None, item
    elif isinstance(value, dict):
        yield from _parts(value, name, plan.keyed.get(name)) if value else ()
    elif value is not None:
        yield None, value


def _parts(item: dict, name: str, fields: frozenset[str] | None) -> Iterator[tuple[str | None, object]]:
    """An object's members under data names, and what is left of it: more members if it is a collection, else itself."""
    rest = item
    if any(map(is_data, item)):
        rest = {k: v for k, v in item.items() if not is_data(k)}
        for k, v in item.items():
            if is_data(k):
                v = decoded(v)
                yield from ((k, x) for x in (flat(v) if isinstance(v, list) else (v,)) if x is not None)
        if not rest:
            return
    # A collection, if the element is keyed and no name in it is a field of the members.
    if fields is not None and not fields & rest.keys() and all(v is None or isinstance(v, dict) for v in rest.values()):
        yield from ((k, v) for k, v in rest.items() if v is not None)
    else:
        yield None, rest


def _scalar(value) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def rows_of(record: dict, key: str, plan: Plan) -> Iterator[tuple]:
    """The rows of a record: (element, row_key, parent_element, parent_key, item_key, ord, ids, fields); with a target those at and below it."""
    stack = [(record, ROOT, key, None, None, None, 0, {}, plan.target is None)]
    while stack:
        node, element, key, parent, parent_key, item_key, place, ids, there = stack.pop()
        there = there or element == plan.target
        fields: dict[str, str] = {}
        below: list[tuple] = []
        inline = [(node, "")] if isinstance(node, dict) else []
        if not inline:
            fields["value"] = _scalar(node)
        while inline:
            now, path = inline.pop()
            for name, value in now.items():
                if not there and name not in plan.towards and name != "id":
                    continue
                value = decoded(value)
                if value is None:
                    continue
                if is_data(name):
                    below += [(element, v, name) for v in (flat(value) if isinstance(value, list) else (value,)) if v is not None]
                elif name in plan.tables:
                    below += [(name, v, k) for k, v in members(value, name, plan)]
                else:
                    for i, v in enumerate(map(decoded, flat(value)) if isinstance(value, list) else (value,)):
                        at = f"{path}{name}[{i}]" if i else f"{path}{name}"
                        if isinstance(v, dict):
                            inline.append((v, f"{at}."))
                        elif v is not None:
                            fields[at] = _scalar(v)
        own = fields["id"] if fields.get("id", "").strip() else item_key
        ids = ids if own is None else {**ids, element: own}
        if there:
            yield element, key, parent, parent_key, item_key, place, list(ids.items()), list(fields.items())
        counts: dict[str, int] = {}
        for child, value, name in below:
            n = counts[child] = counts.get(child, -1) + 1
            stack.append((value, child, f"{key}/{child}.{n}", element, key, name, n, ids, there))


_NAMES = ["export_id", "filing_id", "element", "row_key", "parent_element", "parent_key", "item_key", "ord", "ids", "fields"]
_SHRED = "export_id bigint, filing_id string, element string, row_key string, parent_element string, parent_key string, item_key string, ord int, ids map<string,string>, fields map<string,string>"


def shred(exports: DataFrame, plan: Plan) -> DataFrame:
    """One row per object or value of an element that has a table of its own.

    ``row_key`` is unique within ``export_id``; ``parent_element`` and ``parent_key`` are
    the foreign key; ``item_key`` is the data key of a keyed collection, ``ord`` the place
    among siblings; ``ids`` has by element the natural ids (own ``id``, else data key) of the
    row and of those above it, ``fields`` the inlined values under dotted paths. Nothing in a
    payload is left out but nulls. Null, blank and cut-off payloads, and those nested deeper
    than the JSON parser goes, give no row. A plan with a target gives the rows at and below
    it only.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.map_(pa.string(), pa.string())
        kinds = [pa.int64(), pa.string(), *[pa.string()] * 5, pa.int32(), texts, texts]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = [
                    (export, filing, *row)
                    for export, filing, text in zip(*(part[c].to_pylist() for c in ("export_id", "filing_id", "payload")))
                    for i, record in enumerate(records(text))
                    for row in rows_of(record, f"r{i}", plan)
                ]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_NAMES)

    return exports.select("export_id", "filing_id", "payload").mapInArrow(scan, _SHRED)


def planned(exports: DataFrame, target: str | None = None) -> Plan:
    """The plan of the tables of all payloads, which are scanned once for it."""
    return plan_tables(durable(element_graph(exports)), target)


def flatten(exports: DataFrame) -> dict[str, DataFrame]:
    """A flat table for every element that the plan gives one, by the element's name.

    Columns as of ``shred`` without ``element``. Repeated objects are kept, told apart by
    their keys.
    """
    plan = planned(exports)
    rows = shred(exports, plan)
    return {name: rows.where(F.col("element") == name).drop("element") for name in sorted(plan.tables)}


def columns_of(rows: DataFrame) -> DataFrame:
    """(element, path, n_rows): which inlined columns each table has and how many rows fill them."""
    paths = rows.select("element", F.explode(F.map_keys("fields")).alias("path"))
    return paths.groupBy("element", "path").agg(F.count("*").alias("n_rows"))


def field_of(name: str) -> Column:
    """The inlined field of that name, at whatever depth it was inlined; null if there is none."""
    ends = lambda k, _: (k == name) | k.endswith(f".{name}")
    return F.get(F.map_values(F.map_filter("fields", ends)), F.lit(0))


def table_of(exports: DataFrame, element: str) -> DataFrame:
    """The rows of one element, none if it has no table."""
    return shred(exports, planned(exports, element)).where(F.col("element") == element)


def context_dimensions(exports: DataFrame) -> DataFrame:
    """Distinct (export_id, context_id, dimension, member) of all complete payloads.

    Read from the tables at and below ``contexts``: a row that is named by a dimension and
    holds its member, or whose fields name both.
    """
    rows = shred(exports, planned(exports, "contexts")).withColumn("context_id", F.try_element_at("ids", F.lit("contexts")))
    named = F.when(F.col("item_key").isNotNull() & (F.col("element") != "contexts"), F.struct(F.col("item_key").alias("dimension"), F.try_element_at("fields", F.lit("value")).alias("member")))
    keys = F.filter(F.map_keys("fields"), lambda k: (k == "dimension") | k.endswith(".dimension"))
    of = lambda k, name: F.try_element_at("fields", F.concat(F.left(k, F.length(k) - len("dimension")), F.lit(name)))
    told = F.transform(keys, lambda k: F.struct(of(k, "dimension").alias("dimension"), F.coalesce(of(k, "member"), of(k, "value")).alias("member")))
    pairs = rows.where("context_id is not null").select("export_id", "context_id", F.inline(F.when(F.size(told) > 0, told).otherwise(F.array(named))))
    return pairs.where("dimension is not null and member is not null").distinct()

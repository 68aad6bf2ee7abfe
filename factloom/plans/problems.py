"""Queries of the general data-preparation operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import nested, units, wide
from factloom.session import table


def p1_normalised(spark: SparkSession, d: str) -> DataFrame:
    return units.normalise_facts(table(spark, d, "facts"), table(spark, d, "units"), table(spark, d, "concepts"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return units.restatements(table(spark, d, "facts"), table(spark, d, "units"), table(spark, d, "concepts"))


def p5_wide(spark: SparkSession, d: str) -> DataFrame:
    return wide.widen(table(spark, d, "facts"), table(spark, d, "concepts")).drop("misfits")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return wide.misfit_cells(wide.widen(table(spark, d, "facts"), table(spark, d, "concepts")))


_KEYS = ["export_id", "filing_id", "row_key", "parent_element", "parent_key", "ord"]


def _rows(spark: SparkSession, d: str, element: str) -> DataFrame:
    return nested.table_of(table(spark, d, "structure_exports"), element)


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    """One row per record, with what its metadata say, be they inlined or a table of their own."""
    exports = table(spark, d, "structure_exports")
    rows = nested.shred(exports, nested.planned(exports)).where(F.col("element").isin(nested.ROOT, "metadata"))
    count = lambda c: F.max(nested.field_of(c).try_cast("bigint")).alias(c)
    return rows.groupBy("export_id", "filing_id", F.split_part("row_key", F.lit("/"), F.lit(1)).alias("row_key")).agg(count("num_facts"), count("num_contexts"))


def p6_contexts(spark: SparkSession, d: str) -> DataFrame:
    of = nested.field_of
    return _rows(spark, d, "contexts").select(
        *_KEYS, F.try_element_at("ids", F.lit("contexts")).alias("context_id"), of("identifier.scheme").alias("scheme"), of("identifier.value").alias("identifier"),
        of("period.instant").alias("instant"), of("period.startDate").alias("start_date"), of("period.endDate").alias("end_date"),
    )


def p6_dimensions(spark: SparkSession, d: str) -> DataFrame:
    return nested.context_dimensions(table(spark, d, "structure_exports"))


def p6_facts(spark: SparkSession, d: str) -> DataFrame:
    columns = {c: c.lower() for c in ("name", "contextRef", "unitRef", "value", "decimals", "scale", "tag_name")}
    return _rows(spark, d, "facts").select(*_KEYS, *[F.try_element_at("fields", F.lit(c)).alias(n) for c, n in columns.items()])


def p6_footnotes(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "footnotes").select(*_KEYS, *[nested.field_of(c).alias(n) for c, n in (("id", "footnote_id"), ("lang", "lang"), ("text", "text"))])


def p6_units(spark: SparkSession, d: str) -> DataFrame:
    measure = F.coalesce(nested.field_of("measure"), nested.field_of("value"))
    return _rows(spark, d, "units").select(*_KEYS, F.try_element_at("ids", F.lit("units")).alias("unit_id"), measure.alias("measure"))


def p6_columns(spark: SparkSession, d: str) -> DataFrame:
    exports = table(spark, d, "structure_exports")
    return nested.columns_of(nested.shred(exports, nested.planned(exports)))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.context_dimensions(table(spark, d, "structure_exports"))


QUERIES = {f.__name__: f for f in (
    p1_found, p1_normalised, p5_found, p5_wide, p6_found, p6_records, p6_contexts, p6_dimensions, p6_facts, p6_footnotes, p6_units, p6_columns,
)}

_DECODED = "case when json_type({j}) = 'VARCHAR' then case when json_valid(ltrim({j} ->> '$', chr(65279) || ' ' || chr(9) || chr(10) || chr(13))) then ltrim({j} ->> '$', chr(65279) || ' ' || chr(9) || chr(10) || chr(13))::json end else {j} end"
_ITEMS = "unnest(case json_type({j}) when 'ARRAY' then json_extract({j}, '$[*]') when 'OBJECT' then [{j}] end)"
# The shapes that the table holds, read one by one; a payload is encoded at most four times there.
P6_FOUND = f"""
with p as (select export_id, ltrim(payload, chr(65279) || ' ' || chr(9) || chr(10) || chr(13)) as t from structure_exports where payload is not null),
a as (select export_id, case when json_valid(t) then t::json end as j from p),
b as (select export_id, {_DECODED.replace('{j}', 'j')} as j from a), c as (select export_id, {_DECODED.replace('{j}', 'j')} as j from b), d as (select export_id, {_DECODED.replace('{j}', 'j')} as j from c),
r as (select export_id, {_ITEMS.replace('{j}', 'j')} as j from d), s as (select export_id, {_DECODED.replace('{j}', 'j')} as j from r),
e as (select export_id, case when json_type(j -> 'export') = 'OBJECT' then j -> 'export' else j end -> 'contexts' as c from s),
k as (select export_id, unnest(json_keys(c)) as key, c from e where json_type(c) = 'OBJECT'),
x as (select export_id, key, json_extract(c, '$."' || key || '"') as x from k union all select export_id, null, unnest(json_extract(c, '$[*]')) from e where json_type(c) = 'ARRAY'),
i as (select export_id, case when trim(coalesce(x ->> 'id', '')) <> '' then x ->> 'id' else key end as context_id, x -> 'entity' as e from x),
g as (select export_id, context_id, {_ITEMS.replace('{j}', 'e')} -> 'segment' as s from i where context_id is not null),
h as (select export_id, context_id, {_ITEMS.replace('{j}', 's')} as s from g),
m as (select export_id, context_id, {_ITEMS.replace('{j}', "(s -> 'explicitMember')")} as m from h where json_exists(s, '$.explicitMember')
  union all select export_id, context_id, s from h where json_exists(s, '$.dimension')),
q as (select export_id, context_id, unnest(json_keys(s)) as dimension, s from h where not json_exists(s, '$.explicitMember') and not json_exists(s, '$.dimension')),
o as (select export_id, context_id, m ->> 'dimension' as dimension, coalesce(m ->> 'member', m ->> 'value') as member from m
  union all select export_id, context_id, dimension, json_extract_string(s, '$."' || dimension || '"') from q)
select distinct * from o where dimension is not null and member is not null"""

ORACLES: dict[str, str] = {"p6_found": P6_FOUND, "p6_dimensions": P6_FOUND}

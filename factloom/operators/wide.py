"""Attribute-value rows reshaped into one typed row per entity.

Rows are first reduced to one row per cell with map-side combining, so that an entity
with any number of repeats has at most as many rows as there are attributes. The cells,
sorted by entity, are then streamed through Arrow: attributes become column indices and
each column is built as a typed buffer with a validity mask.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.let import let
from factloom.functions.numbers import read_figure
from factloom.operators.units import concept_names
from factloom.session import small

#: Columns of one table in ``widen_parts``.
PART_COLUMNS = 1000

# Item types and the column type they come out in; all others are numeric.
TEXT_TYPES = ("string", "normalizedString", "token", "textBlock", "escaped", "anyURI", "QName", "domain")
SQL_TYPES = {"date": "date", "boolean": "boolean", "gMonthDay": "string", "integer": "decimal(38,0)"} | dict.fromkeys(TEXT_TYPES, "string")
# Month names by number.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
# Written truth values.
TRUE_WORDS, FALSE_WORDS = ("true", "yes", "1", "☒", "☑", "✓", "✔", "[x]"), ("false", "no", "0", "☐", "[ ]")


def sql_type(item_type: str | None) -> str:
    """The SQL type of a column whose concept has this item type."""
    return SQL_TYPES.get(item_type or "", "double")


def read_date(value: Column) -> Column:
    """A written date that exists, else null: ISO, compact, slashes with the year first or the month first (the day first where only that exists), or month names."""
    text = F.trim(value)
    named = F.regexp_replace(text, r"^([A-Za-z]+)\.? +(\d{1,2})(?:st|nd|rd|th)?,? +(\d{4})$", "$3~$1~$2")

    def spelled(parts: Column) -> Column:
        name = F.lower(parts[1])
        full = F.array_position(F.array(*map(F.lit, MONTHS)), name)
        short = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), name)
        month = F.when(full > 0, full).when(short > 0, short)
        dash = F.lit("-")
        return F.concat(parts[0], dash, F.lpad(month.cast("string"), 2, "0"), dash, F.lpad(parts[2], 2, "0"))

    iso = (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text)
        .when(text.rlike(r"^\d{8}$"), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"))
        .when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.translate(text, "/", "-"))
        .when(text.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$"), F.regexp_replace(text, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$", "$3-$1-$2"))
        .when(F.contains(named, F.lit("~")), let(F.split(named, "~"), spelled))
    )
    day_first = F.when(text.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$"), F.regexp_replace(text, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$", "$3-$2-$1"))
    return F.coalesce(iso.try_cast("date"), day_first.try_cast("date"))


def read_month_day(value: Column) -> Column:
    """A day of the year as ``--MM-DD`` if it exists in some year, else null."""
    text = F.lower(F.trim(value))
    name = F.regexp_extract(text, r"^([a-z]+)\.? +\d{1,2}$", 1)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), name)
    digits = F.regexp_extract(text, r"^(?:--)?(\d{2})-(\d{2})$", 1)
    mm = F.when(month > 0, F.lpad(month.cast("string"), 2, "0")).when(digits != "", digits)
    dd = F.lpad(F.regexp_extract(text, r"(\d{1,2})$", 1), 2, "0")
    # 2024 is a leap year: every day that exists in some year exists in it.
    return F.when(F.concat_ws("-", F.lit("2024"), mm, dd).try_cast("date").isNotNull() & mm.isNotNull(), F.concat(F.lit("--"), mm, F.lit("-"), dd))


def read_boolean(value: Column) -> Column:
    """A written truth value, else null."""
    text = F.lower(F.trim(value))
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)


def attributes(concepts: DataFrame) -> list[tuple[str, str | None]]:
    """(name, item type) of every column, by name: read by the driver, because they are the schema."""
    listed = concept_names(concepts).select("concept", "type").distinct().collect()
    return sorted({r["concept"]: r["type"] for r in sorted(listed, key=str)}.items())


def _cells(facts: DataFrame, names: DataFrame) -> DataFrame:
    """One row per filing, context and ``cell`` of ``names`` (key, cell, type): ``num, whole, day, flag, txt, n_rows``."""
    f = facts.where("filing_id is not null and contextref is not null").select("fact_id", "filing_id", "contextref", "pos", "value", F.col("name").alias("key"))
    f = f.join(small(names), "key")
    kind = F.col("type")
    filled = F.length(F.regexp_replace("value", r"[\s\u00a0\u3000]+", "")) > 0
    is_text = kind.isin(*TEXT_TYPES)
    numeric = ~(is_text | kind.isin("date", "boolean", "gMonthDay"))
    f = f.withColumn("read", F.when(numeric & filled, read_figure(F.col("value"))))
    amount = F.col("read.figure") * F.pow(F.lit(10.0), F.col("read.exponent"))
    fitted = F.struct(
        F.when(numeric & (kind != "integer"), amount).alias("num"),
        F.when((kind == "integer") & (F.abs(amount - F.round(amount)) <= 1e-9 * F.greatest(F.abs(amount), F.lit(1.0))), F.round(amount)).try_cast("decimal(38,0)").alias("whole"),
        F.when(kind == "date", read_date(F.col("value"))).alias("day"),
        F.when(kind == "boolean", read_boolean(F.col("value"))).alias("flag"),
        F.when(is_text & filled, F.col("value")).when(kind == "gMonthDay", read_month_day(F.col("value"))).alias("txt"),
    )
    f = f.withColumn("fit", fitted)
    fits = F.lit(False)
    for c in ("num", "whole", "day", "flag", "txt"):
        fits = fits | F.col(f"fit.{c}").isNotNull()
    ranked = F.struct(F.coalesce("pos", F.lit(2**62)).alias("pos"), "fact_id")
    best = F.min_by(F.when(fits, F.col("fit")), F.when(fits, ranked)).alias("fit")
    return f.groupBy("filing_id", "contextref", "cell").agg(best, F.count("*").alias("n_rows")).select("filing_id", "contextref", "cell", "fit.*", "n_rows")


def typed_cells(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """One row per filing, context and concept with the typed value of the cell.

    ``filing_id, contextref, name, num, whole, day, flag, txt, n_rows``: one of the five is
    filled, none for a cell whose rows hold no value that fits. Of several values that fit
    the first in document order (pos, then fact_id) is taken. Names outside ``concepts``
    and rows without filing or context are left out.
    """
    return _cells(facts, concept_names(concepts).withColumnRenamed("concept", "cell")).withColumnRenamed("cell", "name")


def entity_starts(table: pa.Table) -> np.ndarray:
    """Where the filing or the context differs from that of the row before."""
    new = np.ones(table.num_rows, dtype=bool)
    for c in ("filing_id", "contextref"):
        column = table[c].combine_chunks()
        differs = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = differs if c == "filing_id" else new[1:] | differs
    return new


def _builders(names: list[str], types: list[str]):
    """The stream function for a fixed column list."""
    arrow = {"double": pa.float64(), "decimal(38,0)": pa.decimal128(38, 0), "date": pa.date32(), "boolean": pa.bool_(), "string": pa.string()}
    source = {"double": "num", "decimal(38,0)": "whole", "date": "day", "boolean": "flag", "string": "txt"}

    def build(table: pa.Table) -> pa.RecordBatch:
        new = entity_starts(table)
        first = np.flatnonzero(new)
        row = np.cumsum(new) - 1
        column = table["cell"].to_numpy()
        order = np.argsort(column, kind="stable")
        edges = np.searchsorted(column[order], np.arange(len(names) + 1))
        out = [table["filing_id"].take(pa.array(first)), table["contextref"].take(pa.array(first))]
        entities = len(first)
        for i, kind in enumerate(types):
            cells = order[edges[i] : edges[i + 1]]
            # The typed buffer of the column: the cell's position per entity, masked where there is none.
            at, mask = np.zeros(entities, dtype=np.int64), np.ones(entities, dtype=bool)
            at[row[cells]], mask[row[cells]] = cells, False
            out.append(table[source[kind]].combine_chunks().take(pa.array(at, mask=mask)).cast(arrow[kind]))
        empty = ~np.asarray(table["fits"].to_numpy(zero_copy_only=False), dtype=bool)
        counts = np.bincount(row[empty], minlength=entities)
        misfits = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(np.array(names, dtype=object)[column[empty]], pa.string()))
        arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in [*out, misfits]]
        return pa.RecordBatch.from_arrays(arrays, names=["filing_id", "contextref", *names, "misfits"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None and held.num_rows else table
            if not table.num_rows:
                continue
            # The last entity may go on in the next batch; it has at most one row per column.
            table = table.combine_chunks()
            cut = int(np.flatnonzero(entity_starts(table))[-1])
            if cut:
                yield build(table.slice(0, cut).combine_chunks())
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield build(held.combine_chunks())

    return stream


def widen(facts: DataFrame, concepts: DataFrame, listed: list[tuple[str, str | None]] | None = None) -> DataFrame:
    """One row per filing and context, one typed column per concept, and ``misfits``.

    ``misfits`` lists the concepts for which the entity has rows but none whose value
    fits the column's type. Column names are the concepts' names, in their order;
    monetary and other quantities are doubles, whole numbers ``decimal(38,0)``. Empty
    inputs give an empty table of the same schema. ``listed`` restricts the columns to some
    of ``attributes``; an entity without rows for any of them gives no row.
    """
    listed = attributes(concepts) if listed is None else listed
    names, types = [n for n, _ in listed], [sql_type(t) for _, t in listed]
    ddl = "filing_id string, contextref string, " + "".join(f"`{n.replace('`', '``')}` {t}, " for n, t in zip(names, types)) + "misfits array<string>"
    if not names:
        return facts.limit(0).select("filing_id", "contextref", F.lit(None).cast("array<string>").alias("misfits"))
    # Attributes are numbered in the join that finds them: cells are shuffled with their number only.
    numbers = facts.sparkSession.createDataFrame(list(enumerate(names)), "cell int, concept string")
    cells = _cells(facts, concept_names(concepts).join(F.broadcast(numbers), "concept").drop("concept"))
    fits = F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in ("num", "whole", "day", "flag", "txt")], F.lit(False))
    laid = cells.select("filing_id", "contextref", "cell", "num", "whole", "day", "flag", "txt", fits.alias("fits"))
    laid = laid.repartition("filing_id", "contextref").sortWithinPartitions("filing_id", "contextref", "cell")
    return laid.mapInArrow(_builders(names, types), ddl)


def widen_parts(facts: DataFrame, concepts: DataFrame, width: int = PART_COLUMNS) -> list[DataFrame]:
    """The wide table as several of at most ``width`` columns each, for attribute lists too long for one schema; their keys are the same."""
    listed = attributes(concepts)
    return [widen(facts, concepts, listed[at : at + width]) for at in range(0, len(listed), width)] or [widen(facts, concepts)]


def misfit_cells(wide: DataFrame) -> DataFrame:
    """(filing_id, contextref, name): the cells of a wide table that have rows but no value that fits."""
    return wide.select("filing_id", "contextref", F.explode("misfits").alias("name"))

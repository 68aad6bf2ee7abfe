"""Numbering and carrying forward within keys of any size.

A window by key puts a whole key into one task. Here rows are spread by ranges of key and
order, each range is scanned once, and what ranges have to know of the ones before - how
many rows a key had, which value it had last - is added afterwards. Only keys that span
several ranges need that, and there are fewer of them than ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.session import durable, small

_PART, _LOCAL, _BEFORE = "__part", "__local", "__before"


def _ranged(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The rows in ranges of key and order, sorted, through durable storage: later passes must see the same ranges."""
    laid = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return durable(laid.withColumn(_PART, F.spark_partition_id()))


def _new_key(batch: pa.RecordBatch, keys: list[str], last: tuple | None) -> np.ndarray:
    """Where a row's key differs from that of the row before; nulls are equal."""
    new = np.zeros(batch.num_rows, dtype=bool)
    for k in keys:
        column = batch[k]
        same = pc.fill_null(pc.equal(column[1:], column[:-1]), False)
        both = pc.and_(pc.is_null(column[1:]), pc.is_null(column[:-1]))
        new[1:] |= ~np.asarray(pc.or_(same, both).to_numpy(zero_copy_only=False), dtype=bool)
    new[0] = last is None or tuple(batch[k][0].as_py() for k in keys) != last
    return new


def _spanning(local: DataFrame, keys: list[str], summary) -> DataFrame:
    """``keys, __part, __sum`` of the keys that lie in more than one range."""
    per = local.groupBy(*keys, _PART).agg(summary.alias("__sum"))
    parts = F.count("*").over(Window.partitionBy(*keys))
    return per.withColumn("__n", parts).where("__n > 1").drop("__n")


def _join_before(local: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    named = before.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(_PART).alias("__p"), _BEFORE)
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return local.join(small(named), [F.col(_PART) == F.col("__p"), *same], "left").drop(*[f"__k_{k}" for k in keys], "__p")


def numbered(df: DataFrame, keys: list[str], order: list, name: str = "rn") -> DataFrame:
    """``df`` with the row number within ``keys`` by ``order``, from 1. Null keys are one key; the order should be total."""
    ranged = _ranged(df, keys, order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields) + f", {_LOCAL} bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _new_key(batch, keys, last)
            at = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(new, at, -1))
            local = np.where(start >= 0, at - start + 1, at + 1 + count)
            last, count = tuple(batch[k][-1].as_py() for k in keys), int(local[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], names=[*batch.schema.names, _LOCAL])

    local = ranged.mapInArrow(run, schema)
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = _spanning(local, keys, F.max(_LOCAL)).withColumn(_BEFORE, F.sum("__sum").over(earlier))
    out = _join_before(local, before, keys)
    return out.withColumn(name, F.col(_LOCAL) + F.coalesce(_BEFORE, F.lit(0))).drop(_PART, _LOCAL, _BEFORE)


def carried(df: DataFrame, keys: list[str], order: list, column: str, name: str) -> DataFrame:
    """``df`` with the last value of ``column`` that is not null, up to each row, within ``keys`` by ``order``."""
    ranged = _ranged(df, keys, order)
    kind = ranged.schema[column].dataType.simpleString()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields) + f", {_LOCAL} {kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _new_key(batch, keys, last)
            at = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(new, at, -1))
            filled = np.asarray(pc.is_valid(batch[column]).to_numpy(zero_copy_only=False), dtype=bool)
            source = np.maximum.accumulate(np.where(filled, at, -1))
            within = source >= np.maximum(start, 0)
            values = batch[column].take(pa.array(np.where(within, source, 0), mask=~within))
            if held is not None and start[0] < 0:
                until = int(np.argmax((start >= 0) | within)) if ((start >= 0) | within).any() else batch.num_rows
                values = pa.concat_arrays([pa.array([held] * until, values.type), values[until:]])
            last, held = tuple(batch[k][-1].as_py() for k in keys), values[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, _LOCAL])

    local = ranged.mapInArrow(run, schema)
    # Rows of a range are in order and the carried value of its last row is that of the whole range.
    rank = F.struct(*[c if not isinstance(c, str) else F.col(c) for c in order])
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = _spanning(local, keys, F.max_by(_LOCAL, rank)).withColumn(_BEFORE, F.last("__sum", ignorenulls=True).over(earlier))
    out = _join_before(local, before, keys)
    return out.withColumn(name, F.coalesce(_LOCAL, _BEFORE)).drop(_PART, _LOCAL, _BEFORE)

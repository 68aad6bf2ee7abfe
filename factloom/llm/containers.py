"""Items of varying length put into containers of fixed capacity by sum-of-squares packing.

For every gap (room left in an open container) the packer counts the containers that have
it. An item goes where the sum of the squares of these counts becomes smallest, which
keeps gaps varied and so likely to be filled. Items are spread evenly over shards by the
hash of their id; a shard is packed on its own, longest items first and once at random, in
memory bounded by the shard's token count; its few open containers are all it wastes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.tokens import VOCABULARY, with_tokens
from factloom.session import durable

CAPACITY = 2048
#: Containers that a shard should fill.
SHARD_CONTAINERS = 4096


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, numbered from 0; sizes are from 1 to ``capacity``, packed in the given order."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    made = 0
    for n, size in enumerate(sizes.tolist()):
        if size == capacity:
            out[n], made = made, made + 1
            continue
        there = counts[size:capacity]
        # What the sum changes by if the item goes into a container with gap size, size + 1, ...
        change = 2 * (counts[: capacity - size] - there) + 2
        change[0] = -2 * there[0] + 1  # the container is full then and leaves the count
        change[there == 0] = 1 << 60
        i = int(change.argmin())
        if change[i] <= 2 * counts[capacity - size] + 1:
            gap = size + i
            box = open_at[gap].pop()
            counts[gap] -= 1
        else:
            box, made, gap = made, made + 1, capacity
        left = gap - size
        if left:
            open_at[left].append(box)
            counts[left] += 1
        out[n] = box
    return out


def best_packing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, packed once in the given order and once in a fixed random one; the fuller packing is kept."""
    given = sum_of_squares(sizes, capacity)
    order = np.random.default_rng(len(sizes)).permutation(len(sizes))
    mixed = np.empty_like(given)
    mixed[order] = sum_of_squares(sizes[order], capacity)
    return mixed if mixed.max(initial=-1) < given.max(initial=-1) else given


def pack(items: DataFrame, capacity: int = CAPACITY, shard_containers: int = SHARD_CONTAINERS) -> DataFrame:
    """Containers for items given as ``doc_id, n_tokens``.

    Returns ``doc_id, piece, token_start, n_tokens, container_id``: an item over the
    capacity is split into full pieces and a rest, every other one is piece 0. Items of
    null or no length take no room and give no row. No container holds more than the
    capacity. Repeated ids are packed as often as they come.
    """
    items = durable(items.where("n_tokens > 0").select("doc_id", F.col("n_tokens").cast("bigint")))
    total = items.agg(F.sum("n_tokens").alias("t")).collect()[0]["t"] or 0
    shards = max(1, math.ceil(total / (capacity * shard_containers)))
    piece = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_tokens - 1) div {capacity}")))
    pieces = items.withColumn("piece", piece)
    size = F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece") * capacity)
    pieces = pieces.select("doc_id", F.col("piece").cast("int"), (F.col("piece") * capacity).alias("token_start"), size.alias("n_tokens"))
    shard = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).alias("shard")
    partitions = min(shards, 10_000)
    laid = pieces.withColumn("shard", shard).repartition(partitions, "shard").sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            at = table["shard"].to_numpy()
            for lo, hi in zip(edges := np.append(0, np.flatnonzero(np.diff(at)) + 1), [*edges[1:], len(at)]):
                part = table.slice(lo, hi - lo).combine_chunks()
                boxes = best_packing(part["n_tokens"].to_numpy(), capacity)
                names = pa.array(at[lo] * (1 << 32) + boxes, pa.int64())
                yield from part.drop_columns(["shard"]).append_column("container_id", names).to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None and held.num_rows else table
            if not table.num_rows:
                continue
            at = table["shard"].to_numpy()
            cut = int(np.searchsorted(at, at[-1], side="left")) if at[0] != at[-1] else 0
            if cut:
                yield from done(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield from done(held)

    kind = dict(items.dtypes)["doc_id"]
    return laid.mapInArrow(run, f"doc_id {kind}, piece int, token_start bigint, n_tokens bigint, container_id bigint")


def pack_documents(documents: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """``pack`` for texts, measured in tokens of a public tokenizer; null and empty texts give no row."""
    return pack(with_tokens(documents, "text", ["doc_id"], vocabulary), capacity)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, items, pieces of split items, tokens and the share of room used."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("pieces"))
    return per.agg(
        F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"),
        (F.sum("used") / (F.count("*") * capacity)).alias("fill"),
    )

"""Evidence about fiscal patterns, folded in order into a value and a confidence.

The fold depends on the order of the signals. It runs over sorted partitions with a state
per key that holds counts only, so a key with any number of signals takes constant memory;
the same step serves the batch operator and the stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.periods import MONTH_NAMES, QUARTER_WORDS

#: A quarter's end in words, the month in the group; and a mention of which quarter it is.
DATED_QUARTER = r"(?i)(?:for the|for our|quarterly|quarter ended) ([a-z]+)\s+\d{1,2}(?:st|nd|rd|th)?,?\s+\d{4}"
NAMED_QUARTER = r"(?i)((?:quarterly report|form 10-q)[^\n]*?(?:quarterly|quarter|three months)[^\n]*?(?:first|second|third|fourth|1st|2nd|3rd|4th|\sQ1|\sQ2|\sQ3|\sQ4))"
#: Share of the most common value from which consensus raises the confidence, and by how much.
CONSENSUS, BOOST = 0.7, 1.2


class Evidence:
    """The state of one key: value, confidence, and how often each value was signalled."""

    __slots__ = ("value", "confidence", "total", "n", "counts")

    def __init__(self, value=None, confidence=0.0, total=0.0, n=0, counts=None):
        self.value, self.confidence, self.total, self.n, self.counts = value, confidence, total, n, counts or {}

    def add(self, value: str, confidence: float) -> None:
        """One signal: a more confident one replaces the value; else the mean confidence and a consensus count."""
        self.n += 1
        self.total += confidence
        self.counts[value] = self.counts.get(value, 0) + 1
        if confidence > self.confidence:
            self.value, self.confidence = value, confidence
            return
        self.confidence = max(self.confidence, self.total / self.n)
        common = max(self.counts, key=lambda v: self.counts[v])  # the one signalled first wins a tie
        if self.n >= 2 and self.counts[common] > CONSENSUS * self.n:
            self.value, self.confidence = common, min(self.confidence * BOOST, 1.0)


OUT_DDL = "key string, value string, confidence double, n bigint"


def fold(signals: DataFrame) -> DataFrame:
    """``key, value, confidence, n`` from signals ``key, ts, signal_id, value, confidence`` in order of (ts, signal_id).

    Signals without key or value are left out, a null confidence is 0.
    """
    s = signals.where("key is not null and value is not null").select("key", "ts", "signal_id", "value", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, v, c in zip(*(batch[x].to_pylist() for x in ("key", "value", "confidence"))):
                if k != key:
                    if state:
                        done.append((key, state.value, state.confidence, state.n))
                    key, state = k, Evidence()
                state.add(v, c)
            yield _batch(done)
        if state:
            yield _batch([(key, state.value, state.confidence, state.n)])

    return s.repartition("key").sortWithinPartitions("key", "ts", "signal_id").mapInArrow(run, OUT_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key", "value", "confidence", "n"])


def model_confidence(folded: DataFrame, group) -> DataFrame:
    """The mean confidence over the patterns of a group."""
    return folded.groupBy(group.alias("group")).agg(F.avg("confidence").alias("confidence"), F.count("*").alias("patterns"))


def filing_signals(filings: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Evidence rows of filings about their company's fiscal calendar.

    From annual reports (10-K) the month and the day of the period's end (0.8), and the
    month again (0.6) if the filing came 20 to 90 days later; from texts (filing_id,
    text_id, text) of quarterly reports (10-Q) the quarter they mention, for the month of the
    day beside it (0.7). Keys are ``ticker|kind``. Filings without a ticker or an end, and
    forms spelled otherwise, give no evidence.
    """
    base = filings.where("company_ticker is not null and period_end_date is not null").withColumn("form", F.trim("filing_type"))
    annual = base.where("form = '10-K'")
    row = lambda df, kind, value, conf, sid=F.col("filing_id"): df.select(F.concat_ws("|", "company_ticker", F.lit(kind)).alias("key"), F.col("filing_date").cast("timestamp").alias("ts"), sid.alias("signal_id"), value.alias("value"), F.lit(conf).alias("confidence"))
    month, day = F.month("period_end_date").cast("string"), F.dayofmonth("period_end_date").cast("string")
    out = row(annual, "fiscal_year_end_month", month, 0.8).unionByName(row(annual, "fiscal_year_end_day", day, 0.8))
    late = annual.where(F.datediff("filing_date", "period_end_date").between(20, 90))
    out = out.unionByName(row(late, "fiscal_year_end_month", month, 0.6, F.concat(F.col("filing_id"), F.lit("|lag"))))
    if texts is None:
        return out
    dated = F.regexp_extract("text", DATED_QUARTER, 1)
    told = texts.select("filing_id", "text_id", F.lower(F.substring(dated, 1, 3)).alias("name"), F.lower(F.regexp_extract("text", NAMED_QUARTER, 1)).alias("mention")).where("name <> '' and mention <> ''")
    named = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTH_NAMES.split("|")]), F.col("name")).cast("int")
    quarter = F.coalesce(*[F.when(F.col("mention").rlike(words), q) for q, words in QUARTER_WORDS.items()])
    told = base.where("form = '10-Q'").join(told, "filing_id")
    at = F.when(named > 0, named).otherwise(F.month("period_end_date"))
    return out.unionByName(row(told, "quarter_mapping", F.concat_ws(":", at.cast("string"), quarter), 0.7, F.concat_ws("|", "filing_id", F.col("text_id").cast("string"))))


def fold_stream(signals: DataFrame) -> DataFrame:
    """The fold on a stream of signals: one row per key and micro-batch with the state after it."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, frames, state):
        e = Evidence(*state.get[:4], dict(zip(state.get[4], state.get[5]))) if state.exists else Evidence()
        rows = pd.concat(list(frames)).sort_values(["ts", "signal_id"], kind="stable")
        for value, confidence in zip(rows["value"], rows["confidence"]):
            e.add(value, float(confidence))
        state.update((e.value, e.confidence, e.total, e.n, list(e.counts), list(e.counts.values())))
        yield pd.DataFrame({"key": [key[0]], "value": [e.value], "confidence": [e.confidence], "n": [e.n]})

    s = signals.where("key is not null and value is not null").select("key", "ts", "signal_id", "value", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    state = "value string, confidence double, total double, n bigint, names array<string>, counts array<bigint>"
    return s.groupBy("key").applyInPandasWithState(step, OUT_DDL, state, "update", GroupStateTimeout.NoTimeout)

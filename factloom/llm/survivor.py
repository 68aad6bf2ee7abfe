"""One surviving record per group of duplicate captures, by skyline selection.

Records of a group are compared on trust (rank of the capture channel), recency and
completeness (which fields are usable). A record dominates another if it is at least as
good in all three and better in one. The records that none dominates are the first layer,
those that only it dominates the second, and so on. Every field is taken from the first
layer in which it is usable, there by a lexicographic policy: trust, then recency.

Recency is the time of capture and, among captures of one time, the record id; so it is a
total order, and the best record that has a field is dominated only by better ones that
have it too: the layers give each field to the record that the policy puts first.

The group is never gathered whole. Of the records that agree in trust and in the set of
usable fields the latest dominates the others, which can supply nothing that it cannot. So
a combining aggregate leaves at most ``channels x 2^fields`` records per group whatever
the group's size, and the layers are peeled from those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.session import small

FIELDS = ("is_amended", "original_filing_type", "fiscal_year", "fiscal_period")
#: Fiscal years from the first to the last are usable.
YEARS = (2001, 2030)


def accession_key(written: Column, url: Column) -> Column:
    """The filing id ``NNNNNNNNNN-YY-NNNNNN`` from an accession number however written; from the url where it is null."""
    dashed = r"(\d{1,10})\D(\d{2})\D(\d{6})(?!\d)"
    plain = r"(?<!\d)(\d{10})(\d{2})(\d{6})(?!\d)"

    def read(text: Column) -> Column:
        d, p = F.regexp_extract(text, dashed, 1), F.regexp_extract(text, plain, 1)
        part = lambda pattern, n: F.regexp_extract(text, pattern, n)
        return F.when(d != "", F.concat_ws("-", F.lpad(d, 10, "0"), part(dashed, 2), part(dashed, 3))).when(
            p != "", F.concat_ws("-", p, part(plain, 2), part(plain, 3))
        )

    name = F.regexp_extract(url, r"([^/]*)$", 1)
    return F.coalesce(read(written), F.when(F.coalesce(F.trim(written), F.lit("")) == "", F.coalesce(read(name), read(url))))


def channel_key(channel: Column) -> Column:
    """A channel without regard to case, surrounding blanks and ``-`` or ``_``."""
    return F.translate(F.lower(F.trim(channel)), "-_ ", "")


def usable_form(value: Column) -> Column:
    """``10-K``, ``10-Q``, ``10-K/A`` or ``10-Q/A`` however spelled, else null."""
    bare = F.regexp_replace(F.upper(value), r"[\s.\-–—_]|FORM", "")
    form = F.regexp_extract(bare, r"^10(K|Q)(?:/?A|\(A\)|AMENDED)?$", 1)
    return F.when(form != "", F.concat(F.lit("10-"), form, F.when(bare.rlike(r"A"), "/A").otherwise("")))


def usable_year(value: Column) -> Column:
    """A year from 2001 to 2030 out of ``2023``, ``2023.0``, ``FY2023``, ``fiscal 2023`` and the like, else null."""
    digits = F.regexp_extract(F.lower(F.trim(value)), r"^(?:fy|fiscal(?: year)?|year)?[\s'\-]*(\d{4})(?:\.0*)?$", 1)
    year = digits.try_cast("int")
    return F.when(year.between(*YEARS), year)


# Words for the quarters and the full year, in capitals without blanks.
_QUARTERS = {"FIRST": "Q1", "SECOND": "Q2", "THIRD": "Q3", "FOURTH": "Q4"}
_FULL = ("ANNUAL", "FY", "FULLYEAR", "YEAR", "FULL", "12M", "A", "YEARLY", "FULLFISCALYEAR")


def usable_period(value: Column) -> Column:
    """``Q1`` to ``Q4`` or ``annual`` however spelled, else null (halves and year-to-date are no period here)."""
    bare = F.regexp_replace(F.upper(value), r"[\s.\-_/]", "")
    # A year beside the period is dropped; what is left must be the period alone.
    bare = F.regexp_replace(bare, r"(?:FY)?20\d{2}$|^(?:FY)?20\d{2}(?=.)", "")
    number = F.coalesce(
        F.nullif(F.regexp_extract(bare, r"^(?:Q|QTR|QUARTER)([1-4])$", 1), F.lit("")),
        F.nullif(F.regexp_extract(bare, r"^([1-4])(?:Q|QTR|QUARTER|STQUARTER|NDQUARTER|RDQUARTER|THQUARTER)$", 1), F.lit("")),
    )
    word = F.regexp_replace(bare, "QUARTER$", "")
    named = F.coalesce(*[F.when(word == w, q) for w, q in _QUARTERS.items()])
    return F.coalesce(F.concat(F.lit("Q"), number), named, F.when(F.upper(F.trim(value)).rlike(r"^\s*FY\s*(20\d{2})?\s*$") | bare.isin(*_FULL), "annual"))


def prepare(records: DataFrame, channels: DataFrame) -> DataFrame:
    """Records with ``filing_id``, ``trust`` and the usable value of each field (null where unusable)."""
    ranks = small(channels.groupBy(channel_key(F.col("channel")).alias("channel_key")).agg(F.min("trust_rank").alias("trust_rank")).where("channel_key is not null"))
    r = records.select(
        "record_id", "captured_at", channel_key(F.col("capture_channel")).alias("channel_key"),
        accession_key(F.col("accession_number"), F.col("documents_url")).alias("filing_id"),
        F.col("is_amended"), usable_form(F.col("original_filing_type")).alias("original_filing_type"),
        usable_year(F.col("fiscal_year")).alias("fiscal_year"), usable_period(F.col("fiscal_period")).alias("fiscal_period"),
    ).where("filing_id is not null")
    return r.join(ranks, "channel_key", "left").withColumn("trust", F.coalesce(F.col("trust_rank").cast("int"), F.lit(2**31 - 1)))


def _candidates(records: DataFrame, channels: DataFrame) -> DataFrame:
    """One row per filing: the number of records and the bounded array of possible winners."""
    r = prepare(records, channels)
    mask = sum((F.when(F.col(f).isNotNull(), 1 << i).otherwise(0) for i, f in enumerate(FIELDS)), F.lit(0))
    # A capture without a time is the earliest: nulls sort lowest in a struct.
    late = F.max(F.struct("captured_at", "record_id", *FIELDS)).alias("late")
    best = r.groupBy("filing_id", "trust", mask.alias("mask")).agg(late, F.count("*").alias("n"))
    one = F.struct((-F.col("trust")).alias("trust"), "late.captured_at", "late.record_id", "mask", *[F.col(f"late.{f}").alias(f) for f in FIELDS])
    return best.groupBy("filing_id").agg(F.sum("n").alias("n_records"), F.collect_list(one).alias("found"))


def _dominates(y: Column, x: Column) -> Column:
    """y is at least as good as x in trust, recency and completeness, and better in one."""
    late = lambda r: F.struct(r["captured_at"], r["record_id"])  # noqa: E731 - nulls are the least
    no_worse = (y["trust"] >= x["trust"]) & (late(y) >= late(x)) & (y["mask"].bitwiseOR(x["mask"]) == y["mask"])
    return no_worse & ((y["trust"] > x["trust"]) | (late(y) > late(x)) | (y["mask"] != x["mask"]))


def _layers(found: str) -> Column:
    """``array<struct<layer, record>>``: 1 if no record dominates it, else one more than the deepest layer that does.

    Sorted by trust, recency and fields no record comes before one that dominates it, so
    one pass over the sorted records has seen the layers of all that dominate the next.
    """
    placed = lambda x, layer: F.struct(layer.alias("layer"), x.alias("record"))

    def step(done: Column, x: Column) -> Column:
        above = F.transform(F.filter(done, lambda y: _dominates(y["record"], x)), lambda y: y["layer"])
        return F.concat(done, F.array(placed(x, F.coalesce(F.array_max(above), F.lit(0)) + 1)))

    start = F.transform(F.slice(found, 1, 0), lambda x: placed(x, F.lit(0)))
    return F.aggregate(F.sort_array(found, asc=False), start, step)


def _pick(bit: int, field: str) -> Column:
    """Of the first layer that has the field the record the policy puts first; null if the field is usable in none."""
    usable = F.filter("layers", lambda x: x["record"]["mask"].bitwiseAND(F.lit(1 << bit)) != 0)
    ranked = lambda x: F.struct((-x["layer"]).alias("layer"), *[x["record"][c].alias(c) for c in ("trust", "captured_at", "record_id")], x["record"][field].alias("value"))
    return F.array_max(F.transform(usable, ranked))


def survivors(records: DataFrame, channels: DataFrame) -> DataFrame:
    """One record per filing, each field from the best capture.

    ``filing_id, n_records, n_skyline`` (undominated records), ``n_layers`` (among the
    records that can supply anything), ``base_record`` (the policy's first of the skyline),
    the four fields, and for each ``<field>_record`` and ``<field>_layer``: the record that
    supplies it and its layer. A field usable in no record is null. Records whose accession
    number cannot be read, not even from the url, belong to no filing. Exact copies under
    a new record id are candidates like any other; the highest id wins a tie.
    """
    c = _candidates(records, channels).withColumn("layers", _layers("found"))
    c = c.withColumns({f"pick_{f}": _pick(i, f) for i, f in enumerate(FIELDS)})
    first = F.transform(F.filter("layers", lambda x: x["layer"] == 1), lambda x: x["record"])
    base = F.array_max(F.transform(first, lambda x: F.struct(x["trust"], x["captured_at"], x["record_id"])))["record_id"]
    out = ["filing_id", "n_records", F.size(first).alias("n_skyline"), F.array_max(F.transform("layers", lambda x: x["layer"])).alias("n_layers"), base.alias("base_record")]
    for f in FIELDS:
        pick = F.col(f"pick_{f}")
        out += [pick["value"].alias(f), pick["record_id"].alias(f"{f}_record"), (-pick["layer"]).alias(f"{f}_layer")]
    return c.select(*out)


def supplied_fields(surviving: DataFrame) -> DataFrame:
    """(filing_id, field_name, record_id) for filings with at least two records: which record supplies each field."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_record").alias("record_id")) for f in FIELDS])
    rows = surviving.where("n_records >= 2").select("filing_id", F.inline(pairs))
    return rows.where("record_id is not null")

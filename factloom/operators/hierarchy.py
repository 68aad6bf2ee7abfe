"""Concept hierarchies: roots, levels, trees with guarded depth, calculation sums, name patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions.text import local_name
from factloom.operators.facts import first_pairs
from factloom.session import durable

# Ends of parent names and the ends of their children's names.
PATTERNS = {
    "Assets": ["AssetsCurrent", "AssetsNoncurrent"],
    "AssetsCurrent": ["CashAndCashEquivalents", "ShortTermInvestments", "AccountsReceivable", "Inventory"],
    "AssetsNoncurrent": ["PropertyPlantAndEquipment", "Goodwill", "IntangibleAssets"],
    "Liabilities": ["LiabilitiesCurrent", "LiabilitiesNoncurrent"],
    "LiabilitiesCurrent": ["AccountsPayable", "AccruedLiabilities", "CustomerDeposits", "DeferredRevenue"],
    "LiabilitiesNoncurrent": ["LongTermDebt", "DeferredTaxLiabilities", "LeaseLiability"],
    "StockholdersEquity": ["CommonStock", "AdditionalPaidInCapital", "RetainedEarnings", "AccumulatedOtherComprehensiveIncome"],
    "Revenues": ["RevenueFromContractWithCustomer", "InterestIncome", "OtherIncome"],
    "CostsAndExpenses": ["CostOfGoodsAndServicesSold", "ResearchAndDevelopmentExpense", "SellingGeneralAndAdministrativeExpense"],
}


# Ends of parent names and of the names of their children, in any statement.
CHILD_PAIRS = [
    ("Assets", "AssetsCurrent"), ("Assets", "AssetsNoncurrent"), ("Assets", "CashAndCashEquivalents"), ("Assets", "Inventory"),
    ("Liabilities", "LiabilitiesCurrent"), ("Liabilities", "LiabilitiesNoncurrent"), ("Liabilities", "AccountsPayable"), ("Liabilities", "DeferredIncomeTaxLiabilities"),
    ("StockholdersEquity", "CommonStock"), ("StockholdersEquity", "RetainedEarnings"), ("StockholdersEquity", "AccumulatedOtherComprehensiveIncome"),
    ("Revenues", "RevenueFromContractWithCustomer"), ("CostsAndExpenses", "CostOfGoodsAndServicesSold"), ("CostsAndExpenses", "OperatingExpenses"),
    ("NetCashProvidedByUsedInOperatingActivities", "DepreciationAndAmortization"), ("NetCashProvidedByUsedInInvestingActivities", "PaymentsToAcquirePropertyPlantAndEquipment"),
]


def child_of(concepts: DataFrame) -> DataFrame:
    """(parent, child, statement): pairs of concepts of one statement where the parent's local name begins the child's, or both have the ends of a pair of the list.

    ``concepts`` has ``concept, statement``; those without a statement (null or Unknown) pair
    with nothing. Every prefix of a name, and every end it has, meets the names it may be by
    an equi-join, so no two names are compared that have nothing in common.
    """
    c = concepts.where("concept is not null and statement is not null and statement <> 'Unknown'").select("concept", "statement", local_name(F.col("concept")).alias("local")).distinct()
    prefix = F.transform(F.sequence(F.lit(1), F.greatest(F.length("local") - 1, F.lit(1))), lambda i: F.substring("local", F.lit(1), i))
    below = c.select(F.col("concept").alias("child"), "statement", F.col("local").alias("child_local"), F.explode(prefix).alias("local"))
    begun = below.where("local <> child_local").join(c.withColumnRenamed("concept", "parent"), ["statement", "local"]).select("parent", "child", "statement")
    ends = lambda side: F.array_compact(F.array(*[F.when(F.col("local").endswith(e), F.lit(e)) for e in sorted({pair[side] for pair in CHILD_PAIRS})]))
    pairs = F.broadcast(concepts.sparkSession.createDataFrame(CHILD_PAIRS, "parent_end string, child_end string"))
    parents = c.select(F.col("concept").alias("parent"), "statement", F.explode(ends(0)).alias("parent_end")).join(pairs, "parent_end")
    children = c.select(F.col("concept").alias("child"), "statement", F.explode(ends(1)).alias("child_end"))
    ended = parents.join(children, ["statement", "child_end"]).where("parent <> child").select("parent", "child", "statement")
    return begun.unionByName(ended).distinct()


def network(presentation: DataFrame, calculation: DataFrame, concepts: DataFrame) -> DataFrame:
    """(parent, child, ord, weight, source): the hierarchy of a set of documents.

    The arcs of presentation and calculation networks; only where there are neither, those
    that the name patterns give. Arcs without a role are left out.
    """
    stated = [a.where("role is not null and role <> ''").select("parent", "child", "ord", w.alias("weight"), F.lit(kind).alias("source"))
              for a, w, kind in ((presentation, F.lit(None).cast("double"), "presentation"), (calculation, F.coalesce("weight", F.lit(1.0)), "calculation"))]
    stated = stated[0].unionByName(stated[1])
    guessed = pattern_arcs(concepts.sparkSession, concepts).select("parent", "child", F.col("ord").cast("double").alias("ord"), F.lit(None).cast("double").alias("weight"), F.lit("patterns").alias("source"))
    none = stated.agg(F.count("*").alias("n")).where("n = 0").drop("n")
    return stated.unionByName(guessed.join(F.broadcast(none.select(F.lit(1).alias("one"))), how="left_semi"))


def pattern_arcs(spark: SparkSession, concepts: DataFrame) -> DataFrame:
    """(parent, child, ord) by name patterns over ``concept``.

    Every concept is first matched to the ends it has - a product with the fixed list of
    ends only - and parents meet children through equi-joins on the pattern.
    """
    rows = [(p, c, i, j) for i, (p, cs) in enumerate(PATTERNS.items()) for j, c in enumerate(cs)]
    patterns = F.broadcast(spark.createDataFrame(rows, "parent_end string, child_end string, p int, c int"))
    names = concepts.select("concept", local_name(F.col("concept")).alias("local")).where("local is not null").distinct()
    ends = sorted({r[0] for r in rows} | {r[1] for r in rows})
    has = F.array_compact(F.array(*[F.when(F.col("local").endswith(e), F.lit(e)) for e in ends]))
    keyed = names.select("concept", F.explode(has).alias("end"))
    parents = keyed.select(F.col("concept").alias("parent"), F.col("end").alias("parent_end")).join(patterns, "parent_end")
    children = keyed.select(F.col("concept").alias("child"), F.col("end").alias("child_end"))
    arcs = parents.join(children, "child_end").where("child <> parent")
    w = Window.partitionBy("parent").orderBy("p", "c", "child")
    return arcs.select("parent", "child", (F.row_number().over(w) - 1).alias("ord"))


def first_arcs(arcs: DataFrame, keys: tuple[str, ...] = ("parent", "child")) -> DataFrame:
    """The first arc of each (parent, child) in document order."""
    return first_pairs(arcs, list(keys), ["pos"])


def roots(arcs: DataFrame) -> DataFrame:
    """Parents that are nobody's child."""
    return arcs.select(F.col("parent").alias("concept")).distinct().join(arcs.select(F.col("child").alias("concept")).distinct(), "concept", "left_anti")


def levels(arcs: DataFrame, tops: DataFrame) -> DataFrame:
    """(concept, level): 0 for ``tops``, 1 for their children, 2 for their grandchildren, the least of several; others are absent."""
    t = tops.select(F.col("concept"), F.lit(0).alias("level"))
    one = arcs.join(t.select(F.col("concept").alias("parent")), "parent", "left_semi").select(F.col("child").alias("concept")).distinct()
    two = arcs.join(one.select(F.col("concept").alias("parent")), "parent", "left_semi").select(F.col("child").alias("concept")).distinct()
    found = t.unionByName(one.withColumn("level", F.lit(1))).unionByName(two.withColumn("level", F.lit(2)))
    return found.groupBy("concept").agg(F.min("level").alias("level"))


def tree(arcs: DataFrame, tops: DataFrame, max_depth: int = 3, max_children: int = 10) -> DataFrame:
    """The trees below ``tops`` as rows (root, concept, depth, path, path_key, is_cycle) in depth-first order of ``path_key``.

    The first ``max_children`` children by ``ord`` are followed, down to ``max_depth``; a
    concept that is its own ancestor is marked and not followed.
    """
    w = Window.partitionBy("parent").orderBy("ord", "child")
    kept = arcs.withColumn("n", F.row_number().over(w)).where(F.col("n") <= max_children).select("parent", "child", "n")
    level = tops.select(F.col("concept").alias("root"), "concept", F.lit(0).alias("depth"), F.array("concept").alias("path"), F.col("concept").alias("path_key"), F.lit(False).alias("is_cycle"))
    out = level
    for depth in range(1, max_depth + 1):
        step = level.where("not is_cycle").join(kept, F.col("concept") == F.col("parent"))
        level = step.select(
            "root", F.col("child").alias("concept"), F.lit(depth).alias("depth"), F.concat("path", F.array("child")).alias("path"),
            F.concat("path_key", F.lit("/"), F.lpad(F.col("n").cast("string"), 4, "0")).alias("path_key"), F.array_contains("path", F.col("child")).alias("is_cycle"),
        )
        out = out.unionByName(level)
    return out


def whole_tree(arcs: DataFrame, tops: DataFrame) -> DataFrame:
    """The whole trees below ``tops``: rows as of ``tree``, with all children and every depth.

    Levels are added until one has no rows; a concept that is its own ancestor is marked
    and not followed, so the depth is bounded by the number of concepts. Each level is
    checkpointed: the next one needs only that.
    """
    w = Window.partitionBy("parent").orderBy("ord", "child")
    kept = arcs.withColumn("n", F.row_number().over(w)).select("parent", "child", "n")
    level = tops.select(F.col("concept").alias("root"), "concept", F.lit(0).alias("depth"), F.array("concept").alias("path"), F.col("concept").alias("path_key"), F.lit(False).alias("is_cycle"))
    out, depth = level, 0
    while True:
        depth += 1
        step = level.where("not is_cycle").join(kept, F.col("concept") == F.col("parent"))
        level = durable(step.select(
            "root", F.col("child").alias("concept"), F.lit(depth).alias("depth"), F.concat("path", F.array("child")).alias("path"),
            F.concat("path_key", F.lit("/"), F.lpad(F.col("n").cast("string"), 10, "0")).alias("path_key"), F.array_contains("path", F.col("child")).alias("is_cycle"),
        ))
        if level.isEmpty():
            return out
        out = out.unionByName(level)


def equations(arcs: DataFrame) -> DataFrame:
    """(parent, equation) of weighted arcs, children by order."""
    term = F.concat(F.when(F.col("weight") < 0, "- ").otherwise("+ "), F.when(F.abs("weight") == 1, "").otherwise(F.concat(F.abs("weight").cast("string"), F.lit(" * "))), "child")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("ord", "child", term.alias("term")))), lambda s: s["term"])
    return arcs.groupBy("parent").agg(F.concat(F.col("parent"), F.lit(" = "), F.array_join(parts, " ")).alias("equation"))


def calculation_check(values: DataFrame, arcs: DataFrame, keys: list[str], tolerance: float = 0.001) -> DataFrame:
    """Per ``keys`` and parent: its value, the weighted sum of its children, and whether they agree within the tolerance."""
    v = values.select(*keys, "concept", "value")
    parts = arcs.join(v.withColumnRenamed("concept", "child"), "child").groupBy(*keys, "parent").agg(F.sum(F.col("weight") * F.col("value")).alias("summed"), F.count("*").alias("n_children"))
    both = v.withColumnRenamed("concept", "parent").join(parts, [*keys, "parent"])
    return both.withColumn("agrees", F.abs(F.col("value") - F.col("summed")) <= tolerance * F.greatest(F.abs("value"), F.abs("summed")))


#: Prefixes of element ids in standard dictionaries.
STANDARD_PREFIXES = ("us-gaap_", "dei_", "ifrs-full_")


def _tails(text: Column) -> Column:
    """All ends of a text, the whole first."""
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i))


def resolve_references(refs: DataFrame, concepts: DataFrame) -> DataFrame:
    """The concept each ``href`` points to, by tiers; (href, concept, tier).

    1: the fragment is a name; 2: of a standard fragment the part behind its prefix ends a
    name; 3: it is an element id; 4: a part between underscores is a name, or 5 a local name;
    6: it ends with a local name, the longest first. Within a tier the least name wins.
    Ends are met by joining all tails of a text, never by comparing all names.
    """
    fragment = F.element_at(F.split("href", "#"), -1)
    r = refs.where("href is not null").select("href", fragment.alias("f")).distinct().where("f <> ''")
    standard = F.when(F.col("f").rlike("^(?:" + "|".join(STANDARD_PREFIXES) + ")"), F.regexp_replace("f", "^[^_]*_", ""))
    key = lambda tier, k, rank=F.lit(0): F.struct(F.lit(tier).alias("tier"), k.alias("key"), rank.alias("rank"))
    parts = F.split("f", "_")
    tried = F.concat(
        F.array(key(1, F.col("f")), key(2, standard), key(3, F.col("f"))),
        F.transform(parts, lambda p, i: key(4, p, i)), F.transform(parts, lambda p, i: key(5, p, i)), F.transform(_tails(F.col("f")), lambda t, i: key(6, t, i)),
    )
    local = local_name(F.col("concept"))
    c = concepts.where("name is not null").select(F.col("name").alias("concept"), "concept_id").distinct()
    known = F.concat(
        F.array(key(1, F.col("concept")), key(3, F.col("concept_id")), key(4, F.col("concept")), key(5, local), key(6, local)),
        F.transform(_tails(F.col("concept")), lambda t: key(2, t)),
    )
    known = c.select("concept", F.inline(known)).drop("rank").where("key is not null and key <> ''").distinct()
    hits = r.select("href", F.inline(tried)).where("key is not null and key <> ''").join(known, ["tier", "key"])
    return hits.groupBy("href").agg(F.min(F.struct("tier", "rank", "concept")).alias("best")).select("href", "best.concept", "best.tier")

"""Order baskets, frequent itemsets and association rules.

Sets are mined level by level as tables. A row of a level is one basket's frequent set and those of the basket's frequent items
that come after it; the next level takes each of these in turn, counts the longer sets, and keeps the rows whose set is
frequent. Counts are partial sums, so a common set costs one row for each task, and neither the frequent items nor the
sets that begin with one of them ever stand in one place. A set is only counted where the set without its last item is
frequent, in the baskets that hold it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import stored


@dataclass(frozen=True)
class Itemsets:
    """Frequent sets (items, freq), items ascending, of a number of baskets, and the least confidence of a rule."""

    sets: DataFrame
    n_baskets: int
    min_confidence: float


def order_baskets(purchases: DataFrame, order: str = "order_id", item: str = "item_id") -> DataFrame:
    """(order, items): the distinct items of every order, sorted.

    Pairs are made distinct before the arrays are collected, so an array is never longer than
    the catalogue and a repeated line never travels twice.
    """
    pairs = purchases.where(F.col(item).isNotNull()).select(order, item).distinct()
    return pairs.groupBy(order).agg(F.sort_array(F.collect_set(item)).alias("items"))


def mine(baskets: DataFrame, min_support: float = 1e-4, min_confidence: float = 1e-4) -> Itemsets:
    """All sets in at least min_support of the baskets; `baskets` has sorted arrays `items` of distinct items."""
    held = stored(baskets.select(F.monotonically_increasing_id().alias("basket"), "items"), "baskets")
    n_baskets = held.count()
    least = F.ceil(F.lit(min_support) * F.lit(n_baskets))
    common = lambda rows: stored(rows.groupBy("items").agg(F.count("*").alias("freq")).where(F.col("freq") >= least), "frequent")

    single = held.select("basket", F.explode("items").alias("item"))
    levels = [common(single.select(F.array("item").alias("items")))]
    known = levels[0].select(F.col("items")[0].alias("item"))
    # Each basket again with its frequent items only; a row for each of them and those behind it.
    rest = single.join(known, "item").groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("rest"))
    rows = rest.select(F.array().cast(rest.schema["rest"].dataType).alias("items"), "rest")
    rows = stored(extended(rows), "level")
    while True:
        longer = extended(rows)
        found = common(longer.select("items"))
        if found.isEmpty():
            break
        levels.append(found)
        rows = stored(longer.join(found.select("items"), "items", "left_semi").where(F.size("rest") > 0), "level")
    return Itemsets(reduce(DataFrame.unionByName, levels), n_baskets, min_confidence)


def extended(rows: DataFrame) -> DataFrame:
    """Every row's set with each item of its rest, and what comes behind that item."""
    taken = rows.select("items", "rest", F.posexplode("rest").alias("at", "item"))
    after = F.slice("rest", F.col("at") + 2, F.size("rest"))
    return taken.select(F.array_append("items", F.col("item")).alias("items"), after.alias("rest"))


def frequent_itemsets(mined: Itemsets) -> DataFrame:
    """(items, items_count, freq) with the items of a set in ascending order."""
    return mined.sets.select("items", F.size("items").alias("items_count"), "freq")


def largest_itemsets(mined: Itemsets, n: int = 20) -> DataFrame:
    """The `n` largest sets; equal sizes by descending frequency, then by items."""
    return frequent_itemsets(mined).orderBy(F.desc("items_count"), F.desc("freq"), F.asc("items")).limit(n)


def association_rules(mined: Itemsets) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support): every frequent set with each of its items as what follows."""
    parts = mined.sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("consequent"))
    rules = parts.select(F.array_remove("items", F.col("consequent")).alias("antecedent"), "consequent", "freq")
    before = mined.sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_before"))
    after = mined.sets.where(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("freq").alias("_after"))
    confidence = F.col("freq") / F.col("_before")
    return (
        rules.join(before, "antecedent")
        .join(after, "consequent")
        .where(confidence >= mined.min_confidence)
        .select(
            "antecedent",
            "consequent",
            confidence.alias("confidence"),
            (confidence / (F.col("_after") / F.lit(mined.n_baskets))).alias("lift"),
            (F.col("freq") / F.lit(mined.n_baskets)).alias("support"),
        )
    )

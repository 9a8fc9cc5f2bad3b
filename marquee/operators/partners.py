"""The most similar items of every item, exact, without counting all pairs.

Users with more than LIGHT_ITEMS items are heavy. Pairs that share a light user are counted one by one.
What heavy users add is the same for all items with the same heavy users, so it is counted once for every
two such classes. A partner that shares heavy users alone is the better the fewer users it has, so a class
offers only its first items by (users, item). What an item's list holds already bounds what is read for it: a
class is looked up by so few of its heavy users, rarest first, that one it leaves out cannot enter a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.ranking import best_per_key
from marquee.operators.slots import numbered
from marquee.session import materialise

#: A user with more items is heavy: no pair of its items is listed.
LIGHT_ITEMS = 512
#: Bounds are compared with so much slack, since cosines are rounded.
SLACK = 1e-9


def _cosine(n: Column, one: str, two: str) -> Column:
    return n / F.sqrt(F.col(one).cast("double") * F.col(two))


def described(pairs: DataFrame, user: str, item: str, light: int) -> tuple[DataFrame, DataFrame]:
    """(facts, items): distinct (user, item, reach), and every item with its number of users and its class.

    reach is a user's number of items. Items are of one class if they have the same heavy users, known by
    their number and two sums of 64-bit hashes; class is null where there are none.
    """
    # Keys that join nothing share nothing.
    named = pairs.select(F.col(user).alias("user"), F.col(item).alias("item")).where("user IS NOT NULL AND item IS NOT NULL")
    distinct = materialise(named.distinct(), "facts")
    facts = materialise(distinct.join(distinct.groupBy("user").agg(F.count(F.lit(1)).alias("reach")), "user"), "facts")
    heavy = F.col("reach") > light
    marks = [F.bit_xor(F.when(heavy, F.xxhash64("user", F.lit(seed)))) for seed in (1, 2)]
    items = facts.groupBy("item").agg(F.count(F.lit(1)).alias("size"), F.count_if(heavy).alias("heavy"), F.array(*marks).alias("class"))
    return facts, materialise(items.withColumn("class", F.when(F.col("heavy") > 0, F.col("class"))), "items")


def light_counts(facts: DataFrame, items: DataFrame, light: int) -> DataFrame:
    """Shared light users of two items (i < j, n), with sizes and classes."""
    few = facts.where(F.col("reach").between(2, light))
    left, right = (few.select("user", F.col("item").alias(c)) for c in "ij")
    counted = left.join(right, "user").where("i < j").groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
    for c in "ij":
        counted = counted.join(items.select(F.col("item").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("size", "heavy", "class"))), c)
    return materialise(counted, "light_pairs")


def both_ways(pairs: DataFrame, *values: str) -> DataFrame:
    """Pairs (i, j) and (j, i), with columns of either side swapped too."""
    sides = ("size", "heavy", "class")
    turned = [F.col(f"{x}_{b}").alias(f"{x}_{a}") for x in sides for a, b in ("ij", "ji")]
    kept = [f"{x}_{c}" for x in sides for c in "ij"]
    return pairs.select("i", "j", *values, *kept).unionByName(
        pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), *values, *turned)
    )


def list_bounds(pairs: DataFrame, items: DataFrame, heads: DataFrame, n: int) -> DataFrame:
    """Items with heavy users and the cosine that their n-th partner has at least; 0 where fewer are known.

    Known are partners by light users, and the other items of one's class, which share all heavy users.
    """
    near = both_ways(pairs.where("class_i IS NOT NULL OR class_j IS NOT NULL"), "n").where("class_i IS NOT NULL")
    near = near.select("i", "j", _cosine(F.col("n"), "size_i", "size_j").alias("low"))
    last = best_per_key(near, ["i"], [F.col("low").desc(), F.col("j").asc()], n, rank="place").where(F.col("place") == n)
    own = heads.where(F.col("place") == n + 1).select("class", F.col("size").alias("last_size"))
    known = items.where("class IS NOT NULL").join(own, "class", "left").join(last.select(F.col("i").alias("item"), "low"), "item", "left")
    inside = _cosine(F.col("heavy"), "size", "last_size")
    bound = F.greatest(F.coalesce("low", F.lit(0.0)), F.coalesce(inside, F.lit(0.0)))
    return known.select("item", "size", "heavy", "class", bound.alias("bound"))


def class_overlaps(wanted: DataFrame, members: DataFrame) -> DataFrame:
    """(one, two, shared) of the wanted pairs of different classes that share heavy users."""
    left = members.select(F.col("class").alias("one"), "user")
    right = members.select(F.col("class").alias("two"), "user")
    return wanted.join(left, "one").join(right, ["two", "user"]).groupBy("one", "two").agg(F.count(F.lit(1)).alias("shared"))


def near_classes(bounds: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of different classes (one, two) of which the second may hold a partner for an item of the first.

    A partner with cosine t shares at least t * t * size users with an item. Two classes that share so many
    meet among all but that many, less one, of the first one's heavy users, whichever those are.
    """
    least = bounds.groupBy("class").agg(F.min(F.col("bound") * F.col("bound") * F.col("size")).alias("least"), F.first("heavy").alias("heavy"))
    need = F.greatest(F.lit(1), F.ceil(F.col("least") - SLACK)).cast("bigint")
    probes = least.select("class", (F.col("heavy") - need + 1).alias("length")).where("length > 0")
    placed = numbered(members, [F.col("class"), F.col("reach").asc(), F.col("user").asc()], "at")
    begins = placed.groupBy("class").agg(F.min("at").alias("begin"))
    first = placed.join(begins, "class").join(probes, "class").where(F.col("at") - F.col("begin") < F.col("length"))
    left = first.select(F.col("class").alias("one"), "user")
    right = members.select(F.col("class").alias("two"), "user")
    return left.join(right, "user").where("one <> two").select("one", "two").distinct()


def top_partners(pairs: DataFrame, user: str = "user_id", item: str = "movie_id", n: int = 20, light: int = LIGHT_ITEMS) -> DataFrame:
    """The ``n`` items of highest cosine for every item, over the users they share: (i, j, cosine, rank).

    Equal cosines are ordered by item; repeated rows count once and null users or items not at all; items that
    share no user are no partners, so lists may be shorter and an empty table has none. All lists are exact.
    Work on pairs is at most ``light`` rows for a row of the input, and one row for two classes that share a
    heavy user and may meet; a user of any number of items, all in one class, costs its rows.
    """
    facts, items = described(pairs, user, item, light)
    found = light_counts(facts, items, light)
    classed = items.where("class IS NOT NULL")
    order = [F.col("cosine").desc(), F.col("j").asc()]
    if classed.isEmpty():
        alone = both_ways(found, "n").select("i", "j", _cosine(F.col("n"), "size_i", "size_j").alias("cosine"))
        return best_per_key(alone, ["i"], order, n, rank="rank")
    members = facts.where(F.col("reach") > light).join(classed.select("item", "class"), "item").select("class", "user", "reach").distinct()
    members = materialise(members, "class_users")
    heads = materialise(best_per_key(classed, ["class"], [F.col("size").asc(), F.col("item").asc()], n + 1, rank="place"), "class_heads")
    bounds = materialise(list_bounds(found, items, heads, n), "bounds")

    lights = found.where("class_i IS NOT NULL AND class_j IS NOT NULL AND class_i <> class_j")
    asked = lights.select(F.col("class_i").alias("one"), F.col("class_j").alias("two")).distinct()
    near = near_classes(bounds, members)
    shared = materialise(class_overlaps(asked.unionByName(near).distinct(), members), "class_overlaps")

    both = found.join(shared.select(F.col("one").alias("class_i"), F.col("two").alias("class_j"), "shared"), ["class_i", "class_j"], "left")
    extra = F.when(F.col("class_i") == F.col("class_j"), F.col("heavy_i")).otherwise(F.coalesce("shared", F.lit(0)))
    by_light = both_ways(both.withColumn("total", F.col("n") + F.coalesce(extra, F.lit(0))), "total")
    by_light = by_light.select("i", "j", _cosine(F.col("total"), "size_i", "size_j").alias("cosine"))

    of_head = heads.select(F.col("class").alias("two"), F.col("item").alias("j"), F.col("size").alias("size_j"))
    same = classed.groupBy("class").agg(F.first("heavy").alias("shared")).select(F.col("class").alias("one"), F.col("class").alias("two"), "shared")
    offered = shared.unionByName(same).join(of_head, "two")
    seekers = bounds.select(F.col("class").alias("one"), F.col("item").alias("i"), F.col("size").alias("size_i"), "bound")
    by_heavy = seekers.join(offered, "one").withColumn("cosine", _cosine(F.col("shared"), "size_i", "size_j"))
    by_heavy = by_heavy.where((F.col("i") != F.col("j")) & (F.col("cosine") >= F.col("bound") - SLACK)).select("i", "j", "cosine")

    # A pair found both ways has its whole count in the light part.
    best = by_light.unionByName(by_heavy).groupBy("i", "j").agg(F.max("cosine").alias("cosine"))
    return best_per_key(best, ["i"], order, n, rank="rank")

"""Joins of token sets by similarity: pair by pair in small groups, and in others through an inverted index on the rarest tokens, where no pair is
looked at that shares none of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Groups of at most so many sets are compared pair by pair: that is a bounded number of pairs a set, where the index has a row for each token.
DIRECT = 64


def by_size(sets: DataFrame, group: str, direct: int) -> tuple[DataFrame, DataFrame]:
    """The sets of groups of at most direct sets, and the others. Semi joins, as Spark makes these before it computes tokens from texts."""
    sizes = sets.groupBy(group).agg(F.count(F.lit(1)).alias("sets__"))
    return tuple(sets.join(sizes.where(held).select(group), group, "left_semi") for held in (F.col("sets__") <= direct, F.col("sets__") > direct))


def by_rarity(sets: DataFrame, group: str, key: str, tokens: str) -> DataFrame:
    """(group, key, ranked): each set's tokens as (held, token), where held is how many of the group's sets hold it: fewest first, ties by the
    token. Counts are summed in each task before they move. Keys whose set is empty are left out."""
    flat = sets.select(group, key, F.explode(tokens).alias("token"))
    held = flat.groupBy(group, "token").agg(F.count(F.lit(1)).alias("held"))
    return flat.join(held, [group, "token"]).groupBy(group, key).agg(F.array_sort(F.collect_list(F.struct("held", "token"))).alias("ranked"))


def prefix(ranked: Column, least: float) -> Column:
    """The tokens one of which any set holds that has the share least of the set's tokens or more: all but as many as it could lack."""
    n = F.size(ranked)
    return F.slice(ranked, 1, n - F.ceil(n * least - 1e-9).cast("int") + 1)


def similar_pairs(sets: DataFrame, group: str, key: str, tokens: str, least: float, direct: int = DIRECT) -> DataFrame:
    """(group, a, b, similarity) with a < b: the pairs of a group's sets (group, key, tokens) whose Jaccard similarity is least or more.

    Two such sets share a token among the rarest of either, so only these are joined, without those that one set alone holds; sizes must fit each other
    too. Pairs are then checked on all tokens. Equal sets should be one set first, passed as one key, or many copies of a set are all
    pairs of one another. least is above 0. Groups of at most direct sets need no index."""
    small, sets = by_size(sets.select(group, key, tokens), group, direct)
    shared = F.size(F.array_intersect("ta__", "tb__"))
    likeness = (shared / F.nullif(F.size("ta__") + F.size("tb__") - shared, F.lit(0))).alias("similarity")
    a, b = (small.withColumnsRenamed({key: k, tokens: f"t{k}__"}) for k in "ab")
    near = (F.col("a") < F.col("b")) & (F.size("ta__") >= F.size("tb__") * least - 1e-9) & (F.size("tb__") >= F.size("ta__") * least - 1e-9)
    few = a.join(b, group).where(near).select(group, "a", "b", likeness).where(F.col("similarity") >= least)
    ranked = by_rarity(sets, group, key, tokens)
    index = ranked.select(group, key, F.size("ranked").alias("n"), F.explode(F.filter(prefix(F.col("ranked"), least), lambda t: t["held"] > 1)).alias("t__"))
    left = index.select(group, "t__.token", F.col(key).alias("a"), F.col("n").alias("na"))
    right = index.select(group, "t__.token", F.col(key).alias("b"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (F.col("na") >= F.col("nb") * least - 1e-9) & (F.col("nb") >= F.col("na") * least - 1e-9)
    pairs = left.join(right, [group, "token"]).where(fits).select(group, "a", "b").distinct()
    plain = sets.select(group, key, tokens)
    both = pairs.join(plain.withColumnsRenamed({key: "a", tokens: "ta__"}), [group, "a"]).join(plain.withColumnsRenamed({key: "b", tokens: "tb__"}), [group, "b"])
    found = both.select(group, "a", "b", likeness)
    return found.where(F.col("similarity") >= least).unionByName(few)


def contained_pairs(sets: DataFrame, holders: DataFrame, group: str, key: str, holder: str, tokens: str, least: float, direct: int = DIRECT) -> DataFrame:
    """(group, key, holder): the sets of which a holder (group, holder, tokens) of the same group has the share least or more. Each holder is held
    against all sets of a group of at most direct sets, and in others against those that the index finds."""
    sets = sets.select(group, key, tokens).join(holders.select(group).distinct(), group, "left_semi")
    small, sets = by_size(sets, group, direct)
    enough = F.size(F.array_intersect(tokens, "held__")) >= F.greatest(F.size(tokens) * least - 1e-9, F.lit(1.0))  # an empty set is in none
    held = holders.select(group, holder, F.col(tokens).alias("held__"))
    few = small.join(held, group).where(enough).select(group, key, holder)
    index = by_rarity(sets, group, key, tokens).select(group, key, F.explode(prefix(F.col("ranked"), least)).alias("t__")).select(group, key, "t__.token")
    inverted = holders.select(group, holder, F.explode(tokens).alias("token"))
    pairs = index.join(inverted, [group, "token"]).select(group, key, holder).distinct()
    both = pairs.join(sets.select(group, key, tokens), [group, key]).join(held, [group, holder])
    return both.where(enough).select(group, key, holder).unionByName(few)

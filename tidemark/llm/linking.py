"""Groups from buckets without emitting the pairs of a group: stars, connected components, exact remainder.

``buckets`` holds one row ``(bucket, id)`` for each candidate key of an item.
Items that share a bucket may be similar; ``verify`` decides about pairs.

1. Star: every member is compared with the smallest id of its bucket, which is
   linear in the bucket's size.
2. Components of the confirmed links.
3. Exact remainder: a bucket that still holds more than one component may hide
   a link between them. Its pairs between *different* components are compared,
   where one side lies outside the bucket's largest component. Pairs inside one
   component can't change a group, so no group is lost and a bucket of copies
   costs nothing here.

For items that are sets of parts (``parts``), the remainder is cut down without
loss, so that a large group of near copies that mostly miss the threshold isn't
compared pair by pair. Parts that at most ``RARE`` of the remaining items have are
rare. Two items that share a rare part are found through it (at most ``RARE`` items
a part). Two that share none have at most their common parts in common, so the
numbers of common and rare parts bound their similarity; the bound is tested
on the distinct pairs of these numbers in a bucket, not on its items. Before
that, members are compared with the bucket's hub, the one with the fewest rare
parts.

All steps are DataFrame joins and aggregates with map-side combine; hot join
keys are split by adaptive skew joins. Intermediate tables are written to the
shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, written

RARE = 8


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows of ``buckets(bucket, id)`` whose bucket holds two different ids, with the smallest (``lead``) and the count."""
    stat = buckets.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("__top"), F.count("*").alias("members"))
    return buckets.join(stat.filter("lead <> __top").drop("__top"), "bucket")


def star_pairs(shared: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``: each member of a bucket with the bucket's smallest id."""
    return shared.filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()


def mixed_members(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """``bucket, id, root`` of the buckets of more than two members that hold more than one group."""
    at = shared.filter("members > 2").select("bucket", "id").join(groups, "id", "left")
    at = at.select("bucket", "id", F.coalesce("root", "id").alias("root"))
    mixed = at.groupBy("bucket").agg(F.min("root").alias("__lo"), F.max("root").alias("__hi")).filter("__lo <> __hi").select("bucket")
    return at.join(mixed, "bucket")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def part_sizes(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sizes(id, common, rare), shared(id, part))`` of ``parts(id, part)``: shared are the rare parts of several items."""
    held = parts.groupBy("part").agg(F.count("*").alias("__n"))
    few = parts.join(held.filter(F.col("__n") <= RARE), "part")
    rare = few.groupBy("id").agg(F.count("*").alias("rare"))
    every = parts.groupBy("id").agg(F.count("*").alias("__all"))
    sizes = every.join(rare, "id", "left").select("id", (F.col("__all") - F.coalesce("rare", F.lit(0))).alias("common"), F.coalesce("rare", F.lit(0)).alias("rare"))
    return sizes, few.filter("__n > 1").select("id", "part")


def _bound(similarity: float, common1: str, rare1: str, common2: str, rare2: str, shared: Column | None = None) -> Column:
    """Whether two items can reach the Jaccard similarity: all that may be shared against what certainly isn't."""
    both = F.least(common1, common2) + (shared if shared is not None else F.lit(0))
    total = F.col(common1) + F.col(rare1) + F.col(common2) + F.col(rare2) - both
    return both >= similarity * total - 1e-9


def hub_pairs(mixed: DataFrame, sizes: DataFrame, done: DataFrame) -> DataFrame:
    """New pairs ``(a, b)``: each member of a mixed bucket with the member that has the fewest rare parts."""
    hub = mixed.join(sizes, "id").groupBy("bucket").agg(F.min(F.struct("rare", "id", "root")).alias("h"))
    pairs = mixed.join(hub, "bucket").filter("root <> h.root").select(F.col("h.id").alias("__h"), "id").select(*_ordered("__h", "id")).distinct()
    return pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")


def _outside(mixed: DataFrame) -> DataFrame:
    """The members that lie outside their bucket's largest group: ``bucket, __x, __rx``."""
    count = mixed.groupBy("bucket", "root").agg(F.count("*").alias("__n"))
    largest = count.groupBy("bucket").agg(F.max(F.struct("__n", "root")).alias("__m")).select("bucket", F.col("__m.root").alias("__main"))
    return mixed.join(largest, "bucket").filter("root <> __main").select("bucket", F.col("id").alias("__x"), F.col("root").alias("__rx"))


def cross_pairs(mixed: DataFrame, done: DataFrame) -> DataFrame:
    """New pairs ``(a, b)`` of one bucket that lie in different groups."""
    pairs = _outside(mixed).join(mixed, "bucket").filter("__rx <> root").select(*_ordered("__x", "id")).distinct()
    return pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")


def bounded_pairs(mixed: DataFrame, done: DataFrame, sizes: DataFrame, shared: DataFrame, similarity: float) -> DataFrame:
    """The pairs of ``cross_pairs`` that the numbers of their common and rare parts leave possible."""
    root = mixed.select("id", "root").distinct().join(sizes, "id")
    # items with a rare part in common
    one = shared.select("part", F.col("id").alias("a"))
    two = shared.select("part", F.col("id").alias("b"))
    met = one.join(two, "part").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("__c"))
    left = root.select(F.col("id").alias("a"), F.col("root").alias("__ra"), F.col("common").alias("__ca"), F.col("rare").alias("__qa"))
    right = root.select(F.col("id").alias("b"), F.col("root").alias("__rb"), F.col("common").alias("__cb"), F.col("rare").alias("__qb"))
    met = met.join(left, "a").join(right, "b").filter("__ra <> __rb").filter(_bound(similarity, "__ca", "__qa", "__cb", "__qb", F.col("__c"))).select("a", "b")
    # items without one: first the distinct numbers of each bucket, then the items that have them
    numbers = mixed.join(sizes, "id").select("bucket", "common", "rare").distinct()
    other = numbers.select("bucket", F.col("common").alias("__c2"), F.col("rare").alias("__q2"))
    able = numbers.join(other, "bucket").filter(_bound(similarity, "common", "rare", "__c2", "__q2"))
    sized = mixed.join(sizes, "id")
    outside = _outside(mixed).join(sizes.withColumnRenamed("id", "__x"), "__x").join(able, ["bucket", "common", "rare"])
    outside = outside.select("bucket", "__x", "__rx", F.col("__c2").alias("common"), F.col("__q2").alias("rare"))
    plain = outside.join(sized, ["bucket", "common", "rare"]).filter("__rx <> root").select(*_ordered("__x", "id"))
    return met.union(plain).distinct().join(done.select("a", "b"), ["a", "b"], "left_anti")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, root)`` for every id in ``links(a, b)``; root is the smallest id of its connected component.

    Alternates the large-star and small-star steps of connected components by
    key, each a min aggregate and a join, until the edges are stars. Written
    after each round; the round before is deleted."""
    spark = links.sparkSession
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if edges.isEmpty():
        return spark.createDataFrame([], "id long, root long")
    for _ in range(max_rounds):
        if _are_stars(edges):
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).distinct()
        after = written(small, "edges")
        forget(edges)
        edges = after
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge ``(u, v)`` leads from a node of one edge to a node that no edge leaves."""
    leave = edges.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    arrive = edges.select(F.col("v").alias("u")).distinct().withColumn("hit", F.lit(True))
    return leave.join(arrive, "u", "left").filter("lo <> hi or hit").isEmpty()


def linked_groups(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    parts: Callable[[DataFrame], DataFrame] | None = None,
    similarity: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """``(groups(id, root), links)`` of the items in ``buckets(bucket, id)``.

    ``verify(pairs)`` gets ``(a, b)`` rows and returns those confirmed, with
    any further columns. ``parts(ids)`` gives the parts ``(id, part)`` of the
    items in a table of ids, if ``verify`` asks for a Jaccard ``similarity`` of
    them. Ids without a link are in no group."""
    shared = written(shared_buckets(buckets), "shared")
    done = written(star_pairs(shared), "pairs")
    links = written(verify(done), "links")
    groups = components(links.select("a", "b"))

    def add(pairs: DataFrame) -> bool:
        nonlocal done, links, groups
        new = written(pairs, "pairs")
        if new.isEmpty():
            return False
        found = written(verify(new), "links")
        done, links = done.unionByName(new), links.unionByName(found)
        if found.isEmpty():
            return False
        roots = groups.select(F.col("root").alias("a"), F.col("id").alias("b"))
        groups = written(components(roots.union(found.select("a", "b"))), "groups")
        return True

    mixed = written(mixed_members(shared, groups), "mixed")
    if mixed.isEmpty():
        return groups, links
    if parts is None:
        add(cross_pairs(mixed, done))
        return groups, links
    sizes, rare = part_sizes(written(parts(mixed.select("id").distinct()), "parts"))
    sizes, rare = written(sizes, "sizes"), written(rare, "rare")
    if add(hub_pairs(mixed, sizes, done)):
        mixed = written(mixed_members(shared, groups), "mixed")
    add(bounded_pairs(mixed, done, sizes, rare, similarity))
    return groups, links

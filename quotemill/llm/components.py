"""Connected components and the closing of hash buckets, in DataFrame operations only.

Tables are staged between rounds, so a lost executor costs one round and no group is ever gathered
in one place: groups of any size are reduced by partial aggregation or joined.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import stage

SMALL_BUCKET = 32
ROUNDS = 3


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of ``links`` (a, b) reaches.

    Every round maps a node to its neighbour of smallest random rank, itself included, and rewrites the links;
    a constant part of the nodes goes in each round whatever the shape. Ranks hold for two rounds, in which a star of any size
    is gone: first its middle moves to the smallest, then all others do. Loops and repeats are fine.
    """
    links = stage(links.filter("a <> b").select("a", "b").distinct(), "links")
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    place = stage(both(links).select(F.col("a").alias("id")).distinct().withColumn("at", F.col("id")), "places")
    turn = 0
    while not links.isEmpty():
        rank = lambda c: F.xxhash64(F.col(c), F.lit(turn // 2))  # noqa: B023, E731
        best = both(links).groupBy("a").agg(F.min_by("b", F.struct(rank("b"), F.col("b"))).alias("b"))
        to = F.when(F.struct(rank("a"), F.col("a")) < F.struct(rank("b"), F.col("b")), F.col("a")).otherwise(F.col("b"))
        move = stage(best.select(F.col("a").alias("at"), to.alias("to")), "moves")
        place = stage(place.join(move, "at", "left").select("id", F.coalesce("to", "at").alias("at")), "places")
        left = move.select(F.col("at").alias("a"), F.col("to").alias("to_a"))
        right = move.select(F.col("at").alias("b"), F.col("to").alias("to_b"))
        links = links.join(left, "a").join(right, "b").filter("to_a <> to_b")
        links = stage(links.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        turn += 1
    smallest = place.groupBy("at").agg(F.min("id").alias("component"))
    return stage(place.join(smallest, "at").select("id", "component"), "components")


def joined_components(components: DataFrame | None, links: DataFrame) -> DataFrame:
    """``components`` after more ``links`` (a, b): only links between two of them are followed."""
    if components is None:
        return connected_components(links)
    of = lambda side: components.select(F.col("id").alias(side), F.col("component").alias(f"{side}_in"))
    known = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    more = connected_components(known.select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b")))
    # what was in no component is its own, under its own id
    alone = more.join(components.select("id"), "id", "left_anti").select("id", F.col("id").alias("component"))
    to = more.select(F.col("id").alias("component"), F.col("component").alias("to"))
    placed = components.select("id", "component").unionAll(alone).join(to, "component", "left")
    return stage(placed.select("id", F.coalesce("to", "component").alias("component")), "components")


def shared_buckets(members: DataFrame) -> DataFrame:
    """Rows of (bucket, id) whose bucket holds at least two ids, staged."""
    sized = members.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket")))
    return stage(sized.filter("size > 1").select("bucket", "id", "size"), "buckets")


def _labelled(buckets: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return buckets.withColumn("c", F.col("id"))
    return buckets.join(components, "id", "left").select("bucket", "id", "size", F.coalesce("component", "id").alias("c"))


def close_buckets(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], against: Callable[[DataFrame, DataFrame], DataFrame] | None = None, rounds: int = ROUNDS, within: Callable[[DataFrame], DataFrame] | None = None, limit: int | None = None) -> DataFrame:
    """Components (id, component) of all verified links between ids that share a bucket.

    ``verify`` maps pairs (a, b) to the pairs that are links. In a round every bucket that is not yet
    of one component names one member, another one each round, and each id of another component is
    compared with the named member it shares most buckets with: a row per id. Most groups of copies are one
    component after that. What is left is closed without loss: ids outside the largest component of
    their bucket are compared with everything in other components, by pairs in buckets of up to ``limit`` (SMALL_BUCKET), and by
    ``against(ids, candidates)``, which holds blocks of ids against all candidates, in larger ones; its rows are (id, c),
    ``c`` the component so far. ``within`` maps the rows (bucket, id, c, main) of the smaller buckets to their links itself.
    """
    limit = SMALL_BUCKET if limit is None else limit
    components = None
    for turn in range(rounds):
        here = _labelled(buckets, components)
        rank = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
        named = here.groupBy("bucket").agg(F.min_by(F.struct("id", "c"), F.struct(rank, F.col("id"))).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
        named = named.filter("low < high").select("bucket", F.col("n.id").alias("to"), F.col("n.c").alias("to_c"))
        tried = here.join(named, "bucket").filter("c <> to_c").groupBy("id", "to").agg(F.count(F.lit(1)).alias("times"))
        best = tried.groupBy("id").agg(F.max_by("to", F.struct("times", -F.col("to"))).alias("to"))
        found = stage(verify(best.select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct()), "verified")
        if turn and found.isEmpty():
            break
        components = joined_components(components, found)
    here = stage(_labelled(buckets, components), "labelled")
    parts = here.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("bucket").agg(F.max_by("c", F.struct("n", -F.col("c"))).alias("main"), F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    open_ = stage(here.join(main, "bucket").select("bucket", "id", "size", "c", "main"), "open-buckets")
    small = open_ if against is None else open_.filter(F.col("size") <= limit)
    if within is None:
        other = small.select("bucket", F.col("id").alias("to"), F.col("c").alias("to_c"))
        pairs = small.filter("c <> main").join(other, "bucket").filter("c <> to_c")
        more = [verify(pairs.select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct())]
    else:
        more = [within(small.select("bucket", "id", "c", "main"))]
    if against is not None:
        large = open_.filter(F.col("size") > limit)
        more.append(against(large.filter("c <> main").select("id", "c").distinct(), large.select("id", "c").distinct()))
    first, *others = [stage(found, "verified") for found in more]
    for found in others:
        first = first.unionAll(found)
    return joined_components(components, first)

"""Connected groups of near-duplicates from candidate postings, without pairing a group's members all with all.

Records that look alike to the candidate search form a *group* ``g``; its members are the nodes ``m``.
A posting (key, g) says that a group may match any other group under the same key.

1. Stars: under each key every group meets the first and the previous group only, and of
   these partners each group keeps the most frequent one; inside a group every member meets the first.
   Verified pairs are links, and links are joined to components.
2. Turns: keys with one component are done. Under the others, every group outside the key's largest component
   tries two groups of it, those it meets under most keys, as long as an eighth of such pairs links.
3. Rest: the only pairs that can still change a component lie in different components. Groups outside the
   key's largest component meet all groups of other components, under the first of each row of keys that
   two groups share and only if their traits allow a link, and their members are verified.

Step 3 leaves out only pairs that are connected already, so the components are those of all
verified pairs. Its cost follows the number of groups that do not belong to their key's main component.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailgrain.llm.common import Steps, components

Admissible = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def shared_postings(steps: Steps, postings: DataFrame, band: Column, order: list[str], carried: list[str], admissible: Admissible) -> DataFrame:
    """Postings whose key has several groups, with the previous group and the first of its band if they may match."""
    row = F.struct("g", *carried)
    by_key = W.partitionBy("key").orderBy("_band", *order)
    by_band = W.partitionBy("key", "_band").orderBy(*order)
    # The band follows from the row, so it is not moved with it.
    near = postings.repartition("key").withColumn("_band", band).select(
        "key", "g", *carried, F.lag(row).over(by_key).alias("_previous"), F.lead("g").over(by_key).isNotNull().alias("_more"), F.first(row).over(by_band).alias("_first")
    )

    def partner(name: str) -> Column:
        there = lambda c: F.col(f"{name}.{c}")
        return F.when((there("g") != F.col("g")) & admissible(F.col, there), there("g"))

    near = near.where("_previous is not null or _more")
    return steps.save("shared", near.select("key", "g", *carried, partner("_previous").alias("previous"), partner("_first").alias("leader")))


def chained(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``before``, the key of the same group's row before it in ``order``."""
    return rows.withColumn("before", F.lag("key").over(W.partitionBy("g").orderBy(*order)))


def meetings(rows: DataFrame, admissible: Admissible, alike: Admissible | None = None) -> DataFrame:
    """(g, h), g < h: groups of different components that may match, from ``chained`` rows of open keys; a pair may come several times.

    Similar groups share most of their keys. Where the keys before are equal, too, the pair meets under those, so only the first of each
    row of shared keys counts. The order must be such that a pair that may match under one of its keys may under all earlier ones.
    ``alike`` is null for groups whose traits are not known; these meet.
    """
    fits = F.lit(True) if alike is None else F.coalesce(alike(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")), F.lit(True))
    x, y = rows.where("not in_main").alias("x"), rows.alias("y")
    cross = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & ~F.col("x.part").eqNullSafe(F.col("y.part"))
        & (F.col("y.in_main") | (F.col("x.g") < F.col("y.g")))
        & ~F.coalesce(F.col("x.before") == F.col("y.before"), F.lit(False))
        & admissible(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))
        & fits,
    )
    return cross.select(F.least("x.g", "y.g").alias("g"), F.greatest("x.g", "y.g").alias("h"))


def connected(
    steps: Steps,
    shared: DataFrame,
    members: DataFrame,
    carried: list[str],
    admissible: Admissible,
    verify: Callable[[str, DataFrame], DataFrame],
    order: list[Column],
    traits: Callable[[DataFrame], DataFrame],
    alike: Admissible,
) -> DataFrame:
    """(node, component) for all nodes with a link.

    ``members``: (g, m); ``verify``: of pairs (a, b), those that link; ``order`` of a group's postings: see ``meetings``.
    ``traits``: (m, traits) of the nodes (m); ``alike``: whether two nodes can link as far as their traits tell. It must hold for all that do.
    """
    met = [shared.where(F.col(partner).isNotNull()).select("g", F.col(partner).alias("other")) for partner in ("leader", "previous")]
    best = (
        met[0].union(met[1]).groupBy("g", "other").agg(F.count("*").alias("n"))
        .groupBy("g").agg(F.max_by("other", F.struct("n", "other")).alias("other"))
    )
    first = members.groupBy("g").agg(F.min("m").alias("head"), F.count("*").alias("size"))
    heads = steps.save("heads", first)
    a, b = heads.select("g", F.col("head").alias("b")), heads.select(F.col("g").alias("other"), F.col("head").alias("a"))
    stars = best.join(a, "g").join(b, "other").select("a", "b")
    inside = members.join(heads.where("size > 1").select("g", "head"), "g").where("m <> head").select(F.col("head").alias("a"), F.col("m").alias("b"))
    pairs = stars.union(inside).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = steps.save("links0", verify("links0", pairs))
    turn, useful, open_rows = 0, True, shared
    while True:
        turn += 1
        # A key with one component keeps one, so each turn starts from the keys the last one left open.
        label = components(steps, links, f"turn{turn}")
        known, groups, open_rows = _open(steps, turn, open_rows, members, carried, label)
        steps.drop(f"open{turn - 1}", f"known{turn - 1}")
        mixed = groups.where("part.mixed is not null").select("g", F.col("g").alias("h"))
        if open_rows.isEmpty() and mixed.isEmpty():
            return label
        if not useful:
            break
        there = lambda c: F.col(f"pick.{c}")
        tries = open_rows.where("not in_main").withColumn("pick", F.explode("picks")).where(admissible(F.col, there))
        tries = tries.groupBy("g", there("g").alias("other")).agg(F.count("*").alias("n"))
        tries = tries.withColumn("k", F.row_number().over(W.partitionBy("g").orderBy(F.desc("n"), "other"))).where("k <= 2")
        pairs = tries.join(a, "g").join(b, "other").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = steps.save(f"tries{turn}", pairs)
        found = steps.save(f"links{turn}", verify(f"links{turn}", pairs))
        tried, linked = pairs.count(), found.count()
        useful = linked * 8 > tried
        if not linked:
            break
        steps.drop(f"tries{turn}")
        links = links.union(found)
    # Members of one group differ, so only a group of one node has the traits of its node.
    alone = known.join(open_rows.select("g").distinct(), "g", "left_semi").groupBy("g").agg(F.min("m").alias("m"), F.count("*").alias("k"))
    alone = alone.where("k = 1").select("g", "m")
    looks = alone.join(traits(alone.select("m")), "m").groupBy("g").agg(F.min("traits").alias("traits"), F.count("*").alias("k"))
    looks = looks.where("k = 1").select("g", "traits")
    chains = steps.save("chains", chained(open_rows, order).join(looks, "g", "left"))
    steps.drop(f"open{turn}")
    cross = meetings(chains, admissible, alike).distinct()
    p = known.select("g", F.col("m").alias("a"), F.col("c").alias("ca"))
    q = known.select(F.col("g").alias("h"), F.col("m").alias("b"), F.col("c").alias("cb"))
    rest = cross.union(mixed).join(p, "g").join(q, "h").where("ca <> cb and (g <> h or a < b)")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = steps.save("rest", verify("rest", rest))
    return components(steps, links.union(more), "all")


def _open(steps: Steps, turn: int, shared: DataFrame, members: DataFrame, carried: list[str], found: DataFrame) -> tuple[DataFrame, ...]:
    """Members with their component, groups with theirs, and the postings of keys that still hold several.

    Each such posting says whether it is in the key's largest component, and if not, names a few groups of that
    component, the same under many keys but others in each turn.
    """
    known = members.join(found.withColumnRenamed("node", "m"), "m", "left")
    known = steps.save(f"known{turn}", known.select("g", "m", F.coalesce("component", "m").alias("c")))
    same = F.min("c") == F.max("c")
    groups = known.groupBy("g").agg(F.struct(F.min("c").alias("c"), F.when(~same, F.col("g")).alias("mixed")).alias("part"))
    here = steps.save(f"parts{turn}", shared.select("key", "g", *carried).join(groups, "g"))
    picks = F.array_distinct(F.array(*[F.min_by(F.struct("g", *carried), F.xxhash64(F.lit(8 * turn + i), "g")) for i in range(4)]))
    keys = (
        here.groupBy("key", "part").agg(F.count("*").alias("n"), picks.alias("picks"))
        .groupBy("key").agg(F.max_by(F.struct("part", "picks"), F.struct("n", "part")).alias("top"), F.count("*").alias("parts"))
        .where("parts > 1").select("key", F.col("top.part").alias("main"), F.col("top.picks").alias("picks"))
    )
    open_rows = here.join(keys, "key").withColumn("in_main", F.col("part").eqNullSafe(F.col("main"))).drop("main")
    open_rows = open_rows.withColumn("picks", F.when(~F.col("in_main"), F.col("picks")))
    open_rows = steps.save(f"open{turn}", open_rows)
    steps.drop(f"parts{turn}")
    return known, groups, open_rows

"""Numbers of tree nodes that make "below" a range, without a row for each node and ancestor.

Everything here goes up by doubled steps: step k of a node is its ancestor 2^k above. A tree of depth d has log2(d) of
them, each a table of at most one row a node, so a chain of any length costs rows times the logarithm of its depth.
Node tables have tree_id, node_id, parent_id (null at a root) and dist; a parent that isn't in the table counts as none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged

KEY = ["tree_id", "node_id"]
#: Rows of a window at most, about: siblings of a node, leaves of a taxon.
BLOCK = 1 << 16


def steps(nodes: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ...: tree_id, node_id, up (2^k nodes above) and reach (the length of the way there), of nodes that have one."""
    known = nodes.select("tree_id", F.col("node_id").alias("up"))
    first = nodes.where("parent_id is not null").select(*KEY, F.col("parent_id").alias("up"), F.coalesce("dist", F.lit(0.0)).alias("reach"))
    now = staged(first.join(known, ["tree_id", "up"], "left_semi").select(*KEY, "up", "reach"), "steps")
    found = [now]
    while True:
        over = now.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("_up"), F.col("reach").alias("_reach"))
        now = staged(now.join(over, ["tree_id", "up"]).select(*KEY, F.col("_up").alias("up"), (F.col("reach") + F.col("_reach")).alias("reach")), "steps")
        if now.isEmpty():
            return found
        found.append(now)
        if len(found) > 12 and 1 << (len(found) - 1) > nodes.count():
            raise ValueError("a node is its own ancestor")


MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


def rolled(values: DataFrame, ways: list[DataFrame], merge: dict[str, str]) -> DataFrame:
    """values (tree_id, node_id, ...; a row a node at most) of each node merged with those of all nodes below it. merge: sum, min or max of each column."""
    now = values.select(*KEY, *merge)
    for way in ways:
        moved = now.join(way.select(*KEY, "up"), KEY).select("tree_id", F.col("up").alias("node_id"), *merge)
        now = staged(now.unionByName(moved).groupBy(*KEY).agg(*(MERGES[how](c).alias(c) for c, how in merge.items())), "rolled")
    return now


def along(nodes: DataFrame, ways: list[DataFrame], weight: str, total: str) -> DataFrame:
    """tree_id, node_id and the sum of weight over each node and all its ancestors. nodes: tree_id, node_id, weight."""
    now = nodes.select(*KEY, F.col(weight).alias(total))
    for way in ways:
        above = now.select("tree_id", F.col("node_id").alias("up"), F.col(total).alias("_more"))
        step = way.select(*KEY, "up").join(above, ["tree_id", "up"]).select(*KEY, "_more")
        now = staged(now.join(step, KEY, "left").select(*KEY, (F.col(total) + F.coalesce("_more", F.lit(0))).alias(total)), "along")
    return now


def root_distances(nodes: DataFrame, ways: list[DataFrame]) -> DataFrame:
    """tree_id, node_id and root_dist, the length of the way from each node to its root."""
    own = nodes.select(*KEY).join(ways[0].select(*KEY, "reach"), KEY, "left").withColumn("reach", F.coalesce("reach", F.lit(0.0)))
    return along(own, ways, "reach", "root_dist")


def running(rows: DataFrame, keys: list[str], order: str, value: str, total: str) -> DataFrame:
    """rows with the sum of value over the rows of the same keys that come before in a hashed order of blocks; no window holds more than a block."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks"))
    dealt = rows.join(sizes, keys).withColumn("_block", F.pmod(F.xxhash64(order), F.col("_blocks"))).drop("_blocks")
    before = (Window.unboundedPreceding, -1)
    blocks = dealt.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    earlier = blocks.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(*before)), F.lit(0))).drop("_sum")
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(*before)), F.lit(0))
    return dealt.withColumn("_inside", inside).join(earlier, [*keys, "_block"]).withColumn(total, F.col("_before") + F.col("_inside")).drop("_block", "_inside", "_before")


def intervals(nodes: DataFrame, ways: list[DataFrame]) -> DataFrame:
    """tree_id, node_id, first and last: a node is below another if its first is within the other's first and last.

    first numbers the nodes of a tree so that those below a node follow it without a gap; roots of one tree_id follow one
    another.
    """
    sizes = rolled(nodes.select(*KEY, F.lit(1).cast("long").alias("size")), ways, {"size": "sum"})
    parents = nodes.select(*KEY).join(ways[0].select(*KEY, "up"), KEY, "left").join(sizes, KEY)
    # Roots have no parent, which as a key has to equal itself.
    placed = running(parents.select(*KEY, "size", F.coalesce("up", F.lit(0)).alias("_up"), F.col("up").isNull().alias("_root")), ["tree_id", "_up", "_root"], "node_id", "size", "_elder")
    own = staged(placed.select(*KEY, "size", (F.col("_elder") + (~F.col("_root")).cast("long")).alias("_own")), "siblings")
    numbered = along(own, ways, "_own", "first").join(own.select(*KEY, "size"), KEY)
    return staged(numbered.select(*KEY, "first", (F.col("first") + F.col("size") - 1).alias("last")), "intervals")


def climbed(starts: DataFrame, ways: list[DataFrame], passed: DataFrame, where) -> DataFrame:
    """starts (tree_id, node_id, ...) with stop_id: the lowest ancestor that isn't passed; starts without one go.

    passed: tree_id, node_id and what `where` tells by; where(columns of starts and passed) holds for the ancestors that
    are gone by, and for all below those.
    """
    carried = [c for c in starts.columns if c != "tree_id"]
    now = starts.withColumn("_at", F.col("node_id"))
    facts = passed.withColumnRenamed("node_id", "_up")
    for way in reversed(ways):
        known = way.select("tree_id", F.col("node_id").alias("_at"), F.col("up").alias("_up")).join(facts, ["tree_id", "_up"])
        moved = now.join(known, ["tree_id", "_at"], "left")
        now = staged(moved.select("tree_id", *carried, F.when(F.col("_up").isNotNull() & F.coalesce(where, F.lit(False)), F.col("_up")).otherwise(F.col("_at")).alias("_at")), "climbed")
    top = ways[0].select("tree_id", F.col("node_id").alias("_at"), F.col("up").alias("stop_id"))
    return now.join(top, ["tree_id", "_at"]).drop("_at")


def previous(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """leaves (tree_id, node_id, first, ...) with before (the node) and before_first of the one with the same keys that comes before in the tree; those without one go."""
    block = F.floor(F.col("first") / BLOCK).alias("_block")
    rows = leaves.select(*keys, "node_id", "first", block)
    ends = rows.groupBy(*keys, "_block").agg(F.max_by(F.struct("node_id", "first"), "first").alias("_end"))
    earlier = ends.withColumn("_earlier", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_block"))).drop("_end")
    inside = F.lag(F.struct("node_id", "first")).over(Window.partitionBy(*keys, "_block").orderBy("first"))
    found = rows.withColumn("_inside", inside).join(earlier, [*keys, "_block"]).withColumn("_found", F.coalesce("_inside", "_earlier"))
    return found.where("_found is not null").select(*keys, "node_id", "first", F.col("_found.node_id").alias("before"))


def below(tops: DataFrame, spans: DataFrame, leaves: DataFrame) -> DataFrame:
    """tops (tree_id, stop_id) with the columns of each of leaves (tree_id, node_id, first, ...) below it.

    spans: tree_id, node_id, first, last. A range is cut where blocks of numbers end, so tops and leaves meet by equal blocks.
    """
    ranges = tops.join(spans.select("tree_id", F.col("node_id").alias("stop_id"), F.col("first").alias("_lo"), F.col("last").alias("_hi")), ["tree_id", "stop_id"])
    ranges = ranges.withColumn("_block", F.explode(F.sequence(F.floor(F.col("_lo") / BLOCK), F.floor(F.col("_hi") / BLOCK))))
    held = leaves.withColumn("_block", F.floor(F.col("first") / BLOCK))
    return ranges.join(held, ["tree_id", "_block"]).where("first >= _lo and first <= _hi").drop("_block", "_lo", "_hi")
